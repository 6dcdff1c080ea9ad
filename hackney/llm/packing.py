"""Cost-balanced packing of token sequences.

A sequence costs `linear * n + quadratic * n * n` for each piece of n tokens in it, since attention
stays within a piece. Documents of a batch are assigned in descending order of their cost to the
sequence of lowest cost that has token capacity left.

The number of sequences is fixed before anything is assigned: as many whole ones as the batch's tokens
fill, and for the rest sequences whose capacities are the powers of two that add up to it. So every
capacity is filled to the last token, and no sequence needs padding. A document that is longer than a
sequence first gives whole sequences of its own. A document for which none of the cheapest sequences
has room in one piece is cut at the room of the cheapest.

Batches are runs of documents of a partition, of `batch_tokens` tokens or a little more. They are
packed inside the task that tokenizes them: nothing is shuffled, memory is bounded by a batch and the
longest text, and a lost executor costs its own tasks. Sequence ids hold the partition's number.

Defined results: a null text is an empty one, which gives a piece of the separator alone. Null or
repeated ids are carried along; each row is packed as a document of its own. An empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hackney.llm.common import pick

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
TRIED = 16  # cheapest sequences that are asked for room before a document is cut

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("sequence_tokens", T.LongType()),
    ]
)


@lru_cache(maxsize=1)
def _encoders(tokenizer_path: str, ranks_path: str | None):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path)
    if ranks_path is None:
        return library, None, ()
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    same = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    special = tuple(t.content for t in library.get_added_tokens_decoder().values())
    return library, same, special


def encode(texts: Sequence[str], tokenizer_path: str, ranks_path: str | None) -> list[list[int]]:
    """Ids as `tokenizers` gives them for the file, without added special tokens.

    With a rank file of the same vocabulary, texts that hold none of the special strings go through
    the quicker reader of that file; tests hold its ids against those of `tokenizers`.
    """
    library, same, special = _encoders(tokenizer_path, ranks_path)
    if same is None:
        return [e.ids for e in library.encode_batch(list(texts), add_special_tokens=False)]
    return [
        library.encode(text, add_special_tokens=False).ids
        if any(s in text for s in special)
        else same.encode_ordinary(text)
        for text in texts
    ]


def capacities(tokens: int, size: int) -> list[int]:
    """Whole sequences, then the powers of two that add up to the rest."""
    rest = tokens % size
    return [size] * (tokens // size) + [
        1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1
    ]


def assign(
    lengths: Sequence[int], size: int, linear: float, quadratic: float
) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Pieces (document, start, length, sequence, offset) and the sequences' lengths."""
    rooms = capacities(sum(lengths), size)
    pieces = []
    used = 0
    rests = []
    for doc, length in enumerate(lengths):
        whole = length // size
        for k in range(whole):
            pieces.append((doc, k * size, size, used, 0))
            used += 1
        if length % size:
            rests.append((length % size, doc, whole * size))
    rests.sort(key=lambda r: (-r[0], r[1]))
    # Small sequences come after whole ones, else their low cost would always be tried first.
    heap = [(rooms[s] < size, 0.0, s) for s in range(used, len(rooms))]
    heapq.heapify(heap)
    left = list(rooms)
    for length, doc, start in rests:
        while length:
            tried = []
            chosen = None
            while heap and len(tried) < TRIED:
                entry = heapq.heappop(heap)
                if left[entry[2]] >= length:
                    chosen = entry
                    break
                tried.append(entry)
            if chosen is None:
                chosen = tried.pop(0)
            for entry in tried:
                heapq.heappush(heap, entry)
            small, cost, sequence = chosen
            n = min(length, left[sequence])
            pieces.append((doc, start, n, sequence, rooms[sequence] - left[sequence]))
            left[sequence] -= n
            if left[sequence]:
                heapq.heappush(heap, (small, cost + linear * n + quadratic * n * n, sequence))
            start += n
            length -= n
    return pieces, rooms


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 1024,
    separator: int = 0,
    linear: float = 1.0,
    quadratic: float = 1.0 / 1024,
    batch_tokens: int = 1 << 20,
    tokenizer_path: str | None = None,
    ranks_path: str | None = None,
) -> DataFrame:
    """Pieces of all documents: where they stand in their document and sequence, and their ids.

    `ids` holds little-endian unsigned 32-bit integers. Paths default to the public 50k vocabulary; a
    `tokenizer_path` of another one goes without `ranks_path`.
    """
    if tokenizer_path is None:
        tokenizer_path = public_tokenizers.path(TOKENIZER)
        ranks_path = public_tokenizers.path(RANKS)

    def packed(batch: list, first: int) -> tuple[pa.RecordBatch, int]:
        pieces, rooms = assign([len(ids) for _, ids in batch], max_tokens, linear, quadratic)
        columns = {name: [] for name in PIECES.names}
        for doc, start, length, sequence, offset in pieces:
            name, ids = batch[doc]
            columns["doc_id"].append(name)
            columns["start"].append(start)
            columns["length"].append(length)
            columns["ids"].append(ids[start : start + length].tobytes())
            columns["doc_tokens"].append(len(ids))
            columns["sequence_id"].append(first + sequence)
            columns["offset"].append(offset)
            columns["sequence_tokens"].append(rooms[sequence])
        kinds = {"ids": pa.binary()}
        arrays = [pa.array(v, kinds.get(k, pa.int64())) for k, v in columns.items()]
        return pa.RecordBatch.from_arrays(arrays, names=list(columns)), first + len(rooms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        batch, tokens = [], 0
        for rows in batches:
            names = rows.column(0).to_pylist()
            for lo in range(0, len(names), 256):
                texts = [t or "" for t in rows.column(1).slice(lo, 256).to_pylist()]
                for name, ids in zip(
                    names[lo : lo + 256], encode(texts, tokenizer_path, ranks_path), strict=True
                ):
                    ids.append(separator)
                    batch.append((name, np.array(ids, "<u4")))
                    tokens += len(ids)
                    if tokens >= batch_tokens:
                        done, first = packed(batch, first)
                        yield done
                        batch, tokens = [], 0
        if batch:
            yield packed(batch, first)[0]

    chosen = pick(docs, doc_id=id_col, text=text_col)
    return chosen.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(run, PIECES)
