"""Alignment of two tokenizers' tokens by their bytes.

Both tokenizers are read over one space and the text. A token covers a range of bytes, so each side is
a token-byte incidence matrix, kept as hand-built compressed rows (`Rows`). Their product A·Bᵀ, row by
row after Gustavson, has an entry for each two tokens that overlap, which counts the bytes they share:
the overlap links. Bytes where tokens of both sides end cut the tokens into groups; the product of the
token-group incidence matrices has an entry for each two tokens of a group: the shared-group links. A
group of many tokens has many of those, so the product is taken by the rows asked for: one row a group
names its tokens, and the number of all shared-group links comes from the product with a vector.

A text is cut into parts at single spaces. No token crosses the border before such a space, since one
tokenizer's pattern begins a piece there and no piece of the other holds a space after another character,
and either tokenizer reads what follows as it reads a text after the leading space; so
the parts are aligned on their own, and memory follows a part, not the longest text.

**Counts over the corpus.** Documents are gathered into blocks of about `BLOCK` characters. A block keeps
its distinct pairs of ids once, with the number of its documents that hold them, and each document's
links as positions in that list. Only the lists of distinct pairs are summed over the corpus; the sums
return to their blocks, which are stored between the two passes, so tokenizing happens once.

Defined results: texts that are null or empty, or that one of the tokenizers does not give back byte by
byte, have no tokens; numbers are 0 and the digest an empty string. Ids may be null or repeated: each row
is a document. Ties for an id's highest count all count as best. Empty tables give no rows. Other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import pick
from hackney.session import stage, stages_dropped

RANKS = "byte_bpe_50k.tiktoken"
MODEL = "piece_bpe_32k.model"
PART = 1 << 20  # characters of a part
TOGETHER = 1 << 19  # characters whose parts are aligned in one product
BLOCK = 8 << 20  # characters of the documents of a block
SHIFT = 20  # bits of a pair that hold the second id
_CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Rows:
    """A matrix by its rows: those of entries `starts[i]` to `starts[i + 1]`, in rising columns."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    n_columns: int

    def __len__(self) -> int:
        return len(self.starts) - 1

    def row_of_entries(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def transposed(self) -> Rows:
        order = np.argsort(self.columns, kind="stable")
        starts = np.zeros(self.n_columns + 1, np.int64)
        np.cumsum(np.bincount(self.columns, minlength=self.n_columns), out=starts[1:])
        return Rows(starts, self.row_of_entries()[order], self.values[order], len(self))

    def only(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[rows]
        starts = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(starts[-1]) + np.repeat(self.starts[rows] - starts[:-1], sizes)
        return Rows(starts, self.columns[at], self.values[at], self.n_columns)

    def times(self, other: Rows) -> Rows:
        """Row i of the product adds up the rows of `other` that row i names."""
        sizes = np.diff(other.starts)[self.columns]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(other.starts[self.columns] - (ends - sizes), sizes)
        keys = np.repeat(self.row_of_entries(), sizes) * other.n_columns + other.columns[at]
        values = np.repeat(self.values, sizes) * other.values[at]
        if np.any(keys[1:] < keys[:-1]):
            order = np.argsort(keys, kind="stable")
            keys, values = keys[order], values[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        values = np.add.reduceat(values, first) if len(first) else values
        rows = keys[first] // max(other.n_columns, 1)
        starts = np.searchsorted(rows, np.arange(len(self) + 1))
        return Rows(starts, keys[first] % max(other.n_columns, 1), values, other.n_columns)


def token_bytes(ends: np.ndarray) -> Rows:
    """Which bytes each token covers; tokens follow one another."""
    total = int(ends[-1]) if len(ends) else 0
    return Rows(np.concatenate(([0], ends)), np.arange(total), np.ones(total, np.int64), total)


def token_groups(ends: np.ndarray, group_ends: np.ndarray) -> Rows:
    """The one group of each token."""
    groups = np.searchsorted(group_ends, ends)
    return Rows(np.arange(len(ends) + 1), groups, np.ones(len(ends), np.int64), len(group_ends))


class Sides:
    """Both tokenizers, the bytes of their tokens and the decimal names of their ids."""

    def __init__(self, ranks_path: str, model_path: str):
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.a = tiktoken.Encoding(
            "a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_path)
        a_bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            a_bytes[rank] = token
        b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i in range(self.b.vocab_size())
            for piece in [self.b.id_to_piece(i)]
        ]
        if any(b" " in token.lstrip(b" ") for token in b_bytes):
            raise ValueError("a piece holds a space after another character")
        self.a_tokens, self.b_tokens = pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())
        self.a_sizes = np.array([*map(len, a_bytes)], np.int64)
        self.b_sizes = np.array([*map(len, b_bytes)], np.int64)
        # An id's name before another one of its side, and as the last of its side in a group.
        self.names = pa.array(
            [f"{i},".encode() for i in range(len(a_bytes))] + [f"{i}|".encode() for i in range(len(a_bytes))]
            + [f"{i},".encode() for i in range(len(b_bytes))] + [f"{i};".encode() for i in range(len(b_bytes))],
            pa.binary(),
        )


@lru_cache(maxsize=1)
def sides(ranks_path: str, model_path: str) -> Sides:
    return Sides(ranks_path, model_path)


def parts_of(text: str, size: int = PART) -> Iterator[str]:
    """The text without the single spaces at which it is cut."""
    lo = 0
    while len(text) - lo > size:
        cut = _CUT.search(text, lo + size)
        if cut is None:
            break
        yield text[lo : cut.start()]
        lo = cut.end()
    yield text[lo:]


def _joined(tokens: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Where each token's bytes end among the bytes of all, and these."""
    _, offsets, data = tokens.take(pa.array(ids)).buffers()
    ends = np.frombuffer(offsets, np.int32)[1 : len(ids) + 1]
    return ends, data.to_pybytes() if data is not None else b""


@dataclass(frozen=True)
class Aligned:
    """Parts of texts: ids of both sides, the part of each, groups, and overlap links between positions."""

    a: np.ndarray
    b: np.ndarray
    a_part: np.ndarray
    b_part: np.ndarray
    a_groups: Rows
    b_groups: Rows
    links: Rows
    wrong: np.ndarray  # parts that one side does not give back; they have no tokens here

    def shared_links(self, rows: np.ndarray) -> Rows:
        """The tokens of B in the group of each of the given tokens of A."""
        return self.a_groups.only(rows).times(self.b_groups.transposed())

    def n_shared(self) -> np.ndarray:
        """Shared-group links of each token of A."""
        return np.bincount(self.b_groups.columns, minlength=self.b_groups.n_columns)[self.a_groups.columns]


def align_parts(two: Sides, parts: list[str]) -> Aligned:
    raw = [b" " + part.encode() for part in parts]
    kept_ids, kept_parts, wrong = [], [], np.zeros(len(parts), bool)
    for encoded, tokens, sizes in (
        (two.a.encode_ordinary_batch([" " + p for p in parts], num_threads=1), two.a_tokens, two.a_sizes),
        (two.b.encode(parts, num_threads=1), two.b_tokens, two.b_sizes),
    ):
        counts = np.array([*map(len, encoded)], np.int64)
        ids = np.array([i for e in encoded for i in e], np.int64)
        ends, data = _joined(tokens, ids)
        stops = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))]
        for k, given in enumerate(raw):
            wrong[k] |= data[stops[k] : stops[k + 1]] != given
        kept_ids.append(ids)
        kept_parts.append(np.repeat(np.arange(len(parts)), counts))
    ends = []
    for side, sizes in enumerate((two.a_sizes, two.b_sizes)):
        right = ~wrong[kept_parts[side]]
        kept_ids[side], kept_parts[side] = kept_ids[side][right], kept_parts[side][right]
        ends.append(np.cumsum(sizes[kept_ids[side]]))
    group_ends = np.intersect1d(*ends, assume_unique=True)
    return Aligned(
        *kept_ids,
        *kept_parts,
        token_groups(ends[0], group_ends),
        token_groups(ends[1], group_ends),
        token_bytes(ends[0]).times(token_bytes(ends[1]).transposed()),
        wrong,
    )


def group_names(two: Sides, found: Aligned) -> tuple[np.ndarray, bytes]:
    """`a1,a2|b1;` for all groups in order as bytes, and where each token of A's first byte is."""
    n_a, n_b = len(two.a_sizes), len(two.b_sizes)
    leaders = np.flatnonzero(np.diff(found.a_groups.columns, prepend=-1))
    members = found.shared_links(leaders)
    a_last = np.diff(found.a_groups.columns, append=-1) != 0
    b_last = np.zeros(len(found.b), bool)
    b_last[members.starts[1:] - 1] = True
    codes = np.empty(len(found.a) + len(found.b), np.int64)
    b_before = members.starts[:-1][found.a_groups.columns]
    a_at = np.arange(len(found.a)) + b_before
    a_until = np.append(leaders[1:], len(found.a))
    b_at = np.arange(len(found.b)) + a_until[members.row_of_entries()]
    codes[a_at] = found.a + a_last * n_a
    codes[b_at] = 2 * n_a + found.b[members.columns] + b_last * n_b
    ends, data = _joined(two.names, codes)
    return np.concatenate(([0], ends))[a_at], data


def _paths(ranks_path: str | None, model_path: str | None) -> tuple[str, str]:
    return ranks_path or public_tokenizers.path(RANKS), model_path or public_tokenizers.path(MODEL)


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_path: str | None = None,
    model_path: str | None = None,
) -> DataFrame:
    """Tokens, groups and overlap links of each document.

    `a_ids`, `b_ids`; `a_group` and `b_group`, the group of each token; `link_a`, `link_b`, positions of
    tokens that overlap, and `link_bytes`, the bytes they share; `n_shared`, the shared-group links.
    """
    paths = _paths(ranks_path, model_path)
    names = ["a_ids", "b_ids", "a_group", "b_group", "link_a", "link_b", "link_bytes"]

    def document(two: Sides, text: str) -> dict:
        columns: dict[str, list] = {name: [] for name in names}
        n_a = n_b = n_groups = n_shared = 0
        for part in parts_of(text) if text else ():
            found = align_parts(two, [part])
            if found.wrong.any():
                return {name: [] for name in names} | {"n_shared": 0}
            of = found.links.row_of_entries()
            for name, values in zip(names, (
                found.a, found.b, found.a_groups.columns + n_groups, found.b_groups.columns + n_groups,
                of + n_a, found.links.columns + n_b, found.links.values,
            ), strict=True):
                columns[name].append(values)
            n_a, n_b, n_groups = n_a + len(found.a), n_b + len(found.b), n_groups + found.a_groups.n_columns
            n_shared += int(found.n_shared().sum())
        return {k: np.concatenate(v) if v else [] for k, v in columns.items()} | {"n_shared": n_shared}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = sides(*paths)
        kinds = [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64())] * 5
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                row = document(two, text.as_py() or "")
                lists = [pa.array([row[n]], kind) for n, kind in zip(names, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id.as_py()], pa.int64()), *lists, pa.array([row["n_shared"]], pa.int64())],
                    names=["doc_id", *names, "n_shared"],
                )

    return (
        pick(docs, doc_id=id_col, text=text_col)
        .selectExpr("cast(doc_id as bigint) doc_id", "text")
        .mapInArrow(
            run,
            "doc_id long, a_ids array<int>, b_ids array<int>, a_group array<long>, b_group array<long>,"
            " link_a array<long>, link_b array<long>, link_bytes array<long>, n_shared long",
        )
    )


class _Block:
    """Documents of a block as they are aligned, and its row."""

    COLUMNS = ("n_a", "n_b", "n_groups", "n_links")
    SCHEMA = (
        "block long, doc_id array<bigint>, n_a array<long>, n_b array<long>, n_groups array<long>,"
        " n_links array<long>, digest array<string>, pairs array<long>, docs array<int>,"
        " held array<int>, positions binary, times binary"
    )

    def __init__(self, two: Sides, number: int, part: int, together: int):
        self.two, self.number = two, number
        self.part_size, self.together = part, together
        self.doc_ids: list[int | None] = []
        self.digests, self.wrong = [], []
        self.numbers: list[list[int]] = []
        self.parts: list[str] = []
        self.part_docs: list[int] = []
        self.size = self.waiting = 0
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, doc_id: int | None, text: str) -> None:
        doc = len(self.doc_ids)
        self.doc_ids.append(doc_id)
        self.digests.append(hashlib.sha256())
        self.wrong.append(False)
        self.numbers.append([0, 0, 0, 0])
        self.size += len(text)
        for part in parts_of(text, self.part_size) if text else ():
            self.parts.append(part)
            self.part_docs.append(doc)
            self.waiting += len(part)
            if self.waiting >= self.together:
                self.work()

    def work(self) -> None:
        if not self.parts:
            return
        parts, of = self.parts, np.array(self.part_docs)
        self.parts, self.part_docs, self.waiting = [], [], 0
        found = align_parts(self.two, parts)
        for k in np.flatnonzero(found.wrong):
            self.wrong[of[k]] = True
        n = len(parts)
        a_bounds = np.searchsorted(found.a_part, np.arange(n + 1))
        group_part = found.a_part[np.flatnonzero(np.diff(found.a_groups.columns, prepend=-1))]
        link_a = found.links.row_of_entries()
        numbers = zip(*(
            np.bincount(p, minlength=n).tolist()
            for p in (found.a_part, found.b_part, group_part, found.a_part[link_a])
        ), strict=True)
        begins, names = group_names(self.two, found)
        begins = np.append(begins, len(names) if len(found.a) else 0)
        for k, (doc, own) in enumerate(zip(of.tolist(), numbers, strict=True)):
            if own[0]:
                lo, hi = int(begins[a_bounds[k]]), int(begins[a_bounds[k + 1]])
                if self.numbers[doc][0]:
                    self.digests[doc].update(b";")
                self.digests[doc].update(names[lo : hi - 1])
                for i, value in enumerate(own):
                    self.numbers[doc][i] += value
        pairs = (found.a[link_a] << SHIFT) | found.b[found.links.columns]
        distinct, code = np.unique(pairs, return_inverse=True)
        size = max(len(distinct), 1)
        keys, times = np.unique(of[found.a_part[link_a]] * size + code, return_counts=True)
        self.found.append((keys // size, distinct[keys % size], times))

    def row(self) -> pa.RecordBatch:
        self.work()
        n = len(self.doc_ids)
        empty = np.zeros(0, np.int64)
        docs, pairs, times = (np.concatenate([f[i] for f in self.found] or [empty]) for i in range(3))
        wrong = np.array(self.wrong, bool)
        right = ~wrong[docs] if len(docs) else np.zeros(0, bool)
        docs, pairs, times = docs[right], pairs[right], times[right]
        distinct, position = np.unique(pairs, return_inverse=True)
        size = max(len(distinct), 1)
        # A document whose parts were aligned apart has a pair once in each.
        keys, at = np.unique(docs * size + position, return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, times)
        holders = np.bincount(keys % size, minlength=len(distinct))
        lists = [[0] * 4 if w else x for w, x in zip(self.wrong, self.numbers, strict=True)]
        digests = [d.hexdigest() if x[0] else "" for d, x in zip(self.digests, lists, strict=True)]
        held = np.bincount(keys // size, minlength=n)
        columns = [
            pa.array([self.number], pa.int64()),
            pa.array([self.doc_ids], pa.list_(pa.int64())),
            *(pa.array([[x[i] for x in lists]], pa.list_(pa.int64())) for i in range(4)),
            pa.array([digests], pa.list_(pa.string())),
            pa.array([distinct], pa.list_(pa.int64())),
            pa.array([holders], pa.list_(pa.int32())),
            pa.array([held], pa.list_(pa.int32())),
            *(pa.array([_packed(v)], pa.binary()) for v in (keys % size, sums)),
        ]
        names = [f.split()[0] for f in self.SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names=names)


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.diff(values, prepend=0).astype("<i8").tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(pa.decompress(data, 8 * n, "zstd"), "<i8"))


def _weighed(block: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of a block, with the counts of their links."""
    (row,) = block.to_pylist()
    counts = np.zeros(len(row["pairs"]), np.int64)
    best = np.zeros(len(row["pairs"]), np.int64)
    at = answers["position"].to_numpy()
    counts[at] = answers["n"].to_numpy()
    best[at] = answers["best"].to_numpy(zero_copy_only=False)
    held = np.array(row["held"], np.int64)
    total = int(held.sum())
    positions, times = _unpacked(row["positions"], total), _unpacked(row["times"], total)
    ends = np.cumsum(held)

    def per_document(values: np.ndarray) -> pa.Array:
        sums = np.concatenate(([0], np.cumsum(values)))
        return pa.array(sums[ends] - sums[ends - held], pa.int64())

    return pa.table(
        {
            "doc_id": pa.array(row["doc_id"], pa.int64()),
            **{name: pa.array(row[name], pa.int64()) for name in _Block.COLUMNS},
            "n_best": per_document(times * best[positions]),
            "count_sum": per_document(times * counts[positions]),
            "digest": pa.array(row["digest"], pa.string()),
        }
    )


def link_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_path: str | None = None,
    model_path: str | None = None,
    part_chars: int = PART,
    together_chars: int = TOGETHER,
    block_chars: int = BLOCK,
) -> DataFrame:
    """Per document its tokens, groups and links, weighed by how many documents hold a link's pair of ids.

    `n_best` counts links whose pair is the most frequent one of its first id; `count_sum` adds up the
    documents of all links' pairs; `digest` is the SHA-256 of the groups as `a1,a2|b1;a3|b2,b3`.
    """
    paths = _paths(ranks_path, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        two = sides(*paths)
        block = _Block(two, number, part_chars, together_chars)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                block.add(doc_id.as_py(), text.as_py() or "")
                if block.size >= block_chars or len(block.doc_ids) >= 1 << 16:
                    yield block.row()
                    number += 1
                    block = _Block(two, number, part_chars, together_chars)
        if block.doc_ids:
            yield block.row()

    chosen = pick(docs, doc_id=id_col, text=text_col).selectExpr("cast(doc_id as bigint) doc_id", "text")
    with stages_dropped(docs.sparkSession) as keep:
        blocks = keep(stage(chosen.mapInArrow(run, _Block.SCHEMA), "aligned"))
        listed = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("position", "of"))
        listed = listed.select("block", "position", F.col("of.pairs").alias("pair"), F.col("of.docs").alias("docs"))
        counted = stage(listed.groupBy("pair").agg(F.sum("docs").alias("n")), "pairs")
        first = F.shiftright("pair", SHIFT).alias("first")
        most = counted.groupBy(first).agg(F.max("n").alias("most"))
        weights = counted.withColumn("first", first).join(most, "first").select(
            "pair", "n", (F.col("n") == F.col("most")).alias("best")
        )
        weights = keep(stage(weights, "weights"))
        answers = listed.join(weights, "pair").select(
            F.col("block").alias("of_block"), "position", "n", "best"
        )
    return (
        blocks.drop("docs")
        .groupBy("block")
        .cogroup(answers.groupBy("of_block"))
        .applyInArrow(
            _weighed,
            "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
            " digest string",
        )
    )
