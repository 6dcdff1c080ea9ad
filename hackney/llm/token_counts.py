"""Token counts by a tokenizer compiled to a finite-state transducer.

The greedy merges of a byte-pair model with scores have a local description: a row of pieces is the
model's segmentation if and only if each two neighbours are the segmentation of their own
concatenation, because merges follow one order (score, then position) and none may cross a border. So
the last piece of every prefix is determined by the last pieces of shorter prefixes, and a reader needs
to remember only the positions from which a piece could still reach beyond the text read so far.

That memory is the transducer's state: the longest suffix that begins some piece and, for each position
in it, the last piece that ends there and the number of pieces up to there, relative to now. A transition
reads one character and is annotated with the number of tokens it adds, which may be negative when
pieces merge. States and transitions are compiled as texts first need them and then kept; beyond
their limits the tables start anew, which costs time but changes no count.

Texts are cut into chunks. The state map of a chunk says, for any state before it, which state follows
and how many tokens are added. A space after another character resets the state, so a map is the head
before the first reset, which still depends on the state before, a number, and the state at the end.
Maps compose associatively; a document's maps are composed as a balanced tree, as in a parallel prefix
scan. Only maps are shuffled, never texts.

Defined results: a null text counts as empty, with no tokens. Null and repeated ids are carried along,
one row each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.llm.common import pick

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
CHUNK = 1 << 15
SUPER_CHUNKS = 128
#: States, words and pairs that are kept compiled; together some 300 MB in a Python worker.
MAX_STATES, MAX_WORDS, MAX_PAIRS = 200_000, 400_000, 300_000
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_BOUNDARY = re.compile(f"(?<=[^{SPACE}]){SPACE}")

#: No piece can reach back from here: the beginning of a text, a word, or after an unknown character.
START = ("", (None,), (0,))


class Transducer:
    """The compiled model. `run` reads characters from a state; `words` counts whole words."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.scores = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.vocab_size())
            if not (
                model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
            )
        }
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("a piece holds a space after another character")
        # States share these strings rather than hold slices of their own.
        self.pieces = {p: p for p in self.scores}
        self.prefixes = {q: q for p in self.scores for n in range(1, len(p)) for q in [p[:n]]}
        self.pairs: dict[tuple[str | None, str], bool] = {}
        self.forget()

    def forget(self) -> None:
        self.states = [START]
        self.numbers = {START: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.known: dict[str, int] = {}

    def segment(self, text: str) -> list[str]:
        """The model's merges, one by one."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, before: str | None, piece: str) -> bool:
        key = (before, piece)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            if before is None:
                known = self.segment(piece) == [piece]
            else:
                known = self.segment(before + piece) == [before, piece]
            self.pairs[key] = known
        return known

    def number(self, state: tuple) -> int:
        known = self.numbers.get(state)
        if known is None:
            known = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return known

    def move(self, state: int, char: str) -> tuple[int, int]:
        """The next state and the tokens that reading `char` adds."""
        suffix, last, counts = self.states[state]
        if char == SPACE and not suffix.endswith(SPACE):
            suffix, last, counts = START
        if char not in self.scores:
            return 0, len(char.encode())
        text = suffix + char
        for j in range(len(text)):
            piece = text[j:]
            if piece in self.scores and self.fits(last[j], piece):
                break
        else:
            raise AssertionError(f"no piece ends {text!r}")
        added = counts[j] + 1
        keep = next(k for k in range(len(text) + 1) if k == len(text) or text[k:] in self.prefixes)
        # Positions from which no piece can reach on are all alike.
        here = len(text)
        alive = [k == here or text[k:] in self.prefixes for k in range(keep, here + 1)]
        ends = (*last, self.pieces[piece])[keep:]
        lasts = tuple(p if a else "" for p, a in zip(ends, alive, strict=True))
        relative = tuple(
            c - added if a else 0 for c, a in zip((*counts, added)[keep:], alive, strict=True)
        )
        suffix = self.prefixes.get(text[keep:], "")
        return self.number((suffix, lasts, relative)), added

    def run(self, state: int, text: str) -> tuple[int, int]:
        total = 0
        moves = self.moves
        for char in text:
            known = moves[state].get(char)
            if known is None:
                known = moves[state][char] = self.move(state, char)
            state = known[0]
            total += known[1]
        return state, total

    def words(self, text: str) -> int:
        """Tokens of a text that begins and ends at resets."""
        known = self.known
        total = 0
        for word in _WORDS.findall(text):
            n = known.get(word)
            if n is None:
                n = known[word] = self.run(0, word)[1]
            total += n
        return total

    def tidy(self) -> None:
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        if len(self.states) > MAX_STATES:
            self.forget()

    # State maps: (head, tokens, state after or None where the head is the whole chunk).

    def chunk_map(self, text: str) -> tuple[str, int, tuple | None]:
        first = _BOUNDARY.search(text)
        if first is None:
            return text, 0, None
        last = text.rfind(SPACE)
        while last > first.start() and text[last - 1] == SPACE:
            last -= 1
        last = max(last, first.start())
        state, tokens = self.run(0, text[last:])
        tokens += self.words(text[first.start() : last])
        return text[: first.start()], tokens, self.states[state]

    def compose(self, a: tuple, b: tuple) -> tuple:
        if a[2] is None:
            return a[0] + b[0], b[1], b[2]
        state, tokens = self.run(self.number(a[2]), b[0])
        after = self.states[state] if b[2] is None else b[2]
        return a[0], a[1] + tokens + b[1], after

    def scan(self, maps: list[tuple]) -> int:
        """Tokens of a document, from the maps of its chunks in order."""
        level = [("", 0, START), *maps]
        while len(level) > 1:
            pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
            level = [self.compose(*p) if len(p) == 2 else p[0] for p in pairs]
        return level[0][1]


@lru_cache(maxsize=1)
def transducer(model_path: str) -> Transducer:
    return Transducer(model_path)


MAPS = "row long, doc_id long, n_bytes long, chunk long, head string, tokens long, after binary"
COUNTS = "doc_id long, n_bytes long, n_tokens long"


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_path: str | None = None,
    chunk_chars: int = CHUNK,
) -> DataFrame:
    """One row per document: `doc_id`, `n_bytes` of UTF-8 and `n_tokens`."""
    path = model_path or public_tokenizers.path(MODEL)

    def pieces(text: str, number: str, size: int) -> tuple:
        length = F.greatest(F.ceil(F.length(text) / size), F.lit(1)).cast("int")
        return F.posexplode(F.transform(
            F.sequence(F.lit(0), length - 1), lambda i: F.substring(text, i * size + 1, F.lit(size))
        )).alias(number, "text")

    # Two levels, as taking a part of a string reads what stands before it.
    rows = (
        pick(docs, doc_id=id_col, text=text_col)
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumn("n_bytes", F.octet_length("text").cast("long"))
        .select("row", "doc_id", "n_bytes", pieces("text", "high", chunk_chars * SUPER_CHUNKS))
        .select("row", "doc_id", "n_bytes", "high", pieces("text", "low", chunk_chars))
        .select(
            "row", "doc_id", "n_bytes",
            (F.col("high").cast("long") * SUPER_CHUNKS + F.col("low")).alias("chunk"), "text",
        )
    )

    def map_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        schema = pa.schema(
            [("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("chunk", pa.int64()),
             ("head", pa.string()), ("tokens", pa.int64()), ("after", pa.binary())]
        )
        for batch in batches:
            heads, tokens, afters = [], [], []
            chunks = batch.column("chunk").to_pylist()
            for chunk, text in zip(chunks, batch.column("text").to_pylist(), strict=True):
                machine.tidy()
                text = text.replace(" ", SPACE)
                if chunk == 0 and text:
                    text = SPACE + text
                head, n, after = machine.chunk_map(text)
                heads.append(head)
                tokens.append(n)
                afters.append(None if after is None else pickle.dumps(after))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id", "n_bytes", "chunk")),
                 pa.array(heads, pa.string()), pa.array(tokens, pa.int64()), pa.array(afters, pa.binary())],
                schema=schema,
            )

    def compose_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            totals = []
            for maps in batch.column("maps").to_pylist():
                machine.tidy()
                maps.sort(key=lambda m: m["chunk"])
                totals.append(
                    machine.scan(
                        [
                            (m["head"], m["tokens"], m["after"] and pickle.loads(m["after"]))
                            for m in maps
                        ]
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    maps = rows.mapInArrow(map_chunks, MAPS)
    by_row = maps.groupBy("row", "doc_id", "n_bytes").agg(
        F.collect_list(F.struct("chunk", "head", "tokens", "after")).alias("maps")
    )
    return by_row.drop("row").mapInArrow(compose_maps, COUNTS)
