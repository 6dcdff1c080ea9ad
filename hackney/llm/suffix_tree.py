"""Language-model scores by a probabilistic suffix tree.

The text is a row of tokens: words, A-Z lower-cased, and one end. The tree's symbols are bytes: a word is
its bytes and a space, the end is one symbol of its own, so the probability of a text is the product of
its symbols' and covers words that were never seen. A state is a context of up to `depth` preceding
symbols.

Learning. Tasks count the contexts of the training texts with their next symbols, Spark adds the counts
up, and counts of shorter contexts follow from those of longer ones. A context is a candidate if it makes
up at least `least_share` of all positions. It is retained if its next-symbol distribution diverges from
that of the context shortened by its oldest symbol by more than a description-length penalty: N times the
Kullback-Leibler divergence against half a logarithm of N for each next symbol. Suffixes of retained
contexts are states as well. Distributions are smoothed with the shorter context's, by the number of
different next symbols (Witten and Bell), down to single symbols and a uniform floor.

Scoring. Each position descends from the root by the preceding symbols to its longest state. A token's
chance by the tree is the product over its symbols, down to its separator, so all spellings share one
mass. It is mixed evenly with the token's share of the training tokens, so that words too rare for states
of their own keep what the counts know; a word never seen has only the tree's half, and the longer it is
the less. The chances of all texts thus add up to at most 1, where the base model, which grants a chance
to each word never seen whatever their number, adds up to more.

The tree is all that is broadcast. It has at most `depth / least_share` states by the candidates' shares,
whatever the size of the corpus, with at most 256 numbers each. Counts of words, which grow with the
corpus, stay in tables: words that make up at least `common_share` of all tokens (at most 1 / common_share
of them) are sent along, all others are joined by their hash, token by token.

The base score is that of an add-one unigram model of tokens. Words are told apart by 64-bit hashes.

Defined results: a null text counts as empty and has the end as its only token. A row with a null id is
scored but not learned from and not held out. Repeated ids are carried along, one row each. With nothing
to learn from, every symbol has a chance of 1 in 256, no token counts are mixed in, and the base score
is 0. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import LOWER, blocks, pick, span_hashes, utf8_rows, word_spans
from hackney.llm.labelled import remainder
from hackney.session import stage

DEPTH = 5
SEPARATOR, END = 0x20, 0x0A
END_TOKEN = np.uint64(0x0E0D)
GRAMS, WORDS = 0, 1
HELD = 1 << 20  # distinct keys that a task gathers before it passes them on
ROWS = 2048


@dataclass(frozen=True)
class SuffixTree:
    """States as rows: where the next older symbol leads, and log10 of the next-symbol chances.

    `moves` has two rows of states: from a state in the first half an older symbol leads to the longer
    state or, where there is none, to the state's copy in the second half, which nothing leaves.
    """

    codes: np.ndarray  # of the 256 bytes; 0 is any byte that was never seen
    moves: np.ndarray  # (2 * states * symbols)
    logs: np.ndarray  # (states * symbols)
    symbols: int
    depth: int

    @property
    def states(self) -> int:
        return len(self.logs) // self.symbols

    def score(self, stream: np.ndarray) -> np.ndarray:
        """log10 of each symbol's chance after those before it; a stream begins with its context."""
        code = self.codes[stream].astype(np.int32)
        state = np.zeros(len(code), np.int32)
        width = np.int32(self.symbols)
        for back in range(1, self.depth + 1):
            older = np.zeros(len(code), np.int32)
            older[back:] = code[:-back]
            state = self.moves[state * width + older]
        state %= np.int32(self.states)
        return self.logs[state * width + code]


def symbol_streams(
    column: pa.Array, depth: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (symbols, row of each, whether it counts, token hashes, rows of the tokens).

    Tokens are in the order of their last symbols, which are the separators and ends that count.

    Each row's symbols follow an end symbol that does not count, as their context. A row that comes in
    several blocks carries its last symbols over.
    """
    data, bounds = utf8_rows(column)
    done, carry = 0, None
    for first, part, inner in blocks(data, bounds):
        n = len(inner) - 1
        done += len(part)
        complete = done == bounds[first + n]
        low = LOWER[part]
        starts, ends, rows = word_spans(low, inner)
        hashes = span_hashes(low, starts, ends)
        lead = np.arange(n) if carry is None else np.zeros(0, np.int64)
        last = np.arange(n) if complete else np.zeros(0, np.int64)
        owner = np.concatenate([lead, rows, last])
        begin = np.concatenate([np.zeros(len(lead), np.int64), starts, np.zeros(len(last), np.int64)])
        length = np.ones(len(owner), np.int64)
        length[len(lead) : len(lead) + len(rows)] += ends - starts
        final = np.full(len(owner), END, np.uint8)
        final[len(lead) : len(lead) + len(rows)] = SEPARATOR
        counts = np.ones(len(owner), bool)
        counts[: len(lead)] = False
        order = np.argsort(owner, kind="stable")
        owner, begin, length = owner[order], begin[order], length[order]
        stops = np.cumsum(length)
        at = np.arange(stops[-1] if len(stops) else 0)
        at += np.repeat(begin - (stops - length), length)
        padded = np.append(low, np.uint8(0))
        stream = padded[np.minimum(at, len(low))]
        stream[stops - 1] = final[order]
        row = np.repeat(owner, length) + first
        counted = np.repeat(counts[order], length)
        if carry is not None:
            stream = np.concatenate([carry, stream])
            row = np.concatenate([np.full(len(carry), first), row])
            counted = np.concatenate([np.zeros(len(carry), bool), counted])
        carry = None if complete else stream[-(depth + 1) :]
        word_rows = np.concatenate([rows, last])
        order = np.argsort(word_rows, kind="stable")
        words = np.concatenate([hashes, np.full(len(last), END_TOKEN)])[order]
        yield stream, row, counted, words, word_rows[order] + first


def gram_keys(stream: np.ndarray, counted: np.ndarray, depth: int) -> np.ndarray:
    """Context length, context and symbol of each position that counts, in one integer."""
    wide = stream.astype(np.uint64)
    # A context ends at an end symbol: nothing before it is its own text.
    at = np.arange(len(stream))
    opening = np.where(~counted & (stream == END), at, -1)
    reach = np.minimum(at - np.maximum.accumulate(np.maximum(opening, 0)) + 1, depth + 1)
    reach = np.minimum(reach - 1, depth).astype(np.uint64)
    context = np.zeros(len(stream), np.uint64)
    for back in range(depth, 0, -1):
        older = np.zeros(len(stream), np.uint64)
        older[back:] = wide[:-back]
        context = (context << np.uint64(8)) | older
    # Bytes were stacked oldest first, so the latest stands lowest.
    length = reach[counted]
    mask = (np.uint64(1) << (np.uint64(8) * length)) - np.uint64(1)
    keys = (length << np.uint64(48)) | ((context[counted] & mask) << np.uint64(8))
    return keys | wide[counted]


class Tally:
    """Counts of 64-bit keys, merged now and then."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts)
        self.size += len(found)
        if self.size > 2 * HELD:
            self.merge()

    def merge(self) -> None:
        if len(self.keys) > 1:
            found, where = np.unique(np.concatenate(self.keys), return_inverse=True)
            total = np.bincount(where, np.concatenate(self.counts), len(found)).astype(np.int64)
            self.keys, self.counts, self.size = [found], [total], len(found)

    def take(self, kind: int) -> Iterator[pa.RecordBatch]:
        self.merge()
        for keys, counts in zip(self.keys, self.counts, strict=True):
            for lo in range(0, len(keys), 1 << 16):
                part = keys[lo : lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(part), kind, np.int32)),
                        pa.array(part.view(np.int64)),
                        pa.array(counts[lo : lo + (1 << 16)].astype(np.int64)),
                    ],
                    names=["kind", "key", "n"],
                )
        self.__init__()


def corpus_counts(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """`kind, key, n`: how often each context with its next symbol, and each token, occurs in `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {GRAMS: Tally(), WORDS: Tally()}
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                part = batch.column("text").slice(lo, ROWS)
                for stream, _, counted, words, _ in symbol_streams(part, depth):
                    tallies[GRAMS].add(gram_keys(stream, counted, depth))
                    tallies[WORDS].add(words)
                for kind, tally in tallies.items():
                    if tally.size > HELD:
                        tally.merge()
                        if tally.size > HELD:
                            yield from tally.take(kind)
        for kind, tally in tallies.items():
            yield from tally.take(kind)

    counted = texts.select("text").mapInArrow(run, "kind int, key long, n long")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def tree_counts(grams: DataFrame, least_share: float) -> DataFrame:
    """`length, context, symbol, n` of the root and of all retained contexts, from `key, n`."""
    key = F.col("key")
    split = grams.select(
        F.shiftright(key, 48).cast("int").alias("full"),
        F.shiftright(key, 8).bitwiseAND(F.lit((1 << 40) - 1)).alias("whole"),
        key.bitwiseAND(F.lit(255)).cast("int").alias("symbol"),
        "n",
    )
    one = F.lit(1).cast("long")
    mask = F.expr("shiftleft(1L, 8 * length) - 1L")
    counts = stage(
        split.select("whole", "symbol", "n", F.explode(F.sequence(F.lit(0), "full")).alias("length"))
        .select("length", F.col("whole").bitwiseAND(mask).alias("context"), "symbol", "n")
        .groupBy("length", "context", "symbol")
        .agg(F.sum("n").alias("n")),
        "contexts",
    )
    totals = counts.groupBy("length", "context").agg(
        F.sum("n").alias("total"), F.sum(one).alias("different")
    )
    positions = counts.where("length = 0").agg(F.sum("n")).first()[0] or 0
    candidates = totals.where(F.col("total") >= least_share * positions)
    frequent = stage(counts.join(candidates, ["length", "context"]), "frequent")
    shorter = frequent.select(
        (F.col("length") + 1).alias("length"),
        F.col("context").alias("shorter"),
        "symbol",
        (F.col("n") / F.col("total")).alias("chance"),
    )
    divergence = F.sum(F.col("n") * F.log(F.col("n") / F.col("total") / F.col("chance")))
    retained = (
        frequent.where("length > 0")
        .withColumn(
            "shorter", F.expr("context & (shiftleft(1L, 8 * (length - 1)) - 1L)")
        )
        .join(shorter, ["length", "shorter", "symbol"])
        .groupBy("length", "context")
        .agg(
            divergence.alias("gain"),
            F.first("different").alias("different"),
            F.first("total").alias("total"),
        )
        .where(F.col("gain") >= 0.5 * F.col("different") * F.log("total"))
        .select(F.col("context").alias("whole"), F.explode(F.sequence(F.lit(0), "length")).alias("length"))
        .select("length", F.col("whole").bitwiseAND(mask).alias("context"))
        .distinct()
    )
    root = frequent.where("length = 0").select("length", "context").distinct()
    states = stage(retained.union(root).distinct(), "states")
    return frequent.join(states, ["length", "context"]).select("length", "context", "symbol", "n")


def build_tree(counts: DataFrame, depth: int = DEPTH) -> SuffixTree:
    """The tree of `tree_counts`, whose rows the retained contexts bound."""
    table = counts.toArrow()
    length, context, symbol, n = (table.column(c).to_numpy() for c in counts.columns)
    seen = np.unique(symbol)
    codes = np.zeros(256, np.uint8)
    symbols = len(seen) + 1
    if len(seen) == 256:  # a byte that UTF-8 never uses stands for the unseen ones
        seen, symbols = seen[:-1], 256
    codes[seen] = np.arange(1, len(seen) + 1)
    keys = (length.astype(np.int64) << 40) | context
    states = np.unique(np.append(keys, 0))
    state = np.searchsorted(states, keys)
    size = len(states)
    table_counts = np.zeros((size, symbols))
    table_counts[state, codes[symbol]] = n
    total = table_counts.sum(1)
    different = (table_counts > 0).sum(1)
    lengths, contexts = states >> 40, states & ((1 << 40) - 1)
    up = np.searchsorted(
        states, ((lengths - 1) << 40) | (contexts & ((1 << (8 * np.maximum(lengths - 1, 0))) - 1))
    )
    moves = np.empty((2, size, symbols), np.int32)
    moves[0] = np.arange(size, 2 * size)[:, None]
    moves[1] = np.arange(size, 2 * size)[:, None]
    chances = np.empty((size, symbols))
    chances[0] = (table_counts[0] + 0.5) / (total[0] + 0.5 * 256)
    for level in range(1, depth + 1):
        here = np.flatnonzero(lengths == level)
        weight = different[here][:, None]
        chances[here] = (table_counts[here] + weight * chances[up[here]]) / (
            total[here][:, None] + weight
        )
        oldest = contexts[here] >> (8 * (level - 1))
        moves[0, up[here], codes[oldest]] = here
    logs = np.log10(chances).astype(np.float32)
    return SuffixTree(codes, moves.ravel(), logs.ravel(), symbols, depth)


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_common long, common_base double, "
    "common_score double, rare array<long>, tree_logs array<double>"
)


ESCAPE = 0.5  # the tree's part of a token's chance


def token_logs(model: SuffixTree, stream: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """log10 of each token's chance by the tree, in the order of the tokens' last symbols."""
    each = np.where(counted, model.score(stream), 0.0)
    last = np.flatnonzero(counted & ((stream == SEPARATOR) | (stream == END)))
    return np.add.reduceat(each, np.append(0, last[:-1] + 1)) if len(last) else np.zeros(0)


def _score_rows(
    rows: DataFrame, tree, common, tokens: int, escape: float, floor: float
) -> DataFrame:
    """Sums over common words, and log10 of the tree's chances of all other tokens with their hashes."""
    train_tokens = tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                yield scored(batch.slice(lo, ROWS))

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = len(batch)
        hashes, counts = common.value
        model = tree.value
        base, score = np.zeros(n), np.zeros(n)
        tokens, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
        rare = [(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64))]
        for stream, _, counted, words, rows in symbol_streams(batch.column("text"), model.depth):
            logs = token_logs(model, stream, counted)
            tokens += np.bincount(rows, minlength=n)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, words), len(hashes) - 1)
                hit = hashes[at] == words
                own, count = rows[hit], counts[at[hit]]
                known += np.bincount(own, minlength=n)
                base += np.bincount(own, np.log10(count + 1.0) - floor, n)
                mixed = escape * 10.0 ** logs[hit] + (1 - escape) * count / train_tokens
                score += np.bincount(own, np.log10(mixed), n)
                words, logs, rows = words[~hit], logs[~hit], rows[~hit]
            rare.append((words, logs, rows))
        words, logs, rows = map(np.concatenate, zip(*rare, strict=True))
        offsets = pa.array(np.searchsorted(rows, np.arange(n + 1)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("held_out"),
                pa.array(tokens),
                pa.array(known),
                pa.array(base),
                pa.array(score),
                pa.ListArray.from_arrays(offsets, pa.array(words.view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(logs)),
            ],
            names=[field.split()[0] for field in SCORED.split(", ")],
        )

    return rows.mapInArrow(run, SCORED)


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    modulus: int = 7,
    held_out: int = 2,
    depth: int = DEPTH,
    least_share: float = 1e-5,
    common_share: float = 1e-6,
) -> DataFrame:
    """`doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score` of every document."""
    spark = docs.sparkSession
    fold = remainder(F.col("doc_id"), modulus)
    rows = (
        pick(docs, doc_id=id_col, text=text_col)
        .withColumn("doc_id", F.col("doc_id").cast("long"))
        .select(
            "doc_id",
            F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce(fold == held_out, F.lit(False)).alias("held_out"),
        )
    )
    counts = stage(corpus_counts(rows.where(fold != held_out), depth), "counts")
    words = counts.where(F.col("kind") == WORDS).select("key", "n")
    size = words.agg(F.sum("n").alias("tokens"), F.count("n").alias("different")).first()
    tokens, different = size["tokens"] or 0, size["different"]
    escape = ESCAPE if tokens else 1.0
    # At most 1 / common_share words.
    often = words.where(F.col("n") >= max(1.0, common_share * tokens)).toArrow()
    hashes = often.column("key").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    common = hashes[order], often.column("n").to_numpy()[order]
    tree = build_tree(
        tree_counts(counts.where(F.col("kind") == GRAMS).select("key", "n"), least_share), depth
    )
    context = spark.sparkContext
    floor = float(np.log10(tokens + different + 1))
    scored = _score_rows(rows, context.broadcast(tree), context.broadcast(common), tokens, escape, floor)
    scored = stage(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    count = F.coalesce("n", F.lit(0)) + 1.0
    # A long word's chance is below all doubles, its logarithm is not.
    log = F.col("tree_logs")
    share = (1 - escape) * F.col("n") / float(max(tokens, 1))
    seen = F.log10(escape * F.pow(F.lit(10.0), log) + share)
    rare = (
        scored.select("row", F.explode(F.arrays_zip("rare", "tree_logs")).alias("word"))
        .select("row", F.col("word.rare").alias("key"), "word.tree_logs")
        .join(words, "key", "left")
        .groupBy("row")
        .agg(
            F.sum(F.log10(count)).alias("rare_base"),
            F.sum(F.when(F.col("n").isNull(), log + float(np.log10(escape))).otherwise(seen)).alias("rare_score"),
            F.count("n").alias("rare_known"),
            F.count("key").alias("rare_tokens"),
        )
    )
    none = F.lit(0.0)
    return scored.join(rare, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (
            F.col("common_base")
            + F.coalesce("rare_base", none)
            - F.coalesce("rare_tokens", F.lit(0)) * F.lit(floor)
        ).alias("base_score"),
        (F.col("common_score") + F.coalesce("rare_score", none)).alias("score"),
    )
