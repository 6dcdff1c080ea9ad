"""Factorization machine over hashed terms for toxicity.

The terms of a document are its words (runs of bytes outside white space and ASCII punctuation, A-Z
lower-cased) and the first `PREFIXES` bytes of longer words, hashed to 64 bits; a term is present or
not. The machine's score is

    bias + sum of weights of the terms present + sum over pairs of terms of the product of their vectors

so a pair, such as an insult beside the name of a group, can count for more than its two weights. It is
trained by gradient descent with per-parameter rates in NumPy on the driver, over a sample of labelled
rows that `max_rows` bounds. Terms take part whose occurrence differs between the classes by a likelihood
ratio test, alone or together with another term: the second test compares a pair with the better of its
two terms, so terms that tell nothing by themselves are found by the company they make. Equal texts count
once. Executors send term hashes and get the terms' parameters: both are bounded by the sample, whatever
the size of the data.

Defined results: a text without such terms, an empty or a null one scores by the bias alone. Without
examples, every score is 0.5; with examples of one class, the bias follows that class. Null and
repeated ids are carried along, one row each. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.llm.common import LOWER, SPACE, blocks, pick, span_hashes, utf8_rows, word_spans
from hackney.llm.labelled import fold_labels, label_share, labelled_sample, remainder

PREFIXES = (4, 5, 6)
FILTER_BITS = 20
NOT_WORD = SPACE.copy()
NOT_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


@dataclass(frozen=True)
class FactorizationMachine:
    """Sorted term hashes with a weight and a vector each."""

    terms: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    bias: float

    @property
    def unfitted(self) -> bool:
        """No term told the classes apart."""
        return not len(self.terms)

    def scores(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Chances of `n` documents, from distinct (row, index of term) pairs."""
        linear = np.bincount(rows, self.weights[terms], n)
        pairs = np.zeros(n)
        for k in range(self.vectors.shape[1]):
            v = self.vectors[terms, k]
            pairs += np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + pairs / 2, -500, 500)))


def term_hashes(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays of (hash, row): whole words, then prefixes."""
    low = LOWER[data]
    starts, ends, rows = word_spans(low, bounds, NOT_WORD)
    yield span_hashes(low, starts, ends), rows
    for n in PREFIXES:
        longer = ends - starts > n
        begin = starts[longer]
        yield span_hashes(low, begin, begin + n) ^ np.uint64(n), rows[longer]


def document_terms(column: pa.Array) -> list[np.ndarray]:
    """The distinct term hashes of each text."""
    data, bounds = utf8_rows(column)
    parts: list[list[np.ndarray]] = [[] for _ in range(len(column))]
    for first, part, inner in blocks(data, bounds):
        found = list(term_hashes(part, inner))
        hashes = np.concatenate([h for h, _ in found])
        rows = np.concatenate([r for _, r in found])
        order = np.argsort(rows, kind="stable")
        hashes = hashes[order]
        cuts = np.searchsorted(rows[order], np.arange(len(inner)))
        for k in range(len(inner) - 1):
            parts[first + k].append(np.unique(hashes[cuts[k] : cuts[k + 1]]))
    return [np.unique(np.concatenate(p)) if p else np.zeros(0, np.uint64) for p in parts]


def likelihood_ratio(with_toxic, with_clean, toxic: int, clean: int) -> np.ndarray:
    """The G statistic of a term's presence against the classes."""

    def part(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / expected), 0.0)

    total = toxic + clean
    present = with_toxic + with_clean
    absent = total - present
    return 2 * (
        part(with_toxic, present * toxic / total)
        + part(with_clean, present * clean / total)
        + part(toxic - with_toxic, np.maximum(absent * toxic / total, 1e-9))
        + part(clean - with_clean, np.maximum(absent * clean / total, 1e-9))
    )


def telling_pairs(
    rows: np.ndarray, terms: np.ndarray, labels: np.ndarray, ratio: np.ndarray, least_gain: float
) -> np.ndarray:
    """Terms that together with another one mark label 1 by `least_gain` better than either alone.

    `rows` and `terms` are the distinct pairs of example and term; `ratio` has the test of each term. All
    pairs are counted by products of incidence matrices, of terms frequent enough for the test.
    """
    toxic = labels == 1
    n_toxic, n_clean = int(toxic.sum()), int((~toxic).sum())
    counts = np.arange(1, n_toxic + 1)
    enough = np.flatnonzero(likelihood_ratio(counts, 0 * counts, n_toxic, n_clean) >= least_gain)
    if not len(enough):
        return np.zeros(0, np.int64)
    least = counts[enough[0]]
    often = np.flatnonzero(np.bincount(terms, labels[rows], len(ratio)) >= least)
    number = np.full(len(ratio), -1)
    number[often] = np.arange(len(often))
    use = number[terms] >= 0
    place = np.cumsum(toxic) - 1, np.cumsum(~toxic) - 1
    presence = []  # of terms in examples, of either class; a byte each
    for mine, size, at in ((toxic, n_toxic, place[0]), (~toxic, n_clean, place[1])):
        here = use & mine[rows]
        presence.append(np.zeros((size, len(often)), np.uint8))
        presence[-1][at[rows[here]], number[terms[here]]] = 1
    found = np.zeros(len(often), bool)
    tile = 1024
    for a in range(0, len(often), tile):
        for b in range(a, len(often), tile):
            in_both, not_toxic = (
                p[:, a : a + tile].astype(np.float32).T @ p[:, b : b + tile].astype(np.float32) for p in presence
            )
            one, other = np.nonzero(in_both >= least)
            one, other = one[a + one < b + other], other[a + one < b + other]
            both, clean = in_both[one, other].astype(float), not_toxic[one, other].astype(float)
            one, other = often[a + one], often[b + other]
            gain = likelihood_ratio(both, clean, n_toxic, n_clean) - np.maximum(ratio[one], ratio[other])
            good = (gain >= least_gain) & (both * n_clean > clean * n_toxic)
            found[number[one[good]]] = True
            found[number[other[good]]] = True
    return often[found]


def train(
    examples: list[tuple[np.ndarray, int]],
    prior: float | None = None,
    size: int = 4,
    epochs: int = 60,
    rate: float = 0.3,
    decay: float = 1e-4,
    least_ratio: float = 14.0,
    least_gain: float = 40.0,
    batch: int = 32,
    seed: int = 7,
) -> FactorizationMachine:
    """Fit to (distinct term hashes, label) examples; `prior` is the share of label 1 in the corpus."""
    n = len(examples)
    labels = np.array([label for _, label in examples], float)
    toxic, clean = int(labels.sum()), int(n - labels.sum())
    if prior is None:
        prior = (toxic + 0.5) / (n + 1)
    bias = float(np.log(prior / (1 - prior)))
    none = np.zeros(0)
    if not toxic or not clean:
        return FactorizationMachine(none.astype(np.uint64), none, np.zeros((0, size)), bias)
    hashes = np.concatenate([h for h, _ in examples])
    rows = np.repeat(np.arange(n), [len(h) for h, _ in examples])
    terms, index = np.unique(hashes, return_inverse=True)
    with_toxic = np.bincount(index, labels[rows], len(terms))
    with_clean = np.bincount(index, minlength=len(terms)) - with_toxic
    ratio = likelihood_ratio(with_toxic, with_clean, toxic, clean)
    pairs = telling_pairs(rows, index, labels, ratio, least_gain)
    good = np.union1d(np.flatnonzero(ratio >= least_ratio), pairs)
    number = np.full(len(terms), -1)
    number[good] = np.arange(len(good))
    kept = number[index]
    use = kept >= 0
    by_row = np.split(kept[use], np.searchsorted(rows[use], np.arange(1, n)))

    draw = np.random.default_rng(seed)
    k = len(good)
    weights, vectors = np.zeros(k), draw.normal(0, 0.01, (k, size))
    sums_w, sums_v, sum_b = np.full(k, 1e-6), np.full((k, size), 1e-6), 1e-6
    # Classes are drawn evenly for the sample; the examples' weights bring the corpus's share back.
    importance = np.where(labels == 1, prior / (toxic / n), (1 - prior) / (clean / n))
    for _ in range(epochs):
        order = draw.permutation(n)
        for lo in range(0, n, batch):
            chosen = order[lo : lo + batch]
            term = np.concatenate([by_row[i] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(by_row[i]) for i in chosen])
            sums = np.zeros((len(chosen), size))
            np.add.at(sums, row, vectors[term])
            squares = np.bincount(row, (vectors[term] ** 2).sum(1), len(chosen))
            raw = bias + np.bincount(row, weights[term], len(chosen))
            raw += ((sums**2).sum(1) - squares) / 2
            chance = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            error = (chance - labels[chosen]) * importance[chosen]
            used, where = np.unique(term, return_inverse=True)
            slope_w = np.bincount(where, error[row], len(used)) + decay * weights[used]
            slope_v = np.zeros((len(used), size))
            np.add.at(slope_v, where, error[row, None] * (sums[row] - vectors[term]))
            slope_v += decay * vectors[used]
            sums_w[used] += slope_w**2
            sums_v[used] += slope_v**2
            weights[used] -= rate * slope_w / np.sqrt(sums_w[used])
            vectors[used] -= rate / 4 * slope_v / np.sqrt(sums_v[used])
            slope_b = error.sum()
            sum_b += slope_b**2
            bias -= rate * slope_b / np.sqrt(sum_b)
    return FactorizationMachine(terms[good], weights, vectors, float(bias))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    modulus: int = 5,
    held_out: int = 0,
    max_rows: int = 3000,
) -> FactorizationMachine:
    """The machine of at most `max_rows` labelled rows outside the held-out fold."""
    marks = fold_labels(docs, labels, label_col, modulus, held_out)
    sample = labelled_sample(docs, labels, label_col, modulus, held_out, max_rows, marks=marks)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = document_terms(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([h.tobytes() for h in found], pa.binary())],
                names=["label", "terms"],
            )

    rows = sample.mapInArrow(gather, "label int, terms binary").toArrow()
    # Equal texts count once, in an order of their own.
    distinct = sorted(
        set(zip(rows.column(1).to_pylist(), rows.column(0).to_pylist(), strict=True))
    )
    return train([(np.frombuffer(h, np.uint64), label) for h, label in distinct], label_share(marks))


def score_column(column: pa.Array, model: FactorizationMachine) -> np.ndarray:
    data, bounds = utf8_rows(column)
    k = len(model.terms)
    if k == 0:
        return model.scores(np.zeros(0, int), np.zeros(0, int), len(column))
    low_bits = np.uint64((1 << FILTER_BITS) - 1)
    maybe = np.zeros(1 << FILTER_BITS, bool)
    maybe[model.terms & low_bits] = True
    hits = [np.zeros(0, np.int64)]
    for first, part, inner in blocks(data, bounds):
        for hashes, rows in term_hashes(part, inner):
            some = np.flatnonzero(maybe[hashes & low_bits])
            found = np.minimum(np.searchsorted(model.terms, hashes[some]), k - 1)
            exact = model.terms[found] == hashes[some]
            hits.append(np.unique((rows[some][exact] + first) * k + found[exact]))
    keys = np.unique(np.concatenate(hits))
    return model.scores(keys // k, keys % k, len(column))


def score(
    docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`doc_id`, `score`: one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score_column(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, "doc_id long, score double")


def rows_with_score(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """`row`, a struct of all columns of `docs`, and the `score` of its text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"))
    at = [name.lower() for name in docs.columns].index(text_col.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # The text is read from its row, so that it goes to Python once.
            scores = score_column(batch.column("row").field(at), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(scores, pa.float64())], names=["row", "score"]
            )

    kind = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, kind)


def classify(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, modulus: int = 5, held_out: int = 0
) -> DataFrame:
    """`doc_id, held_out, score, predicted` of every document."""
    scored = score(docs, fit(docs, labels, modulus=modulus, held_out=held_out))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
