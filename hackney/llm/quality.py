"""Supervised subword embeddings for document quality.

A document is the average of the learned vectors of its features: words, pairs of neighbouring words
and character n-grams within words (with the white space beside them as border marks), all hashed into
`buckets` rows. A softmax layer over the average gives the score. Vectors and layer are trained by
stochastic gradient descent in NumPy on the driver, over a sample of labelled rows that `max_rows`
bounds; executors send hashed counts, so the driver never holds texts. The sample may hold the classes
in other shares than the labels do: the bias is that of the labels' shares, and the examples are weighted
by them, so a score means the same at every number of labels.

A pair of equal words is one feature whatever the word, so that repetition is seen in any language.

The layer is linear, so it and the vectors fold into one weight per feature; scoring averages these
weights over the whole text, in blocks, and shuffles nothing. The folded weights are the only thing
sent to the executors: `buckets` numbers, whatever the size of the data.

Defined results: a text without features, an empty or a null one scores by the layer's bias alone.
Without examples, every score is 0.5; with examples of one class, the bias follows that class. Null
and repeated ids are carried along, one row each. An empty table gives no rows. Other columns are not
read. A word pair that crosses a block border of a very long text is left out, in training as well.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.llm.common import SPACE, blocks, mix, pick, span_hashes, utf8_rows, word_spans
from hackney.llm.labelled import fold_labels, label_share, labelled_sample, remainder
from hackney.session import small_batches

GRAMS = (3, 4)
_MULTIPLIERS = np.array([0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0x9E3779B1], np.uint32)


@dataclass(frozen=True)
class QualityModel:
    """The folded weight of each feature, and the bias; `score = sigmoid(bias + mean weight)`."""

    weights: np.ndarray
    bias: float

    @property
    def unfitted(self) -> bool:
        """No example told the classes apart."""
        return not self.weights.any()


def features(
    data: np.ndarray, bounds: np.ndarray, buckets: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays of (bucket, row), one for each kind of feature; `buckets` is a power of two."""
    mask64, mask = np.uint64(buckets - 1), np.uint32(buckets - 1)
    starts, ends, rows = word_spans(data, bounds)
    hashes = span_hashes(data, starts, ends)
    yield (hashes & mask64).astype(np.int64), rows
    same_row = rows[1:] == rows[:-1]
    pairs = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
    pairs[hashes[1:] == hashes[:-1]] = np.uint64(0x5EED)
    yield (pairs[same_row] & mask64).astype(np.int64), rows[1:][same_row]
    space = SPACE[data]
    codes = np.where(space, np.uint32(32), data.astype(np.uint32)) + np.uint32(1)
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        value = np.full(m, n, np.uint32)
        fits = row_of[:m] == row_of[n - 1 :]
        for k in range(n):
            value += codes[k : k + m] * _MULTIPLIERS[k]
            if 0 < k < n - 1:
                fits &= ~space[k : k + m]
        value = value[fits]
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        value ^= value >> np.uint32(13)
        yield (value & mask).astype(np.int64), row_of[:m][fits]


def document_counts(column: pa.Array, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text, its distinct features and how often they occur; counted block by block, as a key
    for each of its features takes many times a text's memory."""
    data, bounds = utf8_rows(column)
    counted = []
    # The blocks of a long text follow each other under its row; others hold whole rows.
    for _, parts in groupby(blocks(data, bounds), key=lambda b: b[0]):
        keys = []
        for _, part, inner in parts:
            rows = len(inner) - 1
            for bucket, row in features(part, inner, buckets):
                keys.append(row * buckets + bucket)
        found, counts = np.unique(np.concatenate(keys), return_counts=True)
        cuts = np.searchsorted(found, np.arange(rows + 1) * buckets)
        counted += [
            (found[a:b] % buckets, counts[a:b].astype(np.float32))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
    return counted


def train(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    buckets: int,
    size: int,
    epochs: int,
    rate: float,
    seed: int,
    prior: float | None = None,
) -> QualityModel:
    """Stochastic gradient descent on the cross entropy of a two-class softmax.

    `prior` is the share of label 1 in the corpus, by default that of the examples.
    """
    positives = sum(label for _, _, label in examples)
    if prior is None:
        prior = (positives + 0.5) / (len(examples) + 1)
    bias = np.zeros(2)
    bias[1] = np.log(prior / (1 - prior))
    # Classes are bounded each for the sample; these weights bring the corpus's shares back.
    importance = np.ones(2)
    if 0 < positives < len(examples):
        share = (positives + 0.5) / (len(examples) + 1)
        importance = np.array([(1 - prior) / (1 - share), prior / share])
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / size, 1 / size, (buckets, size)).astype(np.float32)
    layer = np.zeros((2, size), np.float32)
    steps, total = 0, epochs * max(1, len(examples))
    for _ in range(epochs):
        for k in draw.permutation(len(examples)):
            bucket, counts, label = examples[k]
            if not len(bucket):
                continue
            step = rate * (1 - steps / total)
            steps += 1
            share = counts / counts.sum()
            mean = share @ vectors[bucket]
            logits = layer @ mean + bias
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[label] -= 1
            chance *= importance[label]
            slope = chance.astype(np.float32) @ layer
            layer -= np.float32(step) * np.outer(chance, mean).astype(np.float32)
            vectors[bucket] -= np.float32(step) * np.outer(share, slope)
    weights = vectors @ (layer[1] - layer[0])
    return QualityModel(weights.astype(np.float32), float(bias[1] - bias[0]))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    modulus: int = 4,
    held_out: int = 2,
    max_rows: int = 3000,
    buckets: int = 1 << 17,
    size: int = 16,
    epochs: int = 12,
    rate: float = 1.0,
    seed: int = 42,
) -> QualityModel:
    """The model of at most `max_rows` labelled rows outside the held-out fold."""
    marks = fold_labels(docs, labels, label_col, modulus, held_out)
    sample = labelled_sample(docs, labels, label_col, modulus, held_out, max_rows, marks=marks)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = document_counts(batch.column("text"), buckets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    pa.array([b.astype("<u4").tobytes() for b, _ in found], pa.binary()),
                    pa.array([c.astype("<f4").tobytes() for _, c in found], pa.binary()),
                ],
                names=["label", "buckets", "counts"],
            )

    with small_batches(docs.sparkSession):
        rows = sample.mapInArrow(count, "label int, buckets binary, counts binary").toArrow()
    examples = [
        (np.frombuffer(b, "<u4"), np.frombuffer(c, "<f4"), label)
        for label, b, c in zip(*(rows.column(i).to_pylist() for i in range(3)), strict=True)
    ]
    # Collected order may vary, the sample does not.
    examples.sort(key=lambda e: (e[2], len(e[0]), e[0].tobytes(), e[1].tobytes()))
    return train(examples, buckets, size, epochs, rate, seed, label_share(marks))


def score_column(column: pa.Array, model: QualityModel) -> np.ndarray:
    data, bounds = utf8_rows(column)
    n = len(column)
    sums, counts = np.zeros(n), np.zeros(n)
    for first, part, inner in blocks(data, bounds):
        rows = len(inner) - 1
        for bucket, row in features(part, inner, len(model.weights)):
            sums[first : first + rows] += np.bincount(row, model.weights[bucket], rows)
            counts[first : first + rows] += np.bincount(row, minlength=rows)
    logit = model.bias + sums / np.maximum(counts, 1)
    return 1 / (1 + np.exp(-logit))


def score(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text"
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
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, modulus: int = 4, held_out: int = 2
) -> DataFrame:
    """`doc_id, held_out, score, predicted` of every document."""
    scored = score(docs, fit(docs, labels, modulus=modulus, held_out=held_out))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), modulus) == held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
