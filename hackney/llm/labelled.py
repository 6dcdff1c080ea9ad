"""A bounded sample of labelled documents, for classifiers that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import pick
from hackney.session import stage


def remainder(id_column, modulus: int):
    """crc32 of the id as text, modulo `modulus`; null for a null id."""
    return F.crc32(id_column.cast("string")) % modulus


def fold_labels(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    modulus: int,
    held_out: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`doc_id, label` outside the held-out fold of ids whose documents have text, one row for each.

    An id that is labelled several times counts once, with its least label. Labels other than 0 and 1,
    null ids and null texts are no examples.
    """
    marks = (
        pick(labels, doc_id=id_col, label=label_col)
        .where(F.col("label").isin(0, 1) & (remainder(F.col("doc_id"), modulus) != held_out))
        .groupBy("doc_id")
        .agg(F.min("label").cast("int").alias("label"))
    )
    usable = pick(docs, doc_id=id_col, text=text_col).where(F.col("text").isNotNull())
    return stage(marks.join(usable.select("doc_id").distinct(), "doc_id", "left_semi"), "fold-labels")


def label_share(marks: DataFrame) -> float:
    """The share of label 1 in `fold_labels`, smoothed so that it is never 0 or 1."""
    row = marks.agg(F.sum("label").alias("ones"), F.count("label").alias("all")).first()
    return ((row["ones"] or 0) + 0.5) / (row["all"] + 1)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    modulus: int,
    held_out: int,
    max_rows: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    marks: DataFrame | None = None,
) -> DataFrame:
    """At most `max_rows` rows `text, label` outside the held-out fold, in a fixed random order.

    Each class gives half of them at most, and both are drawn by a hash of the id, so the sample does
    not depend on partitions. `marks` are the `fold_labels`, if they are at hand.
    """
    if marks is None:
        marks = fold_labels(docs, labels, label_col, modulus, held_out, id_col, text_col)
    half = max_rows // 2
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit(label_col))
    chosen = [
        marks.where(F.col("label") == label).orderBy(order, "doc_id").limit(half)
        for label in (0, 1)
    ]
    # Bounded by max_rows rows of an id and a label.
    few = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = pick(docs, doc_id=id_col, text=text_col).where(F.col("text").isNotNull())
    # The second limit bounds ids that many documents share.
    return (
        rows.join(few, "doc_id")
        .withColumn("order", F.xxhash64(F.col("doc_id").cast("string"), "text"))
        .orderBy("order")
        .limit(max_rows)
        .select("text", "label")
    )
