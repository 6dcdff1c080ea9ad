"""Value counts of codes and categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hackney.functions.columns import nan_as_null, present, required
from hackney.functions.labels import code_label
from hackney.schema import CATEGORICAL_COLUMNS, PAYMENT_LABELS, RATECODE_LABELS


def distribution(df: DataFrame, name: str) -> DataFrame:
    """Rows per value, most frequent first; null is a value."""
    counted = df.groupBy(name).agg(F.count(F.lit(1)).alias("trips"))
    return counted.orderBy(F.desc("trips"), F.asc_nulls_last(name))


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per value in the order of the values, missing (null or NaN) last."""
    counted = df.groupBy(nan_as_null(df, name).alias(name)).agg(F.count(F.lit(1)).alias("trips"))
    return counted.orderBy(F.asc_nulls_last(name))


def payment_counts_labelled(trips: DataFrame) -> DataFrame:
    label = code_label(F.col("payment_type"), PAYMENT_LABELS, missing="NaN (missing)")
    return value_counts(trips, "payment_type").select("payment_type", label.alias("label"), "trips")


def ratecode_counts_labelled(trips: DataFrame) -> DataFrame:
    name = required(trips, ["RatecodeID", "RateCodeID"])
    label = code_label(F.col(name), RATECODE_LABELS, missing="NaN")
    return value_counts(trips, name).select(name, label.alias("label"), "trips")


def categorical_value_counts(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL_COLUMNS, k: int = 20
) -> DataFrame:
    """The `k` most frequent values, missing included, of every listed column that exists.

    One scan serves all columns. Rows are counted before they are ranked, and each task keeps only
    its own `k` best per column before the ranking shuffles.
    """
    names = present(df, columns, at_least=1)
    texts = df.select([nan_as_null(df, name).cast("string").alias(name) for name in names])
    counted = (
        texts.unpivot([], names, "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    frequent = Window.partitionBy("column_name").orderBy(
        F.desc("trips"), F.asc_nulls_last("value")
    )
    return (
        counted.withColumn("rank", F.row_number().over(frequent))
        .where(F.col("rank") <= k)
        .orderBy("column_name", "rank")
    )
