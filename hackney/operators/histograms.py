"""Equal-width histograms of whole columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.functions.columns import nan_as_null


def _range(low: float | None, high: float | None) -> tuple[float, float]:
    """The histogram range of a column with these extremes."""
    if low is None or high is None:
        return 0.0, 1.0
    if math.isinf(low) or math.isinf(high):
        raise ValueError(f"cannot divide the range [{low}, {high}] into bins")
    return (low - 0.5, high + 0.5) if low == high else (low, high)


def _bin_of(value: Column, low: float, high: float, bins: int) -> Column:
    """The bin whose edges enclose the value; the last bin includes its upper edge."""
    width = (high - low) / bins

    def edge(i: Column) -> Column:
        return F.lit(low) + i * F.lit(width)

    guess = F.least(
        F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(bins))).cast("int"),
        F.lit(bins - 1),
    )
    # The division may round across an edge, so the edges decide. `least` skips nulls, hence the
    # first branch.
    return (
        F.when(value.isNull(), F.lit(None))
        .when(value < edge(guess), guess - 1)
        .when((guess < bins - 1) & (value >= edge(guess + 1)), guess + 1)
        .otherwise(guess)
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 100) -> DataFrame:
    """`column_name, bin, center, count` for every bin of every column, empty ones included.

    Bins share the range from the least to the greatest value; missing values are left out. One
    pass finds the ranges and one counts, however many columns there are.
    """
    values = df.select(*[nan_as_null(df, name).cast("double").alias(name) for name in columns])
    extremes = values.agg(
        *[F.min(name).alias(f"{name} low") for name in columns],
        *[F.max(name).alias(f"{name} high") for name in columns],
    ).first()
    ranges = [_range(extremes[f"{name} low"], extremes[f"{name} high"]) for name in columns]

    numbered = values.select(
        *[
            _bin_of(F.col(name), low, high, bins).alias(name)
            for name, (low, high) in zip(columns, ranges)
        ]
    )
    counted = (
        numbered.unpivot([], list(columns), "column_name", "bin")
        .where(F.col("bin").isNotNull())
        .groupBy("column_name", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def of_column(items: Sequence[object]) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in items]), F.floor("id").cast("int") + 1)

    spine = df.sparkSession.range(0, len(columns) * bins, 1, 1)
    position = spine.select(
        (F.col("id") / bins).alias("id"), (F.col("id") % bins).cast("int").alias("bin")
    )
    width = of_column([(high - low) / bins for low, high in ranges])
    every_bin = position.select(
        of_column(list(columns)).alias("column_name"),
        "bin",
        (of_column([low for low, _ in ranges]) + (F.col("bin") + 0.5) * width).alias("center"),
    )
    # At most one row per bin exists, so the broadcast side is bounded whatever the input.
    return (
        every_bin.join(F.broadcast(counted), ["column_name", "bin"], "left")
        .withColumn("count", F.coalesce("n", F.lit(0).cast("long")))
        .select("column_name", "bin", "center", "count")
        .orderBy("column_name", "bin")
    )
