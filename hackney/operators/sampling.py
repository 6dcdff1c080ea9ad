"""Looking at some rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """Any `n` rows."""
    return df.limit(n)


def sample_rows(df: DataFrame, n: int = 5_000, seed: int = 42) -> DataFrame:
    """Exactly `n` random rows, or all of a smaller table.

    The sample is the `n` rows with the lowest random numbers. Numbers that `n` rows will undercut but
    for a deviation of ten sigma are dropped in the scan, so the final task gets little more than `n`
    rows from however many partitions. Should fewer pass after all, nothing is dropped.
    """
    rows = df.count()
    passing = n + 10 * math.sqrt(n) + 100
    drawn = df.withColumn("draw", F.rand(seed))
    if rows > passing:
        low = drawn.where(F.col("draw") < passing / rows)
        if low.count() >= n:
            drawn = low
    return drawn.orderBy("draw").limit(n).drop("draw")
