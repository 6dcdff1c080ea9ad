"""One pass over a prepared table that answers many questions: totals by date and hour.

A rollup has at most 24 rows per date. Coverage, counts by hour and weekday, range checks and zone
coverage are read off it, so a report scans the table once for all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.functions.columns import percent, present
from hackney.functions.times import weekday_from_sunday
from hackney.operators.quality import range_conditions, zone_conditions

KEY = ["pickup_date", "pickup_hour"]


def date_hour_rollup(prepared: DataFrame) -> DataFrame:
    """Trips, sums and counts of the means' columns, and failures of every check that applies."""
    means = present(prepared, ["trip_distance", "total_amount"])
    checks = range_conditions(prepared) | zone_conditions(prepared)
    return prepared.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("trips"),
        *[F.sum(name).alias(f"{name}_sum") for name in means],
        *[F.count(name).alias(f"{name}_n") for name in means],
        *[F.sum(F.when(test, 1).otherwise(0)).alias(name) for name, test in checks.items()],
    )


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def _means(rollup: DataFrame, aliases: dict[str, str]) -> list[Column]:
    return [_mean(n).alias(a) for n, a in aliases.items() if f"{n}_sum" in rollup.columns]


def row_total(rollup: DataFrame, columns: int) -> DataFrame:
    rows = F.coalesce(F.sum("trips"), F.lit(0)).cast("long").alias("row_count")
    return rollup.agg(rows).withColumn("column_count", F.lit(columns))


def coverage(rollup: DataFrame) -> DataFrame:
    return rollup.agg(
        F.min("pickup_date").alias("min_date"),
        F.max("pickup_date").alias("max_date"),
        F.count_distinct("pickup_hour").alias("distinct_hours"),
    )


def first_hours(rollup: DataFrame, limit: int = 100) -> DataFrame:
    """The first `limit` date-hours with their trips and means."""
    means = {"trip_distance": "avg_distance_miles", "total_amount": "avg_total_amount"}
    return (
        rollup.groupBy(*KEY)
        .agg(F.sum("trips").alias("trips"), *_means(rollup, means))
        .orderBy(*[F.asc_nulls_last(name) for name in KEY])
        .limit(limit)
    )


def by_hour(rollup: DataFrame) -> DataFrame:
    means = {"total_amount": "avg_total_amount", "trip_distance": "avg_trip_distance"}
    return (
        rollup.groupBy("pickup_hour")
        .agg(F.sum("trips").alias("trips"), *_means(rollup, means))
        .orderBy(F.asc_nulls_last("pickup_hour"))
    )


def by_weekday(rollup: DataFrame) -> DataFrame:
    return (
        rollup.groupBy(weekday_from_sunday(F.col("pickup_date")).alias("dow"))
        .agg(F.sum("trips").alias("trips"), *_means(rollup, {"total_amount": "avg_total_amount"}))
        .orderBy(F.asc_nulls_last("dow"))
    )


def failures(rollup: DataFrame, names: list[str]) -> DataFrame:
    """How many trips fail each of the named checks; null for an empty table."""
    return rollup.agg(*[F.sum(name).alias(name) for name in names])


def failure_shares(rollup: DataFrame, names: list[str]) -> DataFrame:
    """Failures as counts and percent."""
    counts = rollup.agg(
        F.sum("trips").alias("rows"), *[F.sum(name).alias(name) for name in names]
    )
    shares = [percent(F.col(name), F.col("rows")).alias(f"{name}_pct") for name in names]
    return counts.select(*names, *shares)
