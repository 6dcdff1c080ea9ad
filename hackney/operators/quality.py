"""Checks of completeness, ranges, duplicates and zone coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.functions.columns import (
    TIMESTAMP_TYPES,
    nan_as_null,
    of_type,
    percent,
    present,
    rows_of,
)
from hackney.schema import PREPARED_KEY, RAW_KEY
from hackney.session import stage


def column_facts(df: DataFrame) -> DataFrame:
    """One row: the rows (`0`) and, per column position from 1, the values that are present, and the
    least value of each timestamp.

    The functions below take it as `facts`, so that a report computes it once for all of them.
    """
    counts = [F.count(F.lit(1)).alias("0")]
    counts += [F.count(nan_as_null(df, name)).alias(str(i)) for i, name in enumerate(df.columns, 1)]
    least = [F.min(name).alias(f"min_{name}") for name in of_type(df, TIMESTAMP_TYPES)]
    return df.agg(*counts, *least)


def row_count(df: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Rows and columns."""
    rows = df.agg(F.count(F.lit(1)).alias("0")) if facts is None else facts
    return rows.select(F.col("0").alias("row_count"), F.lit(len(df.columns)).alias("column_count"))


def column_inventory(df: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Position, name, type and number of present values of every column."""
    described = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col(str(i)).alias("non_null_count"),
        )
        for i, field in enumerate(df.schema, 1)
    ]
    return rows_of(column_facts(df) if facts is None else facts, described)


def missing_summary(df: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Missing values (null or NaN) per column, as count and percent, most first."""
    rows = F.col("0")
    per_column = [
        F.struct(
            F.lit(name).alias("column_name"),
            (rows - F.col(str(i))).alias("null_count"),
            percent(rows - F.col(str(i)), rows).alias("null_pct"),
        )
        for i, name in enumerate(df.columns, 1)
    ]
    seen = column_facts(df) if facts is None else facts
    return rows_of(seen, per_column).orderBy(F.desc("null_count"), "column_name")


def nonpositive_distance(trips: DataFrame) -> DataFrame:
    return trips.where(F.col("trip_distance") <= 0)


def problem_fares(
    trips: DataFrame, columns: Sequence[str] = ("fare_amount", "total_amount")
) -> DataFrame:
    """Values that are zero or negative, tagged with their column, from one scan.

    A trip counts once for each column it fails; the other columns of its row are null.
    """
    names = present(trips, columns, at_least=1)

    def tagged(name: str) -> Column:
        fields = [
            (F.col(n) if n == name else F.lit(None).cast(trips.schema[n].dataType)).alias(n)
            for n in names
        ]
        row = F.struct(fields[0], F.lit(name).alias("problem_col"), *fields[1:])
        return F.when(F.col(name) <= 0, row)

    failing = F.array_compact(F.array(*[tagged(name) for name in names]))
    return trips.select(F.inline(failing))


def min_dates(
    df: DataFrame, suffix: str = "_datetime", facts: DataFrame | None = None
) -> DataFrame:
    """The first date of every timestamp column whose name ends with `suffix`.

    Without such a column the result has no columns and no rows.
    """
    names = [name for name in of_type(df, TIMESTAMP_TYPES) if name.endswith(suffix)]
    if not names:
        return df.sparkSession.range(0).select()
    least = df.agg(*[F.min(n).alias(f"min_{n}") for n in names]) if facts is None else facts
    return least.select(*[F.to_date(f"min_{name}").alias(f"min_{name}") for name in names])


def _key_hash(key: Sequence[str]) -> Column:
    # Hashing skips nulls, so which parts are missing is hashed as well.
    return F.xxhash64(*[part for name in key for part in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())])


def _hash_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows per key hash that repeats, and under null those of all hashes that do not."""
    counted = df.select(_key_hash(key).alias("key_hash")).groupBy("key_hash").agg(F.count("*").alias("n"))
    repeated = F.when(F.col("n") > 1, F.col("key_hash")).alias("key_hash")
    return counted.groupBy(repeated).agg(F.sum("n").alias("n"))


def _key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """`rows_total` and `distinct_trip_keys`: rows, and distinct keys; missing parts compare equal.

    At first only a hash per row is shuffled, and equal ones are counted before that. A hash that occurs
    once proves its key to be the only one of its kind; the keys of the other rows alone are compared in
    full, so a collision never counts as a repeat. The list of repeated hashes is written out to give the
    planner its true size: Spark broadcasts it when small and joins by shuffle if not.
    """
    counts = stage(_hash_counts(df, key), "hash-counts")
    repeated = counts.where(F.col("key_hash").isNotNull()).select("key_hash")
    keys = df.select(*[F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(key)], _key_hash(key).alias("key_hash"))
    compared = (
        keys.join(repeated, "key_hash", "left_semi")
        .groupBy(*[f"k{i}" for i in range(len(key))])
        .agg(F.count("*").alias("n"))
    )
    zero = F.lit(0).cast("long")
    parts = counts.select(F.col("n").alias("rows"), zero.alias("repeats")).unionAll(
        compared.select(zero, F.col("n") - 1)
    )
    rows, repeats = (F.coalesce(F.sum(name), zero) for name in ("rows", "repeats"))
    return parts.agg(rows.alias("rows_total"), (rows - repeats).alias("distinct_trip_keys"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one in all columns; missing values compare equal."""
    repeats = F.col("rows_total") - F.col("distinct_trip_keys")
    return _key_counts(df, df.columns).select(repeats.alias("duplicate_rows"))


def raw_key_duplicates(trips: DataFrame) -> DataFrame:
    """Rows that repeat an earlier one in the key columns that exist."""
    counts = _key_counts(trips, present(trips, RAW_KEY, at_least=1))
    repeats = F.col("rows_total") - F.col("distinct_trip_keys")
    return counts.select(repeats.alias("duplicate_rows"))


def natural_key_duplicates(prepared: DataFrame) -> DataFrame:
    """Rows, distinct trip keys and their difference; at least four key columns must exist."""
    counts = _key_counts(prepared, present(prepared, PREPARED_KEY, at_least=4))
    repeats = F.col("rows_total") - F.col("distinct_trip_keys")
    return counts.withColumn("estimated_duplicates", repeats)


def _failing(condition: Column) -> Column:
    """Rows that meet the condition; null for an empty table."""
    return F.sum(F.when(condition, 1).otherwise(0))


def range_conditions(prepared: DataFrame) -> dict[str, Column]:
    """What puts a trip outside the reasonable range of a metric, for the metrics that exist."""
    distance, amount = F.col("trip_distance"), F.col("total_amount")
    minutes, speed = F.col("trip_duration_min"), F.col("avg_mph")
    tests = {
        "trip_distance": {
            "trip_distance_negative": distance < 0,
            "trip_distance_gt_100": distance > 100,
        },
        "total_amount": {
            "total_amount_negative": amount < 0,
            "total_amount_gt_500": amount > 500,
        },
        "trip_duration_min": {"duration_le_0": minutes <= 0, "duration_gt_300": minutes > 300},
        "avg_mph": {"avg_mph_gt_90": speed > 90, "avg_mph_negative": speed < 0},
    }
    return {k: v for name in present(prepared, tests) for k, v in tests[name].items()}


def range_checks(prepared: DataFrame) -> DataFrame:
    """How many trips lie outside the reasonable range of each metric."""
    checks = range_conditions(prepared)
    return prepared.agg(*[_failing(test).alias(name) for name, test in checks.items()])


def zone_conditions(prepared: DataFrame) -> dict[str, Column]:
    """A trip without a pickup or dropoff zone or borough, for the columns that exist."""
    names = [f"{role}_{name}" for name in ["Zone", "Borough"] for role in ["PU", "DO"]]
    return {f"{n.lower()}_missing": F.col(n).isNull() for n in present(prepared, names)}


def zone_coverage(prepared: DataFrame) -> DataFrame:
    """Trips without a pickup or dropoff zone or borough, as counts and percent."""
    checked = zone_conditions(prepared)
    counts = prepared.agg(
        F.count(F.lit(1)).alias("rows"),
        *[_failing(condition).alias(name) for name, condition in checked.items()],
    )
    shares = [percent(F.col(name), F.col("rows")).alias(f"{name}_pct") for name in checked]
    return counts.select(*checked, *shares)
