"""The two standing reports, as named DataFrames and as one long table.

Both read their input several times, so give them stored tables: the landed month and the published
table. Questions that one aggregate answers share it: what is known of each column of the raw month, and
the totals by date and hour of the prepared one. Building a report runs these aggregates and the passes
that find ranges and quantile brackets.

Months drift: a section whose columns are absent is left out, as are columns that a section could do
without.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.functions.columns import NUMERIC_TYPES, ensure_timestamps, of_type, present
from hackney.functions.times import fractional_minutes_between
from hackney.operators import demand, describe, distributions, histograms, quality, quantiles
from hackney.operators import rollup as rollups
from hackney.operators import sampling, zones as zone_operators
from hackney.schema import (
    CATEGORICAL_COLUMNS,
    DROPOFF,
    METRIC_COLUMNS,
    PICKUP,
    PREPARED_KEY,
    RAW_KEY,
)
from hackney.session import stage

Report = dict[str, DataFrame]


def raw_profile(trips: DataFrame, zones: DataFrame) -> Report:
    """What a raw month looks like: structure, gaps, problems, distributions, hours and zones."""
    trips = ensure_timestamps(trips, [PICKUP, DROPOFF])
    facts = stage(quality.column_facts(trips), "facts")

    def has(*names: str) -> bool:
        return len(present(trips, names)) == len(names)

    # Durations are described with the columns: one search for quartiles serves all.
    duration = "trip_duration_min"
    shared = has(PICKUP, DROPOFF) and duration not in trips.columns
    of_duration = F.col("column_name") == duration
    if shared:
        minutes = fractional_minutes_between(F.col(PICKUP), F.col(DROPOFF))
        described = stage(describe.describe_numeric(trips.withColumn(duration, minutes)), "described")
    else:
        described = describe.describe_numeric(trips)

    report = {
        "row_count": quality.row_count(trips, facts),
        "column_inventory": quality.column_inventory(trips, facts),
        "missing_summary": quality.missing_summary(trips, facts),
        "min_dates": quality.min_dates(trips, facts=facts),
        "describe_numeric": described.where(~of_duration) if shared else described,
        "describe_timestamps": describe.describe_timestamps(trips),
        "describe_categorical": describe.describe_categorical(trips),
        "duplicate_rows": quality.duplicate_rows(trips),
    }
    if present(trips, CATEGORICAL_COLUMNS):
        report["categorical_value_counts"] = distributions.categorical_value_counts(trips)
    if has("trip_distance"):
        report["nonpositive_distance"] = quality.nonpositive_distance(trips)
    if present(trips, ["fare_amount", "total_amount"]):
        report["problem_fares"] = quality.problem_fares(trips)
    if present(trips, RAW_KEY):
        report["raw_key_duplicates"] = quality.raw_key_duplicates(trips)
    if shared:
        report["describe_duration"] = described.where(of_duration)
    elif has(PICKUP, DROPOFF):
        report["describe_duration"] = describe.describe_duration(trips)
    if amounts := present(trips, ["total_amount", "tip_amount"]):
        report["histograms"] = histograms.histogram(trips, amounts, bins=100)
    if has("passenger_count"):
        report["passenger_counts"] = distributions.value_counts(trips, "passenger_count")
    if has("payment_type"):
        report["payment_counts"] = distributions.payment_counts_labelled(trips)
    if present(trips, ["RatecodeID", "RateCodeID"]):
        report["ratecode_counts"] = distributions.ratecode_counts_labelled(trips)
    if has(PICKUP):
        report["trips_by_hour"] = demand.raw_trips_by_hour(trips)
    if has(PICKUP, "total_amount"):
        report["mean_amount_by_hour"] = demand.hourly_mean_filled(trips)
    if has("PULocationID", "DOLocationID"):
        report["top_zones"] = zone_operators.top_zones_labelled(trips, zones)
    return report


def validate(prepared: DataFrame) -> Report:
    """Whether a prepared month is complete and plausible, and its demand patterns."""
    metrics = present(prepared, METRIC_COLUMNS)
    rows = sampling.preview(prepared)
    report = {
        "preview": rows,
        "describe_preview": describe.describe_numeric(stage(rows, "preview")),
        "column_inventory": quality.column_inventory(prepared),
    }
    if len(present(prepared, rollups.KEY)) == len(rollups.KEY):
        rollup = stage(rollups.date_hour_rollup(prepared), "rollup")
        checks = list(quality.range_conditions(prepared))
        missing = list(quality.zone_conditions(prepared))
        report |= {
            "row_count": rollups.row_total(rollup, len(prepared.columns)),
            "temporal_coverage": rollups.coverage(rollup),
            "hourly_by_date": rollups.first_hours(rollup),
            "trips_by_hour": rollups.by_hour(rollup),
            "trips_by_weekday": rollups.by_weekday(rollup),
        }
        if checks:
            report["range_checks"] = rollups.failures(rollup, checks)
        if missing:
            report["zone_coverage"] = rollups.failure_shares(rollup, missing)
    if len(present(prepared, PREPARED_KEY)) >= 4:
        report["natural_key_duplicates"] = quality.natural_key_duplicates(prepared)
    if metrics:
        report["metric_percentiles"] = quantiles.metric_percentiles(prepared)
        report["describe_sample"] = describe.describe_sample(prepared)
        report["histograms"] = histograms.histogram(prepared, metrics, bins=80)
    if len(present(prepared, ["PU_Borough", "PU_Zone"])) == 2:
        report["top_pickup_zones"] = zone_operators.top_pickup_zones(prepared)
    if len(present(prepared, ["PU_Zone", "DO_Zone", "trip_distance", "total_amount"])) == 4:
        report["top_od_pairs"] = zone_operators.top_od_pairs(prepared)
    for name in present(prepared, ["payment_type", "RatecodeID", "passenger_count"]):
        report[f"{name}_distribution"] = distributions.distribution(prepared, name)
    return report


#: Numeric columns that name a row of a section rather than measure it.
KEY_COLUMNS = {
    "position", "rank", "bin", "hour", "dow", "pickup_hour", "LocationID", "payment_type", "RatecodeID",
    "passenger_count", "probability",
}
#: Sections of rows as they are, and those that differ from run to run.
NOT_LONG = {"preview", "describe_preview", "describe_sample", "nonpositive_distance", "problem_fares"}


def as_long(report: Report) -> DataFrame:
    """One table `section, key, measure, value` of the report's sections.

    A row's key joins its texts, times and codes; each of its numbers is a measure. A row without
    numbers has the measure `row` with the value 1.
    """
    parts = []
    for section, frame in report.items():
        if section in NOT_LONG or not frame.columns:
            continue
        lists = {f.name for f in frame.schema if f.dataType.typeName() == "array"}
        numbers = [n for n in of_type(frame, NUMERIC_TYPES) if n not in KEY_COLUMNS]
        keys = [n for n in frame.columns if n not in numbers and n not in lists]
        key = F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("-")) for n in keys])
        measures = [(n, F.col(n)) for n in numbers] + [
            (f"{n}[{i}]", F.get(n, F.lit(i))) for n in sorted(lists) for i in range(4)
        ]
        cells = [
            F.struct(F.lit(n).alias("measure"), c.cast("double").alias("value"))
            for n, c in measures or [("row", F.lit(1.0))]
        ]
        parts.append(
            frame.select(F.lit(section).alias("section"), key.alias("key"), F.inline(F.array(*cells)))
        )
    return reduce(DataFrame.unionByName, parts)
