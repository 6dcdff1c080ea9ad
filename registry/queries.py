"""Every operator as a query over the given tables.

Queries that read their input more than once, and would compute its joins again each time, stage the
columns they need first. Reports that use no zone attribute skip attaching them, since that neither
adds nor drops trips.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.operators import cleaning, demand, describe, distributions, histograms, quality
from hackney.operators import quantiles, sampling, zones as zone_operators
from hackney.plans import jobs, reports
from hackney.schema import (
    CATEGORICAL_COLUMNS,
    DROPOFF,
    METRIC_COLUMNS,
    PICKUP,
    PREPARED_KEY,
    RAW_KEY,
)
from hackney.session import scratch_path, stage
from hackney.sources import drift, readers, writers
from hackney.sources.layout import Layout
from registry import fixture

Query = Callable[[SparkSession, str], DataFrame]

YEAR, MONTH = 2024, 1
VALIDITY = [PICKUP, DROPOFF, "trip_distance", "total_amount"]
ZONE_IDS = ["PULocationID", "DOLocationID"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded: sums over rows in any order differ in their last digits."""
    return df.select(
        *[
            F.round(name, digits).alias(name) if kind == "double" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def cleaned(spark: SparkSession, sf_dir: str, extra: Sequence[str] = ()) -> DataFrame:
    """Valid trips with derived columns; `extra` are further raw columns."""
    return cleaning.clean_trips(fixture.trips(spark, sf_dir, VALIDITY + list(extra)))


def prepared(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None, repeated: bool = False
) -> DataFrame:
    return jobs.prepare(
        fixture.trips(spark, sf_dir, columns, repeated), fixture.zones(spark, sf_dir)
    )


def scratch_lake(spark: SparkSession) -> Layout:
    root = scratch_path(spark, "lake")
    return Layout(root=root, source=f"{root}/source")


def written_month(spark: SparkSession, sf_dir: str) -> Layout:
    """A lake of its own that holds the prepared trips as one month."""
    lake = scratch_lake(spark)
    writers.write_prepared(prepared(spark, sf_dir), lake.prepared(YEAR, MONTH))
    return lake


def by_date(table: DataFrame) -> DataFrame:
    return table.groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"))


# Sources and sinks


def scan_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.trips(spark, sf_dir)


def scan_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_prepared(spark, written_month(spark, sf_dir), YEAR, MONTH)


def prepared_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_date(readers.read_prepared(spark, written_month(spark, sf_dir), YEAR, MONTH))


def publish_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = written_month(spark, sf_dir)
    jobs.publish(spark, lake, YEAR, MONTH)
    return by_date(readers.read_table(spark))


def run_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark)
    fixture.trips(spark, sf_dir).write.parquet(lake.trips_file(YEAR, MONTH))
    fixture.zones(spark, sf_dir).write.option("header", True).csv(lake.zones_file)
    jobs.run_month(spark, lake, YEAR, MONTH)
    return by_date(readers.read_table(spark))


def scan_drifting_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed months whose codes are integers in one and doubles in the other, read as one table."""
    lake = scratch_lake(spark)
    trips = fixture.trips(spark, sf_dir, ["VendorID", "passenger_count", "RatecodeID", "tip_amount", "mta_tax"])
    whole = trips.where("VendorID = 1").withColumns(
        {"passenger_count": F.col("passenger_count").cast("int"), "RatecodeID": F.col("RatecodeID").cast("long")}
    )
    other = trips.where("VendorID = 2").drop("mta_tax").withColumnRenamed("tip_amount", "Tip_Amount")
    for month, part in ((1, whole), (2, other)):
        writers.land_trips(part, lake.landing(YEAR, month))
    both = drift.read_landed(spark, lake, [(YEAR, 1), (YEAR, 2)])
    return rounded(
        both.groupBy("year", "month", "passenger_count", "RatecodeID").agg(
            F.count(F.lit(1)).alias("trips"), F.sum("tip_amount").alias("tips"), F.count("mta_tax").alias("taxed")
        )
    )


def landed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark)
    fixture.zones(spark, sf_dir).write.option("header", True).csv(lake.zones_file)
    text = readers.read_zone_text(spark, lake.zones_file)
    writers.land_zones(readers.normalise_zones(text), lake.landing_zones)
    return readers.read_zones(spark, lake.landing_zones)


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_count(prepared(spark, sf_dir))


def column_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_inventory(fixture.trips(spark, sf_dir))


# Preparation


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.keep_valid(fixture.trips(spark, sf_dir))


def derive_trip_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = cleaning.keep_valid(fixture.trips(spark, sf_dir, VALIDITY))
    return cleaning.derive_features(valid).drop("total_amount")


def normalise_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = ["passenger_count", "payment_type", "RatecodeID"]
    return cleaned(spark, sf_dir, codes).groupBy(*codes).agg(F.count(F.lit(1)).alias("trips"))


def enrich_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark, sf_dir)


# Quality


def nonpositive_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.nonpositive_distance(fixture.trips(spark, sf_dir))


def problem_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    fares = fixture.trips(spark, sf_dir, ["fare_amount", "total_amount"])
    return quality.problem_fares(fares)


def missing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.missing_summary(fixture.trips(spark, sf_dir)))


def min_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.min_dates(fixture.trips(spark, sf_dir, [PICKUP, DROPOFF]))


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_rows(stage(fixture.trips(spark, sf_dir, repeated=True), "trips"))


def raw_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.raw_key_duplicates(fixture.trips(spark, sf_dir, RAW_KEY, repeated=True))


def natural_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixture.trips(spark, sf_dir, PREPARED_KEY, repeated=True)
    return quality.natural_key_duplicates(cleaning.clean_trips(trips))


def range_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.range_checks(cleaned(spark, sf_dir))


def zone_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.zone_coverage(prepared(spark, sf_dir, VALIDITY + ZONE_IDS)))


# Distributions


def _distribution(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return distributions.distribution(cleaned(spark, sf_dir, [name]), name)

    return query


def passenger_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    passengers = fixture.trips(spark, sf_dir, ["passenger_count"])
    return distributions.value_counts(passengers, "passenger_count")


def payment_counts_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.payment_counts_labelled(fixture.trips(spark, sf_dir, ["payment_type"]))


def ratecode_counts_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.ratecode_counts_labelled(fixture.trips(spark, sf_dir, ["RatecodeID"]))


def categorical_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.categorical_value_counts(
        fixture.trips(spark, sf_dir, CATEGORICAL_COLUMNS)
    )


def _raw_histogram(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(histograms.histogram(fixture.trips(spark, sf_dir, [name]), [name], 100))

    return query


def histogram_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = stage(cleaned(spark, sf_dir).select(*METRIC_COLUMNS), "metrics")
    return rounded(histograms.histogram(metrics, METRIC_COLUMNS, bins=80))


def metric_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of the one-row result, one row per entry."""
    metrics = stage(cleaned(spark, sf_dir).select(*METRIC_COLUMNS), "metrics")
    lists = quantiles.metric_percentiles(metrics)
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(probability).alias("probability"),
            F.get(f"{name}_q", F.lit(i)).alias("value"),
        )
        for name in METRIC_COLUMNS
        for i, probability in enumerate(quantiles.PROBABILITIES)
    ]
    return rounded(lists.select(F.inline(F.array(*entries))), 8)


# Descriptions


def _rounded_description(described: DataFrame) -> DataFrame:
    return described.withColumns(
        {name: F.round(name, 6) for name in ["mean", "std", "min", "max"]}
        | {name: F.round(name, 8) for name in describe.QUARTILES}
    )


def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixture.trips(spark, sf_dir).drop(PICKUP, DROPOFF, "store_and_fwd_flag")
    return _rounded_description(describe.describe_numeric(stage(trips, "numbers")))


def describe_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = stage(fixture.trips(spark, sf_dir, [PICKUP, DROPOFF]), "times")
    return describe.describe_timestamps(times)


def describe_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = VALIDITY + ZONE_IDS + ["store_and_fwd_flag"]
    return describe.describe_categorical(prepared(spark, sf_dir, columns))


def describe_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = stage(fixture.trips(spark, sf_dir, [PICKUP, DROPOFF]), "times")
    return _rounded_description(describe.describe_duration(times))


def describe_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = stage(cleaned(spark, sf_dir).select(*METRIC_COLUMNS), "metrics")
    return _rounded_description(describe.describe_sample(metrics))


# Looking at rows


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.preview(prepared(spark, sf_dir))


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = stage(cleaned(spark, sf_dir).select(*METRIC_COLUMNS), "metrics")
    return sampling.sample_rows(metrics)


def _compared(shown: DataFrame, source: DataFrame) -> DataFrame:
    """Rows shown, rows of them that the source has not, and copies beyond those of the source."""
    names = source.columns
    n = F.count(F.lit(1))
    seen = shown.groupBy(*names).agg(n.alias("shown"))
    there = source.groupBy(*names).agg(n.alias("there"))
    same = [F.col(f"s.{name}").eqNullSafe(F.col(f"t.{name}")) for name in names]
    both = seen.alias("s").join(there.alias("t"), same, "left")
    return both.agg(
        F.sum("shown").alias("rows_shown"),
        F.sum(F.when(F.col("there").isNull(), F.col("shown")).otherwise(0)).alias("rows_unknown"),
        F.sum(F.greatest(F.col("shown") - F.col("there"), F.lit(0))).alias("copies_too_many"),
    )


def preview_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any preview, whichever rows it shows."""
    trips = prepared(spark, sf_dir, VALIDITY + ZONE_IDS)
    return _compared(stage(sampling.preview(trips), "preview"), trips)


def sample_rows_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any sample."""
    metrics = stage(cleaned(spark, sf_dir).select(*METRIC_COLUMNS), "metrics")
    return _compared(stage(sampling.sample_rows(metrics), "sample"), metrics)


def describe_sample_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for the description of any sample: its size, and extremes within the table's."""
    metrics = stage(cleaned(spark, sf_dir).select(*METRIC_COLUMNS), "metrics")
    described = describe.describe_sample(metrics)
    extremes = metrics.agg(
        *[F.struct(F.min(n).alias("least"), F.max(n).alias("most")).alias(n) for n in METRIC_COLUMNS]
    ).select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("column_name"), f"{n}.*") for n in METRIC_COLUMNS]))
    )
    return described.join(extremes, "column_name").select(
        "column_name",
        "count",
        ((F.col("min") >= F.col("least")) & (F.col("max") <= F.col("most"))).alias("within"),
    )


# Reports


def _rounded_report(report: reports.Report) -> DataFrame:
    """Digits as in the queries of the sections, so that no value is rounded at a tie."""
    measure, value = F.col("measure"), F.col("value")
    quantile = measure.isin(list(describe.QUARTILES)) | measure.contains("_q[")
    rounded_value = (
        F.when(quantile, F.round(value, 8))
        .when(F.col("section") == "hourly_by_date", F.round(value, 9))
        .otherwise(F.round(value, 6))
    )
    return reports.as_long(report).withColumn("value", rounded_value)


def raw_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = stage(fixture.trips(spark, sf_dir), "trips")
    return _rounded_report(reports.raw_profile(trips, fixture.zones(spark, sf_dir)))


def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_report(reports.validate(stage(prepared(spark, sf_dir), "prepared")))


# Demand


def temporal_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.temporal_coverage(cleaned(spark, sf_dir))


def hourly_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Means of a few amounts often end in a 5 at the seventh place, so six places would be ties.
    return rounded(demand.hourly_by_date(cleaned(spark, sf_dir)), 9)


def trips_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(demand.trips_by_hour(cleaned(spark, sf_dir)))


def trips_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(demand.trips_by_weekday(cleaned(spark, sf_dir)))


def raw_trips_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.raw_trips_by_hour(fixture.trips(spark, sf_dir, [PICKUP]))


def hourly_mean_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fixture.trips(spark, sf_dir, [PICKUP, "total_amount"])
    return rounded(demand.hourly_mean_filled(trips))


def top_pickup_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = cleaned(spark, sf_dir, ZONE_IDS)
    return zone_operators.top_pickup_zones(trips, fixture.zones(spark, sf_dir))


def top_od_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = cleaned(spark, sf_dir, ZONE_IDS)
    return rounded(zone_operators.top_od_pairs(trips, fixture.zones(spark, sf_dir)))


def top_zones_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_operators.top_zones_labelled(
        fixture.trips(spark, sf_dir, ZONE_IDS), fixture.zones(spark, sf_dir)
    )


# The same operators on a table whose timestamps have fractional seconds


def events_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demand.raw_trips_by_hour(fixture.table(spark, sf_dir, "events"), "ts")


def events_mean_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(demand.hourly_mean_filled(fixture.table(spark, sf_dir, "events"), "ts", "value"))


def events_min_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.min_dates(fixture.table(spark, sf_dir, "events"), suffix="ts")


def events_describe_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.describe_timestamps(fixture.table(spark, sf_dir, "events"), ["ts"])


def events_describe_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    events = fixture.table(spark, sf_dir, "events").select(start.alias("start"), "ts")
    return _rounded_description(describe.describe_duration(events, "start", "ts"))


def events_describe_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe.describe_categorical(fixture.table(spark, sf_dir, "events"), ["event_type"])


def queries() -> dict[str, Query]:
    return {
        "scan_trips": scan_trips,
        "scan_prepared": scan_prepared,
        "prepared_roundtrip": prepared_roundtrip,
        "publish_table": publish_table,
        "run_month": run_month,
        "landed_zones": landed_zones,
        "scan_drifting_months": scan_drifting_months,
        "row_count": row_count,
        "column_inventory": column_inventory,
        "clean_trips": clean_trips,
        "derive_trip_features": derive_trip_features,
        "normalise_codes": normalise_codes,
        "enrich_zones": enrich_zones,
        "nonpositive_distance": nonpositive_distance,
        "problem_fares": problem_fares,
        "missing_summary": missing_summary,
        "min_dates": min_dates,
        "duplicate_rows": duplicate_rows,
        "raw_key_duplicates": raw_key_duplicates,
        "natural_key_duplicates": natural_key_duplicates,
        "range_checks": range_checks,
        "zone_coverage": zone_coverage,
        "payment_distribution": _distribution("payment_type"),
        "ratecode_distribution": _distribution("RatecodeID"),
        "passenger_distribution": _distribution("passenger_count"),
        "passenger_counts": passenger_counts,
        "payment_counts_labelled": payment_counts_labelled,
        "ratecode_counts_labelled": ratecode_counts_labelled,
        "categorical_value_counts": categorical_value_counts,
        "histogram_total_amount": _raw_histogram("total_amount"),
        "histogram_tip_amount": _raw_histogram("tip_amount"),
        "histogram_metrics": histogram_metrics,
        "metric_percentiles": metric_percentiles,
        "describe_numeric": describe_numeric,
        "describe_timestamps": describe_timestamps,
        "describe_categorical": describe_categorical,
        "describe_duration": describe_duration,
        "describe_sample": describe_sample,
        "preview": preview,
        "sample_rows": sample_rows,
        "preview_check": preview_check,
        "sample_rows_check": sample_rows_check,
        "describe_sample_check": describe_sample_check,
        "raw_profile": raw_profile,
        "validate": validate,
        "temporal_coverage": temporal_coverage,
        "hourly_by_date": hourly_by_date,
        "trips_by_hour": trips_by_hour,
        "trips_by_weekday": trips_by_weekday,
        "raw_trips_by_hour": raw_trips_by_hour,
        "hourly_mean_filled": hourly_mean_filled,
        "top_pickup_zones": top_pickup_zones,
        "top_od_pairs": top_od_pairs,
        "top_zones_labelled": top_zones_labelled,
        "events_by_hour": events_by_hour,
        "events_mean_by_hour": events_mean_by_hour,
        "events_min_date": events_min_date,
        "events_describe_timestamps": events_describe_timestamps,
        "events_describe_duration": events_describe_duration,
        "events_describe_categorical": events_describe_categorical,
    }
