"""The two reports over months whose columns drift."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hackney.plans.jobs import prepare
from hackney.plans.reports import as_long, raw_profile, validate
from hackney.session import scratch_path, shared_dir, stage
from tests.conftest import RAW_TRIPS

#: Sections that need the column.
NEEDS = {
    "tpep_pickup_datetime": {"describe_duration", "trips_by_hour", "mean_amount_by_hour"},
    "tpep_dropoff_datetime": {"describe_duration"},
    "passenger_count": {"passenger_counts"},
    "trip_distance": {"nonpositive_distance"},
    "RatecodeID": {"ratecode_counts"},
    "PULocationID": {"top_zones"},
    "DOLocationID": {"top_zones"},
    "payment_type": {"payment_counts"},
    "total_amount": {"mean_amount_by_hour"},
}


@pytest.mark.parametrize("absent", RAW_TRIPS.fieldNames())
def test_a_raw_month_without_a_column(make_trips, zones, absent):
    trips = make_trips({}, {"total_amount": -1.0}, {})
    whole = set(raw_profile(trips, zones))
    report = raw_profile(trips.drop(absent), zones)
    assert whole - set(report) == NEEDS.get(absent, set())
    long = as_long(report).collect()
    assert {r["section"] for r in long} <= set(report)
    assert {("row_count", "row_count", 3.0), ("row_count", "column_count", 18.0)} <= {
        (r["section"], r["measure"], r["value"]) for r in long
    }


def test_a_raw_month_without_whole_types(make_trips, zones):
    trips = make_trips({}, {})
    only_text = raw_profile(trips.select("store_and_fwd_flag"), zones)
    assert only_text["describe_numeric"].count() == only_text["describe_timestamps"].count() == 0
    assert only_text["min_dates"].count() == 0
    only_numbers = raw_profile(trips.select("extra", "tip_amount"), zones)
    assert only_numbers["describe_categorical"].count() == 0
    assert only_numbers["describe_categorical"].columns == only_text["describe_categorical"].columns
    assert as_long(only_text).count() and as_long(only_numbers).count()


@pytest.mark.parametrize("absent", ["payment_type", "PU_Zone", "avg_mph", "total_amount", "pickup_hour"])
def test_a_prepared_month_without_a_column(make_trips, zones, absent):
    prepared = prepare(make_trips({}, {"DOLocationID": 7}, {}), zones)
    report = validate(stage(prepared.drop(absent), "prepared"))
    assert as_long(report).count()
    if absent == "avg_mph":
        assert "avg_mph_gt_90" not in report["range_checks"].columns
        assert report["range_checks"].first()["duration_le_0"] == 0


def test_an_empty_month(make_trips, zones):
    trips = make_trips({}).limit(0)
    assert raw_profile(trips, zones)["row_count"].first()["row_count"] == 0
    report = validate(stage(prepare(trips, zones), "prepared"))
    assert report["row_count"].first()["row_count"] == 0
    assert report["range_checks"].first()["duration_le_0"] is None
    assert as_long(report).count()


def test_the_rollup_scans_once(make_trips, zones):
    """Sections that share the totals by date and hour read only those."""
    prepared = stage(prepare(make_trips({}, {}), zones), "prepared")
    report = validate(prepared)
    for name in ["row_count", "temporal_coverage", "trips_by_hour", "trips_by_weekday", "range_checks"]:
        files = report[name].inputFiles()
        assert files and all("/rollup-" in f for f in files)


def test_the_scratch_folder_is_the_applications(spark):
    folder = scratch_path(spark, "x")
    assert spark.sparkContext.applicationId in folder
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != folder


@pytest.mark.parametrize("master", ["local[2]", "spark://host:7077", None])
def test_without_a_checkpoint_folder_the_warehouse_decides(master):
    settings = {"spark.sql.warehouse.dir": "s3a://bucket/warehouse/", "spark.master": master}

    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, *default: settings.get(key, *default))

    assert shared_dir(Session) == "s3a://bucket/warehouse-scratch"
    settings["spark.sql.warehouse.dir"] = "file:/home/me/warehouse"
    if master and "local" not in master:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(Session)
    else:
        assert shared_dir(Session) == "file:/home/me/warehouse-scratch"
    settings["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert shared_dir(Session) == "hdfs:///shared"


def test_one_row_copied_many_times_is_split(spark):
    """Duplicates where the list of repeated hashes is joined by shuffle and one row is hot."""
    from hackney.operators.quality import duplicate_rows

    hot = spark.range(60_000).select(F.lit(7).cast("long").alias("a"), F.repeat(F.lit("x"), 200).alias("b"))
    rest = spark.range(0, 4_000).select((F.col("id") % 3_000).alias("a"), F.lit("y").alias("b"))
    rows = stage(hot.union(rest).repartition(8), "rows")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = duplicate_rows(rows)
        assert found.collect()[0][0] == 59_999 + 1_000
        assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
