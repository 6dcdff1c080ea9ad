from __future__ import annotations

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hackney.operators import quality
from hackney.operators.cleaning import clean_trips
from hackney.plans.jobs import prepare
from registry import fixture
from tests.conftest import SMALL, at


def test_duplicates_count_missing_values_as_equal(make_trips):
    trips = make_trips(
        {"passenger_count": None},
        {"passenger_count": None},
        {"passenger_count": math.nan},
        {"passenger_count": math.nan},
        {"trip_distance": 0.0},
        {"trip_distance": -0.0},
        {},
    )
    assert quality.duplicate_rows(trips).first()[0] == 3
    assert quality.raw_key_duplicates(trips).first()[0] == 3


def test_rows_that_only_share_a_hash_are_no_duplicates(spark):
    # Nulls leave the hash unchanged, so these two rows have the same one.
    swapped = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert swapped.select(F.xxhash64("x", "y")).distinct().count() == 1
    assert quality.duplicate_rows(swapped).first()[0] == 0


def test_a_third_of_all_rows_are_copies(spark):
    ids = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("a"), F.lit("x").alias("b")
    )
    assert quality.duplicate_rows(ids).first()[0] == 9_999


def test_forced_collisions_are_told_apart(spark, monkeypatch):
    """With a hash of three values every hash repeats, and each key is compared in full."""
    rows = [(i % 40, None if i % 7 == 0 else i % 5, f"v{i}") for i in range(400)] + [(None, None, "v0")]
    df = spark.createDataFrame(rows, "a int, b int, c string")
    monkeypatch.setattr(quality, "_key_hash", lambda key: F.pmod(F.xxhash64(*key), F.lit(3)))
    found = quality._key_counts(df, ["a", "b"]).first()
    assert tuple(found) == (401, len({r[:2] for r in rows}))
    assert quality.duplicate_rows(df).first()[0] == 0


def test_missing_parts_differ_by_place(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, None), (None, None)], "a int, b int")
    hashes = df.select(quality._key_hash(["a", "b"]).alias("h")).distinct().count()
    assert hashes == 3
    assert tuple(quality._key_counts(df, ["a", "b"]).first()) == (4, 3)


def test_duplicates_match_pandas(spark):
    trips = fixture.trips(spark, SMALL, repeated=True)
    frame = trips.toPandas()
    assert quality.duplicate_rows(trips).first()[0] == frame.duplicated().sum()
    key = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime"]
    key += ["passenger_count", "trip_distance"]
    assert quality.raw_key_duplicates(trips).first()[0] == frame.duplicated(subset=key).sum()


def test_natural_key_needs_four_columns(make_trips):
    trips = make_trips({}, {})
    assert quality.natural_key_duplicates(trips).first()["estimated_duplicates"] == 1
    with pytest.raises(ValueError, match="at least 4"):
        quality.natural_key_duplicates(trips.select("PULocationID", "DOLocationID"))


def test_missing_summary_matches_pandas(spark, make_trips):
    trips = make_trips({"passenger_count": math.nan, "tip_amount": None}, {"tip_amount": None}, {})
    found = {
        r["column_name"]: (r["null_count"], r["null_pct"])
        for r in quality.missing_summary(trips).collect()
    }
    frame = trips.toPandas()
    for name in trips.columns:
        missing = frame[name].isna()
        assert found[name] == (missing.sum(), pytest.approx(missing.mean() * 100))


def test_empty_tables_give_nulls(make_trips, zones):
    empty = make_trips({}).limit(0)
    prepared = prepare(empty, zones)
    assert set(quality.range_checks(prepared).first()) == {None}
    assert set(quality.zone_coverage(prepared).first()) == {None}
    assert quality.missing_summary(empty).first()["null_pct"] is None
    assert quality.duplicate_rows(empty).first()[0] == 0
    assert quality.natural_key_duplicates(prepared).first()["estimated_duplicates"] == 0


def test_hard_checks_are_zero_after_cleaning(spark):
    checks = quality.range_checks(clean_trips(fixture.trips(spark, SMALL))).first()
    for name in [
        "trip_distance_negative",
        "total_amount_negative",
        "duration_le_0",
        "avg_mph_negative",
    ]:
        assert checks[name] == 0
    assert checks["duration_gt_300"] > 0


def test_problem_fares_match_pandas(spark):
    trips = fixture.trips(spark, SMALL)
    frame = trips.toPandas()
    parts = [
        frame[frame[c] <= 0][[c]].assign(problem_col=c) for c in ["fare_amount", "total_amount"]
    ]
    expected = pd.concat(parts)
    found = quality.problem_fares(trips)
    assert found.columns == list(expected.columns)
    counts = found.groupBy("problem_col").count().collect()
    assert {r["problem_col"]: r["count"] for r in counts} == {
        name: len(part) for name, part in zip(["fare_amount", "total_amount"], parts)
    }


def test_problem_fares_skip_an_absent_column(make_trips):
    trips = make_trips({"fare_amount": 0.0}, without=("total_amount",))
    assert [tuple(r) for r in quality.problem_fares(trips).collect()] == [(0.0, "fare_amount")]


def test_min_dates_pick_timestamp_columns_by_name(make_trips):
    trips = make_trips({}, {"tpep_pickup_datetime": at("2023-12-31 23:59:00")})
    text = trips.withColumn("note_datetime", F.lit("x"))
    row = quality.min_dates(text).first().asDict()
    assert {k: str(v) for k, v in row.items()} == {
        "min_tpep_pickup_datetime": "2023-12-31",
        "min_tpep_dropoff_datetime": "2024-01-05",
    }


def test_column_inventory(make_trips):
    rows = quality.column_inventory(make_trips({}, {"passenger_count": None})).collect()
    assert len(rows) == 19
    assert tuple(rows[3]) == (4, "passenger_count", "double", 1)
