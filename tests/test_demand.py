from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from hackney.functions.columns import ensure_timestamps, first_present, present
from hackney.functions.labels import labelled_zones
from hackney.functions.times import epoch_micros, from_epoch_micros
from hackney.operators import demand, distributions
from hackney.operators.zones import top_zones_labelled
from hackney.plans.jobs import prepare
from tests.conftest import ZONES
from tests.conftest import at


def test_hours_without_trips_are_null(make_trips):
    trips = make_trips(
        {"total_amount": 10.0},
        {"total_amount": 20.0},
        {"total_amount": math.nan},
        {"tpep_pickup_datetime": None, "total_amount": 99.0},
    )
    means = {r["hour"]: r["mean_amount"] for r in demand.hourly_mean_filled(trips).collect()}
    assert list(means) == list(range(24))
    assert means[8] == 15.0
    assert means[3] is None


def test_missing_pickup_time_is_its_own_hour(make_trips):
    rows = demand.raw_trips_by_hour(make_trips({}, {"tpep_pickup_datetime": None})).collect()
    assert [tuple(r) for r in rows] == [(8, 1), (None, 1)]


def test_weekday_counts_from_sunday(make_trips, zones):
    trips = make_trips(
        {
            "tpep_pickup_datetime": at("2024-01-07 08:00:00"),
            "tpep_dropoff_datetime": at("2024-01-07 09:00:00"),
        }
    )
    assert demand.trips_by_weekday(prepare(trips, zones)).first()["dow"] == 0


def test_hourly_by_date_is_ordered_and_limited(make_trips, zones):
    trips = make_trips(
        *[
            {
                "tpep_pickup_datetime": at(f"2024-01-0{day} {hour:02d}:00:00"),
                "tpep_dropoff_datetime": at(f"2024-01-0{day} {hour:02d}:30:00"),
            }
            for day in [2, 1]
            for hour in range(3)
        ]
    )
    rows = demand.hourly_by_date(prepare(trips, zones), limit=4).collect()
    assert [(r["pickup_date"].day, r["pickup_hour"]) for r in rows] == [
        (1, 0),
        (1, 1),
        (1, 2),
        (2, 0),
    ]


def test_null_code_is_its_own_group(make_trips):
    trips = make_trips({"payment_type": None}, {"payment_type": None}, {})
    rows = distributions.distribution(trips, "payment_type").collect()
    assert [tuple(r) for r in rows] == [(None, 2), (1, 1)]


def test_code_labels(make_trips):
    trips = make_trips({"payment_type": None}, {"payment_type": 9}, {"payment_type": 2})
    assert [r["label"] for r in distributions.payment_counts_labelled(trips).collect()] == [
        "2 - Cash",
        "9 - Other/Unknown",
        "NaN (missing)",
    ]
    rates = make_trips({"RatecodeID": 99.0}, {"RatecodeID": math.nan}, {"RatecodeID": None})
    rows = distributions.ratecode_counts_labelled(rates).collect()
    assert [(r["label"], r["trips"]) for r in rows] == [("99 - Unknown/Null", 1), ("NaN", 2)]


def test_other_spelling_of_the_rate_code(make_trips):
    trips = make_trips({}).withColumnRenamed("RatecodeID", "RateCodeID2")
    with pytest.raises(KeyError):
        distributions.ratecode_counts_labelled(trips)
    renamed = trips.withColumnRenamed("RateCodeID2", "RateCodeID")
    row = distributions.ratecode_counts_labelled(renamed).first()
    assert row["label"] == "1 - Standard rate"


def test_categorical_value_counts_keep_the_most_frequent(spark):
    ids = spark.range(300).select(
        F.least(F.col("id") % 30, F.lit(5)).alias("VendorID"), F.lit(None).alias("payment_type")
    )
    rows = distributions.categorical_value_counts(ids, ["VendorID", "payment_type", "x"], k=3)
    assert [(r["column_name"], r["value"], r["trips"], r["rank"]) for r in rows.collect()] == [
        ("VendorID", "5", 250, 1),
        ("VendorID", "0", 10, 2),
        ("VendorID", "1", 10, 3),
        ("payment_type", None, 300, 1),
    ]


def test_zone_labels_fall_back(spark):
    zones = spark.createDataFrame([(1, "N/A", None, "x"), (None, "b", "z", "x")], ZONES)
    labels = [tuple(r) for r in labelled_zones(zones).collect()]
    assert labels == [(1, "N/A — nan"), (None, "b — z")]
    assert labelled_zones(zones.drop("Borough")).first()["zone_label"] == "nan"
    assert labelled_zones(zones.drop("Zone")).first()["zone_label"] == "1"
    lower = zones.withColumnRenamed("LocationID", "location_id")
    assert labelled_zones(lower).first()["LocationID"] == 1
    with pytest.raises(KeyError):
        labelled_zones(zones.drop("LocationID"))


def test_top_zones_label_unknown_ids_by_themselves(make_trips, zones):
    trips = make_trips(
        {"PULocationID": 99}, {"PULocationID": 99}, {"PULocationID": None, "DOLocationID": 1}, {}
    )
    rows = [tuple(r) for r in top_zones_labelled(trips, zones, k=2).collect()]
    assert rows == [
        ("pickup", 1, 99, "99", 2),
        ("pickup", 2, 1, "Manhattan — Soho", 1),
        ("dropoff", 1, 2, "Queens — Astoria", 3),
        ("dropoff", 2, 1, "Manhattan — Soho", 1),
    ]


def test_columns_by_presence(spark):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00")], "b int, t string")
    assert present(df, ["a", "b"]) == ["b"]
    with pytest.raises(ValueError):
        present(df, ["a", "b"], at_least=2)
    assert first_present(df, ["a", "t"]) == "t"
    assert first_present(df, ["a"]) is None
    assert dict(ensure_timestamps(df, ["t", "u"]).dtypes)["t"] == "timestamp_ntz"


def test_text_that_is_no_timestamp_is_an_error(spark):
    df = spark.createDataFrame([("nonsense",)], "t string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        ensure_timestamps(df, ["t"]).collect()


@pytest.mark.parametrize(
    "text",
    [
        "2024-03-10 02:30:00.123456",
        "1969-12-31 23:59:59.500001",
        "1960-02-29 00:00:00.000001",
        "1960-02-29 00:00:00",
        "1970-01-01 00:00:00",
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_micros_are_exact_in_any_zone(spark, text, zone):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ '{text}' AS t")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = epoch_micros(F.col("t"))
        row = df.select(micros.alias("n"), from_epoch_micros(micros).alias("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row["t"] == at(text)
    assert row["n"] == (at(text) - at("1970-01-01")) / dt.timedelta(microseconds=1)
