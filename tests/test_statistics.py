from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hackney.operators import quantiles as q
from hackney.operators.cleaning import clean_trips
from hackney.operators.describe import (
    describe_categorical,
    describe_duration,
    describe_numeric,
    describe_sample,
    describe_timestamps,
)
from hackney.operators.histograms import histogram
from hackney.operators.quantiles import exact_quantiles, metric_percentiles
from hackney.operators.sampling import preview, sample_rows
from hackney.schema import METRIC_COLUMNS
from hackney.session import stage
from registry import fixture
from tests.conftest import SMALL, at, plan_of

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.9, 0.95, 0.99, 1.0]


def found_quantiles(df, columns, **options):
    rows = exact_quantiles(df, columns, PROBABILITIES, **options).collect()
    return {(r["column_name"], r["probability"]): r["value"] for r in rows}


@pytest.mark.parametrize("accuracy", [20, 10_000])
@pytest.mark.parametrize("limit", [0, 500])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, accuracy, limit):
    """Coarse sketches force several rounds; the result must not depend on them."""
    monkeypatch.setattr(q, "SKETCH_ACCURACY", accuracy)
    df = spark.range(20_000).select(
        (F.rand(1) * 1000).alias("spread"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.round(F.rand(2) * 50, 1)).alias("hot"),
        F.pow(F.lit(10.0), F.rand(3) * 300).alias("heavy_tail"),
        F.when(F.col("id") % 5 == 0, F.rand(4)).alias("gaps"),
        F.lit(3.5).alias("constant"),
    )
    df = stage(df, "values")
    stored = df.toPandas()
    found = found_quantiles(df, df.columns, ranked_rows=limit)
    for name in df.columns:
        values = stored[name].dropna().to_numpy()
        for p in PROBABILITIES:
            assert found[(name, p)] == pytest.approx(np.quantile(values, p), rel=1e-12)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_quantiles_of_nan_null_and_nothing(spark, limit):
    empty = spark.createDataFrame([], "v double")
    assert set(found_quantiles(empty, ["v"], ranked_rows=limit).values()) == {None}
    assert exact_quantiles(empty, []).count() == 0
    rows = [(float(i), None, math.nan if i > 6 else float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "full double, absent double, some_nan double")
    found = found_quantiles(df, df.columns, ranked_rows=limit)
    assert found[("full", 0.5)] == 4.5
    assert found[("absent", 0.5)] is None
    assert found[("some_nan", 0.5)] == 4.5
    assert math.isnan(found[("some_nan", 0.9)])
    assert math.isnan(found[("some_nan", 1.0)])


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=40
    )
)
def test_any_limit_agrees_with_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for limit in [0, 1_000]:
        found = found_quantiles(df, ["v"], ranked_rows=limit)
        for p in PROBABILITIES:
            expected = np.quantile(values, p)
            assert found[("v", p)] == pytest.approx(expected, rel=1e-9, abs=1e-30)


def test_metric_percentiles_have_one_list_per_metric(spark):
    prepared = clean_trips(fixture.trips(spark, SMALL))
    frame = prepared.select(*METRIC_COLUMNS).toPandas()
    rows = metric_percentiles(prepared).collect()
    assert len(rows) == 1
    for name in METRIC_COLUMNS:
        expected = frame[name].quantile([0.5, 0.9, 0.95, 0.99]).to_list()
        assert rows[0][f"{name}_q"] == pytest.approx(expected)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_quantiles_beside_infinity(spark, limit):
    inf = math.inf
    df = spark.createDataFrame([(v, abs(v)) for v in (-inf, inf, 1.0, 2.0)], "both double, one double")
    found = exact_quantiles(df, ["both", "one"], [0.0, 0.25, 0.5, 0.75, 1.0], ranked_rows=limit)
    by_column = {}
    for r in sorted(found.collect()):
        by_column.setdefault(r["column_name"], []).append(r["value"])
    assert by_column["both"] == [-inf, -inf, 1.5, inf, inf]
    assert by_column["one"] == [1.0, 1.75, inf, inf, inf]
    two = exact_quantiles(spark.createDataFrame([(-inf,), (inf,)], "v double"), ["v"], [0.5])
    assert math.isnan(two.first()["value"])


@pytest.mark.parametrize("limit", [0, 3, 1_000_000])
def test_quantiles_of_large_integers(spark, limit):
    values = [1_700_000_000_000_000 + 7 * k for k in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    found = found_quantiles(df, ["v"], ranked_rows=limit)
    for p in PROBABILITIES:
        assert found[("v", p)] == np.quantile(np.array(values, float), p)


def test_brackets_narrow_without_help_of_sketches(spark, monkeypatch):
    """Halving the doubles alone reaches every rank, also across zero and magnitudes."""
    first = q._first_sketch

    def blind(values, probabilities):
        brackets, _, results = first(values, probabilities)
        return brackets, [(b.low, q._middle(b.low, b.high)) for b in brackets], results

    def halves(values, brackets):
        return [(b.low, q._middle(b.low, b.high)) for b in brackets]

    monkeypatch.setattr(q, "_first_sketch", blind)
    monkeypatch.setattr(q, "_next_proposals", halves)
    values = [(-1.0) ** k * 10.0 ** (k % 37 - 18) * (k + 1) for k in range(400)] + [3.5] * 50
    df = stage(spark.createDataFrame([(v,) for v in values], "v double"), "values")
    found = found_quantiles(df, ["v"], ranked_rows=5)
    for p in PROBABILITIES:
        assert found[("v", p)] == pytest.approx(np.quantile(np.array(values), p), rel=1e-12)


@pytest.mark.parametrize("bins", [1, 7, 80, 100])
def test_histogram_matches_numpy(spark, bins):
    trips = fixture.trips(spark, SMALL)
    columns = ["total_amount", "tip_amount", "trip_distance"]
    rows = histogram(trips, columns, bins).toPandas()
    frame = trips.toPandas()
    for name in columns:
        counts, edges = np.histogram(frame[name].dropna().to_numpy(), bins=bins)
        part = rows[rows["column_name"] == name].sort_values("bin")
        assert part["count"].to_list() == counts.tolist()
        assert part["center"].to_list() == pytest.approx(((edges[:-1] + edges[1:]) / 2).tolist())


def test_histogram_of_constant_missing_and_empty_columns(spark):
    rows = [(5.0, math.nan, None), (5.0, 1.0, None)]
    df = spark.createDataFrame(rows, "constant double, one double, none double")
    found = histogram(df, df.columns, bins=4).toPandas()
    by_name = {n: g.sort_values("bin") for n, g in found.groupby("column_name")}
    assert by_name["constant"]["center"].to_list() == [4.625, 4.875, 5.125, 5.375]
    assert by_name["constant"]["count"].to_list() == [0, 0, 2, 0]
    assert by_name["one"]["count"].sum() == 1
    assert by_name["none"]["count"].to_list() == [0, 0, 0, 0]


def test_histogram_rejects_infinity(spark):
    df = spark.createDataFrame([(1.0,), (math.inf,)], "v double")
    with pytest.raises(ValueError, match="bins"):
        histogram(df, ["v"])


def test_describe_numeric_matches_pandas(spark):
    trips = fixture.trips(spark, SMALL)
    expected = trips.toPandas().describe().T
    names = {"25%": "p25", "50%": "p50", "75%": "p75"}
    for row in describe_numeric(trips).collect():
        for statistic in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]:
            found = row[names.get(statistic, statistic)]
            assert found == pytest.approx(expected.loc[row["column_name"], statistic])


def test_describe_timestamps_matches_pandas(spark):
    trips = fixture.trips(spark, SMALL, ["tpep_pickup_datetime", "tpep_dropoff_datetime"])
    expected = trips.toPandas().describe()
    for row in describe_timestamps(trips).collect():
        column = expected[row["column_name"]]
        assert row["count"] == column["count"]
        for ours, theirs in [("min", "min"), ("p25", "25%"), ("p50", "50%"), ("max", "max")]:
            assert pd.Timestamp(row[ours]) == column[theirs].floor("us")
        assert abs(pd.Timestamp(row["mean"]) - column["mean"]) < pd.Timedelta("1us")


def test_zoned_timestamps_are_described_in_wall_time(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP '2024-01-05 08:00:00' AS t")
        assert describe_timestamps(df).first()["p50"] == at("2024-01-05 08:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_timestamp_quartiles_do_not_round_up(spark):
    """A double of this size holds halves of a microsecond only."""
    rows = [("2200-01-01 00:00:00.000001",), ("2200-01-01 00:00:00.000002",)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert describe_timestamps(df).first()["p75"] == at("2200-01-01 00:00:00.000001")


def test_describe_categorical(spark):
    rows = [("a", None), ("b", None), ("b", None), ("a", None), (None, None)]
    df = spark.createDataFrame(rows, "flag string, empty string")
    assert [tuple(r) for r in describe_categorical(df).collect()] == [
        ("empty", 0, 0, None, None),
        ("flag", 4, 2, "a", 2),
    ]


def test_describe_duration_keeps_fractions(make_trips):
    trips = make_trips(
        {
            "tpep_pickup_datetime": at("2024-01-01 00:00:00.200"),
            "tpep_dropoff_datetime": at("2024-01-01 00:01:00.900"),
        }
    )
    assert describe_duration(trips).first()["mean"] == pytest.approx(60.7 / 60)


def test_sample_has_exactly_the_size_asked(spark):
    ids = spark.range(0, 200_000, 1, 16)
    for n in [1, 5, 5_000]:
        sample = sample_rows(ids, n)
        assert sample.count() == sample.distinct().count() == n
    assert sample_rows(spark.range(10), 5_000).count() == 10


def test_describe_sample_describes_that_many_rows(spark):
    prepared = clean_trips(fixture.trips(spark, SMALL))
    rows = describe_sample(prepared, n=500).collect()
    assert {r["column_name"] for r in rows} == set(METRIC_COLUMNS)
    assert {r["count"] for r in rows} == {500}


def test_preview(spark):
    assert preview(spark.range(1_000)).count() == 100


def test_spread_values_take_no_sketch(spark, monkeypatch):
    def unwanted(*args):
        raise AssertionError("sketched")

    monkeypatch.setattr(q.F, "percentile_approx", unwanted)
    values = [math.sin(k) * 100 for k in range(3_000)] + [1e300, -1e300]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = found_quantiles(df, ["v"])
    for p in PROBABILITIES:
        assert found[("v", p)] == pytest.approx(np.quantile(np.array(values), p), rel=1e-12)


def test_ranking_computes_each_value_once(spark):
    df = spark.range(2_000).select(F.sin("id").alias("v"), F.sin(-F.col("id")).alias("w"))
    plan = plan_of(exact_quantiles(df, ["v", "w"]))
    assert plan.count("SIN(") == 2


def test_quantiles_of_ties_between_other_values(spark):
    values = [0.0] * 500 + [k / 1_000 for k in range(500)] + [1e6]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for limit in [0, 10, 1_000_000]:
        found = found_quantiles(df, ["v"], ranked_rows=limit)
        for p in PROBABILITIES:
            assert found[("v", p)] == pytest.approx(np.quantile(np.array(values), p), rel=1e-12)
