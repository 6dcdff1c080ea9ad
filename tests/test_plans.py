"""The physical plans that the operators rely on."""

from __future__ import annotations

import pytest

from hackney.operators.cleaning import clean_trips
from hackney.operators import demand, distributions, quality, zones as zone_operators
from hackney.operators.sampling import preview, sample_rows
from hackney.plans.jobs import prepare
from registry import fixture
from tests.conftest import SMALL, plan_of


@pytest.fixture
def stored(spark, make_trips, zones, tmp_path):
    """Trips and zones as Parquet, and the prepared trips by date."""
    make_trips({}, {"PULocationID": 9}).write.parquet(str(tmp_path / "trips"))
    zones.write.parquet(str(tmp_path / "zones"))
    trips, dimension = (spark.read.parquet(str(tmp_path / n)) for n in ["trips", "zones"])
    prepare(trips, dimension).write.partitionBy("pickup_date").parquet(str(tmp_path / "prepared"))
    return trips, dimension, spark.read.parquet(str(tmp_path / "prepared"))


def test_preparing_broadcasts_the_zones_and_shuffles_no_trips(stored):
    trips, zones, _ = stored
    plan = plan_of(prepare(trips, zones))
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_large_zones_are_not_forced_into_a_broadcast(stored, spark):
    trips, zones, _ = stored
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_of(prepare(trips, zones))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(stored):
    trips, zones, _ = stored
    plan = plan_of(demand.temporal_coverage(prepare(trips, zones)))
    for pushed in [
        "IsNotNull(tpep_pickup_datetime)",
        "IsNotNull(tpep_dropoff_datetime)",
        "GreaterThanOrEqual(trip_distance,0.0)",
        "GreaterThanOrEqual(total_amount,0.0)",
    ]:
        assert pushed in plan
    assert "tip_amount" not in plan


def test_a_date_predicate_prunes_partitions(stored):
    prepared = stored[2].where("pickup_date = DATE '2024-01-05'")
    plan = plan_of(quality.range_checks(prepared))
    assert "PartitionFilters: [isnotnull(pickup_date" in plan


def test_top_k_sorts_no_whole_table(stored):
    prepared = stored[2]
    for top in [
        zone_operators.top_od_pairs(prepared),
        zone_operators.top_pickup_zones(prepared),
        demand.hourly_by_date(prepared),
        sample_rows(prepared),
    ]:
        plan = plan_of(top)
        assert "TakeOrderedAndProject" in plan
        assert "rangepartitioning" not in plan


def test_rankings_keep_k_rows_per_task(stored):
    trips, zones, _ = stored
    assert plan_of(distributions.categorical_value_counts(trips)).count("WindowGroupLimit") == 2
    assert plan_of(zone_operators.top_zones_labelled(trips, zones)).count("WindowGroupLimit") == 2


def test_prepared_rows_are_rebalanced_by_date(stored, spark):
    trips, zones, _ = stored
    by_date = prepare(trips, zones).hint("rebalance", "pickup_date")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(by_date)


def test_only_the_tables_of_the_wanted_columns_are_joined(spark):
    assert "Join" not in plan_of(fixture.trips(spark, SMALL, ["total_amount", "tip_amount"]))
    assert plan_of(fixture.trips(spark, SMALL, ["DOLocationID"])).count("Join") == 1
    assert plan_of(fixture.trips(spark, SMALL)).count("Join") == 3


def test_a_preview_joins_only_the_rows_it_shows(spark):
    lines = plan_of(preview(fixture.trips(spark, SMALL))).splitlines()
    scan = next(i for i, line in enumerate(lines) if "l_orderkey" in line and "FileScan" in line)
    assert "LocalLimit 100" in lines[scan - 1]


def test_zones_are_named_after_trips_are_counted(stored):
    trips, zones, _ = stored
    valid = clean_trips(trips)
    for top in [
        zone_operators.top_od_pairs(valid, zones),
        zone_operators.top_pickup_zones(valid, zones),
    ]:
        lines = plan_of(top).splitlines()
        joins = [i for i, line in enumerate(lines) if "HashJoin" in line]
        first = max(i for i, line in enumerate(lines) if "partial_count" in line)
        assert joins and first > max(joins)  # the plan prints children below


def test_keys_are_shuffled_as_hashes(stored):
    """The first exchange carries a hash and its count; neither key columns nor rows."""
    trips = stored[0]
    lines = plan_of(quality._hash_counts(trips, trips.columns)).splitlines()
    first = next(i for i, line in reversed([*enumerate(lines)]) if "Exchange hashpartitioning" in line)
    partial = lines[first + 1]
    assert "keys=[key_hash" in partial and "functions=[partial_count" in partial
