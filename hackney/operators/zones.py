"""Attaching the zone dimension, and the zone rankings that use its labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hackney.functions.labels import labelled_zones

def checked_dimension(zones: DataFrame) -> DataFrame:
    """Reject repeated ids, which would multiply trips.

    Spark broadcasts the zones by their size; if they are larger than its limit, it shuffles and splits
    skewed keys at run time.
    """
    ids = F.col("LocationID")
    seen = zones.agg(
        F.count(ids).alias("ids"), F.count_distinct(ids).alias("distinct_ids")
    ).first()
    if seen["ids"] != seen["distinct_ids"]:
        raise ValueError(f"{seen['ids'] - seen['distinct_ids']} repeated LocationID in the zones")
    return zones


def add_zone_attributes(
    trips: DataFrame, zones: DataFrame, roles: Sequence[str] = ("PU", "DO")
) -> DataFrame:
    """Pickup (`PU_*`) and dropoff (`DO_*`) zone fields; trips without a match keep nulls."""
    attributes = ["Borough", "Zone", "service_zone"]
    dimension = checked_dimension(
        zones.select(F.col("LocationID").try_cast("int").alias("LocationID"), *attributes)
    )
    for role in roles:
        key = f"{role}LocationID"
        fields = dimension.select(
            F.col("LocationID").alias(key),
            *[F.col(name).alias(f"{role}_{name}") for name in attributes],
        )
        trips = trips.join(fields, key, "left")
    return trips


def top_zones_labelled(trips: DataFrame, zones: DataFrame, k: int = 20) -> DataFrame:
    """The `k` busiest pickup and dropoff locations with their labels, from one scan.

    Trips are counted by id first; only the ranked rows meet the labels.
    """
    by_location = (
        trips.select(F.col("PULocationID").alias("pickup"), F.col("DOLocationID").alias("dropoff"))
        .unpivot([], ["pickup", "dropoff"], "role", "LocationID")
        .where(F.col("LocationID").isNotNull())
        .groupBy("role", "LocationID")
        .agg(F.count(F.lit(1)).alias("trips"))
    )
    busiest = Window.partitionBy("role").orderBy(F.desc("trips"), "LocationID")
    ranked = by_location.withColumn("rank", F.row_number().over(busiest)).where(F.col("rank") <= k)
    labels = checked_dimension(labelled_zones(zones))
    label = F.coalesce("zone_label", F.col("LocationID").cast("string"))
    return (
        ranked.join(labels, "LocationID", "left")
        .select("role", "rank", "LocationID", label.alias("zone_label"), "trips")
        .orderBy(F.desc("role"), "rank")
    )


def _named(counts: DataFrame, zones: DataFrame | None, roles: list[str]) -> DataFrame:
    """Attach zone attributes to counts by id; a stored prepared table has them already."""
    return counts if zones is None else add_zone_attributes(counts, zones, roles)


def top_pickup_zones(trips: DataFrame, zones: DataFrame | None = None, k: int = 20) -> DataFrame:
    """The `k` busiest pickup zones of a prepared table, or of trips with ids and the zones.

    With zones, trips are counted by id and only the counts meet the names.
    """
    key = ["PU_Borough", "PU_Zone"] if zones is None else ["PULocationID"]
    counts = trips.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return (
        _named(counts, zones, ["PU"])
        .groupBy("PU_Borough", "PU_Zone")
        .agg(F.sum("n").alias("trips"))
        .orderBy(F.desc("trips"), F.asc_nulls_last("PU_Borough"), F.asc_nulls_last("PU_Zone"))
        .limit(k)
    )


def top_od_pairs(trips: DataFrame, zones: DataFrame | None = None, k: int = 20) -> DataFrame:
    """The `k` busiest pickup-dropoff pairs with their mean distance and amount.

    Takes a prepared table, or trips with ids and the zones; then trips are counted by the pair of ids.
    """
    key = ["PU_Zone", "DO_Zone"] if zones is None else ["PULocationID", "DOLocationID"]
    measures = ["trip_distance", "total_amount"]
    counts = trips.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(m).alias(f"{m}_sum") for m in measures],
        *[F.count(m).alias(f"{m}_n") for m in measures],
    )
    means = [
        F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_n")).alias(f"avg_{m}") for m in measures
    ]
    return (
        _named(counts, zones, ["PU", "DO"])
        .groupBy("PU_Zone", "DO_Zone")
        .agg(F.sum("n").alias("trips"), *means)
        .orderBy(F.desc("trips"), F.asc_nulls_last("PU_Zone"), F.asc_nulls_last("DO_Zone"))
        .limit(k)
    )
