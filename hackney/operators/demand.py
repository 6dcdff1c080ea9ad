"""When trips happen: coverage, hours and weekdays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.functions.columns import nan_as_null
from hackney.functions.times import weekday_from_sunday
from hackney.schema import PICKUP


def temporal_coverage(prepared: DataFrame) -> DataFrame:
    return prepared.agg(
        F.min("pickup_date").alias("min_date"),
        F.max("pickup_date").alias("max_date"),
        F.count_distinct("pickup_hour").alias("distinct_hours"),
    )


def hourly_by_date(prepared: DataFrame, limit: int = 100) -> DataFrame:
    """The first `limit` date-hours with their trips and means."""
    return (
        prepared.groupBy("pickup_date", "pickup_hour")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.avg("trip_distance").alias("avg_distance_miles"),
            F.avg("total_amount").alias("avg_total_amount"),
        )
        .orderBy(F.asc_nulls_last("pickup_date"), F.asc_nulls_last("pickup_hour"))
        .limit(limit)
    )


def trips_by_hour(prepared: DataFrame) -> DataFrame:
    return (
        prepared.groupBy("pickup_hour")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.avg("total_amount").alias("avg_total_amount"),
            F.avg("trip_distance").alias("avg_trip_distance"),
        )
        .orderBy(F.asc_nulls_last("pickup_hour"))
    )


def trips_by_weekday(prepared: DataFrame) -> DataFrame:
    """Trips and mean amount by weekday, 0 = Sunday."""
    return (
        prepared.groupBy(weekday_from_sunday(F.col("pickup_date")).alias("dow"))
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.avg("total_amount").alias("avg_total_amount"),
        )
        .orderBy(F.asc_nulls_last("dow"))
    )


def raw_trips_by_hour(trips: DataFrame, ts: str = PICKUP) -> DataFrame:
    """Rows per hour of day of any timestamp column; missing times are their own group, last."""
    return (
        trips.groupBy(F.hour(ts).alias("hour"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .orderBy(F.asc_nulls_last("hour"))
    )


def hourly_mean_filled(
    trips: DataFrame, ts: str = PICKUP, amount: str = "total_amount"
) -> DataFrame:
    """Mean amount for each of the 24 hours, null for an hour without trips."""
    means = (
        trips.where(F.col(ts).isNotNull())
        .groupBy(F.hour(ts).alias("hour"))
        .agg(F.avg(nan_as_null(trips, amount)).alias("mean_amount"))
    )
    hours = trips.sparkSession.range(0, 24, 1, 1).select(F.col("id").cast("int").alias("hour"))
    # At most 24 groups exist, so the broadcast side is bounded whatever the input.
    return hours.join(F.broadcast(means), "hour", "left").orderBy("hour")
