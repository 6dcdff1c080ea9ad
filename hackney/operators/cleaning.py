"""From raw trips to valid trips with time features and normalised codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.functions.columns import present
from hackney.functions.times import whole_minutes_between, whole_seconds_between
from hackney.schema import CODE_COLUMNS, DROPOFF, PICKUP


def keep_valid(trips: DataFrame) -> DataFrame:
    """Trips with both timestamps, no negative distance or total, and a positive duration.

    The first four conditions reach the Parquet scan. NaN compares greatest, so it passes.
    """
    pickup, dropoff = F.col(PICKUP), F.col(DROPOFF)
    return trips.where(
        pickup.isNotNull()
        & dropoff.isNotNull()
        & (F.col("trip_distance") >= 0)
        & (F.col("total_amount") >= 0)
        & (whole_seconds_between(pickup, dropoff) > 0)
    )


def derive_features(trips: DataFrame) -> DataFrame:
    """Add dates, pickup hour, duration in minutes and average speed."""
    pickup, dropoff = F.col(PICKUP), F.col(DROPOFF)
    minutes = F.col("trip_duration_min")
    return trips.withColumns(
        {
            "pickup_date": F.to_date(pickup),
            "pickup_hour": F.hour(pickup),
            "dropoff_date": F.to_date(dropoff),
            "trip_duration_min": whole_minutes_between(pickup, dropoff),
        }
    ).withColumn("avg_mph", F.when(minutes > 0, F.col("trip_distance") / (minutes / F.lit(60.0))))


def normalise_codes(trips: DataFrame) -> DataFrame:
    """Codes as integers where the column exists; what does not fit an integer becomes null."""
    return trips.withColumns(
        {name: F.col(name).try_cast("int") for name in present(trips, CODE_COLUMNS)}
    )


def clean_trips(trips: DataFrame) -> DataFrame:
    """All of the above: prepared trips before their zones are attached."""
    return normalise_codes(derive_features(keep_valid(trips)))
