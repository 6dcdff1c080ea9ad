"""Sinks. Each replaces its target as a whole, so a repeated run leaves the same data and a failed one
leaves the earlier data; see `commits`. Rows are counted while they are written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hackney.sources import commits


def land_trips(trips: DataFrame, path: str) -> int:
    """Copy a month of trips unchanged."""
    return commits.overwrite(trips, path).rows


def land_zones(zones: DataFrame, path: str) -> int:
    """Write the zone lookup, a small dimension, as one file."""
    return commits.overwrite(zones.coalesce(1), path).rows


def write_prepared(prepared: DataFrame, path: str) -> int:
    """Write one directory per pickup date, replacing the whole month.

    Rebalancing lets AQE merge the few rows of stray dates into one task and split dates that are
    larger than the advisory partition size over several.
    """
    by_date = prepared.hint("rebalance", "pickup_date")
    return commits.overwrite(by_date, path, ["pickup_date"]).rows


def create_schema(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(
        "CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name) LOCATION :location",
        args={"name": name, "location": location},
    )


def publish_table(prepared: DataFrame, table: str, path: str) -> int:
    """Make `prepared` the content of `table`, whose versions lie in `path`.

    Input that is read by date directory is written without a shuffle.
    """
    return commits.publish(prepared, table, path, ["pickup_date"])
