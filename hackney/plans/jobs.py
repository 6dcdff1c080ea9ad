"""The three jobs of a month and their sequence.

Run one with `python -m hackney.plans.jobs <job> --year Y --month M --root ROOT --source DIR`.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from hackney.operators.cleaning import clean_trips
from hackney.operators.zones import add_zone_attributes
from hackney.session import get_session
from hackney.sources.layout import Layout, run_month_of
from hackney.sources.readers import (
    normalise_zones,
    read_prepared,
    read_trips,
    read_zone_text,
    read_zones,
)
from hackney.sources.writers import (
    create_schema,
    land_trips,
    land_zones,
    publish_table,
    write_prepared,
)

DATABASE = "taxi"
TABLE = "trips_prepared"


def prepare(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Valid trips with time features, integer codes and zone attributes."""
    return add_zone_attributes(clean_trips(trips), zones)


def ingest(spark: SparkSession, lake: Layout, year: int, month: int) -> dict[str, int]:
    """Land one month of trips and the zone lookup; returns the rows written."""
    trips = read_trips(spark, lake.trips_file(year, month))
    zones = normalise_zones(read_zone_text(spark, lake.zones_file))
    return {
        "trips": land_trips(trips, lake.landing(year, month)),
        "zones": land_zones(zones, lake.landing_zones),
    }


def transform(spark: SparkSession, lake: Layout, year: int, month: int) -> int:
    """Prepare one landed month; returns the rows written."""
    trips = read_trips(spark, lake.landing(year, month))
    zones = read_zones(spark, lake.landing_zones)
    return write_prepared(prepare(trips, zones), lake.prepared(year, month))


def publish(spark: SparkSession, lake: Layout, year: int, month: int) -> int:
    """Replace the published table by one prepared month; returns its rows."""
    create_schema(spark, DATABASE, lake.warehouse)
    prepared = read_prepared(spark, lake, year, month)
    return publish_table(prepared, f"{DATABASE}.{TABLE}", f"{lake.warehouse}/{TABLE}")


def run_month(spark: SparkSession, lake: Layout, year: int, month: int) -> dict[str, int]:
    """Ingest, prepare and publish one month; returns the rows of every step."""
    landed = ingest(spark, lake, year, month)
    prepared = transform(spark, lake, year, month)
    published = publish(spark, lake, year, month)
    return {**landed, "prepared": prepared, "published": published}


JOBS = {"ingest": ingest, "transform": transform, "publish": publish, "run": run_month}


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run a job for one month of trips.")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--year", type=int, help="of the month to run; wins over --params")
    parser.add_argument("--month", type=int, help="1 is January; wins over --params")
    parser.add_argument(
        "--params", type=json.loads, default={}, help='JSON such as {"year": 2024, "month": 3}'
    )
    parser.add_argument("--root", required=True, help="Root of the lake, e.g. s3a://bucket")
    parser.add_argument("--source", required=True, help="Folder of the files to ingest")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> None:
    args = parse_args(argv)
    lake = Layout(args.root, args.source)
    given = {name: value for name in ("year", "month") if (value := getattr(args, name)) is not None}
    year, month = run_month_of(given, args.params)  # an invalid month fails before a session starts
    spark = get_session(f"trips-{args.job}")
    print(JOBS[args.job](spark, lake, year, month))
    spark.stop()


if __name__ == "__main__":
    main()
