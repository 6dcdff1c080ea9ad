from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


SMALL = "/root/testdata/sf0.001"

# The documented column layout of the monthly trip files.
RAW_TRIPS = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
    ]
)

# The documented column layout of the zone lookup.
ZONES = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "4")
        .config("spark.checkpoint.dir", str(base / "shared"))
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


# One valid trip of an hour and six miles; tests override what they are about.
TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": at("2024-01-05 08:00:00"),
    "tpep_dropoff_datetime": at("2024-01-05 09:00:00"),
    "passenger_count": 1.0,
    "trip_distance": 6.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 3.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 24.5,
    "congestion_surcharge": 0.0,
    "Airport_fee": None,
}


@pytest.fixture
def make_trips(spark):
    def make(*overrides: dict, without: tuple[str, ...] = ()) -> DataFrame:
        rows = [tuple({**TRIP, **o}[f.name] for f in RAW_TRIPS) for o in overrides]
        return spark.createDataFrame(rows, RAW_TRIPS).drop(*without)

    return make


@pytest.fixture
def zones(spark) -> DataFrame:
    rows = [(1, "Manhattan", "Soho", "Yellow Zone"), (2, "Queens", "Astoria", "Boro Zone")]
    return spark.createDataFrame(rows, ZONES)
