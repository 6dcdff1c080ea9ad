"""Trips and zones as a view of the given tables, since those hold no trip records.

Every line item is one trip. Orders, customers and suppliers are looked up by their unique keys with
left joins, which neither add nor drop trips, so only the tables that the wanted columns come from
are joined. Orders and customers meet first: line items, the largest table, are then shuffled once
for both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_START = "l_partkey * 7 % 1440"
_PICKUP = f"o_orderdate + make_dt_interval(0, 0, CAST({_START} AS INT), 0)"
_END = f"{_START} + l_orderkey % 360 - 10"
_DROPOFF = f"o_orderdate + make_dt_interval(0, 0, CAST({_END} AS INT), 0)"

# Column -> (expression, tables it needs beside lineitem)
_COLUMNS: dict[str, tuple[str, set[str]]] = {
    "VendorID": ("CAST(l_suppkey % 2 + 1 AS INT)", set()),
    "tpep_pickup_datetime": (_PICKUP, {"orders"}),
    "tpep_dropoff_datetime": (
        f"CASE WHEN l_orderkey % 97 <> 0 THEN {_DROPOFF} END",
        {"orders"},
    ),
    "passenger_count": ("CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS DOUBLE) END", set()),
    "trip_distance": ("l_quantity * 2.5D - 5.0D", set()),
    "RatecodeID": (
        "CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 13 = 0 THEN 99.0D "
        "ELSE CAST(l_partkey % 6 + 1 AS DOUBLE) END",
        set(),
    ),
    "store_and_fwd_flag": ("l_returnflag", set()),
    # Some ids are shifted out of the zones, so that trips without a zone exist.
    "PULocationID": (
        "CASE WHEN l_orderkey % 23 = 0 THEN c_nationkey + 1000 ELSE c_nationkey END",
        {"orders", "customer"},
    ),
    "DOLocationID": (
        "CASE WHEN l_orderkey % 29 = 0 THEN s_nationkey + 1000 ELSE s_nationkey END",
        {"supplier"},
    ),
    "payment_type": ("CAST(substr(o_orderpriority, 1, 1) AS INT)", {"orders"}),
    "fare_amount": ("l_extendedprice / 200.0D - 10.0D", set()),
    "mta_tax": ("l_tax * 10.0D", set()),
    "tip_amount": ("l_extendedprice * l_discount / 200.0D", set()),
    "total_amount": ("l_extendedprice / 200.0D - 10.0D + l_tax * 10.0D", set()),
}
TRIP_COLUMNS = list(_COLUMNS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] | None = None,
    repeated: bool = False,
) -> DataFrame:
    """All trips with the wanted columns; `repeated` adds a second copy of some."""
    wanted = TRIP_COLUMNS if columns is None else list(columns)
    needed = set().union(*[_COLUMNS[name][1] for name in wanted])
    lines = table(spark, sf_dir, "lineitem")
    if repeated:
        lines = lines.unionAll(lines.where("l_orderkey % 50 = 0"))
    if "orders" in needed:
        orders = table(spark, sf_dir, "orders")
        if "customer" in needed:
            customers = table(spark, sf_dir, "customer")
            orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "supplier" in needed:
        suppliers = table(spark, sf_dir, "supplier")
        lines = lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return lines.select(*[F.expr(_COLUMNS[name][0]).alias(name) for name in wanted])


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    service = F.when(F.col("n_nationkey") % 2 == 0, "A").otherwise("B")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        service.alias("service_zone"),
    )
