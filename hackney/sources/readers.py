"""Sources: monthly trip files, the zone lookup, the prepared zone and the published table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.session import few_listing_tasks
from hackney.sources import commits
from hackney.sources.layout import Layout


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Trips as they lie in the file or folder; the schema may differ from month to month."""
    return commits.read(spark, path)


def read_zone_text(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup as text columns named by its header."""
    try:
        return spark.read.option("header", True).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no zone lookup under {path}") from error
        raise


def normalise_zones(zones: DataFrame) -> DataFrame:
    """Integer ids; an id that is no number becomes null. The other columns are text as read."""
    return zones.withColumn("LocationID", F.col("LocationID").try_cast("int"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """The landed zone lookup."""
    return commits.read(spark, path)


def read_prepared(spark: SparkSession, lake: Layout, year: int, month: int) -> DataFrame:
    """One prepared month, with `year`, `month` and `pickup_date` recovered from the path."""
    return commits.read(spark, lake.prepared(year, month), lake.prepared_root)


def read_table(spark: SparkSession, table: str = "taxi.trips_prepared") -> DataFrame:
    with few_listing_tasks(spark):
        return spark.table(table)
