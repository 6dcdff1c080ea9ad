from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.sources import commits, drift
from hackney.sources.layout import Layout
from tests.conftest import plan_of


def kinds(schema):
    return {f.name: f.dataType.simpleString() for f in schema}


@pytest.mark.parametrize(
    "one, other, both",
    [
        ("int", "int", "int"), ("int", "bigint", "bigint"), ("smallint", "int", "int"), ("int", "double", "double"),
        ("bigint", "double", "double"), ("float", "double", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
        ("timestamp_ntz", "timestamp", "timestamp"), ("int", "decimal(8,2)", "decimal(12,2)"),
        ("bigint", "decimal(38,10)", "decimal(38,10)"), ("bigint", "decimal(38,25)", "double"), ("void", "int", "int"), ("int", "string", "string"),
        ("double", "date", "string"), ("boolean", "int", "string"),
    ],
)
def test_common_types(spark, one, other, both):
    a, b = (spark.sql(f"SELECT CAST(NULL AS {k}) AS v" if k != "void" else "SELECT NULL AS v").schema["v"].dataType for k in (one, other))
    assert drift.widened(a, b).simpleString() == both == drift.widened(b, a).simpleString()


def test_names_compare_without_case():
    integer, text, double, date = T.IntegerType(), T.StringType(), T.DoubleType(), T.DateType()
    schemas = [T.StructType().add("A", integer).add("b", text), T.StructType().add("a", double).add("C", date)]
    assert kinds(drift.reconciled(schemas)) == {"A": "double", "b": "string", "C": "date"}


@pytest.fixture
def lake(tmp_path):
    return Layout(str(tmp_path / "lake"), str(tmp_path / "source"))


def month(spark, code, fee="Airport_fee"):
    return spark.range(6).select(F.col("id"), (F.col("id") % 3).cast(code).alias("code"), F.lit(1.5).alias(fee))


def scans(df):
    return plan_of(df).count("FileScan parquet")


def test_integers_and_doubles_are_one_scan(spark, lake):
    commits.overwrite(month(spark, "int"), lake.landing(2024, 1))
    commits.overwrite(month(spark, "double", "airport_fee"), lake.landing(2024, 2))
    both = drift.read_landed(spark, lake, [(2024, 1), (2024, 2)])
    assert kinds(both.schema) == {"id": "bigint", "code": "double", "Airport_fee": "double", "year": "int", "month": "int"}
    assert scans(both) == 1
    rows = sorted((r.month, r.id, r.code, r.Airport_fee) for r in both.collect())
    assert rows == [(m, i, float(i % 3), 1.5) for m in (1, 2) for i in range(6)]


def test_what_the_reader_cannot_widen_is_cast(spark, lake):
    commits.overwrite(month(spark, "bigint"), lake.landing(2024, 1))
    commits.overwrite(month(spark, "double"), lake.landing(2024, 2))
    commits.overwrite(month(spark, "string").drop("Airport_fee"), lake.landing(2024, 3))
    two = drift.read_landed(spark, lake, [(2024, 1), (2024, 2)])
    assert scans(two) == 2 and two.schema["code"].dataType == T.DoubleType()
    assert sorted(r.code for r in two.where("month = 1").collect()) == [0.0, 0.0, 1.0, 1.0, 2.0, 2.0]
    three = drift.read_landed(spark, lake, [(2024, 1), (2024, 2), (2024, 3)])
    assert three.schema["code"].dataType == T.StringType() and three.count() == 18
    assert three.where("Airport_fee IS NULL").count() == 6


def test_a_month_prunes_the_others(spark, lake):
    for m, code in ((1, "int"), (2, "double"), (3, "bigint")):
        commits.overwrite(month(spark, code), lake.landing(2024, m))
    one = drift.read_landed(spark, lake, [(2024, m) for m in (1, 2, 3)]).where("month = 2")
    assert plan_of(one).count("PartitionFilters: [isnotnull(month") == 2 and one.count() == 6
    assert {p.rsplit("month=")[1][:2] for p in one.select(F.input_file_name().alias("f")).distinct().toPandas().f} == {"02"}


def test_files_of_one_folder_that_differ(spark, lake):
    path = lake.landing(2024, 1)
    month(spark, "int").write.parquet(path)
    month(spark, "double").write.mode("append").parquet(path)
    month(spark, "string").drop("id").write.mode("append").parquet(path)
    read = drift.read_landed(spark, lake, [(2024, 1)])
    assert kinds(read.schema)["code"] == "string" and read.count() == 18
    assert read.where("id IS NULL").count() == 6 and {r.year for r in read.collect()} == {2024}


def test_prepared_months(spark, lake):
    for m, code in ((1, "int"), (2, "double")):
        dated = month(spark, code).withColumn("pickup_date", F.expr(f"DATE '2024-0{m}-05' + cast(id % 2 AS INT)"))
        commits.overwrite(dated, lake.prepared(2024, m), ["pickup_date"])
    both = drift.read_prepared(spark, lake, [(2024, 1), (2024, 2)])
    assert scans(both) == 1 and both.where("pickup_date = DATE '2024-02-06'").count() == 3
    assert kinds(both.schema)["pickup_date"] == "date"


def test_nothing_to_read(spark, lake):
    commits.overwrite(month(spark, "int").limit(0).withColumn("p", F.lit(1)), lake.landing(2024, 1), ["p"])
    with pytest.raises(FileNotFoundError, match="nothing to read"):
        drift.read_landed(spark, lake, [(2024, 1)])
