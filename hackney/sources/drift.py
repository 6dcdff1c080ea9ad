"""Folders and files of different months read as one table, although their schemas drift.

A column may be an integer in one month and a double in another, be spelled with other capitals, or be
absent. The types found in the footers are reconciled: each column gets the narrowest type that holds
all of them. Spark's Parquet reader widens many types by itself, so all files of which that is true are
one scan with one schema; files that it cannot widen are a scan a schema, whose columns are cast. Every
file is read once, and predicates on partition columns prune all scans alike.

Whole numbers beside doubles become doubles, which hold them exactly up to 2**53. Types without a common
one become text. Columns are in the order of their first appearance, under that spelling.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.sources import commits
from hackney.sources.layout import Layout

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    places = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}.get(type(kind))
    return None if places is None else (places, 0)


def widened(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    kinds = (one, other)
    if all(isinstance(k, _WHOLE) for k in kinds):
        return max(kinds, key=lambda k: _WHOLE.index(type(k)))
    if all(isinstance(k, _TIMES) for k in kinds):
        return max(kinds, key=lambda k: _TIMES.index(type(k)))
    if any(isinstance(k, (T.FloatType, T.DoubleType)) for k in kinds):
        numbers = (*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType)
        return T.DoubleType() if all(isinstance(k, numbers) for k in kinds) else T.StringType()
    places = [_digits(k) for k in kinds]
    if None not in places:
        before, after = (max(p[i] for p in places) for i in (0, 1))
        return T.DecimalType(before + after, after) if before + after <= 38 else T.DoubleType()
    return T.StringType()


def reconciled(schemas: Sequence[T.StructType]) -> T.StructType:
    """One schema for all: names compare without case, as Spark's do."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            known = fields.setdefault(field.name.lower(), T.StructField(field.name, field.dataType))
            fields[field.name.lower()] = T.StructField(known.name, widened(known.dataType, field.dataType))
    return T.StructType([*fields.values()])


def _widened_by_scan(have: T.DataType, want: T.DataType) -> bool:
    """Whether the Parquet reader gives `want` for a column stored as `have`."""
    if have == want:
        return True
    if isinstance(have, (T.ByteType, T.ShortType, T.IntegerType)):
        return isinstance(want, (*_WHOLE, T.DoubleType)) and (
            isinstance(want, T.DoubleType) or _WHOLE.index(type(have)) < _WHOLE.index(type(want))
        )
    return isinstance(have, T.FloatType) and isinstance(want, T.DoubleType)


def _parts(spark: SparkSession, path: str) -> list[tuple[list[str], T.StructType]]:
    """Files or folders to read together, with the schema of their footers."""
    committed = commits.manifest(spark, path)
    if committed is not None:
        root = path.rstrip("/")
        return [([f"{root}/{f}" for f in committed.files], committed.schema)]
    try:
        return [([path], spark.read.option("mergeSchema", True).parquet(path).schema)]
    except (PySparkException, Py4JJavaError) as error:  # of the driver or of a task
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    # The files within differ in types: each by its own footer.
    files = spark.read.parquet(path).inputFiles()
    inner = spark.read.parquet(path).schema
    with ThreadPoolExecutor(16) as several:
        footers = [*several.map(lambda f: spark.read.parquet(f).schema, files)]
    folders = [f for f in inner if f.name.lower() not in {c.name.lower() for s in footers for c in s}]
    return [([f], T.StructType([*s, *folders])) for f, s in zip(files, footers, strict=True)]


def read_together(spark: SparkSession, paths: Sequence[str], base_path: str | None = None) -> DataFrame:
    """All rows of the given files and folders under one reconciled schema.

    Partition columns above the folders are found from `base_path`.
    """
    parts = [part for path in paths for part in _parts(spark, path) if part[0]]
    if not parts:
        raise FileNotFoundError(f"nothing to read in {list(paths)}")
    target = reconciled([schema for _, schema in parts])
    kinds = {f.name.lower(): f.dataType for f in target}
    scans: dict[str, tuple[list[str], T.StructType]] = {}
    for files, schema in parts:
        native = all(_widened_by_scan(f.dataType, kinds[f.name.lower()]) for f in schema)
        key, read_as = ("", target) if native else (schema.json(), schema)
        scans.setdefault(key, ([], read_as))[0].extend(files)
    reader = spark.read if base_path is None else spark.read.option("basePath", base_path)
    frames = []
    for files, schema in scans.values():
        frame = reader.schema(schema).parquet(*files)
        there = {c.lower(): c for c in frame.columns}
        own = [
            (F.col(f"`{there[f.name.lower()]}`") if f.name.lower() in there else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target
        ]
        above = [F.col(f"`{c}`") for low, c in there.items() if low not in kinds]
        frames.append(frame.select(*own, *above))
    return reduce(DataFrame.unionByName, frames)


def read_landed(spark: SparkSession, lake: Layout, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Landed months with their `year` and `month`."""
    return read_together(spark, [lake.landing(*m) for m in months], lake.landing_root)


def read_prepared(spark: SparkSession, lake: Layout, months: Sequence[tuple[int, int]]) -> DataFrame:
    """Prepared months with their `year`, `month` and `pickup_date`."""
    return read_together(spark, [lake.prepared(*m) for m in months], lake.prepared_root)
