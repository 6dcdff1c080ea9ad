"""Overwriting a folder or a table so that readers see the old rows or the new ones, never less.

**Folders.** Spark writes to a hidden staging folder within. The files are then moved beside the old ones,
a manifest that lists them with their schema and number of rows is renamed into place, and only then the
old files go. Manifests are numbered and the highest one counts, so that rename is the commit: a write
that is killed before it leaves the folder's rows as they were, one that is killed after it leaves files
that no reader looks at; the next write removes both. Two writers that start from the same manifest
cannot both commit.
Folders without a manifest are read as they are, and programs that know nothing of manifests still find
one month's files under the same path once a write has ended.

**Tables.** Each version is written to a folder of its own. The table's partitions are those of its
folder, not entries of the catalog, so one change of its location publishes a version as a whole.
Earlier versions, and those that a failed write left, are removed afterwards. Where the columns have
changed the definition is replaced instead, without touching files.

One writer at a time is expected per table; of two writers of a folder the later one gives up.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.session import few_listing_tasks, setting

_NUMBER = re.compile(r"_manifest-(\d+)\.json$")
_MARK = "versioned.by"


@dataclass(frozen=True)
class Manifest:
    """What a folder holds: files relative to it, their rows, and all columns with the partition's."""

    number: int
    rows: int
    files: tuple[str, ...]
    schema: T.StructType

    def text(self) -> str:
        fields = {"rows": self.rows, "schema": self.schema.jsonValue(), "files": self.files}
        return json.dumps(fields)

    @staticmethod
    def of(number: int, text: str) -> Manifest:
        fields = json.loads(text)
        schema = T.StructType.fromJson(fields["schema"])
        return Manifest(number, fields["rows"], tuple(fields["files"]), schema)


class _Folder:
    """A folder of any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        here = self._path(self.path)
        self.files: Any = here.getFileSystem(spark._jsc.hadoopConfiguration())
        self.place = self.files.makeQualified(here).toUri().getPath()

    def at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def named(self, pattern: str) -> list[str]:
        return [s.getPath().getName() for s in self.files.globStatus(self.at(pattern)) or []]

    def data_files(self, schema: T.StructType) -> set[str]:
        """Files of data in it, as any reader would list them."""
        if not self.files.exists(self._path(self.path)):
            return set()
        with few_listing_tasks(self.spark):
            return self.names_of(self.spark.read.schema(schema).parquet(self.path))

    def names_of(self, there: DataFrame) -> set[str]:
        """The files that a reader of this folder found."""
        found = there.inputFiles()
        return {urlsplit(unquote(f)).path.removeprefix(self.place).lstrip("/") for f in found}

    def read(self, name: str) -> str:
        stream = self.files.open(self.at(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The whole text or nothing under that name; an error if it is taken."""
        draft = f"_draft-{uuid.uuid4().hex}"
        stream = self.files.create(self.at(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.files.exists(self.at(name)) or not self.files.rename(self.at(draft), self.at(name)):
            self.files.delete(self.at(draft), False)
            raise FileExistsError(f"{name} in {self.path} was written by another run")

    def move(self, staged: str, names: Sequence[str]) -> None:
        """Bring files from a folder within this one to the same places here."""
        parents = {n.rpartition("/")[0] for n in names} - {""}

        def moved(name: str) -> None:
            if not self.files.rename(self.at(f"{staged}/{name}"), self.at(name)):
                raise OSError(f"{staged}/{name} in {self.path} could not be moved")

        with ThreadPoolExecutor(16) as several:
            list(several.map(lambda parent: self.files.mkdirs(self.at(parent)), parents))
            list(several.map(moved, names))

    def remove(self, names: Sequence[str]) -> None:
        with ThreadPoolExecutor(16) as several:
            list(several.map(lambda n: self.files.delete(self.at(n), True), names))

    def remove_files(self, old: set[str], kept: set[str]) -> None:
        """Delete files, whole folders at once where nothing in them is kept."""
        folders = {f.rpartition("/")[0] for f in old} - {f.rpartition("/")[0] for f in kept} - {""}
        self.remove([*folders, *(f for f in old if f.rpartition("/")[0] not in folders)])


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest that counts for a folder, or None if it was written without one."""
    folder = _Folder(spark, path)
    numbers = {int(_NUMBER.search(n)[1]): n for n in folder.named("_manifest-*.json")}
    if not numbers:
        return None
    last = max(numbers)
    return Manifest.of(last, folder.read(numbers[last]))


def _counted(df: DataFrame) -> tuple[DataFrameWriter, Observation]:
    """Counts rows in the write's last stage, once for each task however often it is retried."""
    written = Observation()
    return df.observe(written, F.count(F.lit(1)).alias("rows")).write, written


def _adopted(spark: SparkSession, folder: _Folder) -> Manifest | None:
    """A manifest for files that were written without one, so that they count until the next commit."""
    if not folder.files.exists(folder._path(folder.path)):
        return None
    try:
        there = spark.read.parquet(folder.path)
    except AnalysisException:  # nothing to read a schema from
        return None
    files = tuple(sorted(folder.data_files(there.schema)))
    adopted = Manifest(0, there.count(), files, there.schema)
    folder.write("_manifest-0.json", adopted.text())
    return adopted


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Manifest:
    """Replace the rows of a folder; the manifest tells what was written."""
    spark = df.sparkSession
    folder = _Folder(spark, path)
    earlier = manifest(spark, path) or _adopted(spark, folder)
    strays = folder.named("_staging-*")
    staging = f"_staging-{uuid.uuid4().hex}"
    writer, written = _counted(df)
    writer.partitionBy(*partition_by).parquet(f"{folder.path}/{staging}")
    files = _Folder(spark, f"{folder.path}/{staging}").data_files(df.schema)
    number = earlier.number + 1 if earlier else 0
    new = Manifest(number, written.get["rows"], tuple(sorted(files)), df.schema)
    folder.move(staging, new.files)
    try:
        folder.write(f"_manifest-{number}.json", new.text())
    except FileExistsError:
        folder.remove([*new.files, staging])
        raise
    # A write that was killed left its staging folder, and maybe files that no manifest lists.
    old = folder.data_files(df.schema) if strays else set(earlier.files if earlier else ())
    folder.remove_files(old - files, files)
    folder.remove([n for n in folder.named("_manifest-*.json") if int(_NUMBER.search(n)[1]) < number])
    folder.remove([staging, *strays, *folder.named("_draft-*")])
    return new


def read(spark: SparkSession, path: str, base_path: str | None = None) -> DataFrame:
    """The committed rows of a folder; partition columns above it are found from `base_path`."""
    found = manifest(spark, path)
    reader = spark.read if base_path is None else spark.read.option("basePath", base_path)
    if found is None:
        return reader.parquet(path)
    if not found.files:
        return spark.createDataFrame([], found.schema)
    folder = _Folder(spark, path)
    reader = reader.option("basePath", base_path or folder.path).schema(found.schema)
    with few_listing_tasks(spark):
        whole = reader.parquet(folder.path)
    if folder.names_of(whole) == set(found.files):
        return whole
    return reader.parquet(*[f"{folder.path}/{f}" for f in found.files])


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def publish(df: DataFrame, table: str, path: str, partition_by: Sequence[str]) -> int:
    """Make `df` the whole content of `table`, whose versions lie in `path`; returns its rows."""
    spark = df.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    location = f"{path.rstrip('/')}/{version}"
    writer, written = _counted(df)
    writer.partitionBy(*partition_by).parquet(location)
    _point(spark, table, location, df.schema, partition_by)
    folder = _Folder(spark, path)
    folder.remove([name for name in folder.named("version-*") if name != version])
    return written.get["rows"]


def _point(
    spark: SparkSession, table: str, location: str, schema: T.StructType, partition_by: Sequence[str]
) -> None:
    data = [f for f in schema if f.name not in partition_by]
    ordered = T.StructType([*data, *[schema[name] for name in partition_by]])
    if spark.catalog.tableExists(table):
        properties = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:t)", args={"t": table}).collect()
        ours = any(p.key == _MARK for p in properties)
        if ours and _columns(spark.table(table).schema) == _columns(ordered):
            spark.sql("ALTER TABLE IDENTIFIER(:t) SET LOCATION :l", args={"t": table, "l": location})
            spark.catalog.refreshTable(table)
            return
        spark.sql("DROP TABLE IDENTIFIER(:t)", args={"t": table})
    # Partitions are found in the folder, so that nothing but the location tells which version counts.
    with few_listing_tasks(spark), setting(spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
        columns = ", ".join(f"`{name}` {kind}" for name, kind in _columns(ordered))
        partitions = ", ".join(f"`{name}`" for name in partition_by)
        spark.sql(
            f"CREATE TABLE IDENTIFIER(:t) ({columns}) USING parquet PARTITIONED BY ({partitions})"
            f" LOCATION :l TBLPROPERTIES ('{_MARK}' = 'location')",
            args={"t": table, "l": location},
        )
