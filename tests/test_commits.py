from __future__ import annotations

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hackney.sources import commits, readers


def numbered(spark, lo, hi):
    rows = spark.range(lo, hi, 1, 4)
    return rows.select("id", (F.col("id") % 3).cast("int").alias("part"))


def failing(spark):
    """Rows of which the last task's cannot be computed, after others were written."""
    bad = F.when(F.col("id") == 99, F.raise_error("lost")).otherwise(F.col("id"))
    return numbered(spark, 50, 100).withColumn("id", bad.cast("long"))


def ids(df):
    return sorted(r.id for r in df.collect())


def files_of(path):
    return {
        os.path.relpath(os.path.join(top, f), path)
        for top, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


@pytest.fixture
def month(spark, tmp_path):
    path = str(tmp_path / "zone/year=2024/month=01")
    commits.overwrite(numbered(spark, 0, 20), path, ["part"])
    return path


def test_the_manifest_tells_what_was_written(spark, month):
    found = commits.manifest(spark, month)
    assert (found.number, found.rows, set(found.files)) == (0, 20, files_of(month))
    assert found.schema.fieldNames() == ["id", "part"]
    read = commits.read(spark, month)
    assert ids(read) == [*range(20)] and dict(read.dtypes) == {"id": "bigint", "part": "int"}


def test_partitions_above_the_folder(spark, month, tmp_path):
    read = commits.read(spark, month, str(tmp_path / "zone"))
    assert {(r.year, r.month) for r in read.collect()} == {(2024, 1)}
    pruned = read.where("part = 1")
    assert "PartitionFilters: [isnotnull(part" in pruned._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert ids(pruned) == [*range(1, 20, 3)]


def test_a_second_write_replaces_the_first(spark, month):
    commits.overwrite(numbered(spark, 100, 102), month, ["part"])
    assert ids(commits.read(spark, month)) == [100, 101] == ids(spark.read.parquet(month))
    assert not os.path.exists(f"{month}/part=0")  # 100 and 101 are in parts 1 and 2
    assert [n for n in os.listdir(month) if n.startswith("_manifest")] == ["_manifest-1.json"]


def test_a_failing_write_leaves_the_earlier_rows(spark, month):
    with pytest.raises(PySparkException, match="lost"):
        commits.overwrite(failing(spark), month, ["part"])
    assert ids(commits.read(spark, month)) == [*range(20)]


def test_killed_before_the_manifest(spark, month, monkeypatch):
    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(commits._Folder, "write", killed)
        with pytest.raises(KeyboardInterrupt):
            commits.overwrite(numbered(spark, 50, 60), month, ["part"])
    assert len(ids(spark.read.parquet(month))) == 30  # the files are there, but not committed
    assert ids(commits.read(spark, month)) == [*range(20)]
    commits.overwrite(numbered(spark, 70, 80), month, ["part"])
    assert ids(commits.read(spark, month)) == [*range(70, 80)] == ids(spark.read.parquet(month))


def test_killed_over_files_without_a_manifest(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "plain")
    numbered(spark, 0, 5).write.partitionBy("part").parquet(path)
    real = commits._Folder.move

    def killed(*args):
        real(*args)
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(commits._Folder, "move", killed)
        with pytest.raises(KeyboardInterrupt):
            commits.overwrite(numbered(spark, 50, 60), path, ["part"])
    assert ids(commits.read(spark, path)) == [*range(5)] and commits.manifest(spark, path).rows == 5


def test_killed_after_the_manifest(spark, month, monkeypatch):
    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(commits._Folder, "remove_files", killed)
        with pytest.raises(KeyboardInterrupt):
            commits.overwrite(numbered(spark, 50, 60), month, ["part"])
    assert ids(commits.read(spark, month)) == [*range(50, 60)]
    assert commits.manifest(spark, month).rows == 10


def test_the_later_of_two_writers_gives_up(spark, month, monkeypatch):
    real = commits._counted

    def overtaken(df):
        monkeypatch.setattr(commits, "_counted", real)
        commits.overwrite(numbered(spark, 200, 205), month, ["part"])
        return real(df)

    monkeypatch.setattr(commits, "_counted", overtaken)
    with pytest.raises(FileExistsError, match="another run"):
        commits.overwrite(numbered(spark, 50, 60), month, ["part"])
    assert ids(commits.read(spark, month)) == [*range(200, 205)]


def test_folders_without_a_manifest_and_empty_tables(spark, tmp_path):
    plain = str(tmp_path / "plain")
    numbered(spark, 0, 5).write.parquet(plain)
    assert commits.manifest(spark, plain) is None and ids(commits.read(spark, plain)) == [*range(5)]
    single = next(os.path.join(plain, f) for f in os.listdir(plain) if f.endswith(".parquet"))
    assert commits.read(spark, single).columns == ["id", "part"]
    assert commits.overwrite(numbered(spark, 0, 0), plain, ["part"]).rows == 0
    assert ids(commits.read(spark, plain)) == [] and commits.read(spark, plain).columns == ["id", "part"]


@pytest.fixture
def table(spark, tmp_path):
    name = f"published_{abs(hash(str(tmp_path)))}"
    yield name, str(tmp_path / "table")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_publish_replaces_the_table(spark, table):
    name, path = table
    assert commits.publish(numbered(spark, 0, 20), name, path, ["part"]) == 20
    first = spark.table(name)
    assert ids(first) == [*range(20)]
    assert commits.publish(numbered(spark, 30, 34), name, path, ["part"]) == 4
    assert ids(spark.table(name)) == [*range(30, 34)]
    assert ids(spark.table(name).where("part = 1")) == [31]
    assert len(os.listdir(path)) == 1


def test_a_failing_publish_leaves_the_table(spark, table):
    name, path = table
    commits.publish(numbered(spark, 0, 20), name, path, ["part"])
    with pytest.raises(PySparkException, match="lost"):
        commits.publish(failing(spark), name, path, ["part"])
    spark.catalog.refreshTable(name)
    assert ids(spark.table(name)) == [*range(20)]
    commits.publish(numbered(spark, 1, 3), name, path, ["part"])
    assert ids(spark.table(name)) == [1, 2] and len(os.listdir(path)) == 1


def test_publish_with_other_columns_or_over_another_table(spark, table):
    name, path = table
    numbered(spark, 0, 9).write.partitionBy("part").option("path", f"{path}-other").saveAsTable(name)
    commits.publish(numbered(spark, 0, 5), name, path, ["part"])
    assert ids(spark.table(name)) == [*range(5)]
    wider = numbered(spark, 0, 7).withColumn("more", F.lit("x"))
    commits.publish(wider, name, path, ["part"])
    assert spark.table(name).columns == ["id", "more", "part"] and spark.table(name).count() == 7


def test_many_directories_are_listed_by_few_tasks(spark, tmp_path):
    """Of a folder, as written and as read, and of a table."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    context = spark.sparkContext
    context.setJobGroup("listing", "")
    rows = spark.range(0, 100, 1, 2).select("id", F.col("id").alias("part"))
    try:
        commits.overwrite(rows, str(tmp_path / "folder"), ["part"])
        assert ids(commits.read(spark, str(tmp_path / "folder"))) == [*range(100)]
        commits.publish(rows, "many_directories", str(tmp_path / "table"), ["part"])
        assert ids(readers.read_table(spark, "many_directories")) == [*range(100)]
        assert spark.conf.get(key) == "10000"
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set(key, before)
        spark.sql("DROP TABLE IF EXISTS many_directories")
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("listing")]
    tasks = [tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds]
    assert tasks and max(tasks) <= 4 * context.defaultParallelism
