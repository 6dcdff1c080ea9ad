"""Spark session settings and the shared folder for tables kept between passes."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def object_store_settings(env: Mapping[str, str]) -> dict[str, str]:
    """S3A client settings from the environment; empty when no endpoint is given."""
    endpoint = env.get("S3_ENDPOINT_URL")
    if not endpoint:
        return {}
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.aws.credentials.provider": (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        ),
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": env["AWS_ACCESS_KEY_ID"],
        "spark.hadoop.fs.s3a.secret.key": env["AWS_SECRET_ACCESS_KEY"],
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }


def get_session(app_name: str, env: Mapping[str, str] = os.environ) -> SparkSession:
    """The session of a job. Master and sizes come from spark-submit, secrets from `env`."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in object_store_settings(env).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    Where that is unset, a folder beside the warehouse, which executors write to as well; on a cluster
    that must not be a folder of one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.conf.get("spark.master", None) or "local"
    if re.match(r"file:|/", warehouse) and not re.match(r"local(\[|$)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse + "-scratch"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds within the block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def few_listing_tasks(spark: SparkSession):
    """Within the block, folders of many directories are listed by a few tasks a core, not by one task each."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    few = min(int(spark.conf.get(key)), 4 * spark.sparkContext.defaultParallelism)
    return setting(spark, key, str(few))


def small_batches(spark: SparkSession):
    """Within the block, jobs hand about 4 MB at once to Python: a batch lies in memory several times, in the
    executor and in each of its Python workers."""
    return setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", "4m")


@lru_cache(maxsize=8)
def _cleared_at_end(spark: SparkSession, folder: str) -> str:
    """Make the folder and have the file system delete it when the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses; it goes when the application ends."""
    application = spark.sparkContext.applicationId
    folder = _cleared_at_end(spark, f"{shared_dir(spark)}/hackney/{application}")
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    For inputs that several passes read and that are dear to compute. The result is a plain Parquet
    scan: it survives lost executors, prunes columns, and gives the planner real table sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    if _scopes:
        _scopes[-1].append(path)
        staged.staged_path = path
    return staged


_scopes: list[list[str]] = []


@contextmanager
def stages_dropped(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables staged within the block at its end, but for those passed to what it gives.

    What is returned from the block may read only tables that are kept, or others' tables.
    """
    paths: list[str] = []
    kept: set[str] = set()

    def keep(staged: DataFrame) -> DataFrame:
        kept.add(staged.staged_path)
        return staged

    _scopes.append(paths)
    try:
        yield keep
    finally:
        _scopes.pop()
        if _scopes:
            _scopes[-1].extend(kept)
        for path in set(paths) - kept:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
