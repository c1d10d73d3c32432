"""Session helpers: a local session for tests and the shared stage folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
# What is staged goes on this list, if there is one: (path, table or None).
_LISTED: ContextVar[list[tuple[str, str | None]] | None] = ContextVar("staged", default=None)


def local_session(app: str = "aislecast", cpus: str | int = "*") -> SparkSession:
    """A single-machine session with the settings the tests and bench use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master without the setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="aislecast-")
        spark.sparkContext.setCheckpointDir(_LOCAL_DIRS[app])
    return _LOCAL_DIRS[app]


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path for one stage table of this application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/aislecast/{app}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def listing(made: list[tuple[str, str | None]]) -> Iterator[None]:
    """Put the stage tables made inside on a list, for :func:`release`."""
    token = _LISTED.set(made)
    try:
        yield
    finally:
        _LISTED.reset(token)


def _list(path: str, table: str | None = None) -> None:
    made = _LISTED.get()
    if made is not None:
        made.append((path, table))


def release(spark: SparkSession, made: list[tuple[str, str | None]]) -> None:
    """Remove listed stage tables; nothing that reads them may run any more."""
    while made:
        path, table = made.pop()
        if table is not None:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a stage result as a table and go on from the table.

    Cuts the lineage at a durable, columnar copy: consumers prune columns and
    push filters into it, and a lost executor does not recompute the stage.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    _list(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(
    df: DataFrame, name: str, keys: list[str], order: list[str], codec: str = "snappy"
) -> DataFrame:
    """As :func:`stage`, hash-bucketed by the keys and sorted inside buckets.

    Windows and aggregations by the keys then run on the stored partitioning,
    without moving the rows again. There are as many buckets as shuffle
    partitions, so rows that arrive partitioned by the keys give one file each.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    database = "aislecast_stage"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{shared_dir(spark)}/{database}'")
    table = f"{database}.{path.rsplit('/', 1)[1].replace('-', '_')}"
    _list(path, table)
    (
        df.write.format("parquet")
        .option("path", path)
        .option("compression", codec)
        .bucketBy(shuffle_partitions(spark), *keys)
        .sortBy(*order)
        .saveAsTable(table)
    )
    return spark.table(table)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
