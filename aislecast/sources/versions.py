"""Tables in committed versions.

A table is a folder of files that are never changed, and a record of which of
them count. A writer first writes new files to a folder of its own; the version
appears in one step, by renaming the finished record to the next number. Readers
take the greatest number, so they see a version whole or not at all, and a writer
that dies earlier leaves nothing but unused files. Of two writers that began from
one version the second finds its number taken and is refused.

The rename must not replace an existing file, as on HDFS and local disks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislecast.operators.upsert import upsert

KEPT_RECORDS = 20


class Conflict(RuntimeError):
    """Another writer committed first."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs = _fs(spark, path)
    if not fs.exists(_path(spark, path)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, path)))


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


@dataclass(frozen=True)
class Record:
    """The numbered records of a table below one folder."""

    root: str

    def _folder(self) -> str:
        return f"{self.root}/_versions"

    def numbers(self, spark: SparkSession) -> list[int]:
        return [int(n) for n in children(spark, self._folder()) if n.isdigit()]

    def read(self, spark: SparkSession, number: int | None = None) -> tuple[int, dict]:
        """The newest version, or one that is named: its number and state; (-1, {}) before the first."""
        if number is None:
            number = max(self.numbers(spark), default=-1)
        if number < 0:
            return -1, {}
        name = f"{self._folder()}/{number:010d}"
        stream = _fs(spark, name).open(_path(spark, name))
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return number, json.loads(text)

    def commit(self, spark: SparkSession, base: int, state: dict) -> int:
        """Make the state the version after base, in one step."""
        fs = _fs(spark, self.root)
        draft = f"{self._folder()}/.{uuid.uuid4().hex}"
        stream = fs.create(_path(spark, draft), True)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        name = f"{self._folder()}/{base + 1:010d}"
        jvm = spark._jvm
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, self.root).toUri(), spark._jsc.hadoopConfiguration())
        no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(_path(spark, draft), _path(spark, name), no_options)
        except Exception as error:
            delete(spark, draft)
            if "FileAlreadyExists" in str(error):
                raise Conflict(f"version {base + 1} of {self.root} was committed by another writer") from None
            raise
        for old in self.numbers(spark):
            if old <= base + 1 - KEPT_RECORDS:
                delete(spark, f"{self._folder()}/{old:010d}")
        return base + 1


@dataclass(frozen=True)
class VersionedTable:
    """A table in parts, each replaced as a whole; ``keys`` and ``day`` say which part a row belongs to.

    A part is a bucket of the keys' hash, and inside it a month of ``day`` if one
    is named. Without keys there is one part (or one a month).
    """

    root: str
    keys: tuple[str, ...] = ()
    buckets: int = 1
    day: str | None = None

    @property
    def record(self) -> Record:
        return Record(self.root)

    def part(self) -> Column:
        """The part of a row, as text."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)) if self.keys else F.lit(0)
        text = F.lpad(bucket.cast("string"), 6, "0")
        if self.day is None:
            return text
        return F.concat_ws("-", F.coalesce(F.date_format(self.day, "yyyyMM"), F.lit("none")), text)

    def stage(self, df: DataFrame) -> dict[str, str]:
        """Write rows to a folder of their own, that no reader sees: part -> folder."""
        spark = df.sparkSession
        name = f"data/{uuid.uuid4().hex}"
        (
            df.withColumn("_part", self.part())
            .hint("rebalance", "_part")
            .write.partitionBy("_part")
            .parquet(f"{self.root}/{name}")
        )
        return {p.removeprefix("_part="): f"{name}/{p}" for p in children(spark, f"{self.root}/{name}") if p.startswith("_part=")}

    def commit(self, spark: SparkSession, base: int, parts: dict[str, str], schema: T.StructType) -> int:
        return self.record.commit(spark, base, {"parts": parts, "schema": schema.jsonValue()})

    def write(self, df: DataFrame) -> int:
        """All rows anew, as the next version; df may read the present one."""
        base, _ = self.record.read(df.sparkSession)
        return self.commit(df.sparkSession, base, self.stage(df), df.schema)

    def replace(self, df: DataFrame, parts: Sequence[str], base: int) -> int:
        """Rows of some parts anew; the other parts keep their files. Parts without rows go."""
        spark = df.sparkSession
        _, state = self.record.read(spark, base)
        new = self.stage(df)
        if beyond := set(new) - set(parts):
            raise ValueError(f"rows of other parts: {sorted(beyond)[:5]}")
        kept = {p: folder for p, folder in state.get("parts", {}).items() if p not in set(parts)}
        return self.commit(spark, base, kept | new, df.schema)

    def read(self, spark: SparkSession, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of the newest version or of one that is named; of some parts only if they are."""
        number, state = self.record.read(spark, version)
        if number < 0:
            raise FileNotFoundError(f"no committed version in {self.root}")
        schema = T.StructType.fromJson(state["schema"])
        held = state["parts"] if parts is None else {p: state["parts"][p] for p in parts if p in state["parts"]}
        folders = [f"{self.root}/{folder}" for folder in held.values()]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def touched(self, rows: DataFrame) -> list[str]:
        """The parts the rows belong to."""
        return sorted(r["p"] for r in rows.select(self.part().alias("p")).distinct().collect())

    def merge(self, new: DataFrame, order: str | None = None) -> int:
        """Last-wins merge by the keys: only parts that hold a new row's key are read and written."""
        spark = new.sparkSession
        base, _ = self.record.read(spark)
        if base < 0:
            empty = spark.createDataFrame([], new.schema)
            return self.write(upsert(empty, new, self.keys, order))
        parts = self.touched(new)
        old = self.read(spark, base, parts)
        return self.replace(upsert(old, new, self.keys, order), parts, base)

    def expire(self, spark: SparkSession, keep: int = 2) -> int:
        """Delete what only older versions than the last ones use, and what dead writers left.

        Returns the folders deleted. Not to be called while a writer is at work.
        """
        numbers = self.record.numbers(spark)
        used = {f for n in numbers[-keep:] for f in self.record.read(spark, n)[1]["parts"].values()}
        gone = 0
        for name in children(spark, f"{self.root}/data"):
            for part in children(spark, f"{self.root}/data/{name}"):
                if part.startswith("_part=") and f"data/{name}/{part}" not in used:
                    delete(spark, f"{self.root}/data/{name}/{part}")
                    gone += 1
        for n in numbers[:-keep]:
            delete(spark, f"{self.root}/_versions/{n:010d}")
        return gone
