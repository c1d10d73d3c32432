"""Land event streams in the raw zone, by day and without duplicate rows.

Each micro-batch writes one folder with its days, and below each day a level by
hash of the duplicate key: ``<zone>/<stream>/batch=<query>-7/date=2025-06-01/part=3``.
Rows that have landed already are left out, so the zone holds every distinct row
once; to know them, a batch reads only the days and parts its own keys fall in.

A record next to the folders says which of them count (see ``sources.versions``),
which batches they hold, and how many rows. It changes in one step when a batch's
files are complete. So a batch that dies leaves nothing to readers, one that runs
again after its commit does nothing, and small folders can be rewritten as one
(:meth:`Landing.compact`) while others read. The query's id, which lasts as long as
its checkpoint, keeps batches of different queries apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislecast.contracts import POS_EVENT, SHELF_EVENT
from aislecast.functions.dates import event_day
from aislecast.session import stage
from aislecast.sources.readers import parse_events
from aislecast.sources.versions import Conflict, Record, children, delete
from aislecast.sources.writers import gather_days, write_by_date

# Topics, and the raw-zone tables they land in.
TOPICS = {"pos-events": "sales_events", "iot-stock-events": "iot_stock_events"}
SCHEMAS = {"sales_events": POS_EVENT, "iot_stock_events": SHELF_EVENT}


def batch_name(spark: SparkSession, batch: int, run: str = "run") -> str:
    """Names a batch of the running query for good."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or run
    return f"{query}-{batch}"


def with_day(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Add the day; NULL if the event's time does not begin with one."""
    day = event_day(F.col(ts).cast("string"))
    return events.withColumn("date", day.try_cast("date"))


def route(messages: DataFrame, topics: Iterable[str]) -> dict[str, DataFrame]:
    """The messages of each topic; other topics are left out."""
    return {topic: messages.filter(F.col("topic") == topic) for topic in topics}


def not_landed(new: DataFrame, landed: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Distinct new rows that are not there yet. Missing values are equal."""
    fresh = new.dropDuplicates(list(keys))
    if landed is None:
        return fresh
    plain = [k for k in keys if k not in ("date", "part")]
    there = landed.select("date", "part", *[F.col(k).alias(f"_there_{k}") for k in plain])
    same = (F.col("n.date") == F.col("t.date")) & (F.col("n.part") == F.col("t.part"))
    for k in plain:
        same &= F.col(f"n.{k}").eqNullSafe(F.col(f"t._there_{k}"))
    return fresh.alias("n").join(there.alias("t"), same, "left_anti")


def merge_rows(
    existing: DataFrame, new: DataFrame, keys: Sequence[str] | None = None
) -> DataFrame:
    """Existing and new rows together, each distinct row once."""
    both = existing.unionByName(new, allowMissingColumns=True)
    return both.dropDuplicates(list(keys)) if keys else both.distinct()


@dataclass
class Landing:
    """Lands one or several streams; usable as ``foreachBatch`` function.

    ``parts`` is the number of hash parts below a day: one for days of a file or
    two, more for large days, so that a small batch reads few of their rows.
    ``lateness``, as in "2 days", bounds what duplicates are looked for among: events
    older than the newest landed one by more are kept aside with the reason
    "late". What breaks the contract or has no day is kept aside as "broken".
    Without it any lateness lands.
    """

    zone: str
    schemas: Mapping[str, T.StructType] = field(default_factory=lambda: dict(SCHEMAS))
    keys: Mapping[str, Sequence[str]] = field(default_factory=dict)
    ts: str = "ts"
    run: str = "run"
    parts: int = 1
    lateness: str | None = None

    def path(self, stream: str) -> str:
        return f"{self.zone}/{stream}"

    def record(self, stream: str) -> Record:
        return Record(self.path(stream))

    def _key(self, stream: str) -> list[str]:
        return list(self.keys.get(stream) or [f.name for f in self.schemas[stream]])

    def _rows(self, spark: SparkSession, stream: str, folders: list[dict], days: Sequence[str] | None = None) -> DataFrame | None:
        """Rows of some folders, at least those of the named days; None if there are none."""
        base = self.path(stream)
        names = []
        for f in folders:
            held = f["days"] if days is None else [d for d in f["days"] if d in days]
            folder = f"{base}/batch={f['name']}"
            # a path for each day where they are few; else the folder, which is listed at once
            names += [f"{folder}/date={d}" for d in held] if 4 * len(held) < len(f["days"]) else [folder]
        if not names:
            return None
        more = [T.StructField("date", T.DateType()), T.StructField("part", T.IntegerType())]
        full = T.StructType([*self.schemas[stream].fields, T.StructField("batch", T.StringType()), *more])
        return spark.read.schema(full).option("basePath", base).parquet(*names)

    def land(self, events: DataFrame, stream: str, batch: int) -> dict[str, int]:
        """One stream's rows of one micro-batch; rows landed and kept aside, as the writes counted them."""
        spark = events.sparkSession
        query, _, number = batch_name(spark, batch, self.run).rpartition("-")
        for attempt in range(5):
            base, state = self.record(stream).read(spark)
            if int(number) <= state.get("last", {}).get(query, -1):
                return {"landed": 0, "aside": 0}
            try:
                return self._land(events, stream, f"{query}-{number}", base, state)
            except Conflict:  # another query or a compaction committed meanwhile
                if attempt == 4:
                    raise
        raise AssertionError

    def _land(self, events: DataFrame, stream: str, name: str, base: int, state: dict) -> dict[str, int]:
        spark = events.sparkSession
        names = [f.name for f in self.schemas[stream]]
        corrupt = F.col("_corrupt_record") if "_corrupt_record" in events.columns else F.lit(None)
        rows = with_day(events.withColumn("_corrupt", corrupt.cast("string")), self.ts)
        second = F.unix_seconds(F.coalesce(F.col(self.ts).cast("string").try_cast("timestamp"), F.col("date").cast("timestamp")))
        reason = F.when(F.col("_corrupt").isNotNull() | F.col("date").isNull(), "broken")
        if self.lateness is not None and state.get("newest") is not None:
            least = F.unix_seconds(F.timestamp_seconds(F.lit(state["newest"])) - F.expr(f"interval {self.lateness}"))
            reason = reason.when(second < least, "late")
        rows = rows.withColumn("_reason", reason)
        # What does not land is kept next to the table, under the batch's own
        # folder, so that no event is lost.
        whole = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
        aside = Observation()
        rows.filter("_reason IS NOT NULL").select(F.coalesce("_corrupt", whole).alias("value"), F.col("_reason").alias("reason")).observe(
            aside, F.count(F.lit(1)).alias("rows")
        ).write.mode("overwrite").partitionBy("reason").text(f"{self.zone}/_quarantine/{stream}/batch={name}")

        keys = self._key(stream)
        part = F.pmod(F.xxhash64(*keys), F.lit(self.parts)).cast("int")
        rows = rows.filter("_reason IS NULL").select(*names, "date", part.alias("part"), second.alias("_second"))
        # Days and parts limit the scan of what is there: a batch touches few
        # days, and there are never more than days in the calendar.
        folders = state.get("folders", [])
        landed = None
        if folders:
            touched = rows.groupBy("date").agg(F.collect_set("part").alias("parts")).collect()
            landed = self._rows(spark, stream, folders, {r["date"].isoformat() for r in touched})
            parts = {p for r in touched for p in r["parts"]}
            if landed is not None:
                days = [r["date"] for r in touched]
                landed = landed.filter(F.col("date").between(min(days), max(days)))
                landed = landed.filter(F.col("part").isin(sorted(parts))) if len(parts) < self.parts else landed
        fresh = not_landed(rows, landed, [*keys, "date", "part"])
        # Behind the exchange, in the tasks that write: what runs again after a
        # lost executor is not counted again.
        seen = Observation()
        (
            gather_days(fresh)
            .observe(seen, F.count(F.lit(1)).alias("rows"), F.max("_second").alias("newest"))
            .drop("_second")
            .write.option("partitionOverwriteMode", "static")
            .partitionBy("date", "part")
            .mode("overwrite")
            .parquet(f"{self.path(stream)}/batch={name}")
        )
        query, _, number = name.rpartition("-")
        found = seen.get
        newest = max((n for n in (state.get("newest"), found["newest"]) if n is not None), default=None)
        self.record(stream).commit(
            spark,
            base,
            {
                "folders": folders + self._folder(spark, stream, name, found["rows"]),
                "last": state.get("last", {}) | {query: int(number)},
                "newest": newest,
                "aside": state.get("aside", 0) + aside.get["rows"],
            },
        )
        return {"landed": found["rows"], "aside": aside.get["rows"]}

    def _folder(self, spark: SparkSession, stream: str, name: str, rows: int) -> list[dict]:
        days = [d.removeprefix("date=") for d in children(spark, f"{self.path(stream)}/batch={name}") if d.startswith("date=")]
        return [{"name": name, "days": days, "rows": rows}] if days else []

    def compact(self, spark: SparkSession, stream: str, small: int = 1_000_000) -> int:
        """Rewrite the folders of fewer rows as one; returns how many there were.

        Folders become larger each time, so a row is rewritten as often as the
        logarithm of the zone. The old files stay for readers of older versions
        until :meth:`expire`.
        """
        base, state = self.record(stream).read(spark)
        old = [f for f in state.get("folders", []) if f["rows"] < small]
        if len(old) < 2:
            return 0
        name = f"compact-{uuid.uuid4().hex[:12]}"
        seen = Observation()
        (
            gather_days(self._rows(spark, stream, old).drop("batch"))
            .observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.partitionBy("date", "part")
            .parquet(f"{self.path(stream)}/batch={name}")
        )
        made = self._folder(spark, stream, name, seen.get["rows"])
        gone = {f["name"] for f in old}
        while True:  # batches may have landed meanwhile; what was rewritten is still there
            kept = [f for f in state["folders"] if f["name"] not in gone]
            try:
                self.record(stream).commit(spark, base, state | {"folders": made + kept})
                return len(old)
            except Conflict:
                base, state = self.record(stream).read(spark)
                if not gone <= {f["name"] for f in state["folders"]}:
                    raise

    def expire(self, spark: SparkSession, stream: str) -> int:
        """Delete folders that the newest version does not hold; not while a batch or a reader is at work."""
        used = {f"batch={f['name']}" for f in self.record(stream).read(spark)[1].get("folders", [])}
        gone = [n for n in children(spark, self.path(stream)) if n.startswith("batch=") and n not in used]
        for n in gone:
            delete(spark, f"{self.path(stream)}/{n}")
        return len(gone)

    def counts(self, spark: SparkSession) -> DataFrame:
        """stream, landed, partitions and aside of every stream, as the writes counted them: no row is read."""
        rows = []
        for stream in self.schemas:
            state = self.record(stream).read(spark)[1]
            folders = state.get("folders", [])
            days = {d for f in folders for d in f["days"]}
            rows.append((stream, sum(f["rows"] for f in folders), len(days), state.get("aside", 0)))
        return spark.createDataFrame(rows, "stream string, landed long, partitions long, aside long")

    def one(self, stream: str):
        """Batch function of a single stream."""

        def run(events: DataFrame, batch: int) -> None:
            events.persist()
            try:
                self.land(events, stream, batch)
            finally:
                events.unpersist()

        return run

    def routed(self, topics: Mapping[str, str] = TOPICS):
        """Batch function of a message source with (topic, value)."""

        def run(messages: DataFrame, batch: int) -> None:
            messages.persist()
            try:
                for topic, mine in route(messages, topics).items():
                    stream = topics[topic]
                    self.land(parse_events(mine, self.schemas[stream]), stream, batch)
            finally:
                messages.unpersist()

        return run

    def quarantined(self, spark: SparkSession, stream: str) -> DataFrame:
        """The events kept aside, as text with the reason; count it to watch a source."""
        path = f"{self.zone}/_quarantine/{stream}"
        schema = "value string, reason string"
        batches = [f"{path}/{n}" for n in children(spark, path) if n.startswith("batch=")]
        if not any(n.startswith("reason=") for b in batches for n in children(spark, b)):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema + ", batch string").text(path).select("value", "reason")

    def read(self, spark: SparkSession, stream: str) -> DataFrame:
        """The landed rows of a stream, each distinct row once, with its day."""
        rows = self._rows(spark, stream, self.record(stream).read(spark)[1].get("folders", []))
        if rows is None:
            full = T.StructType([*self.schemas[stream].fields, T.StructField("date", T.DateType())])
            return spark.createDataFrame([], full)
        return rows.drop("batch", "part")


def drain(source: DataFrame, run, checkpoint: str) -> None:
    """Process everything that is there, then stop."""
    query = (
        source.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def bounded_dedupe(events: DataFrame, ts: str, keys: Sequence[str], lateness: str) -> DataFrame:
    """Duplicates dropped inside a lateness bound, with bounded state.

    The alternative to comparing with the landed table.
    """
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def refresh_days(daily_rollup, raw: DataFrame, days: Sequence, path: str) -> None:
    """Recompute the daily roll-up of the given days and replace only those.

    A day that comes out without rows loses its folder, so no old result stays,
    also where it still has raw rows. The raw rows are read once.
    """
    days = list(days)
    spark = raw.sparkSession
    made = stage(daily_rollup(raw.filter(F.col("date").isin(days))), "refreshed-days")
    write_by_date(made, path)
    for day in set(days) - {r["date"] for r in made.select("date").distinct().collect()}:
        delete(spark, f"{path}/date={day}")
