"""Hash level, compaction, bounded lateness and counts of the landing zone."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislecast.sources.versions import Conflict, Record, children
from aislecast.streaming import landing

EVENT = T.StructType([T.StructField(n, t) for n, t in (("id", T.LongType()), ("ts", T.StringType()), ("v", T.DoubleType()))])


def events(spark, first: int, last: int, day: int = 1):
    rows = spark.range(first, last).select("id", F.format_string("2025-03-%02d 10:00:%02d", F.lit(day), F.col("id") % 60).alias("ts"))
    return rows.withColumn("v", F.col("id") / 2)


def zone(tmp_path, **more) -> landing.Landing:
    return landing.Landing(str(tmp_path / "zone"), {"e": EVENT}, keys={"e": ["id"]}, **more)


def rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()))


def test_a_batch_reads_only_the_parts_of_its_keys(spark, tmp_path):
    land = zone(tmp_path, parts=8)
    days = [events(spark, 100 * d, 100 * d + 100, d) for d in range(1, 10)]
    land.land(days[0].unionByName(days[1]).unionByName(days[2]).unionByName(days[3]).unionByName(days[4]), "e", 0)
    seen = {}
    plain = landing.not_landed

    def spy(new, landed, keys):
        seen["files"] = {tuple(f.split("/")[-3:-1]) for f in landed.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
        seen["keys"] = {(f"date={r['date']}", f"part={r['part']}") for r in new.select("date", "part").distinct().collect()}
        return plain(new, landed, keys)

    landing.not_landed = spy
    try:
        counts = land.land(events(spark, 240, 242, 2).unionByName(events(spark, 900, 901, 9)), "e", 1)
    finally:
        landing.not_landed = plain
    assert counts == {"landed": 1, "aside": 0}
    assert {f[0] for f in seen["files"]} == {"date=2025-03-02"}
    assert {f[1] for f in seen["files"]} <= {k[1] for k in seen["keys"]} and len(seen["files"]) <= 3


def test_compaction_changes_no_row_and_rewrites_small_folders_only(spark, tmp_path):
    land = zone(tmp_path, parts=2)
    land.land(events(spark, 0, 500), "e", 0)
    for k in range(1, 5):
        land.land(events(spark, 500 + 10 * k, 510 + 10 * k, k), "e", k)
    before = rows(land.read(spark, "e"))
    old = land.read(spark, "e")
    assert land.compact(spark, "e", small=100) == 4
    assert rows(land.read(spark, "e")) == before == rows(old)
    folders = Record(land.path("e")).read(spark)[1]["folders"]
    assert sorted(f["rows"] for f in folders) == [40, 500] and land.compact(spark, "e", small=100) == 0
    # batches that ran before are known, and new ones find rows of rewritten folders
    assert land.land(events(spark, 500, 520), "e", 3) == {"landed": 0, "aside": 0}
    assert land.land(events(spark, 510, 520), "e", 5)["landed"] == 0
    assert land.expire(spark, "e") >= 4 and rows(land.read(spark, "e")) == before


def test_a_dead_batch_leaves_nothing_and_runs_again(spark, tmp_path):
    land = zone(tmp_path)
    land.land(events(spark, 0, 5), "e", 0)
    commit = Record.commit
    Record.commit = lambda *a: (_ for _ in ()).throw(OSError("lost"))
    try:
        with pytest.raises(OSError):
            land.land(events(spark, 5, 9), "e", 1)
    finally:
        Record.commit = commit
    assert land.read(spark, "e").count() == 5
    assert land.land(events(spark, 5, 9), "e", 1)["landed"] == 4
    assert land.read(spark, "e").count() == 9 and land.counts(spark).first()["landed"] == 9


def test_two_queries_that_land_at_once_lose_no_row(spark, tmp_path):
    one, two = zone(tmp_path), zone(tmp_path, run="other")
    commit, once = Record.commit, []

    def late(self, *args):
        if not once:
            once.append(1)
            two.land(events(spark, 3, 8), "e", 0)
        return commit(self, *args)

    Record.commit = late
    try:
        assert one.land(events(spark, 0, 5), "e", 0)["landed"] == 3
    finally:
        Record.commit = commit
    assert [r[0] for r in rows(one.read(spark, "e"))] == list(range(8))


def test_compaction_beside_a_batch(spark, tmp_path):
    land = zone(tmp_path)
    for k in range(3):
        land.land(events(spark, 10 * k, 10 * k + 10), "e", k)
    commit, once = Record.commit, []

    def late(self, *args):
        if not once:
            once.append(1)
            land.land(events(spark, 25, 40), "e", 3)
        return commit(self, *args)

    Record.commit = late
    try:
        assert land.compact(spark, "e") == 3
    finally:
        Record.commit = commit
    assert [r[0] for r in rows(land.read(spark, "e"))] == list(range(40))
    with pytest.raises(Conflict):
        land.record("e").commit(spark, 0, {})


def test_too_late_events_are_kept_aside(spark, tmp_path):
    land = zone(tmp_path, lateness="2 days")
    assert land.land(events(spark, 0, 4, 10), "e", 0) == {"landed": 4, "aside": 0}
    more = events(spark, 4, 6, 9).unionByName(events(spark, 6, 9, 5)).unionByName(events(spark, 0, 2, 10))
    broken = spark.createDataFrame([(99, "never", 1.0)], EVENT)
    assert land.land(more.unionByName(broken), "e", 1) == {"landed": 2, "aside": 4}
    aside = rows(land.quarantined(spark, "e").select("reason", F.get_json_object("value", "$.id").cast("int")))
    assert aside == [("broken", 99), ("late", 6), ("late", 7), ("late", 8)]
    assert [r[0] for r in rows(land.read(spark, "e"))] == [0, 1, 2, 3, 4, 5]
    assert land.counts(spark).first().asDict() == {"stream": "e", "landed": 6, "partitions": 2, "aside": 4}
    # a batch that runs again keeps its rows aside once
    land.land(more, "e", 1)
    assert land.quarantined(spark, "e").count() == 4


def test_an_empty_batch(spark, tmp_path):
    land = zone(tmp_path)
    assert land.land(events(spark, 0, 0), "e", 0) == {"landed": 0, "aside": 0}
    assert land.read(spark, "e").count() == 0 and land.quarantined(spark, "e").count() == 0
    assert children(spark, str(tmp_path / "nowhere")) == [] and land.compact(spark, "e") == 0
