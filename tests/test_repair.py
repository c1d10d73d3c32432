"""Versioned tables, and the dense table after late, changed and emptied days."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aislecast.operators import curate, repair
from aislecast.session import stage
from aislecast.sources.versions import Conflict, VersionedTable, children

KEYS = curate.KEYS
DAILY = "store_id string, sku string, date date, qty_sold long, revenue double, avg_price double"
SHELF = "store_id string, sku string, date date, avg_shelf_qty double"
START = dt.date(2024, 11, 20)


def daily_rows(seed: int, stores: int = 4, skus: int = 5, days: int = 70, density: float = 0.08) -> dict:
    r = random.Random(seed)
    out = {}
    for s in range(stores):
        for k in range(skus):
            for d in range(days):
                if r.random() < density * (k != 3 or s == 1):
                    price = None if r.random() < 0.1 else float(r.randint(2, 9))
                    out[f"S{s}", f"K{k}", START + dt.timedelta(d)] = (r.randint(1, 9), 1.5 * r.randint(1, 9), price)
    return out


def frame(spark, rows: dict, ddl: str = DAILY):
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], ddl)


def rows_of(df) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*KEYS, *sorted(set(df.columns) - set(KEYS))).collect())


def edits(rows: dict, kind: str) -> dict:
    out, days = dict(rows), sorted({k[2] for k in rows})
    first, last = days[0], days[-1]
    if kind == "late":
        out["S0", "K1", START + dt.timedelta(15)] = (3, 4.5, 7.0)
        out["S2", "K1", START + dt.timedelta(40)] = (3, 4.5, None)
    elif kind == "changed":
        for n, k in enumerate(sorted(rows)):
            if n % 17 == 0:
                out[k] = (rows[k][0] + 1, rows[k][1], None if n % 2 else 8.0)
    elif kind == "emptied":
        out = {k: v for k, v in rows.items() if k[2] not in days[8:11] and k[2] not in (first, last)}
    elif kind == "longer":
        out["S0", "K0", last + dt.timedelta(3)] = (1, 2.0, 3.0)
        out["S0", "K0", first - dt.timedelta(2)] = (1, 2.0, 4.0)
    elif kind == "members":
        out = {k: v for k, v in rows.items() if k[1] != "K4"}
        out["S9", "K1", START + dt.timedelta(30)] = (1, 2.0, 5.0)
        out["S0", "K8", START + dt.timedelta(31)] = (1, 2.0, 5.0)
    return out


@pytest.mark.parametrize("kind", ["late", "changed", "emptied", "longer", "members", "none"])
@pytest.mark.parametrize("rules", [{}, {"partition_by_store": True}, {"pairs": "observed"}], ids=["fill", "store", "observed"])
def test_repaired_equals_rebuilt(spark, tmp_path, kind, rules):
    old_rows = daily_rows(5)
    old = stage(frame(spark, old_rows), "old")
    new = stage(frame(spark, edits(old_rows, kind)), "new")
    table = repair.dense_table(str(tmp_path / "dense"), 4)
    table.write(curate.densify(old, **rules))
    before = table.record.read(spark)[1]["parts"]
    spans = [tuple(r) for r in repair.touched_spans(old, new, **rules).collect()]
    version = repair.repair_dense(table, old, new, **rules)
    assert rows_of(table.read(spark)) == rows_of(curate.densify(new, **rules))
    assert rows_of(table.read(spark, 0)) == rows_of(curate.densify(old, **rules))
    assert version == (0 if kind == "none" else 1)
    if kind == "late":
        # only parts that hold a touched day are written, and spans end at the next own price
        after = table.record.read(spark)[1]["parts"]
        same = [p for p in before if before[p] == after.get(p)]
        assert len(same) > len(before) / 3
        own = sorted(k[2] for k, v in old_rows.items() if k[:2] == ("S0", "K1") and v[2] is not None and k[2] > START + dt.timedelta(15))
        assert ("S0", "K1", START + dt.timedelta(15), own[0] - dt.timedelta(1)) in spans
        assert ("S2", "K1", START + dt.timedelta(40), START + dt.timedelta(40)) in spans


def test_shelf_changes_touch_their_day(spark, tmp_path):
    daily = stage(frame(spark, daily_rows(6)), "daily")
    shelf = {k: (float(n % 20),) for n, k in enumerate(sorted(daily_rows(7)))}
    other = {k: (v[0] + (n % 9 == 0),) for n, (k, v) in enumerate(shelf.items()) if n % 11}
    old, new = (stage(frame(spark, s, SHELF), "shelf") for s in (shelf, other))
    sentiment = spark.createDataFrame([("K0", 0.5)], "sku string, sentiment_score double")
    table = repair.dense_table(str(tmp_path / "dense"), 3)
    table.write(curate.densify(daily, old, sentiment))
    repair.repair_dense(table, daily, daily, old, new, sentiment)
    assert rows_of(table.read(spark)) == rows_of(curate.densify(daily, new, sentiment))


def test_readers_see_committed_versions_only(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), ("k",), 4)
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    one = spark.range(20).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    table.write(one)
    staged = table.stage(one.withColumn("v", F.lit(2)))  # a writer that dies before it commits
    assert {r["v"] for r in table.read(spark).collect()} == {1}
    base, _ = table.record.read(spark)
    table.write(table.read(spark).withColumn("v", F.col("v") + 10))  # reads what it replaces
    assert {r["v"] for r in table.read(spark).collect()} == {11}
    with pytest.raises(Conflict):
        table.commit(spark, base, staged, one.schema)
    assert {r["v"] for r in table.read(spark).collect()} == {11}
    assert {r["v"] for r in table.read(spark, 0).collect()} == {1}
    assert table.expire(spark, keep=1) == 8 and table.read(spark).count() == 20
    assert not [n for n in children(spark, f"{table.root}/_versions") if n.startswith(".")]


def test_merge_rewrites_only_buckets_with_changed_keys(spark, tmp_path):
    table = VersionedTable(str(tmp_path / "t"), ("k",), 32)
    one = spark.range(500).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit(0).alias("v"))
    table.merge(one)
    before = table.record.read(spark)[1]["parts"]
    new = spark.createDataFrame([(7, 1), (7, 2), (None, 3), (900, 4)], "k long, v int")
    table.merge(new, "v")
    after = table.record.read(spark)[1]["parts"]
    touched = table.touched(new)
    assert {p for p in after if before.get(p) != after[p]} == set(touched) and len(touched) <= 3
    got = {r["k"]: r["v"] for r in table.read(spark).collect()}
    assert len(got) == 501 and {k: v for k, v in got.items() if v} == {7: 2, None: 3, 900: 4}
    table.merge(new, "v")
    assert {r["k"]: r["v"] for r in table.read(spark).collect()} == got
