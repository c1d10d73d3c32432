"""Hard negatives against a search of all rows, and the certified ends of the walks."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from aislecast.llm import hard_negatives as H

NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<double>, label int, rank string, score string, lane string, cluster string"


def plain(rows: list[tuple], every: int = 100, d: int | None = None) -> list[tuple]:
    """The same by Python integers."""
    good = [
        (i, label, [int(np.floor(x * 256)) for x in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and (d is None or len(v) == d) and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for a, label, u in good:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(u, v, strict=True)), i, other) for i, other, v in good if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            low = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(low)]
    return sorted(out)


def mined(spark, rows: list[tuple], every: int = 100, **params) -> list[tuple]:
    frame = spark.createDataFrame([(*r, *("clash",) * 4) for r in rows], SCHEMA)
    found = H.mine(frame, F.col("vec_id") % every == 0, H.HardNegatives(**params)).select(NAMES)
    return sorted(tuple(r) for r in found.collect())


def vectors(n: int, d: int, seed: int, groups: int = 0) -> list[tuple]:
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d))
    if groups:
        x = 6 * r.normal(size=(groups, d))[np.arange(n) % groups] + 0.3 * x
    return [(i, v, int(k)) for i, (v, k) in enumerate(zip(x.tolist(), r.integers(0, 4, n), strict=True))]


@pytest.mark.parametrize("params", [{}, {"pack": 3, "block_values": 64, "step": 5, "clusters": 3}])
def test_against_plain(spark, params):
    rows = vectors(700, 6, 1)
    assert mined(spark, rows, 20, **params) == plain(rows, 20)


def test_table(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.select("vec_id", "embedding", "label").collect()]
    found = H.mine(frame, F.col("vec_id") % 100 == 0).select(NAMES)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows)


def test_awkward_rows(spark):
    ties = [(i, [1.0, 0.5, 0.0], i % 3) for i in range(0, 40)]
    odd = [
        (None, [1.0, 1.0, 1.0], 1),
        (50, None, 1),
        (51, [1.0, None, 1.0], 1),
        (52, [float("nan"), 0.0, 1.0], 1),
        (53, [float("inf"), 0.0, 1.0], 1),
        (54, [1.0, 1.0, 1.0], None),
        (60, [0.0, 0.0, 0.0], 1),
        (61, [-1.0, -1.0, -1.0], 1),
        (62, [4e4, 1.0, -3e4], 0),
    ]
    assert mined(spark, ties + odd, 20) == plain(ties + odd, 20)
    # vectors of another length than most, and components whose scores fit no 64 bits
    more = [(70, [1.0, 2.0], 1), (71, [], 1), (72, [1e30, 0.0, 0.0], 1)]
    assert mined(spark, ties + odd + more, 20) == plain(ties + odd, 20)
    # repeated rows count once; of one id the greatest label counts
    assert mined(spark, ties + ties + [(0, [1.0, 0.5, 0.0], -1)], 20) == plain(ties, 20)


def test_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(0, [], 1), (100, [], 2)]) == []


def test_walks_end_early_where_anchors_are_close():
    rows = vectors(4000, 8, 5, groups=16)
    x = np.floor(256 * np.array([v for _, v, _ in rows])).astype(np.int32)
    ids, labels = np.arange(len(x)), np.array([k for _, _, k in rows])
    own = np.flatnonzero(ids % 16 == 3)[:40]
    anchors, block = H.Side(ids[own], labels[own], x[own]), H.Side(ids, labels, x)
    p = H.HardNegatives()
    centroid = (x[own] / np.linalg.norm(x[own], axis=1)[:, None]).mean(0)
    best, looked = H.nearest_of_label(anchors, block, centroid, p)
    assert looked < 0.5 * len(own) * len(x)
    s = H.scores(anchors.x, block.x)
    s[(labels[own, None] != labels) | (own[:, None] == ids)] = H.NONE
    order = np.lexsort((np.broadcast_to(ids, s.shape), -s), axis=1)[:, : p.positives]
    assert (best.id == order).all()
    below, looked = H.nearest_below(anchors, block, centroid, best.score, p)
    assert looked < 0.7 * len(own) * len(x)
    assert (below.score <= np.repeat(best.score.ravel(), p.negatives).reshape(below.score.shape)).all()


def test_no_bound_is_below_a_score():
    rows = vectors(500, 5, 9)
    x = np.floor(256 * np.array([v for _, v, _ in rows])).astype(np.int32)
    ids, labels = np.arange(500), np.zeros(500, np.int64)
    anchors = H.Side(ids[:30], labels[:30], x[:30])
    for centroid in (x[:30].mean(0).astype(float), np.zeros(5)):
        walk = H.SharedList(anchors, H.Side(ids, labels, x), centroid)
        s = H.scores(anchors.x, x)[:, walk.order]
        assert all((walk.reach(k) >= s[:, k:].max(1)).all() for k in range(0, 500, 13))


def test_large_components_stay_exact():
    u = np.array([[30_000_000, 1], [3, -30_000_000]], np.int32)
    assert H.scores(u, u).tolist() == [[int(a) for a in row] for row in (u.astype(object) @ u.T.astype(object))]


def test_packs_are_neither_broadcast_nor_copied(spark):
    """However small their table: a copy for every block would be a broadcast by the product of both."""
    frame = spark.createDataFrame([(*r, *("clash",) * 4) for r in vectors(300, 6, 3)], SCHEMA)
    plan = H.mine(frame, F.col("vec_id") % 20 == 0, H.HardNegatives(block_values=64))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Generate" not in plan
