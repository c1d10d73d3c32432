"""The n-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tests.llm import brute, cases

from aislecast.llm import metric_join as M

COLUMNS = ["doc_id", "n_shingles", "component_id", "n_links"]


def plain(docs: list[tuple], size: int, percent: int) -> list[tuple]:
    """Every row a document; pairs that share a shingle are compared."""
    sets = [brute.shingles(t, size) for _, t in docs]
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    parent, links = list(range(len(docs))), [0] * len(docs)

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(sets):
        for j, met in Counter(j for x in s for j in holders[x] if j != k).items():
            if 100 * met >= percent * (len(s) + len(sets[j]) - met):
                links[k] += 1
                parent[root(k)] = root(j)
    low: dict[int, int] = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            low[root(k)] = min(i, low.get(root(k), i))
    return sorted((str(i), len(sets[k]), str(low.get(root(k))), links[k]) for k, (i, _) in enumerate(docs))


def joined(spark, docs: list[tuple], **params) -> list[tuple]:
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = M.similarity_join(frame, M.MetricJoin(**params)).select(COLUMNS).collect()
    return sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in found)


def crowd(n: int, words: int, edits: int, seed: int, first: int = 1000) -> list[tuple]:
    """Edited copies of one text, and edited copies of those."""
    r = random.Random(seed)
    base = cases.prose(words, seed).split()
    out = []
    for k in range(n):
        text = list(out[r.randrange(len(out))] if out and r.random() < 0.3 else base)
        for _ in range(r.randint(0, edits)):
            text[r.randrange(len(text))] = f"w{r.randint(0, 50)}"
        out.append(text)
    return [(first + k, " ".join(t)) for k, t in enumerate(out)]


@pytest.mark.parametrize(
    "params",
    [{}, {"leaf": 8, "pivots": 4, "gain": 1.0}, {"leaf": 8, "gain": 0.0}, {"leaf": 3, "pivots": 2, "gain": 9.0, "levels": 2}],
    ids=["whole", "split", "slices", "copies"],
)
def test_against_all_pairs(spark, request, params):
    docs = cases.texts() + crowd(60, 60, 3, 11) + crowd(40, 90, 12, 12, 2000) + [(3000 + k, cases.prose(30, k)) for k in range(20)]
    docs += docs[25:30]
    # groups and parts land in tasks of their own
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    request.addfinalizer(lambda: spark.conf.unset(coalesce))
    assert joined(spark, docs, shingle=4, percent=85, **params) == plain(docs, 4, 85)


@pytest.mark.parametrize("shingle, percent", [(1, 60), (5, 80), (3, 100)])
def test_other_limits(spark, shingle, percent):
    docs = crowd(50, 30, 4, 21) + [(1, None), (2, "a"), (3, "a b"), (4, "b a")]
    assert joined(spark, docs, shingle=shingle, percent=percent, leaf=8, pivots=4, gain=1.0) == plain(docs, shingle, percent)


def test_table(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    found = M.similarity_join(frame, M.MetricJoin(shingle=4, percent=85)).select(COLUMNS).collect()
    assert sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in found) == plain(docs, 4, 85)


def test_awkward_columns_and_no_rows(spark):
    assert M.similarity_join(cases.awkward(spark)).count() == len(cases.texts())
    none = M.similarity_join(cases.nothing(spark))
    assert none.columns == COLUMNS and none.count() == 0


def test_windows_keep_every_close_pair_once():
    r = np.random.default_rng(4)
    points = r.random((300, 2))
    distance = np.linalg.norm(points[:, None] - points[:9], axis=2)
    document, region, copied = M.windows(distance, 0.05)
    met = Counter()
    for k in range(9):
        own = document[region == k]
        guest = copied[region == k]
        for x in range(len(own)):
            for y in range(x):
                if not (guest[x] and guest[y]):
                    met[min(own[x], own[y]), max(own[x], own[y])] += 1
    assert max(met.values()) == 1
    close = np.argwhere(np.triu(np.linalg.norm(points[:, None] - points, axis=2) <= 0.05, 1))
    assert all(met[x, y] == 1 for x, y in close)
    assert len(document) < 3 * len(points)  # and few are copied
