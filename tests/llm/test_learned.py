"""Classifiers, search, orders and segmentations against plain versions and held-out labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aislecast.llm import multi_index, nbest, pu_quality, toxicity, training_order
from aislecast.llm.queries import QUERIES
from tests.llm.cases import awkward, labels, no_labels, nothing, texts


def _accuracy(spark, sf_dir, name, column):
    truth = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return QUERIES[name](spark, sf_dir).join(truth, "doc_id").withColumn("truth", F.col(column)).toPandas()


def test_quality(spark):
    found = _accuracy(spark, "/root/testdata/sf0.01", "op5_quality", "quality")
    held = found[found.held_out]
    assert len(held) > 30 and (held.truth == held.predicted).mean() > 0.95
    assert found.score.between(0, 1).all()


def test_prior():
    """The estimated prior is near the true share, and the risk needs no negatives."""
    rng = np.random.default_rng(5)
    positive, negative = rng.normal(1.5, 1, (3000, 4)), rng.normal(-1.5, 1, (3000, 4))
    unlabelled = np.concatenate([positive[:1400], negative[:600]])
    model, prior = pu_quality.fit_pu(positive[1500:], rng.permutation(unlabelled), pu_quality.Quality())
    assert abs(prior - 0.7) < 0.1
    assert (model.value(positive[1400:1500]) > 0).mean() > 0.95
    assert (model.value(negative[600:]) < 0).mean() > 0.95


def test_toxicity(spark):
    found = _accuracy(spark, "/root/testdata/sf0.1", "op9_toxicity", "toxic")
    held = found[found.held_out]
    assert held[held.truth == 1].predicted.mean() > 0.8
    assert held[held.truth == 0].predicted.mean() < 0.02
    assert held[held.predicted == 1].evidence.map(len).min() > 0


def _index(seed=2, examples=300, terms=40, **params):
    rng = np.random.default_rng(seed)
    # four languages with terms of their own, and some that all share
    tongue = np.arange(examples) % 4
    places = [
        np.unique(np.concatenate([terms * (1 + t) + rng.choice(terms, rng.integers(1, 9)), rng.choice(terms, 2)])) for t in tongue
    ]
    counts = [rng.integers(1, 5, len(p)) for p in places]
    own = rng.integers(0, 2, examples).astype(float)
    idf = rng.random(5 * terms) + 0.5
    p = toxicity.Neighbours(**{"block": 16, "dense": 0.05} | params)
    index = toxicity.Index(places, counts, own, np.ones(examples), np.arange(examples), idf, p, 2.0)
    return index, places, counts


@pytest.mark.parametrize("params", [{}, {"dense": 1.0}, {"dense": 0.0}, {"first": 1, "block": 4}, {"nearest": 500}])
def test_block_max_search_is_exact(params):
    index, places, counts = _index(**params)
    dense = np.zeros((len(places), len(index.idf)))
    for e, (p, n) in enumerate(zip(places, counts, strict=True)):
        dense[index.slot[e], p] = index.vector(p, n)
    index.visited = 0
    for e in range(40):
        query = index.vector(places[e], counts[e] + 1, 3.0)
        near, cosine = index.search(places[e], query)
        plain = dense[:, places[e]] @ query
        order = np.lexsort((index.ids, -np.round(plain, 12)))[: index.p.nearest]
        order = order[plain[order] > 0]
        assert near.tolist() == order.tolist() and np.allclose(cosine, plain[order])
    if not params:
        # blocks whose bound is too low are not visited
        assert index.visited < 0.8 * 40 * index.blocks


def test_no_example_finds_itself():
    index, places, counts = _index()
    queries = [index.vector(p, n) for p, n in zip(places, counts, strict=True)]
    for e, (near, _) in enumerate(index.search_all(places, queries, index.slot)):
        assert index.slot[e] not in near


def test_toxic_cosines_are_those_of_the_texts(spark):
    """Evidence of the whole operator against TF-IDF cosines counted word by word."""
    import math
    import re
    from collections import Counter

    rng = np.random.default_rng(8)
    word = lambda: "".join("bcdfgklmnp"[int(c)] for c in f"{rng.integers(0, 300):03d}")
    rows = [(k, " ".join(word() for _ in range(int(rng.integers(3, 40)))).replace("b", "B", 1) + " 12, x!") for k in range(120)]
    known = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    p = toxicity.Neighbours(modulus=1, held_out=1, prefixes=(), stress=(0.0,), nearest=5, block=4)
    found = {r.doc_id: r.evidence for r in toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), known, p).collect()}
    counts = {k: Counter(re.findall("[a-z]+", t.lower())) for k, t in rows}
    df = Counter(w for c in counts.values() for w in c)
    vocabulary = {w for k in range(60) for w in counts[k]}
    idf = lambda w: 1 + math.log((1 + len(rows)) / (1 + (df[w] if w in vocabulary else 0)))
    vector = {k: {w: (1 + math.log(n)) * idf(w) for w, n in c.items()} for k, c in counts.items()}
    length = {k: math.sqrt(sum(x * x for x in v.values())) for k, v in vector.items()}
    for k, _ in rows:
        cosine = {e: sum(x * vector[e].get(w, 0) for w, x in vector[k].items()) / length[k] / length[e] for e in range(60)}
        order = sorted(cosine, key=lambda e: (-round(cosine[e], 12), e))[:5]
        assert [e for e in order if cosine[e] > 0] == found[k]


def test_rare_toxic_words_tell(spark):
    """Terms of few toxic examples, and beyond the 512 strongest, still bring a document to its example."""
    def filler(k):
        return " ".join(f"w{'abcdefghij'[(k * 7 + j * 3) % 10]}{'klmnopqrst'[(k + j * j) % 10]}" for j in range(12))

    word = lambda k: "".join("abcdefghij"[int(c)] for c in f"{k:05d}") + "zz"
    # 600 tell-tale words of two toxic examples each; texts of no label have one each
    rows = [(k, filler(k) + (f" {word(k // 2)}" * 2 if k < 1200 else "")) for k in range(3600)]
    asked = [(10_000 + k, filler(k + 5) + f" {word(k)}" * 2) for k in range(0, 600, 6)]
    docs = spark.createDataFrame(rows + asked, "doc_id long, text string")
    known = spark.createDataFrame([(k, int(k < 1200)) for k in range(3600)], "doc_id long, toxic int")
    p = toxicity.Neighbours(modulus=1, held_out=1)
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs, known, p).filter("doc_id >= 10000").collect()}
    assert all({2 * (i - 10_000), 2 * (i - 10_000) + 1} <= set(r.evidence[:2]) for i, r in found.items())
    assert sum(r.predicted for r in found.values()) > 90


def test_index_is_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(k, f"word{'abcdefgh'[k % 8]} " * 200) for k in range(400)], "doc_id long, text string")
    known = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    p = toxicity.Neighbours(modulus=1, held_out=1, index_bytes=100_000)
    sample, rates = toxicity._sampled(docs, known, p, "toxic")
    assert 0 < sample.agg(F.sum(F.octet_length("text"))).first()[0] < 150_000 and max(rates.values()) < 0.3


def test_calibration_is_monotone():
    index, places, counts = _index()
    index.calibrate(places, counts)
    at, values = index.steps
    assert (np.diff(at) >= 0).all() and (np.diff(values) >= -1e-12).all()
    assert values.min() >= 0 and values.max() <= 1


@pytest.mark.parametrize("score", [pu_quality.score_quality, toxicity.score_toxicity], ids=lambda f: f.__name__)
def test_scores_awkward(spark, score):
    for own in (labels(spark), no_labels(spark)):
        rows = score(awkward(spark), own).collect()
        assert len(rows) == len(texts())
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
        same = [r.score for r in rows if r.doc_id in (10, 11)]
        assert len(set(same)) == 1
    assert score(nothing(spark), labels(spark)).collect() == []


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rank string, a int, part int")


def test_nearest_recall(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    table = _vectors(spark, [(i, v.tolist(), 0, "clash", 1, 1) for i, v in enumerate(x)])
    rows = multi_index.search(table, F.col("vec_id") % 100 == 0, multi_index.MultiIndex(part=500)).collect()
    hits = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        own = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert all(abs(d[r.vec_id] - r.score) < 1e-12 for r in own)
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert hits / 300 >= 0.9


def test_nearest_awkward(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 0.0, 2.0], [1.0, 0.0, 2.0], [0.0, 1.0, 0.0], [3.0, 0.0, 0.0], [1.0, 0.0, 2.0]]
    bad = [None, [], [0.0, 0.0, 0.0], [nan, 1.0, 1.0], [inf, 1.0, 1.0], [None, 1.0, 1.0], [1.0, 2.0]]
    rows = [(100 * k, v, None, None, None, None) for k, v in enumerate(good + bad)] + [(None, good[0], 0, "", 0, 0)]
    found = multi_index.search(_vectors(spark, rows), F.col("vec_id") % 100 == 0).collect()
    assert {r.query_id for r in found} == {0, 100, 200, 300, 400}
    own = sorted((r for r in found if r.query_id == 0), key=lambda r: r["rank"])
    assert [r.vec_id for r in own] == [100, 400, 200, 300] and own[0].score == 0.0
    assert multi_index.search(_vectors(spark, []), F.col("vec_id") % 100 == 0).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 5, 1000, 4097])
def test_slots_are_a_permutation(n):
    p = training_order.Order()
    found = training_order.slots(np.arange(n), n, p)
    assert sorted(found.tolist()) == list(range(n))
    assert n < 1000 or (found != training_order.slots(np.arange(n), n, training_order.Order(key=1))).any()


def test_training_order(spark, tmp_path):
    """Every token is there once, shards have one stride, and reading resumes at any slot."""
    p = training_order.Order(length=64, shard=16, block_bytes=4000)
    path = str(tmp_path / "shards")
    total = training_order.write_training_order(awkward(spark), path, p)
    rows = sorted(training_order.read_training_order(spark, path, 0, p.shard).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(total))
    assert all(len(r.data) == p.stride and r.shard == r.slot // p.shard for r in rows)
    later = training_order.read_training_order(spark, path, total - 20, p.shard).collect()
    assert sorted(r.slot for r in later) == list(range(total - 20, total))
    with open(training_order.VOCABULARY, "rb") as f:
        encoding = training_order._encoding(f.read())
    expected = sorted(i for _, t in texts() for i in [*encoding.encode_ordinary(t or ""), p.end])
    found = sorted(i for r in rows for i in np.frombuffer(r.data, "<u2")[: r.real].tolist())
    assert found == expected
    starts = {i for r in rows for i in r.docs}
    assert starts == {i for i, _ in texts()}


def test_no_sequences(spark):
    assert training_order.training_order(nothing(spark)).collect() == []


def _all_segmentations(unit, pieces):
    data = np.frombuffer(unit, np.uint8)
    out = {}
    for s, e, p, w in zip(*(x.tolist() for x in pieces.edges(data, np.full(len(data), len(data)))), strict=True):
        out.setdefault(s, []).append((e, p, w))

    def paths(at):
        if at == len(data):
            yield 0.0, []
        for e, p, w in out.get(at, []):
            for score, ids in paths(e):
                yield w + score, pieces.ids_of(p, unit[at:e]) + ids

    return sorted(paths(0), key=lambda x: -x[0])


@pytest.mark.parametrize("value", ["the cat  sat\nx", "a▁b é😀", "hello", "\n\n a", " ", "\ttab"])
def test_nbest_is_exact(spark, value):
    with open(nbest.MODEL, "rb") as f:
        model = f.read()
    pieces = nbest._pieces(model)
    expected = _all_segmentations((" " + value).encode().replace(nbest.SPACE, nbest.ESCAPED), pieces)[:4]
    docs = spark.createDataFrame([(1, value)], "doc_id long, text string")
    rows = sorted(nbest.encode_nbest(docs, 4, ids_of=4).collect(), key=lambda r: r["rank"])
    assert np.allclose([r.score for r in rows], [s for s, _ in expected])
    assert rows[0].ids == expected[0][1] or rows[0].score == expected[1][0]
    assert len({tuple(r.ids) for r in rows}) == len(rows) == len(expected)
    assert all(nbest.decode(r.ids, model) == value and r.round_trip for r in rows)


def test_nbest_awkward(spark):
    rows = nbest.encode_nbest(awkward(spark)).collect()
    assert len({r.doc_id for r in rows}) == len({i for i, _ in texts()})
    assert all(r.round_trip for r in rows)
    with open(nbest.MODEL, "rb") as f:
        model = f.read()
    best = {r.doc_id: r for r in rows if r["rank"] == 1 and r.doc_id is not None}
    for i, t in texts():
        if i is not None:
            assert nbest.decode(best[i].ids, model) == (t or "")
    assert best[16].n_pieces == 0 and best[16].score == 0.0
    scores = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        if r.doc_id not in (None, 11):
            assert r.score <= scores.get(r.doc_id, 0.0) + 1e-6
            scores[r.doc_id] = r.score
    assert nbest.encode_nbest(nothing(spark)).collect() == []


def test_pipeline(spark, sf_dir):
    """Stages take from the one before what they should, and each leaves documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs]
    from aislecast.session import stage

    for name, step in corpus_pipeline.STAGES:
        seen.append(stage(step(spark, seen[-1], sf_dir), name))
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in seen]
    for before, after in zip(ids[:-1], ids[1:], strict=True):
        assert after and after <= before
    assert all(d.columns == docs.columns for d in seen[:-1])
    best = seen[-1].filter("rank = 1")
    assert best.count() == seen[-2].count() and best.filter("not round_trip").isEmpty()
