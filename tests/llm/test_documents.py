"""The document operators against plain versions, on awkward rows and on no rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from aislecast.llm import chosen_path, curriculum, divergence_rules, interpolation, suffix_dedup
from aislecast.llm.oracle import SQL
from aislecast.llm.queries import QUERIES
from tests.compare import connect, difference
from tests.llm import brute
from tests.llm.cases import awkward, nothing, texts


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twin(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twin_awkward(spark, tmp_path, name):
    """The twins also agree on nulls, empty texts, ties and repeated rows."""
    import duckdb

    nan, inf = float("nan"), float("inf")
    odd = [None, [1.0, None], [nan, 1.0], [inf, 1.0], [0.0, 0.0], [-1.0, 0.5]]
    vectors = [(k, odd[k % 13] if k % 13 < len(odd) else [1.0, (k % 7) / 8], None if k % 11 == 3 else k % 4) for k in range(0, 1000, 5)]
    tables = {"documents": awkward(spark), "embeddings": spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")}
    con = duckdb.connect()
    for table, df in tables.items():
        df.coalesce(1).write.parquet(str(tmp_path / f"{table}.parquet"))
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    assert difference(QUERIES[name](spark, str(tmp_path)), con, SQL[name]) is None


def _components(rows):
    return {(r.doc_id, r.component_id) for r in rows}


def test_near_duplicates(spark, sf_dir):
    rows = QUERIES["op1_near_duplicates"](spark, sf_dir).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert _components(rows) == set(brute.components(docs, 3, 85).items())
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert all(r.n_shingles == len(brute.shingles(dict(docs)[r.doc_id], 3)) for r in rows)


def test_near_duplicates_awkward(spark):
    rows = chosen_path.near_duplicates(awkward(spark)).collect()
    assert len(rows) == len(texts())
    known = [(i, t) for i, t in texts() if i is not None]
    expected = brute.components(known, 5, 80)
    assert {(r.doc_id, r.component_id) for r in rows if r.doc_id is not None} == set(expected.items())
    nulls = sorted((r.component_id is None, r.kept) for r in rows if r.doc_id is None)
    assert nulls == [(False, False), (True, True)]
    kept = chosen_path.drop_near_duplicates(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == sorted(set(expected.values()))


def test_crowded_nodes(spark):
    """Hundreds of different near copies, and as many texts with one common part, stay right."""
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(150):
        changed = list(base)
        changed[k % 60] = f"c{k}"
        rows.append((k, " ".join(changed)))
        rows.append((1000 + k, " ".join(base[:20] + [f"u{k}_{j}" for j in range(30)])))
    params = chosen_path.ChosenPath(shingle=3, percent=85, leaf=4)
    found = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), params).collect()
    assert _components(found) == set(brute.components(rows, 3, 85).items())


def _crowd(n, seed, versions=1):
    """n texts, each a base text with one to twelve words changed; with versions, bases are changed in ten words."""
    r = random.Random(seed)
    base = [f"w{k}" for k in range(150)]
    bases = [base]
    for v in range(1, versions):
        other = list(base)
        for k in range(v, 150, 15):
            other[k] = f"v{v}_{k}"
        bases.append(other)
    out = []
    for k in range(n):
        changed = list(bases[k % versions])
        for place in r.sample(range(150), r.randint(1, 12)):
            changed[place] = f"c{r.randint(0, 60)}"
        if k % 7 == 0:
            del changed[r.randrange(140) :][:4]
        out.append((k, " ".join(changed)))
    return out


@pytest.mark.parametrize("versions", [1, 3])
def test_crowd_pairs_grow_with_the_crowd(spark, monkeypatch, versions):
    """A crowd of texts alike but mostly not linked: right components from a bounded number of pairs a text."""
    made = []
    real = chosen_path.stage

    def counted(df, name):
        out = real(df, name)
        if name == "cp-pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(chosen_path, "stage", counted)
    rows = _crowd(600, versions, versions)
    params = chosen_path.ChosenPath(shingle=3, percent=85)
    found = chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), params).collect()
    assert _components(found) == set(brute.components(rows, 3, 85).items())
    assert sum(made) < 20 * len(rows)


@pytest.mark.parametrize(
    "run",
    [
        chosen_path.near_duplicates,
        chosen_path.drop_near_duplicates,
        curriculum.plan_mix,
        curriculum.mix_documents,
        suffix_dedup.repeated_passages,
        suffix_dedup.drop_passages,
        interpolation.lm_scores,
        divergence_rules.judge,
        divergence_rules.filter_documents,
    ],
    ids=lambda f: f.__name__,
)
def test_no_rows(spark, run):
    assert run(nothing(spark)).collect() == []


def test_mix_meets_targets(spark):
    rows = curriculum.plan_mix(awkward(spark)).collect()
    assert len(rows) == len(texts())
    by_source = {}
    for r in rows:
        assert r.taken <= 2 * r.size
        by_source.setdefault(r.source, []).append(r)
    assert list(map(str, sorted(by_source, key=lambda s: (s is None, s)))) == ["a", "b", "c", "None"]
    for own in by_source.values():
        assert abs(sum(r.taken for r in own) - own[0].target) <= 1
        assert own[0].target <= 2 * own[0].source_size
    total = sum(r.size for r in rows)
    assert abs(sum(own[0].target for own in by_source.values()) - 1.5 * total) < 1e-6 * total


def test_mix_order(spark):
    plan = curriculum.plan_mix(awkward(spark))
    order = curriculum.training_order(plan).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert all(0 <= r.position <= 1 for r in order)
    taken = Counter()
    for r in order:
        taken[r.doc_id] += r.words
    expected = Counter()
    for r in plan.collect():
        expected[r.doc_id] += r.taken
    assert taken == +expected
    again = [tuple(r) for r in curriculum.training_order(curriculum.plan_mix(awkward(spark).repartition(3))).collect()]
    assert again == [tuple(r) for r in order]


def test_due_inverts_demand(spark):
    """The demand integrated up to the due time is the offset."""
    from pyspark.sql import functions as F

    for a, b in curriculum.SCHEDULES:
        row = spark.range(11).select(
            F.col("id"), curriculum._due(F.col("id") * 1.0, F.lit(10.0), [(a, b)], F.lit(0)).alias("t")
        )
        for r in row.collect():
            reached = (a * r.t + (b - a) * r.t**2 / 2) / ((a + b) / 2) * 10
            assert math.isclose(reached, r.id, abs_tol=1e-9)


def test_mixed_documents_keep_columns(spark):
    docs = awkward(spark)
    mixed = curriculum.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert {r.doc_id for r in mixed.collect()} <= {r.doc_id for r in docs.collect()}


def _check_passages(rows, docs):
    marks = brute.removed(docs, 50)
    data = dict(docs)
    for r in rows:
        gone, own = marks[r.doc_id], data[r.doc_id]
        kept = bytes(b for b, g in zip(own, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(own), sum(gone), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_passages(spark, sf_dir):
    rows = QUERIES["op3_repeated_passages"](spark, sf_dir).collect()
    docs = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert len(rows) == len(docs)
    _check_passages(rows, docs)


@pytest.mark.parametrize("hot_runs", [0, 4096])
def test_passages_awkward(spark, hot_runs):
    """Also when every name is cut into windows, and with many bins and blocks."""
    params = suffix_dedup.Passages(hot_runs=hot_runs, block_bytes=4000, bin_bytes=20_000, sort_bucket=500)
    rows = suffix_dedup.repeated_passages(awkward(spark), params).collect()
    assert len(rows) == len(texts())
    known = [(i, (t or "").encode()) for i, t in texts() if i is not None]
    _check_passages([r for r in rows if r.doc_id is not None], known)
    nulls = sorted((r.n_bytes, r.n_removed) for r in rows if r.doc_id is None)
    whole = len(texts()[0][1])
    assert nulls == [(0, 0), (whole, whole)]


def test_dropped_passages_keep_columns(spark):
    docs = awkward(spark)
    cut = suffix_dedup.drop_passages(docs)
    assert cut.schema.names == docs.schema.names
    by_id = {r.doc_id: r.text for r in cut.collect()}
    assert by_id[10] == texts()[0][1] and by_id[11] == "" and by_id[16] is None and by_id[21] == texts()[12][1]
    assert all(r.text is None or r.n_chars == len(r.text) for r in cut.collect())


def test_cover_has_all_differences():
    found = {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER}
    assert found == set(range(suffix_dedup.PERIOD))


def test_suffix_order():
    """Windows come in byte order and equal ones are found, for repetitive data too."""
    rng = np.random.default_rng(3)
    for data in (rng.integers(97, 99, 4000), np.tile(rng.integers(97, 123, 37), 60), np.full(500, 120)):
        data = data.astype(np.uint8)
        pos = np.arange(len(data) - 50)
        order, same = suffix_dedup.equal_windows(data, pos, 50, 300)
        windows = [data[p : p + 50].tobytes() for p in order]
        assert windows == sorted(windows)
        assert same.tolist() == [k > 0 and windows[k] == windows[k - 1] for k in range(len(windows))]


def _base_scores(rows, docs):
    tokens = {i: [*brute.words(t), None] for i, t in docs}
    counts = Counter()
    for i, t in docs:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2:
            counts.update([*brute.words(t), None])
    total, distinct = sum(counts.values()), len(counts)
    for r in rows:
        own = tokens[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)


def test_lm_scores(spark, sf_dir):
    rows = QUERIES["op4_lm_scores"](spark, sf_dir).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert len(rows) == len(docs)
    _base_scores(rows, docs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_query_has_three_orders(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    score = lambda rows: {r.doc_id: r.score for r in rows if r.held_out}
    found = score(QUERIES["op4_lm_scores"](spark, sf_dir).collect())
    three, two = (score(interpolation.lm_scores(docs, interpolation.Interpolation(order=k)).collect()) for k in (3, 2))
    assert found == pytest.approx(three, rel=1e-9) and found != pytest.approx(two, rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_awkward(spark, order):
    params = interpolation.Interpolation(order=order, block_bytes=3000, bucket_bytes=20_000)
    rows = interpolation.lm_scores(awkward(spark), params).collect()
    assert len(rows) == len(texts())
    docs = texts()
    _base_scores([r for r in rows if r.doc_id is not None], docs)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_lm_probabilities(spark):
    """Scores of one-document corpora equal the mixture written out; weights of all contexts sum to one."""
    p = interpolation.Interpolation(modulus=1, held_out=1, deleted=5)  # everything is learned from
    docs = spark.createDataFrame([(1, "a b a b a c")], "doc_id long, text string")
    row = interpolation.lm_scores(docs, p).first()
    tokens = ["a", "b", "a", "b", "a", "c", "$"]
    uni, bi, context = Counter(tokens), Counter(zip(["^", *tokens], tokens)), Counter(["^", *tokens[:-1]])
    w, total = 0.5, 0.0
    for h, t in zip(["^", *tokens], tokens):
        low = w * uni[t] / 7 + (1 - w) / 5
        total += math.log10(w * bi[h, t] / context[h] + (1 - w) * low)
    assert math.isclose(row.score, total, rel_tol=1e-9)


def test_weights_raise_the_likelihood():
    rng = np.random.default_rng(1)
    cells = np.stack([rng.integers(1, 4, 50), rng.random(50), rng.integers(0, 4, 50), rng.random(50)], axis=1)
    n = rng.integers(1, 9, 50).astype(float)

    def likelihood(rounds):
        p = interpolation.Interpolation(rounds=rounds)
        w = interpolation.learn_weights(p, cells, n, 0.01)
        low = np.full(50, 0.01)
        for k in range(2):
            own = w[k, cells[:, 2 * k].astype(int)]
            low = own * cells[:, 2 * k + 1] + (1 - own) * low
        return (n * np.log(low)).sum()

    values = [likelihood(k) for k in (0, 1, 2, 5, 20)]
    assert values == sorted(values)


def test_weights_of_a_table_are_those_of_its_cells(spark):
    rng = np.random.default_rng(2)
    p = interpolation.Interpolation(order=3, rounds=7)
    columns = ["b0", "q0", "b1", "q1", "b2", "q2"]
    rows = np.stack([c for _ in range(3) for c in (rng.integers(0, p.buckets, 3000), rng.integers(-1, 60, 3000))], axis=1)
    n = rng.integers(1, 9, 3000)
    table = spark.createDataFrame([(*map(int, r), int(k)) for r, k in zip(rows, n, strict=True)], [*columns, "n"]).repartition(5)
    values = rows.astype(float)
    values[:, 1::2] = np.where(rows[:, 1::2] >= 0, 2.0 ** (-rows[:, 1::2] / p.grain), 0.0)
    found = interpolation.learn_weights_of(p, table, columns, 0.01)
    assert np.allclose(found, interpolation.learn_weights(p, values, n.astype(float), 0.01), rtol=1e-9)
    nothing = interpolation.learn_weights_of(p, table.filter("n < 0"), columns, 0.01)
    assert (nothing[:, 1:] == 0.5).all() and not nothing[:, 0].any()


def test_lm_cells_stay_off_the_driver(spark, sf_dir, monkeypatch):
    """A row of sums of each task is all that comes to the driver."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kind, seen = type(docs), []

    def counted(f):
        def run(self, *args, **more):
            out = f(self, *args, **more)
            seen.append(len(out))
            return out

        return run

    for name in ("collect", "toPandas", "toArrow"):
        monkeypatch.setattr(kind, name, counted(getattr(kind, name)))
    interpolation.lm_scores(docs, interpolation.Interpolation(order=3, rounds=3))
    assert max(seen) <= 64  # of thousands of cells


def test_rules_distances(spark, sf_dir):
    """Prose is near its language; symbols and word lists are not."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = divergence_rules.judge(docs).join(labels, "doc_id").filter("not base_failed").toPandas()
    assert judged[judged.quality == 1].kept.mean() > 0.98
    assert judged[judged.quality == 0].kept.mean() < 0.1
    kept = divergence_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in divergence_rules.judge(docs).filter("kept").select("doc_id").collect()}
    assert {r.doc_id for r in kept.collect()} == ids


def test_rules_long_texts_without_common_words(spark, sf_dir):
    """Gibberish of prose-like characters is far from every language at every length; short texts cannot tell."""
    made = random.Random(3)
    gibberish = lambda n: " ".join("".join(made.choices("bcdfgklmnprstv", k=made.randint(3, 8))) for _ in range(n))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    odd = spark.createDataFrame([(-n, None, gibberish(n)) for n in (49, 50, 500, 10_000)], docs.schema)
    rows = {r.doc_id: r for r in divergence_rules.judge(docs.union(odd)).filter("doc_id < 0").collect()}
    assert rows[-49].prose_distance is None
    for n in (50, 500, 10_000):
        r = rows[-n]
        assert not r.base_failed and r.class_distance < 0.3 and r.word_distance is None
        assert 0.9 < r.prose_distance <= 1.0 and not r.kept
    assert not divergence_rules.filter_documents(docs.union(odd)).filter("doc_id < -49").count()


def test_rules_awkward(spark):
    rows = divergence_rules.judge(awkward(spark)).collect()
    assert len(rows) == len(texts())
    by_id = {r.doc_id: r for r in rows}
    assert by_id[16].n_words == 0 and by_id[16].base_failed and not by_id[16].kept
    assert by_id[22].n_repeat_words == 5000 and by_id[24].n_dup_lines == 29
