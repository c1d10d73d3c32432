"""Toxicity by nearest labelled examples, with exact cosines from a block-max inverted index.

Documents and a bounded sample of labelled rows are TF-IDF vectors. Terms are
runs of letters and their prefixes, told apart by 64-bit hashes; document
frequencies are those of the whole corpus, and norms count all terms of a text,
also those of no example. The weight of a term grows with how far it leans to
label 1 (by the root of its chi-square among the examples), if that makes the
examples tell each other better, each left out in turn; else it is plain TF-IDF.

The index has the examples in blocks of similar ones. Terms of many examples are
rows of a matrix; every other term has postings, and its largest weight in each
block. A block's bound is its largest product of the first kind and the largest
weights of the second. A document visits blocks by descending bound and stops
where no bound reaches the nearest found so far; what it returns is exact.
Neighbours vote by closeness, and votes become probabilities by an isotonic fit
on the examples, each without itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislecast.llm import text as words
from aislecast.llm.blocks import bounded_batches
from aislecast.llm.common import crc_remainder
from aislecast.llm.multi_index import codebook, nearest_code
from aislecast.session import stage

# letters in lower case (all of them outside ASCII), everything else a gap
_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[97:123] = _LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)
SLACK = 1e-5  # of sums in single precision


@dataclass(frozen=True)
class Neighbours:
    modulus: int = 4
    held_out: int = 2  # remainder of the rows whose labels are not used
    positives: int = 1_500  # labelled rows learned from, about so many of each class
    negatives: int = 2_500
    index_bytes: int = 64 << 20  # of their texts, about
    prefixes: tuple[int, ...] = (4, 6)  # lengths in bytes
    stress: tuple[float, ...] = (0.0, 1.0)  # of the lean to label 1, to choose from; 0 is plain TF-IDF
    nearest: int = 15
    block: int = 32  # examples
    first: int = 4  # blocks visited before bounds are compared
    dense: float = 0.1  # terms of a larger share of the examples are a matrix
    weight: float = 1.0  # of the base rate among the votes
    threshold: float = 0.3


def terms(column: pa.Array, prefixes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For chunks of rows: bounds of each row's terms, the terms ascending, and how often they occur."""
    for i, j, data, at in words.chunks(column):
        data = _LETTER[data]
        starts, ends, bounds = words.words(data, at)
        sums = words.prefix_sums(data)
        row = np.repeat(np.arange(j - i), np.diff(bounds))
        found, rows = [words.span_hashes(sums, starts, ends)], [row]
        for k in prefixes:
            longer = ends - starts > k
            found.append(words.mix(words.span_hashes(sums, starts[longer], starts[longer] + k) + np.uint64(k)))
            rows.append(row[longer])
        term, row = np.concatenate(found), np.concatenate(rows)
        order = np.lexsort((term, row))
        term, row = term[order], row[order]
        new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | np.append(True, term[1:] != term[:-1])[: len(term)])
        yield np.searchsorted(row[new], np.arange(j - i + 1)), term[new], np.diff(new, append=len(term))


def _draw(rate: float) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20) < rate


def _sampled(rows: DataFrame, labels: DataFrame, p: Neighbours, label_col: str) -> tuple[DataFrame, dict[int, float]]:
    """About so many labelled rows of each class by a hash of the id, and what part of the class that is."""
    learnt = crc_remainder("doc_id", p.modulus) != p.held_out
    known = (
        labels.filter(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(learnt)
        .groupBy("doc_id")
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    rates = {c: min(1.0, n / max(1, counts.get(c, 0))) for c, n in ((0, p.negatives), (1, p.positives))}

    def drawn(rates: dict[int, float], texts: DataFrame) -> DataFrame:
        own = known.filter(F.when(F.col("label") == 1, _draw(rates[1])).otherwise(_draw(rates[0])))
        # only texts that can be drawn are moved
        return texts.filter(learnt & _draw(max(rates.values()))).join(own, "doc_id")

    sample = stage(drawn(rates, rows), "toxic-sample")
    size = sample.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > p.index_bytes:
        rates = {c: r * p.index_bytes / size for c, r in rates.items()}
        sample = stage(drawn(rates, sample.drop("label")), "toxic-sample")
    return sample, rates


def _example_terms(sample: DataFrame, p: Neighbours) -> pa.Table:
    """doc_id, label, term and n of the examples, by doc_id; bounded as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for bounds, term, n in terms(batch.column(2), p.prefixes):
                own = batch.slice(done, len(bounds) - 1)
                done += len(own)
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x)) for x in (term.view(np.int64), n.astype(np.int32))]
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), *lists], ["doc_id", "label", "term", "n"])

    found = sample.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, term array<long>, n array<int>")
    return found.toArrow().sort_by("doc_id")


def _vectors(rows: DataFrame, vocabulary: np.ndarray, p: Neighbours) -> DataFrame:
    """doc_id, places and counts of the vocabulary's terms, and the squares of the other terms' frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for bounds, term, n in terms(batch.column(1), p.prefixes):
                own = batch.column(0).slice(done, len(bounds) - 1)
                done += len(own)
                place = np.minimum(np.searchsorted(vocabulary, term), max(0, len(vocabulary) - 1))
                known = vocabulary[place] == term if len(vocabulary) else np.zeros(len(term), bool)
                squares = np.concatenate([[0], np.cumsum(np.where(known, 0, (1 + np.log(n)) ** 2))])
                held = np.concatenate([[0], np.cumsum(known)])[bounds]
                lists = [pa.ListArray.from_arrays(pa.array(held, pa.int32()), pa.array(x[known], pa.int32())) for x in (place, n)]
                yield pa.RecordBatch.from_arrays([own, *lists, pa.array(squares[bounds[1:]] - squares[bounds[:-1]])], ["doc_id", "place", "n", "other"])

    return rows.select("doc_id", "text").mapInArrow(run, "doc_id long, place array<int>, n array<int>, other double")


def lean(places: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """The root of chi-square of every term that is more frequent with label 1, else 0."""
    toxic, clean = labels.sum(), (1 - labels).sum()
    if not toxic or not clean:
        return np.zeros(size)
    every = np.concatenate(places)
    owner = np.repeat(labels, [len(x) for x in places])
    a, b = (np.bincount(every, w, size) for w in (owner, 1 - owner))
    c, d = toxic - a, clean - b
    chi = (toxic + clean) * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * toxic * clean, 1)
    return np.where(a / toxic > b / clean, np.sqrt(chi), 0.0)


def similar_order(vectors: list[tuple[np.ndarray, np.ndarray]], block: int) -> np.ndarray:
    """The examples with similar ones next to each other: by clusters of their vectors folded to 64 places."""
    folded = np.zeros((len(vectors), 64))
    for e, (place, w) in enumerate(vectors):
        h = words.mix(place.astype(np.uint64) + np.uint64(1))
        np.add.at(folded[e], (h % np.uint64(64)).astype(np.int64), w * np.where(h >> np.uint64(63), 1.0, -1.0))
    if len(vectors) < 2 * block:
        return np.arange(len(vectors))
    centres = codebook(folded, max(2, len(vectors) // (2 * block)), 6)
    # clusters next to similar clusters, as blocks reach over their borders
    rank = np.argsort(np.argsort(centres @ centres.mean(0), kind="stable"), kind="stable")
    return np.lexsort((np.arange(len(vectors)), rank[nearest_code(folded, centres)]))


class Index:
    """Examples in blocks; for every term of few examples its postings, and its largest weight in each block."""

    def __init__(self, places: list, counts: list, labels: np.ndarray, weights: np.ndarray, ids: np.ndarray, idf: np.ndarray, p: Neighbours, other_idf: float = 1.0):
        self.p, self.idf, self.other_idf = p, idf, other_idf
        vectors = [(np.asarray(x, np.int64), self.vector(np.asarray(x, np.int64), np.asarray(n))) for x, n in zip(places, counts, strict=True)]
        order = similar_order(vectors, p.block)
        self.slot = np.argsort(order, kind="stable")  # of every example as given
        vectors = [vectors[e] for e in order]
        self.labels, self.weights, self.ids = labels[order], weights[order], ids[order]
        n = len(vectors)
        self.blocks = max(1, -(-n // p.block))
        term = np.concatenate([x for x, _ in vectors] or [np.empty(0, np.int64)])
        weight = np.concatenate([w for _, w in vectors] or [np.empty(0)])
        example = np.repeat(np.arange(n), [len(x) for x, _ in vectors]) if n else np.empty(0, np.int64)
        held = np.bincount(term, minlength=len(idf))
        common = np.flatnonzero(held > p.dense * n)
        self.row = np.full(len(idf), -1, np.int32)
        self.row[common] = np.arange(len(common))
        often = self.row[term] >= 0
        self.matrix = np.zeros((n, len(common)))
        self.matrix[example[often], self.row[term[often]]] = weight[often]
        self.single = np.zeros((len(common), self.blocks * p.block), np.float32)
        self.single[:, :n] = self.matrix.T
        # postings by term, then example; runs of one term in one block have a largest weight
        term, example, weight = term[~often], example[~often], weight[~often]
        by_term = np.argsort(term, kind="stable")
        term, self.example, self.posted = term[by_term], example[by_term].astype(np.int32), weight[by_term]
        key = term * self.blocks + self.example // p.block
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.run_block = (key[first] % self.blocks).astype(np.int32)
        self.run_max = np.maximum.reduceat(self.posted, first) if len(first) else np.empty(0)
        self.run_start = np.append(first, len(key))
        self.cuts = np.searchsorted(key[first], np.arange(len(idf) + 1) * self.blocks)
        self.visited = 0  # blocks, over all searches
        self.rate = float((weights * labels).sum() / max(weights.sum(), 1e-12)) if n else 0.0
        self.steps = (np.array([0.0]), np.array([self.rate]))

    def vector(self, place: np.ndarray, n: np.ndarray, other: float = 0.0) -> np.ndarray:
        """Weights of the known terms; other is the sum of squares of the frequencies of all the rest."""
        w = (1 + np.log(np.maximum(n, 1))) * self.idf[place]
        return w / max(np.sqrt((w * w).sum() + other * self.other_idf**2), 1e-12)

    def search_all(self, places: list[np.ndarray], queries: list[np.ndarray], without: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """The nearest examples (slots) of every query and their cosines, nearest first; ties by id.

        without names the example that each query must not find.
        """
        p, found = self.p, []
        often = np.zeros((len(places), self.matrix.shape[1]))
        for k, (place, query) in enumerate(zip(places, queries, strict=True)):
            row = self.row[place]
            often[k, row[row >= 0]] = query[row >= 0]
        product = often.astype(np.float32) @ self.single
        tops = product.reshape(len(places), self.blocks, p.block).max(2)
        for k, (place, query) in enumerate(zip(places, queries, strict=True)):
            rare = self.row[place] < 0
            place, query = place[rare], query[rare]
            size = self.cuts[place + 1] - self.cuts[place]
            run = np.repeat(self.cuts[place] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            given, block = np.repeat(query, size), self.run_block[run]
            bound = tops[k] + np.bincount(block, given * self.run_max[run], self.blocks)
            score = product[k].astype(np.float64)
            exact = np.zeros(self.blocks, bool)

            def visit(which: np.ndarray, run=run, given=given, block=block, score=score, exact=exact) -> None:
                exact[which] = True
                mine = which[block]
                start = self.run_start[run[mine]]
                n = self.run_start[run[mine] + 1] - start
                at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
                score += np.bincount(self.example[at], np.repeat(given[mine], n) * self.posted[at], len(score))

            def least(score=score, exact=exact, k=k) -> float:
                own = np.where(np.repeat(exact, p.block), score, -1.0)[: len(self.labels)]
                if without is not None:
                    own[without[k]] = -1.0
                return np.partition(own, -p.nearest)[-p.nearest] if len(own) > p.nearest else -1.0

            first = np.zeros(self.blocks, bool)
            first[np.argsort(-bound, kind="stable")[: p.first]] = True
            visit(first)
            rest = ~exact & (bound > 0) & (bound >= least() - 2 * SLACK)
            visit(rest)
            self.visited += int(exact.sum())
            own = np.where(np.repeat(exact, p.block), score, 0.0)[: len(self.labels)]
            if without is not None:
                own[without[k]] = 0.0
            near = np.flatnonzero((own > 0) & (own >= least() - 2 * SLACK))
            # single precision has served its turn: the common part again, in double
            cosine = own[near] - product[k, near] + self.matrix[near] @ often[k]
            # sums of another order differ in the last places, and must not decide
            cosine = np.round(cosine, 12)
            best = np.lexsort((self.ids[near], -cosine))[: p.nearest]
            best = best[cosine[best] > 0]
            found.append((near[best], cosine[best]))
        return found

    def search(self, place: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """search_all of one query."""
        return self.search_all([place], [query])[0]

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        """The share of label 1 among the neighbours, by closeness and by what an example stands for."""
        closeness = cosine / np.maximum(1 - cosine, 0.05) * self.weights[near]
        base = self.p.weight * float(self.weights.mean()) if len(self.weights) else 1.0
        return float(((closeness * self.labels[near]).sum() + base * self.rate) / (closeness.sum() + base))

    def calibrate(self, places: list, counts: list) -> float:
        """An isotonic fit of label on vote over the examples, each scored without itself; its mean log loss."""
        votes = np.empty(len(places))
        for e in range(0, len(places), 256):
            own = [np.asarray(x, np.int64) for x in places[e : e + 256]]
            queries = [self.vector(x, np.asarray(n)) for x, n in zip(own, counts[e : e + 256], strict=True)]
            slots = self.slot[e : e + len(own)]
            votes[slots] = [self.vote(*x) for x in self.search_all(own, queries, slots)]
        values, which = np.unique(votes, return_inverse=True)
        mass = np.bincount(which, self.weights)
        hits = np.bincount(which, self.weights * self.labels)
        pools: list[list[float]] = []
        for v, h, m in zip(values.tolist(), hits.tolist(), mass.tolist(), strict=True):
            pools.append([v, v, h, m])
            while len(pools) > 1 and pools[-2][2] / pools[-2][3] >= pools[-1][2] / pools[-1][3]:
                _, last, h2, m2 = pools.pop()
                pools[-1] = [pools[-1][0], last, pools[-1][2] + h2, pools[-1][3] + m2]
        if pools:
            # half a count of doubt on either side keeps scores inside 0 and 1
            unit = float(self.weights.mean())
            edges = np.array([(first, last) for first, last, _, _ in pools]).ravel()
            self.steps = (edges, np.repeat([(h + 0.5 * unit * self.rate) / (m + 0.5 * unit) for _, _, h, m in pools], 2))
        given = np.clip(np.interp(votes, *self.steps), 1e-6, 1 - 1e-6)
        loss = -np.where(self.labels == 1, np.log(given), np.log(1 - given))
        return float((loss * self.weights).sum() / max(self.weights.sum(), 1e-12))

    def score(self, places: list[np.ndarray], counts: list[np.ndarray], other: np.ndarray) -> tuple[list[float], list[list[int]]]:
        """Scores and evidence of some texts."""
        queries = [self.vector(x, n, o) for x, n, o in zip(places, counts, other, strict=True)]
        found = self.search_all(places, queries)
        return [float(np.interp(self.vote(*x), *self.steps)) for x in found], [self.ids[x[0]].tolist() for x in found]


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    params: Neighbours | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted and evidence (ids of the nearest examples).

    Only labels of rows whose crc32 of the id's text has another remainder than
    held_out are used, and of these a bounded sample; scores depend on the text
    alone. Text without letters, also null and empty, gets the score of no
    neighbours. Without labels of both classes all scores are the base rate. A
    label other than 0 and 1, or of no row, is ignored; of contradicting labels 1
    holds. Repeated rows count as often as they occur in the document
    frequencies and get equal scores. No rows give no rows. Other columns are
    ignored.

    The index, bounded by the sample's rows and bytes, goes to every task.
    """
    p = params or Neighbours()
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sample, rates = _sampled(rows, labels, p, label_col)
    examples = _example_terms(sample, p)
    listed, counts = ([x.values.to_numpy() for x in examples.column(c)] for c in ("term", "n"))
    vocabulary = np.unique(np.concatenate([x.view(np.uint64) for x in listed] or [np.empty(0, np.uint64)]))
    places = [np.searchsorted(vocabulary, x.view(np.uint64)) for x in listed]
    vectors = stage(_vectors(rows, vocabulary, p), "toxic-vectors")
    size = vectors.count()
    held = vectors.select(F.explode("place").alias("k")).groupBy("k").count().toArrow()
    df = np.zeros(len(vocabulary))
    df[held.column("k").to_numpy()] = held.column("count").to_numpy()
    own = examples.column("label").to_numpy().astype(np.float64)
    weights = np.array([1 / rates[int(x)] for x in own])
    leaning = lean(places, own, len(vocabulary))
    best, index = np.inf, None
    for stress in p.stress:  # chosen on the examples alone
        idf = (1 + np.log((1 + size) / (1 + df))) * (1 + stress * leaning)
        tried = Index(places, counts, own, weights, examples.column("doc_id").to_numpy(), idf, p, 1 + np.log(1 + size))
        loss = tried.calibrate(places, counts)
        if index is None or loss < best:
            best, index = loss, tried

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 128):
                batch = whole.slice(k, 128)
                place, n = ([x.values.to_numpy() for x in batch.column(c)] for c in ("place", "n"))
                scores, evidence = index.score([x.astype(np.int64) for x in place], n, batch.column("other").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))],
                    ["doc_id", "score", "evidence"],
                )

    scored = vectors.mapInArrow(run, "doc_id long, score double, evidence array<long>")
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", p.modulus) == p.held_out).alias("held_out"),
        "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"),
        "evidence",
    )
