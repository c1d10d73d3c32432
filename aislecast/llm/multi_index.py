"""Nearest neighbours by an inverted multi-index.

Each half of a vector is quantised with a codebook of its own; the pair of
codes is the vector's cell. A query visits cells in the order of the sum of its
two distances, by a heap over the two sorted lists of distances, until the
cells visited hold enough vectors; these are reranked by their exact distance.
How many are enough is measured: on a sample, the share of vectors that has to
be visited for the wished part of the true neighbours to be among them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislecast.llm.blocks import bounded_batches
from aislecast.session import stage


@dataclass(frozen=True)
class MultiIndex:
    neighbours: int = 10
    recall: float = 0.95  # wished for on the sample
    sample: int = 20_000  # vectors the codebooks and the share are fitted on, about
    trials: int = 200  # queries of the sample
    codes: int = 256  # of a half, at most; fewer for fewer vectors
    rounds: int = 12
    part: int = 20_000  # vectors and queries that meet in one task, about


def codebook(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """k-means centres; they start from rows spread over the sample."""
    centres = np.unique(x[np.linspace(0, len(x) - 1, k).astype(np.int64)], axis=0)
    for _ in range(rounds):
        near = nearest_code(x, centres)
        count = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    return np.maximum(0, (x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T)


def nearest_code(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([squares(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)] or [np.empty(0, np.int64)])


def traverse(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """All pairs of codes by the sum of their distances, smallest first."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    queue = [(first[a[0]] + second[b[0]], 0, 0)]
    while queue:
        _, i, j = heapq.heappop(queue)
        yield int(a[i]), int(b[j])
        # a pair is reached from one side only, so none is pushed twice
        if j + 1 < len(b):
            heapq.heappush(queue, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(queue, (first[a[i + 1]] + second[b[0]], i + 1, 0))


class Codes:
    """Both codebooks, the vectors in each cell, and how many a query visits."""

    def __init__(self, sample: np.ndarray, n: int, p: MultiIndex):
        k = int(min(p.codes, max(4, n**0.5 / 4)))
        self.half = sample.shape[1] // 2
        self.books = [codebook(part, k, p.rounds) for part in self._halves(sample)]
        self.share = self._measure(sample, p)
        self.sizes = np.zeros([len(b) for b in self.books], dtype=np.int64)

    def _halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = (nearest_code(part, book) for part, book in zip(self._halves(x), self.books, strict=True))
        return a, b

    def visit(self, x: np.ndarray, enough: float) -> Iterator[list[tuple[int, int]]]:
        """The cells each query visits until they hold enough vectors."""
        near = [squares(part, book) for part, book in zip(self._halves(x), self.books, strict=True)]
        for first, second in zip(*near, strict=True):
            held, out = 0, []
            for a, b in traverse(first, second):
                if self.sizes[a, b]:
                    out.append((a, b))
                    held += int(self.sizes[a, b])
                    if held >= enough:
                        break
            yield out

    def _measure(self, sample: np.ndarray, p: MultiIndex) -> float:
        a, b = self.cells(sample)
        cell = a * len(self.books[1]) + b
        count = np.bincount(cell, minlength=len(self.books[0]) * len(self.books[1]))
        shares = []
        for i in np.linspace(0, len(sample) - 1, min(p.trials, len(sample))).astype(np.int64):
            d = ((sample - sample[i]) ** 2).sum(1)
            d[i] = np.inf
            true = np.argsort(d, kind="stable")[: min(p.neighbours, len(sample) - 1)]
            near = [squares(part[i : i + 1], book)[0] for part, book in zip(self._halves(sample), self.books, strict=True)]
            order = np.argsort((near[0][:, None] + near[1][None, :]).ravel(), kind="stable")
            reached = np.empty(len(order))
            reached[order] = np.cumsum(count[order])
            shares += (reached[cell[true]] / len(sample)).tolist()
        return float(np.quantile(shares, p.recall)) if shares else 1.0


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64)


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, fine), F.lit(False)) & F.exists(vector, lambda x: x != 0)


def search(
    vectors: DataFrame, queries: Column, params: MultiIndex | None = None, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the nearest found of every query.

    queries is a condition on the vectors' columns; candidates are all rows but
    those of the query's own id. Ties go to the smaller vec_id. Vectors that are
    null, zero or hold null or non-finite components take no part, nor do rows
    without an id or vectors of another length than most. A query has fewer rows
    if there are fewer candidates, and none if there are none. Repeated rows are
    candidates each; a repeated query counts once. Other columns are ignored.

    Vectors of a first code and queries are cut into parts, and every part of
    one meets every part of the other, so no code is one task. Broadcast are
    the codebooks and the cells' sizes, both bounded by the codes.
    """
    p = params or MultiIndex()
    spark = vectors.sparkSession
    bounded_batches(spark)
    v = F.col(vector_col)
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(v)).select(
        F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"), queries.alias("query"), F.size(v).alias("d")
    )
    schema = "query_id long, rank int, vec_id long, score double"
    lengths = rows.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    width, n = lengths["d"], lengths["count"]
    rows = rows.filter(F.col("d") == width)
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) / float(1 << 20)
    drawn = rows.filter(draw < min(1.0, p.sample / n)).orderBy("vec_id").select("v").toPandas()["v"]
    if len(drawn) < 2:
        drawn = rows.orderBy("vec_id").limit(p.sample).select("v").toPandas()["v"]
    codes = Codes(np.stack(drawn.to_list()).astype(np.float64), n, p)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            a, b = codes.cells(flat)
            packed = pa.array([x.tobytes() for x in flat], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), packed, batch.column("query"), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
                ["vec_id", "v", "query", "a", "b"],
            )

    indexed = stage(rows.select("vec_id", "v", "query").mapInArrow(assign, "vec_id long, v binary, query boolean, a int, b int"), "multi-index")
    for r in indexed.groupBy("a", "b").count().collect():  # codes squared at most
        codes.sizes[r["a"], r["b"]] = r["count"]
    asked = indexed.filter("query").dropDuplicates(["vec_id"])
    query_parts = max(1, -(-asked.count() // p.part))
    parts = {a: max(1, -(-int(s) // p.part)) for a, s in enumerate(codes.sizes.sum(1))}
    enough = max(codes.share * n, p.neighbours + 1)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column("v")).reshape(len(batch), -1)
            out: list[list] = [[], [], [], [], [], []]
            for i, cells in enumerate(codes.visit(x, enough)):
                by_first: dict[int, list[int]] = {}
                for a, b in cells:
                    by_first.setdefault(a, []).append(b)
                own = batch.column("vec_id")[i].as_py()
                for a, seconds in by_first.items():
                    for part in range(parts[a]):
                        for into, value in zip(out, (a, part, own % query_parts, own, batch.column("v")[i].as_py(), seconds), strict=True):
                            into.append(value)
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["a", "part", "qpart", "query_id", "q", "bs"])

    def rerank(candidates: pa.Table, probes: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if candidates.num_rows and probes.num_rows:
            ids = candidates.column("vec_id").to_numpy()
            x = _vectors(candidates.column("v")).reshape(len(ids), -1)
            second = candidates.column("b").to_numpy()
            for query_id, q, bs in zip(probes.column("query_id").to_pylist(), probes.column("q").to_pylist(), probes.column("bs").to_pylist(), strict=True):
                wanted = np.zeros(len(codes.books[1]), dtype=bool)
                wanted[bs] = True
                met = np.flatnonzero(wanted[second] & (ids != query_id))
                d = np.sqrt(((x[met] - np.frombuffer(q, np.float64)) ** 2).sum(1))
                best = np.lexsort((ids[met], d))[: p.neighbours]
                for into, value in zip(out, (np.full(len(best), query_id), ids[met][best], d[best]), strict=True):
                    into.append(value)
        query_ids, found, scores = (np.concatenate(c) if c else np.empty(0) for c in out)
        return pa.table({"query_id": pa.array(query_ids.astype(np.int64)), "vec_id": pa.array(found.astype(np.int64)), "score": pa.array(scores.astype(np.float64))})

    spread = F.create_map(*(F.lit(x) for item in parts.items() for x in item))
    held = indexed.select(
        "a",
        F.pmod(F.xxhash64("vec_id", "v"), F.element_at(spread, F.col("a"))).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))).alias("qpart"),
        "vec_id",
        "v",
        "b",
    )
    probes = asked.select("vec_id", "v").mapInArrow(probe, "a int, part int, qpart int, query_id long, q binary, bs array<int>")
    keys = ["a", "part", "qpart"]
    found = held.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInArrow(rerank, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= p.neighbours).select("query_id", "rank", "vec_id", "score")
