"""Hard negatives by walking lists that the anchors of a cluster share.

Anchors are clustered by direction. By the triangle inequality of angles, no
anchor u of a cluster has a larger inner product with a candidate x than
|u| |x| cos(max(0, angle(x, centroid) - radius)). Candidates are sorted by that
bound once for each cluster, largest first, and every anchor of the cluster
walks the same list until the bound of the next candidate is below all it still
looks for: the end is certified, so results are exact.

Candidates lie in blocks; a list is that of a block. Every pack of anchors meets
every block, and what the blocks give is merged by rank.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislecast.llm.blocks import bounded_batches
from aislecast.llm.multi_index import codebook, nearest_code
from aislecast.session import stage

NONE = -(1 << 62)  # below every score


@dataclass(frozen=True)
class HardNegatives:
    positives: int = 5
    negatives: int = 5
    scale: int = 256  # components become floor(scale * x)
    percent: int = 80  # of the positive's score that a negative must have, at least
    clusters: int = 64  # of anchors, at most
    sample: int = 5_000  # anchors the centroids are fitted on, about
    pack: int = 512  # anchors that walk together
    block_values: int = 1 << 18  # components in a block of candidates
    step: int = 256  # candidates a walk takes at a time


@dataclass
class Side:
    """Vectors with their ids and labels."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray

    @staticmethod
    def of(ids: pa.Scalar, labels: pa.Scalar, x: pa.Scalar) -> Side:
        one = lambda v, t: np.frombuffer(v.as_buffer(), t)
        n = len(one(ids, np.int64))
        return Side(one(ids, np.int64), one(labels, np.int64), one(x, np.int32).reshape(n, -1))


def scores(u: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products, exact."""
    top = [float(np.abs(v).max()) if v.size else 0.0 for v in (u, x)]
    if u.shape[1] * top[0] * top[1] < 1 << 53:
        return (u.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    return u.astype(np.int64) @ x.T.astype(np.int64)


class Best:
    """The first so many of each slot: by score, largest first, then by id."""

    def __init__(self, slots: int, size: int):
        self.score = np.full((slots, size), NONE, np.int64)
        self.id = np.full((slots, size), np.iinfo(np.int64).max)

    @property
    def last(self) -> np.ndarray:
        """The score of the last place; NONE while it is free."""
        return self.score[:, -1]

    def add(self, slots: np.ndarray, scores_: np.ndarray, ids: np.ndarray) -> None:
        if not len(slots):
            return
        size = self.score.shape[1]
        touched = np.unique(slots)
        all_slots = np.concatenate([np.repeat(touched, size), slots])
        all_scores = np.concatenate([self.score[touched].ravel(), scores_])
        all_ids = np.concatenate([self.id[touched].ravel(), ids])
        order = np.lexsort((all_ids, -all_scores, all_slots))
        sorted_slots = all_slots[order]
        place = np.arange(len(order)) - np.searchsorted(sorted_slots, sorted_slots)
        order, sorted_slots, place = (x[place < size] for x in (order, sorted_slots, place))
        self.score[sorted_slots, place] = all_scores[order]
        self.id[sorted_slots, place] = all_ids[order]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Slot, id and score of all that was found."""
        slot, place = np.nonzero(self.score > NONE)
        return slot, self.id[slot, place], self.score[slot, place]


class SharedList:
    """The candidates of a block by the bound of a cluster's anchors, and how far an anchor has to walk."""

    def __init__(self, anchors: Side, block: Side, centroid: np.ndarray):
        u, x = anchors.x.astype(np.float64), block.x.astype(np.float64)
        self.norms = np.sqrt((u * u).sum(1))
        size = np.sqrt((x * x).sum(1))
        self.slack = 1e-9 * self.norms * (size.max() if len(size) else 0) + 1e-6
        length = np.sqrt((centroid * centroid).sum())
        if length > 0:
            c = centroid / length
            turned = self.norms > 0
            radius = np.arccos(np.clip(u[turned] @ c / self.norms[turned], -1, 1)).max(initial=0)
            angle = np.arccos(np.clip(x @ c / np.where(size > 0, size, 1), -1, 1))
            self.bound = size * np.cos(np.maximum(0, angle - radius))
        else:
            self.bound = size
        self.order = np.argsort(-self.bound, kind="stable")

    def reach(self, k: int) -> np.ndarray:
        """No score from place k on is above this, for each anchor."""
        return self.norms * self.bound[self.order[k]] + self.slack

    def walk(self, anchors: Side, block: Side, step: int, wanted: Callable[[], np.ndarray], take: Callable) -> int:
        """Let every anchor walk until its reach is below what it wants; returns the candidates looked at."""
        looked = 0
        for k in range(0, len(self.order), step):
            going = np.flatnonzero(self.reach(k) >= wanted())
            if not len(going):
                break
            part = self.order[k : k + step]
            take(going, part, scores(anchors.x[going], block.x[part]))
            looked += len(going) * len(part)
        return looked


def nearest_of_label(anchors: Side, block: Side, centroid: np.ndarray, p: HardNegatives) -> tuple[Best, int]:
    """The first positives of every anchor in a block."""
    best = Best(len(anchors.ids), p.positives)

    def take(going: np.ndarray, part: np.ndarray, s: np.ndarray) -> None:
        fits = (anchors.labels[going, None] == block.labels[part]) & (anchors.ids[going, None] != block.ids[part])
        row, column = np.nonzero(fits & (s >= best.last[going, None]))
        best.add(going[row], s[row, column], block.ids[part][column])

    return best, SharedList(anchors, block, centroid).walk(anchors, block, p.step, lambda: best.last, take)


def nearest_below(anchors: Side, block: Side, centroid: np.ndarray, positive: np.ndarray, p: HardNegatives) -> tuple[Best, int]:
    """The first negatives of every anchor and positive in a block; positive: scores, NONE where there is none."""
    many = positive.shape[1]
    best = Best(positive.size, p.negatives)
    # smallest score with 100 * score >= percent * positive
    low = np.where(positive > NONE, -((-p.percent * np.maximum(positive, -(1 << 55))) // 100), 0)
    open_ = (positive > NONE) & (low <= positive)

    def floor() -> np.ndarray:
        return np.maximum(best.last.reshape(positive.shape), low)

    def wanted() -> np.ndarray:
        return np.where(open_, floor(), np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max).astype(np.float64)

    def take(going: np.ndarray, part: np.ndarray, s: np.ndarray) -> None:
        other = anchors.labels[going, None] != block.labels[part]
        least = floor()
        for k in range(many):
            fits = other & open_[going, k, None] & (s <= positive[going, k, None]) & (s >= least[going, k, None])
            row, column = np.nonzero(fits)
            best.add(going[row] * many + k, s[row, column], block.ids[part][column])

    return best, SharedList(anchors, block, centroid).walk(anchors, block, p.step, wanted, take)


def _rows(vectors: DataFrame, anchors: Column, p: HardNegatives, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, v and is_anchor of the rows that take part, one for every id."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("v"), anchors.alias("is_anchor")
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("v", fine), F.lit(False)))
    last = F.max(F.struct("label", "v", F.coalesce("is_anchor", F.lit(False)).alias("is_anchor"))).alias("r")
    return rows.groupBy("vec_id").agg(last).select("vec_id", "r.*")


def _packed(batches: Iterator[pa.RecordBatch], rows: int, limit: int, scale: int) -> Iterator[tuple[bytes, bytes, bytes]]:
    """Ids, labels and components, so many rows at a time; rows with a component beyond the limit are left out."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush(least: int) -> Iterator[tuple[bytes, bytes, bytes]]:
        while held and sum(len(h[0]) for h in held) >= least:
            ids, labels, x = (np.concatenate(part) for part in zip(*held, strict=True))
            held[:] = [(ids[rows:], labels[rows:], x[rows:])] if len(ids) > rows else []
            yield ids[:rows].tobytes(), labels[:rows].tobytes(), x[:rows].astype(np.int32).tobytes()

    for batch in batches:
        x = np.floor(batch.column("v").flatten().to_numpy().reshape(len(batch), -1) * scale)
        good = (np.abs(x) <= limit).all(1)
        held.append((batch.column("vec_id").to_numpy()[good], batch.column("label").to_numpy()[good], x[good]))
        yield from flush(rows)
    if sum(len(h[0]) for h in held):
        yield from flush(1)


SIDE = "ids binary, labels binary, x binary"


def _blocks(rows: DataFrame, size: int, limit: int, scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in _packed(batches, size, limit, scale):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in made], ["ids", "labels", "x"])

    return stage(rows.select("vec_id", "label", "v").mapInArrow(run, SIDE), "negative-blocks")


def _packs(anchors: DataFrame, centres: np.ndarray, p: HardNegatives, limit: int) -> DataFrame:
    """Anchors of one cluster, so many at a time, with their positives' ids and scores."""

    def cluster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(batch.column("v").flatten().to_numpy().reshape(len(batch), -1) * p.scale)
            norm = np.sqrt((x * x).sum(1))[:, None]
            yield batch.append_column("cluster", pa.array(nearest_code(x / np.where(norm > 0, norm, 1), centres).astype(np.int32)))

    named = anchors.mapInArrow(cluster, "vec_id long, label long, v array<double>, pos_ids array<long>, pos_scores array<long>, cluster int")
    sizes = {r["cluster"]: -(-r["count"] // p.pack) for r in named.groupBy("cluster").count().collect()}
    spread = F.create_map(*(F.lit(x) for item in sizes.items() for x in item))
    salt = F.pmod(F.xxhash64("vec_id"), F.element_at(spread, F.col("cluster")))

    def pack(table: pa.Table) -> pa.Table:
        x = np.floor(table.column("v").combine_chunks().flatten().to_numpy().reshape(len(table), -1) * p.scale)
        good = (np.abs(x) <= limit).all(1)
        table = table.filter(pa.array(good))
        wide = []
        for column, none in (("pos_ids", 0), ("pos_scores", NONE)):
            out = np.full((len(table), p.positives), none, np.int64)
            for i, values in enumerate(table.column(column).to_pylist()):
                out[i, : len(values or ())] = values or ()
            wide.append(out.tobytes())
        one = (table.column("vec_id").to_numpy().tobytes(), table.column("label").to_numpy().tobytes(), x[good].astype(np.int32).tobytes())
        centroid = centres[table.column("cluster")[0].as_py()].tobytes() if len(table) else b""
        return pa.table({k: pa.array([v], pa.binary()) for k, v in zip(("aids", "alabels", "ax", "pids", "pscores", "centroid"), (*one, *wide, centroid), strict=True)})

    return named.withColumn("salt", salt).groupBy("cluster", "salt").applyInArrow(
        pack, "aids binary, alabels binary, ax binary, pids binary, pscores binary, centroid binary"
    )


def _meet(packs: DataFrame, blocks: DataFrame, work: Callable[[dict], list[np.ndarray]], names: list[str]) -> DataFrame:
    """Every pack at every block. A task reads a part of both tables: nothing is copied, shuffled or broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                if len(row["aids"].as_buffer()):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in work(row)], names)

    met = blocks.join(packs.hint("shuffle_replicate_nl"))
    return met.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _first(found: DataFrame, by: list[str], score: str, of: str, n: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), of)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def mine(
    vectors: DataFrame,
    anchors: Column,
    params: HardNegatives | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    anchors is a condition on the vectors' columns. A row's score is its inner
    product with the anchor, of components floor(scale * x); larger ones come
    first, then smaller ids. An anchor's positives are its first rows of the same
    label; for each of them the first rows of other labels follow whose score is
    not above the positive's, and not below so many percent of it.

    Rows without id or label, and vectors that are null or hold null or
    non-finite components, take no part; nor do vectors of another length than
    most, and those with components so large that a hundred times a score might
    not fit 64 bits. Zero vectors score zero. Of rows of equal id the one of the
    greatest label, then vector, counts. An anchor without positives, or whose
    positives have no such negatives, has no rows; no rows give no rows. Other
    columns are ignored.

    The centroids, fitted on a bounded sample of anchors, go to every task.
    """
    p = params or HardNegatives()
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = stage(_rows(vectors, anchors, p, id_col, vector_col, label_col), "negative-rows")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    width = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    asked = rows.filter("is_anchor").select("vec_id", "label", "v")
    n = asked.count()
    if width is None or not width["d"] or not n:
        return spark.createDataFrame([], schema)
    d = width["d"]
    limit = int(min(((1 << 63) / 128 / d) ** 0.5, 1 << 30))
    same = F.size("v") == d
    rows, asked = rows.filter(same), asked.filter(same)
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) / float(1 << 20)
    drawn = asked.filter(draw < min(1.0, p.sample / n)).orderBy("vec_id").select("v").toPandas()["v"]
    sample = np.floor(np.stack(drawn.to_list()) * p.scale) if len(drawn) else np.zeros((1, d))
    norm = np.sqrt((sample * sample).sum(1))[:, None]
    centres = codebook(sample / np.where(norm > 0, norm, 1), int(min(p.clusters, max(1, n // 128))), 8)

    blocks = _blocks(rows, max(64, p.block_values // d), limit, p.scale)
    none = F.lit(None).cast("array<long>")

    def side(row: dict) -> tuple[Side, Side, np.ndarray]:
        return Side.of(row["aids"], row["alabels"], row["ax"]), Side.of(row["ids"], row["labels"], row["x"]), np.frombuffer(row["centroid"].as_buffer(), np.float64)

    def positives(row: dict) -> list[np.ndarray]:
        a, block, centroid = side(row)
        slot, ids, s = nearest_of_label(a, block, centroid, p)[0].found()
        return [a.ids[slot], ids, s]

    packs = stage(_packs(asked.select("*", none.alias("pos_ids"), none.alias("pos_scores")), centres, p, limit), "negative-packs")
    found = _meet(packs, blocks, positives, ["anchor_id", "positive_id", "positive_score"])
    near = (
        _first(found, ["anchor_id"], "positive_score", "positive_id", p.positives)
        .groupBy("anchor_id")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("l"))
        .select(F.col("anchor_id").alias("vec_id"), F.col("l.positive_id").alias("pos_ids"), F.col("l.positive_score").alias("pos_scores"))
    )

    def negatives(row: dict) -> list[np.ndarray]:
        a, block, centroid = side(row)
        ids, given = (np.frombuffer(row[k].as_buffer(), np.int64).reshape(-1, p.positives) for k in ("pids", "pscores"))
        slot, found_, s = nearest_below(a, block, centroid, given, p)[0].found()
        return [a.ids[slot // p.positives], ids.ravel()[slot], found_, given.ravel()[slot], s]

    second = stage(_packs(asked.join(near, "vec_id"), centres, p, limit), "negative-packs")
    found = _meet(second, blocks, negatives, ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])
    return _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", p.negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
