"""N-gram Jaccard join of all documents, exact, in the metric space of Jaccard distance.

1 - intersection / union is a metric. A region takes some of its documents as
pivots; every document goes home to its nearest pivot. If x (home i) and y (home
j) are within e, then d(y, pivot i) - d(y, pivot j) <= 2 e: so a document is
copied to each earlier region where this window holds, and no link is lost.
Regions split again until they are small, or until copies would undo the gain;
then all their pairs are compared on whole sets, in blocks. Two copies meet in
other regions too, where one of them is at home, and are passed over here, so
every pair counts once.

Texts of their own are at distance 1 of each other and of all pivots, so pivots
cannot part them, and windows would copy each of them everywhere. Therefore
regions begin as what the rarest shingles hold together. If at least p of the
union is shared, then so is p of either set; hence a document most of whose
shingles no other has is linked with nothing, and two linked documents share one
of their first n - ceil(p n) + 1 shingles, rarest first. Documents chained by such
shingles are a region; there are no links between regions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aislecast.llm import text
from aislecast.llm.blocks import (
    NO_ID,
    Block,
    bucket_of,
    message,
    pack,
    per_block,
    per_bucket,
    read_counts,
    read_keys,
    split_by_bucket,
    sub_blocks,
    write_counts,
    write_keys,
)
from aislecast.llm.components import connected_components
from aislecast.session import stage


@dataclass(frozen=True)
class MetricJoin:
    shingle: int = 5
    percent: int = 80  # of the union that must be shared
    pivots: int = 16  # of a region
    leaf: int = 1024  # documents of a region, or of a slice of one, that are compared at once
    leaf_bytes: int = 32 << 20  # and their sets
    levels: int = 4
    gain: float = 0.7  # part of its pairs that a region may keep when it splits
    block_bytes: int = 4 << 20
    bucket_bytes: int = 16 << 20  # of text whose shingles one bucket counts

    @property
    def reach(self) -> float:
        """The largest distance of a link."""
        return 1 - self.percent / 100


def _sets(block: Block, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row in the block and sorted shingles of every text."""
    for i, _, data, at in sub_blocks(block):
        starts, ends, bounds = text.words(data, at)
        hashed = text.hashes(data, starts, ends)
        for k in range(len(at) - 1):
            yield i + k, text.shingles(hashed[bounds[k] : bounds[k + 1]], size)


def _keys(block: Block, size: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray, np.ndarray]:
    """The sets of a block, all their shingles, and in how many sets each is."""
    sets = list(_sets(block, size))
    every = np.concatenate([s for _, s in sets] or [np.empty(0, np.uint64)])
    keys, counts = np.unique(every, return_counts=True)
    return sets, keys, counts


def _count_documents(blocks: DataFrame, buckets: int, size: int) -> DataFrame:
    """How many documents hold each of a block's shingles, as answers (block, bucket, payload)."""

    def ask(number: int, block: Block, _: dict) -> Iterator[pa.RecordBatch]:
        _, keys, counts = _keys(block, size)
        for bucket, s in split_by_bucket(bucket_of(keys, buckets), buckets):
            head = write_keys(keys[s])
            yield message(number, bucket, len(head).to_bytes(8, "little") + head + write_counts(counts[s]))

    def answer(payloads: list) -> tuple[list[bytes], None]:
        keys, counts = [], []
        for p in payloads:
            end = 8 + int.from_bytes(p[:8], "little")
            keys.append(read_keys(bytes(p[8:end])))
            counts.append(read_counts(p, end)[0])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        return [write_counts(total[place[e - len(k) : e]]) for k, e in zip(keys, ends, strict=True)], None

    return per_bucket(per_block(blocks, ask, "block long, bucket int, payload binary"), answer)


def _described(blocks: DataFrame, answers: DataFrame, buckets: int, p: MetricJoin) -> DataFrame:
    """doc_id, n_shingles and node of every row; set and rare shingles of those that may have a link.

    node is a 64-bit digest of the set, null without words. Of a block's equal
    sets the first has the set.
    """

    def run(number: int, block: Block, known: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        sets, keys, _ = _keys(block, p.shingle)
        df = np.concatenate([read_counts(known[b], 0)[0] for b, _ in split_by_bucket(bucket_of(keys, buckets), buckets)] or [np.empty(0, np.int64)])
        seen: set[int] = set()
        out: list[list] = [[], [], [], [], []]
        for i, one in sets:
            node = whole = rare = None
            if len(one):
                node = int.from_bytes(hashlib.blake2b(one.tobytes(), digest_size=8).digest(), "little", signed=True)
                if node not in seen:
                    seen.add(node)
                    held = df[np.searchsorted(keys, one)]
                    least = -(-p.percent * len(one) // 100)
                    if (held > 1).sum() >= least:
                        first = np.lexsort((one, held))[: len(one) - least + 1]
                        whole, rare = one.tobytes(), one[first[held[first] > 1]].view(np.int64)
            for into, value in zip(out, (None if block.ids[i] == NO_ID else int(block.ids[i]), len(one), node, whole, rare), strict=True):
                into.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["doc_id", "n_shingles", "node", "shingles", "rare"])

    return per_block(blocks, run, "doc_id long, n_shingles long, node long, shingles binary, rare array<long>", answers)


def _read(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.uint64) for v in column]


def shared(sets: list[np.ndarray], pivot: np.ndarray) -> np.ndarray:
    """Size of every set's intersection with one set; all are sorted."""
    every = np.concatenate([*sets, np.zeros(1, np.uint64)])
    place = np.minimum(np.searchsorted(pivot, every), len(pivot) - 1)
    total = np.concatenate([[0], np.cumsum(pivot[place] == every)])
    size = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(size)
    return total[ends] - total[ends - size]


def windows(distance: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From distances to pivots: document, region, and whether it is only copied there."""
    home = distance.argmin(1)
    nearest = distance[np.arange(len(distance)), home]
    inside = distance - nearest[:, None] <= 2 * reach + 1e-9
    inside &= np.arange(distance.shape[1]) < home[:, None]
    document, region = np.nonzero(inside)
    return (
        np.concatenate([np.arange(len(distance)), document]),
        np.concatenate([home, region]),
        np.concatenate([np.zeros(len(distance), bool), np.ones(len(document), bool)]),
    )


MEMBER = "node long, n long, copies long, guest long, shingles binary"
NAMES = ["node", "n", "copies", "guest", "shingles"]


def _split(members: DataFrame, level: int, p: MetricJoin) -> DataFrame:
    """The regions below each region: parent and region, then the member."""
    order = Window.partitionBy("region").orderBy(F.xxhash64("node", F.lit(level)), "node")
    chosen = members.select("region", "node").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= p.pivots)
    parts = members.select("region", "parts").distinct()
    pivots = (
        chosen.join(members.select("region", "node", "shingles"), ["region", "node"])
        .join(parts, "region")
        .select("region", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "rank", "shingles")
        .toDF("of", "at", "rank", "pivot")
    )

    def assign(own: pa.Table, pivots: pa.Table) -> pa.Table:
        pivots = pivots.sort_by("rank")
        sets = _read(own.column("shingles"))
        size = np.array([len(s) for s in sets], np.int64)
        distance = np.empty((len(sets), len(pivots)))
        for k, one in enumerate(_read(pivots.column("pivot"))):
            met = shared(sets, one)
            distance[:, k] = 1 - met / (size + len(one) - met)
        if not len(sets):  # a part with pivots alone
            distance = np.empty((0, 1))
        document, child, copied = windows(distance, p.reach)
        parent = own.column("region").to_numpy()[document]
        region = text.mix(parent.view(np.uint64) + text.mix(child.astype(np.uint64) + np.uint64(level + 1))).view(np.int64)
        guest = own.column("guest").to_numpy()[document] | (copied.astype(np.int64) << level)
        taken = own.select(NAMES).take(pa.array(document)).set_column(3, "guest", pa.array(guest))
        return taken.add_column(0, "region", pa.array(region)).add_column(0, "parent", pa.array(parent))

    left = members.withColumn("part", F.pmod(F.xxhash64("node", F.lit(-1)), F.col("parts")).cast("int"))
    cut = left.groupBy("region", "part").cogroup(pivots.groupBy("of", "at")).applyInArrow(assign, f"parent long, region long, {MEMBER}")
    return stage(cut, "jaccard-regions")


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Of all pairs, whether they are linked: products of the sets x shingles incidence, so many columns at a time."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    often = count[column] > 1  # other shingles are in no intersection
    name = np.cumsum(count > 1) - 1
    row, column = row[often], name[column[often]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    met = np.zeros((n, n), np.float32)
    width = int(min(4096, max(1, column[-1] + 1 if len(column) else 1)))
    for k in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        s = slice(*np.searchsorted(column, [k, k + width]))
        part = np.zeros((n, width), np.float32)
        part[row[s], column[s] - k] = 1
        met += part @ part.T
    met = met.astype(np.int64)
    return 100 * met >= percent * (size[:, None] + size - met)


def joined(links: np.ndarray) -> np.ndarray:
    """The first document reachable from each."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label, len(links)).min(1, initial=len(links))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(members: DataFrame, p: MetricJoin) -> DataFrame:
    """node, root and links of every member in every comparison; root is a node it is joined with, or itself."""
    parts = F.col("parts")
    own = F.pmod(F.xxhash64("node", F.lit(-2)), parts).cast("int").alias("own")
    met = members.select("region", own, F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"), *NAMES)
    met = met.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other")

    def compare(table: pa.Table) -> pa.Table:
        node, guest, own, copies = (table.column(c).to_numpy() for c in ("node", "guest", "own", "copies"))
        links = linked(_read(table.column("shingles")), p.percent)
        np.fill_diagonal(links, False)
        links &= (guest[:, None] & guest) == 0
        if table.column("i")[0] != table.column("j")[0]:
            links &= own[:, None] != own
        return pa.table({"node": node, "root": node[joined(links)], "links": pa.array(links @ copies, pa.int64())})

    return met.groupBy("region", "i", "j").applyInArrow(compare, "node long, root long, links long")


def _sized(members: DataFrame, p: MetricJoin) -> DataFrame:
    """Add the parts a region is compared in; regions of one document go."""
    sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("c"), F.sum(F.octet_length("shingles")).alias("b")).filter("c > 1")
    parts = F.ceil(F.greatest(F.col("c") / p.leaf, F.col("b") / p.leaf_bytes)).cast("int")
    return members.join(sizes.select("region", parts.alias("parts"), F.col("c").alias("size")), "region")


def similarity_join(
    docs: DataFrame, params: MetricJoin | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id and n_links.

    component_id is the smallest id reachable over links, the row's own
    included; n_links counts the other rows a row is linked with, rows of the
    same set among them. Text without words (null and empty too) is linked with
    nothing. Every row is a document of its own, also rows of equal or no id; a
    component of rows without ids has none. No rows give no rows. Other columns
    are ignored.

    Sets are of 64-bit hashes of the shingles, and equal sets are told by a
    64-bit digest; both are the same for the same words.
    """
    p = params or MetricJoin()
    blocks, size = pack(docs, "jaccard", p.block_bytes, id_col, text_col)
    buckets = max(1, -(-size // p.bucket_bytes))
    rows = stage(_described(blocks, _count_documents(blocks, buckets, p.shingle), buckets, p), "jaccard-rows")
    classes = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    sets = rows.filter("shingles is not null").select("node", F.col("n_shingles").alias("n"), "rare", "shingles").dropDuplicates(["node"])
    sets = stage(sets.join(classes.select("node", "copies"), "node"), "jaccard-sets")

    # Regions to begin with.
    by_shingle = sets.select("node", F.explode("rare").alias("shingle"))
    first = by_shingle.groupBy("shingle").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    chained = by_shingle.join(first, "shingle").filter("node <> v").select(F.col("node").alias("u"), "v")
    seeds = connected_components(chained).withColumnRenamed("component", "region")
    members = stage(_sized(sets.drop("rare").withColumn("guest", F.lit(0).cast("long")).join(seeds, "node"), p), "jaccard-regions")

    compared = []
    for level in range(p.levels):
        large = members.filter("parts > 1")
        compared.append(_compare(members.filter("parts = 1"), p))
        if large.isEmpty():
            break
        below = _sized(_split(large, level, p), p)
        pairs = F.sum(F.col("size").cast("double")).alias("after")  # every member of a region counts its size
        kept = below.groupBy("parent").agg(pairs).withColumnRenamed("parent", "region")
        before = large.groupBy("region").agg(F.sum(F.col("size").cast("double")).alias("before"))
        worth = stage(before.join(kept, "region", "left").select("region", (F.coalesce("after", F.lit(0.0)) <= p.gain * F.col("before")).alias("worth")), "jaccard-worth")
        compared.append(_compare(large.join(worth.filter("not worth"), "region", "left_semi"), p))
        good = worth.filter("worth").select(F.col("region").alias("parent"))
        members = stage(below.join(good, "parent", "left_semi").drop("parent"), "jaccard-regions")
    else:
        compared.append(_compare(members, p))

    found = compared[0]
    for more in compared[1:]:
        found = found.union(more)
    found = stage(found, "jaccard-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    components = stage(connected_components(found.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))), "jaccard-components")
    named = classes.join(components, "node", "left").join(links, "node", "left").select("node", "low", "copies", F.coalesce("component", "node").alias("component"), "links")
    named = stage(named, "jaccard-classes")
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = named.join(lowest, "component").select("node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    none = F.col("node").isNull()
    return rows.drop("shingles", "rare").join(of_class, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(none, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
