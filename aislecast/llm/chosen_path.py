"""Near-duplicate documents by a chosen-path set similarity join.

Every document's shingle set is embedded in a fixed number of minwise tokens.
In each of several independent trees a node picks some token positions, and a
document moves on to one child for each: the child of the position and of its
token there. Nodes that become small are compared exhaustively; large ones
branch again. Pairs found are confirmed on the full sets.

A pair of similarity s agrees at a position with probability s, so with b
picks and depth d it meets in a tree with probability p(d), p(0) = 1,
p(d) = 1 - (1 - s p(d - 1)) ** b. At s = 0.8, b = 2, d = 3 that is 0.92, and
six trees miss a pair with probability below 1e-6.

Groups of near copies would branch for ever. So the pairs of the first level,
and every member of a large node with one hub, are confirmed at once, and nodes
whose documents are by then in one component branch no more. What is left are
crowds: documents alike but not linked. Below the first levels their paths are
chosen by what sets them apart. Two documents x and y of different components
share only shingles that two components hold, and for any set h of shingles

    |x & y| <= min(|x & h|, |y & h|) + |(x & y) - h|.

Here h is what a hub and most of a draw of the crowd hold, its common text. So x
and y are linked only if the first term is enough, which it is for few sizes of y
when x is far from h, or if they share a shingle that h has not: documents that
share such a one are compared, or branch into a child of it if they are many. No
link between members of a node is lost, whatever is drawn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislecast.llm import text
from aislecast.llm.blocks import bounded_batches
from aislecast.llm.components import connected_components
from aislecast.session import stage


@dataclass(frozen=True)
class ChosenPath:
    shingle: int = 5
    percent: int = 80  # of the union that must be shared
    tokens: int = 128  # length of the embedding
    trees: int = 6
    picks: int = 2  # children of a document at a node of the first levels
    wide: int = 3  # these levels
    depth: int = 8  # levels below them
    leaf: int = 16  # nodes up to this size are compared exhaustively
    draw: int = 64  # members of a crowd its common text is taken from, about

    @property
    def floor(self) -> int:
        """Equal tokens below which a pair is not confirmed: five deviations under the limit."""
        s = self.percent / 100
        return int(self.tokens * (s - 5 * (s * (1 - s) / self.tokens) ** 0.5))


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    for _, _, data, at in text.chunks(column):
        starts, ends, bounds = text.words(data, at)
        hashed = text.hashes(data, starts, ends)
        for i in range(len(at) - 1):
            yield text.shingles(hashed[bounds[i] : bounds[i + 1]], size)


def _short(tokens: np.ndarray) -> bytes:
    """Sixteen bits of every token: enough to tell documents of one node apart."""
    return tokens.astype(np.uint16).tobytes()


def _embed(one: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The smallest image of the set under every multiplier."""
    low = np.full(len(multipliers), np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(one), 2048):
        np.minimum(low, (one[k : k + 2048, None] * multipliers).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def embed(docs: DataFrame, params: ChosenPath, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, print (digest of the set, null if empty), tokens and short tokens of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multipliers = text.constants(1, params.tokens)
        for batch in batches:
            counts, prints, tokens, short = [], [], [], []
            for one in _sets(batch.column(1), params.shingle):
                counts.append(len(one))
                prints.append(hashlib.blake2b(one.tobytes(), digest_size=16).digest() if len(one) else None)
                picked = _embed(one, multipliers) if len(one) else None
                tokens.append(None if picked is None else picked.tobytes())
                short.append(None if picked is None else _short(picked))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), *(pa.array(x, pa.binary()) for x in (prints, tokens, short))],
                ["doc_id", "n_shingles", "print", "tokens", "short"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, print binary, tokens binary, short binary"
    )


def _branch(nodes: DataFrame, params: ChosenPath, depth: int) -> DataFrame:
    """The children (node, rep) of every (node, rep, short); at depth 0 of every (rep, tokens) in every tree."""
    column = "short" if depth else "tokens"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.uint64(params.tokens)
        for whole in batches:
            for k in range(0, len(whole), 4096):
                batch = whole.slice(k, 4096)
                n = len(batch)
                reps = batch.column("rep").to_numpy()
                kind = np.uint16 if depth else np.uint32
                tokens = np.frombuffer(b"".join(batch.column(column).to_pylist()), kind).reshape(n, -1)
                rows = np.arange(n)
                if depth:
                    paths = batch.column("node").to_numpy().view(np.uint64)
                else:
                    paths = np.tile(text.mix(np.arange(1, params.trees + 1, dtype=np.uint64)), n)
                    rows = np.repeat(rows, params.trees)
                place, nodes_, owners = text.mix(paths) % width, [], []
                for pick in range(params.picks):
                    value = tokens[rows, place.astype(np.int64)].astype(np.uint64)
                    nodes_.append(text.mix(text.mix(paths + place) + value))
                    owners.append(reps[rows])
                    # the steps of all picks together are shorter than a round, so positions differ
                    place = (place + np.uint64(1) + text.mix(paths ^ np.uint64(pick + 1)) % (width // np.uint64(params.picks))) % width
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(nodes_).view(np.int64)), pa.array(np.concatenate(owners))], ["node", "rep"]
                )

    wanted = ["node", "rep", "short"] if depth else ["rep", "tokens"]
    return nodes.select(*wanted).mapInArrow(run, "node long, rep long")


def _members(children: DataFrame, labels: DataFrame | None) -> DataFrame:
    """node, rep, c, n, hub of the nodes that hold two documents not yet in one component."""
    if labels is None:
        named = children.withColumn("c", F.col("rep"))
    else:
        named = children.join(_label("rep", labels, "c"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    named = named.dropDuplicates(["node", "rep"])
    sizes = named.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(F.xxhash64("rep", "node"), "rep"))["rep"].alias("hub"),
        F.min("c").alias("_low"),
        F.max("c").alias("_high"),
    )
    return stage(named.join(sizes.filter("_low < _high").drop("_low", "_high"), "node"), "cp-members")


def _leaf_pairs(leaves: DataFrame, params: ChosenPath) -> DataFrame:
    """All pairs of each small node that are in two components and agree in enough tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for members in batch.column("members").to_pylist():
                reps = np.array([m["rep"] for m in members])
                own = np.array([m["c"] for m in members])
                tokens = np.frombuffer(b"".join(m["short"] for m in members), np.uint16).reshape(len(reps), -1)
                for i in range(len(reps) - 1):
                    same = (tokens[i + 1 :] == tokens[i]).sum(axis=1) >= params.floor
                    other = reps[i + 1 :][same & (own[i + 1 :] != own[i])]
                    left.append(np.minimum(other, reps[i]))
                    right.append(np.maximum(other, reps[i]))
            none = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(left or none)), pa.array(np.concatenate(right or none))], ["a", "b"]
            )

    grouped = leaves.groupBy("node").agg(F.collect_list(F.struct("rep", "c", "short")).alias("members"))
    return grouped.select("members").mapInArrow(run, "a long, b long").distinct()


def _agree(pairs: DataFrame, tokens: DataFrame, params: ChosenPath) -> DataFrame:
    """Only the pairs (a, b) that agree in enough tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(len(batch), -1)
                for c in ("ta", "tb")
            )
            keep = pa.array((ta == tb).sum(axis=1) >= params.floor)
            yield batch.select(["a", "b"]).filter(keep)

    side = lambda c: tokens.select(F.col("rep").alias(c), F.col("short").alias(f"t{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _bitmap(ids: DataFrame, hashed: Column) -> tuple[np.ndarray, int]:
    """Bits set for hashes of the ids, of a bounded number: sixteen an id, 32 MB at most.

    It only spares work: what meets a set bit by chance is dropped by later joins
    and intersections.
    """
    bits = 1 << min(28, max(20, (16 * max(1, ids.count()) - 1).bit_length()))
    place = F.pmod(hashed, F.lit(bits)) + 1
    rows = (
        ids.select(place.alias("p"))
        .groupBy(F.expr("bitmap_bucket_number(p)").alias("k"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits"))
        .collect()
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows:
        part = np.frombuffer(r["bits"], np.uint8)
        out[(r["k"] - 1) * len(part) : r["k"] * len(part)] = part
    return out, bits


def _test(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    return (bitmap[h >> 3] >> (h & 7).astype(np.uint8) & 1).astype(bool)


def _full_sets(ids: DataFrame, docs: DataFrame, params: ChosenPath, id_col: str, text_col: str) -> DataFrame:
    """id and full set of the documents with these ids, and by chance of a few others.

    Texts do not move: tasks know the documents by a bitmap.
    """
    bitmap, bits = _bitmap(ids.distinct(), F.xxhash64("id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_test(bitmap, batch.column(2).to_numpy())))
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                found = [one.tobytes() for one in _sets(part.column(1), params.shingle)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], ["id", "set"])

    texts = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    texts = texts.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(bits)))
    return stage(texts.mapInArrow(sets, "id long, set binary"), "cp-full")


def _linked(pairs: DataFrame, sets: DataFrame, params: ChosenPath) -> DataFrame:
    """The pairs (a, b) similar enough by the sets (id, n, set), as edges (u, v); n is the size of the whole set."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y, n in zip(batch.column("sa"), batch.column("sb"), batch.column("n").to_pylist(), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= params.percent * (n - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    side = lambda c: sets.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("set").alias(f"s{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), "sa", "sb").mapInArrow(check, "u long, v long")


def confirm(pairs: DataFrame, docs: DataFrame, params: ChosenPath, id_col: str, text_col: str) -> DataFrame:
    """The pairs whose full sets are similar enough, as edges (u, v)."""
    found = _full_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs, params, id_col, text_col)
    return _linked(pairs, found.withColumn("n", F.expr("length(set) div 8")), params)


def _held(members: DataFrame, docs: DataFrame, params: ChosenPath, id_col: str, text_col: str) -> DataFrame:
    """id, c, n and set of the members (rep, c) that can have a link to another component.

    n is the size of the whole set, set are the shingles that two components hold,
    and by chance a few others. Links to another component show in these alone.
    """
    own = members.select(F.col("rep").alias("id"), "c").distinct()
    found = _full_sets(own.select("id"), docs, params, id_col, text_col).dropDuplicates(["id", "set"])
    whole = stage(found.join(own, "id"), "cp-crowd")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in batch.column("set")]
            z = np.concatenate(sets or [np.empty(0, np.uint64)])
            c = np.repeat(batch.column("c").to_numpy(), [len(one) for one in sets])
            order = np.argsort(z, kind="stable")
            z, c = z[order], c[order]
            heads = np.flatnonzero(np.concatenate([[True], z[1:] != z[:-1]])) if len(z) else np.empty(0, np.int64)
            low, high = (f.reduceat(c, heads) if len(heads) else c for f in (np.minimum, np.maximum))
            yield pa.RecordBatch.from_arrays([pa.array(z[heads].view(np.int64)), pa.array(low), pa.array(high)], ["id", "low", "high"])

    holders = whole.select("c", "set").mapInArrow(spread, "id long, low long, high long").groupBy("id")
    shared = holders.agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("id")
    bitmap, bits = _bitmap(stage(shared, "cp-shared"), F.col("id"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sets = [], []
            for s in batch.column("set"):
                z = np.frombuffer(s.as_buffer(), np.uint64)
                counts.append(len(z))
                sets.append(z[_test(bitmap, (z & np.uint64(bits - 1)).astype(np.int64))].tobytes())
            enough = [100 * (len(s) // 8) >= params.percent * n for s, n in zip(sets, counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("c"), pa.array(counts, pa.int64()), pa.array(sets, pa.binary())], ["id", "c", "n", "set"]
            ).filter(pa.array(enough, pa.bool_()))

    return stage(whole.select("id", "c", "set").mapInArrow(keep, "id long, c long, n long, set binary"), "cp-held")


def _common(groups: DataFrame, held: DataFrame, params: ChosenPath) -> DataFrame:
    """For every hub: its c and n (ch, nh), the common text of its group, and which of it the hub holds (a byte each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, own = [], []
            for drawn, hub in zip(batch.column("drawn"), batch.column("set"), strict=True):
                h = np.frombuffer(hub.as_buffer(), np.uint64)
                z, counts = np.unique(np.frombuffer(b"".join(drawn.as_py() or []), np.uint64), return_counts=True)
                z = np.union1d(h, z[2 * counts > len(drawn)])
                common.append(z.tobytes())
                own.append(np.isin(z, h, assume_unique=True).tobytes())
            kept = [batch.column(c) for c in ("hub", "ch", "nh")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(common, pa.binary()), pa.array(own, pa.binary())], ["hub", "ch", "nh", "common", "own"])

    sizes = groups.groupBy("hub").agg(F.count(F.lit(1)).alias("m"))
    few = F.pmod(F.xxhash64("rep", "hub"), F.greatest(F.lit(1), F.expr(f"m div {params.draw}"))) == 0
    drawn = groups.join(sizes, "hub").filter(few).join(held.select(F.col("id").alias("rep"), "set"), "rep")
    drawn = drawn.groupBy("hub").agg(F.collect_list("set").alias("drawn"))
    hubs = held.dropDuplicates(["id"]).select(F.col("id").alias("hub"), F.col("c").alias("ch"), F.col("n").alias("nh"), "set")
    found = sizes.select("hub").join(hubs, "hub").join(drawn, "hub", "left")
    return found.mapInArrow(run, "hub long, ch long, nh long, common binary, own binary")


def _around(groups: DataFrame, held: DataFrame, params: ChosenPath) -> DataFrame:
    """For every (hub, rep): c, n, ch and nh of the hub, j and i (shingles shared with the hub and the common text), rest (the others), least n of the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, rest = ([], []), []
            for x, z, own in zip(batch.column("set"), batch.column("common"), batch.column("own"), strict=True):
                x, z = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, z))
                _, at, of = np.intersect1d(x, z, assume_unique=True, return_indices=True)
                shared[0].append(int(np.frombuffer(own.as_buffer(), bool)[of].sum()))
                shared[1].append(len(at))
                rest.append(np.delete(x, at).view(np.int64))
            names = ["hub", "rep", "c", "n", "ch", "nh"]
            kept = [batch.column(c) for c in names] + [pa.array(s, pa.int64()) for s in shared]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rest, pa.list_(pa.int64()))], [*names, "j", "i", "rest"])

    rows = groups.join(held.withColumnRenamed("id", "rep"), "rep").join(stage(_common(groups, held, params), "cp-common"), "hub")
    schema = "hub long, rep long, c long, n long, ch long, nh long, j long, i long, rest array<bigint>"
    rows = rows.select("hub", "rep", "c", "n", "ch", "nh", "set", "common", "own")
    found = stage(rows.mapInArrow(run, schema), "cp-around")
    return found.join(found.groupBy("hub").agg(F.min("n").alias("least")), "hub")


def _close_pairs(shared: DataFrame, params: ChosenPath) -> DataFrame:
    """Pairs (a, b) of two components among the few that share a shingle out of the common text, if they can be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for members in batch.column("members").to_pylist():
                rep, c, n, i, e = (np.array([m[k] for m in members]) for k in ("rep", "c", "n", "i", "e"))
                for k in range(len(rep) - 1):
                    most = np.minimum(i[k], i[k + 1 :]) + np.minimum(e[k], e[k + 1 :])
                    can = (100 + params.percent) * most >= params.percent * (n[k] + n[k + 1 :])
                    other = rep[k + 1 :][can & (c[k + 1 :] != c[k])]
                    left.append(np.minimum(other, rep[k]))
                    right.append(np.maximum(other, rep[k]))
            none = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left or none)), pa.array(np.concatenate(right or none))], ["a", "b"])

    grouped = shared.groupBy("hub", "z").agg(F.collect_list(F.struct("rep", "c", "n", "i", "e")).alias("members"))
    return grouped.select("members").mapInArrow(run, "a long, b long").distinct()


def _by_common_text(wide: DataFrame, params: ChosenPath) -> DataFrame:
    """Pairs (a, b) that can be linked by their parts of the common text alone; by size, as few sizes can."""
    p = params.percent
    sizes = F.sequence(F.greatest("least", F.ceil(F.col("n") * p / 100)), F.col("top"))
    own = wide.filter("c <> ch").withColumn("top", F.least(F.expr(f"{100 + p} * i div {p} - n"), F.expr(f"100 * n div {p}")))
    own = own.filter(F.col("top") >= F.greatest("least", F.ceil(F.col("n") * p / 100)))
    own = own.select("hub", F.col("rep").alias("x"), F.col("c").alias("cx"), F.col("n").alias("nx"), F.explode(sizes).alias("n"))
    met = own.join(wide.select("hub", "n", "rep", "c", "i"), ["hub", "n"])
    met = met.filter((F.col("c") != F.col("cx")) & ((100 + p) * F.col("i") >= p * (F.col("n") + F.col("nx"))))
    return met.select(F.least("rep", "x").alias("a"), F.greatest("rep", "x").alias("b")).distinct()


def _crowd_links(large: DataFrame, docs: DataFrame, short: DataFrame, params: ChosenPath, id_col: str, text_col: str) -> DataFrame | None:
    """Links (u, v) between the components of every large node (node, rep, c)."""
    held = _held(large, docs, params, id_col, text_col)
    nodes, found, p = large.select("node", "rep"), [], params.percent
    for level in range(1, params.depth + 1):
        named = nodes.join(held.select(F.col("id").alias("rep"), "c", "n", F.length("set").alias("f")), "rep").dropDuplicates(["node", "rep"])
        sizes = named.groupBy("node").agg(
            F.count(F.lit(1)).alias("m"),
            F.max(F.struct(F.col("f") / F.col("n"), -F.col("rep"), "rep"))["rep"].alias("hub"),
            F.bit_xor(F.xxhash64("rep")).alias("_x"),
            F.min("c").alias("_low"),
            F.max("c").alias("_high"),
        )
        # of nodes with the same members, one is enough
        one = sizes.filter("_low < _high").groupBy("m", "hub", "_x").agg(F.min("node").alias("node")).drop("_x")
        nodes = stage(named.select("node", "rep", "c").join(one, "node"), "cp-members")
        if nodes.isEmpty():
            break
        pairs = _leaf_pairs(nodes.filter(F.col("m") <= params.leaf).join(short, "rep"), params)
        nodes = nodes.filter(F.col("m") > params.leaf)
        if level == params.depth:
            found.append(stage(_linked(stage(pairs.union(_agree(_left_over(nodes), short, params)).distinct(), "cp-pairs"), held, params), "cp-links"))
            break

        around = _around(stage(nodes.select("hub", "rep").distinct(), "cp-groups"), held, params)
        stars = stage(around.filter(f"c <> ch and {100 + p} * j >= {p} * (n + nh)").select("rep", "hub", "c", "ch"), "cp-stars")
        if not stars.isEmpty():
            found.append(stars.select(F.col("rep").alias("u"), F.col("hub").alias("v")))
            merged = stage(connected_components(stars.select(F.col("c").alias("u"), F.col("ch").alias("v"))), "cp-labels")
            held = stage(_renamed(held, "c", merged), "cp-held")
            around = _renamed(_renamed(around, "c", merged), "ch", merged)
        can = around.withColumn("e", F.size("rest")).filter(f"{100 + p} * (i + e) >= {p} * (n + least)")
        spots = stage(can.select("hub", "rep", "c", "n", "i", "e", F.explode("rest").alias("z")), "cp-spots")
        spread = spots.groupBy("hub", "z").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("_low"), F.max("c").alias("_high"))
        shared = stage(spots.join(spread.filter("_low < _high").drop("_low", "_high"), ["hub", "z"]), "cp-spots")
        close = _close_pairs(shared.filter(F.col("m") <= params.leaf), params)
        alike = _by_common_text(can.filter(f"{100 + p} * i >= {p} * (n + least)"), params)
        pairs = stage(pairs.union(_agree(close.union(alike).distinct(), short, params)).distinct(), "cp-pairs")
        found.append(stage(_linked(pairs, held, params), "cp-links"))
        nodes = shared.filter(F.col("m") > params.leaf).select(F.xxhash64("hub", "z").alias("node"), "rep")
    return reduce(DataFrame.union, found) if found else None


def near_duplicates(
    docs: DataFrame,
    params: ChosenPath | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id and kept.

    component_id is the smallest id reachable over links, the row's own
    included; kept says that it is the row's own. Text without words (null and
    empty too) is linked with nothing, not even its copies. Rows of equal id
    are one node, linked as any of them is. A row without an id can follow a
    copy that has one; alone it has a null component and is kept. No rows give
    no rows. Other columns are ignored.

    Rows of equal sets are one class, of which only the smallest id goes on.
    Links inside one component need not all be found; between components they
    are, as above. In nodes still large at the last level, the members outside
    the hub's component are compared with all others.
    """
    params = params or ChosenPath()
    bounded_batches(docs.sparkSession)
    rows = stage(embed(docs, params, id_col, text_col), "cp-rows")
    reps = stage(
        rows.filter(F.col("print").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("print")
        .agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens"), F.first("short").alias("short")),
        "cp-classes",
    )
    short = reps.select("rep", "short")
    name = lambda links: stage(connected_components(links), "cp-labels")

    members = _members(_branch(reps, params, 0), None)
    large = members.filter(F.col("n") > params.leaf)
    stars = large.filter("rep <> hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
    pairs = stage(
        _leaf_pairs(members.filter(F.col("n") <= params.leaf).join(short, "rep"), params)
        .union(_agree(stars.distinct(), short, params))
        .distinct(),
        "cp-pairs",
    )
    links = stage(confirm(pairs, docs, params, id_col, text_col), "cp-links")
    labels = name(links)

    found = []
    large = _members(large.select("node", "rep"), labels)
    for depth in range(1, params.wide):
        if large.isEmpty():
            break
        children = stage(_branch(large.join(short, "rep"), params, depth), "cp-children")
        members = _members(children, labels)
        found.append(stage(_leaf_pairs(members.filter(F.col("n") <= params.leaf).join(short, "rep"), params), "cp-pairs"))
        large = members.filter(F.col("n") > params.leaf)
    if found:
        pairs = stage(reduce(DataFrame.union, found).distinct(), "cp-pairs")
        links = links.union(stage(confirm(pairs, docs, params, id_col, text_col), "cp-links"))
    if not large.isEmpty():
        more = _crowd_links(large, docs, short, params, id_col, text_col)
        links = links if more is None else links.union(more)
    if found:
        labels = name(links)

    classes = reps.select("print", F.col("rep").alias("node")).join(labels, "node", "left")
    classes = classes.select("print", F.coalesce("component", "node").alias("component_id"))
    component = F.coalesce("component_id", "doc_id")
    return rows.drop("tokens", "short").join(classes, "print", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _label(of: str, labels: DataFrame, name: str) -> DataFrame:
    return labels.select(F.col("node").alias(of), F.col("component").alias(name))


def _renamed(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """The rows with the column's components by their new labels."""
    new = _label(column, labels, "_new")
    return rows.join(new, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new").select(*rows.columns)


def _left_over(stuck: DataFrame) -> DataFrame:
    """In nodes that stayed large: members outside the hub's component, against all others."""
    of = stuck.filter("rep = hub").select("node", F.col("c").alias("ch"))
    out = stuck.join(of, "node").filter("c <> ch").select("node", F.col("rep").alias("x"), F.col("c").alias("cx"))
    met = stuck.join(out, "node").filter((F.col("c") != F.col("cx")) & (F.col("rep") != F.col("x")))
    return met.select(F.least("rep", "x").alias("a"), F.greatest("rep", "x").alias("b")).distinct()


def drop_near_duplicates(docs: DataFrame, params: ChosenPath | None = None) -> DataFrame:
    """The rows kept of every group, with the columns they came with.

    Of rows that share the kept id, one stays; rows without an id all stay.
    """
    found = near_duplicates(docs, params)
    kept = found.filter("kept and doc_id is not null").select(F.col("doc_id").alias("_kept")).distinct()
    one = docs.join(kept, F.col("doc_id") == F.col("_kept"), "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.filter(F.col("doc_id").isNull()))
