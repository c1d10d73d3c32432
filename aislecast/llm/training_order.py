"""Token sequences written in training order.

Documents become token ids and are packed, end to end, into sequences of one
length. A keyed Feistel network permutes the numbers 0 .. 2^b - 1; walking its
cycles until a number falls below n makes it a permutation of the n sequences,
so every sequence knows its global slot without a sort key or a shuffle list.
Ranges of slots are then written as shards in which every sequence has the same
stride: slot s stands in shard s // size at byte (s % size) * stride. A reader
goes through shards in order and can resume at any slot.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aislecast.llm import text
from aislecast.llm.blocks import bounded_batches
from aislecast.llm.common import shuffle_partitions
from aislecast.session import stage, stage_by, stage_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
UNITS = 1 << 20  # remembered per worker; beyond it the memory starts anew


@dataclass(frozen=True)
class Order:
    key: int = 20_240_601
    length: int = 2048  # tokens of a sequence
    shard: int = 1024  # sequences of a shard
    end: int = 50_256  # the id between documents and at the end of the last
    rounds: int = 6
    block_bytes: int = 4 << 20  # of token ids packed together

    @property
    def stride(self) -> int:
        return 2 * self.length


def slots(index: np.ndarray, n: int, p: Order) -> np.ndarray:
    """The permutation's value for every index below n."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask = np.uint64((1 << half) - 1)
    keys = text.mix(np.arange(1, p.rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(p.key))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (text.mix(right + k) & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while (outside := out >= n).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


@cache
def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokens:
    """Token ids of texts, by words that are remembered.

    The pattern never joins across a change from a word to the space after it,
    so a word with the one space before it has the same ids wherever it stands.
    Texts with longer or unusual white space are encoded whole.
    """

    def __init__(self, vocabulary: bytes):
        self.encoding = _encoding(vocabulary)
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.start, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint16)

    def _add(self, keys: list[int], words: list[bytes]) -> None:
        found = [self.encoding.encode_ordinary(w.decode()) for w in words]
        count = np.array([len(f) for f in found], dtype=np.int64)
        self.slot.update(zip(keys, range(len(self.start), len(self.start) + len(keys)), strict=True))
        self.start = np.append(self.start, len(self.ids) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.ids = np.append(self.ids, np.array([i for f in found for i in f], dtype=np.uint16))

    def of(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk, and the rows' bounds in them."""
        n = len(at) - 1
        starts, ends, bounds = text.words(data, at)
        row = np.repeat(np.arange(n), np.diff(bounds))
        # the gap before each word, and the one behind the last word of a row
        first = np.zeros(len(starts), dtype=bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        before = np.where(first, at[row], np.append(0, ends[:-1]) if len(ends) else 0)
        gap = starts - before
        odd = np.zeros(n, dtype=bool)
        odd[row[gap > 1]] = True
        has = np.diff(bounds) > 0
        tail = np.zeros(n, dtype=np.int64)
        tail[has] = at[1:][has] - ends[bounds[1:][has] - 1]
        tail[~has] = np.diff(at)[~has]
        odd |= tail > 0
        unusual = _UNUSUAL[data]
        unusual[:-1] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        odd[np.searchsorted(at, np.flatnonzero(unusual), side="right") - 1] = True
        spaced = (gap == 1) & (data[np.maximum(starts - 1, 0)] == 0x20)
        alone = (gap == 1) & ~spaced  # another character between: a unit of its own
        begin = np.concatenate([starts - spaced, starts[alone] - 1])
        end = np.concatenate([ends, starts[alone]])
        owner = np.concatenate([row, row[alone]])
        keep = ~odd[owner]
        order = np.argsort(begin[keep], kind="stable")
        begin, end, owner = begin[keep][order], end[keep][order], owner[keep][order]

        hashed = text.span_hashes(text.prefix_sums(data), begin, end)
        distinct, example, which = np.unique(hashed, return_index=True, return_inverse=True)
        if len(self.slot) + len(distinct) > UNITS:
            self.clear()
        keys = distinct.tolist()
        known = [self.slot.get(k, -1) for k in keys]
        new = [k for k, s in enumerate(known) if s < 0]
        if new:
            raw = data.tobytes()
            self._add([keys[k] for k in new], [raw[begin[example[k]] : end[example[k]]] for k in new])
            known = [self.slot[k] for k in keys]
        slot = np.array(known, dtype=np.int64)[which] if len(which) else np.empty(0, np.int64)
        count = self.count[slot]
        total = np.cumsum(count)
        flat = self.ids[np.arange(total[-1] if len(total) else 0) - np.repeat(total - count, count) + np.repeat(self.start[slot], count)]
        sizes = np.bincount(owner, count, n).astype(np.int64)
        whole = {r: self.encoding.encode_ordinary(data[at[r] : at[r + 1]].tobytes().decode()) for r in np.flatnonzero(odd).tolist()}
        if not whole:
            return flat, np.concatenate([[0], np.cumsum(sizes)])
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        parts = [np.array(whole[r], np.uint16) if r in whole else flat[cuts[r] : cuts[r + 1]] for r in range(n)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


# ASCII separators and first bytes of three-byte white space; C2 85 and C2 A0 are the two-byte ones.
_UNUSUAL = np.zeros(256, dtype=bool)
_UNUSUAL[[0x1C, 0x1D, 0x1E, 0x1F, 0xE1, 0xE2, 0xE3]] = True


def _packed(docs: DataFrame, p: Order, vocabulary: bytes, id_col: str, text_col: str) -> DataFrame:
    """Rows of sequences: block, n, data (n strides), and by sequence the ids of the documents in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(vocabulary)
        number = TaskContext.get().partitionId() << 32
        ids: list[np.ndarray] = []
        owners: list[tuple[int | None, int]] = []
        held = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, ids, owners, held
            flat = np.concatenate(ids)
            n = -(-len(flat) // p.length) if last else len(flat) // p.length
            used = min(len(flat), n * p.length)
            data = np.full(n * p.length, p.end, dtype=np.uint16)
            data[:used] = flat[:used]
            ends = np.cumsum([size for _, size in owners])
            begins = ends - np.array([size for _, size in owners])
            inside: list[list[int | None]] = [[] for _ in range(n)]
            left = []
            for (doc, _), a, b in zip(owners, begins.tolist(), ends.tolist(), strict=True):
                for k in range(a // p.length, min(n, -(-b // p.length))):
                    inside[k].append(doc)
                if b > used:
                    left.append((doc, b - max(a, used)))
            ids, owners, held = [flat[used:]], left, len(flat) - used
            if n:
                real = np.full(n, p.length)
                real[-1] = used - (n - 1) * p.length
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.array([n], pa.int64()),
                        pa.array([data.astype("<u2").tobytes()], pa.binary()),
                        pa.array([inside], pa.list_(pa.list_(pa.int64()))),
                        pa.array([real.tolist()], pa.list_(pa.int32())),
                    ],
                    ["block", "n", "data", "docs", "real"],
                )
                number += 1

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, j, data, at in text.chunks(batch.column(1)):
                flat, bounds = tokens.of(data, at)
                ids.append(np.insert(flat, bounds[1:], p.end))
                owners += zip(doc_ids[i:j], (np.diff(bounds) + 1).tolist(), strict=True)
                held += len(ids[-1])
                if 2 * held >= p.block_bytes:
                    yield from flush(last=False)
        if held:
            yield from flush(last=True)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "block long, n long, data binary, docs array<array<long>>, real array<int>")


def _first_numbers(sizes: DataFrame) -> DataFrame:
    """The number of each block's first sequence; groups of blocks keep windows small."""
    before = (Window.unboundedPreceding, -1)
    grouped = sizes.withColumn("part", F.shiftright("block", 32))
    parts = grouped.groupBy("part").agg(F.sum("n").alias("n"))
    start = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*before)), F.lit(0))
    own = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("block").rowsBetween(*before)), F.lit(0))
    return grouped.withColumn("own", own).join(parts.select("part", start.alias("start")), "part").select(
        "block", (F.col("start") + F.col("own")).alias("first")
    )


def write_training_order(
    docs: DataFrame,
    path: str,
    params: Order | None = None,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> int:
    """Write all sequences as shards below path; returns their number.

    A shard is one row of a Parquet table: shard, first_slot, n, stride, data
    (n strides of little-endian 16-bit ids) and, by sequence, docs (ids of the
    documents in it, null for a missing id) and real (ids before the padding).
    Rows of a file are in order of shard, and files are ranges of shards.

    A document is its ids and one end; null and empty text is an end alone.
    Documents are packed in the order a task reads them; only the last sequence
    of a task is padded, with ends. A document of any length spans sequences.
    Repeated rows are packed as often as they occur. No rows give no shards.
    Other columns are ignored.
    """
    p = params or Order()
    spark = docs.sparkSession
    bounded_batches(spark)
    packed = stage_by(_packed(docs, p, Path(vocabulary).read_bytes(), id_col, text_col), "packed", ["block"], ["block"], codec="zstd")
    total = packed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    firsts = stage(_first_numbers(packed.select("block", "n")), "first-numbers")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(len(whole)):
                row = {c: v[0] for c, v in zip(whole.schema.names, whole.slice(k, 1).columns, strict=True)}
                first, n = row["first"].as_py(), row["n"].as_py()
                slot = slots(np.arange(first, first + n), total, p)
                data = row["data"].as_buffer()
                pieces = pa.FixedSizeBinaryArray.from_buffers(pa.binary(p.stride), n, [None, data]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot // p.shard), pa.array(slot), pieces, row["docs"].values, row["real"].values],
                    ["shard", "slot", "data", "docs", "real"],
                )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held.clear()
            slot = rows.column("slot").to_numpy()
            data = rows.column("data")
            first, last = np.frombuffer(data.buffers()[1], np.int32)[[data.offset, data.offset + len(data)]]
            whole = data.buffers()[2].slice(int(first), int(last - first))
            data = pa.BinaryArray.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, whole.size], np.int32)), whole])
            one = lambda c: pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows.column(c))
            numbers = (int(slot[0] // p.shard), int(slot[0]), len(slot), p.stride)
            return pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int64()) for x in numbers), data, one("docs"), one("real")],
                ["shard", "first_slot", "n", "stride", "data", "docs", "real"],
            )

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and b > a and held[0].column("shard")[0].as_py() != shard[a]:
                    yield flush()
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield flush()

    rows = packed.join(firsts, "block").select("first", "n", "data", "docs", "real")
    spread = rows.mapInArrow(place, "shard long, slot long, data binary, docs array<long>, real int")
    # Slots are dense, so ranges of shards are known: nothing is sampled, and no row is placed twice.
    shards, parts = -(-total // p.shard) or 1, shuffle_partitions(spark)
    (
        spread.repartitionById(parts, F.expr(f"cast(shard * {parts} div {shards} as int)"))
        .sortWithinPartitions("slot")
        .mapInArrow(join, "shard long, first_slot long, n long, stride long, data binary, docs array<array<long>>, real array<int>")
        .write.option("compression", "zstd")
        .parquet(path)
    )
    return total


def read_training_order(spark: SparkSession, path: str, first_slot: int = 0, size: int = Order.shard) -> DataFrame:
    """The sequences from a slot on, in order of shards: slot, shard, data, docs and real.

    Shards before the slot's are skipped by the files' statistics.
    """
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(len(whole)):
                row = {c: v[0] for c, v in zip(whole.schema.names, whole.slice(k, 1).columns, strict=True)}
                n, first, stride = (row[c].as_py() for c in ("n", "first_slot", "stride"))
                skip = max(0, first_slot - first)
                data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(stride), n, [None, row["data"].as_buffer()]).cast(pa.binary())
                out = pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(first, first + n)), pa.array(np.full(n, row["shard"].as_py(), np.int64)), data, row["docs"].values, row["real"].values],
                    ["slot", "shard", "data", "docs", "real"],
                )
                yield out.slice(skip)

    shards = spark.read.parquet(path).filter(F.col("shard") >= first_slot // size)
    return shards.mapInArrow(run, "slot long, shard long, data binary, docs array<long>, real int")


def training_order(docs: DataFrame, params: Order | None = None) -> DataFrame:
    """Write the shards to a stage folder and tell what stands where: a row per sequence.

    slot, shard, offset (bytes from the shard's start), n_tokens (without
    padding), doc_ids and sha256 of the sequence's bytes as read back.
    """
    p = params or Order()
    spark = docs.sparkSession
    path = stage_path(spark, "training-order")
    write_training_order(docs, path, p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            digests = [hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column("data")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("slot"), batch.column("shard"), pa.array(slot % p.shard * p.stride), pc.cast(batch.column("real"), pa.int64()), batch.column("docs"), pa.array(digests)],
                ["slot", "shard", "offset", "n_tokens", "doc_ids", "sha256"],
            )

    schema = "slot long, shard long, offset long, n_tokens long, doc_ids array<long>, sha256 string"
    return read_training_order(spark, path, 0, p.shard).mapInArrow(run, schema)
