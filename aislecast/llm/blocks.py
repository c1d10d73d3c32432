"""Documents packed into blocks of some megabytes, and questions from block to bucket and back.

Some operators ask of every word, n-gram or string what all other documents
say of it. One row per question would cost more than the work itself, so a
block sends one sorted array of distinct keys to each bucket of the key space,
and the bucket's answer comes back as one array in the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aislecast.llm.text import CHUNK_BYTES
from aislecast.session import stage_by

NO_ID = np.iinfo(np.int64).max  # stands for a null id: larger than any other
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches of this session small, however long the rows are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_ipc(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


@dataclass
class Block:
    """Rows in a task: their ids, bytes, offsets and, as Arrow, their other columns."""

    ids: np.ndarray
    data: np.ndarray
    at: np.ndarray
    rest: bytes

    @staticmethod
    def of(row: dict) -> Block:
        one = lambda k, t: np.frombuffer(row[k], dtype=t)
        return Block(one("ids", np.int64), one("data", np.uint8), one("at", np.int64), row["rest"])


def pack(
    docs: DataFrame, name: str, block_bytes: int, id_col: str = "doc_id", text_col: str = "text", carry: bool = False
) -> tuple[DataFrame, int]:
    """The rows as a table of blocks, stored by block number; and all bytes of text.

    The table is bucketed by block, so that answers are joined to it without
    moving the texts; a file holds at least one block. With carry, blocks keep
    the rows' other columns.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    columns = docs.columns
    wanted = docs.select(
        F.col(id_col).cast("long").alias("id_"), F.col(text_col).cast("string").alias("text_"), *(docs.columns if carry else [])
    )
    wanted = wanted.toDF("id_", "text_", *(f"c{k}" for k in range(len(columns) if carry else 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number, size
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            texts = pc.fill_null(whole.column(1).cast(pa.large_string()), "")
            at = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())]).astype(np.int64)
            data = b"".join(t.as_buffer().to_pybytes() for t in texts) if at[-1] else b""
            ids = pc.fill_null(whole.column(0), int(NO_ID)).to_numpy().astype(np.int64)
            rest = ipc(whole.select(whole.schema.names[2:])) if carry else b""
            out = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), *(pa.array([x], pa.binary()) for x in (ids.tobytes(), at.tobytes(), data, rest))],
                ["block", "ids", "at", "data", "rest"],
            )
            held.clear()
            number, size = number + 1, 0
            return out

        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            ends, i = np.cumsum(lengths), 0
            while i < len(batch):
                before = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, before + max(0, block_bytes - size), side="right")))
                held.append(batch.slice(i, j - i))
                size += int(ends[j - 1] - before)
                i = j
                if size >= block_bytes or sum(map(len, held)) >= 50_000:
                    yield flush()
        if held:
            yield flush()

    packed = wanted.mapInArrow(run, "block long, ids binary, at binary, data binary, rest binary")
    table = stage_by(packed, name, ["block"], ["block"], codec="zstd")
    return table, table.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]


def per_block(
    blocks: DataFrame, run: Callable[[int, Block, dict[int, bytes]], Iterator[pa.RecordBatch]], schema: str, answers: DataFrame | None = None
) -> DataFrame:
    """Apply to every block, with its answers (bucket -> bytes) if there are any."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {k: v[0].as_py() if k == "answers" else v[0] for k, v in zip(batch.schema.names, batch.slice(i, 1).columns, strict=True)}
                known = {a["bucket"]: a["payload"] for a in row.pop("answers", None) or []}
                number = row.pop("block").as_py()
                fields = {k: v.as_buffer() if k != "rest" else v.as_py() for k, v in row.items()}
                yield from run(number, Block.of(fields), known)

    if answers is not None:
        grouped = answers.filter("block >= 0").groupBy("block").agg(F.collect_list(F.struct("bucket", "payload")).alias("answers"))
        blocks = blocks.join(grouped, "block", "left")
    return blocks.mapInArrow(each, schema)


def per_bucket(asked: DataFrame, run: Callable[[list], tuple[list[bytes], bytes | None]]) -> DataFrame:
    """Answer each bucket's questions together: rows (block, bucket, payload) to rows of the same shape.

    Besides the answers, a bucket may have a summary; it comes as block -1.
    """

    def each(table: pa.Table) -> pa.Table:
        answers, summary = run([memoryview(p.as_buffer()) for p in table.column("payload")])
        block, bucket = (table.column(c).to_pylist() for c in ("block", "bucket"))
        if summary is not None:
            block, bucket, answers = [*block, -1], [*bucket, bucket[0]], [*answers, summary]
        return pa.table(
            {"block": pa.array(block, pa.int64()), "bucket": pa.array(bucket, pa.int32()), "payload": pa.array(answers, pa.binary())}
        )

    return asked.groupBy("bucket").applyInArrow(each, "block long, bucket int, payload binary")


def message(block: int, bucket: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([bucket], pa.int32()), pa.array([payload], pa.binary())],
        ["block", "bucket", "payload"],
    )


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 64-bit key; sorted keys have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def split_by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Slices of equal bucket in an array sorted by bucket."""
    bounds = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(bounds)):
        yield int(b), slice(int(bounds[b]), int(bounds[b + 1]))


def sub_blocks(block: Block, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows first .. end of a block of about so many bytes, with their bytes and offsets."""
    i, n, at = 0, len(block.ids), block.at
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        yield i, j, block.data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def write_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of 64-bit numbers, with their lengths in front."""
    head = np.array([len(arrays), *map(len, arrays)], np.int64).tobytes()
    return head + b"".join(np.ascontiguousarray(a).view(np.int64).tobytes() for a in arrays)


def read_arrays(payload: bytes) -> tuple[list[np.ndarray], int]:
    """Those arrays, and where the bytes behind them begin."""
    n = int(np.frombuffer(payload, np.int64, 1)[0])
    sizes = np.frombuffer(payload, np.int64, n, 8)
    out, start = [], 8 * (n + 1)
    for size in sizes:
        out.append(np.frombuffer(payload, np.int64, int(size), start))
        start += 8 * int(size)
    return out, start


def write_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, in six bytes each if they fit."""
    if not len(keys):
        return b"\x06"
    steps = np.diff(keys, prepend=keys[:1])
    head = keys[:1].tobytes()
    if int(steps.max()) >> 48:
        return b"\x08" + head + steps.tobytes()
    return b"\x06" + head + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def read_keys(payload: bytes) -> np.ndarray:
    if len(payload) == 1:
        return np.empty(0, np.uint64)
    width = payload[0]
    raw = np.frombuffer(payload, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(raw), 8), dtype=np.uint8)
    steps[:, :width] = raw
    out = np.cumsum(steps.view(np.uint64)[:, 0], dtype=np.uint64)
    return out + np.frombuffer(payload[1:9], np.uint64)[0]


def write_counts(counts: np.ndarray) -> bytes:
    """Counts in one byte each, those of 255 and more listed behind."""
    large = np.flatnonzero(counts >= 255)
    head = np.array([len(counts), len(large)], np.int64).tobytes()
    return head + np.minimum(counts, 255).astype(np.uint8).tobytes() + large.astype(np.int64).tobytes() + counts[large].astype(np.int64).tobytes()


def read_counts(payload: bytes, start: int) -> tuple[np.ndarray, int]:
    """Those counts, and where they end."""
    n, m = (int(x) for x in np.frombuffer(payload, np.int64, 2, start))
    out = np.frombuffer(payload, np.uint8, n, start + 16).astype(np.int64)
    at = start + 16 + n
    out[np.frombuffer(payload, np.int64, m, at)] = np.frombuffer(payload, np.int64, m, at + 8 * m)
    return out, at + 16 * m
