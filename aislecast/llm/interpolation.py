"""Language-model scores by deleted interpolation.

The probability of a token mixes the maximum-likelihood estimates of all orders,
    P_k = w_k(c) c(context, token) / c(context) + (1 - w_k(c)) P_(k-1),
down to P_0 = 1 / (V + 1). The weight of an order depends on how often its
context was seen, by buckets of powers of two. The weights are learned by
expectation-maximisation on training documents held out from the counts the
estimates are made of; then the held-out counts are added.

Counts are taken of all training documents and asked for by all documents, so
blocks of documents send distinct n-gram keys to buckets of the key space and
get the counts back.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
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
from aislecast.session import stage

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)


@dataclass(frozen=True)
class Interpolation:
    order: int = 2
    modulus: int = 7
    held_out: int = 2  # remainder of the documents that are not learned from
    deleted: int = 3  # remainder of those the weights are learned on
    buckets: int = 24  # of context counts, by powers of two
    grain: int = 4  # held-out probabilities are gathered to 1 / grain of a power of two
    rounds: int = 50
    block_bytes: int = 4 << 20
    bucket_bytes: int = 4 << 20  # of all text, per bucket of the key space


@dataclass
class Grams:
    """The tokens of some rows: n-gram keys by order (0 where the row is too short) and row bounds."""

    keys: list[np.ndarray]
    bounds: np.ndarray


def grams(data: np.ndarray, at: np.ndarray, order: int) -> Grams:
    starts, ends, bounds = text.words(data, at)
    hashed = text.hashes(data, starts, ends)
    n = len(at) - 1
    token_at = bounds + np.arange(n + 1)
    tokens = np.empty(token_at[-1], dtype=np.uint64)
    tokens[token_at[1:] - 1] = END
    inner = np.ones(len(tokens), dtype=bool)
    inner[token_at[1:] - 1] = False
    tokens[inner] = hashed
    place = np.arange(len(tokens)) - np.repeat(token_at[:-1], np.diff(token_at))
    keys = [text.mix(tokens)]
    before = np.where(place > 0, np.roll(tokens, 1), START)
    for k in range(2, order + 1):
        # the key of order k is that of the context, one token before, and the token
        context = np.roll(keys[-1], 1) if k > 2 else text.mix(before)
        key = text.mix(context * np.uint64(0x9E3779B97F4A7C15) + tokens + np.uint64(k))
        keys.append(np.where(place >= k - 2, key, np.uint64(0)))
    return Grams(keys, token_at)


def contexts(g: Grams, order: int) -> np.ndarray:
    """The key of order - 1 that each token's key of that order has as context."""
    key = np.roll(g.keys[order - 2], 1)
    if order == 2:
        key[g.bounds[:-1]] = text.mix(np.array([START]))[0]
    return np.where(g.keys[order - 1] != 0, key, np.uint64(0))


def remainders(ids: np.ndarray, modulus: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i == NO_ID else str(i).encode()) % modulus for i in ids.tolist()], dtype=np.int64)


def _count(p: Interpolation, buckets: int):
    """Distinct keys of a block, with their training and their deleted counts."""

    def run(number: int, block: Block, _: dict) -> Iterator[pa.RecordBatch]:
        fold = remainders(block.ids, p.modulus)
        keys: list[list[np.ndarray]] = [[] for _ in range(p.order)]
        folds = []
        for i, j, data, at in sub_blocks(block):
            g = grams(data, at, p.order)
            for k in range(p.order):
                keys[k].append(g.keys[k])
            folds.append(np.repeat(fold[i:j], np.diff(g.bounds)))
        of = np.concatenate(folds)
        starts = text.mix(np.full(len(fold), START))
        sent: dict[int, list[bytes]] = {}
        nothing = write_keys(np.empty(0, np.uint64)), write_counts(np.empty(0, np.int64)), write_counts(np.empty(0, np.int64))
        for k in range(p.order):
            key = np.concatenate([*keys[k], *([starts] if k == 0 else [])])
            own = np.concatenate([of, *([fold] if k == 0 else [])])
            own = own[key != 0]
            key = key[key != 0]
            order = np.argsort(key, kind="stable")
            key, own = key[order], own[order]
            heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
            if not len(heads):
                continue
            known = np.add.reduceat((own != p.held_out).astype(np.int64), heads)
            deleted = np.add.reduceat((own == p.deleted).astype(np.int64), heads)
            distinct = key[heads]
            for bucket, part in split_by_bucket(bucket_of(distinct, buckets), buckets):
                pieces = sent.setdefault(bucket, list(nothing) * p.order)
                pieces[3 * k : 3 * k + 3] = write_keys(distinct[part]), write_counts(known[part]), write_counts(deleted[part])
        for bucket, pieces in sent.items():
            head = np.array([len(x) for x in pieces[0::3]], np.int64).tobytes()
            yield message(number, bucket, head + b"".join(pieces))

    return run


def _total(p: Interpolation):
    """The counts over all blocks, for the keys of each message; and N and V of the bucket."""
    start = text.mix(np.array([START]))[0]

    def run(payloads: list) -> tuple[list[bytes], bytes]:
        read = [_asked(x, p.order) for x in payloads]
        out: list[list[bytes]] = [[] for _ in payloads]
        summary = [0, 0, 0, 0]
        for k in range(p.order):
            sizes = [len(r[k][0]) for r in read]
            key, known, deleted = (np.concatenate([r[k][m] for r in read]) for m in range(3))
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[True], key[order][1:] != key[order][:-1]])[: len(key)]
            heads = np.flatnonzero(new)
            total = np.add.reduceat(known[order], heads) if len(heads) else known
            apart = np.add.reduceat(deleted[order], heads) if len(heads) else deleted
            spread = np.diff(np.append(heads, len(key)))
            all_known, all_deleted = np.empty_like(known), np.empty_like(deleted)
            all_known[order], all_deleted[order] = np.repeat(total, spread), np.repeat(apart, spread)
            if k == 0 and len(heads):
                token = key[order][heads] != start
                for m, counts in enumerate((total, total - apart)):
                    summary[2 * m] += int(counts[token].sum())
                    summary[2 * m + 1] += int((counts[token] > 0).sum())
            at = np.concatenate([[0], np.cumsum(sizes)])
            for i in range(len(payloads)):
                part = slice(at[i], at[i + 1])
                out[i] += [write_counts(all_known[part]), write_counts(all_deleted[part])]
        return [b"".join(pieces) for pieces in out], np.array(summary, np.int64).tobytes()

    return run


def _asked(payload: memoryview, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, training counts and deleted counts of a message, by order."""
    sizes, at, out = np.frombuffer(payload, np.int64, order), 8 * order, []
    for size in sizes.tolist():
        keys = read_keys(payload[at : at + size])
        known, at = read_counts(payload, at + size)
        deleted, at = read_counts(payload, at)
        out.append((keys, known, deleted))
    return out


class Table:
    """The counts of a block's distinct keys."""

    def __init__(self, p: Interpolation, keys: list[np.ndarray], answers: dict[int, bytes]):
        found: list[list[np.ndarray]] = [[] for _ in range(2 * p.order)]
        for bucket in sorted(answers):
            at = 0
            for into in found:
                counts, at = read_counts(answers[bucket], at)
                into.append(counts)
        counts = [np.concatenate(f) if f else np.empty(0, np.int64) for f in found]
        self.keys, self.known, self.deleted = keys, counts[::2], counts[1::2]

    def of(self, order: int, key: np.ndarray, rest: bool) -> np.ndarray:
        """Counts by key of an order; rest leaves the deleted documents out."""
        at = np.searchsorted(self.keys[order], key)
        counts = self.known[order] - self.deleted[order] if rest else self.known[order]
        return np.where(key != 0, counts[np.minimum(at, len(counts) - 1)], 0)


def _table(p: Interpolation, block: Block, answers: dict[int, bytes]) -> tuple[Table, list[Grams]]:
    held = [(i, grams(data, at, p.order)) for i, _, data, at in sub_blocks(block)]
    keys = []
    for k in range(p.order):
        every = np.concatenate([g.keys[k] for _, g in held] + ([text.mix(np.array([START]))] if k == 0 else []))
        keys.append(np.unique(every[every != 0]))
    return Table(p, keys, answers), held


def _estimates(p: Interpolation, counts: Table, g: Grams, total: int, rest: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For every order from 1: estimates, and the buckets of their contexts (0: unseen)."""
    shares, places = [], []
    for k in range(1, p.order + 1):
        own = counts.of(k - 1, g.keys[k - 1], rest).astype(np.float64)
        if k == 1:
            seen = np.full(len(own), total)
        else:
            seen = counts.of(k - 2, contexts(g, k), rest)
        shares.append(own / np.maximum(seen, 1))
        places.append(np.minimum(np.frexp(seen.astype(np.float64))[1], p.buckets - 1))
    return shares, places


def first_weights(p: Interpolation) -> np.ndarray:
    weights = np.full((p.order, p.buckets), 0.5)
    weights[:, 0] = 0.0
    return weights


def expected(p: Interpolation, weights: np.ndarray, cells: np.ndarray, n: np.ndarray, uniform: float) -> np.ndarray:
    """Expected tokens by order and bucket: those an order's own estimate explains, and all that come down to it.

    These add up over parts of the cells.
    """
    places = cells[:, 0::2].astype(np.int64)
    shares = cells[:, 1::2]
    below = np.full(len(n), uniform)
    parts = []
    for k in range(p.order):
        w = weights[k, places[:, k]]
        parts.append((w * shares[:, k], (1 - w) * below))
        below = parts[-1][0] + parts[-1][1]
    out = np.zeros((2, p.order, p.buckets))
    reach = n.astype(np.float64)  # expected tokens that come down to this order
    for k in reversed(range(p.order)):
        taken, left = parts[k]
        share = taken / np.maximum(taken + left, 1e-300)
        out[0, k] = np.bincount(places[:, k], reach * share, p.buckets)
        out[1, k] = np.bincount(places[:, k], reach, p.buckets)
        reach = reach * (1 - share)
    return out


def next_weights(weights: np.ndarray, sums: np.ndarray) -> np.ndarray:
    num, den = sums
    out = np.where(den > 0, num / np.maximum(den, 1e-300), weights)
    out[:, 0] = 0.0
    return out


def learn_weights(p: Interpolation, cells: np.ndarray, n: np.ndarray, uniform: float) -> np.ndarray:
    """Weights (order, bucket) by expectation-maximisation.

    cells holds, per order, a bucket and a probability; n is how many tokens a
    cell stands for. The likelihood of the held-out tokens grows every round.
    """
    weights = first_weights(p)
    for _ in range(p.rounds):
        weights = next_weights(weights, expected(p, weights, cells, n, uniform))
    return np.clip(weights, 0.0, 1.0 - 1e-6)


def _pack_cells(columns: list[str]):
    """Cells as arrays, a row for each batch: buckets and steps in turn, and how many tokens each stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.stack([batch.column(c).to_numpy() for c in columns], axis=1).astype(np.int32)
            n = batch.column("n").to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (cells, n)], ["cells", "n"])

    return run


def learn_weights_of(p: Interpolation, cells: DataFrame, columns: list[str], uniform: float) -> np.ndarray:
    """The same of a table of cells, in the columns and n, with probabilities as steps of 1 / grain.

    The distinct cells grow with the corpus, so they stay in a stage table: tasks
    read it once a round, and the driver sees a sum of each task, which has as
    many numbers as there are weights.
    """
    packed = stage(cells.mapInArrow(_pack_cells(columns), "cells binary, n binary"), "lm-cells")

    def summed(weights: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for batch in batches:
                for row, n in zip(batch.column("cells"), batch.column("n"), strict=True):
                    values = np.frombuffer(row.as_buffer(), np.int32).reshape(-1, len(columns)).astype(np.float64)
                    steps = values[:, 1::2]
                    values[:, 1::2] = np.where(steps >= 0, 2.0 ** (-steps / p.grain), 0.0)
                    own = expected(p, weights, values, np.frombuffer(n.as_buffer(), np.int64), uniform)
                    sums = own if sums is None else sums + own
            if sums is not None:
                yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

        return run

    weights = first_weights(p)
    for _ in range(p.rounds):
        parts = [np.frombuffer(r["sums"]) for r in packed.mapInArrow(summed(weights), "sums binary").collect()]
        if not parts:
            break
        weights = next_weights(weights, np.sum(parts, axis=0).reshape(2, *weights.shape))
    return np.clip(weights, 0.0, 1.0 - 1e-6)


def _gather(p: Interpolation, total_rest: int):
    """The deleted documents' tokens, counted by buckets and rounded probabilities."""
    columns = [f"{x}{k}" for k in range(p.order) for x in "bq"]

    def run(_: int, block: Block, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        fold = remainders(block.ids, p.modulus) == p.deleted
        if not fold.any():
            return
        counts, held = _table(p, block, answers)
        rows = []
        for i, g in held:
            mine = np.repeat(fold[i : i + len(g.bounds) - 1], np.diff(g.bounds))
            shares, places = _estimates(p, counts, g, total_rest, rest=True)
            cells = []
            for share, place in zip(shares, places, strict=True):
                # -1: no estimate; otherwise steps of 1 / grain below 1
                steps = np.where(share > 0, np.rint(-p.grain * np.log2(np.maximum(share, 1e-300))), -1)
                cells += [place[mine].astype(np.int64), steps[mine].astype(np.int64)]
            rows.append(np.stack(cells, axis=1))
        found, n = np.unique(np.concatenate(rows), axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in found.T.copy()), pa.array(n.astype(np.int64))], [*columns, "n"])

    return run, columns


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T.copy()], [f"s{k}" for k in range(4)])


def lm_scores(docs: DataFrame, params: Interpolation | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A text's tokens are its lower-cased words and one end; null is empty text,
    which is one end. base_score adds one to unigram counts; score is the
    interpolated model's log10 probability. A null id is learned from as if its
    text were empty. Without any training text every token has probability 1.
    Repeated rows count as often as they occur. No rows give no rows. Other
    columns are ignored. Words are told apart by 64-bit hashes.
    """
    p = params or Interpolation()
    blocks, size = pack(docs, "lm", p.block_bytes, id_col, text_col)
    buckets = max(1, -(-size // p.bucket_bytes))
    schema = "block long, bucket int, payload binary"
    answers = stage(per_bucket(per_block(blocks, _count(p, buckets), schema), _total(p)), "lm-counts")

    # N and V with and without the deleted documents: a row per bucket, added up on the executors
    sums = answers.filter("block = -1").select("payload").mapInArrow(_numbers, "s0 long, s1 long, s2 long, s3 long")
    total, distinct, total_rest, distinct_rest = (
        v or 0 for v in sums.agg(*(F.sum(f"s{k}") for k in range(4))).first()
    )

    gather, columns = _gather(p, total_rest)
    cells = (
        per_block(blocks, gather, ", ".join(f"{c} long" for c in [*columns, "n"]), answers)
        .groupBy(*columns)
        .agg(F.sum("n").alias("n"))
    )
    weights = learn_weights_of(p, cells, columns, 1 / (distinct_rest + 1))

    def score(_: int, block: Block, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        fold = remainders(block.ids, p.modulus) == p.held_out
        counts, held = _table(p, block, answers)
        out: list[list[np.ndarray]] = [[], [], [], []]
        for _, g in held:
            own = counts.of(0, g.keys[0], rest=False)
            shares, places = _estimates(p, counts, g, total, rest=False)
            chance = np.full(len(own), 1 / (distinct + 1))
            for k in range(p.order):
                w = weights[k, places[k]]
                chance = w * shares[k] + (1 - w) * chance
            heads = g.bounds[:-1]
            base = np.log10((own + 1) / (total + distinct + 1))
            for into, x in zip(out, ((own > 0).astype(np.int64), base, np.log10(chance), np.ones(len(own), np.int64)), strict=True):
                into.append(np.add.reduceat(x, heads))
        known, base, real, n = (np.concatenate(x) for x in out)
        ids = pa.array(block.ids, pa.int64(), mask=block.ids == NO_ID)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(fold), pa.array(n), pa.array(known), pa.array(np.full(len(n), total, np.int64)), pa.array(base), pa.array(real)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return per_block(
        blocks,
        score,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        answers,
    )
