"""Removal of repeated passages by blockwise suffix sorting with a difference cover.

A byte goes if a string of some length covers it that also starts in a document
with a smaller id. The work has four steps.

1. Every window of that length is named by the smallest hash of the short
   strings in it, so equal windows have equal names. A name that occurs once
   holds no repeated window; the buckets of the name space tell which do.
2. Runs of windows of one repeated name go to the bin of the name, as text.
   A name with very many different runs (the edge of a common line) is cut
   into single windows, which go to bins by their own hash.
3. Each bin suffix-sorts its windows: first the cover sample (positions whose
   remainder modulo the period lies in a difference cover) is ranked, then one
   bucket of leading bytes is sorted at a time. Windows that tie over a whole
   period are ordered by the ranks of their cover positions: for any two there
   is a shift below the period that moves both onto the cover. Neighbours that
   share the full length are one string, and its smallest id is known.
4. The ranges found go back to their blocks, which drop the bytes.

Memory is bounded by the size of a block and of a bin; nothing is compared
across bins, as equal windows meet in one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from aislecast.llm import text
from aislecast.llm.blocks import (
    Block,
    bucket_of,
    from_ipc,
    message,
    pack,
    per_block,
    per_bucket,
    read_arrays,
    read_keys,
    split_by_bucket,
    sub_blocks,
    write_arrays,
    write_keys,
)
from aislecast.session import stage

# A perfect difference cover: the differences of its members are all residues.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
TIED = 8 * -(-PERIOD // 8)  # bytes compared before ranks are


@dataclass(frozen=True)
class Passages:
    length: int = 50
    block_bytes: int = 4 << 20
    bin_bytes: int = 4 << 20  # of all text, per bin; also sets the number of buckets
    hot_runs: int = 4096  # runs of one name from which it is cut into windows
    sort_bucket: int = 1 << 18  # windows sorted at a time

    def __post_init__(self) -> None:
        if self.length < TIED:
            raise ValueError(f"length must be at least {TIED}")

    @property
    def gram(self) -> int:
        return self.length // 2


def _shifts() -> np.ndarray:
    """For every two residues the least shift that moves both onto the cover."""
    on = np.zeros(2 * PERIOD, dtype=bool)
    on[[c + k for c in COVER for k in (0, PERIOD)]] = True
    table = np.zeros((PERIOD, PERIOD), dtype=np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            table[a, b] = next(d for d in range(PERIOD) if on[a + d] and on[b + d])
    return table


SHIFT = _shifts()


def _key(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, as numbers in byte order."""
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    return np.ascontiguousarray(eights[at]).view(">u8")[:, 0].astype(np.uint64)


def _prefix(padded: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The n bytes from each position, as strings that sort by byte."""
    windows = np.lib.stride_tricks.sliding_window_view(padded, n)
    return np.ascontiguousarray(windows[at]).view(f"S{n}")[:, 0]


def _changes(keys: list[np.ndarray]) -> np.ndarray:
    """Where a row differs from the one before it; the first one does."""
    out = np.zeros(len(keys[0]), dtype=bool)
    out[:1] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def cover_ranks(padded: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Ranks of the cover positions by their next bytes, at least depth; 0 elsewhere."""
    places = np.arange(n)
    on = np.zeros(PERIOD, dtype=bool)
    on[list(COVER)] = True
    places = places[on[places % PERIOD]]
    prefix = _prefix(padded, places, depth)
    order = np.argsort(prefix, kind="stable")
    ranks = np.zeros(len(padded), dtype=np.int32)
    ranks[places[order]] = np.cumsum(_changes([prefix[order]]))
    return ranks


def _settle(pos: np.ndarray, group: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The order of positions that tie within groups over a period, by cover ranks.

    All groups are partitioned at once around one pivot each, into smaller,
    equal and larger; equal ones are done.
    """
    order = np.arange(len(pos))
    slot = np.arange(len(pos))  # where the open positions stand in the result
    out = np.empty(len(pos), dtype=np.int64)
    turn = 0
    while len(order):
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(heads, len(group)))
        which = np.repeat(np.arange(len(heads)), sizes)
        pivot = pos[order[heads + (sizes * ((turn * 0.618 + 0.5) % 1)).astype(np.int64)]][which]
        mine = pos[order]
        shift = SHIFT[mine % PERIOD, pivot % PERIOD]
        side = np.sign(ranks[mine + shift].astype(np.int64) - ranks[pivot + shift]) + 1
        place = np.argsort(which * 3 + side, kind="stable")
        order, side, which = order[place], side[place], which[place]
        done = side == 1
        out[slot[done]] = order[done]
        order, slot, group = order[~done], slot[~done], (which * 3 + side)[~done]
        turn += 1
    return out


def equal_windows(data: np.ndarray, pos: np.ndarray, length: int, at_a_time: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions in suffix order, and whether each shares its full window with the one before it."""
    padded = np.concatenate([data, np.zeros(length + 2 * PERIOD + TIED + 8, dtype=np.uint8)])
    ranks = cover_ranks(padded, len(data) + PERIOD, length)
    first = _key(padded, pos)
    by_first = np.argsort(first, kind="stable")
    first = first[by_first]
    ordered, same = np.empty(len(pos), dtype=np.int64), np.zeros(len(pos), dtype=bool)
    start = 0
    while start < len(pos):
        end = min(len(pos), start + at_a_time)
        if end < len(pos):  # never cut a bucket of equal leading bytes
            end = int(np.searchsorted(first, first[end - 1], side="right"))
        part = pos[by_first[start:end]]
        prefix = _prefix(padded, part, TIED)
        order = np.argsort(prefix, kind="stable")
        part = part[order]
        ties = ~_changes([prefix[order]])
        group = np.cumsum(~ties)
        open_ = ties.copy()
        open_[:-1] |= ties[1:]
        inner = part[open_]
        inner = inner[_settle(inner, group[open_], ranks)]
        part[open_] = inner
        rest = [k for k in (*range(TIED, length - 7, 8), max(0, length - 8))]
        equal = ties.copy()
        near = np.flatnonzero(ties)
        for k in rest:
            equal[near] &= _key(padded, part[near] + k) == _key(padded, part[near - 1] + k)
        ordered[start:end], same[start:end] = part, equal
        start = end
    return ordered, same


def _names(data: np.ndarray, at: np.ndarray, p: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that lie in one row: their positions and names; and the bytes' prefix sums."""
    sums = text.prefix_sums(data)
    n = len(data) - p.length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64), sums
    low = text.span_hashes(sums, np.arange(len(data) - p.gram + 1), np.arange(p.gram, len(data) + 1))
    width, span = p.length - p.gram + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[: n], low[width - span :][:n])
    valid = np.ones(n, dtype=bool)
    for end in at[1:]:  # windows that would leave their row
        valid[max(0, end - p.length + 1) : end] = False
    pos = np.flatnonzero(valid)
    return pos, text.mix(low[pos]), sums


def _runs(pos: np.ndarray, name: np.ndarray, at: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first window of every run, and the runs' window counts."""
    cut = np.concatenate([[True], (pos[1:] != pos[:-1] + 1) | (name[1:] != name[:-1]) | single[1:] | single[:-1]])
    cut &= len(pos) > 0
    rows = np.searchsorted(at, pos, side="right")
    cut[1:] |= rows[1:] != rows[:-1]
    heads = np.flatnonzero(cut)
    return heads, np.diff(np.append(heads, len(pos)))


def _census(block: Block, p: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct names of a block, their numbers of different runs, and if rows of two ids have them."""
    parts = []
    for i, _, data, at in sub_blocks(block):
        pos, name, sums = _names(data, at, p)
        if not len(pos):
            continue
        heads, sizes = _runs(pos, name, at, np.zeros(len(pos), dtype=bool))
        starts = pos[heads]
        content = text.span_hashes(sums, starts, starts + sizes + p.length - 1)
        owner = block.ids[i + np.searchsorted(at, starts, side="right") - 1]
        parts.append((name[heads], content, owner))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, bool)
    name, content, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((content, name))
    name, content, owner = name[order], content[order], owner[order]
    new = np.concatenate([[True], name[1:] != name[:-1]])
    heads = np.flatnonzero(new)
    different = np.add.reduceat(_changes([name, content]).astype(np.uint32), heads)
    shared = np.minimum.reduceat(owner, heads) != np.maximum.reduceat(owner, heads)
    return name[heads], different.astype(np.uint32), shared


def _ask(p: Passages, buckets: int):
    def run(number: int, block: Block, _: dict) -> Iterator[pa.RecordBatch]:
        name, runs, shared = _census(block, p)
        for bucket, part in split_by_bucket(bucket_of(name, buckets), buckets):
            n = part.stop - part.start
            head = n.to_bytes(8, "little") + runs[part].tobytes() + shared[part].tobytes()
            yield message(number, bucket, head + write_keys(name[part]))

    return run


def _census_of(payload: memoryview) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(payload[:8], "little")
    runs, shared = np.frombuffer(payload, np.uint32, n, 8), np.frombuffer(payload, np.uint8, n, 8 + 4 * n)
    return read_keys(payload[8 + 5 * n :]), runs, shared


def _answer(p: Passages):
    """The names of each message that are shared, and those with too many runs."""

    def run(payloads: list) -> tuple[list[bytes], None]:
        read = [_census_of(x) for x in payloads]
        sizes = [len(x[0]) for x in read]
        name, runs, shared = (np.concatenate(x) for x in zip(*read, strict=True))
        order = np.argsort(name, kind="stable")
        heads = np.flatnonzero(_changes([name[order]]))
        holders = np.diff(np.append(heads, len(name)))
        total = np.add.reduceat(runs[order].astype(np.int64), heads)
        met = (holders > 1) | (np.maximum.reduceat(shared[order], heads) > 0)
        code = np.empty(len(name), dtype=np.uint8)
        code[order] = np.repeat(met * np.where(total > p.hot_runs, 2, 1), holders)
        out, start = [], 0
        for n in sizes:
            mine, names = code[start : start + n], name[start : start + n]
            out.append(names[mine == 1].tobytes() + names[mine == 2].tobytes() + np.array([np.count_nonzero(mine == 2)], np.int64).tobytes())
            start += n
        return out, None

    return run


def _known(answers: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All shared names, sorted, and whether each is cut into windows."""
    plain, hot = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for a in answers.values():
        n_hot = int(np.frombuffer(a[-8:], np.int64)[0])
        names = np.frombuffer(a[:-8], np.uint64)
        plain.append(names[: len(names) - n_hot])
        hot.append(names[len(names) - n_hot :])
    names = np.concatenate(plain + hot)
    flags = np.zeros(len(names), dtype=bool)
    flags[len(names) - sum(map(len, hot)) :] = True
    order = np.argsort(names)
    return names[order], flags[order]


def _send(p: Passages, bins: int):
    """Distinct runs of every bin with their texts and with where they stand in the block."""

    def run(number: int, block: Block, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        names, hot = _known(answers)
        parts = []
        for i, _, data, at in sub_blocks(block):
            pos, name, sums = _names(data, at, p)
            if not len(pos) or not len(names):
                continue
            found = np.minimum(np.searchsorted(names, name), len(names) - 1)
            held = names[found] == name
            pos, name, single = pos[held], name[held], hot[found[held]]
            if not len(pos):
                continue
            heads, sizes = _runs(pos, name, at, single)
            starts = pos[heads]
            content = text.span_hashes(sums, starts, starts + sizes + p.length - 1)
            key = np.where(single[heads], content, name[heads])
            owner = block.ids[i + np.searchsorted(at, starts, side="right") - 1]
            parts.append((key, content, sizes, starts + block.at[i], owner))
        if not parts:
            return
        key, content, sizes, starts, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
        bin_ = (key % np.uint64(bins)).astype(np.int64)
        order = np.lexsort((owner, sizes, content, bin_))
        bin_, content, sizes, starts, owner = (x[order] for x in (bin_, content, sizes, starts, owner))
        new = _changes([bin_, content, sizes])
        for b, part in split_by_bucket(bin_, bins):
            heads = np.flatnonzero(new[part]) + part.start
            lengths = sizes[heads] + p.length - 1
            pieces = b"".join(block.data[s : s + n].tobytes() for s, n in zip(starts[heads], lengths, strict=True))
            copies = np.diff(np.append(heads, part.stop))
            yield message(number, b, write_arrays(sizes[heads], copies, starts[part], owner[part]) + pieces)

    return run


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0 .. n - 1 for every n, in a row."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - counts, counts)


def _sort_bin(p: Passages):
    """For every message, the ranges of its block that a smaller id has too."""

    def run(payloads: list) -> tuple[list[bytes], None]:
        read = [read_arrays(x) for x in payloads]
        data = np.concatenate([np.frombuffer(x, np.uint8, offset=start) for x, (_, start) in zip(payloads, read, strict=True)])
        sizes = np.concatenate([a[0] for a, _ in read])
        copies = np.concatenate([a[1] for a, _ in read])
        starts = np.concatenate([a[2] for a, _ in read])
        owner = np.concatenate([a[3] for a, _ in read])
        lengths = sizes + p.length - 1
        begin = np.cumsum(lengths) - lengths
        pos = np.repeat(begin, sizes) + _ramp(sizes)
        lowest = np.repeat(owner[np.cumsum(copies) - copies], sizes)  # runs come with owners in order

        ordered, same = equal_windows(data, pos, p.length, p.sort_bucket)
        at_pos = np.zeros(len(data), dtype=np.int32)
        at_pos[pos] = np.arange(len(pos))
        back = at_pos[ordered]
        heads = np.flatnonzero(~same)
        least = np.minimum.reduceat(lowest[back], heads)
        first = np.empty(len(pos), dtype=np.int64)
        first[back] = np.repeat(least, np.diff(np.append(heads, len(pos))))

        # every copy of a run, window by window
        which = np.repeat(np.arange(len(sizes)), copies)
        window0 = (np.cumsum(sizes) - sizes)[which]
        n = sizes[which]
        copy = np.repeat(np.arange(len(which)), n)
        offset = _ramp(n)
        gone = first[window0[copy] + offset] < owner[copy]
        copy, offset = copy[gone], offset[gone]
        new = np.ones(len(copy), dtype=bool)
        new[1:] = (copy[1:] != copy[:-1]) | (offset[1:] != offset[:-1] + 1)
        heads = np.flatnonzero(new)
        last = np.append(heads[1:], len(copy)) - 1 if len(heads) else heads
        low = starts[copy[heads]] + offset[heads]
        high = starts[copy[last]] + offset[last] + p.length

        of = np.repeat(np.arange(len(payloads)), [len(a[2]) for a, _ in read])[copy[heads]]
        bounds = np.searchsorted(of, np.arange(len(payloads) + 1))
        return [write_arrays(low[a:b], high[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], None

    return run


def _gone(block: Block, answers: dict[int, bytes]) -> np.ndarray:
    """Which bytes of the block go."""
    change = np.zeros(len(block.data) + 1, dtype=np.int32)
    for payload in answers.values():
        (low, high), _ = read_arrays(payload)
        np.add.at(change, low, 1)
        np.add.at(change, high, -1)
    return np.cumsum(change[:-1]) > 0


def _ranges(docs: DataFrame, p: Passages, id_col: str, text_col: str, carry: bool) -> tuple[DataFrame, DataFrame]:
    """The blocks, and the answers with what to drop from each."""
    blocks, total = pack(docs, "passages", p.block_bytes, id_col, text_col, carry)
    parts = max(1, -(-total // p.bin_bytes))
    schema = "block long, bucket int, payload binary"
    names = stage(per_bucket(per_block(blocks, _ask(p, parts), schema), _answer(p)), "passage-names")
    runs = per_block(blocks, _send(p, parts), schema, names)
    return blocks, stage(per_bucket(runs, _sort_bin(p)), "passage-ranges")


def repeated_passages(
    docs: DataFrame, params: Passages | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans and kept_sha256.

    Texts are UTF-8 bytes and null is empty, with the digest of nothing.
    Matches do not cross rows and are judged on the input. Rows of equal id do
    not remove from each other; a null id counts as larger than all others. No
    rows give no rows. Other columns are ignored.
    """
    p = params or Passages()
    blocks, ranges = _ranges(docs, p, id_col, text_col, carry=False)

    def run(_: int, block: Block, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        gone = _gone(block, answers)
        at = block.at
        total = np.concatenate([[0], np.cumsum(gone)])
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        firsts = at[:-1][np.diff(at) > 0]
        begins[firsts] = gone[firsts]
        spans = np.concatenate([[0], np.cumsum(begins)])
        kept = block.data[~gone].tobytes()
        kept_at = at - total[at]
        digests = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(kept_at[:-1], kept_at[1:], strict=True)]
        ids = pa.array(block.ids, pa.int64(), mask=block.ids == np.iinfo(np.int64).max)
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array(x.astype(np.int64)) for x in (np.diff(at), np.diff(total[at]), np.diff(spans[at]))), pa.array(digests, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )

    return per_block(blocks, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", ranges)


def drop_passages(docs: DataFrame, params: Passages | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with repeated passages cut from their texts, all other columns as they came.

    A cut through a character drops what is left of the character. Null stays
    null. A column n_chars, if there is one, counts what stays.
    """
    p = params or Passages()
    blocks, ranges = _ranges(docs, p, id_col, text_col, carry=True)
    schema, columns = docs.schema, docs.columns
    text_at = columns.index(text_col)
    counted = columns.index("n_chars") if "n_chars" in columns and isinstance(schema["n_chars"].dataType, T.LongType) else None

    def run(_: int, block: Block, answers: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        gone = _gone(block, answers)
        total = np.concatenate([[0], np.cumsum(gone)])
        kept = block.data[~gone].tobytes()
        kept_at = block.at - total[block.at]
        rest = from_ipc(block.rest).combine_chunks()
        arrays = [c.combine_chunks() for c in rest.columns]
        was_null = arrays[text_at].is_null().to_numpy(zero_copy_only=False)
        texts = [
            None if missing else kept[a:b].decode("utf-8", "ignore")
            for a, b, missing in zip(kept_at[:-1], kept_at[1:], was_null, strict=True)
        ]
        arrays[text_at] = pa.array(texts, pa.string())
        if counted is not None:
            arrays[counted] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(arrays, columns)

    return per_block(blocks, run, schema, ranges)
