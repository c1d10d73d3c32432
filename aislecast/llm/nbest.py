"""Encoding with SentencePiece models into the N best segmentations, and decoding.

A text is a lattice: an edge for every piece of the vocabulary that occurs in
it, weighted with the piece's score. Viterbi from the left gives the best score
up to every position; that is the exact remaining cost for a search from the
right, so A* takes segmentations off its queue in the order of their scores.

No piece crosses from a word into the space before the next, so the lattice of
a text is a chain of small ones ("units"). Their best segmentations are found
for many different units at once. A text's N best differ from its best in the
units with the N - 1 smallest losses at most; A* runs on those alone, and their
lists are merged in order.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislecast.llm import text
from aislecast.llm.blocks import bounded_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁".encode()
# The space sign itself, where a text has it, must not become a space: its first
# byte is replaced by one that no UTF-8 text and no piece has.
ESCAPED = b"\xf8" + SPACE[1:]
PENALTY = 10.0  # of a character without a piece, below the lowest score
UNITS = 1 << 20  # remembered per worker; beyond it the memory starts anew


class Pieces:
    """A model's pieces as a trie over bytes, with 0x20 for the space sign."""

    def __init__(self, model: bytes):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = m.get_piece_size()
        self.scores = np.array([m.get_score(i) for i in range(n)])
        self.bytes_ = [b""] * n
        self.byte_ids = np.full(256, m.unk_id(), dtype=np.int32)
        self.spoken = np.zeros(256, dtype=bool)
        children: list[dict[int, int]] = [{}]
        piece = [-1]
        for i in range(n):
            if m.is_byte(i):
                value = int(m.id_to_piece(i)[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_[i] = bytes([value])
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                self.bytes_[i] = own = m.id_to_piece(i).encode().replace(SPACE, b" ")
                node = 0
                for b in own:
                    if b not in children[node]:
                        children[node][b] = len(children)
                        children.append({})
                        piece.append(-1)
                    node = children[node][b]
                piece[node] = i
                self.spoken[list(own)] = True
        self.next = np.zeros((len(children), 256), dtype=np.int32)
        for node, found in enumerate(children):
            for b, to in found.items():
                self.next[node, b] = to
        self.piece = np.array(piece, dtype=np.int32)
        self.unknown = float(self.scores[self.piece[self.piece >= 0]].min(initial=0.0)) - PENALTY
        self.lengths = np.array([len(b) for b in self.bytes_], dtype=np.int64)
        self.flat = np.frombuffer(b"".join(self.bytes_), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def edges(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All lattice edges: start, end, piece (-1: bytes) and weight; ends[i] is where position i's unit ends."""
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        at, node, step = heads, np.zeros(len(heads), np.int32), 0
        single = np.zeros(len(data) + 1, dtype=bool)
        following = np.append(heads[1:], len(data))
        char_end = np.zeros(len(data) + 1, dtype=np.int64)
        char_end[heads] = following
        parts = []
        while len(at):
            open_ = at + step < ends[at]
            at, node = at[open_], node[open_]
            node = self.next[node, data[at + step]]
            at, node = at[node > 0], node[node > 0]
            step += 1
            hit = self.piece[node] >= 0
            found = at[hit]
            single[found[char_end[found] == found + step]] = True
            parts.append((found, found + step, self.piece[node[hit]]))
        bare = heads[~single[heads]]
        parts.append((bare, char_end[bare], np.full(len(bare), -1, np.int32)))
        start, end, piece = (np.concatenate(x) for x in zip(*parts, strict=True))
        return start, end, piece, np.where(piece >= 0, self.scores[piece], self.unknown)

    def ids_of(self, piece: int, own: bytes) -> list[int]:
        """The ids an edge stands for."""
        return [piece] if piece >= 0 else [int(self.byte_ids[b]) for b in own.replace(ESCAPED, SPACE)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for, with the spaces of a whole text's units."""
        n = self.lengths[ids]
        total = np.cumsum(n)
        at = np.arange(total[-1] if len(total) else 0) - np.repeat(total - n, n) + np.repeat(self.starts[ids], n)
        return self.flat[at].tobytes()


@cache
def _pieces(model: bytes) -> Pieces:
    return Pieces(model)


def decode(ids: list[int], model: bytes) -> str:
    """The text of ids; the space put before a text when it was encoded is dropped."""
    return _pieces(model).decode(np.array(ids, dtype=np.int64))[1:].decode("utf-8", "replace")


def search(unit: bytes, n: int, pieces: Pieces) -> list[tuple[float, list[int]]]:
    """The n best segmentations of a unit as (score, ids), best first, ties by ids' places.

    Forward Viterbi, then A* from the end with the forward scores as heuristic.
    """
    data = np.frombuffer(unit, np.uint8)
    start, end, piece, weight = pieces.edges(data, np.full(len(data), len(data)))
    into: list[list[tuple[int, int, float]]] = [[] for _ in range(len(data) + 1)]
    for s, e, p, w in zip(start.tolist(), end.tolist(), piece.tolist(), weight.tolist(), strict=True):
        into[e].append((s, p, w))
    best = [0.0] + [-np.inf] * len(data)
    for e in range(1, len(data) + 1):
        for s, _, w in into[e]:
            best[e] = max(best[e], best[s] + w)
    queue: list = [(-best[-1], 0, len(data), 0.0, ())]
    pushed, out = 1, []
    while queue and len(out) < n:
        _, _, at, right, path = heapq.heappop(queue)
        if at == 0:
            ids: list[int] = []
            while path:
                (s, e, p), path = path
                ids += pieces.ids_of(p, unit[s:e])
            out.append((right, ids))
            continue
        for s, p, w in into[at]:
            heapq.heappush(queue, (-(best[s] + w + right), pushed, s, right + w, ((s, at, p), path)))
            pushed += 1
    return out


class Memory:
    """The units a worker has met: best score, loss of the second best, and ids."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.score, self.gap = np.empty(0), np.empty(0)
        self.start, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)
        self.lists: dict[tuple[bytes, int], list] = {}

    def add(self, keys: list[int], data: np.ndarray, bounds: np.ndarray) -> None:
        """Segment the units data[bounds[i]:bounds[i + 1]] and remember them."""
        score, gap, ids, count = self._segment(data, bounds)
        first = len(self.score)
        self.slot.update(zip(keys, range(first, first + len(keys)), strict=True))
        self.start = np.append(self.start, len(self.ids) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.score, self.gap = np.append(self.score, score), np.append(self.gap, gap)
        self.ids = np.append(self.ids, ids)

    def _segment(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
        sizes = np.diff(bounds)
        unit_end, unit_start = np.repeat(bounds[1:], sizes), np.repeat(bounds[:-1], sizes)
        start, end, piece, weight = self.pieces.edges(data, unit_end)
        base = unit_start[start]
        # positions of a unit get one more place than it has bytes
        unit = np.repeat(np.arange(len(sizes)), sizes)
        shift = unit[start]
        tail, head = start + shift, end + shift
        forward = np.full(len(data) + len(sizes), -np.inf)
        backward = forward.copy()
        firsts, lasts = bounds[:-1] + np.arange(len(sizes)), bounds[1:] + np.arange(len(sizes))
        forward[firsts], backward[lasts] = 0.0, 0.0
        arrived = np.full(len(forward), -1, dtype=np.int64)

        reach = end - base
        order = np.lexsort((head, reach))
        for part in np.split(order, np.flatnonzero(np.diff(reach[order])) + 1):
            value = forward[tail[part]] + weight[part]
            to = head[part]
            cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            top = np.maximum.reduceat(value, cut)
            forward[to[cut]] = top
            won = np.flatnonzero(value == np.repeat(top, np.diff(np.append(cut, len(to)))))
            arrived[to[won[::-1]]] = part[won[::-1]]  # the first of equals stays
        away = unit_end[start] - start
        order = np.lexsort((tail, away))
        for part in np.split(order, np.flatnonzero(np.diff(away[order])) + 1):
            value = backward[head[part]] + weight[part]
            to = tail[part]
            cut = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            backward[to[cut]] = np.maximum.reduceat(value, cut)

        # follow the best edges of all units back at once
        used = np.zeros(len(start), dtype=bool)
        at = lasts
        while len(at):
            edge = arrived[at]
            used[edge] = True
            at = tail[edge]
            at = at[at != bounds[shift[edge]] + shift[edge]]
        score = forward[lasts]
        through = np.where(used, -np.inf, forward[tail] + weight + backward[head])
        second = np.full(len(sizes), -np.inf)
        np.maximum.at(second, shift[~used], through[~used])
        gap = np.where(np.isfinite(second), np.maximum(score - second, 0.0), np.inf)

        path = np.flatnonzero(used)
        path = path[np.argsort(start[path], kind="stable")]
        width = np.where(piece[path] >= 0, 1, end[path] - start[path])
        which = np.repeat(np.arange(len(path)), width)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(width) - width, width)
        raw = np.where(data == ESCAPED[0], SPACE[0], data)
        ids = np.where(piece[path][which] >= 0, piece[path][which], self.pieces.byte_ids[raw[start[path][which] + inside]])
        count = np.bincount(shift[path], width, len(sizes)).astype(np.int64)
        return score, gap, ids.astype(np.int32), count

    def alternatives(self, unit: bytes, n: int) -> list[tuple[float, np.ndarray]]:
        """(loss, ids) of the unit's n best, by A*."""
        if (unit, n) not in self.lists:
            found = search(unit, n, self.pieces)
            self.lists[unit, n] = [(found[0][0] - s, np.array(ids, np.int32)) for s, ids in found]
        return self.lists[unit, n]


def _units(data: np.ndarray, at: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with a space before every text, the units' bounds, and the rows' first units."""
    sizes = np.diff(at)
    some = sizes > 0
    heads = at[:-1][some]
    data = np.insert(data, heads, 0x20)
    at = np.concatenate([[0], np.cumsum(sizes + some)])
    quiet = ~pieces.spoken[data] & (data < 0x80)
    space = data == 0x20
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    cut[1:] |= quiet[1:] != quiet[:-1]
    cut[at[:-1][some]] = True
    bounds = np.append(np.flatnonzero(cut), len(data))
    return data, bounds, np.searchsorted(bounds, at)


def _orders(lists: list[list[tuple[float, np.ndarray]]], n: int) -> Iterator[tuple[float, tuple[int, ...]]]:
    """The n smallest sums of one loss from each list, with the choices, in order."""
    queue = [(0.0, (0,) * len(lists), 0)]
    while queue and n:
        loss, choice, first = heapq.heappop(queue)
        yield loss, choice
        n -= 1
        for k in range(first, len(lists)):
            if choice[k] + 1 < len(lists[k]):
                step = lists[k][choice[k] + 1][0] - lists[k][choice[k]][0]
                heapq.heappush(queue, (loss + step, (*choice[:k], choice[k] + 1, *choice[k + 1 :]), k))


def encode_nbest(
    docs: DataFrame, n: int = 4, model_path: str = MODEL, id_col: str = "doc_id", text_col: str = "text", ids_of: int = 1
) -> DataFrame:
    """The n best segmentations of every row: doc_id, rank (from 1), score, n_pieces, ids_sha256, round_trip, ids.

    Ranks up to ids_of carry their ids, later ones null; with 0 there is no
    column ids. A space goes before every text that is not empty, as the models expect.
    Characters without a piece become byte pieces. round_trip says that the ids
    decode to the text again. ids_sha256 is of the ids as 32-bit little-endian
    numbers. Texts with fewer segmentations have fewer rows; null and empty
    text has one, without pieces. Equal scores stand in a fixed order. Repeated
    rows give repeated rows, no rows give none; other columns are ignored.
    Texts may be long: work is by units, and memory by Arrow batch.
    """
    bounded_batches(docs.sparkSession)
    model = Path(model_path).read_bytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(_pieces(model))
        for batch in batches:
            for i, j, data, at in text.chunks(batch.column(1)):
                yield from _rows(memory, batch.column(0).slice(i, j - i).to_pylist(), data, at, n, ids_of)

    schema = "doc_id long, rank int, score double, n_pieces long, ids_sha256 string, round_trip boolean"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, schema + (", ids array<int>" if ids_of else ""))


def _rows(memory: Memory, ids: list, data: np.ndarray, at: np.ndarray, n: int, ids_of: int) -> Iterator[pa.RecordBatch]:
    pieces = memory.pieces
    if SPACE in data.tobytes():
        data = np.frombuffer(data.tobytes().replace(SPACE, ESCAPED), np.uint8)
    own, bounds, rows = _units(data, at, pieces)
    hashed = text.span_hashes(text.prefix_sums(own), bounds[:-1], bounds[1:])
    distinct, first, which = np.unique(hashed, return_index=True, return_inverse=True)
    if len(memory.slot) + len(distinct) > UNITS:
        memory.clear()
    keys = distinct.tolist()
    slots = [memory.slot.get(k, -1) for k in keys]
    new = [k for k, s in enumerate(slots) if s < 0]
    if new:
        a, b = bounds[first[new]], bounds[first[new] + 1]
        size = b - a
        total = np.cumsum(size)
        take = np.arange(total[-1]) - np.repeat(total - size, size) + np.repeat(a, size)
        memory.add([keys[k] for k in new], own[take], np.concatenate([[0], total]))
        slots = [memory.slot[k] for k in keys]
    slot = np.array(slots, dtype=np.int64)[which]

    count = memory.count[slot]
    total = np.concatenate([[0], np.cumsum(count)])
    every = memory.ids[np.arange(total[-1]) - np.repeat(total[:-1], count) + np.repeat(memory.start[slot], count)]
    raw = np.where(own == ESCAPED[0], SPACE[0], own).astype(np.uint8)
    decoded = pieces.decode(every)
    exact = decoded == raw.tobytes()
    score, gap = memory.score[slot], memory.gap[slot]
    out: list[list] = [[], [], [], [], [], [], []]
    for r, doc_id in enumerate(ids):
        lo, hi = rows[r], rows[r + 1]
        best = every[total[lo] : total[hi]]
        best_score = float(score[lo:hi].sum())
        own_gap = gap[lo:hi]
        take = min(n - 1, hi - lo)
        chosen = np.argpartition(own_gap, take - 1)[:take] if take else np.empty(0, np.int64)
        if take and take < hi - lo:  # of equal losses the first units
            limit = own_gap[chosen].max()
            below = np.flatnonzero(own_gap < limit)
            chosen = np.concatenate([below, np.flatnonzero(own_gap == limit)[: take - len(below)]])
        chosen = np.sort(chosen[np.isfinite(own_gap[chosen])]) + lo
        units = [own[bounds[u] : bounds[u + 1]].tobytes() for u in chosen]
        lists = [memory.alternatives(u, n) for u in units]
        good = exact or pieces.decode(best) == raw[bounds[lo] : bounds[hi]].tobytes()
        for rank, (loss, choice) in enumerate(_orders(lists, n)):
            parts, before, fine = [], total[lo], good
            for u, unit, options, c in zip(chosen, units, lists, choice, strict=True):
                if c:
                    parts += [every[before : total[u]], options[c][1]]
                    before = total[u + 1]
                    fine = fine and pieces.decode(options[c][1]) == unit.replace(ESCAPED, SPACE)
            path = np.concatenate([*parts, every[before : total[hi]]]) if parts else best
            for into, x in zip(out, (doc_id, rank + 1, best_score - loss, len(path), hashlib.sha256(path.astype("<i4").tobytes()).hexdigest(), fine, path if rank < ids_of else None), strict=True):
                into.append(x)
    columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.float64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.string()), pa.array(out[5], pa.bool_())]
    names = ["doc_id", "rank", "score", "n_pieces", "ids_sha256", "round_trip"]
    if ids_of:
        columns.append(pa.array(out[6], pa.list_(pa.int32())))
        names.append("ids")
    yield pa.RecordBatch.from_arrays(columns, names)
