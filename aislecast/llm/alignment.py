"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked ids.

A document's tokens are the rows of a token x byte incidence matrix, one for
each tokenizer, in compressed sparse rows built here. Gustavson's row products
A . B' give the overlap links: token of A, token of B, bytes in common. Tokens
chained by overlap links are a group; it ends where both tokenizers end a token.

Links inside groups come from the product of the group incidences: rows are the
ids of A in the document, columns the ids of B, and values the token pairs. As
equal ids of a group are added up first, a long group costs its different ids,
not its token pairs.

How many documents link two ids is asked by block: the block sends every
different pair once, with its documents, and gets the corpus-wide count back.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aislecast.llm.blocks import NO_ID, bounded_batches, read_counts, write_counts
from aislecast.session import stage, stage_by

# Fixed value: how byte-level BPE cuts a text into words before it merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK_BYTES = 1 << 19


@dataclass(frozen=True)
class Alignment:
    byte_bpe: str = "/opt/tokenizers/byte_bpe_50k.json"  # A, takes a space and the text
    pieces: str = "/opt/tokenizers/piece_bpe_32k.model"  # B, adds the space itself
    overlaps: bool = False  # also return the overlap links
    block_tokens: int = 1_200_000  # of A in a block, about


def _sorted(key: np.ndarray, values: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Both by key. Small values ride in the low bits of the keys: sorting numbers is much faster than sorting places."""
    if values is None:
        return np.sort(key), None
    if int(key.max()) < 1 << 43 and int(values.max()) < 1 << 20:
        packed = np.sort((key << 20) | values)
        return packed >> 20, packed & ((1 << 20) - 1)
    order = np.argsort(key, kind="stable")
    return key[order], values[order]


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: row i has columns[starts[i] : starts[i + 1]], ascending."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    @staticmethod
    def of(rows: np.ndarray, columns: np.ndarray, height: int, width: int, values: np.ndarray | None = None) -> Csr:
        """From entries in any order; those of one place are added up."""
        key = rows.astype(np.int64) * width + columns
        if len(key) > 1 and (key[1:] < key[:-1]).any():
            key, values = _sorted(key, values)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key_ = key[first]
        if values is None:
            total = np.diff(first, append=len(key))
        else:
            total = np.add.reduceat(values, first) if len(first) else np.empty(0, np.int64)
        return Csr(np.searchsorted(key_, np.arange(height + 1, dtype=np.int64) * width), key_ % width, total, width)


def product(a: Csr, b: Csr, at_once: int = 1 << 22) -> Iterator[tuple[int, int, Csr]]:
    """Gustavson's product: row i is the sum of the rows of b that row i of a names, weighted.

    Yields (first row, end row, their product), so many multiplications at a
    time, but whole rows.
    """
    size = b.starts[a.columns + 1] - b.starts[a.columns]
    done = np.concatenate([[0], np.cumsum(size)])
    by_row = done[a.starts]
    height, i = len(a.starts) - 1, 0
    row_of = a.rows
    while i < height:
        j = max(i + 1, int(np.searchsorted(by_row, by_row[i] + at_once, side="right")) - 1)
        s = slice(int(a.starts[i]), int(a.starts[j]))
        n = int(by_row[j] - by_row[i])
        if n == s.stop - s.start and (size[s] == 1).all():
            of, place = s, b.starts[a.columns[s]]
        else:
            of = np.repeat(np.arange(s.start, s.stop), size[s])
            place = np.arange(n) - (done[of] - by_row[i]) + b.starts[a.columns[of]]
        yield i, j, Csr.of(row_of[of] - i, b.columns[place], j - i, b.width, a.values[of] * b.values[place])
        i = j


def incidence(ends: np.ndarray, size: int) -> Csr:
    """Tokens x bytes, for tokens that lie end to end."""
    return Csr(np.concatenate([[0], ends]), np.arange(size), np.ones(size, np.int64), size)


def transposed_incidence(ends: np.ndarray, size: int) -> Csr:
    """Bytes x tokens: one token a byte."""
    owner = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    return Csr(np.arange(size + 1), owner, np.ones(size, np.int64), len(ends))


def overlap_links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token of A, token of B and common bytes of all tokens that overlap."""
    size = int(ends_a[-1]) if len(ends_a) else 0
    parts = list(product(incidence(ends_a, size), transposed_incidence(ends_b, size)))
    if not parts:
        return (np.empty(0, np.int64),) * 3
    return (
        np.concatenate([i + p.rows for i, _, p in parts]),
        np.concatenate([p.columns for _, _, p in parts]),
        np.concatenate([p.values for _, _, p in parts]),
    )


def groups(over_a: np.ndarray, over_b: np.ndarray, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of A and of B, numbered in order."""
    first = np.flatnonzero(np.diff(over_a, prepend=-1))
    last = np.append(first[1:], len(over_a)) - 1
    # a token begins a group unless it overlaps the last partner of the token before
    new = np.ones(len(first), bool)
    new[1:] = over_b[first[1:]] != over_b[last[:-1]]
    of_a = np.cumsum(new) - 1
    of_b = np.empty(n_b, np.int64)
    of_b[over_b] = of_a[over_a]
    return of_a, of_b


def linked_ids(
    doc_a: np.ndarray, ids_a: np.ndarray, group_a: np.ndarray, ids_b: np.ndarray, group_b: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """document, pair (id of A x width + id of B) and number of token pairs, in order of both."""
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    # rows of the left side: the different (document, id), which sort like the rest of the place
    place, times = np.unique(((doc_a.astype(np.int64) << 20) | ids_a) * max(1, n) + group_a, return_counts=True)
    of_row, column = np.divmod(place, max(1, n))
    first = np.flatnonzero(np.diff(of_row, prepend=-1))
    names = of_row[first]
    left = Csr(np.append(first, len(place)), column, times, n)
    right = Csr.of(group_b, ids_b, n, width)
    docs, pairs, times = [], [], []
    for i, _, part in product(left, right):
        name = names[i + part.rows]
        docs.append(name >> 20)
        pairs.append((name & 0xFFFFF) * width + part.columns)
        times.append(part.values)
    none = [np.empty(0, np.int64)]
    return np.concatenate(docs or none), np.concatenate(pairs or none), np.concatenate(times or none)


class Vocabulary:
    """The bytes of every id, end to end."""

    def __init__(self, entries: list[bytes]):
        self.size = len(entries)
        self.lengths = np.array([len(e) for e in entries], np.int64)
        self.at = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.lengths[ids]
        begin = np.cumsum(n) - n
        return self.flat[np.repeat(self.at[ids] - begin, n) + np.arange(int(n.sum()))]


class ByteBpe:
    """Tokenizer A. Its ranks are its ids; special tokens are plain text."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        vocab = json.loads(Path(path).read_text())["model"]["vocab"]
        # byte-level alphabet: printable Latin-1 stands for itself, the rest for 256 onwards
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        entries = {bytes(byte[c] for c in token): i for token, i in vocab.items() if all(c in byte for c in token)}
        listed = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            listed[i] = token
        self.vocabulary = Vocabulary(listed)
        self._fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=entries, special_tokens={})
        self._slow = None

    def encode(self, text: str) -> list[int]:
        try:
            return self._fast.encode_ordinary(text)
        except BaseException as e:
            # its pattern gives up on white space of a megabyte; the other library does not
            if type(e).__name__ != "PanicException":
                raise
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self.path)
            self._slow.encode_special_tokens = True
        return self._slow.encode(text, add_special_tokens=False).ids


class PieceBpe:
    """Tokenizer B."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self._model
        entries = []
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                entries.append(bytes([int(piece[3:5], 16)]))
            else:
                entries.append(piece.replace("▁", " ").encode())
        self.vocabulary = Vocabulary(entries)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


@cache
def tokenizers(byte_bpe: str, pieces: str) -> tuple[ByteBpe, PieceBpe]:
    return ByteBpe(byte_bpe), PieceBpe(pieces)


def _whole(ids: np.ndarray, counts: np.ndarray, vocabulary: Vocabulary, source: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of every text, whether its ids' bytes are the text."""
    sizes = np.add.reduceat(np.append(vocabulary.lengths[ids], 0), np.minimum(np.cumsum(counts) - counts, len(ids)))
    sizes[counts == 0] = 0
    fits = sizes == np.diff(at)
    same = vocabulary.joined(ids[np.repeat(fits, counts)]) == source[np.repeat(fits, np.diff(at))]
    wrong = np.concatenate([[0], np.cumsum(~same)])
    ends = np.cumsum(np.where(fits, sizes, 0))
    return fits & (wrong[ends] == wrong[ends - np.where(fits, sizes, 0)])


def encode_both(raw: list[bytes], a: ByteBpe, b: PieceBpe) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and their number by text, of A and of B; none where either does not spell space + text.

    A spells every text that is UTF-8: its merges only join neighbours, from single bytes on.
    """
    texts = [t.decode("utf-8", "replace") for t in raw]
    lists = [a.encode(" " + t) for t in texts], b.encode(texts)
    source = np.frombuffer(b"".join(b" " + t for t in raw), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(t) + 1 for t in raw])]).astype(np.int64)
    good = np.array([len(r) > 0 and ("\ufffd" not in t or t.encode() == r) for r, t in zip(raw, texts, strict=True)], bool)
    out = []
    for found in lists:
        counts = np.fromiter(map(len, found), np.int64, len(found))
        out.append((np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts))
    good &= _whole(*out[1], b.vocabulary, source, at)
    return tuple(x for ids, counts in out for x in (ids[np.repeat(good, counts)], np.where(good, counts, 0)))


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _per_document(of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, minlength=n)


LISTS = ["a_ids", "b_ids", "a_sizes", "b_sizes"]
OVERLAPS = ["over_a", "over_b", "over_bytes"]


def align(docs: DataFrame, params: Alignment | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens and groups of every row: doc_id, a_ids, b_ids, and a_sizes, b_sizes, the tokens in every group.

    With overlaps, also over_a, over_b and over_bytes: positions of two tokens
    that overlap, and the bytes they share. Null and empty texts, and texts that
    either tokenizer does not spell as space + text (one with the space sign
    U+2581 in it, for instance), have empty lists. Rows are as in the input,
    repeated ones and null ids too; other columns are ignored.
    """
    p = params or Alignment()
    bounded_batches(docs.sparkSession)
    names = LISTS + (OVERLAPS if p.overlaps else [])

    def chunks(column: pa.Array) -> Iterator[tuple[int, int]]:
        size = pc.fill_null(pc.binary_length(column), 0).to_numpy()
        ends, i = np.cumsum(size), 0
        while i < len(column):
            before = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
            yield i, j
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(p.byte_bpe, p.pieces)
        for batch in batches:
            for i, j in chunks(batch.column(1)):
                raw = [t or b"" for t in batch.column(1).slice(i, j - i).to_pylist()]
                ids_a, n_a, ids_b, n_b = encode_both(raw, a, b)
                over_a, over_b, shared = overlap_links(np.cumsum(a.vocabulary.lengths[ids_a]), np.cumsum(b.vocabulary.lengths[ids_b]))
                group_a, group_b = groups(over_a, over_b, len(ids_b))
                doc_a = np.repeat(np.arange(j - i), n_a)
                first = np.flatnonzero(np.diff(group_a, prepend=-1))
                n_groups = _per_document(doc_a[first], j - i)
                columns = [
                    _lists(ids_a, n_a),
                    _lists(ids_b, n_b),
                    _lists(np.bincount(group_a, minlength=len(first)), n_groups),
                    _lists(np.bincount(group_b, minlength=len(first)), n_groups),
                ]
                if p.overlaps:
                    links = _per_document(doc_a[over_a], j - i)
                    own_a, own_b = (np.repeat(np.cumsum(n) - n, links) for n in (n_a, n_b))
                    columns += [_lists(x, links) for x in (over_a - own_a, over_b - own_b, shared)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *columns], ["doc_id", *names])

    text = F.col(text_col).cast("string").cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} array<int>" for c in names)
    )


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and their number by row."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
    return column.flatten().to_numpy().astype(np.int64), counts


def _words(n: int, ends: str) -> np.ndarray:
    out = np.empty(n, object)
    out[:] = [f"{i}{ends}".encode() for i in range(n)]
    return out


@cache
def _spelled(n_a: int, n_b: int) -> tuple[np.ndarray, ...]:
    """The decimals of all ids, followed by what follows inside a group, and at its end."""
    return _words(n_a, ","), _words(n_a, "|"), _words(n_b, ","), _words(n_b, ";")


def digests(
    ids_a: np.ndarray, n_a: np.ndarray, ids_b: np.ndarray, n_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, words: tuple[np.ndarray, ...]
) -> list[str]:
    """SHA-256 of `a1,a2|b1;a3|b2,b3` of every document; '' without tokens."""
    a_more, a_last, b_more, b_last = words
    sizes_a, sizes_b = np.bincount(group_a), np.bincount(group_b)
    end_a = np.append(group_a[1:] != group_a[:-1], True)[: len(group_a)]
    end_b = np.append(group_b[1:] != group_b[:-1], True)[: len(group_b)]
    out = np.empty(len(ids_a) + len(ids_b), object)
    # before a token of A stand the tokens of B of earlier groups, before one of B also those of A of its own
    out[np.arange(len(ids_a)) + (np.cumsum(sizes_b) - sizes_b)[group_a]] = np.where(end_a, a_last[ids_a], a_more[ids_a])
    out[np.arange(len(ids_b)) + np.cumsum(sizes_a)[group_b]] = np.where(end_b, b_last[ids_b], b_more[ids_b])
    ends = np.cumsum(n_a + n_b)
    listed, found, start = out.tolist(), [], 0
    for end in ends.tolist():
        found.append(hashlib.sha256(b"".join(listed[start:end])[:-1]).hexdigest() if end > start else "")
        start = end
    return found


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _blocks(aligned: DataFrame, p: Alignment) -> DataFrame:
    """Blocks of documents with their digests, and their linked id pairs as documents x pairs in compressed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = tokenizers(p.byte_bpe, p.pieces)
        words = _spelled(a.vocabulary.size, b.vocabulary.size)
        width = b.vocabulary.size
        number = TaskContext.get().partitionId() << 32
        held: list[dict] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            joined = {k: np.concatenate([h[k] for h in held]) for k in ("ids", *COUNTS, "pairs", "times", "size")}
            pairs, where = np.unique(joined["pairs"], return_inverse=True)
            fields = [joined[k].astype(np.int64).tobytes() for k in ("ids", *COUNTS, "size")]
            fields += [where.astype(np.uint32).tobytes(), write_counts(joined["times"])]
            shas = list(chain.from_iterable(h["sha"] for h in held))
            lists = [pairs // width, pairs % width, np.bincount(where, minlength=len(pairs))]
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    *(pa.array([f], pa.binary()) for f in fields),
                    pa.array([shas], pa.list_(pa.string())),
                    *(pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in lists),
                ],
                ["block", "ids", *COUNTS, "size", "place", "times", "sha", "a", "b", "docs"],
            )
            held.clear()
            number += 1
            return out

        for batch in batches:
            (ids_a, n_a), (ids_b, n_b), (sizes_a, n_groups), (sizes_b, _) = (_flat(batch.column(c)) for c in LISTS)
            group_a, group_b = (np.repeat(np.arange(len(s)), s) for s in (sizes_a, sizes_b))
            doc_a = np.repeat(np.arange(len(batch)), n_a)
            of, pairs, times = linked_ids(doc_a, ids_a, group_a, ids_b, group_b, width)
            each = np.concatenate([[0], np.cumsum(sizes_a * sizes_b)])
            ends = np.cumsum(n_groups)
            held.append(
                {
                    "ids": pc.fill_null(batch.column(0), int(NO_ID)).to_numpy(),
                    "n_a": n_a,
                    "n_b": n_b,
                    "n_groups": n_groups,
                    "n_links": each[ends] - each[ends - n_groups],
                    "pairs": pairs,
                    "times": times,
                    "size": _per_document(of, len(batch)),
                    "sha": digests(ids_a, n_a, ids_b, n_b, group_a, group_b, words),
                }
            )
            if sum(int(h["n_a"].sum()) for h in held) >= p.block_tokens or sum(len(h["ids"]) for h in held) >= 50_000:
                yield flush()
        if held:
            yield flush()

    binary = ", ".join(f"{c} binary" for c in ("ids", *COUNTS, "size", "place", "times"))
    made = aligned.select("doc_id", *LISTS).mapInArrow(run, f"block long, {binary}, sha array<string>, a array<int>, b array<int>, docs array<int>")
    return stage_by(made, "alignment", ["block"], ["block"], codec="zstd")


def count_links(aligned: DataFrame, params: Alignment | None = None) -> DataFrame:
    """What the corpus says of every row of :func:`align`.

    doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.
    n_links are token pairs inside groups. A pair of ids counts the documents
    that link it, each row as a document; n_best are the links whose pair counts
    most of all pairs of its id of A, ties included, and count_sum adds the
    counts up. Rows without tokens have zeros and an empty digest. No rows give
    no rows.
    """
    p = params or Alignment()
    bounded_batches(aligned.sparkSession)
    blocks = _blocks(aligned, p)
    asked = blocks.select("block", F.inline(F.arrays_zip("a", "b", "docs")))
    # of one id of A there are no more pairs than ids of B
    best = F.max("count").over(Window.partitionBy("a"))
    counts = stage(asked.groupBy("a", "b").agg(F.sum("docs").alias("count")).withColumn("best", F.col("count") == best), "alignment-counts")
    answers = (
        asked.drop("docs")
        .join(counts, ["a", "b"])
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("a", "b", "count", "best"))).alias("l"))
        .select("block", F.col("l.count").alias("count"), F.col("l.best").alias("best"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                own = {k: np.frombuffer(row[k].as_buffer(), np.int64) for k in ("ids", *COUNTS, "size")}
                place = np.frombuffer(row["place"].as_buffer(), np.uint32)
                times, _ = read_counts(row["times"].as_buffer().to_pybytes(), 0)
                known = [pa.array([], pa.int64()) if row[k].values is None else row[k].values for k in ("count", "best")]
                count = known[0].to_numpy(zero_copy_only=False).astype(np.int64)
                is_best = known[1].to_numpy(zero_copy_only=False).astype(bool)
                ends = np.cumsum(own["size"])
                sums = []
                for value in (np.where(is_best[place], times, 0), times * count[place]):
                    total = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
                    sums.append(total[ends] - total[ends - own["size"]])
                ids = pa.array(own["ids"], mask=own["ids"] == NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(own[k]) for k in COUNTS), *(pa.array(s, pa.int64()) for s in sums), row["sha"].values],
                    ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"],
                )

    longs = ", ".join(f"{c} long" for c in (*COUNTS, "n_best", "count_sum"))
    return blocks.drop("a", "b", "docs").join(answers, "block", "left").mapInArrow(run, f"doc_id long, {longs}, groups_sha256 string")


def cross_tokenizer_alignment(docs: DataFrame, params: Alignment | None = None) -> DataFrame:
    """:func:`align`, stored, and :func:`count_links` of it. Null and empty texts, ties and repeated rows as there."""
    aligned = stage(align(docs, params), "aligned")
    return count_links(aligned, params)
