"""Cross-tokenizer alignment against a version token by token."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from tests.llm import cases

from aislecast.llm import alignment

PARAMS = alignment.Alignment()
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(texts: list[str | None]) -> list[tuple]:
    """Every row's counts and digest, with the libraries' own calls and no matrix."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PARAMS.byte_bpe)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PARAMS.pieces)
    byte = alignment.tokenizers(PARAMS.byte_bpe, PARAMS.pieces)[0].vocabulary
    token = lambda i: byte.flat[byte.at[i] : byte.at[i] + byte.lengths[i]].tobytes()

    def piece(i: int) -> bytes:
        text = b.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if b.is_byte(i) else text.replace("▁", " ").encode()

    def grouped(ids: list[int], spelled: list[bytes], cuts: set[int]) -> list[list[int]]:
        out, end = [[]], 0
        for i, s in zip(ids, spelled, strict=True):
            out[-1].append(i)
            end += len(s)
            if end in cuts:
                out.append([])
        return out[:-1]

    rows, holders = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spelled = [token(i) for i in ids_a], [piece(i) for i in ids_b]
        if not text or any(b"".join(s) != b" " + text.encode() for s in spelled):
            rows.append(None)
            continue
        cuts = set.intersection(*(set(np.cumsum([len(x) for x in s]).tolist()) for s in spelled))
        pairs = list(zip(grouped(ids_a, spelled[0], cuts), grouped(ids_b, spelled[1], cuts), strict=True))
        links = [(x, y) for xs, ys in pairs for x in xs for y in ys]
        holders.update(set(links))
        rows.append((len(ids_a), len(ids_b), pairs, links))
    best: dict[int, int] = {}
    for (x, _), n in holders.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, pairs, links = r
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in pairs)
        at_best = sum(holders[x, y] == best[x] for x, y in links)
        out.append((n_a, n_b, len(pairs), len(links), at_best, sum(holders[k] for k in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


AWKWARD = ["<|endoftext|> <s> </s> <0x41>", "a\x00b\r\n\t c", "▁", "x▁y", "  　 ", "漢字かな한글", "😀😀 é́ ﬁ", "'s 'LL don't", "�", " lead", "\u0085 "]


def test_against_plain(spark):
    docs = cases.texts() + [(100 + k, t) for k, t in enumerate(AWKWARD)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = alignment.cross_tokenizer_alignment(frame, alignment.Alignment(block_tokens=3_000))
    got = sorted((str(r["doc_id"]), *(r[c] for c in COLUMNS)) for r in found.collect())
    want = sorted((str(i), *row) for (i, _), row in zip(docs, plain([t for _, t in docs]), strict=True))
    assert got == want
    assert sum(r[1] == 0 for r in got) > 3


def test_whole_table(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = [(r["doc_id"], r["text"]) for r in frame.collect()]
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.cross_tokenizer_alignment(frame).collect()}
    assert got == dict(zip((i for i, _ in docs), plain([t for _, t in docs]), strict=True))


def test_awkward_columns_and_no_rows(spark):
    assert alignment.cross_tokenizer_alignment(cases.awkward(spark)).count() == len(cases.texts())
    none = alignment.cross_tokenizer_alignment(cases.nothing(spark))
    assert none.columns == ["doc_id", *COLUMNS] and none.count() == 0


def test_overlap_links_lead_back_to_the_tokens(spark):
    text = "Crème brûlée, twice: 漢字 and 12345 xylophones"
    frame = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in alignment.align(frame, alignment.Alignment(overlaps=True)).collect()}
    one = rows[1]
    a, b = alignment.tokenizers(PARAMS.byte_bpe, PARAMS.pieces)
    assert sum(one["over_bytes"]) == len(text.encode()) + 1
    for ids, vocabulary, over in ((one["a_ids"], a.vocabulary, one["over_a"]), (one["b_ids"], b.vocabulary, one["over_b"])):
        met = np.bincount(over, weights=one["over_bytes"])
        assert met.tolist() == vocabulary.lengths[ids].tolist()
        assert vocabulary.joined(np.array(ids)).tobytes() == b" " + text.encode()
    assert sum(one["a_sizes"]) == len(one["a_ids"]) and sum(one["b_sizes"]) == len(one["b_ids"])
    assert rows[2]["a_ids"] == [] and rows[2]["over_bytes"] == []


@pytest.mark.parametrize("at_once", [1, 7, 1 << 20])
def test_gustavson_product(at_once):
    r = np.random.default_rng(3)
    x, y = (r.integers(0, 3, s) * (r.random(s) < 0.3) for s in ((9, 7), (7, 11)))
    a, b = (alignment.Csr.of(*np.nonzero(m), *m.shape, m[np.nonzero(m)]) for m in (x, y))
    out = np.zeros((9, 11), np.int64)
    for i, _, part in alignment.product(a, b, at_once):
        out[i + part.rows, part.columns] = part.values
    assert (out == x @ y).all()


def test_long_texts_end(spark):
    # one group of many tokens, white space of a megabyte, and one very long word
    texts = ["x" * 400_001, " " * 1_000_000, "漢" * 50_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in alignment.cross_tokenizer_alignment(frame).collect()}
    assert all(rows[k]["n_a"] > 0 and rows[k]["n_links"] >= rows[k]["n_groups"] for k in rows)
