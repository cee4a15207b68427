"""Packing: exact round trip of the tokens, cuts against a plain dynamic programme."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from basketry.llm import packing as pk

ODD = [None, "", "one. two! three?\n\nfour", "<|endoftext|> a<|endoftext|>", "  é\r\n\t '\'s 12³ ½ don't", "🙂👩‍👩‍👧" * 30,
       "a" * 5000, " " * 4000, "x" + "\n" * 3000 + "y", "The end. " * 3000, "word " * 9000, "\x00\x1c\x85 �"]


@pytest.fixture(scope="module")
def reference():
    tk = Tokenizer.from_file(pk.VOCABULARY)
    return lambda text: [*tk.encode(text or "", add_special_tokens=False).ids, 1]


def packed(spark, texts, parts=1, **more):
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, start int").coalesce(parts)
    return pk.pack(df, **more).collect()


def check(rows, texts, ids_of, window):
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.id].append(r)
        seqs[r.sequence_id].append(r)
    assert set(docs) == set(range(len(texts)))
    for i, text in enumerate(texts):
        mine, want = sorted(docs[i], key=lambda r: r.start), ids_of(text)
        assert [r.start for r in mine] == np.cumsum([0] + [r.length for r in mine])[:-1].tolist()
        assert b"".join(r.ids for r in mine) == np.array(want, "<u4").tobytes()
        assert {r.doc_tokens for r in mine} == {len(want)} and all(r.length > 0 for r in mine)
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == np.cumsum([0] + [r.length for r in s])[:-1].tolist()
        n = sum(r.length for r in s)
        assert n <= window and {r.sequence_length for r in s} == {n}
        assert {r.sequence_padded for r in s} == {n if n & (n - 1) == 0 else window}
    return sum(s[0].sequence_padded - s[0].sequence_length for s in seqs.values())


def test_round_trip_and_little_padding(spark, sf, reference):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for parts in (1, 4):
        rows = packed(spark, texts, parts)
        padding = check(rows, texts, reference, 2048)
        assert padding < 0.02 * sum(r.length for r in rows)


def test_blocks_run_on(spark, monkeypatch, reference):
    texts = ODD * 3
    monkeypatch.setattr(pk, "BLOCK", 512)
    s = pk.Stream(dict(window=128, hard_gap=32, per_window=4, in_document=2, in_sentence=9), np.zeros(60_000, bool), 0)
    out = []
    for i, t in enumerate(texts):
        s.add(i, np.array(reference(t), np.uint32))
        for rows in s.pieces(False):
            out += rows
        assert s.held < 2 * 512
    for rows in s.pieces(True):
        out += rows
    names = "id start length ids doc_tokens sequence_id offset sequence_length".split()
    rows = [type("R", (), dict(zip(names, r)) | {"sequence_padded": r[7] if r[7] & (r[7] - 1) == 0 else 128}) for r in out]
    check(rows, texts, reference, 128)


def plain(at, pen, window, per_window):
    best = {0: 0}
    for j, p in zip(at, pen):
        best[j] = min(best[i] + (0 if (j - i) & (j - i - 1) == 0 else window - (j - i)) for i in best if j - window <= i) \
            + per_window + p
    return best[at[-1]]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_the_cheapest(seed):
    rng = random.Random(seed)
    n, window = rng.randint(1, 300), rng.choice([8, 16, 37])
    ends = np.array(sorted(rng.sample(range(1, n + 1), min(n, rng.randint(0, 40)))), int)
    docs = np.array(sorted({n, *rng.sample(range(1, n + 1), min(n, 5))}), int)
    at, pen = pk.candidates(n, docs, ends, rng.randint(1, window), 3, 7)
    cuts = pk.cheapest_cuts(at, pen, window, 2)
    cost, last, penalty = 0, 0, dict(zip(at.tolist(), pen.tolist()))
    for c in cuts:
        size = c - last
        assert 0 < size <= window
        cost += (0 if size & (size - 1) == 0 else window - size) + 2 + penalty[c]
        last = c
    assert last == n and cost == plain(at.tolist(), pen.tolist(), window, 2)


def test_empty_table_bytes_and_digest(spark, reference):
    assert packed(spark, []) == []
    df = spark.sql("SELECT 'd0' AS doc_id, CAST(unhex('61FF2062') AS STRING) AS text")
    r = pk.pack(df).selectExpr("id", "ids", "crc32(ids) AS c").first()
    want = np.array(reference("a� b"), "<u4").tobytes()
    assert r.id == "d0" and r.ids == want and r.c == zlib.crc32(want)
