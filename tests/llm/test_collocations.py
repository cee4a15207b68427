"""Phrase collocations against counting every phrase of every piece."""

import re
from collections import Counter

import pytest

from basketry.llm import collocations as co

LOWER = {i: i + 32 for i in range(65, 91)}


def pieces(text):
    for p in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
        yield [w for w in re.split("[ \t]+", p) if w]


def brute(rows, min_count, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cands = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    out = []
    for (lang, w), a in cands.items():
        if any(x == lang and len(v) > len(w) and b >= a and any(v[i:i + len(w)] == w for i in range(len(v)))
               for (x, v), b in cands.items()):
            continue
        s, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], s))
    ranked = []
    for lang in {o[0] for o in out}:
        mine = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))[:top]
        ranked += [(lang, i + 1, *o[1:]) for i, o in enumerate(mine)]
    return sorted(ranked)


def found(spark, rows, min_count, top, **more):
    df = spark.createDataFrame(rows, "lang string, text string, gram int, n string")
    return sorted(tuple(r)[:8] for r in co.collocations(df, min_count=min_count, top=top, **more).collect())


ROWS = ([("en", "New York city is BIG, new york city is old. The cat sat; the cat ran"),
         (None, "new york city\x0bnew york CITY"), ("en", None), ("en", ""), ("en", " ... !!"),
         ("de", "über den Fluß und über den\tFluß\xa0hinaus\r\nüber den"), ("fr", "a a a a a a a a a")] * 3
        + [("en", "new york city is big the cat sat " * 400)] + [("en", "x y z " + str(i) + " x y") for i in range(20)]
        + [("en", " ".join(f"w{(i * i) % 23} v{i % 7}" for i in range(500)))])
ROWS = [(*r, 1, "t") for r in ROWS]


@pytest.mark.parametrize("period", [1, 5, 32, 10 ** 6])
def test_equals_brute_force_whatever_the_parse(spark, period):
    want = brute([r[:2] for r in ROWS], 3, 40)
    assert len(want) > 40
    assert found(spark, ROWS, 3, 40, period=period) == want


def test_blocks_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(co, "BLOCK", 64)
    assert found(spark, ROWS, 3, 40) == brute([r[:2] for r in ROWS], 3, 40)
    raw = b"one two. three four " * 40
    assert b"".join(co._blocks(raw)) == raw


def test_chunks_own_every_token_once():
    texts = [b"a b c. d e f g h i j k l m n o p q r s t u v w x y z" * 5, b"", b"one", b"! . ?", b"a b c. d e f"]
    for period in (1, 3, 9):
        back = [b""] * len(texts)
        for d, c in co.parse(texts, period, 4):
            back[d] += b" ".join(c.split()[:-4]) + b" "
        for t, b in zip(texts, back):
            assert b.split() == t.translate(co._TABLE).replace(b".", b" . ").split()


def test_a_copied_text_adds_no_chunk(spark):
    df = spark.createDataFrame([("en", "some words that come again and again, in a long line of words " * 9)] * 50, "lang string, text string")
    rows = co.chunks(df).collect()
    assert all(r.n % 50 == 0 for r in rows)


def test_ties_and_exact_scores(spark):
    counts = spark.createDataFrame([("x", 0, "", 10 ** 14), ("x", 1, "p", 10 ** 10), ("x", 1, "q", 10 ** 10 + 3),
                                    ("x", 2, "p q", 10 ** 9 + 7)], "lang string, k int, gram string, f long")
    r = co.score(counts).first()
    assert r.score == 1000 * (10 ** 9 + 7) * 10 ** 14 // (10 ** 10 * (10 ** 10 + 3)) and r.cut == 1


def test_empty_table_and_bytes(spark):
    assert found(spark, [], 1, 5) == []
    df = spark.sql("SELECT 'en' AS lang, CAST(unhex('61FF2062') AS STRING) AS text FROM range(4)")
    got = co.collocations(df, min_count=2, top=5).selectExpr("hex(phrase) AS h", "a").collect()
    assert [(r.h, r.a) for r in got] == [("61FF2062", 4)]
