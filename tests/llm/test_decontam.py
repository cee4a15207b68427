"""Decontamination: brute force, planted paraphrases, the SVD itself and odd inputs."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import decontam as dc
from basketry.llm.common import table

DOC = "doc_id long, text string, leaks string, item_id long"
RNG = np.random.default_rng(5)
VOCAB = ["w" + "".join(RNG.choice(list("abcdefgh"), 3)) for _ in range(400)]


def prose(n):
    return list(RNG.choice(VOCAB, n))


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_lcs_matches_table():
    for _ in range(200):
        a, b = RNG.integers(0, 5, RNG.integers(0, 20)).tolist(), RNG.integers(0, 5, RNG.integers(0, 20)).tolist()
        assert dc.lcs(a, b) == plain_lcs(a, b)


def test_randomized_svd_spans_the_leading_directions(spark):
    rows = [RNG.integers(0, 60, 30).tolist() for _ in range(40)]
    idf = np.ones(dc.BUCKETS)
    basis = dc.randomized_svd(spark.createDataFrame([(r,) for r in rows], "ids array<int>"), idf, rank=40)
    a = np.zeros((40, dc.BUCKETS))
    for i, r in enumerate(rows):
        k, v = dc.tfidf(np.array(r), idf)
        a[i, k] = v
    assert np.allclose(basis.T @ basis, np.eye(40), atol=1e-3)
    assert np.allclose(a @ basis @ basis.T, a, atol=1e-3)


def test_recall_against_brute_force(spark, sf):
    docs, bench = table(spark, sf, "documents").toPandas(), table(spark, sf, "benchmark").toPandas()
    want = set()
    items = {i: dc.words_of(t).tolist() for i, t in zip(bench.item_id, bench.text)}
    for d, t in zip(docs.doc_id, docs.text):
        w = dc.words_of(t).tolist()
        for i, need in items.items():
            long = len(need) * 3 // 2
            step = max(1, len(need) // 4)
            if len(set(need) & set(w)) * 4 >= len(set(need)) * 3 and any(
                    dc.lcs(need, w[a:a + long]) >= 0.75 * len(need) for a in range(0, max(1, len(w) - long + step), step)):
                want.add((d, i))
    found = dc.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    got = {(r["doc_id"], int(r["m"]["item_id"])) for r in found.select("doc_id", F.explode("leaks").alias("m")).collect()}
    assert len(want & got) >= 0.9 * len(want) and len(got - want) <= 0.1 * len(got)


def test_planted_paraphrases(spark):
    items, rows = [], []
    for i in range(30):
        w = prose(40)
        items.append((i, " ".join(w[:30]) + ". " + " ".join(w[30:]) + ".", "x"))
        near = [x for k, x in enumerate(w) if k % 7 != 3 or k >= 30]  # words left out before the answer
        near[5:5] = prose(2)
        rows.append((i, " ".join(prose(300) + near + prose(200)).upper(), "a", 0))
    rows += [(100 + i, " ".join(prose(400)), "a", 0) for i in range(60)]
    got = dc.find_leaks(spark.createDataFrame(rows, DOC), spark.createDataFrame(items, "item_id long, text string, leaks string"))
    pairs = {(r["doc_id"], int(r["m"]["item_id"])) for r in got.select("doc_id", F.explode("leaks").alias("m")).collect()}
    assert len(pairs & {(i, i) for i in range(30)}) >= 27 and all(a == b for a, b in pairs)


def test_odd_rows_and_benchmark_blocks(spark, monkeypatch):
    monkeypatch.setattr(dc, "BLOCK_BYTES", 200)
    long = prose(150)
    items = [(1, " ".join(long), "x"), (2, None, "x"), (3, "", "x"), (4, "Who? me", "x"), (1, " ".join(long), "x"), (None, "only five words are here", "x")]
    rows = [(1, " ".join(prose(50) + long + prose(20)), "a", 0), (2, None, "a", 0), (3, "", "a", 0), (4, "say Who, ME again", "a", 0),
            (None, "only five WORDS are here", "a", 0), (5, " ".join(VOCAB * 100), "a", 0), (1, "nothing", "a", 0)]
    d, b = spark.createDataFrame(rows, DOC), spark.createDataFrame(items, "item_id long, text string, extra string")
    out = dc.find_leaks(d, b)
    assert out.columns == ["doc_id", "text", "item_id", "leaks"]
    got = [sorted({m["item_id"] or "" for m in r["leaks"]}) for r in out.collect()]
    assert got == [["1"], [], [], ["4"], [""], [], []]
    left = dc.clean_rows(d, b)
    assert left.columns == d.columns and left.count() == 4
    assert dc.clean_rows(d.limit(0), b).count() == 0 and dc.clean_rows(d, b.limit(0)).count() == len(rows)


def test_heavy_paraphrases_are_candidates(spark):
    rng = np.random.default_rng(8)
    items, rows = [], []
    for i in range(160):
        n = int(rng.integers(10, 65))
        w, cut = list(rng.choice(VOCAB, n)), n - max(3, n // 6)
        items.append((i, " ".join(w[:cut]) + ". " + " ".join(w[cut:]) + ".", "x"))
        near = [str(rng.choice(VOCAB)) if k < cut and rng.random() < 0.35 else x for k, x in enumerate(w)]
        for _ in range(n // 4):
            near.insert(int(rng.integers(0, cut)), str(rng.choice(VOCAB)))
        rows.append((i, " ".join([*rng.choice(VOCAB, 200), *near, *rng.choice(VOCAB, 150)]), "a", 0))
    d, b = spark.createDataFrame(rows, DOC), spark.createDataFrame(items, "item_id long, text string, leaks string")
    pairs = lambda **p: {(r["doc_id"], r["m"]["item_id"]) for r in
                         dc.find_leaks(d, b, **p).select("doc_id", F.explode("leaks").alias("m")).collect()}
    every = {x for x in pairs(near=-10.0) if str(x[0]) == x[1]}  # every window looked at
    got = pairs()
    assert len(every) > 80 and len(every & got) >= 0.99 * len(every)


def test_short_items_are_found_inside_long_texts(spark):
    items = [(n, " ".join(f"rare{n}x{k}" if k % 2 else VOCAB[k] for k in range(n)), "x") for n in range(1, 8)]
    rows = [(i, " ".join([*prose(300 + n), t, *prose(200)]), "a", 0) for i, (n, t, _) in enumerate(items)]
    rows.append((99, " ".join(f"rare{n}x1 rare{n}x3 {VOCAB[2]}" for n in range(2, 8)), "a", 0))
    out = dc.find_leaks(spark.createDataFrame(rows, DOC), spark.createDataFrame(items, "item_id long, text string, leaks string"))
    got = {(r["doc_id"], int(r["m"]["item_id"])) for r in out.select("doc_id", F.explode("leaks").alias("m")).collect()}
    assert {(n - 1, n) for n in range(1, 8)} <= got and all(n == 1 or d == n - 1 for d, n in got)


def latent_index(items):
    idf, rows = np.ones(dc.BUCKETS), [dc.hashed(p) for t in items for p, _ in dc.passages(t)]
    columns = np.unique(np.concatenate(rows))
    x = np.zeros((len(rows), len(columns)))
    for i, r in enumerate(rows):
        k, v = dc.tfidf(r, idf)
        x[i, np.searchsorted(columns, k)] = v
    basis = np.linalg.svd(x, full_matrices=False)[2].T.astype(np.float32)
    return dc.Index([(str(i), t) for i, t in enumerate(items)], columns, basis, idf)


def test_cosines_of_repeated_words_are_cosines():
    ix = latent_index(["echo " * 40, "echo delta " * 16, " ".join(prose(30))])
    for text in ("echo " * 64, "delta echo " * 200, "echo " * 5000, "delta " + "echo " * 39):
        found = ix.matches(text, 0.25, 0.75, 0.6)
        assert found and all(0 < m[4] <= 1 for m in found), found
    # the same text as the passage: the cosine is one
    assert max(m[4] for m in ix.matches("echo " * 64, 0.25, 0.75, 0.6) if m[0] == "0") == pytest.approx(1, abs=1e-3)


def test_bounds_before_the_subsequence_lose_no_match():
    rng = np.random.default_rng(4)
    items = [" ".join(rng.choice(VOCAB, n)) for n in (9, 20, 33, 50, 64, 64, 12)]
    ix = latent_index(items)
    texts = []
    for k in range(60):
        w = items[k % 7].split()
        said = [x if rng.random() > 0.2 else str(rng.choice(VOCAB)) for x in w]
        at = [0, dc.PIECE - 20, 3 * dc.PIECE - 5][k % 3]  # across the cuts between pieces too
        texts.append(" ".join([*rng.choice(VOCAB, at), *said, *rng.choice(VOCAB, 40)]))
    got = [ix.matches(t, 0.25, 0.75, 0.6) for t in texts]
    ix.held = lambda words: ix.size  # no passage left out
    every = [ix.matches(t, 0.25, 0.75, 0.6) for t in texts]
    plain = lambda found: [[(*m[:4], *m[5:]) for m in f] for f in found]
    assert plain(got) == plain(every)
    assert all(a[4] == pytest.approx(b[4], abs=1e-5) for f, g in zip(got, every) for a, b in zip(f, g))  # 32-bit sums
    assert sum(str(k % 7) in {m[0] for m in f} for k, f in enumerate(got)) >= 40


def test_words_as_numbers_match_plain_words(monkeypatch):
    import random

    from basketry.llm import decontam

    def plain(text):
        words = ("".join(filter(str.isalnum, t.lower())) for t in text.split())
        return [w for w in words if w]

    number, word = {}, {}
    draw, letters = random.Random(5), "aZ_\u00e9\u0130\u03a3\u039f  \x1c\x85\u00a0.,-'\t\n\u00b2\u0663\u4e2d\u00df9"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 14))) for _ in range(5000)]
    texts += ["", " ", "x" * 200_000 + " y " + "z" * 70_000, "don't stop, " * 20_000]
    for long in (decontam.LONG, 4):
        monkeypatch.setattr(decontam, "LONG", long)
        decontam._kept_powers.cache_clear()
        for t in texts if long > 4 else texts[:2000]:
            got, want = decontam.words_of(t.encode()).tolist(), plain(t)
            assert len(got) == len(want), t[:80]
            for n, w in zip(got, want):
                assert number.setdefault(w, n) == n and word.setdefault(n, w) == w
    decontam._kept_powers.cache_clear()
    assert decontam.words_of(None).size == 0
    assert decontam.words_of(b"\xff\xfe ab\xff").tolist() == decontam.words_of("ab").tolist()


def test_index_is_fitted_on_every_document(spark, monkeypatch):
    rng, seen = np.random.default_rng(4), []
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 400, 40)) for _ in range(2000)] + ["", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    bench = spark.createDataFrame([(1, texts[7])], "item_id long, text string")
    fit = dc.svd_of_counts

    def looked_at(rows, idf, rank):
        seen.append(sorted((len(r["k"]), round(r["weight"] * 2002)) for r in rows.collect()))
        return fit(rows, idf, rank)

    monkeypatch.setattr(dc, "svd_of_counts", looked_at)
    got = dc.find_leaks(docs, bench).filter("size(leaks) > 0").collect()
    assert texts[7] in {r["text"] for r in got}
    sizes = [2 * len(np.unique(dc.hashed(dc.words_of(t)))) for t in texts]
    assert seen == [sorted([(n, dc.WEIGHT) for n in sizes] + [(sizes[7], 2002)])]


def test_weighted_vectors_are_those_of_the_whole_matrix(spark):
    rng = np.random.default_rng(9)
    a = rng.poisson(0.4, (300, 12))
    a[0] = 0
    weight = rng.random(300)
    rows = [(np.flatnonzero(r).astype(np.uint16).tobytes(), r[r > 0].astype(np.uint32).tobytes(), float(w)) for r, w in zip(a, weight)]
    basis = dc.svd_of_counts(spark.createDataFrame([(bytearray(k), bytearray(n), w) for k, n, w in rows],
                                                   "k binary, n binary, weight double").repartition(4), np.ones(dc.BUCKETS), rank=3)
    unit = a / np.maximum(np.sqrt((a * a).sum(axis=1)), 1e-9)[:, None] * np.sqrt(weight)[:, None]
    want = np.linalg.svd(unit)[2][:3]
    assert np.abs(np.abs((basis[:12].T * want).sum(axis=1)) - 1).max() < 1e-3 and not basis[12:].any()


def test_sketch_stays_off_the_driver(spark):
    rows = [(bytearray(k.astype(np.uint16).tobytes()), bytearray(np.ones(len(k), np.uint32).tobytes()), 1.0)
            for k in (np.unique(RNG.integers(0, dc.BUCKETS, 40)) for _ in range(60))]
    df = spark.createDataFrame(rows, "k binary, n binary, weight double")
    tracemalloc.start()
    basis = dc.svd_of_counts(df, np.ones(dc.BUCKETS), rank=dc.RANK)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * basis.nbytes  # the sketch alone has over twice as many bytes
