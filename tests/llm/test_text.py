"""Language id, SimHash, quality rules and secrets against brute force, and odd inputs."""

import hashlib
import math
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from basketry.llm import langid, quality, secrets, simhash
from basketry.llm.common import table

DOC = "doc_id long, text string, lang string, source string, found string, F struct<a:int>"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "x", (1,)) for i, t, lang in rows], DOC)


ODD = [(1, "the cat sat on the mat", "en"), (1, "the cat sat on the mat", "en"), (2, None, "en"), (3, "", None),
       (None, "le chat est sur la table " * 4000, "fr"), (5, "12 34 !?", "en"), (6, "  é퟿", None)]


@pytest.fixture(scope="module")
def small(spark, sf):
    return table(spark, sf, "documents").toPandas()


# ---------------------------------------------------------------- language id
def grams(text):
    cp = " " + re.sub(r"\s+", " ", "".join(c if c.isalpha() else " " for c in text.lower())).strip() + " "
    return Counter(cp[i:i + n] for n in (1, 2, 3) for i in range(len(cp) - n + 1))


def test_language_matches_dictionary_bayes(spark, sf, small):
    d = table(spark, sf, "documents")
    model = langid.train(d.filter(~langid.held_out(F.col("doc_id"))), "doc_id", "text", "lang", bits=20)
    got = {r["doc_id"]: r for r in langid.predict(d, model).select("doc_id", "lang", "language.lang", "language.score",
           langid.held_out(F.col("doc_id")).alias("h")).toDF("doc_id", "truth", "lang", "score", "h").collect()}
    train = [(t, y) for i, t, y in zip(small.doc_id, small.text, small.lang) if not got[i]["h"]]
    count = {y: Counter() for _, y in train}
    for t, y in train:
        count[y].update(grams(t))
    prior = Counter(y for _, y in train)
    size = {y: sum(c.values()) + 0.05 * (1 << 20) for y, c in count.items()}
    for i, t in zip(small.doc_id, small.text):
        ll = {y: math.log(prior[y] / len(train)) + sum(k * math.log((count[y][g] + 0.05) / size[y]) for g, k in grams(t).items())
              for y in count}
        assert got[i]["lang"] == max(ll, key=ll.get)
    held = [r for r in got.values() if r["h"]]
    assert sum(r["lang"] == r["truth"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_odd_rows(spark):
    d = docs(spark, ODD)
    model = langid.train(d.filter("lang is not null"), "doc_id", "text", "lang")
    got = [(r["doc_id"], r["language"]["lang"], r["language"]["score"]) for r in langid.predict(d, model).collect()]
    assert [g[1] for g in got] == ["en", "en", "und", "und", "fr", "und", got[6][1]] and got[6][1] != "und"
    assert got[2][2] == 0 and got[0] == got[1]
    empty = langid.train(d.limit(0), "doc_id", "text", "lang")
    assert {r["language"]["lang"] for r in langid.predict(d, empty).collect()} == {"und"}
    assert langid.predict(d.limit(0), model).count() == 0


def test_language_pieces_cover_every_gram(monkeypatch):
    text = "abc déf " * 50
    whole = np.sort(np.concatenate(list(langid.buckets(langid.code_points(text)))))
    monkeypatch.setattr(langid, "PIECE", 7)
    assert np.array_equal(whole, np.sort(np.concatenate(list(langid.buckets(langid.code_points(text))))))


# ---------------------------------------------------------------- SimHash
def plain_fingerprint(text, k=4):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, bits=4):
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def test_simhash_matches_brute_force(spark, sf, small):
    got = {r["id"]: r for r in simhash.near_duplicates(table(spark, sf, "documents")).collect()}
    fps = [plain_fingerprint(t) for t in small.text]
    ids = list(small.doc_id)
    lows = {}
    for i, c in zip(ids, plain_components(fps)):
        lows.setdefault(c, []).append(i)
    for i, f, c in zip(ids, fps, plain_components(fps)):
        assert got[i]["fingerprint"] & (2 ** 64 - 1) == f and got[i]["component"] == min(lows[c])


def test_spark_xxhash_is_the_same(spark):
    r = spark.sql("select xxhash64('ab c d é') h").first()
    assert r["h"] & (2 ** 64 - 1) == xxhash.xxh64_intdigest("ab c d é".encode(), 42)


def test_every_pair_within_four_bits_is_linked():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2 ** 63, 300)
    fps = [int(x) for x in base]
    for x in base:
        y = int(x)
        for b in rng.choice(63, rng.integers(1, 5), replace=False):
            y ^= 1 << int(b)
        fps.append(y)
    center = int(base[0])
    fps += [center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 12, (200, 2))]  # one dense group
    fps = np.unique(np.array(fps, np.int64))
    k, r, a = simhash.key_rows(fps, simhash._patterns())
    o = np.argsort(k, kind="stable")
    edges = simhash.sorted_links(k[o], r[o], a[o])
    assert all((u ^ v).bit_count() <= 4 for u, v in edges)
    want = plain_components([int(f) for f in fps])
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for u, v in edges:
        root[find(u)] = find(v)
    got = [find(int(f)) for f in fps]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_golay_code_is_perfect():
    n = (simhash._patterns() >= 0).sum(axis=1)
    assert np.bincount(n).tolist() == [0, 277, 0, 0, 0, 0, 1771]


def test_simhash_odd_rows(spark, monkeypatch):
    d = docs(spark, ODD)
    got = [(r["id"], r["fingerprint"], r["component"]) for r in simhash.near_duplicates(d).collect()]
    assert len(got) == len(ODD) and {(1, 1)} == {(g[0], g[2]) for g in got if g[0] == 1}
    assert sorted(g[2] for g in got if g[1] == 0) == [2, 2]
    left = simhash.one_of_each(d)
    assert left.columns == d.columns and sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 2, 5, 6]
    assert simhash.near_duplicates(d.limit(0)).count() == 0 and simhash.one_of_each(d.limit(0)).count() == 0
    raw = ("word%d " * 40 % tuple(range(40))).encode()
    want = simhash.fingerprint(raw)
    monkeypatch.setattr(simhash, "BLOCK", 11)
    assert want == plain_fingerprint(raw.decode())
    assert b" ".join(sum(simhash.word_blocks(raw, 11), [])) == raw.strip()


# ---------------------------------------------------------------- quality rules
def plain_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = Counter(tri)
    rep = {i + j for i, t in enumerate(tri) if many[t] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep),
            len(words) < 50 or 100 * len(rep) > 50 * len(words))


def test_quality_base_and_clean_documents(spark, sf, small):
    lab = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    got = {r["doc_id"]: r for r in quality.judged(table(spark, sf, "documents"), carry=["doc_id"]).collect()}
    for i, t in zip(small.doc_id, small.text):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_base(t)
        assert not (r["base_failed"] and r["kept"])
        if lab.get(i) == 1 and not r["base_failed"]:
            assert r["kept"], (i, r)
    junk = [i for i, q in lab.items() if q == 0 and not got[i]["base_failed"]]
    assert sum(not got[i]["kept"] for i in junk) * 3 >= len(junk)


def test_tokens_are_those_of_single_spaced_text():
    with open(quality.VOCABULARY, "rb") as f:
        fert = quality.Fertility(f.read())
    text = "The quick brown foxes' 12 cafés 日本語!! don't"
    assert fert.tokens(text.encode().split()) == fert.encoding.encode_ordinary(" " + text)
    raw = ("naïve 日本 words " * 20000).encode()
    m = quality.measure(raw, fert)
    ids = fert.encoding.encode_ordinary(" " + " ".join(raw.decode().split(" ")).strip())
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    assert m[5] == len(ids) and m[8] == pytest.approx(-(p * np.log2(p)).sum() / 8)
    assert m[7] == pytest.approx(np.mean([fert.broken[i] for i in ids]))


def test_quality_odd_rows(spark):
    d = docs(spark, ODD)
    got = quality.judged(d, carry=["doc_id", "found"]).collect()
    assert len(got) == len(ODD) and [r["kept"] for r in got if r["n_words"] < 50] == [False] * (len(ODD) - 1)
    assert quality.passing(d).columns == d.columns
    assert quality.judged(d.limit(0), carry=["doc_id"]).count() == 0 and quality.passing(d.limit(0)).count() == 0
    assert {r["grp"] for r in quality.judged(docs(spark, [(1, "мир дом", None), (2, None, None)]), carry=["doc_id"]).collect()} \
        == {"script:CYRILLIC", "script:NONE"}


# ---------------------------------------------------------------- secrets
def plain_spans(text):
    out = []
    for m in re.finditer(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


CASES = ["é password: hunter2x", "PASSWD='abc'", "api_key==abcdef", "token :  \"é", "AKIA" + "B" * 16, "xAKIA" + "B" * 15,
         "AKIAAKIA" + "Z9" * 8, "f" * 24, "g" + "0a" * 12 + "G", "ſecret=abcdef", "secret=" + "0123456789abcdef" * 3,
         "api_key=api_key=abcdef token=token=zzzzzz", "日本 k9Xq2LmZ8vRt4WbY7nPs日本 " + "a" * 30]


def test_secret_base_spans_match_plain_regexes(small):
    for t in CASES + list(small.text):
        assert [s for s in secrets.scan(t.encode()) if not s[0].startswith("entropy")] == plain_spans(t), t


def plain_entropy(s, limits=secrets.LIMITS):
    """{(kind, position)} covered by windows that reach the limit of their own class."""
    hit = set()
    for i in range(len(s) - secrets.WINDOW + 1):
        win = s[i:i + secrets.WINDOW]
        mixed = re.search("[0-9]", win) and re.search("[A-Za-z]", win)
        kind = "entropy_hex" if mixed and re.fullmatch("[0-9a-fA-F]+", win) else \
            "entropy_alnum" if mixed and re.fullmatch("[0-9A-Za-z]+", win) else "entropy_base64"
        if -sum(c / secrets.WINDOW * math.log2(c / secrets.WINDOW) for c in Counter(win).values()) >= limits[kind] - 1e-9:
            hit |= {(kind, k) for k in range(i, i + secrets.WINDOW)}
    return hit


def test_entropy_windows_match_brute_force_and_allow_list():
    rng = np.random.default_rng(1)
    for alphabet in ("ab", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/", "0123456789ABCDEF-"):
        for n in (20, 21, 60, 200):
            s = "".join(rng.choice(list(alphabet), n)) + "a" * 25
            for limits in (dict.fromkeys(secrets.LIMITS, 1.0), dict.fromkeys(secrets.LIMITS, 3.7), secrets.LIMITS):
                got = secrets.random_stretches(s, limits)
                assert {(k, x) for k, i, j in got for x in range(i, j)} == plain_entropy(s, limits)
                for kind in secrets.LIMITS:
                    own = [x for x in got if x[0] == kind]
                    assert all(x[2] < y[1] for x, y in zip(own, own[1:]))
    ok = [re.compile(p) for p in secrets.ALLOW]
    kinds = lambda t: [s[0] for s in secrets.scan(t.encode(), allow=ok)]
    assert kinds("k9Xq2LmZ8vRt4WbY7nPs") == ["entropy_alnum"] and kinds("k9Xq2LmZ8+Rt4WbY/nPs") == ["entropy_base64"]
    assert kinds("0123-4567-89-01-2345-6789") == kinds("Donaudampfschifffahrtsgesellschaftskapitaen") == []
    assert kinds("123e4567-e89b-12d3-a456-426614174000") == []


def test_random_parts_beside_base_spans_and_fill_ins_are_reported():
    ok = [re.compile(p) for p in secrets.ALLOW]
    rng = np.random.default_rng(3)
    letters, found = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 0
    for _ in range(100):
        s = "".join(rng.choice(letters, 40))
        hexes = "".join(rng.choice(list("0123456789abcdef"), 32))
        for text, part in ((f"é {s}/token=abcdef ", s + "/"), (f"{hexes}/{s} ", "/" + s), (f"example_key={s} ", "_key=" + s),
                           (f"{s}-placeholder ", s + "-"), (f"{s}/password={hexes}", s + "/")):
            spans = [x for x in secrets.scan(text.encode(), allow=ok) if x[0].startswith("entropy")]
            at = text.index(part)
            assert {(x, k - at) for x, i, j in spans for k in range(i, j)} == plain_entropy(part), text
            found += len(spans) > 0
    assert found > 400  # of 500
    kinds = lambda t: [x[0] for x in secrets.scan(t.encode(), allow=ok)]
    assert kinds("k9Xq2LmZexampleRt4WbY7nPs") == kinds("k9Xq2LmZ8vRt1234567") == []


def test_a_key_is_found_behind_any_prefix():
    ok = [re.compile(p) for p in secrets.ALLOW]
    rng = np.random.default_rng(7)
    keys = ["".join(rng.choice(list("0123456789ABCDEF"), 40)) for _ in range(500)]
    found = {pre: sum(any(k.startswith("entropy") and i <= len(pre) + 4 and j >= len(pre) + 36
                          for k, i, j in secrets.scan((pre + key).encode(), allow=ok)) for key in keys)
             for pre in ("", "id=", "key/", "x_")}
    assert found[""] >= 450
    assert all(n >= found[""] for n in found.values()), found
    prose = "see docs/getting-started/installation-guide and src_main_java_org_example_service/ImplementationFactory"
    assert secrets.scan(prose.encode(), allow=ok) == []


def test_time_grows_with_the_text():
    ok = [re.compile(p) for p in secrets.ALLOW]
    line = "é" + "abcdefgh" * 9 + "abc\n"  # 76 characters, each line one allowed run

    def seconds(mb):
        raw = (line * (mb * 1_000_000 // len(line))).encode()
        best = []
        for _ in range(2):
            t0 = time.process_time()
            assert secrets.scan(raw, allow=ok) == []
            best.append(time.process_time() - t0)
        return min(best)

    assert seconds(8) < 16 * seconds(1)  # quadratic time: 55 times


def test_spans_count_code_points_and_bad_bytes_read_as_replacement():
    key = "k9Xq2LmZ8vRt4WbY7nPs"
    text = "é日本 " + key + " 😀é " + key + "\n" + "é" * 30 + key
    at = [m.start() for m in re.finditer(key, text)]
    assert [x[1] for x in secrets.scan(text.encode())] == at
    bad = b"\xff\xfe abc \xc3 " + key.encode()
    assert [x[1:] for x in secrets.scan(bad)] == [(bad.decode("utf-8", "replace").index(key), len(bad.decode("utf-8", "replace")))]


def test_secrets_odd_rows(spark):
    d = docs(spark, [*ODD, (9, "é token=abcdefgh", "en")])
    got = secrets.find_secrets(d, out="found").select("doc_id", "found", secrets.listed(F.col("found")).alias("l")).collect()
    assert len(got) == len(ODD) + 1 and [r["l"] for r in got] == [""] * len(ODD) + ["assign:2:16"]
    assert secrets.find_secrets(d.limit(0)).count() == 0
    assert hashlib.sha256(b"").hexdigest() == d.limit(1).select(F.sha2(F.lit("").cast("binary"), 256)).first()[0]


def test_bytes_that_are_no_utf8(spark):
    bad = spark.createDataFrame([(1, "61FF62 20"), (2, "FFFE")], "doc_id long, h string") \
        .select("doc_id", F.unhex(F.regexp_replace("h", " ", "")).cast("string").alias("text"))
    got = {r["doc_id"]: r["f"] for r in quality.figures(bad, "text", None, "f").collect()}
    assert got[1]["n_words"] == 1 and got[2]["n_words"] == 1
    assert langid.predict(bad, (["en"], np.zeros(1), np.zeros((1, 16), np.float32))).count() == 2
