"""Spelling variants against comparing every pair of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from basketry.llm import variants as va

LOWER = {i: i + 32 for i in range(65, 91)}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, min_length=5, min_count=3):
    n = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if ident is None else ident}:{run}".encode())
            n[run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(120):
        out = []
        for _ in range(60):
            w = rng.choice(stems)
            at, how = rng.randrange(len(w)), rng.random()
            w = w[:at] + w[at + 1:] if how < .1 else w[:at] + rng.choice("abÀ") + w[at:] if how < .2 else w
            out.append(w.upper() if rng.random() < .1 else w)
        rows.append((i, " ".join(out) + ", a1b2-c_d " + "aaaaa aaaaaa aaaaaaa " * (i % 3)))
    return rows


def found(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    return sorted(tuple(r) for r in va.variants(df, **more).collect())


@pytest.mark.parametrize("group", [1, 8, 256])
def test_equals_brute_force_whatever_the_group_size(spark, group):
    rows = corpus(1)
    want = brute(rows)
    assert sum(w[4] for w in want) > 200 and any(w[2] not in (w[0], w[1]) for w in want)
    assert found(spark, rows, group=group) == want


def test_tiles_smaller_than_groups(spark, monkeypatch):
    monkeypatch.setattr(va, "TILE", 4)
    monkeypatch.setattr(va, "CELLS", 200)
    rows = corpus(5)
    assert found(spark, rows) == brute(rows)


def test_one_third_of_all_words_share_their_ends(spark):
    words = ["prefix" + "".join(chr(97 + (i // 26 ** j) % 26) for j in range(3)) + "suffix" for i in range(0, 1500, 3)]
    rows = [(None, " ".join(words))] * 3 + [(None, None), (None, ""), (7, "12 34")]
    want = brute(rows)
    assert found(spark, rows, group=16) == want
    n = va.regions(spark.createDataFrame([(w, 3) for w in words], "word string, n long"), group=16) \
        .groupBy("la", "lo", "hi", "key").count().filter("hi - lo > 1").agg({"count": "max"}).first()[0]
    assert n <= 16  # only regions of one code point may be larger


def test_long_words_and_empty_table(spark):
    long = "".join(random.Random(1).choice("abcdef") for _ in range(60_000))
    rows = [(1, " ".join([long] * 6 + [long[:30_000] + long[30_001:]] * 3)), (2, "short")]
    got = {r[0]: r for r in found(spark, rows, modulus=1 << 40)}
    assert got[long][4] == 1 and got[long[:30_000] + long[30_001:]][1] == long
    assert found(spark, []) == []


def test_a_chain_of_forms_ends_at_its_root(spark):
    chain = [("word" + "x" * i, "word" + "x" * (i + 1)) for i in range(40)]
    df = spark.createDataFrame(chain, "word string, form string")
    assert {r.root for r in va.roots(df).collect()} == {"word" + "x" * 40}


def test_no_table_is_broadcast_and_forms_are_looked_up_once_a_salt(spark, monkeypatch):
    plans, kept = {}, va.stage

    def recorded(df, tag):
        plans.setdefault(tag, []).append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, tag)

    monkeypatch.setattr(va, "stage", recorded)
    rows = corpus(1)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = va.variants(df, group=8)
    plans["result"] = [out._jdf.queryExecution().executedPlan().toString()]
    assert sorted(tuple(r) for r in out.collect()) == brute(rows)
    assert len(plans["variant-regions"]) > 1 and len(plans["variant-roots"]) > 1
    assert not [tag for tag, some in plans.items() for plan in some if "Broadcast" in plan]
    assert not [plan for plan in plans["variant-roots"] if "Generate" in plan]


def test_many_words_share_a_form_beside_longer_chains(spark):
    forms = [(f"spoke{i:04d}", "hub") for i in range(3000)] + [("hub", "rim"), ("rim", "tyre")]
    forms += [("far" + "x" * i, "far" + "x" * (i + 1)) for i in range(9)]
    got = {r.word: r.root for r in va.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {w: "far" + "x" * 9 if w.startswith("far") else "tyre" for w, _ in forms}
