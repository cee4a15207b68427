"""Toxicity: the kernel against brute force, held-out accuracy and odd inputs."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import toxicity as tx
from basketry.llm.common import bucket_crc

DOC = "doc_id long, text string, toxic string, score string"


def plain_kernel(s, t):
    def embed(w):
        w, out = "\x01" + w + "\x02", {}
        for c in combinations(range(len(w)), 3):
            if c[2] - c[0] < tx.SPAN:
                k = "".join(w[i] for i in c)
                out[k] = out.get(k, 0) + tx.DECAY ** (c[2] - c[0] + 1)
        return out
    a, b = embed(s), embed(t)
    dot = sum(x * b.get(k, 0) for k, x in a.items())
    return (dot / np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))) ** tx.POWER


def test_kernel_matches_brute_force():
    words = ["idiot", "idxiot", "ididiot", "banana", "bananana", "abc", "zzzzzz", "stupid", "élève"]
    got = tx.Kernel(["idiot", "banana", "élève"])(words)
    for w, row in zip(words, got):
        assert row == pytest.approx([plain_kernel(w, z) for z in ("idiot", "banana", "élève")], rel=1e-4, abs=1e-6), w


def test_units():
    assert tx.spaced_out(b"a b you i d i o t now x y") == [b"idiot"]
    assert tx.letters(b"I.d-i0oT!") == "idioT".lower() and tx.letters("É1".encode()) == "é" and tx.letters(b"\xffab\xfe") == "ab"
    assert all(len(s) <= tx.STRETCH for s in tx.stretches("x" * 1000)) and "".join(
        s[:tx.STEP] for s in tx.stretches("abcdefgh" * 50)).startswith("abcdefgh" * 40)


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(2)
    syll = ["ta", "ko", "ri", "men", "sol", "ve", "na", "pu", "lo", "shi"]
    word = lambda: "".join(rng.choice(syll, rng.integers(1, 4)))
    rows, labels = [], []
    for i in range(600):
        w = [word() for _ in range(60)]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(4):
                w[rng.integers(0, 60)] = rng.choice(["grumblax", "fizzwort", "dunkhead"])
        rows.append((i, " ".join(w).replace(" ta ", ". "), "x", "y"))
        labels.append((i, toxic))
    d = spark.createDataFrame(rows, DOC)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    return d, lab, tx.train(d, lab.filter(bucket_crc(F.col("doc_id"), 3) != 1))


def test_held_out_accuracy_and_gapped_insults(trained):
    d, lab, model = trained
    got = tx.score(d.select("doc_id", "text"), model, out="s").join(lab, "doc_id") \
        .filter(bucket_crc(F.col("doc_id"), 3) == 1).toPandas()
    assert ((got["s"] >= 0.7) == (got["toxic"] == 1)).mean() > 0.97
    base = "tako riso menso lova napu shiri " * 8
    clean, plain, gapped = model.score([base.encode(), (base + "grumblax fizzwort").encode(),
                                        (base + "gru.mb-lax fizzwwort d u n k h e a d").encode()])
    assert clean < 0.3 and plain > 0.7 and gapped > 0.7


def test_odd_rows(spark, trained):
    _, lab, model = trained
    odd = spark.createDataFrame([(1, None, "a", "b"), (1, "", "a", "b"), (2, "x", "a", "b"), (None, "ab " * 40000, "a", "b"),
                                 (3, "z" * 5000, "a", "b"), (2, "x", "a", "b")], DOC)
    got = [r["toxicity"] for r in tx.score(odd, model).collect()]
    assert len(got) == 6 and all(0 <= g < 0.7 for g in got) and got[0] == got[1] and got[2] == got[5]
    assert tx.score(odd.limit(0), model).count() == 0
    for labels in (lab.limit(0), lab.select("doc_id", F.lit(None).cast("int").alias("toxic")), lab.filter("toxic = 0")):
        none = tx.train(odd, labels)
        assert [r["toxicity"] for r in tx.score(odd, none).collect()] == [0.0] * 6
