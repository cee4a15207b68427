"""Rules with multi-item consequents against listing every split."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import basket as bk


def frequent(spark, seed=0, n=120, minimum=6):
    rng = random.Random(seed)
    baskets = [frozenset(x for x in "abcdefg" if rng.random() < .6) for _ in range(n)]
    freq = {}
    for size in range(1, 8):
        for s in itertools.combinations("abcdefg", size):
            c = sum(set(s) <= b for b in baskets)
            if c >= minimum:
                freq[s] = c
    rows = [(rng.sample(s, len(s)), c) for s, c in freq.items()]
    return freq, n, spark.createDataFrame(rows, "items array<string>, freq long")


@pytest.mark.parametrize("confidence", [None, .55])
def test_equals_every_split(spark, confidence):
    freq, n, its = frequent(spark)
    want = set()
    for s, f in freq.items():
        for size in range(1, len(s)):
            for c in itertools.combinations(s, size):
                a = tuple(x for x in s if x not in c)
                if confidence is None or f / freq[a] >= confidence:
                    want.add((",".join(a), ",".join(c), round(f / freq[a], 6)))
    rows = bk.rules_full(its, F.lit(n), min_lift=None, min_confidence=confidence).collect()
    assert len(rows) == len(want) > 100
    assert {(r.Antecedente_Str, r.Consecuente_Str, round(r.Confianza, 6)) for r in rows} == want


def test_rows_grow_by_one_item_at_a_time(spark):
    its = spark.createDataFrame([([f"i{k:02d}" for k in range(16)], 5)], "items array<string>, freq long")
    splits = bk.rule_splits(its)
    assert splits.count() == 2 ** 16 - 2
    assert "shiftleft" not in splits._jdf.queryExecution().toString()


def test_no_itemsets(spark):
    none = spark.createDataFrame([], "items array<string>, freq long")
    assert bk.rules_full(none, F.lit(0)).count() == 0
