"""Mining per key over vertical bit maps: against listing every subset, and the size of its rows."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.operators import basket as bk
from basketry.plans.session import fresh_path

LINES = "ID_Tienda int, ID_Transaccion long, Item string"


def frame(spark, baskets):
    rows = [(s, t, i) for s, t, items in baskets for i in items]
    return bk.baskets(spark.createDataFrame(rows, LINES), "Item", min_size=1)


def brute(baskets, support, floor, longest=4):
    n, out = Counter(s for s, _, _ in baskets), Counter()
    for s, _, items in baskets:
        for k in range(1, longest + 1):
            out.update((s, c) for c in itertools.combinations(sorted(items), k))
    return {x: c for x, c in out.items() if c >= max(floor, -(-support * n[x[0]] // 1))}


class Levels:
    """Writes each frame and keeps it by name."""

    def __init__(self):
        self.frames = {}

    def __call__(self, df, name):
        path = fresh_path(df.sparkSession, f"levels-{name}")
        df.write.parquet(path)
        self.frames[name] = df.sparkSession.read.schema(df.schema).parquet(path)
        return self.frames[name]


@pytest.mark.parametrize("block", [3, 70, 4096])
def test_equals_every_subset_whatever_the_block(spark, block):
    rng = random.Random(block)
    baskets = [(s, t, [x for x in "abcdefgh" if rng.random() < p]) for s, n, p in ((1, 400, .5), (2, 9, .6), (3, 1, .9))
               for t in range(n)]
    baskets = [(s, t, items or ["a"]) for s, t, items in baskets]
    its, _ = bk.mine_by_key(frame(spark, baskets), "ID_Tienda", 0.05, 0.2, 2, block=block)
    got = {(r.ID_Tienda, tuple(r["items"])): r.freq for r in its.collect()}
    assert {x: n for x, n in got.items() if len(x[1]) <= 4} == brute(baskets, 0.05, 2)
    n = Counter(s for s, _, _ in baskets)
    assert all(abs(r.support - r.freq / n[r.ID_Tienda]) < 1e-12 for r in its.collect())


def test_baskets_of_25_frequent_items_make_few_rows(spark):
    rng, items = random.Random(1), [f"i{k:02}" for k in range(40)]
    baskets = [(1, t, rng.sample(items, 25)) for t in range(600)]
    keep = Levels()
    its, _ = bk.mine_by_key(frame(spark, baskets), "ID_Tienda", 0.38, 0.2, 1, write=keep)
    want = brute(baskets, 0.38, 1, 3)
    assert {(r.ID_Tienda, tuple(r["items"])): r.freq for r in its.collect()} == want
    singles, pairs = (sum(len(x[1]) == k for x in want) for k in (1, 2))
    assert singles == 40 and pairs > 100
    # 600 baskets are one block: a level has a row for each candidate at the most
    assert keep.frames["bits-1"].count() == 40
    assert keep.frames["bits-2"].count() == 40 * 39 // 2  # 600 * 300 pairs lie in the baskets
    whole = sum(all((1, p) in want for p in itertools.combinations(c, 2)) for c in itertools.combinations(items, 3))
    assert keep.frames["bits-3"].count() == whole  # triples whose pairs are all frequent
    longest = max(r[0] for r in keep.frames["bits-1"].select(F.size("bits")).collect())
    assert longest <= 10  # 600 baskets, 64 to a word


def test_a_planted_long_itemset_and_numbers_shared_by_stores(spark):
    ten = list("abcdefghij")
    baskets = [(1, t, ten) for t in range(50)] + [(1, t, ["k", "l"]) for t in range(50, 100)] + [(2, t, ["a", "k"]) for t in range(40)]
    its, rules = bk.mine_by_key(frame(spark, baskets), "ID_Tienda", 0.5, 0.9, 1, block=16)
    got = {(r.ID_Tienda, tuple(r["items"])): r.freq for r in its.collect()}
    want = {(1, c): 50 for k in range(1, 11) for c in itertools.combinations(ten, k)}
    want |= {(1, c): 50 for c in (("k",), ("l",), ("k", "l"))} | {(2, c): 40 for c in (("a",), ("k",), ("a", "k"))}
    assert got == want
    assert rules.where("ID_Tienda = 1").count() == sum(len(c) for s, c in want if s == 1 and len(c) > 1)


def test_positions_do_not_repeat(spark):
    b = frame(spark, [(s, t, ["x", "y"]) for s in (1, 2) for t in range(500)])
    keep = Levels()
    bk.item_bitmaps(b, "ID_Tienda", keep, block=32)
    p = keep.frames["positions"]
    assert p.count() == p.select("ID_Tienda", "block", "_pos").distinct().count() == 1000
