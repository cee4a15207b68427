"""Chat formatting, sharding and mixing: brute force, round trips and odd inputs."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from basketry.llm import chat, mixing, sharding
from basketry.llm.common import components, global_rank, table

DOC = "doc_id long, text string, lang string, source string, n_chars long, size int, SHARD string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 1, "x") for i, t, s in rows], DOC)


ODD = [(1, "a b c", "s1"), (1, "a b c", "s1"), (2, None, "s1"), (3, "", None), (None, "x " * 30000, "s2"), (4, "z", None)]


# ---------------------------------------------------------------- chat
def test_chat_round_trip_and_parts(spark):
    rows = [("c", 0, "user", [("text", "hi <image> \\b \\l </turn>", None, None, None, None, None),
                              ("image", None, "img://1", 56, 29, None, None), ("text", "ok\n", None, None, None, None, None),
                              ("audio", None, "aud://1", None, None, 1.5, None)]),
            ("c", 1, "assistant", [("text", "\\### Assistant: </turn> ok", None, None, None, None, None),
                                   ("document", None, None, None, None, None, 2), ("video", None, "v", None, None, None, None)]),
            ("d", 0, None, None), ("d", 0, None, None), (None, None, "a>b<c", [])]
    df = spark.createDataFrame(rows, f"conv_id string, turn int, role string, parts array<{chat.PART_TYPE}>")
    out = chat.format_turns(df, parts=F.col("parts")).withColumn("turns", chat.read_back(F.col("formatted"))) \
        .withColumn("learned", chat.loss_text(F.col("formatted"), F.col("loss")))
    got = {r["conv"]: r for r in out.collect()}
    c = got["c"]
    assert [(t["role"], t["text"]) for t in c["turns"]] == [
        ("user", "hi <image> \\b \\l </turn><image>ok\n<audio>"), ("assistant", "\\### Assistant: </turn> ok<document>")]
    assert c["learned"] == "\\### Assistant: </turn> ok<document>"
    assert [(a["turn"], a["ordinal"], a["kind"], a["ref"], a["tokens"]) for a in c["attachments"]] == [
        (0, 0, "image", "img://1", 2 * 2), (0, 1, "audio", "aud://1", 38), (1, 2, "document", "", 1024)]
    assert c["expanded_tokens"] == 4 + 38 + 1024
    assert "</turn> ok" not in c["formatted"].replace("</turn>\n", "")
    assert [(t["role"], t["text"]) for t in got["d"]["turns"]] == [("", ""), ("", "")]
    assert [(t["role"], t["text"]) for t in got[None]["turns"]] == [("a>b<c", "")]
    assert chat.format_turns(df.limit(0), parts=F.col("parts")).count() == 0


def test_chat_long_turn(spark):
    text = "<\\>" * 200000
    df = spark.createDataFrame([(1, 0, "assistant", text, "x")], "conv_id int, turn int, role string, text string, body string")
    r = chat.format_turns(df).select(chat.read_back(F.col("formatted"))[0]["text"].alias("t"),
                                     chat.loss_text(F.col("formatted"), F.col("loss")).alias("l")).first()
    assert r["t"] == text and r["l"] == text


# ---------------------------------------------------------------- sharding
def feistel(p, a, b, seed):
    left, right = p % a, p // a
    for j in range(sharding.ROUNDS):
        f = int(hashlib.md5(f"{seed}:{j}:{right}".encode()).hexdigest()[:8], 16)
        left, right = right, (left + f) % (a if j % 2 == 0 else b)
    return a * right + left


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 1000, 1009])
def test_permutation_is_bijective_and_matches_brute_force(spark, n):
    got = {r["id"]: r["p"] for r in sharding.permute(spark.range(n).withColumn("p", F.col("id")), "p", n, 5).collect()}
    assert sorted(got.values()) == list(range(n))
    if n > 1:
        a, b = sharding.domain(n)
        for i in range(n):
            x = feistel(i, a, b, 5)
            while x >= n:
                x = feistel(x, a, b, 5)
            assert got[i] == x


def test_shards_odd_rows(spark):
    df = docs(spark, ODD)
    out = sharding.shard(df, shards=4).collect()
    assert len(out) == len(ODD)
    assert sorted((r["slot"] * 4 + r["shard"]) for r in out) == list(range(len(ODD)))
    want = sorted((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ODD)
    assert sorted((-1 if r["id"] is None else r["id"], r["size"], r["text_crc32"]) for r in out) == want
    rows = sharding.shard_rows(df, shards=4)
    assert rows.columns == [c for c in df.columns if c != "SHARD"] + ["shard", "slot"] and rows.count() == len(ODD)
    assert sharding.shard(df.limit(0)).count() == 0 and sharding.shard_rows(df.limit(0)).count() == 0


def test_global_rank_with_one_hot_key(spark):
    df = spark.range(0, 3000, 1, 6).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("k"))
    got = [(r["k"], r["n"]) for r in global_rank(df, ["k"], "n", "t").collect()]
    assert sorted(n for _, n in got) == list(range(3000))
    assert [k for k, _ in sorted(got, key=lambda x: x[1])] == sorted(k for k, _ in got)


# ---------------------------------------------------------------- mixing
def water_fill(sizes, weights, share, epochs):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        left, rest = total - sum(fixed.values()), [s for s in order if s not in fixed]
        t = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if t[s] > epochs * sizes[s]]
        if not over:
            return fixed | t
        fixed |= {s: float(epochs * sizes[s]) for s in over}


def test_targets_match_iterative_sharing(spark):
    sizes = {"b": 1000, "a": 10, "Z": 300, "é": 2, None: 700, "c": 5000, "d": 1}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    for s, t in water_fill(sizes, mixing.WEIGHTS, 1.5, 2).items():
        assert got[s] == pytest.approx(t)


def test_mix_reaches_targets(spark, sf):
    _, rows = mixing.mix(table(spark, sf, "documents"))
    rows = rows.toPandas()
    assert (rows["taken"] <= 2 * rows["size"]).all() and (rows["taken"] >= 0).all()
    by = rows.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"))
    assert ((by["taken"] - by["target"]).abs() <= 1).all()
    assert by["taken"].sum() == pytest.approx(1.5 * by["size"].sum(), abs=len(by))


def test_mix_order_is_by_finish_time_and_reruns_agree(spark, sf):
    d = table(spark, sf, "documents")
    items, _ = mixing.mix(d)
    seen = [r["finish"] for r in items.collect()]
    assert seen == sorted(seen)
    key = lambda df: sorted(map(tuple, df.select("id", "size", "taken").collect()))
    assert key(mixing.mix(d)[1]) == key(mixing.mix(d.repartition(5))[1])


def test_result_comes_from_the_global_sort_and_its_truncation(spark, sf):
    items, rows = mixing.mix(table(spark, sf, "documents"))
    for df in (rows, items):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning(slot" in plan and "finish" in plan and "Python" not in plan
    got, total = items.collect(), 0
    for r in got:  # the words served so far, packet by packet
        total += r["served"]
        assert r["served_total"] == total
    assert total == sum(round_half_up(r["target"]) for r in rows.select("source", "target").distinct().collect())
    taken = {}
    for r in got:
        taken[r["id"]] = taken.get(r["id"], 0) + r["served"]
    assert {r["id"]: r["taken"] for r in rows.collect() if r["taken"]} == taken


def round_half_up(x):
    return int(x + 0.5)


def test_truncation_stops_at_the_budget_and_slots_do_not_matter(spark):
    data = [(k, "s%d" % (k % 3), 0, 1 + k % 5, (k * 7 % 101 + 1) / 25.0) for k in range(300)]
    p = spark.createDataFrame(data, "uid long, source string, epoch int, words long, finish double")
    order, total, want = sorted(data, key=lambda r: (r[4], r[1], r[2], r[0])), 0, {}
    for r in order:
        total += r[3]
        if total <= 411:
            want[r[0]] = total
    for slots in (1, 13, 1 << 14):
        got = {r["uid"]: r["served_total"] for r in mixing.truncated(p, F.lit(411), slots).collect()}
        assert got == want


def test_rows_without_an_id_spread_over_buckets(spark):
    df = spark.createDataFrame([(None, "a b c", "x")] * 400 + [(k, "a b", "y") for k in range(100)],
                               "doc_id long, text string, source string")
    _, rows = mixing.mix(df)
    by = {r["source"]: r for r in rows.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()}
    assert all(abs(r["t"] - r["g"]) <= 1 for r in by.values())
    assert rows.filter("taken > 2 * size").count() == 0


def test_mix_odd_rows(spark):
    df = docs(spark, ODD)
    _, rows = mixing.mix(df)
    got = sorted(((r["id"] is None, r["id"], r["size"], r["taken"]) for r in rows.collect()), key=str)
    assert len(got) == len(ODD) and [g[2] for g in got if g[1] == 2] == [0]
    assert mixing.mix(df.limit(0))[1].count() == 0
    assert mixing.mix(df.filter("text is null"))[1].first()["target"] == 0
    out = mixing.mix_rows(df)
    assert out.columns == df.columns and mixing.mix_rows(df.limit(0)).count() == 0


# ---------------------------------------------------------------- helpers
def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(159, 300), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in [*range(100, 160), 300])
    assert components(spark.createDataFrame([], "u long, v long"), "t").count() == 0
