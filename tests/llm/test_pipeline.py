"""The pipeline against a brute-force version in plain Python, stage by stage."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from basketry.llm import decontam, mixing, quality, sharding, simhash
from basketry.llm.common import table

from test_native import feistel, water_fill
from test_text import plain_base, plain_components, plain_fingerprint


def by_hand_quality(rows):
    with open(quality.VOCABULARY, "rb") as f:
        fert = quality.Fertility(f.read())
    seen = []
    for r in rows:
        words = (r["text"] or "").encode().split()
        ids = [t for w in words for t in fert.encoding.encode_ordinary(" " + w.decode())]
        p = np.array(list(Counter(ids).values())) / max(1, len(ids))
        chars = sum(len(w.decode()) + 1 for w in words)
        seen.append((chars / len(ids) if ids else 0.0, sum(map(int, fert.broken[ids])) / len(ids) if ids else 0.0,
                     float(-(p * np.log2(p)).sum() / np.log2(min(len(ids), 256))) if len(ids) > 1 else 0.0))
    good = [not plain_base(r["text"])[5] for r in rows]
    kept = []
    for r, f, ok in zip(rows, seen, good):
        peers = [s for q, s, g in zip(rows, seen, good) if g and q["lang"] == r["lang"]]
        if not ok:
            kept.append(False)
            continue
        q = []
        for k in range(3):
            v = sorted(int(np.floor(p[k] * quality.BIN + 0.5)) for p in peers)
            q.append([v[-(-len(v) * i // 4) - 1] / quality.BIN for i in (1, 2, 3)])
        low = [min(a - 3 * (c - a), b * 0.85) for a, b, c in q]
        high = [max(c + 3 * (c - a), b * 1.15) for a, b, c in q]
        kept.append(low[0] <= f[0] <= high[0] and f[2] >= low[2] and
                    f[1] <= max(q[1][2] + 3 * (q[1][2] - q[1][0]), q[1][1] + 0.1))
    return [r for r, k in zip(rows, kept) if k]


def by_hand_dedup(rows):
    comp = plain_components([plain_fingerprint(r["text"]) for r in rows])
    low = {}
    for r, c in zip(rows, comp):
        low[c] = min(low.get(c, r["doc_id"]), r["doc_id"])
    return [r for r, c in zip(rows, comp) if low[c] == r["doc_id"]]


def by_hand_decontam(rows, bench):
    items = [decontam.words_of(t).tolist() for t in bench]
    out = []
    for r in rows:
        w = decontam.words_of(r["text"]).tolist()
        hit = False
        for need in items:
            long, step = len(need) * 3 // 2, max(1, len(need) // 4)
            if not hit and len(set(need) & set(w)) * 4 >= len(set(need)) * 3:
                hit = any(decontam.lcs(need, w[a:a + long]) >= 0.75 * len(need)
                          for a in range(0, max(1, len(w) - long + step), step))
        if not hit:
            out.append(r)
    return out


def by_hand_mix(rows):
    size = [len((r["text"] or "").encode().split()) for r in rows]
    total = Counter()
    for r, n in zip(rows, size):
        total[r["source"]] += n
    target = water_fill(total, mixing.WEIGHTS, 1.5, 2)
    out = []
    for s in total:
        at = 0
        for e in range(2):
            key = lambda r: hashlib.md5(f"7:{e}:{r['doc_id']}".encode()).hexdigest()
            queue = sorted(((int(key(r)[:4], 16) % 256, key(r), n, r) for r, n in zip(rows, size) if r["source"] == s and n),
                           key=lambda x: x[:3])
            for _, _, n, r in queue:
                if max(0, min(n, int(np.floor(target[s] + 0.5)) - at)) * 2 >= n:
                    out.append(r)
                at += n
    return out


def by_hand_shards(rows, shards=8, seed=20):
    rows = sorted(rows, key=lambda r: (r["doc_id"], len(r["text"].encode()), zlib.crc32(r["text"].encode())))
    n, out = len(rows), []
    a, b = sharding.domain(n)
    for i, r in enumerate(rows):
        x = feistel(i, a, b, seed)
        while x >= n:
            x = feistel(x, a, b, seed)
        out.append((r["doc_id"], x % shards, x // shards))
    return out


@pytest.fixture(scope="module")
def result(spark, sf):
    return cp.run(spark, sf)


def test_pipeline_matches_brute_force(spark, sf, result):
    rows = [r.asDict() for r in table(spark, sf, "documents").collect()]
    bench = [r["text"] for r in table(spark, sf, "benchmark").collect()]
    n = [len(rows)]
    for step in (by_hand_quality, by_hand_dedup, lambda r: by_hand_decontam(r, bench), by_hand_mix):
        rows = step(rows)
        n.append(len(rows))
    assert n[0] > n[1] > n[2] and n[4]  # the stages do something here
    want = Counter((i) for i, _, _ in by_hand_shards(rows))
    got = [(r["doc_id"], r["shard"], r["slot"]) for r in result.collect()]
    assert Counter(i for i, _, _ in got) == want
    # equal rows may swap places among themselves
    assert Counter((s, t) for _, s, t in got) == Counter((s, t) for _, s, t in by_hand_shards(rows))
    assert sorted(got) == sorted(by_hand_shards(rows))


def test_stages_keep_the_columns_and_survive_odd_input(spark, sf, result):
    docs = table(spark, sf, "documents")
    assert result.columns == docs.columns + ["shard", "slot"] and 4 <= len(cp.STAGES) <= 5
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, 0), (1, "", None, None, 0),
                                 (2, "word " * 60000, "en", "s", 9)], docs.schema)
    for name, stage in cp.STAGES:
        for d in (odd, odd.limit(0)):
            out = stage(spark, d, sf)
            assert out.columns[:5] == docs.columns, name
            assert out.count() <= 2 * d.count()


def test_registered():
    q, sql = entry.queries(), entry.oracle_sql()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in q) == 1
    assert "pipeline" in q and "pipeline" not in sql and set(sql) <= set(q)
