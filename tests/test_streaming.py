"""files_two_batches: the same raw files once in batch, once in two streaming drops."""

import itertools

import pytest

from basketry.functions import calendar as cal
from basketry.operators import clean as cl
from basketry.operators import enrich as en
from basketry.plans.session import fresh_path
from basketry.sources import text as tx
from basketry.streaming import ingest as st

DROP_1 = ["2016-01-04|102|1|5 12 5 7", "2016-01-04|102|2|3 3", "2016-01-05|103|3|7 9"]
DROP_2 = ["2016-01-06|107|4|5 9 x", "2016-01-06|107|5|12"]


def _write(spark, path, lines, mode="overwrite"):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode(mode).text(path)


def _catalog(spark):
    pc = spark.createDataFrame([(5, 1), (12, 2), (7, 1)], "ID_Producto long, ID_Categoria int")
    cats = spark.createDataFrame([(1, "Frutas"), (2, "Lacteos")], "ID_Categoria int, Nombre_Categoria string")
    return pc, cats


def test_stream_equals_batch(spark):
    root = fresh_path(spark, "stream-fixture")
    pc, cats = _catalog(spark)
    _write(spark, f"{root}/in", DROP_1)
    st.ingest(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", pc, cats)
    _write(spark, f"{root}/in", DROP_2, mode="append")
    st.ingest(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", pc, cats)
    st.ingest(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", pc, cats)  # nothing new: no double count
    got = sorted(map(repr, spark.read.parquet(f"{root}/out").select(*st.SALES_COLUMNS).collect()))

    _write(spark, f"{root}/batch", DROP_1 + DROP_2)
    lines = cl.clean_lines(tx.read_transactions(spark, f"{root}/batch"))
    batch = cal.sales_calendar(en.enrich(lines, pc, cats)).select(*st.SALES_COLUMNS)
    assert got == sorted(map(repr, batch.collect()))
    assert len(got) == 11  # 8 units in drop 1, 3 in drop 2 ('x' is dropped)


def test_daily_merge_and_redelivery(spark):
    root = fresh_path(spark, "stream-fixture")
    _write(spark, f"{root}/in", DROP_1)
    st.merge_daily(spark, f"{root}/in", f"{root}/state", f"{root}/ckpt")
    _write(spark, f"{root}/in", DROP_2, mode="append")
    st.merge_daily(spark, f"{root}/in", f"{root}/state", f"{root}/ckpt")
    daily = {r.Fecha.isoformat(): (r.Total_Productos_Vendidos, r.Numero_Transacciones)
             for r in st.read_daily(spark, f"{root}/state").collect()}
    assert daily == {"2016-01-04": (6, 2), "2016-01-05": (2, 1), "2016-01-06": (3, 2)}

    # a re-delivered file: the dedup stream keeps one row per basket key
    _write(spark, f"{root}/dup", DROP_1)
    st.dedup_to(spark, f"{root}/dup", f"{root}/dedup", f"{root}/ckpt2")
    _write(spark, f"{root}/dup", DROP_1[:2], mode="append")
    st.dedup_to(spark, f"{root}/dup", f"{root}/dedup", f"{root}/ckpt2")
    kept = spark.read.parquet(f"{root}/dedup").select("ID_Transaccion").collect()
    assert sorted(r.ID_Transaccion for r in kept) == [1, 2, 3]


def test_split_basket_counts_once(spark):
    root = fresh_path(spark, "stream-split")
    items = spark.createDataFrame([(p, f"i{p}") for p in (5, 7, 12)], "ID_Producto long, Item string")
    for run, state in ((lambda: st.merge_daily(spark, f"{root}/in", f"{root}/d", f"{root}/c1"), "d"),
                       (lambda: st.merge_pairs(spark, f"{root}/in", f"{root}/p", f"{root}/c2", items), "p")):
        _write(spark, f"{root}/in", ["2016-01-04|102|1|5 12", "2016-01-04|103|1|5 7"])
        run()
        _write(spark, f"{root}/in", ["2016-01-04|102|1|7"], mode="append")  # the rest of basket (102, 1)
        run()
        if state == "d":
            got = st.read_daily(spark, f"{root}/d").first()
            assert (got.Total_Productos_Vendidos, got.Numero_Transacciones) == (5, 2)
            root = fresh_path(spark, "stream-split")
    pairs = {(r.Item_A, r.Item_B): r.Transacciones for r in st.read_pairs(spark, f"{root}/p", min_count=1).collect()}
    assert pairs == {("i12", "i5"): 1, ("i5", "i7"): 2, ("i12", "i7"): 1}


def test_dedup_keeps_late_first_deliveries_and_drops_old_repeats(spark):
    root = fresh_path(spark, "stream-late")
    drops = (["2016-08-01|1|1|5", "2016-01-01|1|2|5"],
             ["2016-02-01|1|3|5", "2016-01-01|1|2|5"],  # five months late and new; five months old and known
             ["2016-08-01|1|1|5", "2016-02-01|1|3|5", "2016-09-01|2|1|5", "2016-09-01|2|1|5"],
             # the second part of a basket stays, as does a basket under another date
             ["2016-08-01|1|1|7 9", "2016-09-02|1|2|5", "|1|4|5", "|1|4|5", "2016-08-01|1|1|7 9"])
    for drop in drops:
        _write(spark, f"{root}/in", drop, mode="append")
        st.dedup_to(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{root}/out").fillna("").collect())
    assert got == sorted({tuple(int(v) if i in (1, 2) else v for i, v in enumerate(x.split("|"))) for d in drops for x in d})


BASKETS = [(f"2016-0{1 + k % 3}-{1 + k % 5:02d}", 100 + k % 2, k % 11, " ".join(str(5 + (k * j) % 4) for j in range(1 + k % 4)))
           for k in range(60)]


def _daily_want(rows):
    units, baskets = {}, {}
    for day, store, t, text in rows:
        units[day] = units.get(day, 0) + len(text.split())
        baskets.setdefault(day, set()).add((store, t))
    return {d: (units[d], len(baskets[d])) for d in units}


def _daily(spark, state):
    return {r.Fecha.isoformat(): (r.Total_Productos_Vendidos, r.Numero_Transacciones)
            for r in st.read_daily(spark, state).collect()}


def test_daily_base_and_open_batches(spark, monkeypatch):
    """Many small batches with split baskets: compaction changes no figure and leaves few batches open."""
    monkeypatch.setattr(st, "KEY_RUNS", 2)
    root = fresh_path(spark, "stream-daily")
    for k in range(0, 60, 4):
        _write(spark, f"{root}/in", ["|".join(map(str, b)) for b in BASKETS[k:k + 4]], mode="append")
    st.merge_daily(spark, f"{root}/in", f"{root}/state", f"{root}/ckpt", compact_every=3, max_files=1)
    assert _daily(spark, f"{root}/state") == _daily_want(BASKETS)
    hwm, base = st.published(spark, f"{root}/state", "daily")
    assert hwm == 11 and sorted(st.open_batches(spark, f"{root}/state")) == [12, 13, 14]
    assert len(st._key_runs(spark, f"{root}/state", hwm)) <= 2
    st.compact_daily(spark, f"{root}/state", 14)
    assert _daily(spark, f"{root}/state") == _daily_want(BASKETS) and not st.open_batches(spark, f"{root}/state")


@pytest.mark.parametrize("step", ["before the pointer", "behind the pointer"])
def test_a_crash_in_a_compaction_counts_nothing_twice(spark, monkeypatch, step):
    root = fresh_path(spark, "stream-crash")
    for k in range(0, 60, 12):
        _write(spark, f"{root}/in", ["|".join(map(str, b)) for b in BASKETS[k:k + 12]], mode="append")
    st.merge_daily(spark, f"{root}/in", f"{root}/state", f"{root}/ckpt", compact_every=100, max_files=1)
    st.compact_daily(spark, f"{root}/state", 1)

    def crash(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(st.sinks, "write_stage", crash) if step == "before the pointer" else \
            m.setattr(st, "_sweep", lambda spark, d, n, upto: crash() if upto == 3 else None)
        with pytest.raises(RuntimeError):
            st.compact_daily(spark, f"{root}/state", 3)
    assert _daily(spark, f"{root}/state") == _daily_want(BASKETS)
    st.compact_daily(spark, f"{root}/state", 4)
    assert _daily(spark, f"{root}/state") == _daily_want(BASKETS) and not st.open_batches(spark, f"{root}/state")


def test_pairs_by_difference_touch_only_the_new_baskets(spark):
    root = fresh_path(spark, "stream-pairs")
    items = spark.createDataFrame([(p, f"i{p}") for p in range(5, 10)], "ID_Producto long, Item string")
    rows = [("2016-01-04", 1, t, f"{5 + t % 4} {5 + (t + 1) % 4}") for t in range(300)]
    more = [("2016-01-05", 1, t, "9 5") for t in (3, 77, 150)]  # 1 % of the baskets
    counts = {}
    for t in range(300):
        have = {f"i{p}" for _, _, u, text in rows + more if u == t for p in text.split()}
        for a, b in itertools.combinations(sorted(have), 2):
            counts[a, b] = counts.get((a, b), 0) + 1
    run = lambda: st.merge_pairs(spark, f"{root}/in", f"{root}/state", f"{root}/ckpt", items)
    _write(spark, f"{root}/in", ["|".join(map(str, r)) for r in rows])
    run()
    _write(spark, f"{root}/in", ["|".join(map(str, r)) for r in more], mode="append")
    q = run()
    touched = [p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["numInputRows"]]
    assert touched == [3]
    got = lambda: {(r.Item_A, r.Item_B): r.Transacciones for r in st.read_pairs(spark, f"{root}/state", 1).collect()}
    assert got() == counts
    st.compact_pairs(spark, f"{root}/state", 1)
    assert got() == counts and not st.open_batches(spark, f"{root}/state")
