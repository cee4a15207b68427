"""Plan checks: no Python UDF nodes, no cartesian products, pushed filters,
invariants that must hold whatever the partitioning."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from basketry.plans.registry import all_queries
from basketry.operators import customers as cu
from basketry.operators import kpi
from basketry.plans.facts import sales

QUERIES = {n: q.fn for n, q in all_queries().items()}
# Queries that write files or run streams before returning (their plan is a scan).
PLAN_SKIP = set()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_or_cartesian(spark, sf, name):
    plan = _plan(QUERIES[name](spark, sf))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_slice_pushes_filters(spark, sf):
    s = kpi.slice_sales(sales(spark, sf), stores=[1, 2], start="1996-01-01", end="1996-12-31")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "ID_Tienda" in plan
    assert "PartitionFilters" in plan and "Anio" in plan


def test_store_units_sum_to_total(spark, sf):
    s = sales(spark, sf)
    total = s.count()
    assert cu.store_units(s).agg(F.sum("Unidades_Vendidas")).first()[0] == total
    bands = cu.rfm_bands(cu.rf_features(s))
    n = cu.basket_table(s).count()
    for dim in ("Recencia", "Frecuencia"):
        assert bands.where(F.col("Dimension") == dim).agg(F.sum("Num_Transacciones")).first()[0] == n


def test_result_independent_of_partitioning(spark, sf):
    s = sales(spark, sf)
    a = sorted(cu.purchase_gaps(cu.basket_table(s)).collect())
    b = sorted(cu.purchase_gaps(cu.basket_table(s.repartition(7))).collect())
    assert a == b


def test_explode_count_equals_tokens(spark, sf):
    from basketry.operators import clean as cl
    from basketry.sources import text as tx
    raw = tx.raw_transactions(sales(spark, sf).select("Fecha", "ID_Tienda", "ID_Transaccion", "ID_Producto"))
    tokens = raw.agg(F.sum(F.size(F.split("ID_Productos_Raw", " ")))).first()[0]
    assert cl.explode_units(raw).count() == tokens == sales(spark, sf).count()


def test_itemset_support_not_above_subsets(spark, sf):
    from basketry.plans import facts
    its, _ = facts.mined(spark, sf)
    rows = {tuple(r["items"]): r["freq"] for r in its.collect()}
    for items, f in rows.items():
        for i in range(len(items)):
            sub = items[:i] + items[i + 1:]
            if sub:
                assert rows[sub] >= f


def test_pareto_within_catalogue(spark, sf):
    from basketry.operators import products as pr
    r = pr.pareto(sales(spark, sf)).first()
    assert 0 <= r.Productos_Pareto <= r.Productos_Total
    by_store = pr.pareto(sales(spark, sf), keys=["ID_Tienda"]).collect()
    assert all(0 <= x.Productos_Pareto <= x.Productos_Total for x in by_store)


def test_same_results_without_automatic_broadcasts(spark, sf):
    """At 100 TB the size checks pick shuffle joins; the answers must not change."""
    from basketry.sources import tables as tb
    names = ["top_products_volume", "recommend_for_basket", "predict_next_items", "rules_full",
             "check_integrity", "cooccurrence_by_store", "seasonal_decompose", "store_summary"]
    before = {n: sorted(map(repr, QUERIES[n](spark, sf).collect())) for n in names}
    fact_before = sorted(map(repr, tb.sales_view(spark, sf).collect()))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plan = tb.sales_view(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert sorted(map(repr, tb.sales_view(spark, sf).collect())) == fact_before
        for n in names:
            assert sorted(map(repr, QUERIES[n](spark, sf).collect())) == before[n], n
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
