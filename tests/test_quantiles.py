"""Exact quantiles by selection against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import profile as pf
from basketry.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)


def groups(seed):
    rng = random.Random(seed)
    wide = [("wide", rng.gauss(0, 1e6)) for _ in range(5000)]  # as many distinct values as rows
    flat = [("flat", float(rng.randint(0, 3))) for _ in range(2000)]
    return wide + flat + [("one", 7.5), (None, 1.0), (None, 2.0), ("nulls", None), ("wide", None)]


def test_equals_numpy(spark):
    rows = groups(1)
    got = {r.g: [r[f"q{i}"] for i in range(len(PROBS))] for r in
           exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", PROBS, ["g"]).collect()}
    assert set(got) == {"wide", "flat", "one", None}
    for g, q in got.items():
        assert q == pytest.approx(list(np.quantile([v for h, v in rows if h == g and v is not None], PROBS)), rel=1e-12)


def test_one_group_and_none(spark):
    df = spark.createDataFrame(groups(2), "g string, v double")
    r = exact_quantiles(df, "v", (0.5,)).collect()
    assert len(r) == 1 and r[0].q0 == pytest.approx(np.median([v for _, v in groups(2) if v is not None]))
    assert exact_quantiles(df.where("false"), "v", (0.5,), ["g"]).count() == 0


def test_no_task_holds_a_whole_wide_column(spark):
    df = spark.range(20_000).select(F.rand(3).alias("v"))
    plan = exact_quantiles(df, "v", (0.5,))._jdf.queryExecution().toString()
    assert "percentile" not in plan
    described = pf.describe(df, ["v"])
    assert "percentile" not in described._jdf.queryExecution().toString()
    v = [r.v for r in df.collect()]
    r = described.first()
    assert [r.P25, r.P50, r.P75] == pytest.approx(np.quantile(v, [.25, .5, .75]).round(6).tolist(), abs=1e-6)


def test_boxplot_of_an_empty_table(spark):
    r = pf.boxplot(spark.createDataFrame([], "v double"), "v").first()
    assert r.Total == 0 and r.Q1 is None
