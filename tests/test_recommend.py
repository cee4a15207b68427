"""Next items against trying every rule on every basket."""

import itertools
import random

import pytest

from basketry.operators import recommend as rc

RULE = "antecedent array<string>, consequent array<string>, confidence double, lift double, support double"


def brute(rules, baskets, n):
    out = []
    for b in baskets:
        items = set(b[2])
        hits = sorted((-lift, ",".join(a), ",".join(c), conf) for a, c, conf, lift, _ in rules
                      if set(a) <= items and not set(c) & items)[:n]
        out += [(b[0], b[1], i + 1, a, c, round(conf, 6), round(-nl, 6)) for i, (nl, a, c, conf) in enumerate(hits)]
    return sorted(out)


def planted(seed, multi):
    rng = random.Random(seed)
    items = [f"i{k:02d}" for k in range(14)]
    rules = []
    for size in (1, 2, 3):
        for a in itertools.combinations(items, size):
            for c in items:
                if c not in a and rng.random() < .35:
                    rules.append((list(a), [c], rng.random(), rng.choice([1.5, 2.0, 2.5, rng.random() * 3]), .1))
            if multi and rng.random() < .2:
                c = rng.sample([x for x in items if x not in a], 2)
                rules.append((list(a), sorted(c), rng.random(), 3 * rng.random(), .1))
    baskets = [(s, t, rng.sample(items, rng.randint(1, 12))) for s in (1, 2) for t in range(60)]
    baskets += [(3, t, ["i03", "i01", "i03"]) for t in range(200)] + [(4, 0, ["unknown"]), (4, 1, [])]
    return rules, baskets


@pytest.mark.parametrize("multi", [False, True])
@pytest.mark.parametrize("n", [1, 3, 10])
def test_equals_every_rule_on_every_basket(spark, n, multi, monkeypatch):
    monkeypatch.setattr(rc, "RUN", 2)
    rules, baskets = planted(n, multi)
    got = rc.next_items(spark.createDataFrame(rules, RULE),
                        spark.createDataFrame(baskets, "ID_Tienda int, ID_Transaccion long, items array<string>"), n)
    assert got.columns == ["ID_Tienda", "ID_Transaccion", "Posicion", "Antecedente_Str", "Consecuente_Str", "Confianza", "Lift"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rules, baskets, n)


def test_index_lists_are_bounded_by_the_largest_basket(spark):
    rules = [(["a"], [f"c{i:03d}"], .5, 1 + i / 100, .1) for i in range(200)]
    from pyspark.sql import functions as F
    index = rc.antecedent_index(spark.createDataFrame(rules, RULE), F.lit(7)).collect()
    assert len(index) == 1 and [r.Consecuente_Str for r in index[0].best] == [f"c{i:03d}" for i in range(199, 192, -1)]


def test_no_rules_and_no_baskets(spark):
    rules, baskets = planted(1, False)
    r, b = "antecedent array<string>", "ID_Tienda int, ID_Transaccion long, items array<string>"
    assert rc.next_items(spark.createDataFrame([], RULE), spark.createDataFrame(baskets, b)).count() == 0
    assert rc.next_items(spark.createDataFrame(rules, RULE), spark.createDataFrame([], b)).count() == 0


def brute_any(rules, baskets, n):
    """Rules with an antecedent item in the basket; baskets of equal keys are chosen for together, each is given."""
    out, items = [], {}
    for s, t, own in baskets:
        items.setdefault((s, t), set()).update(own)
    for s, t, own in baskets:
        if s is None or t is None:
            continue
        hits = sorted({(-lift, ",".join(sorted(a)), ",".join(sorted(c)), conf, sup) for a, c, conf, lift, sup in rules
                       if set(a) & items[s, t]})[:n]
        out += [(s, t, i + 1, a, c, round(conf, 6), round(-nl, 6), round(sup, 6), ",".join(sorted(own)))
                for i, (nl, a, c, conf, sup) in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize("n", [1, 3, 10])
def test_rules_of_any_item_equal_every_rule_on_every_basket(spark, n):
    rules, baskets = planted(n, True)
    baskets += [(None, 1, ["i01"]), (5, None, ["i02"]), (1, 0, ["i07", "i09"]), (6, 1, ["i04", None])]
    df = spark.createDataFrame(baskets, "ID_Tienda int, ID_Transaccion long, items array<string>")
    got = rc.for_baskets(spark.createDataFrame(rules, RULE), df, n)
    assert got.columns == ["ID_Tienda", "ID_Transaccion", "Posicion", "Antecedente_Str", "Consecuente_Str", "Confianza",
                           "Lift", "Soporte", "Historial"]
    assert dict(got.dtypes)["Posicion"] == "int"
    own = [(s, t, [x for x in items if x is not None]) for s, t, items in baskets]
    assert sorted(tuple(r) for r in got.collect()) == brute_any(rules, own, n)
