"""Registered basket-mining and recommendation queries.

Items are part brands, and part types where larger itemsets are wanted;
baskets hold at least two distinct items.  The oracle SQL counts brand
itemsets of size 1-3 by self-joins (no FP-Growth) and enumerates the splits
explicitly.  There are six part types, so the type oracle lists all 63
possible itemsets as bit masks and counts the baskets that hold each: no
length limit on either side.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions.labels import rnd
from basketry.operators import basket as bk
from basketry.operators import recommend as rc
from basketry.plans import facts
from basketry.plans.registry import register, with_sales

SUP, CONF = facts.MINING_MIN_SUPPORT, facts.MINING_MIN_CONFIDENCE
TOP_ITEMSETS, TOP_RULES = 100, 50
FILTER_CONF, FILTER_LIFT = 0.05, 1.0
PAIR_TOP, PAIR_TOP_STORE = 100, 10
PAIR_MIN, PAIR_MIN_STORE = 10, 3  # baskets a pair has to be in
SAMPLE_MODULO = 10
TOP_ITEMS = 10
RECOMMEND_PRODUCT = "Brand#13"
RECOMMEND_N = 10
LIFT_BINS = 50

_SAME = "{x}.ID_Tienda = {y}.ID_Tienda AND {x}.ID_Transaccion = {y}.ID_Transaccion"
_MINING_CTES = (
    """bi AS (SELECT DISTINCT s.ID_Tienda, s.ID_Transaccion, p.p_brand AS item
           FROM sales s JOIN part p ON s.ID_Producto = p.p_partkey)""",
    "bsz AS (SELECT ID_Tienda, ID_Transaccion FROM bi GROUP BY 1, 2 HAVING count(*) >= 2)",
    "bb AS (SELECT bi.* FROM bi JOIN bsz USING (ID_Tienda, ID_Transaccion))",
    f"mc AS (SELECT CAST(ceil({SUP} * count(*)) AS BIGINT) AS m, count(*) AS N FROM bsz)",
    "i1 AS (SELECT item AS a, count(*) AS f FROM bb GROUP BY 1 HAVING count(*) >= (SELECT m FROM mc))",
    "bf AS (SELECT * FROM bb WHERE item IN (SELECT a FROM i1))",
    f"""i2 AS (SELECT x.item AS a, y.item AS b, count(*) AS f FROM bf x JOIN bf y ON {_SAME.format(x='x', y='y')}
           AND x.item < y.item GROUP BY 1, 2 HAVING count(*) >= (SELECT m FROM mc))""",
    f"""i3 AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS f FROM bf x
           JOIN bf y ON {_SAME.format(x='x', y='y')} AND x.item < y.item
           JOIN bf z ON {_SAME.format(x='y', y='z')} AND y.item < z.item
           GROUP BY 1, 2, 3 HAVING count(*) >= (SELECT m FROM mc))""",
    """its AS (SELECT a AS Productos, 1 AS Longitud, f FROM i1 UNION ALL SELECT a || ',' || b, 2, f FROM i2
           UNION ALL SELECT a || ',' || b || ',' || c, 3, f FROM i3)""",
    """sp AS (SELECT a AS ant, b AS cons, f FROM i2 UNION ALL SELECT b, a, f FROM i2
           UNION ALL SELECT a, b || ',' || c, f FROM i3 UNION ALL SELECT b, a || ',' || c, f FROM i3
           UNION ALL SELECT c, a || ',' || b, f FROM i3 UNION ALL SELECT a || ',' || b, c, f FROM i3
           UNION ALL SELECT a || ',' || c, b, f FROM i3 UNION ALL SELECT b || ',' || c, a, f FROM i3)""",
    """rr AS (SELECT sp.ant, sp.cons, CAST(sp.f AS DOUBLE) / mc.N AS sup, CAST(sp.f AS DOUBLE) / fa.f AS conf,
           CAST(fa.f AS DOUBLE) / mc.N AS sa, CAST(fc.f AS DOUBLE) / mc.N AS sc, fa.Longitud AS la, fc.Longitud AS lc
           FROM sp JOIN its fa ON fa.Productos = sp.ant JOIN its fc ON fc.Productos = sp.cons, mc)""",
    f"""rules AS (SELECT ant AS Antecedente_Str, cons AS Consecuente_Str, conf, conf / sc AS lift, sup
           FROM rr WHERE lc = 1 AND conf >= {CONF})""",
)


def _mining_sql(*ctes: str, select: str) -> str:
    return with_sales(*_MINING_CTES, *ctes, select=select)


_RULES_SELECT = """SELECT Antecedente_Str, Consecuente_Str, round(conf, 6) AS Confianza, round(lift, 6) AS Lift,
       round(sup, 6) AS Soporte FROM rules"""
_FULL_SELECT = """SELECT ant AS Antecedente_Str, cons AS Consecuente_Str, la AS Long_Antecedente, lc AS Long_Consecuente,
       round(sa, 6) AS Soporte_Antecedente, round(sc, 6) AS Soporte_Consecuente, round(sup, 6) AS Soporte,
       round(conf, 6) AS Confianza, round(conf / sc, 6) AS Lift, round(sup - sa * sc, 6) AS Leverage,
       round(CASE WHEN conf < 1 THEN (1 - sc) / (1 - conf) END, 6) AS Conviction FROM rr WHERE conf / sc >= 1.0"""
_ITEMSETS_SELECT = """SELECT Productos, Longitud, f AS Frecuencia, round(CAST(f AS DOUBLE) / (SELECT N FROM mc), 6)
       AS Soporte FROM its"""


def _n(spark, sf):
    return facts.n_mining_baskets(spark, sf)


@register("baskets", _mining_sql(select="""
SELECT ID_Tienda, ID_Transaccion, string_agg(item, ',' ORDER BY item) AS Items, CAST(count(*) AS INTEGER) AS Num_Items
FROM bb GROUP BY 1, 2"""), "K1 D26 B12")
def baskets(spark, sf):
    b = facts.mining_baskets(spark, sf)
    return b.select("ID_Tienda", "ID_Transaccion", bk._txt("items").alias("Items"), F.size("items").alias("Num_Items"))


@register("baskets_topn", with_sales(
    """bi AS (SELECT DISTINCT s.ID_Tienda, s.ID_Transaccion, p.p_brand AS item
           FROM sales s JOIN part p ON s.ID_Producto = p.p_partkey)""",
    f"top AS (SELECT item FROM bi GROUP BY item ORDER BY count(*) DESC, item LIMIT {TOP_ITEMS})",
    select="""SELECT ID_Tienda, ID_Transaccion, string_agg(item, ',' ORDER BY item) AS Items,
       CAST(count(*) AS INTEGER) AS Num_Items FROM bi WHERE item IN (SELECT item FROM top)
       GROUP BY 1, 2 HAVING count(*) >= 2"""), "B14")
def baskets_topn(spark, sf):
    lines = bk.keep_top_items(facts.item_lines(spark, sf), TOP_ITEMS)
    b = bk.baskets(lines, "Item", min_size=2)
    return b.select("ID_Tienda", "ID_Transaccion", bk._txt("items").alias("Items"), F.size("items").alias("Num_Items"))


@register("sample_baskets", _mining_sql(select=f"""
SELECT ID_Tienda, ID_Transaccion, string_agg(item, ',' ORDER BY item) AS Items FROM bb
WHERE ID_Transaccion % {SAMPLE_MODULO} = 0 GROUP BY 1, 2"""), "B13")
def sample_baskets(spark, sf):
    """The sample is the feature: every tenth transaction number."""
    s = bk.sample_baskets(facts.mining_baskets(spark, sf), modulo=SAMPLE_MODULO)
    return s.select("ID_Tienda", "ID_Transaccion", bk._txt("items").alias("Items"))


@register("itemsets", _mining_sql(select=_ITEMSETS_SELECT), "K2 K3")
def itemsets(spark, sf):
    its, _ = facts.mined(spark, sf)
    return bk.itemsets_report(its, _n(spark, sf))


@register("top_itemsets", _mining_sql(select=_ITEMSETS_SELECT + f" ORDER BY f DESC, Productos LIMIT {TOP_ITEMSETS}"),
          "F3")
def top_itemsets(spark, sf):
    its, _ = facts.mined(spark, sf)
    return bk.itemsets_report(bk.top_itemsets(its, TOP_ITEMSETS), _n(spark, sf))


@register("rules", _mining_sql(select=_RULES_SELECT), "K4")
def rules(spark, sf):
    _, r = facts.mined(spark, sf)
    return bk.rules_report(r)


@register("top_rules", _mining_sql(select=_RULES_SELECT + f"""
ORDER BY lift DESC, Antecedente_Str, Consecuente_Str LIMIT {TOP_RULES}"""), "L4 F3")
def top_rules(spark, sf):
    _, r = facts.mined(spark, sf)
    return bk.rules_report(bk.top_rules(r, TOP_RULES))


@register("rules_full", _mining_sql(select=_FULL_SELECT), "K5 C7")
def rules_full(spark, sf):
    its, _ = facts.mined(spark, sf)
    return bk.rules_full(its, _n(spark, sf), min_lift=1.0)


@register("rules_filtered", _mining_sql(f"rfull AS ({_FULL_SELECT})", select=f"""
SELECT * FROM rfull WHERE Confianza > {FILTER_CONF} AND Lift > {FILTER_LIFT}"""), "K6")
def rules_filtered(spark, sf):
    its, _ = facts.mined(spark, sf)
    full = bk.rules_full(its, _n(spark, sf), min_lift=1.0)
    return bk.filter_rules(full, FILTER_CONF, FILTER_LIFT)


@register("itemsets_by_length", _mining_sql(
    f"rep AS ({_ITEMSETS_SELECT})",
    """rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY Longitud ORDER BY Frecuencia DESC, Productos) AS INTEGER)
           AS Posicion FROM rep WHERE Longitud IN (2, 3))""",
    select="""SELECT 'conteo' AS Tipo, Longitud, CAST(NULL AS INTEGER) AS Posicion, CAST(NULL AS VARCHAR) AS Productos,
       count(*) AS Valor FROM rep GROUP BY Longitud
UNION ALL SELECT 'top', Longitud, Posicion, Productos, Frecuencia FROM rk
  WHERE (Longitud = 2 AND Posicion <= 15) OR (Longitud = 3 AND Posicion <= 10)"""), "K7")
def itemsets_by_length(spark, sf):
    its, _ = facts.mined(spark, sf)
    return bk.by_length(bk.itemsets_report(its, _n(spark, sf)))


@register("lift_distribution", _mining_sql(f"rep AS ({_RULES_SELECT})", select="""
SELECT count(*) AS Reglas, round(avg(Lift), 6) AS Lift_Media, round(quantile_cont(Lift, 0.5), 6) AS Lift_Mediana,
       min(Lift) AS Lift_Min, max(Lift) AS Lift_Max, round(quantile_cont(Confianza, 0.25), 6) AS Confianza_P25,
       round(quantile_cont(Confianza, 0.75), 6) AS Confianza_P75 FROM rep"""), "K8")
def lift_distribution(spark, sf):
    _, r = facts.mined(spark, sf)
    stats, _hist = bk.lift_distribution(bk.rules_report(r), LIFT_BINS)
    return stats


@register("lift_histogram", _mining_sql(
    f"rep AS ({_RULES_SELECT})",
    "mm AS (SELECT CAST(min(Lift) AS DOUBLE) AS lo, CAST(max(Lift) AS DOUBLE) AS hi FROM rep)",
    select=f"""SELECT Bin, round(lo + Bin * (CASE WHEN hi = lo THEN 0.0 ELSE (hi - lo) / {LIFT_BINS} END), 6) AS Desde,
       round(lo + (Bin + 1) * (CASE WHEN hi = lo THEN 0.0 ELSE (hi - lo) / {LIFT_BINS} END), 6) AS Hasta,
       count(*) AS Frecuencia
FROM (SELECT CAST(least(CASE WHEN hi = lo THEN 0 ELSE floor((Lift - lo) / ((hi - lo) / {LIFT_BINS})) END,
                        {LIFT_BINS - 1}) AS INTEGER) AS Bin, lo, hi FROM rep, mm) x GROUP BY Bin, lo, hi"""), "K8 H14")
def lift_histogram(spark, sf):
    _, r = facts.mined(spark, sf)
    _stats, hist = bk.lift_distribution(bk.rules_report(r), LIFT_BINS)
    return hist


@register("cooccurrence", _mining_sql(select=f"""
SELECT x.item AS Item_A, y.item AS Item_B, count(*) AS Transacciones FROM bb x JOIN bb y
  ON {_SAME.format(x='x', y='y')} AND x.item < y.item GROUP BY 1, 2
HAVING count(*) >= {PAIR_MIN} ORDER BY Transacciones DESC, Item_A, Item_B LIMIT {PAIR_TOP}"""), "K10")
def cooccurrence(spark, sf):
    return bk.cooccurrence(facts.mining_baskets(spark, sf), min_count=PAIR_MIN, n=PAIR_TOP)


@register("cooccurrence_by_store", _mining_sql(
    f"""pc AS (SELECT x.ID_Tienda, x.item AS Item_A, y.item AS Item_B, count(*) AS Transacciones FROM bb x JOIN bb y
          ON {_SAME.format(x='x', y='y')} AND x.item < y.item GROUP BY 1, 2, 3
          HAVING count(*) >= {PAIR_MIN_STORE})""",
    select=f"""SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ID_Tienda ORDER BY Transacciones DESC,
       Item_A, Item_B) AS INTEGER) AS Posicion FROM pc) x WHERE Posicion <= {PAIR_TOP_STORE}"""), "K11")
def cooccurrence_by_store(spark, sf):
    return bk.cooccurrence(facts.mining_baskets(spark, sf), min_count=PAIR_MIN_STORE, n=PAIR_TOP_STORE, keys=["ID_Tienda"])


@register("recommend_for_product", _mining_sql(select=f"""
SELECT Antecedente_Str, Consecuente_Str, round(conf, 6) AS Confianza, round(lift, 6) AS Lift, round(sup, 6) AS Soporte
FROM rules WHERE list_contains(string_split(Antecedente_Str, ','), '{RECOMMEND_PRODUCT}')
ORDER BY lift DESC, Antecedente_Str, Consecuente_Str LIMIT {RECOMMEND_N}"""), "L1 C6")
def recommend_for_product(spark, sf):
    _, r = facts.mined(spark, sf)
    return rc.for_product(r, RECOMMEND_PRODUCT, RECOMMEND_N)


@register("recommend_for_basket", _mining_sql(
    """ri AS (SELECT DISTINCT Antecedente_Str, Consecuente_Str, conf, lift, sup,
           unnest(string_split(Antecedente_Str, ',')) AS item FROM rules)""",
    """hits AS (SELECT DISTINCT bb.ID_Tienda, bb.ID_Transaccion, ri.Antecedente_Str, ri.Consecuente_Str, ri.conf,
           ri.lift, ri.sup FROM bb JOIN ri ON bb.item = ri.item)""",
    "hist AS (SELECT ID_Tienda, ID_Transaccion, string_agg(item, ',' ORDER BY item) AS Historial FROM bb GROUP BY 1, 2)",
    select=f"""SELECT ID_Tienda, ID_Transaccion, Posicion, Antecedente_Str, Consecuente_Str, round(conf, 6) AS Confianza,
       round(lift, 6) AS Lift, round(sup, 6) AS Soporte, Historial FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ID_Tienda,
       ID_Transaccion ORDER BY lift DESC, Antecedente_Str, Consecuente_Str) AS INTEGER) AS Posicion FROM hits) x JOIN hist USING (ID_Tienda, ID_Transaccion)
WHERE Posicion <= {RECOMMEND_N}"""), "L2 C6 G2")
def recommend_for_basket(spark, sf):
    _, r = facts.mined(spark, sf)
    return rc.for_baskets(r, facts.mining_baskets(spark, sf), RECOMMEND_N)


@register("predict_next_items", _mining_sql(
    """ri AS (SELECT Antecedente_Str, Consecuente_Str, conf, lift, len(string_split(Antecedente_Str, ',')) AS na,
           unnest(string_split(Antecedente_Str, ',')) AS item FROM rules)""",
    """m AS (SELECT bb.ID_Tienda, bb.ID_Transaccion, ri.Antecedente_Str, ri.Consecuente_Str, ri.conf, ri.lift
           FROM bb JOIN ri ON bb.item = ri.item
           GROUP BY ALL HAVING count(*) = max(ri.na))""",
    """fresh AS (SELECT m.* FROM m WHERE NOT EXISTS (SELECT 1 FROM bb WHERE bb.ID_Tienda = m.ID_Tienda
           AND bb.ID_Transaccion = m.ID_Transaccion
           AND list_contains(string_split(m.Consecuente_Str, ','), bb.item)))""",
    select=f"""SELECT ID_Tienda, ID_Transaccion, Posicion, Antecedente_Str, Consecuente_Str, round(conf, 6) AS Confianza,
       round(lift, 6) AS Lift FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ID_Tienda, ID_Transaccion
       ORDER BY lift DESC, Antecedente_Str, Consecuente_Str) AS INTEGER) AS Posicion FROM fresh) x
WHERE Posicion <= {RECOMMEND_N}"""), "L3")
def predict_next_items(spark, sf):
    _, r = facts.mined(spark, sf)
    return rc.next_items(r, facts.mining_baskets(spark, sf), RECOMMEND_N)


@register("hub_items", _mining_sql(
    """u AS (SELECT unnest(string_split(Antecedente_Str, ',')) AS Item, 1 AS ea, 0 AS ec, sup, conf, lift FROM rules
           UNION ALL SELECT unnest(string_split(Consecuente_Str, ',')), 0, 1, sup, conf, lift FROM rules)""",
    select="""SELECT Item, CAST(sum(ea) AS BIGINT) AS Como_Antecedente, CAST(sum(ec) AS BIGINT) AS Como_Consecuente,
       count(*) AS Reglas, round(avg(sup), 6) AS Soporte_Medio, round(avg(conf), 6) AS Confianza_Media,
       round(avg(lift), 6) AS Lift_Medio FROM u GROUP BY Item"""), "L5")
def hub_items(spark, sf):
    _, r = facts.mined(spark, sf)
    return rc.hub_items(r)


_STORE_CTES = (
    """bi AS (SELECT DISTINCT s.ID_Tienda, s.ID_Transaccion, p.p_brand AS item
           FROM sales s JOIN part p ON s.ID_Producto = p.p_partkey)""",
    "bsz AS (SELECT ID_Tienda, ID_Transaccion FROM bi GROUP BY 1, 2 HAVING count(*) >= 2)",
    "bb AS (SELECT bi.* FROM bi JOIN bsz USING (ID_Tienda, ID_Transaccion))",
    f"""mk AS (SELECT ID_Tienda, count(*) AS N, greatest(CAST(ceil({SUP} * count(*)) AS BIGINT), {facts.STORE_MIN_COUNT}) AS m
           FROM bsz GROUP BY ID_Tienda)""",
    """s1 AS (SELECT ID_Tienda, a, f FROM (SELECT ID_Tienda, item AS a, count(*) AS f FROM bb GROUP BY 1, 2) t
           JOIN mk USING (ID_Tienda) WHERE f >= m)""",
    f"""s2 AS (SELECT ID_Tienda, a, b, f FROM (SELECT x.ID_Tienda, x.item AS a, y.item AS b, count(*) AS f FROM bb x JOIN bb y
           ON {_SAME.format(x='x', y='y')} AND x.item < y.item GROUP BY 1, 2, 3) t JOIN mk USING (ID_Tienda) WHERE f >= m)""",
    f"""s3 AS (SELECT ID_Tienda, a, b, c, f FROM (SELECT x.ID_Tienda, x.item AS a, y.item AS b, z.item AS c, count(*) AS f
           FROM bb x JOIN bb y ON {_SAME.format(x='x', y='y')} AND x.item < y.item
           JOIN bb z ON {_SAME.format(x='y', y='z')} AND y.item < z.item GROUP BY 1, 2, 3, 4) t
           JOIN mk USING (ID_Tienda) WHERE f >= m)""",
    f"""s4 AS (SELECT ID_Tienda, a, b, c, d, f FROM (SELECT x.ID_Tienda, s3.a, s3.b, s3.c, w.item AS d, count(*) AS f
           FROM s3 JOIN bb x ON x.ID_Tienda = s3.ID_Tienda AND x.item = s3.a
           JOIN bb y ON {_SAME.format(x='x', y='y')} AND y.item = s3.b JOIN bb z ON {_SAME.format(x='y', y='z')} AND z.item = s3.c
           JOIN bb w ON {_SAME.format(x='z', y='w')} AND w.item > s3.c GROUP BY 1, 2, 3, 4, 5) t
           JOIN mk USING (ID_Tienda) WHERE f >= m)""",
    """sits AS (SELECT t.ID_Tienda, t.Productos, t.Longitud, t.f, mk.N FROM (
             SELECT ID_Tienda, a AS Productos, 1 AS Longitud, f FROM s1
             UNION ALL SELECT ID_Tienda, a || ',' || b, 2, f FROM s2
             UNION ALL SELECT ID_Tienda, a || ',' || b || ',' || c, 3, f FROM s3
             UNION ALL SELECT ID_Tienda, a || ',' || b || ',' || c || ',' || d, 4, f FROM s4) t JOIN mk USING (ID_Tienda))""",
    """ssp AS (SELECT ID_Tienda, a AS ant, b AS cons, f FROM s2 UNION ALL SELECT ID_Tienda, b, a, f FROM s2
           UNION ALL SELECT ID_Tienda, a || ',' || b, c, f FROM s3 UNION ALL SELECT ID_Tienda, a || ',' || c, b, f FROM s3
           UNION ALL SELECT ID_Tienda, b || ',' || c, a, f FROM s3
           UNION ALL SELECT ID_Tienda, a || ',' || b || ',' || c, d, f FROM s4
           UNION ALL SELECT ID_Tienda, a || ',' || b || ',' || d, c, f FROM s4
           UNION ALL SELECT ID_Tienda, a || ',' || c || ',' || d, b, f FROM s4
           UNION ALL SELECT ID_Tienda, b || ',' || c || ',' || d, a, f FROM s4)""",
    f"""srules AS (SELECT ssp.ID_Tienda, ssp.ant, ssp.cons, CAST(ssp.f AS DOUBLE) / fa.f AS conf,
           CAST(ssp.f AS DOUBLE) / fa.f / (CAST(fc.f AS DOUBLE) / fa.N) AS lift, CAST(ssp.f AS DOUBLE) / fa.N AS sup
           FROM ssp JOIN sits fa ON fa.ID_Tienda = ssp.ID_Tienda AND fa.Productos = ssp.ant
           JOIN sits fc ON fc.ID_Tienda = ssp.ID_Tienda AND fc.Productos = ssp.cons
           WHERE CAST(ssp.f AS DOUBLE) / fa.f >= {CONF})""",
)


def _store_mined(spark, sf):
    return facts.mined_by(spark, sf, "ID_Tienda")


@register("itemsets_by_store", with_sales(*_STORE_CTES, select="""
SELECT ID_Tienda, Productos, Longitud, f AS Frecuencia, round(CAST(f AS DOUBLE) / N, 6) AS Soporte FROM sits"""), "K11")
def itemsets_by_store(spark, sf):
    its, _ = _store_mined(spark, sf)
    return its.select("ID_Tienda", bk._txt("items").alias("Productos"), F.size("items").alias("Longitud"),
                      F.col("freq").alias("Frecuencia"), rnd("support", 6).alias("Soporte"))


@register("rules_by_store", with_sales(*_STORE_CTES, select="""
SELECT ID_Tienda, ant AS Antecedente_Str, cons AS Consecuente_Str, round(conf, 6) AS Confianza, round(lift, 6) AS Lift,
       round(sup, 6) AS Soporte FROM srules"""), "K11")
def rules_by_store(spark, sf):
    _, rules = _store_mined(spark, sf)
    return rules.select("ID_Tienda", bk._txt("antecedent").alias("Antecedente_Str"),
                        bk._txt("consequent").alias("Consecuente_Str"), rnd("confidence", 6).alias("Confianza"),
                        rnd("lift", 6).alias("Lift"), rnd("support", 6).alias("Soporte"))


# ------------------------------------------------------------------ part types
# Six types: a basket is a bit mask over the types in text order, an itemset one of 63 masks.
_TYPE_CTES = (
    "ty AS (SELECT p_type AS item, row_number() OVER (ORDER BY p_type) - 1 AS i FROM (SELECT DISTINCT p_type FROM part) x)",
    """tb AS (SELECT ID_Tienda, ID_Transaccion, CAST(sum(1 << CAST(i AS INTEGER)) AS BIGINT) AS bm FROM (
           SELECT DISTINCT s.ID_Tienda, s.ID_Transaccion, ty.i FROM sales s JOIN part p ON s.ID_Producto = p.p_partkey
           JOIN ty ON ty.item = p.p_type) x GROUP BY 1, 2 HAVING count(*) >= 2)""",
    "tm AS (SELECT bm, count(*) AS k FROM tb GROUP BY bm)",
    f"tc AS (SELECT count(*) AS N, CAST(ceil({SUP} * count(*)) AS BIGINT) AS m FROM tb)",
    "masks AS (SELECT CAST(r AS BIGINT) AS mask FROM range(1, (SELECT 1 << CAST(count(*) AS INTEGER) FROM ty)) t(r))",
    """fi AS (SELECT mask, CAST(sum(k) AS BIGINT) AS f, CAST(bit_count(mask) AS INTEGER) AS len FROM masks
           JOIN tm ON bm & mask = mask GROUP BY mask HAVING sum(k) >= (SELECT m FROM tc))""",
    """nm AS (SELECT mask, string_agg(item, ',' ORDER BY item) AS txt FROM masks
           JOIN ty ON (mask >> CAST(i AS INTEGER)) & 1 = 1 GROUP BY mask)""",
    """tr AS (SELECT a.mask AS am, c.mask AS cm, na.txt AS ant, nc.txt AS cons, a.len AS la, c.len AS lc,
           CAST(w.f AS DOUBLE) / tc.N AS sup, CAST(w.f AS DOUBLE) / a.f AS conf, CAST(a.f AS DOUBLE) / tc.N AS sa,
           CAST(c.f AS DOUBLE) / tc.N AS sc
           FROM fi a JOIN fi c ON a.mask & c.mask = 0 JOIN fi w ON w.mask = a.mask | c.mask
           JOIN nm na ON na.mask = a.mask JOIN nm nc ON nc.mask = c.mask, tc)""",
    f"trules AS (SELECT ant, cons, am, cm, conf, conf / sc AS lift, sup FROM tr WHERE lc = 1 AND conf >= {CONF})",
)


def _type_sql(*ctes: str, select: str) -> str:
    return with_sales(*_TYPE_CTES, *ctes, select=select)


_TYPE_ITEMSETS = """SELECT txt AS Productos, len AS Longitud, f AS Frecuencia,
       round(CAST(f AS DOUBLE) / (SELECT N FROM tc), 6) AS Soporte FROM fi JOIN nm USING (mask)"""


@register("itemsets_by_type", _type_sql(select=_TYPE_ITEMSETS), "K2 K3")
def itemsets_by_type(spark, sf):
    its, _ = facts.mined(spark, sf, facts.MINING_TYPE)
    return bk.itemsets_report(its, facts.n_mining_baskets(spark, sf, facts.MINING_TYPE))


@register("itemsets_by_type_length", _type_sql(
    f"rep AS ({_TYPE_ITEMSETS})",
    """rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY Longitud ORDER BY Frecuencia DESC, Productos) AS INTEGER)
           AS Posicion FROM rep WHERE Longitud IN (2, 3))""",
    select="""SELECT 'conteo' AS Tipo, Longitud, CAST(NULL AS INTEGER) AS Posicion, CAST(NULL AS VARCHAR) AS Productos,
       count(*) AS Valor FROM rep GROUP BY Longitud
UNION ALL SELECT 'top', Longitud, Posicion, Productos, Frecuencia FROM rk
  WHERE (Longitud = 2 AND Posicion <= 15) OR (Longitud = 3 AND Posicion <= 10)"""), "K7")
def itemsets_by_type_length(spark, sf):
    its, _ = facts.mined(spark, sf, facts.MINING_TYPE)
    return bk.by_length(bk.itemsets_report(its, facts.n_mining_baskets(spark, sf, facts.MINING_TYPE)))


@register("rules_by_type", _type_sql(select="""SELECT ant AS Antecedente_Str, cons AS Consecuente_Str,
       round(conf, 6) AS Confianza, round(lift, 6) AS Lift, round(sup, 6) AS Soporte FROM trules"""), "K4")
def rules_by_type(spark, sf):
    return bk.rules_report(facts.mined(spark, sf, facts.MINING_TYPE)[1])


@register("rules_full_by_type", _type_sql(select="""SELECT ant AS Antecedente_Str, cons AS Consecuente_Str,
       la AS Long_Antecedente, lc AS Long_Consecuente, round(sa, 6) AS Soporte_Antecedente,
       round(sc, 6) AS Soporte_Consecuente, round(sup, 6) AS Soporte, round(conf, 6) AS Confianza,
       round(conf / sc, 6) AS Lift, round(sup - sa * sc, 6) AS Leverage,
       round(CASE WHEN conf < 1 THEN (1 - sc) / (1 - conf) END, 6) AS Conviction FROM tr"""), "K5 C7")
def rules_full_by_type(spark, sf):
    its, _ = facts.mined(spark, sf, facts.MINING_TYPE)
    return bk.rules_full(its, facts.n_mining_baskets(spark, sf, facts.MINING_TYPE), min_lift=None)


@register("predict_next_types", _type_sql(
    """fired AS (SELECT tb.ID_Tienda, tb.ID_Transaccion, r.* FROM tb JOIN trules r ON tb.bm & r.am = r.am
           AND tb.bm & r.cm = 0)""",
    select=f"""SELECT ID_Tienda, ID_Transaccion, Posicion, ant AS Antecedente_Str, cons AS Consecuente_Str,
       round(conf, 6) AS Confianza, round(lift, 6) AS Lift FROM (SELECT *, CAST(row_number() OVER (
       PARTITION BY ID_Tienda, ID_Transaccion ORDER BY lift DESC, ant, cons) AS INTEGER) AS Posicion FROM fired) x
WHERE Posicion <= {RECOMMEND_N}"""), "L3")
def predict_next_types(spark, sf):
    _, r = facts.mined(spark, sf, facts.MINING_TYPE)
    return rc.next_items(r, facts.mining_baskets(spark, sf, facts.MINING_TYPE), RECOMMEND_N)
