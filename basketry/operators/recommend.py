"""Recommendations from association rules (C6, G2, L1-L5, L6 via segment).

Rules are matched by item containment, never by substring (Q8: product 7
must not match 17 or 70).  Matching many baskets at once is an equi join on
one item, kept narrow before it happens: for L2 only the best n rules of each
antecedent item can be among a basket's best n; for L3 an antecedent, with its
consequents in order of lift, waits at its rarest item.  The best n of a basket come from a window per basket,
which Spark limits early in every task; no list of matches is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.labels import rnd
from basketry.operators.basket import _txt


def for_product(rules: DataFrame, product, n: int = 10) -> DataFrame:
    """L1: rules whose antecedent holds ``product``, best lift first (ties: text)."""
    hit = rules.where(F.array_contains("antecedent", F.lit(product)))
    return (hit.select(_txt("antecedent").alias("Antecedente_Str"), _txt("consequent").alias("Consecuente_Str"),
                       rnd("confidence", 6).alias("Confianza"), rnd("lift", 6).alias("Lift"),
                       rnd("support", 6).alias("Soporte"), F.col("lift").alias("_l"))
            .orderBy(F.col("_l").desc(), "Antecedente_Str", "Consecuente_Str").limit(n).drop("_l"))


def _order():
    return [F.col("lift").desc(), F.col("Antecedente_Str").asc(), F.col("Consecuente_Str").asc()]


def _texts(rules: DataFrame) -> DataFrame:
    return rules.withColumn("Antecedente_Str", _txt("antecedent")).withColumn("Consecuente_Str", _txt("consequent"))


def for_baskets(rules: DataFrame, baskets: DataFrame, n: int = 10, keys=("ID_Tienda", "ID_Transaccion")) -> DataFrame:
    """For every basket, the distinct rules with any antecedent item in it, top ``n`` by lift,
    beside the basket's own items (``Historial``).

    A rule among a basket's best ``n`` is also among the best ``n`` of the item
    that matched it, so only those are joined, one short list of ranks for each item of a basket; the rules'
    texts come behind the choice.  Ranks number the best rules of all items, which mining bounds: there are at
    most (mean basket) / (minimum support) items.  Baskets that are bucketed by a key are gathered without a shuffle.
    """
    keys = list(keys)
    per_item = Window.partitionBy("item").orderBy(*_order())
    best = _texts(rules).select("*", F.explode("antecedent").alias("item")) \
        .withColumn("_r", F.row_number().over(per_item)).where(F.col("_r") <= n) \
        .select("item", "Antecedente_Str", "Consecuente_Str", "confidence", "lift", "support") \
        .withColumn("_rank", F.dense_rank().over(Window.orderBy(*_order())))
    # a rule met through several items has one rank: dense_rank numbers the distinct rules
    ranks = best.groupBy("item").agg(F.collect_set("_rank").alias("_ranks"))
    # outer joins and the hint, which change no row: no side that is as long as the baskets can be taken for small and broadcast
    top = baskets.select(*keys, F.explode("items").alias("item")).join(ranks, "item", "left") \
        .groupBy(*keys).agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_ranks")))), 1, n).alias("_top"))
    history = baskets.select(*keys, _txt("items").alias("Historial"))
    chosen = top.hint("merge").join(history, keys).select(*keys, "Historial", F.posexplode("_top").alias("Posicion", "_rank")) \
        .withColumn("Posicion", F.col("Posicion") + 1)
    return chosen.join(best.dropDuplicates(["_rank"]), "_rank", "left").select(
        *keys, "Posicion", "Antecedente_Str", "Consecuente_Str", rnd("confidence", 6).alias("Confianza"),
        rnd("lift", 6).alias("Lift"), rnd("support", 6).alias("Soporte"), "Historial")


RUN = 1024  # consequents of two and more items, which have no bound per antecedent, go in runs of this length


def antecedent_index(rules: DataFrame, keep) -> DataFrame:
    """One row per antecedent with its consequents, best lift first: antecedent, Antecedente_Str, best.

    A basket that holds the antecedent blocks at most as many of its single-item consequents as it has
    other items.  So the first ``keep`` (n + the largest basket) of them hold the best n that any basket leaves
    open, and the list is bounded.  Longer consequents are all kept, in runs.
    """
    single = F.size("consequent") == 1
    w = Window.partitionBy("Antecedente_Str", "_single").orderBy(*_order())
    ranked = _texts(rules).withColumn("_single", single).withColumn("_r", F.row_number().over(w)) \
        .where(~F.col("_single") | (F.col("_r") <= keep))
    run = F.when(F.col("_single"), F.lit(-1)).otherwise(F.floor((F.col("_r") - 1) / RUN))
    entry = F.struct((-F.col("lift")).alias("_l"), "Consecuente_Str", "consequent", "confidence", "lift")
    return ranked.groupBy("Antecedente_Str", "antecedent", run.alias("_run")) \
        .agg(F.array_sort(F.collect_list(entry)).alias("best")).drop("_run")


def next_items(rules: DataFrame, baskets: DataFrame, n: int = 10, keys=("ID_Tienda", "ID_Transaccion")) -> DataFrame:
    """L3: rules whose whole antecedent is in the basket and whose consequent is not yet bought.

    Baskets of the same items get the same rules, so each set of items is looked at once.
    Rules are indexed by antecedent (``antecedent_index``); an antecedent can only fire in a set
    that holds its rarest item, so it is joined there and nowhere else, and its containment is checked once
    for all its rules.  Each antecedent gives a set at most its best ``n`` open consequents.
    """
    keys = list(keys)
    own = baskets.select(*keys, F.array_sort(F.array_distinct("items")).alias("items"))
    sets = own.groupBy("items").agg(F.count(F.lit(1)).alias("_c"))
    common = sets.select("_c", F.explode("items").alias("item")).groupBy("item").agg(F.sum("_c").alias("_c"))
    largest = F.coalesce(sets.agg(F.max(F.size("items"))).scalar(), F.lit(0))
    index = antecedent_index(rules, largest + F.lit(n))
    rare = index.select("Antecedente_Str", "antecedent").distinct() \
        .select("Antecedente_Str", F.explode("antecedent").alias("item")).join(common, "item") \
        .groupBy("Antecedente_Str").agg(F.min(F.struct("_c", "item")).alias("_rare")) \
        .select("Antecedente_Str", F.col("_rare.item").alias("item"))
    waiting = index.join(rare, "Antecedente_Str")
    fired = sets.select("items", F.explode("items").alias("item")).join(waiting, "item") \
        .where(F.size(F.array_except("antecedent", "items")) == 0) \
        .select("items", "Antecedente_Str", F.explode(F.slice(
            F.filter("best", lambda r: ~F.arrays_overlap(r["consequent"], F.col("items"))), 1, n)).alias("r")) \
        .select("items", "Antecedente_Str", "r.Consecuente_Str", "r.confidence", "r.lift")
    w = Window.partitionBy("items").orderBy(*_order())
    top = fired.withColumn("Posicion", F.row_number().over(w)).where(F.col("Posicion") <= n) \
        .groupBy("items").agg(F.collect_list(F.struct(  # n entries at most
            "Posicion", "Antecedente_Str", "Consecuente_Str", rnd("confidence", 6).alias("Confianza"),
            rnd("lift", 6).alias("Lift"))).alias("_top"))
    return own.join(top, "items").select(*keys, F.inline("_top"))


def hub_items(rules: DataFrame) -> DataFrame:
    """Per item, how often it is antecedent / consequent, mean support, confidence, lift."""
    a = rules.select(F.explode("antecedent").alias("Item"), F.lit(1).alias("ea"), F.lit(0).alias("ec"),
                     "support", "confidence", "lift")
    c = rules.select(F.explode("consequent").alias("Item"), F.lit(0).alias("ea"), F.lit(1).alias("ec"),
                     "support", "confidence", "lift")
    return a.unionByName(c).groupBy("Item").agg(
        F.sum("ea").cast("long").alias("Como_Antecedente"), F.sum("ec").cast("long").alias("Como_Consecuente"),
        F.count(F.lit(1)).alias("Reglas"),
        rnd(F.avg("support"), 6).alias("Soporte_Medio"), rnd(F.avg("confidence"), 6).alias("Confianza_Media"),
        rnd(F.avg("lift"), 6).alias("Lift_Medio"))
