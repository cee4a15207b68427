"""Baskets, frequent itemsets, association rules and pair counts
(B12-B14, C7, D26, F3, F4, K1-K12).

Scale notes
-----------
* A basket is built with ``array_sort(collect_set(item))``: its size is
  bounded by the number of distinct items, not by the units sold.
* Itemsets come from MLlib's FP-Growth (parallel FP-growth: one item count,
  then group-dependent conditional transactions mined on every partition).
  No sampling and no basket cap are applied unless asked for.
* Multi-item consequents (``rules_full``) expand each frequent itemset into
  its 2^n - 2 antecedent/consequent splits with a bitmask and higher-order
  ``filter``; every subset of a frequent itemset is frequent, so there are
  never more splits than pairs of frequent itemsets.
* Mining per key (``mine_by_key``) intersects vertical bit maps level by level,
  each key with its own threshold; a level is pruned against the one before and
  staged, and its rows are candidates by blocks of baskets, not occurrences.
* Pair counting first drops infrequent items (Apriori pruning).  A basket is
  exploded by position, then each position against the rest of its basket:
  no row ever holds all pairs of a basket.  Hot pairs are combined map-side
  by the partial aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.labels import rnd

BASKET_KEYS = ("ID_Tienda", "ID_Transaccion")


def _txt(c) -> Column:
    """Sorted array -> comma text (arrays are reported as text)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.concat_ws(",", F.transform(F.array_sort(c), lambda x: x.cast("string")))


def baskets(lines: DataFrame, item: str = "Item", keys=BASKET_KEYS, min_size: int = 2) -> DataFrame:
    """One row per basket with its distinct items, size >= ``min_size``."""
    b = lines.groupBy(*keys).agg(F.array_sort(F.collect_set(item)).alias("items"))
    return b.where(F.col("items").isNotNull() & (F.size("items") >= min_size))


def keep_top_items(lines: DataFrame, n: int, item: str = "Item", keys=BASKET_KEYS) -> DataFrame:
    """Keep only the ``n`` items present in most baskets (ties: item order).

    The top-n list is bounded by ``n`` and broadcast into a left-semi join.
    """
    counts = lines.select(*keys, item).distinct().groupBy(item).agg(F.count(F.lit(1)).alias("c"))
    top = counts.orderBy(F.col("c").desc(), F.col(item).asc()).limit(n).select(item)
    return lines.join(F.broadcast(top), item, "left_semi")


def sample_baskets(b: DataFrame, fraction: float | None = None, seed: int = 42, keys=BASKET_KEYS,
                   unit: str = "basket", modulo: int | None = None) -> DataFrame:
    """B13 (Q4, Q5): stable sample of whole baskets.

    Membership depends on the basket key alone, so the sample does not depend
    on partitioning or task retries: either ``fraction`` of the hash range, or
    every ``modulo``-th transaction number.
    """
    if unit == "line":
        # Q4: the reference's row sample thins baskets; kept as an option
        return sample_lines(b, fraction if fraction is not None else 1.0, seed)
    if unit != "basket":
        raise ValueError("unit must be 'basket' or 'line'")
    if modulo is not None:
        return b.where(F.pmod(F.col(keys[-1]), F.lit(modulo)) == 0)
    if fraction is None:
        return b
    h = F.xxhash64(F.lit(seed), *[F.col(k) for k in keys])
    return b.where(F.pmod(h, F.lit(1_000_000)) < F.lit(int(round(fraction * 1_000_000))))


def sample_lines(lines: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """B13 (unit='line'): the reference's row sample, made stable by hashing the row."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in lines.columns])
    return lines.where(F.pmod(h, F.lit(1_000_000)) < F.lit(int(round(fraction * 1_000_000))))


ITEMSET_SCHEMA = T.StructType([T.StructField("items", T.ArrayType(T.StringType())),
                               T.StructField("freq", T.LongType())])
RULE_SCHEMA = T.StructType([
    T.StructField("antecedent", T.ArrayType(T.StringType())), T.StructField("consequent", T.ArrayType(T.StringType())),
    T.StructField("confidence", T.DoubleType()), T.StructField("lift", T.DoubleType()),
    T.StructField("support", T.DoubleType())])


def mine(b: DataFrame, min_support: float = 0.10, min_confidence: float = 0.5, num_partitions: int | None = None,
         stage=None):
    """K2/K4/K9: FP-Growth itemsets (of every length) and single-consequent rules.

    Returns ``(itemsets, rules)`` with sorted item arrays.  Whatever baskets
    there are get mined; without any, both are typed empty frames (Q7).
    ``stage`` writes a frame and reads it back: FP-Growth asks for its input twice, which shuffles
    baskets that are not staged twice.
    """
    from pyspark.ml.fpm import FPGrowth

    spark = b.sparkSession
    if b.isEmpty():
        return spark.createDataFrame([], ITEMSET_SCHEMA), spark.createDataFrame([], RULE_SCHEMA)
    # like baskets meet in a task, whose trees stay small; equal ones are told apart by their keys
    items = b.repartitionByRange("items", *[F.col(f"`{c}`") for c in b.columns if c != "items"]) \
        .select(F.col("items").cast(T.ArrayType(T.StringType())).alias("items"))
    items = stage(items) if stage else items
    # a basket is sent to the group of each of its items: as many groups as cores, not as partitions of the input
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence,
                  numPartitions=num_partitions or spark.sparkContext.defaultParallelism)
    model = fp.fit(items)
    itemsets = model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").cast("long"))
    rules = model.associationRules.select(
        F.array_sort("antecedent").alias("antecedent"), F.array_sort("consequent").alias("consequent"),
        "confidence", "lift", "support")
    return itemsets, rules


def rules_from(itemsets: DataFrame, n_baskets, min_confidence: float = 0.5, keys=()) -> DataFrame:
    """K4: single-consequent rules read off staged itemsets (no second pass over the FP-tree).

    ``n_baskets`` is a column over the itemsets frame (a scalar, or a count per key).
    """
    keys = list(keys)
    its = itemsets.select(*keys, F.array_sort("items").alias("_all"), F.col("freq").alias("_f"), n_baskets.alias("_n"))
    split = its.where(F.size("_all") >= 2).select("*", F.explode("_all").alias("_c")) \
        .select(*keys, "_f", "_n", F.array_except("_all", F.array("_c")).alias("antecedent"),
                F.array("_c").alias("consequent"))
    ant = its.select(*keys, F.col("_all").alias("antecedent"), F.col("_f").alias("_fa"))
    con = its.where(F.size("_all") == 1).select(*keys, F.col("_all").alias("consequent"), F.col("_f").alias("_fc"))
    r = split.join(ant, [*keys, "antecedent"]).join(con, [*keys, "consequent"])
    conf = F.col("_f") / F.col("_fa")
    return r.where(conf >= min_confidence).select(
        *keys, "antecedent", "consequent", conf.alias("confidence"),
        (conf / (F.col("_fc") / F.col("_n"))).alias("lift"), (F.col("_f") / F.col("_n")).alias("support"))


def itemsets_report(itemsets: DataFrame, n_baskets) -> DataFrame:
    """K2/K3: itemsets as text with length, frequency and support (freq / N)."""
    return itemsets.select(
        _txt("items").alias("Productos"), F.size("items").alias("Longitud"), F.col("freq").alias("Frecuencia"),
        rnd(F.col("freq") / n_baskets, 6).alias("Soporte"))


def rules_report(rules: DataFrame) -> DataFrame:
    """K4: rules with text antecedent / consequent (the reference's export columns)."""
    return rules.select(
        _txt("antecedent").alias("Antecedente_Str"), _txt("consequent").alias("Consecuente_Str"),
        rnd("confidence", 6).alias("Confianza"), rnd("lift", 6).alias("Lift"),
        rnd("support", 6).alias("Soporte"))


def top_itemsets(itemsets: DataFrame, n: int = 100) -> DataFrame:
    """top ``n`` itemsets by frequency (ties: item text)."""
    return itemsets.withColumn("_t", _txt("items")).orderBy(F.col("freq").desc(), F.col("_t").asc()) \
        .limit(n).drop("_t")


def top_rules(rules: DataFrame, n: int = 50, by: str = "lift") -> DataFrame:
    """Top ``n`` rules by ``by`` (ties: antecedent, consequent text)."""
    return (rules.withColumn("_a", _txt("antecedent")).withColumn("_c", _txt("consequent"))
            .orderBy(F.col(by).desc(), F.col("_a").asc(), F.col("_c").asc()).limit(n).drop("_a", "_c"))


def rule_splits(itemsets: DataFrame, min_confidence: float | None = None) -> DataFrame:
    """Every split of every itemset into antecedent and consequent: f_all, ant, cons.

    Consequents grow level by level: one item at first, then by an item that stands behind the last one, so each is
    made once and a row gives at most as many rows as its itemset has items.  With ``min_confidence`` the supports
    of a level's antecedents are looked up and only consequents that reach it grow on: a larger consequent leaves a
    smaller antecedent, whose support is no smaller, so nothing that reaches it is lost.  Those levels are written to
    the checkpoint folder, since each one is the next one's input.
    """
    multi = itemsets.select(F.array_sort("items").alias("items"), F.col("freq").alias("f_all")).where(F.size("items") >= 2)
    ants = itemsets.select(F.array_sort("items").alias("ant"), F.col("freq").alias("f_ant"))
    largest = multi.agg(F.max(F.size("items"))).first()[0] or 0
    n = F.size("items")
    level = multi.select("items", "f_all", F.posexplode("items").alias("last", "c")) \
        .select("items", "f_all", "last", F.array("c").alias("cons"))
    levels = []
    for size in range(1, largest):
        level = level.withColumn("ant", F.array_except("items", "cons"))
        if min_confidence is not None:
            level = level.join(ants, "ant").where(F.col("f_all") / F.col("f_ant") >= min_confidence).drop("f_ant").checkpoint()
        levels.append(level.select("f_all", "ant", "cons"))
        level = level.where((n > size + 1) & (F.col("last") < n - 1)) \
            .select("items", "f_all", "cons", F.explode(F.sequence(F.col("last") + 1, n - 1)).alias("last")) \
            .select("items", "f_all", "last", F.concat("cons", F.array(F.get("items", F.col("last")))).alias("cons"))
    empty = itemsets.where("false").select(F.col("freq").alias("f_all"), F.col("items").alias("ant"), F.col("items").alias("cons"))
    return reduce(lambda a, b: a.unionByName(b), levels, empty)


def rules_full(itemsets: DataFrame, n_baskets, min_lift: float | None = 1.0,
               min_confidence: float | None = None) -> DataFrame:
    """Rules with multi-item consequents, all splits of every itemset (``rule_splits``).

    Supports of both sides come from an equi join with the itemsets themselves (every
    subset of a frequent itemset is frequent).  Adds leverage and conviction (null when
    confidence is 1).
    """
    fi = itemsets.select(F.array_sort("items").alias("items"), "freq")
    split = rule_splits(itemsets, min_confidence)
    a = fi.select(F.col("items").alias("ant"), F.col("freq").alias("f_ant"))
    c = fi.select(F.col("items").alias("cons"), F.col("freq").alias("f_cons"))
    # the basket count (often a scalar subquery) is projected once and used by name
    r = split.join(a, "ant").join(c, "cons").withColumn("_n", n_baskets)
    n = F.col("_n")
    sup = F.col("f_all") / n
    sa = F.col("f_ant") / n
    sc = F.col("f_cons") / n
    conf = F.col("f_all") / F.col("f_ant")
    out = r.select(
        _txt("ant").alias("Antecedente_Str"), _txt("cons").alias("Consecuente_Str"),
        F.size("ant").alias("Long_Antecedente"), F.size("cons").alias("Long_Consecuente"),
        rnd(sa, 6).alias("Soporte_Antecedente"), rnd(sc, 6).alias("Soporte_Consecuente"),
        rnd(sup, 6).alias("Soporte"), rnd(conf, 6).alias("Confianza"),
        rnd(conf / sc, 6).alias("Lift"), rnd(sup - sa * sc, 6).alias("Leverage"),
        rnd(F.when(conf < 1, (1 - sc) / (1 - conf)), 6).alias("Conviction"),
        (conf / sc).alias("_lift"))
    if min_lift is not None:
        out = out.where(F.col("_lift") >= min_lift)
    return out.drop("_lift")


def filter_rules(rules: DataFrame, confidence: float, lift: float, conf_col: str = "Confianza",
                 lift_col: str = "Lift") -> DataFrame:
    """K6: strict thresholds, confidence > c and lift > l."""
    return rules.where((F.col(conf_col) > confidence) & (F.col(lift_col) > lift))


def by_length(itemsets_rep: DataFrame, n_pairs: int = 15, n_triples: int = 10) -> DataFrame:
    """K7: counts per itemset length plus top pairs and top triples by frequency."""
    counts = itemsets_rep.groupBy("Longitud").agg(F.count(F.lit(1)).alias("Valor")).select(
        F.lit("conteo").alias("Tipo"), "Longitud", F.lit(None).cast("int").alias("Posicion"),
        F.lit(None).cast("string").alias("Productos"), "Valor")
    order = [F.col("Frecuencia").desc(), F.col("Productos").asc()]

    def best(size: int, n: int) -> DataFrame:
        # a limit per length (top-k in every task) before the position is numbered
        first = itemsets_rep.where(F.col("Longitud") == size).orderBy(*order).limit(n)
        return first.select(F.lit("top").alias("Tipo"), "Longitud", F.row_number().over(Window.orderBy(*order)).alias("Posicion"),
                            "Productos", F.col("Frecuencia").alias("Valor"))

    top = best(2, n_pairs).unionByName(best(3, n_triples))
    return counts.unionByName(top)


def lift_distribution(rules_rep: DataFrame, bins: int = 50) -> tuple[DataFrame, DataFrame]:
    """K8: lift mean / median / min / max and confidence quartiles, plus a lift histogram."""
    from basketry.functions.labels import histogram

    stats = rules_rep.agg(
        F.count(F.lit(1)).alias("Reglas"),
        rnd(F.avg("Lift"), 6).alias("Lift_Media"),
        rnd(F.percentile("Lift", 0.5), 6).alias("Lift_Mediana"),
        F.min("Lift").alias("Lift_Min"), F.max("Lift").alias("Lift_Max"),
        rnd(F.percentile("Confianza", 0.25), 6).alias("Confianza_P25"),
        rnd(F.percentile("Confianza", 0.75), 6).alias("Confianza_P75"))
    return stats, histogram(rules_rep, "Lift", bins)


def cooccurrence(b: DataFrame, min_count: int = 2, n: int | None = None, keys=(),
                 basket_keys=BASKET_KEYS) -> DataFrame:
    """Baskets holding each item pair (a < b), per ``keys``, count >= ``min_count``.

    Items below ``min_count`` (within their ``keys`` group) cannot be in a
    pair that reaches it, so they are removed before the pairs are generated.
    A basket's row carries its items once for each position, and every position
    is exploded against the items after it, so the largest row is a basket and
    the pairs stream into the map-side count.  ``n`` keeps the top pairs per group.
    """
    keys = list(keys)
    bk = list(dict.fromkeys([*keys, *basket_keys]))
    exploded = b.select(*bk, F.explode("items").alias("item"))
    freq = exploded.groupBy(*keys, "item").agg(F.count(F.lit(1)).alias("_c")) \
        .where(F.col("_c") >= min_count).select(*keys, "item")
    its = exploded.join(freq, [*keys, "item"], "left_semi") \
        .groupBy(*bk).agg(F.array_sort(F.collect_set("item")).alias("items"))
    heads = its.where(F.size("items") >= 2).select(*keys, "items", F.posexplode("items").alias("_p", "Item_A"))
    pairs = heads.select(*keys, "Item_A", F.explode(F.slice("items", F.col("_p") + 2, F.size("items"))).alias("Item_B"))
    out = pairs.groupBy(*keys, "Item_A", "Item_B").agg(F.count(F.lit(1)).alias("Transacciones")) \
        .where(F.col("Transacciones") >= min_count)
    if n is not None:
        order = [F.col("Transacciones").desc(), F.col("Item_A").asc(), F.col("Item_B").asc()]
        if keys:
            w = Window.partitionBy(*keys).orderBy(*order)
            out = out.withColumn("Posicion", F.row_number().over(w)).where(F.col("Posicion") <= n)
        else:
            out = out.orderBy(*order).limit(n)
    return out


#: baskets of one bit-map row (64 to a word); a block's size varies with the hash by a few per cent
BLOCK = 4096


def _written(df: DataFrame, name: str) -> DataFrame:
    from basketry.plans.session import fresh_path

    path = fresh_path(df.sparkSession, f"mining-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def item_bitmaps(b: DataFrame, key: str, write=_written, basket_keys=BASKET_KEYS, block: int = BLOCK) -> DataFrame:
    """Vertical layout of baskets: (key, block, items = [item], bits array<bigint>).

    A key's baskets are hashed into blocks of about ``block``; inside its block a
    basket has a position, by which it is one bit in the row of each of its items.
    A row is at most some hundred words long whatever the number of baskets, and a
    hot key is many blocks.
    """
    rest = [k for k in basket_keys if k != key]
    blocks = b.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block))).alias("_blocks"))
    numbered = b.join(blocks, key).withColumn("block", F.pmod(F.xxhash64(*rest), F.col("_blocks")))
    place = Window.partitionBy(key, "block").orderBy(*rest)
    numbered = write(numbered.select(key, "block", "items", (F.row_number().over(place) - 1).alias("_pos")), "positions")
    words = numbered.select(key, "block", F.explode("items").alias("_i"), (F.col("_pos") / 64).cast("int").alias("_w"),
                            F.expr("shiftleft(1L, _pos % 64)").alias("_m")) \
        .groupBy(key, "block", "_i", "_w").agg(F.bit_or("_m").alias("_m"))
    by_word = words.groupBy(key, "block", "_i").agg(F.map_from_entries(F.collect_list(F.struct("_w", "_m"))).alias("_map"))
    bits = F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys("_map"))),
                       lambda w: F.coalesce(F.try_element_at("_map", w), F.lit(0).cast("bigint")))
    return by_word.select(key, "block", F.array(F.col("_i").cast("string")).alias("items"), bits.alias("bits"))


def _candidates(found: DataFrame, key: str, size: int) -> DataFrame:
    """Itemsets of ``size`` all of whose subsets one smaller are in ``found``, with two of them (left, right).

    Itemsets that share all but the last item are paired position by position, so
    the largest row is one head with its last items.
    """
    head = F.slice("items", 1, size - 2) if size > 2 else F.array().cast("array<string>")
    tails = found.groupBy(key, head.alias("_head")).agg(F.array_sort(F.collect_list(F.element_at("items", -1))).alias("_t"))
    first = tails.select(key, "_head", "_t", F.posexplode("_t").alias("_p", "_a"))
    pairs = first.select(key, "_head", "_a", F.explode(F.slice("_t", F.col("_p") + 2, F.size("_t"))).alias("_b")) \
        .select(key, F.concat("_head", F.array("_a", "_b")).alias("items"), F.concat("_head", F.array("_a")).alias("left"),
                F.concat("_head", F.array("_b")).alias("right"))
    if size == 2:
        return pairs
    subset = F.explode(F.transform("items", lambda x: F.array_except("items", F.array(x)))).alias("_sub")
    whole = pairs.select(key, "items", "left", "right", subset) \
        .join(found.select(key, F.col("items").alias("_sub")), [key, "_sub"], "left_semi")
    return whole.groupBy(key, "items", "left", "right").agg(F.count(F.lit(1)).alias("_n")) \
        .where(F.col("_n") == size).drop("_n")


def mine_by_key(b: DataFrame, key: str, min_support: float = 0.10, min_confidence: float = 0.5, min_count: int = 1,
                stage=None, basket_keys=BASKET_KEYS, block: int = BLOCK, write=_written):
    """Itemsets and single-consequent rules per value of ``key`` (e.g. per store).

    Frequent means: in at least ``min_support`` of that key's baskets and in at
    least ``min_count`` of them (the same floor for every key; with a support
    alone, single occurrences would be frequent in a key of few baskets).  Level
    by level over vertical bit maps (``item_bitmaps``): candidates are made from the
    frequent itemsets one smaller and pruned against them, and a candidate's bits in
    a block are the AND of the bits of two of its subsets.  So a level holds one row
    for each candidate and block that has such a basket, not one for each basket and
    contained itemset.  A key of few baskets costs its own few rows; nothing is mined
    at another key's threshold.  ``write`` (frame, name -> frame) writes the
    bits of each level as a table, which cuts the plan (a cached frame would not: its
    plan would grow fourfold a level); by default as Parquet under
    ``spark.checkpoint.dir``.  ``stage`` does the same for the small tables of itemsets
    and may cache.  Ends when a level is empty.

    Returns ``(itemsets, rules)``: (key, items, freq, support) and (key,
    antecedent, consequent, confidence, lift, support).
    """
    stage = stage or write
    limit = b.groupBy(key).agg(F.count(F.lit(1)).alias("_nk")) \
        .withColumn("_min", F.greatest(F.ceil(F.lit(min_support) * F.col("_nk")), F.lit(min_count)))
    limit = stage(limit, "limits")
    ones = F.aggregate("bits", F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w))

    def frequent(bits: DataFrame) -> DataFrame:
        return bits.groupBy(key, "items").agg(F.sum(ones).alias("freq")).join(limit, key) \
            .where(F.col("freq") >= F.col("_min")).select(key, "items", "freq", "_nk")

    bits = write(item_bitmaps(b, key, write, basket_keys, block), "bits-1")
    levels, size = [], 1
    while True:
        found = stage(frequent(bits), f"level-{size}")
        if found.isEmpty():
            break
        levels.append(found)
        size += 1
        left = bits.select(key, F.col("items").alias("left"), "block", F.col("bits").alias("_lb"))
        right = bits.select(key, F.col("items").alias("right"), "block", F.col("bits").alias("_rb"))
        both = _candidates(found, key, size).join(left, [key, "left"]).join(right, [key, "block", "right"])
        anded = F.zip_with("_lb", "_rb", lambda x, y: F.coalesce(x.bitwiseAND(y), F.lit(0).cast("bigint")))
        bits = write(both.select(key, "block", "items", anded.alias("bits")).where(F.exists("bits", lambda w: w != 0)),
                     f"bits-{size}")
    if not levels:
        ktype = b.schema[key].dataType.simpleString()
        spark = b.sparkSession
        return (spark.createDataFrame([], f"{key} {ktype}, items array<string>, freq long, support double"),
                spark.createDataFrame([], f"{key} {ktype}, antecedent array<string>, consequent array<string>, "
                                          "confidence double, lift double, support double"))
    its = levels[0]
    for x in levels[1:]:
        its = its.unionByName(x)
    rules = rules_from(its, F.col("_nk"), min_confidence, keys=[key])
    return its.select(key, "items", "freq", (F.col("freq") / F.col("_nk")).alias("support")), rules
