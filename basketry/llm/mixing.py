"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in a fixed pseudo-random order, twice
over if need be (``epochs``).  Serving a source whose target is T at rate T, a
document that ends at c words of its queue has the virtual finish time c / T.
A document in service when its source has had T words (virtual time one) is cut
there into two packets, as a queue may cut a packet.  All packets of all sources
are sorted globally by finish time, and the mix is the packets until the words
served reach the total budget; what a document gave is read off the packets that
this truncation leaves.  T is rounded to words, so that sums are exact.

The global sort is a range partitioning by ``slots`` of virtual time (logarithmic
beyond time one).  Up to time one every slot holds about as many words, since all
queues are served at their rates at once; the running sum inside a slot is one
window, and the sums of slots, a bounded number of rows, meet in one place.

Sizes are counted in words.  Queues are cut into hash buckets so that the
running sum of a hot source is spread over tasks; the sums meet as one row per
(source, epoch, bucket).  Rows without an id are spread over buckets of their own.

Cases: null text counts 0 words and is never taken; a null source is a source
of its own, last in order; rows that are repeated queue one behind the other;
an empty table gives an empty result; if no document has a word every target
is 0; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import WORD_RE, free_name, quoted, stage, with_uid

WEIGHTS = (5.0, 2.0, 1.0)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, epochs: int = 2) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size).

    Sources in code point order, nulls last, take ``weights`` in turn.  The
    budget is ``share`` of all words.  A target stops at ``epochs`` times the
    source's size and the excess goes to the others by weight: with sources
    sorted by cap / weight, the water level is the first one that does not
    reach the next cap.  One row per source.
    """
    rank = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.pmod(F.row_number().over(rank) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (k + 1).cast("int"))
    s = sizes.select("source", "source_size", weight.alias("weight")) \
        .withColumn("cap", (F.col("source_size") * epochs).cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    s = s.withColumn("below", F.coalesce(F.sum("cap").over(
            by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) \
        .withColumn("open", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))) \
        .withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
    level = (F.col("budget") - F.col("below")) / F.col("open")
    s = s.withColumn("level", F.min(F.when(level <= F.col("cap") / F.col("weight"),
                                           F.struct(F.col("below"), level.alias("v")))).over(every)["v"])
    target = F.when(F.col("budget") == 0, F.lit(0.0)).otherwise(
        F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))))
    return s.select("source", "source_size", "weight", target.alias("target"))


def truncated(packets: DataFrame, budget, slots: int = 1 << 14) -> DataFrame:
    """``packets`` (finish, source, epoch, uid, words) in global order of finish time until
    their words reach ``budget`` (a column: the scalar total), with ``served_total``, the
    words served up to and with a packet."""
    time = F.when(F.col("finish") <= 1, F.col("finish")).otherwise(1 + F.log("finish"))
    p = packets.withColumn("slot", F.floor(time * slots))
    before = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = p.groupBy("slot").agg(F.sum("words").alias("words")) \
        .select("slot", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    # a slot is in one range partition, so the window needs no further exchange
    inside = Window.partitionBy("slot").orderBy("finish", F.col("source").asc_nulls_last(), "epoch", "uid") \
        .rowsBetween(Window.unboundedPreceding, 0)
    run = p.repartitionByRange("slot").withColumn("run", F.sum("words").over(inside))
    # slots grow with the logarithm of the longest finish time: some thousand rows, joined by Spark's own size check
    return run.join(sums, "slot").withColumn("served_total", F.col("before") + F.col("run")) \
        .filter(F.col("served_total") <= budget).drop("before", "run", "slot")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = 1.5, epochs: int = 2, buckets: int = 256, seed: int = 7,
        uid_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs``: (items, rows).

    ``items``: one row per document and epoch taken, globally sorted by virtual
    finish time: uid, id, source, epoch, size, served, finish, served_total.
    ``rows``: one row per input row: uid, id, source, size, source_size, target,
    taken.  Both read the same truncated packets.  ``uid_col`` names a unique row
    number of a staged input; without it rows are numbered here.
    """
    uid = F.monotonically_increasing_id() if uid_col is None else F.col(uid_col)
    sized = stage(docs.select(
        uid.alias("uid"), quoted(id_col).alias("id"), quoted(source_col).alias("source"),
        F.coalesce(F.regexp_count(quoted(text_col), F.lit(WORD_RE)), F.lit(0)).cast("bigint").alias("size")), "mix-sizes")
    goal = stage(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                         weights, share, epochs), "mix-targets")

    # the queue order of an epoch: MD5 of (seed, epoch, id); its first bytes name the bucket
    epoch = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"),
                            F.coalesce(F.col("id").cast("string"), F.lit("null"))).cast("binary"))
    bucket = F.pmod(F.conv(F.substring("key", 1, 4), 16, 10).cast("int"), F.lit(buckets))
    # rows without an id share one key: they queue after the others, in buckets by row number
    bucket = F.when(F.col("id").isNull(), buckets + F.pmod(F.xxhash64("uid"), F.lit(buckets))).otherwise(bucket)
    queue = sized.filter("size > 0").select("*", epoch).withColumn("key", key).withColumn("bucket", bucket)
    inside = Window.partitionBy("source", "epoch", "bucket").orderBy("key", "size", "uid") \
        .rowsBetween(Window.unboundedPreceding, 0)
    sums = queue.groupBy("source", "epoch", "bucket").agg(F.sum("size").alias("words"))
    ahead = sums.select("source", "epoch", "bucket", F.coalesce(F.sum("words").over(
        Window.partitionBy("source").orderBy("epoch", "bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("ahead")).alias("s")
    q = queue.withColumn("run", F.sum("size").over(inside)).alias("q")
    queue = q.join(ahead, F.col("q.source").eqNullSafe(F.col("s.source")) & (F.col("q.epoch") == F.col("s.epoch"))
                   & (F.col("q.bucket") == F.col("s.bucket"))).select("q.*", "s.ahead").alias("q")
    # one row a source on the right: a broadcast by size, else AQE splits the rows of a hot source
    g = goal.select("source", F.round("target").cast("bigint").alias("rate")).filter("rate > 0").alias("g")
    queue = queue.join(g, F.col("q.source").eqNullSafe(F.col("g.source"))).select("q.*", "g.rate")
    end = F.col("ahead") + F.col("run")
    start = end - F.col("size")
    crosses = (start < F.col("rate")) & (end > F.col("rate"))  # in service at virtual time one
    ends = F.when(crosses, F.array(F.col("rate") - start, F.col("size"))).otherwise(F.array("size"))
    cut = queue.select("uid", "id", "source", "epoch", "size", "rate", start.alias("start"), F.posexplode(ends).alias("piece", "till"))
    words = F.when(F.col("piece") == 0, F.col("till")).otherwise(F.col("start") + F.col("size") - F.col("rate"))
    packets = cut.select("uid", "id", "source", "epoch", "size", words.alias("words"),
                         ((F.col("start") + F.col("till")) / F.col("rate")).alias("finish"))
    budget = goal.agg(F.sum(F.round("target").cast("bigint"))).scalar()
    items = truncated(packets, budget).withColumnRenamed("words", "served")
    taken = items.groupBy("uid").agg(F.sum("served").alias("taken")).alias("t")
    rows = sized.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))) \
        .select("d.*", "g.source_size", "g.target").alias("d") \
        .join(taken, F.col("d.uid") == F.col("t.uid"), "left") \
        .select("d.*", F.coalesce("t.taken", F.lit(0)).cast("bigint").alias("taken"))
    return items.orderBy("finish", F.col("source").asc_nulls_last(), "epoch", "uid"), rows


def mix_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             **params) -> DataFrame:
    """``docs`` as mixed: each row once per epoch of which at least half its words
    were served, so none more than ``epochs`` times; the others go."""
    uid = free_name(docs, "__uid")
    kept = stage(with_uid(docs, uid), "mix-input")
    items, _ = mix(kept, id_col, text_col, source_col, uid_col=uid, **params)
    times = items.filter("served * 2 >= size").groupBy("uid").agg(F.count(F.lit(1)).cast("int").alias("n"))
    n = free_name(docs, "__n")
    return kept.join(times.select(F.col("uid").alias(uid), F.col("n").alias(n)), uid) \
        .withColumn(n, F.explode(F.array_repeat(F.lit(0), F.col(n)))).drop(uid, n)
