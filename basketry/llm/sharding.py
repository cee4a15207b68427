"""Sharding by a Feistel permutation with cycle walking.

Every row gets its global row number (position in the order of id, size and
CRC), the numbers 0..N-1 are permuted by a keyed Feistel network, and the
permuted number p gives ``shard = p mod shards`` and ``slot = p div shards``.
Anyone who knows N, the seed and the shard count can compute either way which
row stands where; shard sizes differ by at most one row (law ``rows``).

The network works on pairs (L, R) in Z_a x Z_b with a*b just over N, so at most
about 2*sqrt(N) numbers lie outside 0..N-1.  A row whose image lies outside
walks on along its cycle.  How many steps the longest walk takes is found
beforehand by walking the outside numbers themselves, so no row is left out
and no step count is guessed.

Cases: null text has size 1 (no bytes plus 1) and the CRC of the empty text;
null ids come first in the order; repeated rows are numbered one after the
other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import free_name, global_rank, quoted, stage, with_uid

ROUNDS = 4


def round_value(seed: int, j: int, x: Column) -> Column:
    """Round function: 32 bits of an MD5 over (seed, round, value)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(j)), x.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _network(df: DataFrame, p: str, a: int, b: int, seed: int) -> DataFrame:
    """One pass of the network over column ``p`` of ``df`` (0 <= p < a*b)."""
    keep = [quoted(c) for c in df.columns if c != p]
    cur = df.select(*keep, F.pmod(F.col(p), F.lit(a)).alias("__l"), F.expr(f"`{p}` div {a}L").alias("__r"))
    for j in range(ROUNDS):
        m = a if j % 2 == 0 else b
        cur = cur.select(*keep, F.col("__r").alias("__l"),
                         F.pmod(F.col("__l") + round_value(seed, j, F.col("__r")), F.lit(m)).alias("__r"))
    return cur.select(*keep, (F.lit(a) * F.col("__r") + F.col("__l")).cast("bigint").alias(p))


def domain(n: int) -> tuple[int, int]:
    """Factors a, b with a*b >= n and a*b - n < a."""
    a = max(1, isqrt(n))
    return a, max(1, -(-n // a))


def walk_steps(spark: SparkSession, n: int, seed: int) -> int:
    """Passes after which every one of 0..n-1 is back inside 0..n-1."""
    a, b = domain(n)
    out, steps = spark.range(n, a * b).select(F.col("id").alias("p")), 1
    while out.limit(1).count():
        out = _network(out, "p", a, b, seed).filter(F.col("p") >= n)
        steps += 1
    return steps


def permute(df: DataFrame, p: str, n: int, seed: int, steps: int | None = None) -> DataFrame:
    """Replace the numbers 0..n-1 in column ``p`` by their permuted images."""
    if n <= 1:
        return df
    a, b = domain(n)
    steps = steps or walk_steps(df.sparkSession, n, seed)
    df, start = _network(df, p, a, b, seed), "__start"
    for _ in range(steps - 1):
        moved = _network(df.select("*", F.col(p).alias(start)), p, a, b, seed)
        df = moved.select(*[quoted(c) for c in df.columns if c != p],
                          F.when(F.col(start) < n, F.col(start)).otherwise(F.col(p)).alias(p))
    return df


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8,
          seed: int = 20) -> DataFrame:
    """(id, size, text_crc32, row_number, shard, slot) for every row of ``docs``."""
    text = F.coalesce(quoted(text_col), F.lit(""))
    facts = docs.select(quoted(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"))
    return _place(facts, ["id", "size", "text_crc32"], shards, seed)


def _place(facts: DataFrame, order: list[str], shards: int, seed: int) -> DataFrame:
    # staged first: the range partitioner samples its input, which must not read the texts twice
    ranked = global_rank(stage(facts, "shard-facts"), order, "row_number", "shard-ranks")
    n = ranked.count()
    out = permute(ranked.withColumn("p", F.col("row_number")), "p", n, seed)
    return out.withColumn("shard", F.pmod("p", F.lit(shards)).cast("int")) \
        .withColumn("slot", F.expr(f"p div {shards}L")).drop("p")


def shard_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8,
               seed: int = 20) -> DataFrame:
    """``docs`` with all its columns plus ``shard`` and ``slot`` (replacing columns so named)."""
    uid = free_name(docs, "__uid")
    kept = stage(with_uid(docs, uid), "shard-input")
    text = F.coalesce(quoted(text_col), F.lit(""))
    facts = kept.select(quoted(id_col).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.col(uid).alias("uid"))
    placed = _place(facts, ["id", "size", "text_crc32", "uid"], shards, seed)
    return kept.drop("shard", "slot").join(placed.select(F.col("uid").alias(uid), "shard", "slot"), uid).drop(uid)
