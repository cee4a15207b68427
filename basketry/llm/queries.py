"""Registered queries of the training-data operators: op1 .. op13.

Each reads a whole driver table, runs its operator with the parameters meant for
production and derives the digest columns that are returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    chaining, chat, collocations, common, decontam, langid, mixing, packing, quality, secrets, sharding, simhash, toxicity, variants)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


@query("op3_chat_parts", r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\b'), '<', '\l'), '>', '\g') AS body,
         replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g') AS head FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(head) + length(body) + 15) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""")
def op3_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = common.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    said = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit(said).alias("text"))
    out = chat.format_turns(turns.unionByName(more))
    back = out.select("conv", "formatted", "loss", chat.read_back(F.col("formatted")).alias("turns"),
                      chat.loss_text(F.col("formatted"), F.col("loss")).alias("learned"))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(joined.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))


def _feistel_sql(a: str, b: str, seed: int, p: str) -> tuple[list[str], str]:
    """The rounds over column ``p`` as a chain of subqueries' select lists."""
    steps = [f"{p} % {a} AS l, {p} // {a} AS r"]
    for j in range(sharding.ROUNDS):
        f = f"CAST('0x' || substr(md5('{seed}:{j}:' || CAST(r AS VARCHAR)), 1, 8) AS BIGINT)"
        steps.append(f"r AS l, (l + {f}) % {a if j % 2 == 0 else b} AS r")
    return steps, f"{a} * r + l"


def _shard_sql(shards: int = 8, seed: int = 20) -> str:
    steps, out = _feistel_sql("a", "b", seed, "p")
    inner = "walk"
    for s in steps:
        inner = f"(SELECT doc_id, size, text_crc32, n, a, b, {s} FROM {inner})"
    return f"""
WITH RECURSIVE bits(k, c) AS (
  SELECT CAST(i AS BIGINT), CAST(i AS BIGINT) FROM range(256) t(i)),
crc8(k, c, s) AS (
  SELECT k, c, 0 FROM bits UNION ALL
  SELECT k, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, s + 1 FROM crc8 WHERE s < 8),
lut AS (SELECT list(c ORDER BY k) AS v FROM crc8 WHERE s = 8),
d AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         hex(encode(coalesce(text, ''))) AS h FROM documents),
byt AS (
  SELECT doc_id, size, h, CASE WHEN h = '' THEN CAST(0 AS BIGINT) ELSE xor(CAST(4294967295 AS BIGINT), list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(regexp_extract_all(h, '..'), lambda i: CAST('0x' || i AS BIGINT))),
    lambda acc, x: xor(acc >> 8, v[CAST((xor(acc, x) & 255) + 1 AS BIGINT)]))) END AS text_crc32
  FROM d, lut),
ranked AS (
  SELECT doc_id, size, text_crc32, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS p,
         count(*) OVER () AS n FROM byt),
dom AS (
  SELECT *, CAST(greatest(1, floor(sqrt(n))) AS BIGINT) AS a FROM ranked),
start AS (SELECT *, CAST(greatest(1, ceil(n / a)) AS BIGINT) AS b FROM dom),
walk(doc_id, size, text_crc32, n, a, b, p, k) AS (
  SELECT doc_id, size, text_crc32, n, a, b, p, 0 FROM start
  UNION ALL
  SELECT doc_id, size, text_crc32, n, a, b, {out}, 1 FROM
  {inner.replace('FROM walk', 'FROM (SELECT * FROM walk WHERE k = 0 OR p >= n)')})
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % {shards} AS INTEGER) AS shard, p // {shards} AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM walk WHERE k = 1 AND p < n"""


@query("op5_feistel_shards", _shard_sql())
def op5_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(common.table(spark, sf_dir, "documents"), shards=8)
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op7_fair_mix", """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s0 AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM d GROUP BY source),
s1 AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget FROM s0),
s2 AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM s1),
s3 AS (SELECT *, (budget - below) / open AS lv FROM s2),
g AS (
  SELECT source, source_size, CASE WHEN budget = 0 THEN 0.0::DOUBLE ELSE least(cap, coalesce(
    (SELECT x.lv FROM s3 x WHERE x.lv <= x.cap / x.weight ORDER BY x.below LIMIT 1) * weight, cap)) END AS target FROM s3),
q AS (
  SELECT doc_id, d.source, size, target, sum(size) OVER (
    PARTITION BY d.source ORDER BY epoch, CAST('0x' || substr(key, 1, 4) AS INTEGER) % 256, key, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fin
  FROM (SELECT *, md5('7:' || CAST(epoch AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
        FROM d, (VALUES (0), (1)) e(epoch) WHERE size > 0) d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
t AS (
  SELECT doc_id, sum(greatest(0, least(size, CAST(round(target) AS BIGINT) - (fin - size)))) AS taken FROM q GROUP BY doc_id)
SELECT d.doc_id, d.size, g.source_size, g.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN t ON d.doc_id = t.doc_id""")
def op7_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = mixing.mix(common.table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))), "doc_id", "text", "lang")
    return langid.predict(docs.select("doc_id", "text"), model, "text", "found").select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"))


@query("op2_simhash_components")
def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(common.table(spark, sf_dir, "documents"), shingle=4, bits=4)
    return out.select(F.col("id").alias("doc_id"), simhash.hex16("fingerprint").alias("fingerprint"),
                      F.col("component").alias("component_id"))


@query("op8_fertility_rules")
def op8_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return quality.judged(docs, "text", "lang", ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_tokens", "chars_per_token", "byte_share", "entropy")


@query("op10_entropy_secrets")
def op10_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(common.table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "found")
    base = F.filter("found", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"),
                        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
                        secrets.listed(F.col("found")).alias("spans"))


@query("op6_kernel_toxicity")
def op6_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.table(spark, sf_dir, "labels")
    held = F.coalesce(common.bucket_crc(F.col("doc_id"), 3) == 1, F.lit(False))
    model = toxicity.train(docs, labels.filter(~held))
    return toxicity.score(docs, model, "text", "score").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op9_latent_leaks")
def op9_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_leaks(docs, common.table(spark, sf_dir, "benchmark"), out="leaks")
    hit = found.select("doc_id", F.explode("leaks").alias("m"))
    return hit.select("doc_id", F.col("m.item_id").cast("bigint").alias("item_id"), "m.part", "m.start", "m.end",
                      "m.cosine", "m.lcs", "m.answer")


@query("op4_chained_passages")
def op4_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(common.table(spark, sf_dir, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_phrase_collocations", rf"""
WITH piece AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece WHERE len(w) > 0),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, count(*) AS f
  FROM place, (VALUES (1), (2), (3), (4), (5)) ks(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM gram WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, g, f, string_split(g, ' ') AS w FROM gram WHERE k >= 2 AND f >= 100),
cut AS (SELECT lang, g, f, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y
        FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)),
scored AS (
  SELECT cut.lang, cut.g, cut.f AS a, j, x.f AS l, y.f AS r, total.n,
         CAST((CAST(1000 AS HUGEINT) * cut.f * total.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cut JOIN gram x ON x.lang = cut.lang AND x.g = cut.x JOIN gram y ON y.lang = cut.lang AND y.g = cut.y
  JOIN total ON total.lang = cut.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, j) AS o FROM scored),
part AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS g, max(f) AS f FROM (
    SELECT lang, w, f, k, m, unnest(range(1, k - m + 2)) AS i FROM cand, (VALUES (2), (3), (4)) ms(m) WHERE m < k)
  GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN part p ON p.lang = b.lang AND p.g = b.g
         WHERE b.o = 1 AND NOT coalesce(100 * p.f >= 100 * b.a, false)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""")
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("text", "lang")
    return collocations.collocations(docs, min_count=100, top=2000).drop("cut")


@query("op12_spelling_variants", rf"""
WITH RECURSIVE bits(k, c) AS (
  SELECT CAST(i AS BIGINT), CAST(i AS BIGINT) FROM range(256) t(i)),
crc8(k, c, s) AS (
  SELECT k, c, 0 FROM bits UNION ALL
  SELECT k, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, s + 1 FROM crc8 WHERE s < 8),
lut AS (SELECT list(c ORDER BY k) AS v FROM crc8 WHERE s = 8),
run AS (
  SELECT doc_id, x, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS x FROM documents)
  WHERE length(x) >= 5 GROUP BY ALL),
hashed AS (
  SELECT x, c, xor(CAST(4294967295 AS BIGINT), list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(regexp_extract_all(hex(encode(doc_id || ':' || x)), '..'), lambda i: CAST('0x' || i AS BIGINT))),
    lambda acc, b: xor(acc >> 8, v[CAST((xor(acc, b) & 255) + 1 AS BIGINT)]))) AS h FROM run, lut),
voc AS (
  SELECT w, length(w) AS len, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(x, 1, h % length(x)) || substr(x, h % length(x) + 2) ELSE x END AS w, c FROM hashed)
  WHERE length(w) >= 5 GROUP BY w HAVING sum(c) >= 3),
del AS (SELECT w, len, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS d FROM (SELECT *, unnest(range(1, len + 1)) AS i FROM voc)),
one AS (SELECT DISTINCT del.w AS x, voc.w AS y FROM del JOIN voc ON voc.w = del.d),
pair AS (
  SELECT a.w AS x, b.w AS y FROM del a JOIN del b ON a.len = b.len AND a.i = b.i AND a.d = b.d AND a.w <> b.w
  UNION ALL SELECT x, y FROM one UNION ALL SELECT y, x FROM one),
near AS (
  SELECT x, y, voc.n AS m, row_number() OVER (PARTITION BY x ORDER BY voc.n DESC, y) AS o, count(*) OVER (PARTITION BY x) AS c
  FROM pair JOIN voc ON voc.w = y),
form AS (
  SELECT voc.w, CASE WHEN m >= 2 * n THEN y END AS form, n, coalesce(c, 0) AS n_near, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM voc LEFT JOIN near ON x = voc.w AND o = 1),
walk(w, root, next) AS (
  SELECT w, w, form FROM form UNION ALL
  SELECT walk.w, form.w, form.form FROM walk JOIN form ON form.w = walk.next)
SELECT form.w AS word, form.form, root, form.n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM form JOIN walk ON walk.w = form.w AND walk.next IS NULL""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(common.table(spark, sf_dir, "documents"), min_length=5, min_count=3, factor=2)


@query("op13_packed_sequences")
def op13_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(common.table(spark, sf_dir, "documents"), window=2048)
    return pieces.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "sequence_length", "sequence_padded")
