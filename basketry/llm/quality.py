"""Quality rules by tokeniser fertility.

Every whole text is tokenised with a public byte-level vocabulary, white space
collapsed to single spaces, so that a word's tokens depend on the word alone and
are looked up once for each distinct word a worker meets.  Three figures follow:

* ``chars_per_token``: code points of the words and the spaces before them, per token;
* ``byte_share``: share of tokens that are no whole characters (byte fallback);
* ``entropy``: Shannon entropy of the text's tokens over log2(min(tokens, 256)).

Bands are fitted per language (or, where the language is null, per dominant
script) over all documents that pass the base rules: from ``spread`` interquartile
ranges below the first quartile to as many above the third (the usual fences of
far outliers), and never narrower than ``slack`` of the median on either side.
The figures are binned first, so quartiles are exact over bounded histograms.  A
document is kept if the base rules pass, chars_per_token lies inside its band,
entropy is not below and byte_share not above theirs.

Base rules: at least 50 words, and not more than half of them inside 3-word
windows that occur twice.

Cases: null reads as empty and fails the base rules; bytes that are no UTF-8 read as U+FFFD for
tokens and script, and count as they stand (lead bytes) for characters; a text of any length is
read whole, in pieces; repeated rows get equal results; an empty table gives an
empty result; other columns are kept as they are.
"""

from __future__ import annotations

import base64
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import free_name, quoted, ship, stage, with_uid
from basketry.llm.simhash import word_blocks

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the public pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT = 50, 50  # words; per cent
CACHE_WORDS, CACHE_CHARS = 150_000, 40
BIN = 200  # bins a unit in the histograms
SALTS = 64  # tasks that a language's rows may spread over when they meet their bands
_WORKER: dict = {}

FACTS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, "
         "chars_per_token double, byte_share double, entropy double, script string")


class Fertility:
    """A vocabulary with the tokens of the words met so far."""

    def __init__(self, ranks_file: bytes):
        import tiktoken

        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, ranks_file.splitlines())}
        self.encoding = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.broken = np.zeros(max(ranks.values()) + 1, bool)
        for t, r in ranks.items():
            try:
                t.decode()
            except UnicodeDecodeError:
                self.broken[r] = True
        self.cache: dict[bytes, list[int]] = {}

    def tokens(self, words: list[bytes]) -> list[int]:
        """Tokens of the words, each with the space before it."""
        cache, out = self.cache, []
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in words:
            t = cache.get(w)
            if t is None:
                t = self.encoding.encode_ordinary(" " + w.decode("utf-8", "replace"))
                if len(w) <= CACHE_CHARS:
                    cache[w] = t
            out += t
        return out


def _repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    n = Counter(windows)
    hit = np.fromiter((n[w] > 1 for w in windows), bool, len(windows))
    return int((np.r_[hit, False, False] | np.r_[False, hit, False] | np.r_[False, False, hit]).sum())


def _dup_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _script(text: str) -> str:
    """Dominant script of the letters, by the first word of their Unicode names."""
    n = Counter(text)
    by = Counter()
    for c, k in n.items():
        if c.isalpha():
            by[unicodedata.name(c, "OTHER").split(" ")[0]] += k
    return min(by, key=lambda s: (-by[s], s)) if by else "NONE"


def measure(raw: bytes, fertility: Fertility, need_script: bool = False) -> tuple:
    """The figures of ``FACTS`` for a UTF-8 text."""
    words, ids_n, counts, broken = [], 0, np.zeros(len(fertility.broken), np.int64), 0
    chars = len(raw) - int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80))
    for block in word_blocks(raw):
        words += block
        for at in range(0, len(block), 1 << 16):
            ids = np.array(fertility.tokens(block[at:at + (1 << 16)]), np.int64)
            ids_n += len(ids)
            broken += int(fertility.broken[ids].sum())
            if len(raw) <= 1 << 16:
                counts = np.unique(ids, return_counts=True)[1]
            else:
                counts += np.bincount(ids, minlength=len(counts))
    word_chars = chars - sum(map(raw.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    n = len(words)
    entropy = 0.0
    if ids_n > 1:
        p = counts[counts > 0] / ids_n
        entropy = float(-(p * np.log2(p)).sum() / np.log2(min(ids_n, 256)))
    return (n, word_chars, sum(raw.count(c.encode()) for c in SYMBOLS),
            _dup_lines(raw), _repeat_words(words), ids_n, (word_chars + n) / ids_n if ids_n else 0.0,
            broken / ids_n if ids_n else 0.0, entropy, _script(raw.decode("utf-8", "replace")) if need_script else None)


def figures(docs: DataFrame, text_col: str, lang_col: str | None, out: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` plus column ``out``: struct of ``FACTS``.  The vocabulary file is read on the
    driver (about a megabyte) and broadcast."""
    ship(docs)
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    @F.arrow_udf(f"struct<{FACTS.replace(' long', ':long').replace(' double', ':double').replace(' string', ':string')}>")
    def measured(text: pa.Array, lang: pa.Array) -> pa.Array:
        key = len(shared.value), hash(shared.value)
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Fertility(shared.value)
        rows = [measure(t.as_py() or b"", _WORKER[key], not known.as_py())
                for t, known in zip(text.cast(pa.binary()), lang.is_valid(), strict=True)]
        types = [pa.int64()] * 6 + [pa.float64()] * 3 + [pa.string()]
        cols = list(zip(*rows)) if rows else [[]] * len(types)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                          names=[f.split()[0] for f in FACTS.split(", ")])

    lang = F.lit(None).cast("string") if lang_col is None else quoted(lang_col).cast("string")
    return docs.withColumn(out, measured(quoted(text_col), lang))


def base_failed(n_words: Column, n_repeat: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT * n_words)


def bands(facts: DataFrame, spread: float = 3.0, slack: float = 0.15, byte_slack: float = 0.1) -> DataFrame:
    """One row per group: low_cpt, high_cpt, high_bytes, low_entropy, from rows (grp,
    chars_per_token, byte_share, entropy) by exact quartiles of binned values."""
    measures = ("chars_per_token", "byte_share", "entropy")
    bins = facts.select("grp", F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.round(F.col(m) * BIN).cast("bigint").alias("b")) for m in measures])).alias("x")) \
        .groupBy("grp", "x.m", "x.b").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("grp", "m").orderBy("b")  # rows: bins of one group, whose values have a fixed range
    cum = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy("grp", "m"))
    q = bins.withColumn("cum", cum).withColumn("total", total).groupBy("grp", "m").agg(*[
        (F.min(F.when(F.col("cum") * 4 >= F.col("total") * k, F.col("b"))) / BIN).alias(name)
        for k, name in ((1, "q1"), (2, "q2"), (3, "q3"))])
    q = q.groupBy("grp").pivot("m", list(measures)).agg(F.first(F.struct("q1", "q2", "q3")))

    def below(m):
        return F.least(m["q1"] - F.lit(spread) * (m["q3"] - m["q1"]), m["q2"] * (1 - slack))

    def above(m, least):
        return F.greatest(m["q3"] + F.lit(spread) * (m["q3"] - m["q1"]), least)

    cpt, ent, byt = (F.col(m) for m in ("chars_per_token", "entropy", "byte_share"))
    return q.select("grp", below(cpt).alias("low_cpt"), above(cpt, cpt["q2"] * (1 + slack)).alias("high_cpt"),
                    above(byt, byt["q2"] + byte_slack).alias("high_bytes"), below(ent).alias("low_entropy"))


def judged(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", carry: list[str] = (),
           vocabulary: str = VOCABULARY, **band) -> DataFrame:
    """Columns ``carry`` of ``docs``, the figures, ``grp``, ``base_failed`` and ``kept``."""
    f = figures(docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(carry)], quoted(text_col).alias("text"),
                            (F.lit(None).cast("string") if lang_col is None else quoted(lang_col)).alias("lang")),
                "text", "lang", "f", vocabulary)
    f = stage(f.select(*[f"c{i}" for i in range(len(carry))], "f.*",
                       F.coalesce(F.col("lang"), F.concat(F.lit("script:"), "f.script")).alias("grp"))
              .withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))), "quality-figures")
    b = bands(f.filter("not base_failed"), **band).withColumnRenamed("grp", "g")
    inside = F.col("chars_per_token").between(F.col("low_cpt"), F.col("high_cpt")) \
        & (F.col("entropy") >= F.col("low_entropy")) & (F.col("byte_share") <= F.col("high_bytes"))
    # one row a language or script, repeated for each salt, so that a hot language's rows spread over tasks
    b = b.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = f.withColumn("salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    return salted.join(b, (F.col("grp") == F.col("g")) & (F.col("salt") == F.col("salt_")), "left") \
        .withColumn("kept", F.coalesce(~F.col("base_failed") & inside, F.lit(False))) \
        .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
                *[x for x in f.columns if not (x[0] == "c" and x[1:].isdigit())], "kept")


def passing(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", **params) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    uid = free_name(docs, "__uid")
    kept = stage(with_uid(docs, uid), "quality-input")
    good = judged(kept, text_col, lang_col, [uid], **params).filter("kept").select(uid)
    return kept.join(good, uid, "left_semi").drop(uid)
