"""Phrase collocations counted inside the distinct chunks of a prefix-free parse.

Parse.  A text is lower-cased (A-Z only) and cut into words; the marks that end a
piece stay as separator tokens, and ``overlap`` end tokens close the text.  A new
chunk begins wherever the hash of the next ``overlap`` tokens falls below a limit
(once in ``period`` tokens on average), which depends on the content alone, so equal
stretches of text are cut alike wherever they stand.  A chunk reaches ``overlap``
tokens into the next one, so no chunk is the beginning of another, and every phrase
of up to ``overlap + 1`` words lies whole in the chunk in which it begins.

Dictionary.  Distinct chunks per language with the number of times the parse uses
them.  Phrases are counted inside each distinct chunk once and weighted by that
number; the last ``overlap`` tokens of a chunk belong to its successor, so a phrase
in an overlap is counted there and nowhere else.

Levels.  A phrase cannot be more frequent than a part of it.  Level k therefore
only counts positions where both phrases of k - 1 words are frequent, which is
looked up in a bitmap of fixed size (2^27 bits) over hashes of the frequent phrases:
a collision lets a position through that does not matter, none is ever left out.
Counts are summed by the phrase's own text, so they are exact.

Scores use decimal arithmetic of 38 digits: below 10^15 words in a language and
10^17 occurrences of a phrase they are exact.

Cases: null and empty texts hold no words; a null language is ``und``; bytes that
are no UTF-8 are carried as they are; a very long text is read in blocks that end at
a separator; repeated rows count each; ties are settled as documented in ``score``;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import quoted, ship, stage

MAX_WORDS = 5
PERIOD = 32
SALTS = 16  # parts that a hot key is spread over
BITS = 27  # the bitmap of frequent phrases has 2^BITS bits, at any size of the corpus
BLOCK = 1 << 22  # bytes of text that are looked at together

_BREAK, _END = b".", b"!"  # separators never occur in words, so two of them serve as tokens
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r",
                         b"abcdefghijklmnopqrstuvwxyz .........")
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# ---------------------------------------------------------------- tokens and hashes
def _encoded(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Code and 64-bit hash of every token, and the distinct tokens."""
    arr = tokens.dictionary_encode()
    hashed = np.array([xxhash.xxh64_intdigest(w) for w in arr.dictionary.to_pylist()], np.uint64)
    codes = arr.indices.to_numpy().astype(np.int64)
    return codes, hashed[codes], arr.dictionary


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _K2
    return x ^ (x >> np.uint64(29))


def _rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k tokens that begin at each position (positions that have k tokens)."""
    n = max(0, len(h) - k + 1)
    out = h[:n].copy()
    for j in range(1, k):
        out = out * _K1 + h[j:j + n]
    return out


def _bit_of(rolled: np.ndarray, lang: np.ndarray) -> np.ndarray:
    return (_mixed(rolled ^ lang) >> np.uint64(64 - BITS)).astype(np.int64)


def _lang_hash(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "replace"), 7)


# ---------------------------------------------------------------- the parse
def _blocks(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``BLOCK`` bytes that end at a separator."""
    if len(raw) <= BLOCK:
        yield raw
        return
    text, at = raw.translate(_TABLE), 0
    while at < len(text):
        cut = text.find(_BREAK, at + BLOCK)
        end = len(text) if cut < 0 else cut + 1
        yield text[at:end]
        at = end


def parse(texts: list[bytes], period: int = PERIOD, overlap: int = MAX_WORDS - 1) -> Iterator[tuple[int, bytes]]:
    """(index of the text, chunk) for the chunks of some texts, in order."""
    end = b" " + b" ".join([_END] * overlap) + b" "
    tokens = end.join([*(t.translate(_TABLE).replace(_BREAK, b" . ") for t in texts), b""]).split()
    if not tokens:
        return
    codes, h, words = _encoded(pa.array(tokens, pa.binary()))
    is_end = codes == words.index(pa.scalar(_END, pa.binary())).as_py()
    ends = np.flatnonzero(is_end)[::overlap]  # the first end token of each text
    starts = np.concatenate([[0], ends[:-1] + overlap])
    windows = _rolled(h, overlap)
    at = np.flatnonzero(_mixed(windows) <= np.uint64((1 << 64) // period - 1))
    doc = np.searchsorted(ends, at, side="right")
    inside = doc < len(ends)
    at, doc = at[inside], doc[inside]
    keep = (at > starts[doc]) & (at + overlap <= ends[doc])
    begin = np.concatenate([starts, at[keep]])
    doc = np.concatenate([np.arange(len(ends)), doc[keep]])
    order = np.argsort(begin, kind="stable")
    begin, doc = begin[order], doc[order]
    last = np.append(doc[1:] != doc[:-1], True)
    stop = np.where(last, ends[doc], np.append(begin[1:], 0)) + overlap
    for d, b, e in zip(doc.tolist(), begin.tolist(), stop.tolist()):
        if e - b > overlap:  # a text without words has nothing of its own
            yield d, b" ".join(tokens[b:e])


def chunks(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", period: int = PERIOD,
           overlap: int = MAX_WORDS - 1) -> DataFrame:
    """The dictionary of the parse: lang, chunk (binary), n (times the parse uses it)."""
    ship(docs)

    def cut(batches):
        for batch in batches:
            langs, texts = batch.column(0), batch.column(1)
            held, size = ([], []), 0
            for lang, text in zip(langs, texts):
                for part in _blocks(text.as_py() or b""):
                    held[0].append(lang)
                    held[1].append(part)
                    size += len(part)
                    if size >= BLOCK:
                        yield from rows(*held)
                        held, size = ([], []), 0
            yield from rows(*held)

    def rows(langs, texts):
        found = list(parse(texts, period, overlap))
        if found:
            yield pa.RecordBatch.from_arrays([
                pa.array([langs[d].as_py() for d, _ in found], pa.string()),
                pa.array([c for _, c in found], pa.binary())], ["lang", "chunk"])

    read = docs.select(F.coalesce(quoted(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       quoted(text_col).cast("binary").alias("text"))
    return read.mapInArrow(cut, "lang string, chunk binary").groupBy("lang", "chunk") \
        .agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- counts by level
def _grams(batch: pa.Table, k: int, overlap: int, bitmap) -> pa.RecordBatch | None:
    """Phrases of k words that begin in some chunks (lang, chunk, n), with their weighted counts."""
    split = pc.split_pattern(batch.column("chunk").combine_chunks(), pattern=b" ")
    codes, h, words = _encoded(split.flatten())
    sizes = np.diff(split.offsets.to_numpy())
    chunk = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # tokens to the end of the chunk
    mark = pc.is_in(words, value_set=pa.array([_BREAK, _END], pa.binary())).to_numpy(zero_copy_only=False)[codes]
    n = len(codes) - k + 1
    if n <= 0:
        return None
    ok = left[:n] > overlap  # the rest belongs to the next chunk
    for j in range(k):
        ok &= ~mark[j:j + n]
    coded = batch.column("lang").combine_chunks().dictionary_encode()
    names, lang, times = coded.dictionary, coded.indices.to_numpy().astype(np.int64)[chunk], batch.column("n").to_numpy()
    at = np.flatnonzero(ok)
    if bitmap is not None:
        salt = np.array([_lang_hash(x) for x in names.to_pylist()], np.uint64)
        part = _rolled(h, k - 1)
        for j in (0, 1):
            bit = _bit_of(part[at + j], salt[lang[at]])
            at = at[(bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) != 0]
    if not len(at):
        return None
    # distinct phrases by their tokens, not by a hash; numbered anew where the next product would not fit
    group, size = lang[at] * len(words) + codes[at], len(names) * len(words)
    for j in range(1, k):
        if size > (1 << 62) // len(words):
            distinct, group = np.unique(group, return_inverse=True)
            size = len(distinct)
        group, size = group * len(words) + codes[at + j], size * len(words)
    _, first, group = np.unique(group, return_index=True, return_inverse=True)
    total = np.zeros(len(first), np.int64)
    np.add.at(total, group, times[chunk[at]])
    pos = at[first]
    grams = pc.binary_join_element_wise(*[words.take(pa.array(codes[pos + j])) for j in range(k)], b" ")
    out_lang = names.take(pa.array(lang[pos]))
    if k == 1:  # the words of a language, under the empty phrase
        all_words = np.zeros(len(names), np.int64)
        np.add.at(all_words, lang[at], times[chunk[at]])
        out_lang = pa.concat_arrays([out_lang, names])
        grams = pa.concat_arrays([grams, pa.array([b""] * len(names), pa.binary())])
        total = np.concatenate([total, all_words])
    return pa.RecordBatch.from_arrays([out_lang, grams, pa.array(total)], ["lang", "gram", "n"])


def _level(dictionary: DataFrame, k: int, overlap: int, bitmap) -> DataFrame:
    def count(batches):
        bits = None if bitmap is None else bitmap.value
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= BLOCK:
                yield from counted(held, bits)
                held, size = [], 0
        yield from counted(held, bits)

    def counted(held, bits):
        rows = pa.Table.from_batches(held) if held else None
        # a batch of long chunks is taken apart again
        step = max(1, int(rows.num_rows * BLOCK * 2 / max(1, rows.nbytes))) if rows else 1
        for at in range(0, rows.num_rows if rows else 0, step):
            out = _grams(rows.slice(at, step), k, overlap, bits)
            if out is not None:
                yield out

    return dictionary.select("lang", "chunk", "n").mapInArrow(count, "lang string, gram binary, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("f"))


def _bitmap(counts: DataFrame, k: int) -> np.ndarray:
    """Bits of the frequent phrases of k words: at most 2^(BITS - 6) rows reach the driver."""
    def bits(batches):
        for batch in batches:
            if batch.num_rows:
                h = np.array([[xxhash.xxh64_intdigest(w) for w in g.split(b" ")] for g in batch.column(1).to_pylist()],
                             np.uint64)
                salt = np.array([_lang_hash(x) for x in batch.column(0).to_pylist()], np.uint64)
                rolled = h[:, 0].copy()
                for j in range(1, k):
                    rolled = rolled * _K1 + h[:, j]
                bit = _bit_of(rolled, salt)
                at, place = np.unique(bit >> 6, return_inverse=True)
                word = np.zeros(len(at), np.uint64)
                np.bitwise_or.at(word, place, np.uint64(1) << (bit & 63).astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(word.view(np.int64))], ["at", "word"])

    out = np.zeros(1 << (BITS - 6), np.uint64)
    got = counts.filter(F.length("gram") > 0).select("lang", F.col("gram").cast("binary").alias("gram")) \
        .mapInArrow(bits, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toPandas()
    out[got["at"].to_numpy()] = got["word"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100,
                     max_words: int = MAX_WORDS, period: int = PERIOD) -> DataFrame:
    """Columns lang, k, gram, f: all phrases of 1 to ``max_words`` words with f >= ``min_count``
    (staged), and for each language the number of its words under k = 0 and the empty phrase."""
    sc, overlap = docs.sparkSession.sparkContext, max(1, max_words - 1)
    dictionary = stage(chunks(docs, text_col, lang_col, period, overlap), "parse")
    levels, bitmap = [], None
    for k in range(1, max_words + 1):
        found = _level(dictionary, k, overlap, bitmap).filter((F.col("f") >= min_count) | (F.length("gram") == 0))
        found = stage(found.select("lang", F.when(F.length("gram") == 0, 0).otherwise(k).alias("k"),
                                   F.col("gram").cast("string").alias("gram"), "f"), f"phrases-{k}")
        levels.append(found)
        if bitmap is not None:
            bitmap.unpersist()
        if k < max_words:
            bitmap = sc.broadcast(_bitmap(found, k))
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out


# ---------------------------------------------------------------- scores
def _decimal(col, digits: int):
    return F.col(col).cast(f"decimal({digits},0)")


def score(counts: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut: lang, phrase, k, a, cut, l, r, n, score.

    The score of a cut is floor(1000 * a * n / (l * r)); equal scores go to the smallest cut.
    A frequent part ("the") belongs to a great many candidates, so the looked-up counts are
    repeated under ``SALTS`` salts and a part's candidates spread over them.
    """
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def with_count(rows, part, out):
        side = salted.select(F.col("lang"), F.col("gram").alias(part), "salt", F.col("f").alias(out))
        return rows.join(side, ["lang", part, "salt"])

    cands = counts.filter("k >= 2").select("lang", F.col("gram").alias("phrase"), "k", F.col("f").alias("a"),
                                           F.pmod(F.xxhash64("gram"), F.lit(SALTS)).cast("int").alias("salt"))
    cuts = cands.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))) \
        .withColumns({"first": F.expr("substring_index(phrase, ' ', cut)"),
                      "rest": F.expr("substring_index(phrase, ' ', cut - k)"), "none": F.lit("")})
    full = with_count(with_count(with_count(cuts, "first", "l"), "rest", "r"), "none", "n")
    value = F.expr("CAST((CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(15,0))) "
                   "DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0))) AS BIGINT)")
    best = full.withColumn("score", value).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "k", "a", "l", "r", "n")).alias("b"))
    return best.select("lang", "phrase", "b.k", "b.a", "b.cut", "b.l", "b.r", "b.n", "b.score")


def not_contained(cands: DataFrame) -> DataFrame:
    """Drop what a longer candidate holds that is as frequent.

    A phrase is at most as frequent as its parts, so if any longer candidate that holds it is
    as frequent, so is one that is a single word longer.
    """
    longer = cands.filter("k >= 3")
    inner = longer.select("lang", F.expr("substring_index(phrase, ' ', k - 1)").alias("phrase"), "a").unionByName(
        longer.select("lang", F.expr("substring_index(phrase, ' ', 1 - k)").alias("phrase"), "a")) \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    return cands.join(inner, ["lang", "phrase"], "left") \
        .filter(F.col("longest").isNull() | (F.col("longest") < F.col("a"))).drop("longest")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 100,
                 top: int = 2000, max_words: int = MAX_WORDS, period: int = PERIOD) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score (and cut).

    Order: score and a descending, then the phrase by its bytes.
    """
    counts = frequent_phrases(docs, text_col, lang_col, min_count, max_words, period)
    scored = stage(score(counts), "phrase-scores")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # a language may hold most phrases: the best of each of its SALTS parts first, so SALTS * top rows meet at most
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    best = not_contained(scored).withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    final = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return best.withColumn("rank", final).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "cut")
