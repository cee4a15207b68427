"""Spelling variants: words that are one edit apart, found by dense prefix-suffix tiling.

Words.  Runs of Latin letters, A-Z lower-cased; a fixed share of the runs of each
document loses one code point (``thinned``), which plants misspellings.  The words are the
distinct results of at least ``min_length`` code points and ``min_count`` occurrences.

Regions.  Two words of La and at most La + 1 code points are near if their common
prefix and common suffix together reach the longer length minus one.  The edit stands
right behind the common prefix.  A region [lo, hi) of La says where that may be: words
that agree before lo and behind hi meet under the key (La, lo, hi, both parts).  A
word of L code points takes part as the shorter one (La = L) and as the longer one
(La = L - 1); the first two regions are the halves.  The regions of a key
do not overlap, so a pair is seen under exactly one key.

Tiles.  A group's middle parts are laid out as padded code-point matrices, once aligned left
and once aligned right, in tiles of up to ``TILE`` rows; a tile is compared with a tile
in one step, whose first mismatch from either side gives both lengths.  Small groups of
one size are stacked and compared at once.  Groups larger than ``GROUP`` are first cut
into the two halves of their region, again and again; a region of one code point holds at most one
word for each letter and for each pair of letters, so no group grows with the data.
Only totals per word leave a tile, never the pairs.

Cases: null and empty texts hold no words, bytes that are no UTF-8 end a run; texts are read whole,
in blocks; repeated rows count each; a null id reads as ``null`` in the rule of ``thinned``; ties go to the
smallest word; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import groupby
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import quoted, ship, stage

TILE = 64
GROUP = 256
SALTS = 32
CELLS = 1 << 24  # code points compared in one step
HELD = 1 << 18  # distinct words of a task that are held before they are given out
BLOCK = 1 << 22
NONE = np.iinfo(np.int64).max


# ---------------------------------------------------------------- words
def thinned(run: str, doc: int, modulus: int = 97) -> str:
    """``run`` without one code point if ``modulus`` divides the crc32 of ``<doc_id>:<run>``;
    ``doc`` is the crc32 of the part up to the colon."""
    h = zlib.crc32(run.encode(), doc)
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _text_blocks(raw: bytes):
    at = 0
    while at < len(raw):
        end = min(len(raw), at + BLOCK)
        while end < len(raw) and raw[end] not in b" \t\n\r.,":
            end += 1
        yield raw[at:end]
        at = end


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
          modulus: int = 97) -> DataFrame:
    """Columns word, n."""
    ship(docs)

    def count(batches):
        found = re.compile("[a-zÀ-ÿ]{%d,}" % min_length)
        total: Counter = Counter()
        for batch in batches:
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc = zlib.crc32(f"{ident}:".encode())
                for part in _text_blocks((text.as_py() or b"").lower()):  # bytes: A-Z alone
                    for run, n in Counter(found.findall(part.decode("utf-8", "replace"))).items():
                        word = thinned(run, doc, modulus)
                        if len(word) >= min_length:
                            total[word] += n
                    if len(total) >= HELD:
                        yield out(total)
                        total = Counter()
        if total:
            yield out(total)

    def out(total):
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                          ["word", "n"])

    read = docs.select(F.coalesce(quoted(id_col).cast("string"), F.lit("null")).alias("id"),
                       quoted(text_col).cast("binary").alias("text"))
    return read.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")) \
        .filter(F.col("n") >= min_count)


def _met(rows: DataFrame, other: DataFrame, on, how: str) -> DataFrame:
    """A join that is never broadcast.  All its sides grow with the data, and Spark takes staged ones for as large as
    their files: rows repeated under salts or with like keys are packed there to a small part of what they take in memory."""
    return rows.join(other.hint("merge"), on, how)


# ---------------------------------------------------------------- regions
_KEY = ["la", "lo", "hi", "key"]


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, long, la, lo, hi) with the parts before and behind the region as ``key``."""
    return rows.withColumn("key", F.expr(
        "concat(substring(word, 1, lo), substring(word, hi + 1 + IF(long, 1, 0), la - hi))"))


def _first_regions(vocabulary: DataFrame, min_length: int) -> DataFrame:
    size = F.char_length("word")
    roles = vocabulary.select("word", "n", F.explode(F.array(
        F.struct(F.lit(False).alias("long"), size.alias("la")),
        F.struct(F.lit(True).alias("long"), (size - 1).alias("la")))).alias("r")) \
        .select("word", "n", "r.long", "r.la").filter(F.col("la") >= min_length)
    half = F.expr("la div 2").cast("int")
    return _keyed(roles.withColumn("g", F.explode(F.array(
        F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), F.col("la").alias("hi"))))).select(
        "word", "n", "long", "la", "g.lo", "g.hi"))


def regions(vocabulary: DataFrame, min_length: int = 5, group: int = GROUP) -> DataFrame:
    """Rows of all groups that are small enough, or whose region is one code point (staged)."""
    rows, done = stage(_first_regions(vocabulary, min_length), "variant-regions"), []
    while True:
        # a group counts if a shorter word is in it; large ones are few, and salted since they are large
        large = rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("c")).filter((F.col("c") > group) & F.expr("hi - lo > 1"))
        large = stage(large.drop("c").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "variant-large")
        if large.isEmpty():
            done.append(rows)
            break
        on = [*_KEY, "salt"]
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
        done.append(_met(salted, large, on, "left_anti").drop("salt"))
        mid = F.expr("(lo + hi) div 2").cast("int")
        rows = stage(_keyed(_met(salted, large, on, "left_semi").select("word", "n", "long", "la", F.explode(F.array(
            F.struct(F.col("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi")))).alias("g")).select(
            "word", "n", "long", "la", "g.lo", "g.hi")), "variant-regions")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


# ---------------------------------------------------------------- tiles
def _matrices(mids: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Padded code-point matrices of Latin-1 strings, aligned left and (read backwards) aligned right."""
    left = np.array(mids, f"S{width}").view(np.uint8).reshape(-1, width)
    right = np.array([m[::-1] for m in mids], f"S{width}").view(np.uint8).reshape(-1, width)
    return left, right


def _first_mismatch(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(tiles, rows of a, rows of b): length of the common beginning."""
    differ = np.ones((a.shape[0], a.shape[1], b.shape[1], a.shape[2] + 1), bool)  # the last column ends every row
    np.not_equal(a[:, :, None, :], b[:, None, :, :], out=differ[..., :-1])
    return differ.argmax(axis=-1)


def near_in_tiles(left_a, right_a, left_b, right_b, long_b: np.ndarray, m: int, at_end: bool) -> np.ndarray:
    """Whether row i of a tile (shorter words, middle parts of m code points) and row j of the other are one edit
    apart, with the edit in this region."""
    prefix = np.minimum(_first_mismatch(left_a, left_b), m)
    suffix = np.minimum(_first_mismatch(right_a, right_b), m)
    both = prefix + suffix
    longer = long_b[:, None, :]
    here = (prefix < m) | at_end
    return np.where(longer, (both >= m) & here, both == m - 1)


def compare_groups(sizes: list[int], n_short: list[int], mids: list[bytes], longs: np.ndarray, rank: np.ndarray,
                   m: int, at_end: bool) -> tuple[np.ndarray, np.ndarray]:
    """Near words of each row within its group, and the best rank among them.

    The rows of all groups follow each other, the shorter words of a group first; ``m`` is the length of a
    shorter word's middle part.
    """
    width = m + 1
    left, right = _matrices(mids, width)
    count, best = np.zeros(len(mids), np.int64), np.full(len(mids), NONE)
    side = max(1, min(TILE, isqrt(max(1, CELLS // width))))
    # pad row: matches nothing, since its first and last code points differ from all
    left = np.vstack([left, np.full((1, width), 255, np.uint8)])
    right = np.vstack([right, np.full((1, width), 255, np.uint8)])
    longs, rank = np.append(longs, False), np.append(rank, NONE)
    pad = len(mids)
    by_size: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    at = 0
    for size, short in zip(sizes, n_short):
        for a in range(at, at + short, side):
            rows = np.arange(a, min(a + side, at + short))
            for b in range(at, at + size, side):
                cols = np.arange(b, min(b + side, at + size))
                shape = 1 << (max(len(rows), len(cols)) - 1).bit_length()
                by_size.setdefault(min(shape, side), []).append((rows, cols))
        at += size
    for shape, tiles in by_size.items():
        step = max(1, CELLS // (shape * shape * width))
        for t in range(0, len(tiles), step):
            some = tiles[t:t + step]
            a, b = (np.full((len(some), shape), pad) for _ in range(2))
            for i, (r, c) in enumerate(some):
                a[i, :len(r)], b[i, :len(c)] = r, c
            near = near_in_tiles(left[a], right[a], left[b], right[b], longs[b], m, at_end)
            near &= (a != pad)[:, :, None] & (b != pad)[:, None, :]
            if near.any():
                tile, i, j = np.nonzero(near)
                i, j = a[tile, i], b[tile, j]
                np.add.at(count, i, 1)
                np.minimum.at(best, i, rank[j])
                back = longs[j]  # a shorter partner is a row of its own tile
                np.add.at(count, j[back], 1)
                np.minimum.at(best, j[back], rank[i[back]])
    return count, best


def near_words(groups: DataFrame) -> DataFrame:
    """word, n_near and the near word of largest n: best_n, best (ties: the smallest word)."""
    ship(groups)

    def tiles(batches):
        held: list[tuple] = []
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            held += rows
            if len(held) > 1 << 16 and held[0][:4] != held[-1][:4]:
                last = held[-1][:4]
                at = len(held)
                while held[at - 1][:4] == last:
                    at -= 1
                yield from results(held[:at])
                held = held[at:]
        yield from results(held)

    def results(rows):
        for (la, lo, hi), part in groupby(rows, key=lambda r: r[:3]):
            grouped = [sorted(g, key=lambda r: (r[4], r[5])) for _, g in groupby(part, key=lambda r: r[3])]
            grouped = [g for g in grouped if len(g) > 1 and not g[0][4]]
            flat = [r for g in grouped for r in g]
            if not flat:
                continue
            m = hi - lo
            longs = np.array([r[4] for r in flat])
            order = sorted(range(len(flat)), key=lambda i: (-flat[i][6], flat[i][5]))
            rank = np.empty(len(flat), np.int64)
            rank[order] = np.arange(len(flat))
            mids = [r[5][lo:hi + r[4]].encode("latin-1") for r in flat]
            count, best = compare_groups([len(g) for g in grouped], [sum(not r[4] for r in g) for g in grouped], mids,
                                         longs, rank, m, hi == la)
            hit = np.flatnonzero(count)
            if len(hit):
                partner = [flat[order[b]] for b in best[hit].tolist()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([flat[i][5] for i in hit.tolist()], pa.string()), pa.array(count[hit]),
                    pa.array([p[6] for p in partner], pa.int64()), pa.array([p[5] for p in partner], pa.string())],
                    ["word", "c", "best_n", "best"])

    n = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = groups.select(*_KEY, "long", "word", "n").repartition(n, *_KEY).sortWithinPartitions(*_KEY)
    found = dealt.mapInArrow(tiles, "word string, c long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("c").alias("n_near"),
                                     F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("w"))).alias("b")) \
        .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.w").alias("best"))


# ---------------------------------------------------------------- forms and roots
def roots(forms: DataFrame) -> DataFrame:
    """word, root for every word of ``forms`` (word, form): the end of its chain, by pointer doubling.

    A chain ends since the count at least doubles with each step; many words can share a form, so they
    are salted, and a form is looked up once for each salt that its words have.
    """
    cur = stage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "variant-roots")
    while not cur.filter("open").isEmpty():
        going = cur.filter("open").select(
            "word", "root", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int").alias("salt"))
        step = _met(going.select("root", "salt").distinct(),
                    cur.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "inner")
        cur = stage(_met(going, step, ["root", "salt"], "left")
                    .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open"))
                    .unionByName(cur.filter("not open")), "variant-roots")
    return cur.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
             factor: int = 2, modulus: int = 97, group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word.

    ``form``: the near word of largest count (ties: the smallest), if that is at least ``factor``
    times the word's own; ``root``: the last form reached from the word, itself if it has none.
    """
    vocabulary = stage(words(docs, id_col, text_col, min_length, min_count, modulus), "variant-words")
    near = near_words(regions(vocabulary, min_length, group))
    is_form = F.col("best_n") >= factor * F.col("n")
    full = stage(_met(vocabulary, near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "variant-forms")
    linked = roots(full.filter(F.col("form").isNotNull()))
    return _met(full, linked, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                                                    "form_n")
