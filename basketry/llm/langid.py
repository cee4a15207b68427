"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, every character that is not a letter becomes a space
(runs of them one space) and all 1- to 3-grams of the padded result are hashed
into 2**bits buckets.  Training counts n-grams per language in parallel over a
bounded sample of the labelled rows (``sample_per_lang`` rows expected per
language, drawn by the hash of the id); the smoothed log-probability matrix
(languages x buckets) is broadcast, and batches of texts are scored as sparse
count rows times that matrix in numpy.  The score is the posterior of the
predicted language.

Cases: a null text and a text without any letter get ``und`` and score 0; ties
go to the language that is first in code point order; without any training
row every text is ``und``; texts of any length are read whole, in pieces; bytes that
are no UTF-8 read as U+FFFD, which is no letter;
repeated rows get equal results; other columns pass unread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import bucket_crc, quoted, ship

BITS, MAX_N, PIECE = 16, 3, 1 << 17
#: most languages a model may have, which bounds the matrix that is broadcast (MAX_LANGS * 2**BITS * 4 bytes)
MAX_LANGS = 256
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Flags of the code points that are letters (computed once in each worker)."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def code_points(text: str) -> np.ndarray | None:
    """Lower-cased letters with single spaces between words and at both ends; None without a letter."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[cp]
    if not letter.any():
        return None
    cp = np.where(letter, cp, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first space after a word stays
    return np.concatenate((np.array([32], np.uint32), cp[keep], np.array([32] * bool(letter[-1]), np.uint32)))


def buckets(cp: np.ndarray, bits: int = BITS):
    """Yield the bucket numbers of all n-grams, piece by piece."""
    shift = np.uint32(32 - bits)
    for at in range(0, len(cp), PIECE):
        part = cp[at:at + PIECE + MAX_N - 1]
        h, size = np.zeros(len(part), np.uint32), min(PIECE, len(cp) - at)
        for n in range(1, MAX_N + 1):
            if len(part) < n:
                break
            h = h[:len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1:] + np.uint32(n)
            yield ((h * np.uint32(0x9E3779B1)) >> shift)[:size].astype(np.int64)


def train(rows: DataFrame, id_col: str, text_col: str, lang_col: str, sample_per_lang: int = 3000,
          alpha: float = 0.05, bits: int = BITS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, log priors, log-probability matrix) from the labelled ``rows``."""
    ship(rows)
    rows = rows.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"), quoted(lang_col).alias("lang")) \
        .filter("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages: the model would have no bound")
    langs = sorted(counts, key=lambda x: x.encode())
    if not langs:
        return [], np.zeros(0), np.zeros((0, 1 << bits), np.float32)
    # the draw is by hash, so it does not depend on how rows are stored
    space = 1 << 20
    limit = F.create_map(*[F.lit(x) for lang in langs for x in
                           (lang, min(space, -(-space * sample_per_lang // counts[lang])))])
    sample = rows.filter(F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(space)) < limit[F.col("lang")])
    index = {x: i for i, x in enumerate(langs)}

    def count(batches):
        total = np.zeros((len(langs), 1 << bits), np.int64)
        for b in batches:
            for t, lang in zip(b.column("text").cast(pa.binary()), b.column("lang").to_pylist(), strict=True):
                cp = code_points(readable(t))
                if cp is not None:
                    for h in buckets(cp, bits):
                        total[index[lang]] += np.bincount(h, minlength=1 << bits)
        k, h = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(h, pa.int32()), pa.array(total[k, h])],
                                         names=["k", "h", "n"])

    grams = sample.select("text", "lang").mapInArrow(count, "k int, h int, n long") \
        .groupBy("k", "h").agg(F.sum("n").alias("n")).toPandas()  # at most languages x buckets rows
    m = np.full((len(langs), 1 << bits), alpha)
    m[grams["k"].to_numpy(), grams["h"].to_numpy()] += grams["n"].to_numpy()
    prior = np.array([counts[x] for x in langs], float)
    return langs, np.log(prior / prior.sum()), np.log(m / m.sum(axis=1, keepdims=True)).astype(np.float32)


def readable(t: pa.Scalar) -> str | None:
    """The text of a binary value; bytes that are no UTF-8 read as U+FFFD."""
    raw = t.as_py()
    return None if raw is None else raw.decode("utf-8", "replace")


def score_batch(texts, langs, prior, table: np.ndarray) -> tuple[list[str], list[float]]:
    """Predictions for some texts; ``table`` is the matrix with buckets as rows.

    The batch's n-grams are one sparse matrix (text, bucket, 1 each time) whose
    product with the matrix is a gather and a segmented sum."""
    bits = int(table.shape[0]).bit_length() - 1
    names, scores = [], []
    for t in texts:
        cp = code_points(t) if t is not None and langs else None
        if cp is None:
            names.append("und"), scores.append(0.0)
            continue
        ll = prior.copy()
        for h in buckets(cp, bits):
            if len(h) > 4096:  # long piece: count first, then one dense product
                ll += np.bincount(h, minlength=table.shape[0]).astype(np.float32) @ table
            else:
                ll += table[h].sum(axis=0, dtype=np.float64)
        k = int(np.argmax(ll))
        p = np.exp(ll - ll[k])
        names.append(langs[k]), scores.append(float(1 / p.sum()))
    return names, scores


def predict(docs: DataFrame, model, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` plus column ``out``: struct(lang, score)."""
    ship(docs)
    langs, prior, matrix = model
    shared = docs.sparkSession.sparkContext.broadcast((langs, prior, np.ascontiguousarray(matrix.T)))

    @F.arrow_udf("struct<lang:string,score:double>")
    def classify(text: pa.Array) -> pa.Array:
        names, scores = score_batch(map(readable, text.cast(pa.binary())), *shared.value)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                          names=["lang", "score"])

    return docs.withColumn(out, classify(quoted(text_col)))


def held_out(id_col: Column) -> Column:
    """The fold rule of the registered query (a null id is not held out)."""
    return F.coalesce(bucket_crc(id_col, 4) == 2, F.lit(False))
