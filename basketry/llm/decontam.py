"""Benchmark decontamination by latent semantic retrieval.

1. Words (the letters and digits between white space, in lower case) are hashed into ``BUCKETS``
   columns; inverse document frequencies come from all documents.
2. Benchmark items, cut into passages of at most ``PASSAGE`` words, and all documents, whole,
   form a TF-IDF matrix; the rows of the documents weigh as much as ``WEIGHT`` passages together.  Its
   leading right singular vectors come from a distributed randomised SVD: in one pass,
   sketch the rows with a Gaussian matrix and multiply them with their sketches; the
   product with the same Gaussian matrix is the sketch's small Gram matrix, which
   orthonormalises it, and what is left is decomposed.  The sketch stays in a staged table:
   tasks multiply it, the driver decomposes matrices of rank x rank and gets the finished vectors.
3. Every document is read whole as overlapping windows of ``BLOCK``-word blocks, for each
   passage as many as hold a stretch of one and a half passages wherever it begins.
   A window is a candidate for a passage if its cosine with the passage's latent
   image, as a share of the passage's own, reaches ``near``.  Windows are first taken with
   the squares of their words one by one, a norm that repeated words only make larger; the
   cosine of what is left is then taken with the window's whole norm.
4. A subsequence is no longer than the passage's words that the stretch has at all, so
   candidates with too few of them are left out before it is computed.  A candidate counts if the longest common subsequence of words, inside a stretch of
   one and a half passages around the window, covers ``sure`` of the passage, or at least ``maybe`` of it
   while the answer (the item's last sentence) is covered by ``maybe`` too.
   Passages of fewer than ``SHORT`` words have to occur word for word; they are looked up
   by the hash of their words, without the cosine (given as 1).

The index vectors are bounded (BUCKETS x rank).  Benchmark texts are broadcast in
blocks of at most ``BLOCK_BYTES``; a larger benchmark takes several passes.

Cases: null and empty texts and items without a word match nothing; bytes that are no
UTF-8 read as no letter; equal items
are each reported; repeated rows get equal results; an empty benchmark or table
gives no match; a null item id is reported as null; other columns pass unread.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import discard, free_name, quoted, recording, ship, stage

BUCKETS, RANK, EXTRA = 1 << 16, 192, 16
PASSAGE, BLOCK, SHORT, WEIGHT = 64, 16, 8, 256
BLOCK_BYTES = 4 << 20
CACHE_WORDS, PIECE, LONG = 400_000, 1 << 10, 1 << 16
_SPACE = re.compile(rb"[\x09-\x0d\x20]")

MATCH = "struct<item_id:string,part:int,start:int,end:int,cosine:double,lcs:double,answer:double>"


def _number(token: str) -> int:
    """32-bit number of a token's word: its letters and digits in lower case; -1 without any."""
    word = token.lower()
    if not word.isalnum():
        word = "".join(filter(str.isalnum, word))
    return xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass")) if word else -1


class _Numbers(dict):
    """token -> number of its word, kept by a worker for some hundred thousand tokens."""

    def __missing__(self, token: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        n = self[token] = _number(token)
        return n


_NUMBER = _Numbers()


def token_numbers(text: str | None) -> np.ndarray:
    """The white-space separated tokens of a text as numbers; each distinct token is looked at once by a worker."""
    tokens = (text or "").split()
    return np.fromiter(map(_NUMBER.__getitem__, tokens), np.int64, len(tokens))


_LOWER = bytes(32 if 28 <= c <= 31 else c for c in range(128)).lower() + bytes(range(128, 256))
_NO_WORD = bytes(c for c in range(128) if not chr(c).isalnum() and not chr(c).isspace())
# Value of each ASCII code in a word's sum: none for white space.
_VALUE = np.array([c + 1 if chr(c).isalnum() else 0 for c in range(128)], np.uint64)
_ODD = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Of each code point: 1 for a letter or digit, 2 for white space, 0 for anything else."""
    return np.frombuffer(bytes(1 if c.isalnum() else 2 * c.isspace() for c in map(chr, range(0x110000))), np.uint8)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a fixed odd number, and of its inverse, modulo 2^64."""
    return tuple(np.cumprod(np.full(n, x, np.uint64)) for x in (_ODD, pow(_ODD, -1, 1 << 64)))


_kept_powers = lru_cache(maxsize=1)(_powers)


def _piece_words(raw: bytes) -> np.ndarray:
    """The words of a text as numbers, all at once: the sum of a word's letters, each weighed by its place."""
    if raw.isascii():
        value = _VALUE[np.frombuffer(b" " + raw.translate(_LOWER, _NO_WORD), np.uint8)]
    else:
        code = np.frombuffer((" " + raw.decode("utf-8", "replace").lower()).encode("utf-32-le"), np.uint32)
        kind = _classes()[code]
        at = np.flatnonzero(kind)
        value = (code[at].astype(np.uint64) + np.uint64(1)) * (kind[at] == 1)
    there = value > 0
    begin = np.flatnonzero(there[1:] > there[:-1]) + 1
    if not len(begin):
        return np.zeros(0, np.int64)
    weight, back = _kept_powers(2 * LONG) if len(value) <= 2 * LONG else _powers(len(value))
    h = np.add.reduceat(value * weight[:len(value)], begin) * back[begin]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)


def words_of(text: bytes | str | None) -> np.ndarray:
    """The words of a text as 63-bit numbers, in order: what stands between white space, in lower case, without
    what is neither letter nor digit; tokens without either are left out, bytes that are no UTF-8 read as no letter."""
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    out, at = [], 0
    while len(raw) - at > LONG:  # pieces, cut at white space
        cut = _SPACE.search(raw, at + LONG)
        if cut is None:
            break
        out.append(_piece_words(raw[at:cut.end()]))
        at = cut.end()
    out.append(_piece_words(raw[at:] if at else raw))
    return np.concatenate(out) if len(out) > 1 else out[0]


def hashed(words: np.ndarray) -> np.ndarray:
    """Column of each word."""
    return words & (BUCKETS - 1)


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    where: dict[int, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & where.get(w, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def passages(item: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(words, answer words) of the passages of an item; the answer is its last sentence with a word."""
    words = words_of(item)
    parts = (words_of(s) for s in reversed(re.split(r"[.!?]\s|[.!?]$|\n", item or "")))
    answer = next((w for w in parts if len(w)), words[:0])
    n = max(1, -(-len(words) // PASSAGE))
    cuts = [len(words) * i // n for i in range(n + 1)]
    return [(words[a:b], answer) for a, b in zip(cuts, cuts[1:]) if b > a]


# ---------------------------------------------------------------- statistics and index
def counted_rows(docs: DataFrame, text: str) -> DataFrame:
    """(columns, counts) of each text's words, as 16-bit and 32-bit numbers."""
    def count(batches):
        there = np.zeros(BUCKETS, np.int32)
        for b in batches:
            ks, ns = [], []
            for t in b.column(0).cast(pa.binary()):
                h = hashed(words_of(t.as_py()))
                if len(h) > 4096:
                    there = np.bincount(h, minlength=BUCKETS)
                    k = np.flatnonzero(there)
                    n = there[k]
                else:
                    k, n = np.unique(h, return_counts=True)
                ks.append(k.astype(np.uint16).tobytes()), ns.append(n.astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ks, pa.binary()), pa.array(ns, pa.binary())], names=["k", "n"])

    return docs.select(text).mapInArrow(count, "k binary, n binary")


def _bytes_of(column: pa.Array) -> bytes:
    return b"".join(column.to_pylist())


def document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """Documents that hold each bucket, and documents in all."""
    return frequencies(counted_rows(docs, text))


def frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """The same of ``counted_rows``.  Each task sends one vector."""
    def count(batches):
        df, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            df += np.bincount(np.frombuffer(_bytes_of(b.column(0)), np.uint16), minlength=BUCKETS)
            n += b.num_rows
        k = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, k]), pa.array(np.r_[n, df[k]])], names=["k", "n"])

    rows = rows.select("k").mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS, np.int64)
    at = rows["k"].to_numpy() >= 0
    out[rows["k"].to_numpy()[at]] = rows["n"].to_numpy()[at]
    return out, int(rows["n"][~at].sum())


def tfidf(ids: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.unique(ids, return_counts=True)
    v = n * idf[k]
    norm = np.sqrt((v * v).sum())
    return k, v / norm if norm else v


def randomized_svd(rows: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 11) -> np.ndarray:
    """Leading right singular vectors (BUCKETS, rank) of the TF-IDF rows of ``rows`` (ids array<int>)."""
    def counted(batches):
        for b in batches:
            both = [np.unique(np.array(ids.as_py(), np.int64), return_counts=True) for ids in b.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.astype(np.uint16).tobytes() for k, _ in both], pa.binary()),
                 pa.array([n.astype(np.uint32).tobytes() for _, n in both], pa.binary()),
                 pa.array(np.ones(len(both)))], names=["k", "n", "weight"])

    return svd_of_counts(rows.mapInArrow(counted, "k binary, n binary, weight double"), idf, rank, seed)


def svd_of_counts(rows: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 11) -> np.ndarray:
    """The same for rows (k, n: columns and counts; weight: of the row's square in the Gram matrix), read once."""
    ship(rows)
    width = rank + EXTRA
    shared = rows.sparkSession.sparkContext.broadcast(idf)
    omega_of = lambda: np.random.default_rng(seed).standard_normal((BUCKETS, width), np.float32)

    def product(batches):
        omega, idf, p = omega_of(), shared.value, np.zeros((BUCKETS, width), np.float32)
        for b in batches:
            for k, n, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                k = np.frombuffer(k, np.uint16)
                v = np.frombuffer(n, np.uint32) * idf[k]
                v = (v * (math.sqrt(w) / max(math.sqrt((v * v).sum()), 1e-300))).astype(np.float32)
                p[k] += v[:, None] * (v @ omega[k])  # a row's columns are unlike
        k = np.flatnonzero(p.any(axis=1))
        for at in range(0, len(k), 1 << 12):
            part = k[at:at + (1 << 12)]
            yield _rows(part, p[part])

    def total(kind):
        def run(batches):
            acc: dict[int, np.ndarray] = {}
            for b in batches:
                for k, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    v = np.frombuffer(v.as_py(), kind).astype(float)
                    acc[k] = acc[k] + v if k in acc else v
            yield _rows(list(acc), acc.values())
        return run

    def summed(part, kind):
        return part.repartition("k").mapInArrow(total(kind), "k long, v binary")

    def matrix(b):
        return b.column(0).to_numpy(), np.frombuffer(_bytes_of(b.column(1))).reshape(-1, width)

    def small(prepare):
        """Sum of x(k, v)' y(k, v) over the rows of the sketch, added up by tasks: the driver gets one matrix."""
        def run(batches):
            sides, acc = prepare(), np.zeros((width, width))
            for b in batches:
                x, y = sides(*matrix(b))
                acc += x.T @ y
            yield _rows(range(width), acc)

        out = np.zeros((width, width))
        for r in summed(sketch.mapInArrow(run, "k long, v binary"), float).collect():
            out[r["k"]] = np.frombuffer(r["v"])
        return out

    def gram():
        omega = omega_of()
        return lambda k, v: (omega[k].astype(float), v)

    # a task sends a table of BUCKETS x width: half as many tasks as cores, whatever the input
    few = max(1, rows.sparkSession.sparkContext.defaultParallelism // 2)
    with recording() as written:
        sketch = stage(summed(rows.select("k", "n", "weight").coalesce(few).mapInArrow(product, "k long, v binary"), np.float32),
                       "decontam-sketch")
    g = small(gram)  # the Gram matrix of the rows' sketches
    val, vec = np.linalg.eigh((g + g.T) / 2)
    keep = val > max(1e-6 * val.max(initial=0), 1e-12)
    out = np.zeros((BUCKETS, rank), np.float32)
    if keep.any():
        turn = np.zeros((width, width))
        turn[:, :keep.sum()] = vec[:, keep] / np.sqrt(val[keep])
        val, vec = np.linalg.eigh(small(lambda: lambda k, v: (v @ turn,) * 2))
        top = [i for i in np.argsort(-val)[:rank] if val[i] > 1e-9 * val.max()]
        turn = turn @ (vec[:, top] / np.sqrt(val[top]))

        def turned(batches):
            for b in batches:
                k, v = matrix(b)
                yield _rows(k, (v @ turn).astype(np.float32))

        for r in sketch.mapInArrow(turned, "k long, v binary").toLocalIterator():  # at most BUCKETS rows
            out[r["k"], :len(top)] = np.frombuffer(r["v"], np.float32)
    discard(rows.sparkSession, written)
    return out


def _rows(keys, vectors) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([v.tobytes() for v in vectors], pa.binary())],
                                      names=["k", "v"])


def _rolled(words: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of n words."""
    size = max(0, len(words) - n + 1)
    h = np.zeros(size, np.uint64)
    for j in range(n):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD1342543DE82EF95) + words[j:j + size].astype(np.uint64)
    return h


class Index:
    """The latent images of some passages, and what checking candidates needs."""

    def __init__(self, items: list[tuple[str | None, str]], columns: np.ndarray, vectors: np.ndarray, idf: np.ndarray):
        """``vectors``: the rows of the basis that are not zero, those of ``columns``."""
        self.slot = np.zeros(BUCKETS + 1, np.int64)  # column -> row of ``table``, whose first row is zero
        self.slot[columns] = np.arange(1, len(columns) + 1)
        basis = np.vstack([np.zeros((1, vectors.shape[1]), np.float32), vectors])
        self.ids, self.parts, self.words, self.answers, image = [], [], [], [], []
        for item, text in items:
            for p, (words, answer) in enumerate(passages(text)):
                k, v = tfidf(hashed(words), idf)
                self.ids.append(item), self.parts.append(p), self.words.append(words.tolist()), self.answers.append(answer.tolist())
                image.append(v @ basis[self.slot[k]])
        self.table = basis * np.append(0, idf[columns])[:, None].astype(np.float32)
        self.square = np.append(idf * idf, 0).astype(np.float32)
        self.image = np.array(image, np.float32).reshape(-1, basis.shape[1])
        own = (self.image * self.image).sum(axis=1)  # a passage's cosine with its own image
        self.image /= np.maximum(own, 1e-6)[:, None]
        self.own = own
        size = np.array([len(w) for w in self.words], np.int64)
        blocks = -(-(size * 3 // 2 + BLOCK - 1) // BLOCK)
        self.scales = [(int(m), p, self.image[p].T.copy()) for m in np.unique(blocks[size >= SHORT])
                       for p in [np.flatnonzero((blocks == m) & (size >= SHORT))]]
        self.reach = max((m for m, _, _ in self.scales), default=1)
        self.coded = hashed(np.array([w for t in self.words for w in t], np.int64))
        self.first, self.size = np.cumsum(size) - size, size
        self.short: dict[int, dict[tuple, list[int]]] = {}  # by length, the short passages of the same words
        for p in np.flatnonzero(size < SHORT).tolist():
            self.short.setdefault(len(self.words[p]), {}).setdefault(tuple(self.words[p]), []).append(p)
        self.hashes = {n: np.sort(_rolled(np.array([w for t in by for w in t], np.int64), n)[::n])
                       for n, by in self.short.items()}

    def held(self, ids: np.ndarray) -> np.ndarray:
        """How many words of each passage have their column among ``ids``: no common subsequence is longer."""
        there = np.zeros(BUCKETS, np.uint8)
        there[ids] = 1
        return np.add.reduceat(there[self.coded], self.first, dtype=np.int64)

    def candidates(self, ids: np.ndarray, near: float, maybe: float):
        """(first word, words, passage, bound) of all windows whose cosine may be at least ``near`` of the
        passage's own: the bound on that share leaves the products of repeated words out of the norm.
        Of each piece of a text, only passages that have a share of ``maybe`` of their words around it are asked for."""
        if not self.scales:
            return
        long = self.reach * BLOCK
        for at in range(0, len(ids), PIECE):
            alive = self.held(ids[max(0, at - PASSAGE):at + PIECE + long + PASSAGE]) >= maybe * self.size
            scales = [(m, which[alive[which]], image[:, alive[which]]) for m, which, image in self.scales if alive[which].any()]
            if not scales:
                continue
            part = ids[at:at + PIECE + (self.reach - 1) * BLOCK]  # more blocks, for the windows across the cut
            part = np.concatenate((part, np.full(-len(part) % BLOCK, BUCKETS)))  # a column without weight
            block = self.table[self.slot[part]].reshape(-1, BLOCK, self.table.shape[1]).sum(axis=1)
            norm = self.square[part].reshape(-1, BLOCK).sum(axis=1)
            sums, squares, n = block, norm, 1
            for m, which, image in scales:  # in order of size
                while n < m and len(sums) > 1:
                    sums, squares, n = sums[:-1] + block[n:], squares[:-1] + norm[n:], n + 1
                cos = (sums @ image) / np.sqrt(np.maximum(squares, 1e-9))[:, None]
                w, p = np.nonzero(cos >= near)
                yield from zip((at + w * BLOCK).tolist(), repeat(n * BLOCK), which[p].tolist(), cos[w, p].tolist())

    def norms(self, ids: np.ndarray) -> tuple[float, float]:
        """(norm of the window's TF-IDF vector, norm without the products of repeated words)."""
        k, n = np.unique(ids, return_counts=True)
        square = self.square[k].astype(float)
        return math.sqrt(float((square * n * n).sum())), math.sqrt(max(float((square * n).sum()), 1e-9))

    def word_for_word(self, words: np.ndarray, said_by: list[int]) -> dict[int, tuple[int, int]]:
        """First place of each short passage that occurs."""
        out: dict[int, tuple[int, int]] = {}
        for n, by in self.short.items():
            for i in np.flatnonzero(np.isin(_rolled(words, n), self.hashes[n])).tolist():
                for p in by.get(tuple(said_by[i:i + n]), ()):
                    out.setdefault(p, (i, i + n))
        return out

    def matches(self, text: bytes | str | None, near: float, sure: float, maybe: float) -> list[tuple]:
        words = words_of(text)
        if not len(words) or not len(self.image):
            return []
        best: dict[int, tuple] = {}
        said_by: list[int] = words.tolist() if self.short else []
        for p, (i, j) in self.word_for_word(words, said_by).items():
            best[p] = (self.ids[p], self.parts[p], i, j, 1.0, 1.0, 1.0)
        ids, there, sizes = hashed(words), {}, {}
        for at, long, p, share in self.candidates(ids, near, maybe):
            need, answer = self.words[p], self.answers[p]
            if p in best and best[p][5] == 1:
                continue
            a, b = max(0, at - len(need)), min(len(words), at + (-(-(len(need) * 3 // 2 + BLOCK - 1) // BLOCK)) * BLOCK + len(need))
            said_by = said_by or words.tolist()
            region = said_by[a:b]
            if (a, b) not in there:  # the words of a region, for all passages that ask for it
                if len(there) > 256:
                    there.clear(), sizes.clear()
                there[a, b] = frozenset(region)
            if sum(map(there[a, b].__contains__, need)) < maybe * len(need):
                continue
            if (at, long) not in sizes:
                sizes[at, long] = self.norms(ids[at:at + long])
            whole, apart = sizes[at, long]
            share *= apart / max(whole, 1e-9)
            if share < near:
                continue
            cos = min(1.0, share * float(self.own[p]))
            if lcs(need, region) >= maybe * len(need):
                # the match has to lie close together: stretches of one and a half passages
                long, step = len(need) * 3 // 2, max(1, len(need) // 4)
                found = [(a + i, min(b, a + i + long), lcs(need, x) / len(need), lcs(answer, x) / len(answer))
                         for i in range(0, max(1, len(region) - long + step), step) for x in [region[i:i + long]]]
            else:
                continue
            for i, j, share, said in found:
                if (share >= sure or share >= maybe and said >= maybe) and (p not in best or share > best[p][5]):
                    best[p] = (self.ids[p], self.parts[p], i, j, cos, share, said)
        out = list(best.values())
        return sorted(out, key=lambda m: (str(m[0]), m[1]))


# ---------------------------------------------------------------- operator
def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", out: str = "leaks", near: float = 0.25, sure: float = 0.75, maybe: float = 0.6,
               rank: int = RANK, weight: int = WEIGHT) -> DataFrame:
    """``docs`` plus column ``out``: array of ``MATCH``, the benchmark passages found in each text
    (word positions; item ids as text).  The index is fitted on the whole benchmark and all documents,
    which weigh as much as ``weight`` passages."""
    ship(docs)
    spark = docs.sparkSession
    items = benchmark.select(quoted(item_id).cast("string").alias("id"), quoted(item_text).alias("text")) \
        .filter("text is not null")
    text = docs.select(quoted(text_col).alias("text"))
    with recording() as written:
        counts = stage(counted_rows(text, "text"), "decontam-counts")
    df, n = frequencies(counts)
    idf = np.log((1 + n) / (1 + df)) + 0.1

    def cut(batches):  # passages as columns and counts
        for b in batches:
            both = [np.unique(hashed(p), return_counts=True) for t in b.column("text").to_pylist() for p, _ in passages(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.astype(np.uint16).tobytes() for k, _ in both], pa.binary()),
                 pa.array([c.astype(np.uint32).tobytes() for _, c in both], pa.binary())], names=["k", "n"])

    train = items.select("text").mapInArrow(cut, "k binary, n binary").withColumn("weight", F.lit(1.0)) \
        .unionByName(counts.withColumn("weight", F.lit(weight / max(1, n))))
    basis = svd_of_counts(train, idf, rank)
    discard(spark, written)
    columns = np.flatnonzero(basis.any(axis=1))  # words of the training passages
    basis = basis[columns]

    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
    blocks = max(1, -(-size // BLOCK_BYTES))
    index = spark.sparkContext.broadcast((columns, basis, idf))
    parts, cols = [], [quoted(c) for c in docs.columns if c.lower() != out.lower()]
    result = docs.select(*cols)
    for k in range(blocks):  # one pass over the documents for each block of benchmark text
        block = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()
        shared = spark.sparkContext.broadcast(sorted(((r["id"], r["text"]) for r in block), key=str))
        name = free_name(result, f"__leaks{k}")
        result = result.withColumn(name, _matcher(shared, index, near, sure, maybe)(quoted(text_col)))
        parts.append(name)
    return result.select(*cols, F.flatten(F.array(*[F.col(p) for p in parts])).alias(out))


def _matcher(shared, index, near: float, sure: float, maybe: float):
    held: list[Index] = []

    @F.arrow_udf(f"array<{MATCH}>")
    def matches(text: pa.Array) -> pa.Array:
        if not held:
            held.append(Index(shared.value, *index.value))
        found = [held[0].matches(t.as_py(), near, sure, maybe) for t in text.cast(pa.binary())]
        offsets = np.cumsum([0, *map(len, found)])
        flat = list(zip(*[m for f in found for m in f])) or [[]] * 7
        types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(c, t) for c, t in zip(flat, types, strict=True)],
            names=["item_id", "part", "start", "end", "cosine", "lcs", "answer"]))

    # not to be evaluated again inside filters that the optimizer derives from what follows
    return matches.asNondeterministic()


def clean_rows(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` in which no benchmark passage is found."""
    out = free_name(docs, "__leaks")
    return find_leaks(docs, benchmark, text_col, out=out, **params).filter(F.size(out) == 0).drop(out)
