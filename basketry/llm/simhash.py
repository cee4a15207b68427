"""SimHash near-duplicates found through Golay-code fuzzy hashing.

Fingerprint: 64 bits over the XXH64 values of word shingles; a bit is set if it
is set in more than half of them.  Documents link when their fingerprints differ
in at most 4 bits, and a component is what links reach.

Candidate search.  The fingerprint is cut into three segments (22, 21 and 21
bits), each padded to a 23-bit word of the perfect binary Golay code, whose
codewords lie 7 apart so that every word has exactly one within 3.  Decoding a
segment to *all* codewords within distance 4 gives one to six indices, and two
segments that differ in at most 2 bits always share one (take the codeword next
to the word half way between them).  Likewise, if two segments differ in at most
1 bit, the nearest codeword of one is among the indices of the other.

Pigeonhole: 4 errors over three segments leave two segments with at most 2 errors
together, so they split (0, 0..2) or (1, 1).  Hence two kinds of keys, each of two
segments, and every pair within 4 bits shares at least one:

* (a exact, an index of b) for each ordered pair of segments;
* (nearest codeword of a and of b) on one side against (an index of a, an index
  of b) on the other, for each pair of segments.

Key rows are of distinct fingerprints only, are shuffled by key and sorted.
Within a key, members are compared by XOR and bit count in a search that starts
from one member, takes over everything within 4 bits and goes on with what is
left, so a dense group of copies shrinks as it is read and only a spanning
forest of verified links leaves the task, never all its pairs.

Cases: null and empty texts and texts without words have fingerprint zero, which
links like any other; fewer words than a shingle: the whole sequence is one;
repeated rows fall into one component; null ids are ignored as representatives
unless a component has no other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import components, free_name, quoted, ship, stage, with_uid

MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (shift, width)
GOLAY = 0b101011100011  # generator polynomial x^11+x^9+x^7+x^6+x^5+x+1 of the (23, 12) code
BLOCK = 1 << 22
_POP16 = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


# ---------------------------------------------------------------- fingerprints
def word_blocks(raw: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of about ``size`` bytes."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + size)
        while end < len(raw) and raw[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield raw[at:end].split()
        at = end


def fingerprint(raw: bytes, k: int = 4) -> int:
    """SimHash of a UTF-8 text (only A-Z are lower-cased)."""
    ones, n, tail = np.zeros(64, np.int64), 0, []
    low = raw.lower()
    for block in word_blocks(low):
        words = tail + block
        if len(words) < k:
            tail = words
            continue
        ones, n = _add([b" ".join(s) for s in zip(*[words[i:] for i in range(k)])], ones, n)
        tail = words[len(words) - k + 1:]
    if n == 0:
        if not tail:
            return 0
        ones, n = _add([b" ".join(tail)], ones, n)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def _add(shingles: list[bytes], ones: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    hashed = xxhash.xxh64_intdigest
    for at in range(0, len(shingles), 1 << 14):
        h = np.array([hashed(s, 42) for s in shingles[at:at + (1 << 14)]], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = ones + bits.sum(axis=0, dtype=np.int64)
    return ones, n + len(shingles)


def fingerprints(docs: DataFrame, text_col: str, out: str, k: int = 4) -> DataFrame:
    """``docs`` plus column ``out``: the fingerprint as a signed 64-bit number."""
    ship(docs)

    @F.arrow_udf("long")
    def simhash(text: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py() or b"", k) for t in text.cast(pa.binary())],
                                 np.uint64).view(np.int64))

    return docs.withColumn(out, simhash(quoted(text_col)))


# ---------------------------------------------------------------- Golay keys
def _syndromes(x: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator polynomial."""
    x = x.copy()
    for bit in range(22, 10, -1):
        x ^= np.where((x >> bit) & 1, GOLAY << (bit - 11), 0)
    return x


def _patterns() -> np.ndarray:
    """(2048, 6): for each syndrome the error patterns of weight up to 4, the lightest first, -1 where there are fewer."""
    out, filled = np.full((2048, 6), -1, np.int64), np.zeros(2048, np.int64)
    level = np.array([0], np.int64)
    for _ in range(5):
        s = _syndromes(level)
        for e, k in zip(level.tolist(), s.tolist(), strict=True):
            out[k, filled[k]] = e
            filled[k] += 1
        level = np.unique((level[:, None] | (1 << np.arange(23))[None, :]).ravel())
        level = level[_weight(level.astype(np.uint64)) == _ + 1]
    return out


def _weight(x: np.ndarray) -> np.ndarray:
    m = np.uint64(0xFFFF)
    return sum(_POP16[(x >> np.uint64(s)) & m].astype(np.int16) for s in (0, 16, 32, 48))


def codeword_indices(x: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    """(n, 6) indices of the codewords within distance 4 of 23-bit words, nearest first, -1 for none.
    A codeword's index is its 12 upper bits: the lower 11 follow from them."""
    e = patterns[_syndromes(x)]
    return np.where(e < 0, -1, (x[:, None] ^ e) >> 11)


def key_rows(fps: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, fingerprint, asks) rows of distinct fingerprints.  Keys of the first kind are
    symmetric (asks is true); of the second, only rows that ask look for partners."""
    u = fps.view(np.uint64)
    seg = [((u >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
    idx = [codeword_indices(x, patterns) for x in seg]
    keys, rows, asks = [], [], []

    def emit(tag, high, low, ask):
        keep = np.flatnonzero((high >= 0) & (low >= 0))
        keys.append((np.int64(tag) << 40) | (high[keep] << 12) | low[keep])
        rows.append(fps[keep])
        asks.append(np.full(len(keep), ask))

    for a in range(3):
        for b in range(3):
            if a != b:
                for j in range(6):
                    emit(3 * a + b, seg[a], idx[b][:, j], True)
    for t, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        emit(9 + t, idx[a][:, 0], idx[b][:, 0], True)
        for i in range(6):
            for j in range(6):
                emit(9 + t, idx[a][:, i], idx[b][:, j], False)
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(asks)


# ---------------------------------------------------------------- links inside a key
def group_links(fps: np.ndarray, asks: np.ndarray, bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Spanning forest of the links among the members of one key that an asking member sees."""
    fps, first = np.unique(fps, return_inverse=True)
    ask = np.zeros(len(fps), bool)
    np.logical_or.at(ask, first, asks)
    u, left, out = fps.view(np.uint64), np.arange(len(fps)), []
    todo = []
    while len(left) or todo:
        if todo:
            p = todo.pop()
        else:
            p, left = left[0], left[1:]
        if not len(left):
            break
        near = _weight(u[left] ^ u[p]) <= bits
        if not ask[p]:
            near &= ask[left]
        hit = left[near]
        out.extend((int(fps[p]), int(fps[h])) for h in hit)
        todo.extend(hit.tolist())
        left = left[~near]
    return out


def sorted_links(keys: np.ndarray, fps: np.ndarray, asks: np.ndarray, bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links of whole keys; rows are sorted by key."""
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[start, len(keys)])
    out: list[tuple[int, int]] = []
    u = fps.view(np.uint64)
    group = np.repeat(np.arange(len(start)), size)
    small = size[group] <= 8
    for lag in range(1, 8):  # groups of up to 8: by distance in the sorted order
        i = np.flatnonzero(small[:-lag] & (group[:-lag] == group[lag:])) if len(u) > lag else np.zeros(0, np.int64)
        i = i[(asks[i] | asks[i + lag]) & (u[i] != u[i + lag])]
        i = i[_weight(u[i] ^ u[i + lag]) <= bits]
        out.extend(zip(fps[i].tolist(), fps[i + lag].tolist(), strict=True))
    for g in np.flatnonzero(size > 8):
        s = slice(start[g], start[g] + size[g])
        if asks[s].any():
            out.extend(group_links(fps[s], asks[s], bits))
    return out


def links(distinct: DataFrame, fp: str, bits: int = MAX_BITS) -> DataFrame:
    """(u, v): verified links that connect every pair of ``distinct`` fingerprints within ``bits``."""
    ship(distinct)
    if not 0 <= bits <= MAX_BITS:
        raise ValueError("the keys are complete for up to 4 bits")

    def keys(batches):
        patterns = _patterns()
        for b in batches:
            f = b.column(0).to_numpy()
            for at in range(0, len(f), 1 << 13):
                k, r, a = key_rows(f[at:at + (1 << 13)], patterns)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(r), pa.array(a)], names=["key", "fp", "asks"])

    def compare(batches):
        held = None  # rows of the last key seen, which may go on in the next batch
        for b in batches:
            cur = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if not len(cur[0]):
                continue
            if held is not None:
                cur = [np.concatenate(x) for x in zip(held, cur, strict=True)]
            cut = int(np.searchsorted(cur[0], cur[0][-1]))
            done, held = [x[:cut] for x in cur], [x[cut:] for x in cur]
            if cut:
                yield _edges(sorted_links(*done, bits))
        if held is not None:
            yield _edges(sorted_links(*held, bits))

    rows = distinct.select(F.col(fp).alias("fp")).mapInArrow(keys, "key long, fp long, asks boolean")
    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "u long, v long")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["u", "v"])


# ---------------------------------------------------------------- operator
def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (signed), component (smallest id reachable)."""
    facts = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
    facts = stage(fingerprints(facts, "text", "fp", shingle).select("id", "fp"), "simhash-fps")
    distinct = stage(facts.groupBy("fp").agg(F.min("id").alias("low")), "simhash-distinct")
    comp = components(links(distinct, "fp", bits), "simhash")
    joined = distinct.join(comp.select(F.col("node").alias("fp"), "root"), "fp", "left") \
        .select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = joined.groupBy("root").agg(F.min("low").alias("component"))
    by_fp = joined.join(lows, "root").select("fp", "component")
    # one row per fingerprint on the right; a fingerprint that many documents share is split by AQE's skew join
    return facts.join(by_fp, "fp").select("id", F.col("fp").alias("fingerprint"), "component")


def one_of_each(docs: DataFrame, text_col: str = "text", shingle: int = 4, bits: int = MAX_BITS,
                id_col: str = "doc_id") -> DataFrame:
    """``docs`` without near-duplicates: of each component the row with the smallest id stays
    (null ids last; among equal ids, one)."""
    uid = free_name(docs, "__uid")
    kept = stage(with_uid(docs, uid), "simhash-input")
    ranked = kept.select(F.struct(quoted(id_col).isNull().alias("n"), quoted(id_col).alias("i"),
                                  F.col(uid).alias("u")).alias("who"), quoted(text_col).alias("text"))
    stay = near_duplicates(ranked, "who", "text", shingle, bits) \
        .filter("id = component").select(F.col("component.u").alias(uid))
    return kept.join(stay, uid, "left_semi").drop(uid)


def hex16(fp):
    """A signed 64-bit number as 16 hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
