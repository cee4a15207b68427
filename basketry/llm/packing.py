"""Order-preserving packing of tokenised documents into sequences by dynamic programming.

The documents of an input partition, in their order, form one stream of tokens, each
document closed by the token ``end``.  The stream is cut into windows of at most
``window`` tokens.  A cut may stand at the end of a document, at the end of a sentence
(behind a token that ends in one of ``.!?`` or a line feed), or, in a sentence
longer than ``hard_gap`` tokens, every ``hard_gap`` tokens.  Each window costs its
padding (none if its length is a power of two, else what is missing to ``window``), plus
``per_window``, plus the truncation penalty of its end: nothing at the end of a
document, ``in_document`` at a sentence's, ``in_sentence`` inside one.

best(j) = pen(j) + per_window + min over cuts i in [j - window, j) of best(i) + window - (j - i).
The inner minimum is that of best(i) + i over a sliding range, which a monotone queue
gives in constant time for each cut; windows of a power of two are at most twelve further transitions.

Memory: the tokens are decided on in blocks of ``BLOCK``; where more follow, the
cheapest cut among the last ``window`` tokens of a block closes it and the rest
opens the next one, so documents run on over blocks and a text of any length passes.

Tokens are those of a byte-level BPE vocabulary (a ``tokenizers`` JSON file, read once on
the driver and broadcast: 50,000 entries); ``tests/llm`` holds them against
``tokenizers`` itself.  The file's merges are applied by ``tiktoken``, which is five times as fast.

The sequence number holds the partition in its upper bits.  A lost task is run again over the same rows, so
its sequences come out alike; an input in no fixed order (a shuffle) should be staged first.

Cases: null and empty texts are the end token alone; bytes that are no UTF-8 read as U+FFFD; repeated rows
and null ids are packed each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import quoted, ship

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed value: how the vocabulary's texts are cut into words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK = 1 << 19


# ---------------------------------------------------------------- tokens
def read_vocabulary(path: str = VOCABULARY) -> tuple[dict[bytes, int], dict[str, int]]:
    """Token bytes -> id, and special token -> id, of a byte-level BPE file.

    Such files write each byte as a printable character: printable Latin-1 as itself, all
    others, in order, as the characters from U+0100.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return ranks, special


_ENCODERS: dict[int, tuple] = {}


def encoder(vocabulary: tuple[dict[bytes, int], dict[str, int]]):
    """(encoding, for each id whether it ends a sentence), built once a worker."""
    import tiktoken

    key = id(vocabulary)
    if key not in _ENCODERS:
        ranks, special = vocabulary
        ends = np.zeros(max([*ranks.values(), *special.values()]) + 1, bool)
        ends[[i for t, i in ranks.items() if t.rstrip(b" ")[-1:] in (b".", b"!", b"?", b"\n")]] = True
        _ENCODERS[key] = (tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special),
                          ends, vocabulary)
    return _ENCODERS[key][:2]


# ---------------------------------------------------------------- cuts
def candidates(n: int, doc_ends: np.ndarray, sentence_ends: np.ndarray, hard_gap: int, in_document: int,
               in_sentence: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in (0, n] where a cut may stand, in order, with their penalties."""
    pen = np.full(n + 1, -1, np.int64)
    pen[sentence_ends] = in_document
    pen[doc_ends] = 0
    if n and pen[n] < 0:
        pen[n] = in_sentence
    soft = np.flatnonzero(pen >= 0)
    soft = soft[soft > 0]
    before = np.concatenate([[0], soft[:-1]])
    for a, b in zip(before[soft - before > hard_gap].tolist(), soft[soft - before > hard_gap].tolist()):
        pen[np.arange(a + hard_gap, b, hard_gap)] = in_sentence
    at = np.flatnonzero(pen >= 0)
    at = at[at > 0]
    return at, pen[at]


def cheapest_cuts(at: np.ndarray, pen: np.ndarray, window: int, per_window: int, open_end: bool = False) -> list[int]:
    """The chosen cuts (the last one closes the last window).

    ``open_end``: more tokens follow, so the last cut is the cheapest among those within a window of the end.
    """
    places = np.concatenate([[0], at])
    index = np.full(int(places[-1]) + 1, -1, np.int64)
    index[places] = np.arange(len(places))
    exact: dict[int, list[int]] = {}
    power = 1
    while power <= window:
        src = places - power
        hit = np.flatnonzero(src >= 0)
        hit = hit[index[src[hit]] >= 0]
        for j, i in zip(hit.tolist(), index[src[hit]].tolist()):
            exact.setdefault(j, []).append(i)
        power *= 2
    where, extra = places.tolist(), [0, *pen.tolist()]
    best, key, came = [0], [0], [0]
    queue: deque[int] = deque()
    for j in range(1, len(where)):
        p = where[j]
        last = key[j - 1]
        while queue and key[queue[-1]] > last:
            queue.pop()
        queue.append(j - 1)
        while where[queue[0]] < p - window:
            queue.popleft()
        i = queue[0]
        cost = key[i] + window - p
        for x in exact.get(j, ()):
            if best[x] < cost:
                cost, i = best[x], x
        cost += per_window + extra[j]
        best.append(cost)
        key.append(cost + p)
        came.append(i)
    j = len(where) - 1
    if open_end:
        near = [x for x in range(max(1, int(np.searchsorted(places, where[-1] - window, "right"))), len(where))]
        j = min(near, key=lambda x: (best[x], -x))
    cuts = []
    while j:
        cuts.append(where[j])
        j = came[j]
    return cuts[::-1]


class Stream:
    """The tokens of one partition that are not yet given out."""

    def __init__(self, options: dict, ends: np.ndarray, first_sequence: int):
        self.opt, self.ends, self.sequence = options, ends, first_sequence
        self.tokens: list[np.ndarray] = []
        self.docs: list[list] = []  # id, tokens of the document, tokens of it given out, tokens of it held
        self.held = 0

    def add(self, ident, tokens: np.ndarray) -> None:
        self.docs.append([ident, len(tokens), 0, len(tokens)])
        self.tokens.append(tokens)
        self.held += len(tokens)

    def pieces(self, final: bool):
        """Rows that are decided: all if ``final``, else whole blocks as long as one more is held."""
        while self.held >= 2 * BLOCK or (final and self.held):
            yield self._cut(self.held if final and self.held < 2 * BLOCK else BLOCK)

    def _cut(self, n: int):
        o, all_tokens = self.opt, np.concatenate(self.tokens)
        block, whole = all_tokens[:n], n == self.held
        bounds = np.cumsum([0] + [d[3] for d in self.docs])
        inside = bounds[(bounds > 0) & (bounds <= n)]
        at, pen = candidates(n, inside, np.flatnonzero(self.ends[block]) + 1, o["hard_gap"], o["in_document"],
                             o["in_sentence"])
        cuts = np.array(cheapest_cuts(at, pen, o["window"], o["per_window"], not whole))
        done = int(cuts[-1])
        edges = np.unique(np.concatenate([[0], cuts, inside[inside < done]]))
        begin, stop = edges[:-1], edges[1:]
        doc = np.searchsorted(bounds, begin, "right") - 1
        seq = np.searchsorted(cuts, begin, "right")
        seq_start = np.concatenate([[0], cuts[:-1]])
        rows = []
        for b, e, d, s in zip(begin.tolist(), stop.tolist(), doc.tolist(), seq.tolist()):
            ident, total, given, _ = self.docs[d]
            rows.append((ident, given + b - int(bounds[d]), e - b, block[b:e].astype("<u4").tobytes(), total,
                         self.sequence + s, b - int(seq_start[s]), int(cuts[s] - seq_start[s])))
        self.sequence += len(cuts)
        kept = int(np.searchsorted(bounds, done, "right") - 1)
        if kept < len(self.docs):
            part = done - int(bounds[kept])
            self.docs[kept][2] += part
            self.docs[kept][3] -= part
        self.docs = self.docs[kept:]
        self.tokens = [all_tokens[done:]]
        self.held -= done
        return rows


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, end: int = 1,
         window: int = 2048, hard_gap: int = 256, per_window: int = 32, in_document: int = 8,
         in_sentence: int = 64) -> DataFrame:
    """One row per piece: id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset, sequence_length and sequence_padded (the length it is padded to)."""
    if not 0 < hard_gap <= window:
        raise ValueError("hard_gap has to lie in 1 to window")
    ship(docs)
    spec = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    options = dict(window=window, hard_gap=hard_gap, per_window=per_window, in_document=in_document, in_sentence=in_sentence)
    read = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("binary").alias("text"))
    schema = T.StructType([T.StructField("id", read.schema["id"].dataType), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType()), T.StructField("sequence_length", T.LongType())])

    def packed(batches):
        from pyspark import TaskContext

        enc, ends = encoder(spec.value)
        stream, kind = Stream(options, ends, TaskContext.get().partitionId() << 33), None
        for batch in batches:
            kind = batch.schema.field(0).type
            for ident, text in zip(batch.column(0), batch.column(1)):
                ids = enc.encode_to_numpy((text.as_py() or b"").decode("utf-8", "replace"), allowed_special="all")
                stream.add(ident.as_py(), np.append(ids, np.uint32(end)).astype(np.uint32))
                for rows in stream.pieces(False):
                    yield out(rows, kind)
        for rows in stream.pieces(True):
            yield out(rows, kind)

    def out(rows, kind):
        types = [kind, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.names)

    n = F.col("sequence_length")
    padded = F.when(n.bitwiseAND(n - 1) == 0, n).otherwise(F.lit(window))
    return read.mapInArrow(packed, schema).withColumn("sequence_padded", padded.cast("long"))
