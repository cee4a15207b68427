"""Toxicity: a subsequence string-kernel SVM with Nystroem landmarks.

The kernel between two words counts their common letter triples in order, gaps
allowed, each occurrence weighing ``DECAY`` to the length it spans, normalised to
1 for equal words.  Letters inserted into an insult, or taken out of it, only
lower the kernel; letters parted by punctuation or spaces are read as one word.

Training data are the sentences of labelled texts.  A toxic sentence is a bag of
words of which some are insults, a clean one a bag without any.  A word counts once
for each distinct pair of neighbours it is seen between (so that exact and near
copies of a text add nothing), as toxic only if all texts that hold it there are:

1. words found in toxic sentences far more often than chance allows (likelihood
   ratio) are the insults seen; the ``landmarks`` strongest are the landmarks, and all of
   them and their spellings with one letter inserted are the positive examples;
2. an SVM with squared hinge loss over the Nystroem features (kernel to the
   landmarks times the inverse root of their kernel matrix) parts them from words
   of clean sentences; then the clean words it finds most toxic join the training
   words and it is fitted again;
3. the values of a text's three most toxic words (repeats counted) and the log of
   its length are the input of a logistic regression fitted on the sample's texts,
   never falling in a word's value, which gives the score: one chance likeness in a
   long text weighs less than several in a short one.

The model learns from a bounded sample of labelled rows (``sample`` toxic and twice as many
clean texts expected, drawn by the hash of the id); of the sample's clean words, ``negatives``
drawn by hash and as many of the most toxic are the negative examples.  Scoring reads whole texts.

Cases: texts that are null, empty or without a word of three letters get the values
of words that resemble no landmark; words of any length are read whole, in
overlapping stretches, in training too; bytes that are no UTF-8 read as no letter; if training finds no insult, every text gets the share of
toxic texts in the sample (0 without any); several labels of a document count as
toxic if half of them do; null labels are ignored; repeated rows get equal
scores; other columns pass unread.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import quoted, ship, stage

DECAY, LANDMARKS, SAMPLE = 0.7, 64, 4000
MIN_RATIO, MIN_ODDS = 20.0, 8.0  # likelihood ratio and odds from which a word is an insult
STRETCH, STEP = 24, 8
SPAN, POWER = 7, 2  # longest stretch of a triple; exponent of the normalised kernel
TOP = 3  # most toxic words that a text's score looks at
INSERTED = "aeox"  # letters put into insults to make positive examples
CACHE_WORDS = 400_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORKER: dict = {}


# ---------------------------------------------------------------- words
_LOWER = bytes(range(256)).lower()
_NO_LETTER = bytes(c for c in range(128) if not chr(c).isalpha())


def letters(token: bytes) -> str:
    """The letters of a token in lower case, everything else left out; bytes that are no UTF-8 read as no letter."""
    if token.isascii():
        return token.translate(_LOWER, _NO_LETTER).decode()
    return "".join(c for c in unicodedata.normalize("NFC", token.decode("utf-8", "replace")).lower() if c.isalpha())


def spaced_out(raw: bytes) -> list[bytes]:
    """Runs of three or more single characters parted by single spaces, joined."""
    edge = np.flatnonzero(_SPACE[np.frombuffer(raw, np.uint8)])
    one = np.diff(np.concatenate(([-1], edge, [len(raw)]))) == 2
    if not (one[:-2] & one[1:-1] & one[2:]).any():
        return []
    out, run = [], []
    for w in raw.split() + [b"--"]:
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) >= 3:
            out.append(b"".join(run))
        run = []
    return out


# ---------------------------------------------------------------- kernel
@lru_cache(maxsize=64)
def _triples(n: int):
    """Places of the letter triples of a word of n letters with both its edges marked, and their weights."""
    t = np.array([c for c in combinations(range(n + 2), 3) if c[2] - c[0] < SPAN], np.int64)
    return t[:, 0], t[:, 1], t[:, 2], DECAY ** (t[:, 2] - t[:, 0] + 1)


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length -> (n, triples) codes; a letter is one of 64 classes, word edges are two more."""
    n = len(words[0])
    a = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64).reshape(-1, n)
    a = np.where((a >= 97) & (a <= 122), a - 96, 29 + a % 35)
    a = np.hstack([np.full((len(a), 1), 27), a, np.full((len(a), 1), 28)])
    i, j, k, _ = _triples(n)
    return ((a[:, i] << 12) | (a[:, j] << 6) | a[:, k]).astype(np.int32)


class Kernel:
    """Normalised kernel values of words against fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        # code -> where its landmarks begin in ``mark`` and ``share``, and how many they are
        self.first, self.many = np.zeros(1 << 18, np.int32), np.zeros(1 << 18, np.int32)
        self.landmarks = len(landmarks)
        rows: dict[int, list[tuple[int, float]]] = {}
        for m, z in enumerate(landmarks):
            code, w = _codes([z])[0], _triples(len(z))[3]
            total = {}
            for c, x in zip(code.tolist(), w.tolist(), strict=True):
                total[c] = total.get(c, 0.0) + x
            norm = sum(x * x for x in total.values()) ** 0.5
            for c, x in total.items():
                rows.setdefault(c, []).append((m, x / norm))
        self.mark = np.array([m for r in rows.values() for m, _ in r], np.int64)
        self.share = np.array([x for r in rows.values() for _, x in r])
        many = np.array([len(r) for r in rows.values()], np.int32)
        self.first[list(rows)], self.many[list(rows)] = np.cumsum(many) - many, many

    def __call__(self, words: list[str]) -> np.ndarray:
        """(len(words), landmarks); words have 3 to ``STRETCH`` letters."""
        out = np.zeros((len(words), self.landmarks))
        size = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            w = _triples(int(n))[3]
            for part in np.array_split(at, -(-len(at) * len(w) // (1 << 20))):
                code = _codes([words[i] for i in part])
                many = self.many[code]
                r, c = np.nonzero(many)
                if not len(r):
                    continue
                # each triple meets the few landmarks that have it
                many = many[r, c]
                end = np.cumsum(many)
                at_landmark = np.arange(end[-1]) + np.repeat(self.first[code[r, c]] - (end - many), many)
                dot = np.bincount(np.repeat(r, many) * self.landmarks + self.mark[at_landmark],
                                  np.repeat(w[c], many) * self.share[at_landmark], len(part) * self.landmarks)
                dot = dot.reshape(len(part), self.landmarks)
                some = np.flatnonzero(dot.any(axis=1))
                out[part[some]] = (dot[some] / self.norms(code[some], w)[:, None]) ** POWER
        return out

    @staticmethod
    def norms(code: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The words' own norms: weights of equal triples add up before they are squared."""
        out = np.full(len(code), np.sqrt((w * w).sum()))
        tidy = np.sort(code, axis=1)
        twice = np.flatnonzero((tidy[:, 1:] == tidy[:, :-1]).any(axis=1))  # words that hold a triple twice
        if len(twice):
            order = np.argsort(code[twice], axis=1)
            code, weight = tidy[twice], w[order]
            new = np.ones(code.shape, bool)
            new[:, 1:] = code[:, 1:] != code[:, :-1]
            total = np.add.reduceat(weight.ravel(), np.flatnonzero(new))
            owner = np.r_[0, np.cumsum(new.sum(axis=1))[:-1]]
            out[twice] = np.sqrt(np.add.reduceat(total * total, owner))
        return out


def stretches(word: str) -> list[str]:
    if len(word) <= STRETCH:
        return [word]
    return [word[i:i + STRETCH] for i in range(0, len(word) - STRETCH + STEP, STEP)]


class Model:
    """landmarks, weights over raw kernel values (Nystroem map folded in), bias, logistic curve."""

    def __init__(self, landmarks, weights, bias, curve=None, base=0.0):
        self.landmarks, self.weights, self.bias, self.curve, self.base = landmarks, weights, bias, curve, base
        self.kernel = Kernel(landmarks) if landmarks else None
        self.cache: dict[bytes, float] = {}  # token -> value
        self.known: dict[str, float] = {}  # its letters -> value

    def values(self, words: list[str]) -> np.ndarray:
        """Raw value of each word (letters only)."""
        parts, owner = [], []
        for i, w in enumerate(words):
            if len(w) >= 3:
                s = stretches(w)
                parts += s
                owner += [i] * len(s)
        out = np.full(len(words), self.bias)
        if parts:
            v = self.kernel(parts) @ self.weights + self.bias
            best = np.full(len(words), -np.inf)
            np.maximum.at(best, owner, v)
            out = np.where(np.isfinite(best), best, out)
        return out

    def features(self, texts: list[bytes]) -> np.ndarray:
        """(texts, TOP + 1): values of the most toxic words, log of the number of words."""
        words = [raw.split() + spaced_out(raw) for raw in texts]
        flat, cache, known = list(chain.from_iterable(words)), self.cache, self.known
        new = set(flat).difference(cache)
        if len(cache) + len(new) > CACHE_WORDS:
            cache.clear(), known.clear()
            new = set(flat)
        new = list(new)
        for at in range(0, len(new), 1 << 14):
            part = new[at:at + (1 << 14)]
            read = [letters(w) for w in part]
            fresh = list(set(read).difference(known))
            known.update(zip(fresh, self.values(fresh).tolist(), strict=True))
            cache.update(zip(part, map(known.__getitem__, read), strict=True))
        value = np.fromiter(map(cache.__getitem__, flat), float, len(flat))
        out = np.full((len(texts), TOP + 1), self.bias)
        end = 0
        for i, w in enumerate(words):
            begin, end = end, end + len(w)
            best = value[begin:end]
            if len(w) > TOP:
                best = np.partition(best, len(w) - TOP)[len(w) - TOP:]
            out[i, :len(best)] = np.sort(best)[::-1]
            out[i, TOP] = np.log1p(len(w))
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.kernel is None or self.curve is None:
            return np.full(len(texts), self.base)
        x = np.hstack([self.features(texts), np.ones((len(texts), 1))])
        return 1 / (1 + np.exp(-np.clip(x @ self.curve, -700, 700)))


# ---------------------------------------------------------------- training
def fit_svm(k: np.ndarray, kzz: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3,
            steps: int = 400) -> tuple[np.ndarray, float]:
    """Squared-hinge SVM over Nystroem features, by accelerated gradient steps;
    returns (weights over kernel values, bias)."""
    val, vec = np.linalg.eigh(kzz)
    root = vec @ np.diag(1 / np.sqrt(np.maximum(val, 1e-6))) @ vec.T
    x = np.hstack([k @ root, np.ones((len(k), 1))])
    weight = weight / weight.sum()
    reg = np.r_[np.full(x.shape[1] - 1, ridge), 0.0]
    rate = 1 / (2 * np.linalg.norm(x * np.sqrt(weight)[:, None], 2) ** 2 + ridge)
    w = prev = np.zeros(x.shape[1])
    for t in range(steps):
        v = w + t / (t + 3) * (w - prev)
        slack = np.maximum(0, 1 - y * (x @ v))
        w, prev = v - rate * (-2 * x.T @ (weight * y * slack) + reg * v), w
    return root @ w[:-1], float(w[-1])


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge by damped Newton steps; word values whose
    weight would be negative are left out one by one."""
    x = np.hstack([x, np.ones((len(x), 1))])
    use = list(range(x.shape[1]))
    while True:
        a, c = x[:, use], np.zeros(len(use))
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a @ c, -30, 30)))
            h = a.T @ (a * (p * (1 - p))[:, None]) + 1e-2 * np.eye(len(use))
            step = np.linalg.solve(h, a.T @ (p - y) + 1e-2 * c)
            c = c - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        low = min(((v, k) for v, k in zip(c, use, strict=True) if k < TOP), default=(0.0, 0))
        if low[0] >= 0:
            out = np.zeros(x.shape[1])
            out[use] = c
            return out
        use.remove(low[1])


_SENTENCE_END = b".!?\n"


def sentences(raw: bytes) -> list[bytes]:
    for c in _SENTENCE_END[1:]:
        raw = raw.replace(bytes([c]), b".")
    return [s for s in (x.strip() for x in raw.split(b".")) if s]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE, landmarks: int = LANDMARKS, negatives: int = 4000) -> Model:
    """Fit on the texts of ``docs`` whose id is in ``labels`` (id, 0/1)."""
    ship(docs)
    lab = labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("double").alias("y")) \
        .filter("id is not null and y is not null").groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    count = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = count.get(1, 0) / max(1, sum(count.values()))
    space = 1 << 20
    draw = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(space))
    # clean texts are drawn twice as often: they show what insults are not
    limit = F.when(F.col("y") == 1, F.lit(-(-space * sample // max(1, count.get(1, 0))))) \
        .otherwise(F.lit(-(-space * 2 * sample // max(1, count.get(0, 0)))))
    drawn = stage(lab.filter(draw < limit), "toxicity-sample")
    # the sample's ids are bounded by the parameter: at most about 3 * sample rows of 12 bytes
    chosen = stage(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).filter("text is not null")
                   .join(F.broadcast(drawn), "id"), "toxicity-texts")

    def contexts(batches):
        for b in batches:
            rows: dict[tuple[str, int], int] = {}  # (word, hash of word and neighbours) -> toxic
            for t, y in zip(b.column("text").cast(pa.binary()), b.column("y").to_pylist(), strict=True):
                for s in sentences(t.as_py()):
                    line = [b"", *s.split(), *spaced_out(s), b""]
                    for before, w, after in zip(line, line[1:], line[2:]):
                        word = letters(w)
                        if len(word) >= 3:
                            place = xxhash.xxh64_intdigest(b" ".join((before, w, after))) >> 1
                            for key in zip(stretches(word), repeat(place)):
                                rows[key] = min(y, rows.get(key, y))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in rows], pa.string()),
                                              pa.array([k[1] for k in rows], pa.int64()),
                                              pa.array(list(rows.values()), pa.int32())], names=["w", "c", "y"])

    words = stage(chosen.select("text", "y").mapInArrow(contexts, "w string, c long, y int")
                  .repartition("w")  # one exchange serves both groupings
                  .groupBy("w", "c").agg(F.min("y").alias("y")).groupBy("w")
                  .agg(F.sum("y").alias("k1"), F.sum(1 - F.col("y")).alias("k0")), "toxicity-words")
    total = words.agg(F.coalesce(F.sum("k1"), F.lit(0)).alias("n1"), F.coalesce(F.sum("k0"), F.lit(0)).alias("n0")).first()
    n1, n0 = total["n1"], total["n0"]
    if not n1 or not n0:
        return Model([], np.zeros(0), 0.0, base=base)
    share, k1, k0 = n1 / (n1 + n0), F.col("k1"), F.col("k0")
    ln = lambda k, e: F.when(k > 0, k * F.log(k / ((k1 + k0) * F.lit(e)))).otherwise(0.0)
    insults = words.withColumn("g", 2 * (ln(k1, share) + ln(k0, 1 - share))) \
        .filter((F.col("g") >= MIN_RATIO) & ((k1 + 0.5) / n1 >= MIN_ODDS * (k0 + 0.5) / n0)) \
        .orderBy(F.desc("g"), "w").collect()  # words of the bounded sample
    if not insults:
        return Model([], np.zeros(0), 0.0, base=base)
    bad, strength = [r["w"] for r in insults], np.array([r["k1"] for r in insults], float)
    z = bad[:landmarks]
    kernel = Kernel(z)
    kzz, seen_bad = kernel(z), kernel(bad)
    variants = sorted({w[:i] + c + w[i:] for w in bad for i in range(1, len(w)) for c in INSERTED if len(w) < STRETCH})
    more = kernel(variants)
    clean = words.filter("k1 = 0 or k0 >= k1")
    some = [r["w"] for r in clean.orderBy(F.xxhash64("w"), "w").limit(negatives).collect()]

    def fit(neg: list[str]) -> Model:
        k = np.vstack([seen_bad, more, kernel(neg)])
        y = np.r_[np.ones(len(bad) + len(more)), -np.ones(len(neg))]
        each = np.r_[0.7 * np.sqrt(strength) / np.sqrt(strength).sum(), np.full(len(more), 0.3 / max(1, len(more))),
                     np.full(len(neg), 1 / max(1, len(neg)))]
        return Model(z, *fit_svm(k, kzz, y, each))

    model = fit(some)

    def value(batches):
        for b in batches:
            w = b.column("w").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(model.values(w), pa.float64())],
                                             names=["w", "f"])

    hard = clean.select("w").mapInArrow(value, "w string, f double").orderBy(F.desc("f"), "w").limit(negatives).collect()
    model = fit(sorted({*some, *(r["w"] for r in hard)}))

    names = [f"f{i}" for i in range(TOP + 1)]

    def features(batches):
        for b in batches:
            f = model.features([t.as_py() for t in b.column("text").cast(pa.binary())])
            yield pa.RecordBatch.from_arrays([*[pa.array(f[:, i]) for i in range(TOP + 1)], b.column("y")], names=[*names, "y"])

    # the bounded sample: a few numbers for each of its texts
    seen = chosen.select("text", "y").mapInArrow(features, ", ".join(f"{n} double" for n in names) + ", y int").toPandas()
    curve = fit_curve(seen[names].to_numpy(), seen["y"].to_numpy().astype(float))
    return Model(z, model.weights, model.bias, curve, base)


# ---------------------------------------------------------------- scoring
def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` plus column ``out``: probability-like score in 0..1."""
    ship(docs)
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.landmarks, model.weights, model.bias, model.curve, model.base))

    @F.arrow_udf("double")
    def toxic(text: pa.Array) -> pa.Array:
        state = shared.value
        key = (tuple(state[0]), state[2], None if state[3] is None else tuple(state[3]), state[4])
        if key not in _WORKER:
            _WORKER.clear()
            _WORKER[key] = Model(*state)
        out = [pa.array([], pa.float64())]
        raw = text.cast(pa.binary())
        for at in range(0, len(raw), 256):
            texts = [t.as_py() or b"" for t in raw.slice(at, 256)]
            out.append(pa.array(_WORKER[key].score(texts), pa.float64()))
        return pa.concat_arrays(out)

    return docs.withColumn(out, toxic(quoted(text_col)))
