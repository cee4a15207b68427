"""Secret scan: fixed patterns plus sliding-window entropy.

Base patterns (kinds ``assign``, ``access``, ``hex``) are found leftmost and
without overlap per kind.  Beside them, a window of 20 characters slides along
each candidate string (a run of 20 or more base64-like characters), its counts by
character and by character class updated by one in and one out.  A window has the
class of its own characters: ``entropy_hex`` (hex digits, at least one digit and one
letter), ``entropy_alnum`` (letters and digits, at least one of each), else
``entropy_base64``.  Windows whose Shannon entropy reaches the limit of their class
are reported, those of one class that touch or overlap as one span, unless an
allow-list pattern covers the candidate.  Base spans and fill-ins are cut out of a
candidate first; each part that remains and is a window long is a candidate of its own.

Spans are (kind, start, end) in code points, end exclusive, over the whole text.

Cases: null reads as empty and has no spans; a candidate of any length is
scanned to its end, in time linear in the text; bytes that are no UTF-8 read as
U+FFFD; equal rows give equal spans; other columns pass unread.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import quoted, ship

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64")

WINDOW = 20
#: bits a character, by class, from which a window counts as random
LIMITS = {"entropy_hex": 3.0, "entropy_alnum": 3.7, "entropy_base64": 3.9}
#: candidates that are known not to be secrets
ALLOW = (
    r"[A-Za-z]+",                                        # letters only: words run together
    r"[0-9]+",                                           # plain numbers
    r"[A-Za-z]*[-_=+/]+[A-Za-z-_=+/]*",                  # letters joined by punctuation: slugs, paths, rules
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUIDs
    r"[0-9/_=+-]+",                                      # dates, phone numbers, number ranges
)
#: stretches inside a candidate that are no secret
FILL_IN = re.compile(r"(?i)example|placeholder|x{6,}|0{8,}|1234567")

_IN = np.zeros(256, bool)
_IN[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", np.uint8)] = True
_NLOGN = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
_NAMES = (b"password", b"passwd", b"secret", b"token", b"api")


def _classes(c: str) -> tuple[int, int, int]:
    """(is digit, is letter, is hex digit) of an ASCII character."""
    return int(c.isdigit()), int(c.isalpha()), int(c in "0123456789abcdefABCDEF")


_CLASS = {chr(i): _classes(chr(i)) for i in range(128)}


def random_stretches(s: str, limits=LIMITS) -> list[tuple[str, int, int]]:
    """(kind, start, end): unions, by class, of the windows of ``s`` whose entropy reaches the limit of their class."""
    count, total, out, last = {}, 0.0, [], {}
    digits = letters = hexes = 0
    lowest, full = min(limits.values()) - 1e-9, math.log2(WINDOW)
    for i, c in enumerate(s):
        if i >= WINDOW:
            old = s[i - WINDOW]
            n = count[old]
            count[old] = n - 1
            total += _NLOGN[n - 1] - _NLOGN[n]
            d, a, h = _CLASS[old]
            digits, letters, hexes = digits - d, letters - a, hexes - h
        n = count.get(c, 0)
        count[c] = n + 1
        total += _NLOGN[n + 1] - _NLOGN[n]
        d, a, h = _CLASS[c]
        digits, letters, hexes = digits + d, letters + a, hexes + h
        if i < WINDOW - 1:
            continue
        entropy = full - total / WINDOW
        if entropy < lowest:
            continue
        if digits and letters and digits + letters == WINDOW:
            kind = "entropy_hex" if hexes == WINDOW else "entropy_alnum"
        else:
            kind = "entropy_base64"
        if entropy >= limits[kind] - 1e-9:
            start, k = i - WINDOW + 1, last.get(kind)
            if k is not None and start <= out[k][2]:
                out[k] = (kind, out[k][1], i + 1)
            else:
                last[kind] = len(out)
                out.append((kind, start, i + 1))
    return out


def outside(s: str, holes: list[tuple[int, int]]) -> list[tuple[int, str]]:
    """(offset, text) of what the holes leave of ``s``, where it is a window long."""
    at, out = 0, []
    for i, j in [*sorted(holes), (len(s), len(s))]:
        if i - at >= WINDOW:
            out.append((at, s[at:i]))
        at = max(at, j)
    return out


def scan(raw: bytes, limits=LIMITS, allow=None) -> list[tuple[str, int, int]]:
    """All spans of a UTF-8 text, ordered by start, then kind as listed."""
    text = raw.decode("utf-8", "replace")
    if "\ufffd" in text:
        raw = text.encode()
    arr, found = np.frombuffer(raw, np.uint8), []
    low = raw.lower()
    if (b":" in raw or b"=" in raw) and any(n in low for n in _NAMES):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    edges = np.flatnonzero(~_IN[arr])
    edges = np.concatenate(([-1], edges, [len(arr)]))
    runs = np.flatnonzero(np.diff(edges) > WINDOW)
    extra, at, seen_to = [], 0, 0
    for k in runs:  # every base hex or access match lies inside such a run of ASCII characters
        b0, b1 = int(edges[k]) + 1, int(edges[k + 1])
        at += b0 - seen_to - int(np.count_nonzero((arr[seen_to:b0] & 0xC0) == 0x80))  # code points since the last run
        seen_to = b0
        s = raw[b0:b1].decode("ascii")
        found += [("access", at + m.start(), at + m.end()) for m in ACCESS.finditer(s) if m.end() - m.start() >= 20]
        found += [("hex", at + m.start(), at + m.end()) for m in HEX.finditer(s) if m.end() - m.start() >= 24]
        extra.append((at, s))
    base, ok, seen, live = sorted(x[1:] for x in found), allow or (), 0, []
    for at, s in extra:  # in order, as the base spans are
        while seen < len(base) and base[seen][0] < at + len(s):
            live.append(base[seen])
            seen += 1
        live = [x for x in live if x[1] > at]
        if any(a.fullmatch(s) for a in ok):
            continue
        holes = [(i - at, j - at) for i, j in live]
        if ok:
            holes += [m.span() for m in FILL_IN.finditer(s)]
        for k, part in outside(s, holes):  # each a candidate of its own
            if part == s or not any(a.fullmatch(part) for a in ok):
                found += [(kind, at + k + i, at + k + j) for kind, i, j in random_stretches(part, limits)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "secrets", limits: dict | None = None,
                 allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """``docs`` plus column ``out`` (replaced if there is one): array of struct(kind, start, end), ordered."""
    ship(docs)
    limits = dict(LIMITS, **(limits or {}))

    @F.arrow_udf("array<struct<kind:string,start:int,end:int>>")
    def spans(text: pa.Array) -> pa.Array:
        ok = [re.compile(p) for p in allow]
        offsets, kinds, starts, ends = [0], [], [], []
        for t in text.cast(pa.binary()):
            for k, i, j in scan(t.as_py() or b"", limits, ok):
                kinds.append(k), starts.append(i), ends.append(j)
            offsets.append(len(kinds))
        items = pa.StructArray.from_arrays([pa.array(kinds, pa.string()), pa.array(starts, pa.int32()),
                                            pa.array(ends, pa.int32())], names=["kind", "start", "end"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items)

    return docs.withColumn(out, spans(quoted(text_col)))


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
