"""Secret scans: fixed patterns, and a battery of randomness tests for everything else.

Candidates are runs of ``MIN_TOKEN`` or more characters of [A-Za-z0-9+/_=-].
Each has an inferred encoding (hex, base32 or base64; digits alone are none).
The battery tests that it is random: chi-squared uniformity over the encoding's
alphabet, the runs test about the middle symbol, and the lag-one serial
correlation; three times the least of their p-values, or 1, is the battery's.

A discovery is a token that isn't ordinary text.  The likelihood ratio of uniform
symbols to the symbols of ordinary words is an e-value of that: its mean over
ordinary tokens is 1 at most, and it grows with the token's length, so that short
tokens can't reach what long ones do.  Times the battery's p-value, or 0 where that
is under ``ALPHA``, which is never over 1, it stays an e-value: what fails a test
of randomness loses as much evidence, or all.  The Benjamini-Hochberg rule on these products, over all candidates of
all documents, on a histogram of fixed size, keeps the share of false ones under
``RATE``.

Results on unusual input: null texts are empty and have no spans; repeated
rows count as often as they occur; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Kinds of spans, in the order in which those of one start are listed.
KINDS = ("assign", "access", "hex", "random")
MIN_TOKEN = 16
ALPHA = 1e-3
RATE = 0.01
#: Bins of the evidence's decimal logarithms, a tenth each.
BINS = 400

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_NAMES = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")

_TOKEN = np.zeros(129, bool)
_TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True

# Per cent of each letter in ordinary words, from a to z.
_LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.2, 0.8, 4.0, 2.4, 6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 1.0, 2.4, 0.2, 2.0, 0.1)
#: The logarithm of each character's share in ordinary tokens: letters, a tenth of them capitals, few digits and signs.
_ORDINARY = {chr(97 + k): math.log(0.85 * (x + 0.3) / 108) for k, x in enumerate(_LETTERS)}
_ORDINARY |= {chr(65 + k): math.log(0.10 * (x + 0.3) / 108) for k, x in enumerate(_LETTERS)}
_ORDINARY |= {c: math.log(0.003) for c in "0123456789"} | {c: math.log(0.004) for c in "+/_=-"}

ENCODINGS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
_PLACES = {k: {c: i for i, c in enumerate(v)} for k, v in ENCODINGS.items()}


def encoding(token: str) -> str | None:
    """The encoding that the token's characters suggest; None for digits alone or signs alone."""
    body = token.rstrip("=")
    kinds = set(body)
    if not body or kinds <= set("0123456789+/_=-"):
        return None
    if kinds <= set("0123456789abcdef") or kinds <= set("0123456789ABCDEF"):
        return "hex"
    if kinds <= set(ENCODINGS["base32"]) and kinds & set("234567"):
        return "base32"
    return "base64"


def _tail(z: float) -> float:
    """Two-sided p-value of a standard normal."""
    return math.erfc(abs(z) / math.sqrt(2))


def battery(token: str, kind: str) -> tuple[float, float, float]:
    """p-values of randomness: uniformity, runs, serial correlation."""
    body = token.rstrip("=").replace("-", "+").replace("_", "/").replace("=", "")
    body = body.lower() if kind == "hex" else body
    x = np.array([_PLACES[kind][c] for c in body])
    n, size = len(x), len(ENCODINGS[kind])
    chi = float((np.bincount(x, minlength=size) ** 2).sum()) * size / n - n
    # Wilson and Hilferty's cube root makes chi-squared normal
    d = size - 1
    uniform = 0.5 * math.erfc(((chi / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d)) / math.sqrt(2))
    high = x >= size // 2
    a = int(high.sum())
    b = n - a
    if a and b:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * a * b / n
        var = max(1e-9, (mean - 1) * (mean - 2) / (n - 1))
        of_runs = _tail((runs - mean) / math.sqrt(var))
    else:
        of_runs = 0.5 ** (n - 1)
    y = x - (size - 1) / 2
    spread = float((y * y).sum())
    serial = _tail(float((y[1:] * y[:-1]).sum()) / spread * math.sqrt(n)) if spread else 0.0
    return uniform, of_runs, serial


def ordinary(token: str, kind: str) -> float:
    """The decimal logarithm of the likelihood ratio of a random token to an ordinary one."""
    body = token.rstrip("=")
    return sum(-math.log(len(ENCODINGS[kind])) - _ORDINARY[c] for c in body) / math.log(10)


def evidence(token: str, kind: str, alpha: float = ALPHA) -> float:
    """The decimal logarithm of the token's e-value, likelihood ratio times p-value of the battery; 0 where it is under 1 or p under ``alpha``."""
    p = min(1.0, 3 * min(battery(token, kind)))
    return max(0.0, ordinary(token, kind) + math.log10(p)) if p >= alpha else 0.0


def base_spans(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; ``tokens`` are the candidates' places, which hold all access and hex matches."""
    found = []
    low = text.lower()
    if any(x in low for x in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    for s, e in tokens:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text, s, e) if len(m[0]) >= 16]
        if e - s >= 32:
            found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text, s, e) if len(m[0]) >= 32]
    return sorted(found)


def token_places(text: str) -> list[tuple[int, int]]:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    inside = _TOKEN[np.minimum(points, 128)]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= MIN_TOKEN
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def uncovered(tokens: list[tuple[int, int]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The tokens that overlap none of the spans; both in order of their starts, walked together."""
    out, at, end = [], 0, -1  # the end of all spans that start before the token's end
    for s, e in tokens:
        while at < len(spans) and spans[at][0] < e:
            end = max(end, spans[at][2])
            at += 1
        if end <= s:
            out.append((s, e))
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base and tested for each row: spans of the fixed patterns; other tokens with their evidence."""
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    test = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.string()), ("evidence", pa.float64())])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            base, tested = [], []
            for text in b.column(1).to_pylist():
                text = text or ""
                tokens = token_places(text)
                spans = base_spans(text, tokens)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                rest = []
                for s, e in uncovered(tokens, spans):
                    if kind := encoding(text[s:e]):
                        rest.append({"start": s, "end": e, "encoding": kind, "evidence": evidence(text[s:e], kind)})
                tested.append(rest)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.list_(span)), pa.array(tested, pa.list_(test))], ["doc_id", "base", "tested"])

    schema = "base array<struct<start:bigint,kind:int,end:bigint>>, tested array<struct<start:bigint,end:bigint,encoding:string,evidence:double>>"
    own = docs.select("doc_id", "text")
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(batches, f"doc_id {kind}, {schema}")


def discovery_threshold(found: DataFrame, rate: float = RATE) -> float:
    """The least evidence that Benjamini and Hochberg's rule accepts, over all tested tokens; infinity if none."""
    bins = found.select(F.explode("tested").alias("t")).groupBy(F.least(F.floor(F.col("t.evidence") * 10), F.lit(BINS)).cast("int").alias("b")).count().collect()
    counts = np.zeros(BINS + 1)
    for r in bins:
        counts[r.b] += r["count"]
    above = np.cumsum(counts[::-1])[::-1]
    edges = 10.0 ** (-np.arange(BINS + 1) / 10)
    passed = np.flatnonzero((above > 0) & (edges <= rate * above / max(1.0, counts.sum())))
    return passed[0] / 10 if len(passed) else math.inf


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, base and spans for each row; spans are the base ones and the tokens found random, by start and kind."""
    found = materialize(candidates(docs))
    least = discovery_threshold(found, rate)
    hit = F.filter("tested", lambda t: t["evidence"] >= F.lit(least))
    added = F.transform(hit, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def shown(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def query(docs: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scan(docs).select("doc_id", *(count(k).alias(f"n_{KINDS[k]}") for k in range(3)), F.sha2(shown("base").cast("binary"), 256).alias("base_sha256"), shown("spans").alias("spans"))
