"""Language identification by interpolated Kneser-Ney character models.

Texts are case-folded and each run of characters that are no letters becomes
one space.  Characters are 16-bit units: a letter beyond the basic plane is two.  All 4-grams of all training rows are counted by language, each
under its own 64-bit key.  Lower orders use continuation counts.  The model
keeps, by sorted key, the interpolated log-probability of each 4-gram in every
language, and the lower orders for 4-grams it has not seen.

4-grams that fit ``PART_BYTES`` (then so do the lower orders, of which there are
fewer) are one model, and the texts are read once.  Beyond, the engine itself
makes the tables of all orders, by joins, and they are scanned in ranges of keys
that fit: first the 4-grams, one pass over the texts a range, each of which leaves
the 3-grams that end what it has not seen, then those, and so on.  Sums are added
for each text; the driver and a task only ever hold one range.  A text gets the
language of the lowest
cross-entropy per character.  The score is the share of the best language when
all are weighed by their likelihoods, tempered by length.

Rejection is calibrated on training rows alone: a tenth of them, by a hash of the
text, is scored by a model of the others, and each language's mean and standard
deviation of the cross-entropy of its own rows are kept.  A text that lies over the
mean of the language found for it by more than ``REJECT`` standard deviations is
``rejected``: it is in no learned language, its score is 0, and lang_pred only says
which one is least unlike it.  A language without rows in that tenth rejects nothing.

Logarithms are 32-bit numbers in a model that is held whole and 64-bit ones in
ranges, so that scores of the two ways agree to six digits.

Results on unusual input: a null text, or one without letters, is ``und``
with score 0; rows without language teach nothing; without training rows all
texts are ``und``; ties go to the language first in order; repeated rows get
equal results and count as often as they occur; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import materialize

#: Bits of the table of places by hash at least; keys that share a hash are searched for.
BITS = 20
#: Characters handled at once.
BLOCK = 1 << 19
#: Different 4-grams that a task counts before it passes them on.
HELD = 1 << 20
#: Bytes of the keys and log-probabilities of one order that are held at once.
PART_BYTES = 1 << 25
#: Standard deviations over the mean from which on a text is in no learned language.
REJECT = 4.0
#: One of so many training texts calibrates the rejection.
HELD_BACK = 10

_MIX = np.uint64(0x9E3779B97F4A7C15)
_folding: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """For each code point of the basic plane: its lower-case letter, or a space."""
    if not _folding:
        table = np.full(1 << 16, 32, np.uint32)
        for c in range(1 << 16):
            if chr(c).isalpha():
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _folding.append(table)
    return _folding[0]


def folded(text: str | None) -> np.ndarray:
    """16-bit units of the folded text, with a space at either end; a letter beyond the basic plane is a pair of surrogates, as no other letter is."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    beyond = raw >= 1 << 16
    near = _fold_table()[np.where(beyond, 32, raw)]
    if beyond.any():
        near = np.repeat(near, 1 + beyond)
        first = np.flatnonzero(beyond) + np.arange(beyond.sum())
        low = np.array([ord(chr(c).lower()) if chr(c).isalpha() else 0 for c in raw[beyond].tolist()], np.uint32)
        letter, off = low >= 1 << 16, low - (1 << 16)
        near[first[letter]] = 0xD800 + (off[letter] >> 10)
        near[first[letter] + 1] = 0xDC00 + (off[letter] & 0x3FF)
    out = np.full(len(near) + 2, 32, np.uint64)
    out[1:-1] = near
    keep = out != 32
    keep[0] = True
    keep[1:] |= out[:-1] != 32
    return out[keep]


def grams(chars: np.ndarray) -> np.ndarray:
    """The 4-grams, 16 bits a character; the first ones start with further spaces."""
    c = np.concatenate([np.full(2, 32, np.uint64), chars])
    return c[:-3] << np.uint64(48) | c[1:-2] << np.uint64(32) | c[2:-1] << np.uint64(16) | c[3:]


def buckets(g: np.ndarray, bits: int = BITS) -> np.ndarray:
    h = g * _MIX
    h ^= h >> np.uint64(32)
    h *= _MIX
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _signed(g: np.ndarray) -> np.ndarray:
    """The keys as signed longs of the same order; its own inverse but for the type."""
    return (g ^ np.uint64(1 << 63)).view(np.int64)


def _unsigned(g: np.ndarray) -> np.ndarray:
    return g.view(np.uint64) ^ np.uint64(1 << 63)


def counted(docs: DataFrame) -> DataFrame:
    """lang, gram (signed key) and times: all 4-grams of all rows of ``docs`` (text, lang)."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            if len(parts) == 1:
                return parts[0]
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, times = summed(parts)
                for at in range(0, len(keys), 1 << 15):
                    k, n = keys[at : at + (1 << 15)], times[at : at + (1 << 15)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(_signed(k)), pa.array(n)], ["lang", "gram", "times"])
            held.clear()

        def take(lang: str, texts: list[np.ndarray]) -> int:
            g = np.concatenate(texts)
            made = 0
            for at in range(0, len(g), BLOCK):
                k, n = np.unique(g[at : at + BLOCK], return_counts=True)
                held.setdefault(lang, []).append((k, n))
                made += len(k)
            return made

        def settle() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                held[lang] = [summed(parts)]
            left = sum(len(k) for ((k, _),) in held.values())
            if left <= HELD // 2:
                return left
            yield from flush()
            return 0

        for b in it:
            by: dict[str, list[np.ndarray]] = {}
            waiting: dict[str, int] = {}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                g = grams(folded(text))
                by.setdefault(lang, []).append(g)
                waiting[lang] = waiting.get(lang, 0) + len(g)
                if waiting[lang] > BLOCK:
                    size += take(lang, by.pop(lang))
                    waiting[lang] = 0
                    if size > HELD:
                        size = yield from settle()
            for lang, texts in by.items():
                size += take(lang, texts)
                if size > HELD:
                    size = yield from settle()
        yield from flush()

    partial = docs.select("text", "lang").mapInArrow(batches, "lang string, gram long, times long")
    return partial.groupBy("lang", "gram").agg(F.sum("times").alias("times"))


def counts(docs: DataFrame) -> pd.DataFrame:
    """``counted`` in the driver's memory."""
    return counted(docs).toPandas()


@dataclass(frozen=True)
class Lower:
    """The orders under 4, of all languages."""

    languages: list[str]
    keys: list[np.ndarray]  # sorted 1-, 2- and 3-grams
    probs: list[np.ndarray]
    back: list[np.ndarray]  # by context of 1 and 2 characters: the mass left to the lower order
    floor: np.ndarray  # of characters never seen, by language
    discount: np.ndarray  # of the 4-grams, by language


@dataclass(frozen=True)
class Model:
    languages: list[str]
    bits: int
    grams: np.ndarray  # sorted
    logs: np.ndarray  # of each 4-gram, by language
    keys: list[np.ndarray]  # sorted 1-, 2- and 3-grams
    probs: list[np.ndarray]
    contexts: list[np.ndarray]  # sorted contexts of 1, 2 and 3 characters
    back: list[np.ndarray]  # the mass left to the lower order by each
    floor: np.ndarray  # of characters never seen, by language

    def lower(self, g: np.ndarray) -> np.ndarray:
        """Probabilities, by language, of 4-grams that the model has not seen."""
        p = np.tile(self.floor, (len(g), 1))
        for n in (1, 2, 3):
            suffix = g & np.uint64((1 << 16 * n) - 1)
            if n > 1:
                p = p * self._weight(n - 1, suffix >> np.uint64(16))
            at = np.minimum(np.searchsorted(self.keys[n - 1], suffix), len(self.keys[n - 1]) - 1)
            seen = self.keys[n - 1][at] == suffix
            p[seen] = self.probs[n - 1][at[seen]]
        return p * self._weight(3, g >> np.uint64(16))

    def _weight(self, n: int, context: np.ndarray) -> np.ndarray:
        known = self.contexts[n - 1]
        at = np.minimum(np.searchsorted(known, context), len(known) - 1)
        return np.where((known[at] == context)[:, None], self.back[n - 1][at], 1.0)

    def dense(self) -> np.ndarray:
        """By hash, the place of one 4-gram with it in the sorted array, or -1."""
        out = np.full(1 << self.bits, -1, np.int32)
        out[buckets(self.grams, self.bits)] = np.arange(len(self.grams), dtype=np.int32)
        return out

    def sums(self, g: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Sums of the log-probabilities, by language, of the 4-grams."""
        total = np.zeros(len(self.languages))
        for at in range(0, len(g), BLOCK):
            part = g[at : at + BLOCK]
            k = dense[buckets(part, self.bits)]
            seen = (k >= 0) & (self.grams[k] == part)
            if not seen.all():
                # another 4-gram has the hash's place
                other = np.flatnonzero((k >= 0) & ~seen)
                k[other] = np.minimum(np.searchsorted(self.grams, part[other]), len(self.grams) - 1)
                seen[other] = self.grams[k[other]] == part[other]
            if seen.all():
                total += self.logs[k].sum(axis=0, dtype=np.float64)
            else:
                total += self.logs[k[seen]].sum(axis=0, dtype=np.float64) + np.log(self.lower(part[~seen])).sum(axis=0)
        return total


def _matrix(keys: np.ndarray, grams: np.ndarray, langs: pd.Series, times: np.ndarray, languages: list[str]) -> np.ndarray:
    out = np.zeros((len(keys), len(languages)))
    out[np.searchsorted(keys, grams), np.searchsorted(languages, langs.to_numpy().astype(str))] = times
    return out


def _discount(ones: np.ndarray, twos: np.ndarray) -> np.ndarray:
    return np.clip(ones / np.maximum(1, ones + 2 * twos), 0.1, 0.9)


def _order(types: np.ndarray, tally: np.ndarray, discount: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of the n-grams, their contexts, and the mass that each context leaves to the lower order."""
    context, inverse = np.unique(types >> np.uint64(16), return_inverse=True)
    mass, kinds = np.zeros((len(context), tally.shape[1])), np.zeros((len(context), tally.shape[1]))
    np.add.at(mass, inverse, tally)
    np.add.at(kinds, inverse, tally > 0)
    weight = np.where(mass > 0, discount * kinds / np.maximum(mass, 1), 1.0)
    return np.maximum(tally - discount, 0) / np.maximum(mass[inverse], 1) + weight[inverse] * below, context, weight


def _lower_orders(triples: pd.DataFrame, ones: dict[str, int], twos: dict[str, int]) -> Lower:
    """From the continuation counts (lang, gram, times) of the 3-grams and how many 4-grams occur once and twice."""
    languages = sorted(ones)
    g = triples["gram"].to_numpy().astype(np.uint64)
    types = {3: np.unique(g)}
    # tally[n]: distinct continuations of the n-grams
    tally, up = {3: _matrix(types[3], g, triples["lang"], triples["times"].to_numpy(), languages)}, {}
    for n in (2, 1):
        types[n], up[n] = np.unique(types[n + 1] & np.uint64((1 << 16 * n) - 1), return_inverse=True)
        tally[n] = np.zeros((len(types[n]), len(languages)))
        np.add.at(tally[n], up[n], tally[n + 1] > 0)
    floor = 1.0 / (len(types[1]) + 1)
    probs, back = {}, {}
    below = np.full((len(types[1]), len(languages)), floor)
    for n in (1, 2, 3):
        if n > 1:
            below = probs[n - 1][up[n - 1]]
        probs[n], context, weight = _order(types[n], tally[n], _discount((tally[n] == 1).sum(axis=0), (tally[n] == 2).sum(axis=0)), below)
        if n == 1:
            unseen = weight[0] * floor
        else:
            place = np.minimum(np.searchsorted(types[n - 1], context), len(types[n - 1]) - 1)
            inside = types[n - 1][place] == context
            back[n - 1] = np.ones((len(types[n - 1]), len(languages)))
            back[n - 1][place[inside]] = weight[inside]
    own = _discount(np.array([ones[x] for x in languages]), np.array([twos[x] for x in languages]))
    return Lower(languages, [types[n] for n in (1, 2, 3)], [probs[n] for n in (1, 2, 3)], [back[1], back[2]], unseen, own)


def _fit_whole(counted: pd.DataFrame, lower: Lower, bits: int) -> Model:
    g = _unsigned(counted["gram"].to_numpy())
    types = np.unique(g)
    times = _matrix(types, g, counted["lang"], counted["times"].to_numpy(), lower.languages)
    below = lower.probs[2][np.searchsorted(lower.keys[2], types & np.uint64((1 << 48) - 1))]
    probs, context, weight = _order(types, times, lower.discount, below)
    bits = max(bits, (2 * len(types) - 1).bit_length())
    return Model(lower.languages, bits, types, np.log(probs).astype(np.float32), lower.keys, lower.probs, [*lower.keys[:2], context], [*lower.back, weight], lower.floor)


def fit(counted: pd.DataFrame, bits: int = BITS) -> Model | None:
    """The Kneser-Ney models of all languages from their counted 4-grams."""
    if counted.empty:
        return None
    suffix = pd.DataFrame({"lang": counted["lang"], "gram": _unsigned(counted["gram"].to_numpy()) & np.uint64((1 << 48) - 1)})
    triples = suffix.groupby(["lang", "gram"]).size().reset_index(name="times")
    once = counted.groupby("lang")["times"]
    lower = _lower_orders(triples, once.agg(lambda t: int((t == 1).sum())).to_dict(), once.agg(lambda t: int((t == 2).sum())).to_dict())
    return _fit_whole(counted, lower, bits)


def _distinct(table: DataFrame) -> int:
    return table.select("gram").distinct().count()


def _whole(table: DataFrame, bits: int) -> Model | None:
    """The model of all ``counted`` rows, in the driver's memory."""
    return fit(table.toPandas(), bits)


@dataclass(frozen=True)
class Range:
    """The n-grams of one order from ``low`` to ``high``, which hold all that share a context."""

    order: int
    grams: np.ndarray  # sorted
    logs: np.ndarray  # of each n-gram, by language
    contexts: np.ndarray  # sorted
    back: np.ndarray  # logarithms of the mass that each context leaves to the lower order
    low: int
    high: int
    floor: float

    def scan(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of what is known of the n-grams in the range, and the lower order's n-grams for those it has not seen."""
        g = g[(g >= np.uint64(self.low)) & (g <= np.uint64(self.high))]
        total = np.zeros(self.logs.shape[1])
        rest = []
        for at in range(0, len(g), BLOCK):
            part = g[at : at + BLOCK]
            k = np.minimum(np.searchsorted(self.grams, part), max(0, len(self.grams) - 1))
            seen = self.grams[k] == part if len(self.grams) else np.zeros(len(part), bool)
            total += self.logs[k[seen]].sum(axis=0, dtype=np.float64)
            other = part[~seen]
            context = other >> np.uint64(16)
            c = np.minimum(np.searchsorted(self.contexts, context), max(0, len(self.contexts) - 1))
            known = self.contexts[c] == context if len(self.contexts) else np.zeros(len(other), bool)
            total += self.back[c[known]].sum(axis=0, dtype=np.float64)
            if self.order > 1:
                rest.append(other & np.uint64((1 << 16 * (self.order - 1)) - 1))
            else:
                total += len(other) * np.log(self.floor)
        return total, np.concatenate(rest) if rest else np.zeros(0, np.uint64)


def _fitted(table: DataFrame, languages: list[str]) -> tuple[dict[int, tuple[DataFrame, DataFrame]], float]:
    """For each order its tables (gram, p) and (context, w), arrays by language, and the floor; made by the engine."""
    each = range(len(languages))
    counts = {4: table.select("lang", "gram", "times")}
    for n in (3, 2, 1):
        ends = F.col("gram").bitwiseAND(F.lit((1 << 16 * n) - 1)).alias("gram")
        counts[n] = materialize(counts[n + 1].select("lang", ends).groupBy("lang", "gram").agg(F.count("*").alias("times")))
    floor = 1.0 / (counts[1].select("gram").distinct().count() + 1)
    out: dict[int, tuple[DataFrame, DataFrame]] = {}
    for n in (1, 2, 3, 4):
        few = {r.lang: r for r in counts[n].groupBy("lang").agg(F.count_if(F.col("times") == 1).alias("ones"), F.count_if(F.col("times") == 2).alias("twos")).collect()}
        discount = _discount(np.array([few[x].ones for x in languages]), np.array([few[x].twos for x in languages])).tolist()
        wide = counts[n].groupBy("gram").agg(*(F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("times"))), F.lit(0)).alias(f"c{i}") for i, x in enumerate(languages)))
        wide = materialize(wide.withColumn("context", F.shiftright("gram", 16)))
        context = wide.groupBy("context").agg(*(F.sum(f"c{i}").alias(f"m{i}") for i in each), *(F.count_if(F.col(f"c{i}") > 0).alias(f"k{i}") for i in each))
        weight = lambda i: F.when(F.col(f"m{i}") > 0, F.lit(discount[i]) * F.col(f"k{i}") / F.col(f"m{i}")).otherwise(1.0)  # noqa: B023, E731
        context = context.select("context", *(F.greatest(f"m{i}", F.lit(1)).alias(f"m{i}") for i in each), F.array(*map(weight, each)).alias("w"))
        df = wide.join(context, "context")
        if n > 1:
            lower = out[n - 1][0].select(F.col("gram").alias("ends"), F.col("p").alias("below"))
            df = df.withColumn("ends", F.col("gram").bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1))).join(lower, "ends")
        else:
            df = df.withColumn("below", F.array_repeat(F.lit(floor), len(languages)))
        p = [F.greatest(F.col(f"c{i}") - F.lit(discount[i]), F.lit(0.0)) / F.col(f"m{i}") + F.get("w", F.lit(i)) * F.get("below", F.lit(i)) for i in each]
        out[n] = materialize(df.select("gram", F.array(*p).alias("p"))), materialize(context.select("context", "w"))
    return out, floor


def ranges(grams: DataFrame, contexts: DataFrame, order: int, n_languages: int, floor: float, part_bytes: int) -> Iterator[Range]:
    """One order's tables, one range after the other."""
    rows = max(1, part_bytes // (8 + 8 * n_languages))
    parts = -(-grams.count() // rows)
    bounds: list[int] = []
    if parts > 1:
        least, found = grams.agg(F.min("gram"), F.percentile_approx("gram", [k / parts for k in range(1, parts)], 100 * parts)).first()
        bounds = sorted({x >> 16 << 16 for x in found if x >> 16 > least >> 16})
    edges = [-(1 << 63), *bounds, 1 << 63]
    unsigned = _unsigned if order == 4 else (lambda g: g.astype(np.uint64))
    shift = 1 << 63 if order == 4 else 0
    for low, high in zip(edges, edges[1:]):
        own = grams.filter(F.col("gram").between(low, high - 1)).sort("gram").toPandas()
        left = contexts.filter(F.col("context").between(low >> 16, (high - 1) >> 16)).sort("context").toPandas()
        keys = unsigned(own["gram"].to_numpy().astype(np.int64))
        # a context of the highest order keeps the sign's place of its key, 48 bits from the end
        context = left["context"].to_numpy().astype(np.int64)
        context = (context + (1 << 47)).astype(np.uint64) if order == 4 else context.astype(np.uint64)
        array = lambda c, n: np.log(np.array(c.tolist(), float).reshape(n, n_languages))
        yield Range(order, keys, array(own["p"], len(own)), context, array(left["w"], len(left)), max(0, low + shift), min((1 << 64) - 1, high - 1 + shift), floor)


def _summed(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of ``docs`` but text, with sums (of log-probabilities by language), n (4-grams) and length (folded characters)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "text"]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        dense = m.dense() if m else None
        for b in it:
            sums, ns, lengths = [], [], []
            for text in b.column("text").to_pylist():
                chars = folded(text)
                g = grams(chars)[1:] if len(chars) > 2 else grams(chars)
                sums.append(m.sums(g, dense).tolist() if m else [])
                ns.append(len(g) if m else 0)
                lengths.append(max(0, len(chars) - 2))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(sums, pa.list_(pa.float64())), pa.array(ns, pa.int64()), pa.array(lengths, pa.int64())], [*kept, "sums", "n", "length"])

    schema = docs.select(*kept).schema.add("sums", ArrayType(DoubleType())).add("n", "long").add("length", "long")
    return docs.mapInArrow(batches, schema)


def _decided(found: DataFrame, languages: list[str]) -> DataFrame:
    """doc_id, lang_pred, score, entropy and length from doc_id, sums, n and length."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            langs, scores, entropies = [], [], []
            for sums, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                lang, score, entropy = "und", 0.0, None
                if n:
                    h = -np.array(sums) / n
                    k = int(np.argmin(h))
                    lang, entropy = languages[k], float(h[k])
                    score = float(1 / np.exp(np.minimum(0, (h[k] - h) * min(n, 200))).sum())
                langs.append(lang)
                scores.append(score)
                entropies.append(entropy)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(entropies, pa.float64()), b.column(3)], ["doc_id", "lang_pred", "score", "entropy", "length"])

    schema = found.select("doc_id").schema.add("lang_pred", "string").add("score", "double").add("entropy", "double").add("length", "long")
    return found.select("doc_id", "sums", "n", "length").mapInArrow(batches, schema)


def _scanned(rows: DataFrame, part: Range, n_languages: int) -> DataFrame:
    """row, sums, rest, n and length of rows of row and text (order 4) or grams (lower orders)."""
    shared = rows.sparkSession.sparkContext.broadcast(part)
    texts = part.order == 4

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in it:
            sums, rests, ns, lengths = [], [], [], []
            for x in b.column(1):
                n = length = 0
                if texts:
                    chars = folded(x.as_py())
                    g = grams(chars)[1:] if len(chars) > 2 else grams(chars)
                    n, length = len(g), max(0, len(chars) - 2)
                else:
                    g = x.values.to_numpy().astype(np.uint64)
                total, rest = m.scan(g)
                sums.append(total.tolist())
                rests.append(rest.astype(np.int64))
                ns.append(n)
                lengths.append(length)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sums, pa.list_(pa.float64())), pa.array(rests, pa.list_(pa.int64())), pa.array(ns, pa.int64()), pa.array(lengths, pa.int64())], ["row", "sums", "rest", "n", "length"])

    return rows.mapInArrow(batches, "row long, sums array<double>, rest array<long>, n long, length long")


def _in_ranges(docs: DataFrame, table: DataFrame, languages: list[str], part_bytes: int) -> DataFrame:
    """doc_id, sums, n and length for each row of ``docs``: order by order, range by range."""
    fitted, floor = _fitted(table, languages)
    rows = materialize(docs.withColumn("row", F.monotonically_increasing_id()))
    left, passes = rows.select("row", "text"), []
    for order in (4, 3, 2, 1):
        found = [materialize(_scanned(left, part, len(languages))) for part in ranges(*fitted[order], order, len(languages), floor, part_bytes)]
        every = found[0]
        for more in found[1:]:
            every = every.unionByName(more)
        passes.append(every.select("row", "sums", "n", "length"))
        left = materialize(every.groupBy("row").agg(F.flatten(F.collect_list("rest")).alias("grams")).filter(F.size("grams") > 0))
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    sums = [F.sum(F.get("sums", F.lit(i))) for i in range(len(languages))]
    added = every.groupBy("row").agg(F.array(*sums).alias("sums"), F.max("n").alias("n"), F.max("length").alias("length"))
    return rows.select("row", "doc_id").join(added, "row").select("doc_id", "sums", "n", "length")


def predicted(docs: DataFrame, table: DataFrame, bits: int = BITS, part_bytes: int = PART_BYTES) -> DataFrame:
    """doc_id, lang_pred, score, entropy and length (folded characters) for each row of ``docs``."""
    docs = docs.select("doc_id", "text")
    languages = sorted(r.lang for r in table.select("lang").distinct().collect())
    if _distinct(table) * (8 + 4 * len(languages)) <= part_bytes:
        return _decided(_summed(docs, _whole(table, bits)), languages)
    return _decided(_in_ranges(docs, table, languages, part_bytes), languages)


def calibrated(rows: DataFrame, table: DataFrame, bits: int = BITS, part_bytes: int = PART_BYTES) -> DataFrame:
    """lang, mean and spread of the cross-entropies of ``rows`` (text, lang), which ``table`` was not counted on, by their own language."""
    found = predicted(rows.select(F.col("lang").alias("doc_id"), "text"), table, bits, part_bytes)
    usual = found.filter("entropy is not null").groupBy(F.col("doc_id").alias("lang"))
    return usual.agg(F.avg("entropy").alias("mean"), F.coalesce(F.stddev_samp("entropy"), F.lit(0.0)).alias("spread"))


def identify(docs: DataFrame, training: DataFrame, reject: float = REJECT, bits: int = BITS, part_bytes: int = PART_BYTES) -> DataFrame:
    """``predicted`` and rejected, with score 0 where a row is rejected; ``training`` has text and lang."""
    learned = training.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    apart = F.pmod(F.xxhash64("text"), F.lit(HELD_BACK)) == 0  # by text, so that copies of a text are on one side
    most, rest = materialize(counted(learned.filter(~apart))), materialize(counted(learned.filter(apart)))
    table = materialize(most.unionByName(rest).groupBy("lang", "gram").agg(F.sum("times").alias("times")))
    usual = materialize(calibrated(learned.filter(apart), most, bits, part_bytes)).withColumnRenamed("lang", "lang_pred")
    found = predicted(docs, table, bits, part_bytes)
    # one row a language
    out = found.join(F.broadcast(usual), "lang_pred", "left")
    far = F.coalesce(F.col("entropy") > F.col("mean") + reject * F.col("spread"), F.lit(False))
    out = out.withColumn("rejected", far)
    return out.select("doc_id", "lang_pred", F.when(F.col("rejected"), 0.0).otherwise(F.col("score")).alias("score"), "entropy", "length", "rejected")
