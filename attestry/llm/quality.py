"""Quality scores learnt by Bradley-Terry pairwise ranking.

Each text has a vector of surface features (byte classes, repeated words and
lines, word shapes).  Every sampled low-quality row is paired with several
high-quality rows; the logistic loss on the difference of their features
gives the weights, as in a Bradley-Terry model of preferences.  A text's
strength is its weighted sum.  The threshold is the quantile of the training
strengths at the share of low-quality rows (half-way between the two nearest
rows), and is mapped to a score of 0.7.

Bound: at most ``SAMPLE`` labelled ids, those with the smallest hashes, are used
to fit, each with one text; everything else runs over all rows.

Results on unusual input: null texts count as empty ones and get a score like
any other; repeated rows get equal scores; ids with several labels use the
lower one, ids with several texts teach the first of them; null labels are left out; without labels of both kinds every score
is 0.75, so that nothing is rejected; further columns are ignored by ``query``
and kept by ``keep_good``.
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

#: Labelled rows used to fit at most.
SAMPLE = 12_000
#: High-quality partners of each low-quality row.
PARTNERS = 8
RIDGE = 1e-3
THRESHOLD = 0.7

_CLASSES = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "high": range(128, 256), "space": (32, 9), "line": (10, 13),
    "stop": (46, 44), "shout": (33, 63), "bar": (124, 47, 92, 95), "money": (36, 37), "mark": (35, 38, 42, 64, 94, 126, 43, 61), "bracket": (40, 41, 60, 62, 91, 93, 123, 125), "quote": (34, 39, 96), "colon": (58, 59, 45),
}
_CLASS_OF = np.zeros(256, np.int64)
for _k, _members in enumerate(_CLASSES.values()):
    for _b in _members:
        _CLASS_OF[_b] = _k + 1
WIDTH = 2 * (len(_CLASSES) + 1) + 14


def features(text: bytes | None) -> np.ndarray:
    """The surface features of one UTF-8 text, each of moderate size."""
    raw = np.frombuffer(text or b"", np.uint8)
    size = max(1, len(raw))
    share = np.bincount(_CLASS_OF, weights=np.bincount(raw, minlength=256), minlength=len(_CLASSES) + 1) / size
    words = (text or b"").split()
    n = max(1, len(words))
    kinds: dict[bytes, int] = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    most = max(kinds.values(), default=0)
    repeats = sum(map(bytes.__eq__, words[1:], words))
    lines = [x for x in (text or b"").split(b"\n") if x]
    n_lines = max(1, len(lines))
    expected = n ** -0.25  # distinct words become rarer in longer texts
    mean = sum(map(len, words)) / n
    bars = kinds.get(b"|", 0)
    rest = [
        len(kinds) / n, len(kinds) / n - expected, most / n, repeats / n, mean / 10, abs(mean - 6) / 10, min(1.0, mean / 100), bars / n,
        len(set(lines)) / n_lines, min(1.0, np.log1p(len(raw)) / 12), min(1.0, np.log1p(n_lines) / 8), float(n < 20), np.log1p(n / n_lines) / 5, 1.0 if repeats > 0.2 * n else 0.0,
    ]
    return np.concatenate([share, np.sqrt(share), rest])


@dataclass(frozen=True)
class Model:
    """Strength of a text: weights . (features - centre) / scale; score: logistic in strength."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        strength = ((x - self.centre) / self.scale) @ self.weights
        at = np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(at + self.slope * (strength - self.threshold), -30, 30)))


NEUTRAL = Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), -1.0, 0.2513)


def preferences(good: np.ndarray, seed: int = 7, partners: int = PARTNERS) -> tuple[np.ndarray, np.ndarray]:
    """Rows (better, worse) of the sampled pairs: each bad row with several good ones, each good row in one pair at least."""
    rng = np.random.default_rng(seed)
    bad_rows, good_rows = np.flatnonzero(~good), np.flatnonzero(good)
    worse = np.repeat(bad_rows, max(partners, -(-len(good_rows) // len(bad_rows))))
    return np.resize(rng.permutation(good_rows), len(worse)), rng.permutation(worse)


def weights_of(d: np.ndarray) -> np.ndarray:
    """The weights of least mean logistic loss on the differences better - worse, with a ridge of ``RIDGE`` / 2 times their squares."""
    w = np.zeros(d.shape[1])
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        gradient = -(p[:, None] * d).mean(axis=0) + RIDGE * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 2 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_pairs(x: np.ndarray, good: np.ndarray, seed: int = 7, partners: int = PARTNERS) -> Model:
    """The Bradley-Terry model of sampled preferences of good rows over bad ones."""
    n_bad = int((~good).sum())
    if not n_bad or n_bad == len(good):
        return NEUTRAL
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = np.clip((x - centre) / scale, -8, 8)
    better, worse = preferences(good, seed, partners)
    w = weights_of(z[better] - z[worse])
    strength = ((x - centre) / scale) @ w
    return Model(centre, scale, w, float(np.quantile(strength, n_bad / len(good), method="midpoint")), 1.0)


def fit(docs: DataFrame, labels: DataFrame, held_out=None, sample: int = SAMPLE) -> Model:
    """The model for labelled rows of ``docs``; ``held_out`` is a condition on doc_id for rows never to learn from."""
    rows = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    if held_out is not None:
        rows = rows.filter(~held_out)
    rows = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # one text an id, however often it occurs
    texts = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").cast("long").alias("quality"))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            x = [features(t).tolist() for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    schema = texts.select("doc_id").schema.add("quality", "long").add("x", ArrayType(DoubleType()))
    got: pd.DataFrame = texts.mapInArrow(batches, schema).toPandas()
    if got.empty:
        return NEUTRAL
    got = got.sort_values("doc_id")  # the pairs depend on the order
    return fit_pairs(np.array(got["x"].tolist()), got["quality"].to_numpy() > 0)


def score(texts: pa.Array, model: Model) -> np.ndarray:
    x = np.array([features(t) for t in texts.cast(pa.binary()).to_pylist()]).reshape(-1, WIDTH)
    return model.scores(x)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score for each row of ``docs``."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score(b.column(1), model))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(batches, docs.select("doc_id").schema.add("score", "double"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least the threshold, unchanged."""
    at = docs.columns.index("text")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield b.filter(pa.array(score(b.column(at), model) >= threshold))

    return docs.mapInArrow(batches, docs.schema)
