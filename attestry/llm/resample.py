"""Resampling towards a target distribution by importance weights over hashed word features.

Features are runs of up to ``order`` words; each falls into one of ``buckets`` by
its hash.  A bucket's gain is the logarithm of its share in the target over its
share in all documents, and a document's weight the sum of the gains of its
features.  Weights and Gumbel noise of each document's own id give a draw
without replacement: the highest sums are drawn.

Identical texts are collapsed first, by grouping the full text (combined before
the shuffle, so that a text with a third of all rows is a row for each task).
Features are counted once for each different text and enter the corpus counts times
the text's rows; the weight is computed once as well and joined back to the
documents by the text's digest, before the noise, which belongs to each document.

Ranks over all drawn documents come from ranges of scores: rows are numbered
inside their range, and the ranges' sizes are added up (a number for each range).
The driver and each task hold ``buckets`` counts and gains, whatever the input.

Results on unusual input: null and empty texts have no features and weight 0; a
null doc_id gets the noise of the empty id; rows that repeat a doc_id each draw
with the same noise and have ranks of their own; without target texts all target
counts are 0; an empty table gives an empty result; further columns are ignored
by ``query`` and kept by ``drawn``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType

from .common import crc_sql, materialize, numbered

BUCKETS = 10_000
ORDER = 1
SEED = 2024
#: Documents of fewer words are not drawn.
MIN_WORDS = 20
#: Share of the others that is drawn, in per cent.
PERCENT = 10
#: Features whose buckets a task remembers.
REMEMBERED = 1 << 19

_FOLD = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


class _Places(dict):
    """Each feature's bucket, computed when it is first asked for."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def features(text: str | None, order: int = ORDER) -> tuple[int, list[bytes]]:
    """The number of words, and all runs of one to ``order`` of them."""
    words = (text or "").encode("utf-8", "replace").translate(_FOLD).split()
    runs = list(words)
    for k in range(2, order + 1):
        runs += [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    return len(words), runs


def bucketed(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """The columns of ``texts`` but text, with words, n_features, and places and times: the features' buckets and how often each occurs."""
    kept = [c for c in texts.columns if c != "text"]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(buckets)
        for b in it:
            words, totals, sizes, at, times = [], [], [0], [], []
            for text in b.column("text").to_pylist():
                n, runs = features(text, order)
                found, count = np.unique(np.fromiter(map(places.__getitem__, runs), np.int32, len(runs)), return_counts=True)
                words.append(n)
                totals.append(len(runs))
                sizes.append(sizes[-1] + len(found))
                at.append(found)
                times.append(count)
            flat = lambda parts, kind: pa.array(np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind))
            offsets = pa.array(sizes, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, flat(at, np.int32)), pa.ListArray.from_arrays(offsets, flat(times, np.int64))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(words, pa.int64()), pa.array(totals, pa.int64()), *lists], [*kept, "words", "n_features", "places", "times"])

    schema = texts.select(*kept).schema.add("words", "long").add("n_features", "long")
    return texts.mapInArrow(batches, schema.add("places", ArrayType(IntegerType())).add("times", ArrayType(LongType())))


def totals(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows of ``counted`` (places, times, copies): as many numbers as buckets."""
    each = counted.select("copies", F.explode(F.arrays_zip("places", "times")).alias("x"))
    out = np.zeros(buckets)
    for r in each.groupBy(F.col("x.places").alias("place")).agg(F.sum(F.col("x.times") * F.col("copies")).alias("n")).collect():
        out[r.place] = r.n
    return out


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of the smoothed ratio of shares, rounded down, of each bucket."""
    n = float(len(target))
    s, t = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((a + 1.0) * (s + n) / ((b + 1.0) * (t + n)))) for a, b in zip(target.tolist(), source.tolist())], np.int64)


def weighted(counted: DataFrame, gain: np.ndarray) -> DataFrame:
    """text_sha256, words, n_features and weight of each row of ``counted``."""
    shared = counted.sparkSession.sparkContext.broadcast(gain)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            places, times = b.column("places"), b.column("times")
            worth = np.concatenate([[0], np.cumsum(shared.value[places.flatten().to_numpy()] * times.flatten().to_numpy())]).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(places.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("text_sha256"), b.column("words"), b.column("n_features"), pa.array(worth[ends[1:]] - worth[ends[:-1]])], ["text_sha256", "words", "n_features", "weight"])

    own = counted.select("text_sha256", "words", "n_features", "places", "times")
    return own.mapInArrow(batches, "text_sha256 string, words long, n_features long, weight long")


def noise(doc_id: str | Column = "doc_id", seed: int = SEED) -> Column:
    """A thousand times the Gumbel noise of an id, rounded down."""
    own = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit(""))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), own).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def _digest(text: str) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def weights(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """text_sha256, words, n_features and weight of each different text of ``docs``; ``docs`` and ``target`` have text."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text")).groupBy("text").agg(F.count("*").alias("copies"))
    counted = materialize(bucketed(texts.withColumn("text_sha256", _digest("text")), order, buckets))
    wanted = bucketed(target.select("text", F.lit(1).cast("long").alias("copies")), order, buckets)
    return weighted(counted, gains(totals(wanted, buckets), totals(counted, buckets)))


def scored(docs: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, words, n_features, weight and score for each row of ``docs``."""
    own = docs.select("doc_id", _digest("text").alias("text_sha256"))
    found = own.join(weights(docs, target, order, buckets), "text_sha256")
    return found.select("doc_id", "words", "n_features", "weight", (F.col("weight") + noise("doc_id", seed)).alias("score"))


def ranked(scores: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scores`` with rank, 1 for the highest score (ties: the smaller doc_id), of the drawn rows; null for all others.

    Drawn are ``percent`` in a hundred of the rows of ``min_words`` words or more, rounded down.
    """
    scores = materialize(scores)
    may = scores.filter(F.col("words") >= min_words)
    drawn = may.count() * percent // 100
    order = numbered(may, F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    rank = F.when(F.col("number") <= drawn, F.col("number"))
    return order.select(*scores.columns, rank.alias("rank")).unionByName(scores.filter(F.col("words") < min_words).withColumn("rank", F.lit(None).cast("long")))


def drawn(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs``, each id once."""
    ids = ranked(scored(docs, target, order, buckets, seed), percent, min_words).filter("rank is not null").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["__id"]), "left_semi")


def query(docs: DataFrame, target: DataFrame) -> DataFrame:
    return ranked(scored(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE = f"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), item_words AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark
), counted AS (
  SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS word FROM doc_words) GROUP BY ALL
), {crc_sql("SELECT word FROM counted UNION SELECT word FROM item_words")}, source AS (
  SELECT crc % {BUCKETS} AS bucket, sum(n) AS s FROM counted JOIN crcs USING (word) GROUP BY bucket
), target AS (
  SELECT crc % {BUCKETS} AS bucket, count(*) AS t FROM item_words JOIN crcs USING (word) GROUP BY bucket
), sums AS (
  SELECT (SELECT coalesce(sum(s), 0) FROM source)::DOUBLE AS big_s, (SELECT coalesce(sum(t), 0) FROM target)::DOUBLE AS big_t
), gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (big_s + {BUCKETS}) / ((s + 1)::DOUBLE * (big_t + {BUCKETS}))))::BIGINT AS g FROM source LEFT JOIN target USING (bucket), sums
), weight AS (
  SELECT doc_id, sum(n * g)::BIGINT AS weight FROM counted JOIN crcs USING (word) JOIN gain ON bucket = crc % {BUCKETS} GROUP BY doc_id
), score AS (
  SELECT doc_id, len(ws) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM doc_words LEFT JOIN weight USING (doc_id)
), drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM score WHERE n_features >= {MIN_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {PERCENT} * (SELECT count(*) FROM drawn) // 100 THEN rank END AS rank FROM score LEFT JOIN drawn USING (doc_id)
"""
