"""Exact dedup by a content sort, with DataFrame functions only.

Every text's white space is normalised, and the texts are range-partitioned by
their normalised bytes.  The splitters are sampled by the engine.  A splitter is
a text's first ``HEAD`` bytes, then a hash of all of it, so that splitters stay
small however long the texts are and a common beginning can be split.  In each
range an external sort by the whole normalised text places equal texts side by
side, and a sort aggregate compares each text in full with its neighbour: a run of
equal ones becomes one row, with the smallest id and the number of rows.

A group of more rows than a range's fair share would make one range too large.
Such groups (there are fewer of them than ranges) are known beforehand from counts
by hash; they are cut into pieces by a salt behind the hash, each piece is sorted
and merged as any other run, and the pieces' few rows are sorted and compared in
full once more.

What comes out of the sort is a row for each different text.  Its rows' own
digests bring it back to the documents, where copies are looked up only for texts
that occur more than once.

Results on unusual input: null texts are empty, and all texts without anything
but white space are equal to a single space, not to the empty text; a null doc_id
is smaller than all others; of rows that repeat both doc_id and text one is kept;
rows that share a doc_id but not the text are judged each by its text; an empty
table gives an empty result; further columns are ignored by ``groups`` and kept by
``dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Bytes of a text that stand in a splitter.
HEAD = 32


def normalised(text: str | Column = "text") -> Column:
    """The text with one space for each run of ASCII white space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: str | Column) -> Column:
    return F.sha2(F.col(text).cast("binary") if isinstance(text, str) else text.cast("binary"), 256)


def _large(own: DataFrame, ranges: int) -> DataFrame:
    """hash and pieces of the texts that have more rows than a range's share: fewer rows than ``ranges``."""
    share = max(1, -(-own.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0] // ranges))
    counted = own.groupBy("hash").agg(F.sum("copies").alias("n")).filter(F.col("n") > share)
    return counted.select("hash", F.ceil(F.col("n") / share).alias("pieces"))


def runs(docs: DataFrame, large: DataFrame) -> DataFrame:
    """A row for each run of equal texts of ``docs`` (doc_id, text): text_sha256, keep_id, n, and of the pieces of large groups the text itself.

    ``large`` has the hashes of texts to be cut into pieces, and how many.
    """
    keyed = docs.select("doc_id", normalised().alias("norm")).withColumn("hash", F.xxhash64("norm"))
    # fewer rows than there are ranges
    keyed = keyed.join(F.broadcast(large), "hash", "left")
    keyed = keyed.select(
        "doc_id", "norm", "hash", F.substring(F.col("norm").cast("binary"), 1, HEAD).alias("head"), F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("doc_id"), "pieces")).alias("piece")
    )
    # the smallest id as a struct: nulls come first, and the engine then aggregates sorted neighbours instead of hashing
    ranged = keyed.repartitionByRange("head", "hash", "piece").sortWithinPartitions("head", "hash", "piece", "norm")
    merged = ranged.groupBy("head", "hash", "piece", "norm").agg(F.min(F.struct("doc_id")).alias("least"), F.count("*").alias("n"))
    return merged.select(digest("norm").alias("text_sha256"), F.col("least.doc_id").alias("keep_id"), "n", F.when(F.col("piece").isNotNull(), F.col("norm")).alias("norm"))


def classes(docs: DataFrame, own: DataFrame) -> DataFrame:
    """text_sha256, keep_id and n of each different text."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = materialize(runs(docs, _large(own, ranges)))
    whole = found.filter("norm is null").select("text_sha256", "keep_id", "n")
    pieces = found.filter("norm is not null").groupBy("norm").agg(F.min(F.struct("keep_id")).alias("least"), F.sum("n").alias("n"))
    return whole.unionByName(pieces.select(digest("norm").alias("text_sha256"), F.col("least.keep_id").alias("keep_id"), "n"))


def _judged(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, copies (rows with both), keep_id and group_size, a row for each id and text."""
    digests = docs.select("doc_id", normalised().alias("norm")).select("doc_id", F.xxhash64("norm").alias("hash"), digest("norm").alias("text_sha256"))
    own = materialize(digests.groupBy("doc_id", "hash", "text_sha256").agg(F.count("*").alias("copies")))
    shared = classes(docs, own).filter("n > 1")
    keep = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return own.join(shared, "text_sha256", "left").select("doc_id", "text_sha256", "copies", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for each row of ``docs`` (doc_id, text)."""
    # rows that repeat id and text differ in nothing: the first of them may be kept
    each = _judged(docs.select("doc_id", "text")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    kept = (F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return each.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text no row of smaller id has; of rows that repeat doc_id and text, one."""
    kept = materialize(_judged(docs.select("doc_id", "text")).filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))))
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), F.col("copies").alias("__copies"))
    own = docs.withColumn("__own", digest(normalised()))
    same = own["doc_id"].eqNullSafe(kept["__id"]) & (own["__own"] == kept["__sha"])
    once = own.join(kept.filter("__copies = 1"), same, "left_semi")
    repeated = own.join(kept.filter("__copies > 1"), same, "left_semi").dropDuplicates(["doc_id", "__own"])
    return once.unionByName(repeated).select(*docs.columns)


query = groups

ORACLE = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM texts
"""
