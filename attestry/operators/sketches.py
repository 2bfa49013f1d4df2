"""Mergeable sketches: numbers of different values, quantiles and counts of values that later batches join without rereading.

A sketch row has, for each key, a HyperLogLog sketch of different values (relative standard error ``2 ** (-LOG_K / 2)``, 1.6 per
cent at 12), a KLL sketch of a number's quantiles (rank error about 1.3 per cent), and a count-min matrix of how often
values occur: ``DEPTH`` rows of ``WIDTH`` counters, by which no count is too small, and too large by more than ``2 / WIDTH`` of all
rows at a probability of ``2 ** -DEPTH`` only.  All three of a union are the union of theirs, in whatever order batches come.

Nulls are in no sketch; keys of null are a key; an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_K = 12
WIDTH, DEPTH = 2048, 5


def sketched(df: DataFrame, keys: list[str], value: str, number: str) -> DataFrame:
    """keys, rows, distinct (HyperLogLog of ``value``) and quantiles (KLL of ``number``, a whole number)."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), F.hll_sketch_agg(value, F.lit(LOG_K)).alias("distinct"), F.kll_sketch_agg_bigint(F.col(number).cast("bigint")).alias("quantiles"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key over all its sketch rows, of any batches; ``keys`` may be fewer than they were made by."""
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_bigint("quantiles").alias("quantiles"))


def estimates(sketches: DataFrame, keys: list[str], shares: tuple[float, ...] = (0.1, 0.5, 0.9)) -> DataFrame:
    """keys, rows, n_distinct and a quantile column q<per cent> for each share."""
    quantile = lambda s: F.kll_sketch_get_quantile_bigint("quantiles", F.lit(s)).alias(f"q{round(100 * s)}")
    return sketches.select(*keys, "rows", F.hll_sketch_estimate("distinct").alias("n_distinct"), *map(quantile, shares))


def _cell(value: Column, depth: Column) -> Column:
    return F.pmod(F.xxhash64(value, depth), F.lit(WIDTH)).cast("int")


def counters(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, depth, cell and n: a count-min matrix for each key, of its filled cells; matrices add up by ``merged_counters``."""
    each = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    deep = each.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(DEPTH - 1))))
    return deep.groupBy(*keys, "depth", _cell(F.col(value), F.col("depth")).alias("cell")).agg(F.sum("n").alias("n"))


def merged_counters(matrices: DataFrame, keys: list[str]) -> DataFrame:
    return matrices.groupBy(*keys, "depth", "cell").agg(F.sum("n").alias("n"))


def looked_up(matrices: DataFrame, asked: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value and at_most: for each asked value of a key, how often it has occurred at most."""
    deep = asked.select(*keys, value).distinct().withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(DEPTH - 1)))).withColumn("cell", _cell(F.col(value), F.col("depth")))
    found = deep.join(matrices, [*keys, "depth", "cell"], "left")
    return found.groupBy(*keys, value).agg(F.min(F.coalesce("n", F.lit(0))).alias("at_most"))
