"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import drop_tables, materialize, numbered, shared_dir, tables

__all__ = ["crc_mod", "crc_sql", "drop_tables", "materialize", "numbered", "shared_dir", "table", "tables"]


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the column as text, modulo ``divisor``; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def crc_sql(words: str) -> str:
    """SQL of a recursive WITH clause whose last part, ``crcs``, has word and crc of the query ``words``: the CRC byte by byte, over the table that its polynomial gives."""
    return f"""bits(i, c, k) AS (
  SELECT range, range, 0 FROM range(256) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (
  SELECT i, c AS v FROM bits WHERE k = 8
), crc_steps(word, h, p, c) AS (
  SELECT word, hex(encode(word)), 0, 4294967295::BIGINT FROM ({words})
  UNION ALL
  SELECT word, h, p + 1, xor(c >> 8, v) FROM crc_steps JOIN crc_table
  ON i = xor(c & 255, 16 * (strpos('0123456789ABCDEF', substr(h, 2 * p + 1, 1)) - 1) + strpos('0123456789ABCDEF', substr(h, 2 * p + 2, 1)) - 1) WHERE 2 * p < length(h)
), crcs AS (
  SELECT word, xor(c, 4294967295) AS crc FROM crc_steps WHERE 2 * p = length(h)
)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
