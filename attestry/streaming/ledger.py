"""An extension: running totals of a ledger that grows, as a stream.

Totals by phase never expire, so that no watermark is set; the state has one row a phase.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "generated_at string, phase string, provider string, model string, tokens_in bigint, tokens_out bigint, usd double, page_count_proxy bigint, bad string"


def ledger_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Events of the JSON lines in a folder, new files as they come; lines that do not parse are in bad."""
    reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).option("columnNameOfCorruptRecord", "bad")
    return reader.json(path)


def running_totals(events: DataFrame) -> DataFrame:
    """Events, tokens and invalid lines by phase; for output mode complete or update."""
    sums = (F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens_in", "tokens_out", "page_count_proxy"))
    return events.groupBy("phase").agg(F.count("*").alias("events"), F.count("bad").alias("invalid"), *sums)
