"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

Each stage takes the rows that the one before it kept, and all but the last
return the columns of documents.  Packing returns one row a piece.

Results on unusual input, of every stage: null texts count as empty ones; rows
that repeat a doc_id are judged each by its own text, but the near-duplicate
stage keeps or drops an id as a whole (a null id is always kept); further
columns pass through; an empty table stays empty; without labels of both kinds
no document is rejected; without benchmark items none is contaminated.  Line
dedup drops documents that lose their whole text, and none that had no text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import decontaminate, line_dedup, packing, quality, simhash
from attestry.llm.common import crc_mod, drop_tables, materialize, tables


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.7; a quarter of the labels is held out of the fit."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels, crc_mod("doc_id", 4) == 2))


def without_repeated_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of later runs of over 50 words; those left without text go."""
    out = line_dedup.dedup(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate component."""
    return simhash.keep_first(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which benchmark windows hit no word, or less than a twentieth of them."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequences and offsets."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", good_quality),
    ("line dedup", without_repeated_runs),
    ("near duplicates", one_of_each_group),
    ("decontamination", uncontaminated),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    since = tables()
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
        drop_tables(since, last=1)  # the stage's own tables and its input
    return docs


#: The classifier's weights and the tokenizer can't be expressed in SQL.
ORACLE_SQL = None
