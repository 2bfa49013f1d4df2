"""The registered queries of this subpackage, each over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, exact, fingerprint, langid, licences, line_dedup, packing, quality, resample, secrets, simhash, spelling
from .common import crc_mod, table


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.query(table(spark, sf_dir, "conversations"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.query(table(spark, sf_dir, "documents"))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 4) == 2
    model = quality.fit(docs, table(spark, sf_dir, "labels"), held_out)
    good = (F.col("score") >= quality.THRESHOLD).cast("int")
    return quality.scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", good.alias("predicted"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 0
    found = langid.identify(docs, docs.filter(~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.query(table(spark, sf_dir, "documents"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.query(table(spark, sf_dir, "documents"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.query(table(spark, sf_dir, "documents"))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.query(table(spark, sf_dir, "documents"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.query(table(spark, sf_dir, "documents"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.query(table(spark, sf_dir, "documents"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": _op1,
    "op2_quality_ranking": _op2,
    "op3_secret_scan": _op3,
    "op4_winnowing": _op4,
    "op5_simhash_dedup": _op5,
    "op6_packing": _op6,
    "op7_language_id": _op7,
    "op8_decontamination": _op8,
    "op9_license_scan": _op9,
    "op10_line_dedup": _op10,
    "op11_exact_dedup": _op11,
    "op12_spelling_variants": _op12,
    "op13_importance_resampling": _op13,
}

ORACLES: dict[str, str] = {
    "op1_chat_formatting": chat.ORACLE,
    "op8_decontamination": decontaminate.ORACLE,
    "op9_license_scan": licences.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op11_exact_dedup": exact.ORACLE,
    "op12_spelling_variants": spelling.ORACLE,
    "op13_importance_resampling": resample.ORACLE,
}
