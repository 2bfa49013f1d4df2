"""Queries on evidence: quotes, demotions, words, overlaps and references, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import blocks, concepts, grounding


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def claims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Claims that a labelled document's first line stands in the document itself or, for low quality, in the next one."""
    docs, labels = _tables(spark, sf_dir, "documents", "labels")
    first = docs.join(labels, "doc_id").select("lang", (F.col("doc_id") + (1 - F.col("quality"))).cast("string").alias("block_id"), F.when(F.col("toxic") == 1, "INFERRED").otherwise("EXTRACTED").alias("confidence"), F.substring_index("text", "\n", 1).alias("quote_verbatim"), F.col("doc_id").alias("claim"))
    return first, docs.select(F.col("doc_id").cast("string").alias("block_id"), "text")


def claim_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grounding.ground_claims(*claims(spark, sf_dir)).select("claim", "block_id", "effective_confidence", "demoted")


def demotion_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grounding.demotion_rates(grounding.ground_claims(*claims(spark, sf_dir)), ["lang"])


def quote_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _tables(spark, sf_dir, "documents", "benchmark")
    return grounding.quotes_in_texts(items, blocks.spread(docs))


def word_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    (items,) = _tables(spark, sf_dir, "benchmark")
    words = F.array_sort(text.content_words("text"))
    return items.select("item_id", F.size(words).cast("long").alias("n"), F.array_join(words, " ").alias("words"))


def lexical_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages, some of their lines as quotes or provenance, and the benchmark items of their number, in turn, as what they cite."""
    docs, items = _tables(spark, sf_dir, "documents", "benchmark")
    n = items.count()
    rows = F.transform(F.split("text", "\n"), lambda x, i: F.concat(F.when(i % 3 == 0, "  > ").when(i % 5 == 1, "- `").when(i % 7 == 2, "![[a longword]] ").otherwise(""), x))
    cited = docs.select(F.col("doc_id").alias("page"), (F.col("doc_id") % max(1, n)).alias("item_id")).join(items, "item_id", "left").select("page", "text")
    return grounding.lexical_overlap(docs.select(F.col("doc_id").alias("page"), F.array_join(rows, "\n").alias("text")), cited, 0.01)


def grounding_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grounding.grounding_totals(grounding.ground_claims(*claims(spark, sf_dir)))


def attached_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as claims on their parts, and parts of a brand and size as concepts of every order's file."""
    (lines,) = _tables(spark, sf_dir, "lineitem")
    made = lines.select(F.col("l_orderkey").alias("file"), F.col("l_partkey").cast("string").alias("block_id"), "l_linenumber")
    # a concept may come in any number of rows: its blocks need not be gathered first
    cited = lines.select(F.col("l_orderkey").alias("file"), F.concat(F.lit("s"), F.col("l_suppkey") % 7).alias("slug"), F.array(F.col("l_partkey").cast("string")).alias("block_ids"))
    return concepts.attached_claims(cited, made).select("slug", "file", "block_id", "l_linenumber")


def dead_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without labels, as references to labels."""
    docs, labels = _tables(spark, sf_dir, "documents", "labels")
    found = grounding.dead_references(docs.select("doc_id", "source"), labels, "doc_id", "source")
    return found.select("doc_id", "n", F.array_join("sources", ",").alias("sources"))


QUERIES = {f.__name__: f for f in (claim_grounding, demotion_rate, quote_grounding, word_sets, lexical_overlap, dead_references, grounding_totals, attached_claims)}

_QUOTE = lambda c: rf"trim(regexp_replace(regexp_replace({c}, '[*_`]+', '', 'g'), '\s+', ' ', 'g'))"
_STOP = "[" + ", ".join(f"'{w}'" for w in rules.STOP_WORDS) + "]"
_WORDS = lambda c: f"[w FOR w IN list_distinct([lower(x) FOR x IN regexp_extract_all({c}, '[A-Za-z][A-Za-z0-9_-]{{2,}}')]) IF length(w) > 3 AND NOT list_contains({_STOP}, w)]"
_CLAIMS = f"""claims AS (
  SELECT lang, doc_id + 1 - quality AS block_id, CASE WHEN toxic = 1 THEN 'INFERRED' ELSE 'EXTRACTED' END AS confidence, string_split(text, chr(10))[1] AS quote, doc_id AS claim FROM documents JOIN labels USING (doc_id)
), grounded AS (
  SELECT c.*, confidence = 'EXTRACTED' AND NOT coalesce({_QUOTE('quote')} <> '' AND contains({_QUOTE('d.text')}, {_QUOTE('quote')}), false) AS demoted FROM claims c LEFT JOIN documents d ON d.doc_id = c.block_id
)"""

ORACLES = {
    "claim_grounding": f"WITH {_CLAIMS} SELECT claim, block_id::VARCHAR AS block_id, CASE WHEN demoted THEN 'AMBIGUOUS' ELSE confidence END AS effective_confidence, demoted FROM grounded",
    "demotion_rate": f"""WITH {_CLAIMS}, n AS (SELECT lang, count(*) FILTER (confidence = 'EXTRACTED') AS extracted, count(*) FILTER (demoted) AS demoted FROM grounded GROUP BY lang)
        SELECT lang, extracted, demoted, coalesce(round(demoted / nullif(extracted, 0), 4), 0) AS rate, extracted > 0 AND demoted / extracted > 0.2 AS fails FROM n""",
    "quote_grounding": f"SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains({_QUOTE('d.text')}, {_QUOTE('b.text')})",
    "word_sets": f"SELECT item_id, len(w)::BIGINT AS n, array_to_string(list_sort(w), ' ') AS words FROM (SELECT item_id, {_WORDS('text')} AS w FROM benchmark)",
    "grounding_totals": f"""WITH {_CLAIMS} SELECT count(*) AS claims, count(*) FILTER (confidence = 'EXTRACTED') AS extracted, count(*) FILTER (demoted) AS demoted, count(*) FILTER (confidence = 'INFERRED') AS inferred, count(*) FILTER (demoted OR confidence = 'AMBIGUOUS') AS ambiguous,
          round(count(*) FILTER (demoted) / count(*) FILTER (confidence = 'EXTRACTED'), 4) AS rate FROM grounded""",
    "attached_claims": """WITH c AS (SELECT DISTINCT l_orderkey AS file, 's' || l_suppkey % 7 AS slug, l_partkey FROM lineitem) SELECT slug, file, l.l_partkey::VARCHAR AS block_id, l_linenumber FROM lineitem l JOIN c ON c.file = l.l_orderkey AND c.l_partkey = l.l_partkey""",
    "lexical_overlap": f"""WITH i AS (SELECT item_id, {_WORDS('text')} AS s FROM benchmark), r AS (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
        o AS (SELECT doc_id, string_agg(regexp_replace(x, '!\\[\\[[^\\]]+\\]\\]', '', 'g'), chr(10) ORDER BY i) FILTER (i % 3 <> 0 AND i % 5 <> 1 AND NOT starts_with(trim(x), '>')) AS own, string_agg(CASE WHEN i % 3 <> 0 AND i % 5 <> 1 AND i % 7 = 2 THEN 'longword ' ELSE '' END || x, chr(10) ORDER BY i) AS whole FROM r GROUP BY doc_id),
        d AS (SELECT doc_id, {_WORDS("coalesce(whole, '')")} AS p, {_WORDS("coalesce(own, '')")} AS q FROM documents LEFT JOIN o USING (doc_id)), j AS (
        SELECT doc_id, s, CASE WHEN len(p) = 0 OR len(s) = 0 THEN 0 ELSE len(list_intersect(p, s)) / len(list_distinct(list_concat(p, s))) END AS f, CASE WHEN len(q) = 0 OR len(s) = 0 THEN 0 ELSE len(list_intersect(q, s)) / len(list_distinct(list_concat(q, s))) END AS o FROM d LEFT JOIN i ON i.item_id = doc_id % (SELECT count(*) FROM benchmark))
        SELECT doc_id AS page, coalesce(round(f, 4), 0) AS full_overlap, coalesce(round(o, 4), 0) AS synthesis_overlap, CASE WHEN s IS NULL THEN 'MISSING_BLOCK' WHEN o >= 0.01 THEN 'PASS' ELSE 'LOW_OVERLAP' END AS status FROM j""",
    "dead_references": "SELECT doc_id, count(*) AS n, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id",
}
