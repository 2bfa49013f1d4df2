"""Queries on concepts, made of order lines: parts are concepts, ship months chapters, discounts doubts; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import concepts
from ..sources.scratch import materialize


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slug, name, chapter, confidence, density and ord of each order line."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_quantity", "l_shipdate")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name")
    slug = F.regexp_replace(F.lower("p_name"), "[^a-z0-9]+", "-")
    # parts grow with the lines: never a broadcast, however small their file is
    return lines.join(parts.hint("shuffle_hash"), lines["l_partkey"] == parts["p_partkey"]).select(
        slug.alias("slug"),
        F.col("p_name").alias("name"),
        F.month("l_shipdate").alias("chapter"),
        (F.lit(1) - F.col("l_discount")).alias("confidence"),
        (F.col("l_quantity") / 10).alias("density"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("ord"),
    )


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concepts.merge(mentions(spark, sf_dir))


def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged concepts' slugs, written once for queries that read them in several places."""
    return materialize(merged(spark, sf_dir).select("slug"))


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as concepts, with what their order lines give them: few have all kinds of evidence."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    given = lambda c, t: F.when(c, F.array(F.col(t).cast("string"))).otherwise(F.array().cast("array<string>"))
    return lines.select(
        F.concat(F.lit("part-"), F.col("l_partkey") + 1000, F.when(F.col("l_linenumber") > 3, "s").otherwise("")).alias("slug"), F.lit("n").alias("name"), F.month("l_shipdate").alias("chapter"), (F.lit(1) - F.col("l_discount") * 4).alias("confidence"), (F.col("l_quantity") / 11).alias("density"),
        F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("ord"), given(F.col("l_quantity") <= 2, "l_orderkey").alias("definitions"), given(F.col("l_discount") == 0, "l_orderkey").alias("examples"),
        given(F.col("l_tax") == 0.08, "l_orderkey").alias("formulas"), given(F.col("l_suppkey") % 10 == 0, "l_orderkey").alias("warnings"), given(F.col("l_returnflag") == "R", "l_orderkey").alias("cross_references"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concepts.scored(concepts.tallied(evidence(spark, sf_dir)))


def merged_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same concepts with their lists, merged and folded, and the score that the lists give."""
    found = concepts.scored(concepts.fold(concepts.merge(evidence(spark, sf_dir))))
    count = lambda c: F.size(c).cast("long").alias(c)
    return found.select("slug", count("definitions"), count("examples"), count("formulas"), count("warnings"), count("cross_references"), F.get("definitions", F.lit(0)).alias("first_definition"), F.col("score").cast("long"))


def blocks_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts that cite documents: the source is the slug, a document its block."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("source").alias("slug"), F.concat(F.col("source"), F.lit("-ch01-"), "doc_id").alias("block_id"), F.lit(12).alias("score"), "doc_id")
    return docs


def slug_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    slug = F.regexp_replace(F.lower(F.concat("p_name", F.lit("s s "), "p_type")), "[^a-z0-9]+", "-")
    return parts.select(slug.alias("slug"), text.normal_slug(slug).alias("norm"), text.is_clean_slug(slug).alias("clean")).groupBy("slug", "norm", "clean").agg(F.count("*").alias("n"))


def concept_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = merged(spark, sf_dir)
    return m.select("slug", "name", F.array_join(F.col("chapters").cast("array<string>"), ",").alias("chapters"), F.round("confidence", 6).alias("confidence"), F.round("density", 6).alias("density"), "source_count")


def concept_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = merged(spark, sf_dir)
    both = m.unionByName(m.withColumn("slug", F.concat("slug", F.lit("s"))))
    return concepts.fold(both).select("slug", "norm", "source_count", F.size("chapters").cast("long").alias("n_chapters"), F.array_join("merged_slugs", ",").alias("merged_slugs"))


def concept_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("slug", F.col("score").cast("long"))


def score_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concepts.threshold(scored(spark, sf_dir), 12, 20).select("slug", F.col("score").cast("long"))


def artifact_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean and unclean slugs of parts, some with remains of markup put before."""
    m = slugs(spark, sf_dir)
    made = m.union(m.select(F.concat(F.lit("quad-"), "slug"))).union(m.select(F.concat(F.lit("1-"), "slug"))).union(m.select(F.left("slug", F.lit(2))))
    good, bad = concepts.clean(made.distinct())
    return good.select("slug", F.lit(True).alias("kept")).union(bad.select("slug", F.lit(False)))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = slugs(spark, sf_dir)
    return concepts.near_duplicates(m.union(m.select(F.concat("slug", F.lit("s")))).union(m.select(F.concat(F.lit("big-"), "slug"))))


def strongest_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_returnflag").alias("flag"), F.col("l_suppkey").cast("string").alias("block_id"))
    return concepts.strongest_blocks(lines, "flag").select("flag", "block_id", "votes", F.col("rank").cast("long").alias("rank"))


def ambiguous_downweight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as concepts of their parts; a part that was returned at a high discount is ambiguous."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    id_ = F.col("l_partkey").cast("string")
    made = lines.groupBy(F.col("l_orderkey").cast("string").alias("slug")).agg(F.collect_list(id_).alias("block_ids")).withColumn("score", F.lit(3))
    bad = lines.filter("l_returnflag = 'R' and l_discount >= 0.095").select(id_.alias("block_id"))
    return concepts.downweight(made, bad).select("slug", F.col("ambiguous_claim_count").cast("long"), F.col("score").cast("long"))


def concept_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts and their plurals as concepts; parts as mentions under either form, types as files, brands as lanes."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    slug = F.regexp_replace(F.lower("p_name"), "[^a-z0-9]+", "-")
    made = parts.select(slug.alias("slug")).distinct().select("slug", F.when(F.col("slug") < "m", F.array("slug", F.concat("slug", F.lit("s")))).alias("merged_slugs"))
    said = parts.select(F.col("p_type").alias("file"), F.col("p_brand").alias("lane"), F.concat(slug, F.when(F.col("p_size") % 2 == 0, "s").otherwise("")).alias("slug"), F.col("p_size").alias("chapter"), F.lit("t").alias("chapter_title"), F.array(F.col("p_partkey").cast("string"), F.lit(""), F.lit("b"), F.col("p_partkey").cast("string")).alias("block_ids"))
    out = concepts.concept_sources(made, said)
    return out.select("slug", "file", "lane", "chapter", F.array_join("block_ids", ",").alias("block_ids"))


def rank_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concepts.ranked(scored(spark, sf_dir)).select("slug", F.col("score").cast("long"), F.col("rank").cast("long"))


def selection_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = slugs(spark, sf_dir)
    chosen = m.union(m.filter("slug < 'c'")).union(m.select(F.concat(F.lit("no-"), "slug")))
    return concepts.selection_issues(chosen, m, concepts.near_duplicates(chosen))


def known_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = slugs(spark, sf_dir)
    return concepts.known_duplicates(m, m.select(F.concat("slug", F.lit("s")).alias("slug")))


QUERIES = {f.__name__: f for f in (slug_normalize, concept_merge, concept_fold, concept_score, score_threshold, artifact_filter, near_duplicates, strongest_blocks, ambiguous_downweight, rank_candidates, selection_check, known_duplicates, concept_sources, merged_evidence)}

_NORM = "array_to_string([CASE WHEN length(t) > 3 AND t LIKE '%s' AND t NOT LIKE '%ss' THEN left(t, -1) ELSE t END FOR t IN string_split(lower(slug), '-') IF t <> '' AND t <> 's'], '-')"
_MENTIONS = """mentions AS (
  SELECT regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') AS slug, p_name AS name, month(l_shipdate) AS chapter, 1 - l_discount AS confidence, l_quantity / 10 AS density,
         struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey) AS ord FROM lineitem JOIN part ON l_partkey = p_partkey
), merged AS (
  SELECT slug, arg_max(name, ord) AS name, list_sort(list(DISTINCT chapter)) AS chapters, max(confidence) AS confidence, max(density) AS density, count(*) AS source_count FROM mentions GROUP BY slug
)"""
_SCORED = """m AS (
  SELECT 'part-' || (l_partkey + 1000) AS norm, l_linenumber > 3 AS plural, month(l_shipdate) AS chapter, 1 - l_discount * 4 AS confidence, l_quantity / 11 AS density, l_quantity <= 2 AS d, l_discount = 0 AS e, l_tax = 0.08 AS f, l_suppkey % 10 = 0 AS w, l_returnflag = 'R' AS c FROM lineitem
), scored AS (
  SELECT norm || CASE WHEN bool_and(plural) THEN 's' ELSE '' END AS slug, 3 * bool_or(d)::INT + 3 * bool_or(e)::INT + 2 * bool_or(f)::INT + 2 * bool_or(w)::INT + bool_or(c)::INT + (count(DISTINCT chapter) >= 2)::INT + (count(DISTINCT chapter) >= 3)::INT
    + (max(density) >= 2)::INT + (max(density) >= 4)::INT + (max(confidence) >= 0.8)::INT + (count(*) >= 2)::BIGINT AS score FROM m GROUP BY norm
)"""
_CLEAN = r"(NOT regexp_matches(slug, '[{}\\$<>]|operatorname|quad|overline|stdtdbtdtd|^\d') AND length(slug) >= 3)"

ORACLES = {
    "slug_normalize": f"""SELECT slug, {_NORM} AS norm, {_CLEAN} AS clean, count(*) AS n
        FROM (SELECT regexp_replace(lower(p_name || 's s ' || p_type), '[^a-z0-9]+', '-', 'g') AS slug FROM part) GROUP BY ALL""",
    "concept_merge": f"WITH {_MENTIONS} SELECT slug, name, array_to_string(chapters, ',') AS chapters, round(confidence, 6) AS confidence, round(density, 6) AS density, source_count FROM merged",
    "concept_fold": f"""WITH {_MENTIONS}, both_forms AS (SELECT * FROM merged UNION ALL SELECT slug || 's', name, chapters, confidence, density, source_count FROM merged), normed AS (SELECT *, {_NORM} AS norm FROM both_forms)
        SELECT arg_min(slug, struct_pack(a := length(slug), b := slug)) AS slug, norm, sum(source_count)::BIGINT AS source_count, len(list_distinct(flatten(list(chapters))))::BIGINT AS n_chapters,
          CASE WHEN count(DISTINCT slug) > 1 THEN string_agg(DISTINCT slug, ',' ORDER BY slug) END AS merged_slugs FROM normed GROUP BY norm""",
    "concept_score": f"WITH {_SCORED} SELECT slug, score FROM scored",
    "merged_evidence": f"""WITH {_SCORED}, o AS (SELECT 'part-' || (l_partkey + 1000) AS norm, l_linenumber > 3 AS plural, l_orderkey::VARCHAR AS k, struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey) AS ord,
          l_quantity <= 2 AS d, l_discount = 0 AS e, l_tax = 0.08 AS f, l_suppkey % 10 = 0 AS w, l_returnflag = 'R' AS c FROM lineitem)
        SELECT norm || CASE WHEN bool_and(plural) THEN 's' ELSE '' END AS slug, count(*) FILTER (d) AS definitions, count(*) FILTER (e) AS examples, count(*) FILTER (f) AS formulas, count(*) FILTER (w) AS warnings, count(DISTINCT k) FILTER (c) AS cross_references,
          arg_min(k, struct_pack(x := plural, y := ord)) FILTER (d) AS first_definition, any_value(score) AS score FROM o JOIN (SELECT slug AS s, score FROM scored) ON s IN (norm, norm || 's') GROUP BY norm""",
    "score_threshold": f"WITH {_SCORED} SELECT slug, score FROM scored WHERE score >= 12 ORDER BY score DESC, slug LIMIT 20",
    "artifact_filter": f"""WITH {_MENTIONS}, made AS (SELECT slug FROM merged UNION SELECT 'quad-' || slug FROM merged UNION SELECT '1-' || slug FROM merged UNION SELECT left(slug, 2) FROM merged)
        SELECT slug, {_CLEAN} AS kept FROM made""",
    "near_duplicates": f"""WITH {_MENTIONS}, s AS (SELECT slug, {_NORM} AS n, list_distinct(string_split({_NORM}, '-')) AS t FROM (SELECT slug FROM merged UNION SELECT slug || 's' FROM merged UNION SELECT 'big-' || slug FROM merged))
        SELECT a.slug AS a, b.slug AS b, CASE WHEN a.n = b.n THEN 'identical after plural/possessive normalization' WHEN contains(a.n, b.n) OR contains(b.n, a.n) THEN 'one slug contains the other' ELSE 'token overlap >= 0.6' END AS reason
        FROM s a JOIN s b ON a.slug < b.slug WHERE a.n = b.n OR contains(a.n, b.n) OR contains(b.n, a.n)
          OR len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) >= 0.6""",
    "strongest_blocks": """SELECT flag, block_id, votes, rank FROM (SELECT l_returnflag AS flag, l_suppkey::VARCHAR AS block_id, count(*) AS votes, row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_suppkey::VARCHAR) AS rank
        FROM lineitem GROUP BY 1, 2) WHERE rank <= 5""",
    "ambiguous_downweight": """WITH b AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.095), n AS (SELECT l_orderkey, count(DISTINCT b.l_partkey) AS n FROM lineitem l LEFT JOIN b ON b.l_partkey = l.l_partkey GROUP BY 1)
        SELECT l_orderkey::VARCHAR AS slug, n AS ambiguous_claim_count, greatest(0, 3 - n) AS score FROM n""",
    "concept_sources": """WITH p AS (SELECT *, regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g') AS slug FROM part)
        SELECT slug, p_type AS file, p_brand AS lane, p_size AS chapter, p_partkey || ',b' AS block_ids FROM p WHERE p_size % 2 = 1 OR slug < 'm'""",
    "rank_candidates": f"WITH {_SCORED} SELECT slug, score, row_number() OVER (ORDER BY score DESC, slug) AS rank FROM scored",
    "selection_check": f"""WITH {_MENTIONS}, s AS (SELECT slug, {_NORM} AS n, list_distinct(string_split({_NORM}, '-')) AS t FROM (SELECT slug FROM merged UNION SELECT 'no-' || slug FROM merged))
        SELECT slug, 'selected more than once' AS issue FROM merged WHERE slug < 'c' UNION ALL SELECT 'no-' || slug, 'not a candidate' FROM merged
        UNION ALL SELECT a.slug, 'near duplicate of ' || b.slug FROM s a JOIN s b ON a.slug < b.slug WHERE a.n = b.n OR contains(a.n, b.n) OR contains(b.n, a.n) OR len(list_intersect(a.t, b.t)) / len(list_distinct(list_concat(a.t, b.t))) >= 0.6""",
    "known_duplicates": f"""WITH {_MENTIONS}, pages AS (SELECT slug || 's' AS slug FROM merged), p AS (SELECT slug AS existing, {_NORM} AS norm FROM pages), o AS (SELECT slug, {_NORM} AS norm FROM merged)
        SELECT slug, existing FROM o JOIN p USING (norm) WHERE slug NOT IN (SELECT slug FROM pages)""",
}
