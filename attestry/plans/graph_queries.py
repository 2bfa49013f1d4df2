"""Queries on links of web pages and of a small vault, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import links

#: A vault of four files that has every state of a link, for tests.
VAULT = [
    ("raw/papers/demo/ch-01-start.md", "A block. ^demo-ch01-0001\nAnother one. ^demo-ch01-0002"),
    ("raw/papers/other/ch-01-start.md", "Elsewhere. ^other-ch01-0001"),
    ("raw/papers/demo/ch-02-end.md", "The last. ^demo-ch02-0001"),
    (
        "concepts/page.md",
        "![[raw/papers/demo/ch-01-start#^demo-ch01-0001]] [[raw/papers/demo/ch-01-start#^demo-ch01-0009|^ch01-0009]] [[demo/ch-02-end#^demo-ch02-0001]] "
        "[[ch-01-start#^demo-ch01-0001]] [[ch-02-end#^demo-ch02-0001|x]] [[nowhere#^demo-ch01-0001]] ![[raw/papers/demo/ch-01-start#^[demo-ch01-0001]]] [[demo-ch01-0002]]\n- extracted_from::[[ch-02-end#^demo-ch02-0001]]",
    ),
]


def vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chapter files with a block each, and as pages that link to it in one of seven forms, by number, and to the next page."""
    d, src = F.col("doc_id"), F.col("source")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    stem, block = F.concat(F.lit("ch-"), d % 50), F.concat("source", F.lit("-ch01-"), d + 1000)
    path = F.concat(F.lit("raw/papers/"), src, F.lit("/"), d, F.lit("/"), stem)
    chapters = docs.select(F.concat(path, F.lit(".md")).alias("file"), F.concat(F.lit("A block. ^"), block).alias("text"))
    forms = [("![[", path, "#^", block, "]]"), ("[[", path, "#^", src, "-ch01-0]]"), ("[[", d, "/", stem, "#^", block, "]]"), ("[[", stem, "#^", block, "|x]]"), ("[[nowhere", d, "#^", block, "]]"), ("![[", path, "#^[", block, "]]]"), ("[[", block, "]]")]
    link = F.element_at(F.array(*(F.concat(*(F.lit(x) if isinstance(x, str) else x for x in f)) for f in forms)), (d % 7 + 1).cast("int"))
    predicate = F.when(d % 3 == 0, "defined_by").otherwise("extracted_from")
    pages = docs.select(F.concat(F.lit("concepts/p"), d, F.lit(".md")).alias("file"), F.concat(F.lit("See "), link, F.lit("\n- "), predicate, F.lit("::[[p"), d + 1, F.lit("]]")).alias("text"))
    return chapters.union(pages)


def _hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.hrefs(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hrefs(spark, sf_dir).groupBy("page_id", "href").agg(F.count("*").alias("n"))


def link_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as files, named by their addresses; each page links to the end of its own address and to what it refers to."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.rtrim(F.regexp_replace("url", r"^https?://|[?#].*$", ""), F.lit("/")).alias("p"))
    files = pages.select(F.concat("p", F.lit(".md")).alias("file"), F.lit("").alias("text")).distinct()
    own = pages.select("page_id", F.regexp_extract("p", r"([^/]*/[^/]*)$", 1).alias("target"))
    other = _hrefs(spark, sf_dir).select("page_id", F.regexp_replace("href", "^/", "").alias("target"))
    named = own.union(other).distinct().filter("target <> ''")
    asked = named.select(F.col("page_id").cast("string").alias("file"), F.col("target").alias("raw"), F.lit(False).alias("embed"), "target", F.lit("").alias("anchor"), F.lit(None).cast("string").alias("status"))
    found = links.resolve_links(asked, files)
    return found.select(F.col("file").cast("long").alias("page_id"), "target", F.when(F.col("status") == "anchor_missing", "found").otherwise(F.col("status")).alias("status"))


def link_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_resolve(spark, sf_dir).groupBy("status").agg(F.count("*").alias("links"))


def vault_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = vault(spark, sf_dir)
    return links.resolve_links(links.extract_links(files), files)


def vault_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.totals(vault_links(spark, sf_dir))


def vault_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = vault(spark, sf_dir)
    return links.repair(files, links.owners(files))


def predicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.predicate_counts(vault(spark, sf_dir))


def incoming_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.incoming_edges(vault(spark, sf_dir))


def ghost_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.ghost_links(vault(spark, sf_dir))


def typed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as concepts: their lines' parts are blocks, those shipped in a hurry formulas, returned ones warnings; cheap parts have files of their own."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    row = lambda c: F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("l_linenumber", "l_partkey", "l_suppkey")))), lambda x: x["l_partkey"].cast("string"))
    made = lines.groupBy("l_orderkey").agg(row(F.lit(True)).alias("block_ids"), row(F.col("l_linestatus") == "F").alias("formula_ids"), row(F.col("l_returnflag") == "R").alias("warning_ids"))
    refs = spark.read.parquet(f"{sf_dir}/part.parquet").filter("p_size < 10").select(F.col("p_partkey").cast("string").alias("block_id"), "p_brand").select("block_id", F.col("p_brand").alias("ref"))
    edges = links.typed_edges(made.select(F.col("l_orderkey").cast("string").alias("slug"), F.lit("src").alias("source"), "block_ids", "formula_ids", "warning_ids"), refs)
    return links.relation_lines(edges).select("slug", "predicate", "block_id", F.col("pos").cast("long").alias("pos"), "target", "line")


QUERIES = {f.__name__: f for f in (link_extract, link_resolve, link_totals, vault_links, vault_totals, vault_repair, predicate_counts, incoming_edges, ghost_links, typed_edges)}

_VAULT = """d AS (SELECT doc_id AS i, source, 'ch-' || doc_id % 50 AS stem, source || '-ch01-' || (doc_id + 1000) AS block, 'raw/papers/' || source || '/' || doc_id || '/ch-' || doc_id % 50 AS path FROM documents),
  ends AS (SELECT a.i, count(*) AS n FROM d a JOIN d b ON a.stem = b.stem AND ends_with(b.path, a.i || '/' || a.stem) GROUP BY a.i), names AS (SELECT stem, count(*) AS n FROM d GROUP BY stem),
  asked AS (SELECT d.*, i % 7 AS k, ends.n AS e, names.n AS s, 'concepts/p' || i || '.md' AS file, CASE i % 7
    WHEN 0 THEN '![[' || path || '#^' || block || ']]' WHEN 1 THEN '[[' || path || '#^' || source || '-ch01-0]]' WHEN 2 THEN '[[' || i || '/' || stem || '#^' || block || ']]' WHEN 3 THEN '[[' || stem || '#^' || block || '|x]]'
    WHEN 4 THEN '[[nowhere' || i || '#^' || block || ']]' WHEN 5 THEN '![[' || path || '#^[' || block || ']]]' ELSE '[[' || block || ']]' END AS raw FROM d JOIN ends USING (i) JOIN names USING (stem)),
  found AS (SELECT file, raw, starts_with(raw, '!') AS embed, CASE k WHEN 0 THEN path WHEN 1 THEN path WHEN 2 THEN i || '/' || stem WHEN 3 THEN stem WHEN 4 THEN 'nowhere' || i WHEN 5 THEN path ELSE block END AS target,
    CASE k WHEN 1 THEN source || '-ch01-0' ELSE block END AS anchor,
    CASE k WHEN 0 THEN 'ok' WHEN 1 THEN 'anchor_missing' WHEN 2 THEN CASE WHEN e > 1 THEN 'target_ambiguous' ELSE 'suffix_match' END WHEN 3 THEN CASE WHEN s > 1 THEN 'target_ambiguous' ELSE 'ok' END
      WHEN 4 THEN 'target_missing' WHEN 5 THEN 'malformed_bracket_anchor' ELSE 'malformed_anchorless_id' END AS status,
    CASE WHEN k < 2 OR (k = 2 AND e = 1) OR (k = 3 AND s = 1) THEN path ELSE '' END AS resolved FROM asked)"""

_HREFS = """hrefs AS (SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href=["'']([^"''#]*)', 1)) AS href FROM pages)"""
_RESOLVED = f"""{_HREFS}, p AS (SELECT page_id, rtrim(regexp_replace(url, '^https?://|[?#].*$', '', 'g'), '/') AS p FROM pages), paths AS (
  SELECT DISTINCT p AS path, string_split(p, '/')[-1] AS stem FROM p
), asked AS (
  SELECT page_id, regexp_extract(p, '([^/]*/[^/]*)$', 1) AS target FROM p UNION SELECT page_id, regexp_replace(href, '^/', '') FROM hrefs
), names AS (SELECT DISTINCT target, regexp_replace(target, '\\.md$', '') AS name FROM asked WHERE target <> ''), n AS (
  SELECT target, name, count(path) AS n, bool_or(path = name) AS exact FROM names LEFT JOIN paths ON CASE WHEN contains(name, '/') THEN ends_with(path, name) ELSE stem = name END GROUP BY ALL
), resolved AS (
  SELECT page_id, target, CASE WHEN contains(name, '/') AND exact THEN 'found' WHEN n = 0 THEN 'target_missing' WHEN n > 1 THEN 'target_ambiguous' ELSE 'found' END AS status FROM asked JOIN n USING (target)
)"""

ORACLES = {
    "link_extract": f"WITH {_HREFS} SELECT page_id, href, count(*) AS n FROM hrefs GROUP BY ALL",
    "link_resolve": f"WITH {_RESOLVED} SELECT page_id, target, status FROM resolved",
    "link_totals": f"WITH {_RESOLVED} SELECT status, count(*) AS links FROM resolved GROUP BY status",
    "vault_links": f"WITH {_VAULT} SELECT * FROM found",
    "vault_totals": f"WITH {_VAULT} SELECT status, count(*) AS links, status NOT IN ('ok', 'suffix_match') AS dead FROM found GROUP BY status",
    # what was malformed counts as rewritten and then, in its new form, as canonical
    "vault_repair": f"""WITH {_VAULT} SELECT path || '.md' AS file, 'A block. ^' || block AS text, 0::BIGINT AS canonical, 0::BIGINT AS rewritten, 0::BIGINT AS unresolved FROM d
        UNION ALL SELECT file, 'See ' || CASE k WHEN 0 THEN raw WHEN 1 THEN '`^' || source || '-ch01-0` *(unresolved source block)*' WHEN 5 THEN '![[' || path || '#^' || block || ']]'
          ELSE '[[' || path || '#^' || block || CASE k WHEN 3 THEN '|x]]' ELSE '|^ch01-' || (i + 1000) || ']]' END END || chr(10) || '- ' || CASE WHEN i % 3 = 0 THEN 'defined_by' ELSE 'extracted_from' END || '::[[p' || (i + 1) || ']]',
          (k IN (0, 5, 6))::BIGINT, (k > 1)::BIGINT, (k = 1)::BIGINT FROM asked""",
    "predicate_counts": "SELECT CASE WHEN doc_id % 3 = 0 THEN 'defined_by' ELSE 'extracted_from' END AS predicate, count(*) AS edges, count(DISTINCT doc_id) AS files FROM documents GROUP BY 1",
    "incoming_edges": "SELECT 'p' || (doc_id + 1) AS target, count(*) AS edges FROM documents GROUP BY 1",
    "ghost_links": """WITH g AS (SELECT 'p' || (doc_id + 1) AS target FROM documents WHERE doc_id + 1 NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT 'nowhere' || doc_id FROM documents WHERE doc_id % 7 = 4
        UNION ALL SELECT source || '-ch01-' || (doc_id + 1000) FROM documents WHERE doc_id % 7 = 6) SELECT target, count(*) AS n FROM g GROUP BY target""",
    "typed_edges": """WITH l AS (SELECT l_orderkey::VARCHAR AS slug, l_partkey::VARCHAR AS b, l_linestatus = 'F' AS f, l_returnflag = 'R' AS r, struct_pack(x := l_linenumber, y := l_partkey, z := l_suppkey) AS o FROM lineitem),
        u AS (SELECT slug, b, row_number() OVER (PARTITION BY slug ORDER BY min(o)) - 1 AS pos FROM l GROUP BY slug, b),
        e AS (SELECT slug, 'extracted_from' AS predicate, b, pos FROM u UNION ALL SELECT slug, 'defined_by', b, pos FROM u WHERE pos = 0
          UNION ALL SELECT slug, 'formulated_by', b, row_number() OVER (PARTITION BY slug ORDER BY o) - 1 AS pos FROM l WHERE f QUALIFY pos < 3
          UNION ALL SELECT slug, 'warned_by', b, row_number() OVER (PARTITION BY slug ORDER BY o) - 1 AS pos FROM l WHERE r QUALIFY pos < 3)
        SELECT slug, predicate, b AS block_id, pos, coalesce(p_brand, 'src') AS target, '- ' || predicate || '::[[' || coalesce(p_brand, 'src') || '#^' || b || '|^' || b || ']]' AS line FROM e LEFT JOIN part ON p_partkey::VARCHAR = b AND p_size < 10""",
}
