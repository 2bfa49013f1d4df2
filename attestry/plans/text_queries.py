"""Queries on document texts: lines, blocks, categories, chapters and sizes, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import blocks, chapters


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as chapter files: the source is the slug, the document its chapter."""
    docs = documents(spark, sf_dir)
    return docs.select(F.col("source").alias("slug"), F.col("doc_id").alias("chapter"), F.col("doc_id").alias("file"), "text")


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.annotate(files(spark, sf_dir))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.block_categories(blocks.spread(files(spark, sf_dir)))


def kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The categories of all new blocks, for what needs no ids: each file's lines are judged where they were read."""
    return blocks.classify(blocks.new_blocks(blocks.spread(files(spark, sf_dir))))


def line_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.explode_lines(documents(spark, sf_dir), ["doc_id"]).select("doc_id", F.col("line_no").cast("long").alias("line_no"), "line")


def substantive_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blocks.substantive_lines(documents(spark, sf_dir), ["doc_id"])
    return found.groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum("line_no").alias("places"))


def block_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotated(spark, sf_dir).select("block_id", F.col("line_no").cast("long").alias("line_no"), "text")


def block_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).select("block_id", "category")


def category_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.category_pivot(kinds(spark, sf_dir), "slug")


def block_id_multiset_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all blocks against those of blocks outside the transitional category."""
    found = classified(spark, sf_dir)
    return blocks.multiset_difference(found, found.filter(F.col("category") != rules.TRANSITION), "block_id").select("block_id", F.col("missing").cast("long"), F.col("extra").cast("long"))


def duplicate_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = annotated(spark, sf_dir).select(F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "block_id")
    return blocks.duplicates(hashed, ["sha"], "block_id")


def slop_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.lit("documents").alias("kind"), F.col("doc_id").alias("id"), "text")
    said = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.lit("conversations"), "conv_id", "text")
    return docs.union(said).groupBy("kind").agg(F.count("*").alias("texts"), F.count_if(text.placeholder("text")).alias("slop"))


def section_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.section_diversity(kinds(spark, sf_dir).withColumnRenamed("file", "doc_id"), "doc_id")


def evidence_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.evidence_share(kinds(spark, sf_dir), "slug")


def boundary_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's headline lines (ten words or fewer) as the starts of its chapters, and their ends."""
    rows = blocks.explode_lines(documents(spark, sf_dir), ["doc_id"])
    sizes = rows.groupBy("doc_id").agg(F.max("line_no").alias("line_count"))
    starts = rows.filter((text.word_count("line") <= 10) & (text.strip("line") != "")).select(F.col("doc_id").alias("slug"), F.col("line_no").alias("chapter"), F.col("line").alias("title"), (F.col("line_no") - 1).alias("line_start"), F.lit(None).cast("int").alias("line_end"))
    out = chapters.normal_boundaries(starts, sizes.withColumnRenamed("doc_id", "slug"))
    return out.select(F.col("slug").alias("doc_id"), F.col("line_start").cast("long"), F.col("line_end").cast("long"), "title", F.coalesce("issue", F.lit("")).alias("issue"))


def size_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chapters.size_split(documents(spark, sf_dir), "doc_id", 20, 3)


def chapter_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = documents(spark, sf_dir).select("doc_id", F.col("doc_id").alias("chapter"), F.get(text.lines("text"), F.lit(0)).alias("title"))
    named = first.withColumn("title", F.regexp_replace("title", "[^ -~]", ""))
    return named.select("doc_id", text.clean_title("title").alias("title"), text.file_stem("title", "chapter").alias("stem"), text.unit_id("chapter", text.file_stem("title", "chapter")).alias("unit_id"), text.is_slug("title").alias("is_slug"))


def _held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files, of which every fifth has an id on its first line already."""
    named = F.concat(F.lit(" ^"), "slug", F.lit("-ch"), F.lpad(F.col("chapter").cast("string"), 2, "0"), F.lit("-0001\n"))
    named = F.when(F.col("chapter") < 100, named).otherwise(F.concat(F.lit(" ^"), "slug", F.lit("-ch"), "chapter", F.lit("-0001\n")))
    first = F.concat(F.substring_index("text", "\n", 1), named, F.expr("substring(text, locate('\n', text) + 1)"))
    return files(spark, sf_dir).withColumn("text", F.when((F.col("chapter") % 5 == 0) & F.contains("text", F.lit("\n")), first).otherwise(F.col("text")))


def annotation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blocks.annotation_totals(_held(spark, sf_dir))
    return found.select("slug", F.coalesce(F.col("file").cast("string"), F.lit("")).alias("file"), "added", "preserved", "block_ids", "substantive_lines")


def annotation_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with ids by number on their first lines: their own, another chapter's, another slug's, a short one, one that repeats, or none."""
    d = F.col("doc_id")
    own = F.concat(F.col("source"), F.lit("-ch"), F.lpad((d % 90 + 10).cast("string"), 2, "0"), F.lit("-"))
    tag = F.element_at(F.array(F.concat(own, d + 10000), F.concat(F.col("source"), F.lit("-ch09-"), d + 10000), F.concat(F.lit("x-"), own, d + 10000), F.concat(own, F.lit("7")), F.concat(own, F.lit("0001")), F.lit("")), (d % 6 + 1).cast("int"))
    body = F.concat(F.lit("# H\nword "), F.when(tag != "", F.concat(F.lit("^"), tag)).otherwise(""), F.lit("\n"), F.regexp_replace(F.coalesce("text", F.lit("")), r"\^", ""))
    made = documents(spark, sf_dir).select(F.col("source").alias("slug"), (d % 90 + 10).cast("int").alias("chapter"), d.alias("file"), body.alias("text"))
    found = blocks.annotation_issues(made)
    return found.select("slug", F.coalesce("file", F.lit(-1)).alias("file"), F.coalesce(F.col("line_no").cast("long"), F.lit(-1)).alias("line_no"), F.coalesce("block_id", F.lit("")).alias("block_id"), "issue")


def evidence_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as presentations: a line's number names the section, its parts are cited, large ones embedded."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    heads = F.array(*(F.lit(h) for hs in blocks.SECTIONS.values() for h in hs))
    id_ = F.concat(F.lit("d-ch01-"), "l_partkey")
    body = F.concat(F.lit("^"), id_, F.lit("\n\n"), F.when(F.col("l_quantity") > 25, F.concat(F.lit("![[c#^"), id_, F.lit("]]"))).otherwise(""))
    header = F.element_at(heads, ((F.col("l_linenumber") + F.col("l_partkey")) % F.size(heads) + 1).cast("int"))
    m = blocks.balance_metrics(lines.select(F.col("l_orderkey").alias("unit_id"), header.alias("header"), body.alias("body")))
    return m.select("unit_id", "category", "citations", "unique", "embeds", "lines", "share_total", "share_body", "required")


QUERIES = {f.__name__: f for f in (annotation_totals, line_explode, substantive_lines, block_annotate, block_classify, category_pivot, block_id_multiset_check, duplicate_blocks, slop_scan, section_diversity, evidence_share, boundary_lead, size_split, chapter_names, annotation_scan, evidence_balance)}

_LINES = r"""
raw AS (
  SELECT doc_id, source, string_split(text, chr(10)) AS a FROM documents
), lines AS (
  SELECT doc_id, source, unnest(l) AS line, unnest(range(len(l))) + 1 AS n
  FROM (SELECT doc_id, source, CASE WHEN a[-1] = '' THEN a[:-2] ELSE a END AS l FROM raw)
), bare AS (
  SELECT *, regexp_replace(line, '^\s+|\s+$', '', 'g') AS t FROM lines
)"""
_BLOCKS = rf"""{_LINES}, fenced AS (
  SELECT *, CASE WHEN t = '---' THEN row_number() OVER (PARTITION BY doc_id, t = '---' ORDER BY n) END AS fence FROM bare
), fronts AS (
  SELECT doc_id, max(n) FILTER (fence = 1) AS f1, max(n) FILTER (fence = 2) AS f2 FROM fenced GROUP BY doc_id
), masked AS (
  SELECT b.*, coalesce(n = f1 OR n = f2 OR (n > f1 AND (f2 IS NULL OR n < f2)), false) AS off,
         starts_with(t, '|') AS pipe, lead(starts_with(t, '|')) OVER (PARTITION BY doc_id ORDER BY n) AS next_pipe
  FROM bare b JOIN fronts USING (doc_id)
), granted AS (
  SELECT *, NOT off AND CASE WHEN pipe THEN NOT coalesce(next_pipe, false)
    ELSE t <> '' AND NOT starts_with(t, '#') AND NOT starts_with(t, '```') AND NOT starts_with(t, '<!--') END AS ok FROM masked
), blocks AS (
  SELECT source, doc_id, n, t, source || '-ch' || printf('%02d', doc_id) || '-' || printf('%04d', row_number() OVER (PARTITION BY doc_id ORDER BY n)) AS block_id
  FROM granted WHERE ok
)"""
_COUNT = r"len(regexp_split_to_array(t, '\s+'))"
_LIST = lambda words: "[" + ", ".join(rules.quoted(w) for w in words) + "]"
_SIGNS = lambda value, patterns: "(" + " OR ".join(f"regexp_matches({value}, {rules.quoted(p)})" for p in patterns) + ")"
_LETTERS = lambda patterns: [p.replace(r"[%\w]", r"[%\p{L}\p{N}_]").replace(r"[\w\-]", r"[\p{L}\p{N}_\-]").replace(r"\w", r"[\p{L}\p{N}_]") for p in patterns]
# the text between marks: every word of it stands between two, and what joins two words can be told apart
_MARKED = r"('#' || replace(regexp_replace(lower(t), '[^\p{L}\p{N}_ ]', '#', 'g'), ' ', '# #') || '#')"
_SAYS = lambda words: f"len([w FOR w IN {_LIST(words)} IF CASE WHEN regexp_full_match(lower(trim(w)), '[a-z0-9]+( [a-z0-9]+)*') THEN contains(marked, '#' || replace(lower(trim(w)), ' ', '# #') || '#') ELSE contains(lower(t), lower(w)) END]) > 0"
_LATE = lambda words: _SAYS(words.split("|"))
#: The rules by hand, each by itself; the first that holds counts.
_CATEGORY = rf"""coalesce([c FOR c IN [
    CASE WHEN {_SIGNS('t', _LETTERS(rules.FORMULA_SIGNS))} THEN 'Formulas' END, CASE WHEN {_SIGNS('t', _LETTERS(rules.CODE_SIGNS))} THEN 'Examples / Figures' END, CASE WHEN rtrim(t) IN ('```', '{{', '[') THEN 'Examples / Figures' END,
    CASE WHEN n_words >= 5 AND regexp_matches(t, '^[A-Z][A-Za-z\s\-/]+:\s') THEN 'Definitions' END, CASE WHEN n_words >= 8 AND {_SAYS(rules.DEFINITION_WORDS)} THEN 'Definitions' END,
    CASE WHEN n_words >= 5 AND {_LATE('is defined as|is known as|also called|refers to')} THEN 'Definitions' END, CASE WHEN n_words >= 5 AND {_SAYS(rules.WARNING_WORDS)} THEN 'Warnings / Caveats' END,
    CASE WHEN {_SAYS(rules.HISTORY_WORDS)} THEN 'Historical / Empirical References' END, CASE WHEN regexp_matches(t, '(^|[^\p{{L}}\p{{N}}_])(Figure|Table|Algorithm|Listing|Example)\s+[0-9-]') THEN 'Examples / Figures' END,
    CASE WHEN n_words >= 8 AND ({_SAYS(rules.EXAMPLE_WORDS)} OR regexp_matches(t, '[0-9]\.[0-9]') OR regexp_matches(t, '[0-9]%') OR regexp_matches(t, '\$[0-9]')) THEN 'Examples / Figures' END,
    CASE WHEN n_words <= 3 OR regexp_matches(t, '^#{{1,6}}\s') OR regexp_matches(t, '^---+\s*$') OR len([w FOR w IN {_LIST(rules.TRANSITION_PHRASES)} IF contains(lower(t), w)]) > 0 THEN 'Transitional / Structural' END,
    CASE WHEN n_words >= 12 AND {_LATE(rules.LATE_DEFINITIONS)} THEN 'Definitions' END, CASE WHEN n_words >= 12 AND ({_LATE(rules.LATE_EXAMPLES)} OR regexp_matches(lower(t), '(^|[^\p{{L}}\p{{N}}_])(e\.g\.|i\.e\.)[\p{{L}}\p{{N}}_]')) THEN 'Examples / Figures' END,
    CASE WHEN n_words >= 12 AND {_LATE(rules.LATE_WARNINGS)} THEN 'Warnings / Caveats' END, CASE WHEN n_words >= 12 AND {_LATE(rules.LATE_HISTORY)} THEN 'Historical / Empirical References' END] IF c IS NOT NULL][1], 'Transitional / Structural')"""
_CLASSED = f"{_BLOCKS}, read AS (SELECT *, {_COUNT} AS n_words, {_MARKED} AS marked FROM blocks), classed AS (SELECT *, {_CATEGORY} AS category FROM read)"
_PIVOT = ", ".join(f"count(*) FILTER (category = '{c}') AS {c.split(' ')[0].lower()}" for c in rules.CATEGORIES)
_SLOP = rules.quoted(rules.PLACEHOLDERS.replace("W", f"[^{rules.WORD}]"))

ORACLES = {
    "annotation_totals": rf"""WITH held AS (SELECT doc_id, source, source || '-ch' || printf('%02d', doc_id) || '-0001' AS id, doc_id % 5 = 0 AND contains(text, chr(10)) AS has, text FROM documents),
        edited AS (SELECT doc_id, source, has, CASE WHEN has THEN split_part(text, chr(10), 1) || ' ^' || id || chr(10) || text[instr(text, chr(10)) + 1:] ELSE text END AS text FROM held), {_BLOCKS.replace('FROM documents', 'FROM edited')},
        a AS (SELECT doc_id, count(*) AS added FROM blocks WHERE NOT regexp_matches(t, '\^' || source || '-ch[0-9]+-0001$') GROUP BY 1), l AS (
          SELECT doc_id, count(*) AS n FROM masked WHERE NOT off AND t <> '' AND NOT starts_with(t, '#') AND NOT starts_with(t, '```') AND NOT starts_with(t, '<!--') GROUP BY 1),
        f AS (SELECT source, doc_id, coalesce(added, 0) AS added, has::INT AS kept, coalesce(n, 0) AS n FROM edited LEFT JOIN a USING (doc_id) LEFT JOIN l USING (doc_id))
        SELECT source AS slug, coalesce(doc_id::VARCHAR, '') AS file, sum(added)::BIGINT AS added, sum(kept)::BIGINT AS preserved, sum(added + kept)::BIGINT AS block_ids, sum(n)::BIGINT AS substantive_lines FROM f
        GROUP BY GROUPING SETS ((source, doc_id), (source))""",
    "annotation_scan": """WITH d AS (SELECT doc_id AS d, source AS s, doc_id % 6 AS k, source || '-ch' || (doc_id % 90 + 10) || '-' AS own FROM documents)
        SELECT s AS slug, d AS file, 2::BIGINT AS line_no, CASE k WHEN 2 THEN 'x-' || own || (d + 10000) ELSE own || '7' END AS block_id, 'another slug or form' AS issue FROM d WHERE k IN (2, 3)
        UNION ALL SELECT s, d, 2, s || '-ch09-' || (d + 10000), 'another chapter' FROM d WHERE k = 1
        UNION ALL SELECT s, -1, -1, own || '0001', 'repeated' FROM d WHERE k = 4 GROUP BY ALL HAVING count(*) > 1
        UNION ALL SELECT s, d, -1, '', 'no block ids' FROM d WHERE k IN (2, 3, 5)""",
    "evidence_balance": """WITH h AS (SELECT l_orderkey AS u, l_partkey AS p, l_quantity > 25 AS e, ['executive_summary', 'author_words', 'definition', 'formulas', 'examples', 'examples', 'examples', 'limitations', 'limitations', 'empirical_context', 'empirical_context', 'relations', 'evidence_index'][(l_linenumber + l_partkey) % 13 + 1] AS c FROM lineitem),
        g AS (SELECT u, c, count(*) + count(*) FILTER (e) AS citations, count(DISTINCT p) AS uniq, count(*) FILTER (e) AS embeds, count(*) + count(*) FILTER (e) AS full_lines FROM h GROUP BY u, c),
        a AS (SELECT u, unnest(['executive_summary', 'author_words', 'definition', 'formulas', 'examples', 'limitations', 'empirical_context', 'relations', 'evidence_index']) AS c FROM (SELECT DISTINCT u FROM h)),
        b AS (SELECT a.u, a.c, coalesce(citations, 0) AS n, coalesce(uniq, 0) AS uniq, coalesce(embeds, 0) AS embeds, coalesce(full_lines, 0) AS full_lines FROM a LEFT JOIN g USING (u, c)),
        t AS (SELECT *, sum(n) OVER (PARTITION BY u) AS whole, sum(CASE WHEN c = 'evidence_index' THEN 0 ELSE n END) OVER (PARTITION BY u) AS body FROM b)
        SELECT u AS unit_id, c AS category, n AS citations, uniq AS "unique", embeds, full_lines AS lines, CASE WHEN whole = 0 THEN 0 ELSE round(n / whole, 4) END AS share_total, CASE WHEN c = 'evidence_index' OR body = 0 THEN 0 ELSE round(n / body, 4) END AS share_body, c NOT IN ('executive_summary', 'empirical_context') AS required FROM t""",
    "line_explode": f"WITH {_LINES} SELECT doc_id, n AS line_no, line FROM lines",
    "substantive_lines": rf"""WITH {_BLOCKS} SELECT doc_id, count(*) AS lines, sum(n)::BIGINT AS places FROM masked
        WHERE NOT off AND t <> '' AND NOT starts_with(t, '#') AND NOT starts_with(t, '```') AND NOT starts_with(t, '<!--') GROUP BY doc_id""",
    "block_annotate": f"WITH {_BLOCKS} SELECT block_id, n AS line_no, t AS text FROM blocks",
    "block_classify": f"WITH {_CLASSED} SELECT block_id, category FROM classed",
    "category_pivot": f"WITH {_CLASSED} SELECT source AS slug, {_PIVOT}, count(*) AS total FROM classed GROUP BY source",
    "block_id_multiset_check": f"WITH {_CLASSED} SELECT block_id, 1::BIGINT AS missing, 0::BIGINT AS extra FROM classed WHERE category = '{rules.TRANSITION}'",
    "duplicate_blocks": f"WITH {_BLOCKS} SELECT sha256(t) AS sha, count(*) AS n, min(block_id) AS first, max(block_id) AS last FROM blocks GROUP BY 1 HAVING count(*) > 1",
    "slop_scan": f"""SELECT kind, count(*) AS texts, count(*) FILTER (regexp_matches(lower(text), {_SLOP})) AS slop
        FROM (SELECT 'documents' AS kind, text FROM documents UNION ALL SELECT 'conversations', text FROM conversations) GROUP BY kind""",
    "section_diversity": f"WITH {_CLASSED} SELECT doc_id, string_agg(DISTINCT category, ',' ORDER BY category) AS categories, count(DISTINCT category) AS n_categories FROM classed GROUP BY doc_id",
    "evidence_share": f"WITH {_CLASSED} SELECT slug, category, blocks, round(blocks / sum(blocks) OVER (PARTITION BY slug), 4) AS share FROM (SELECT source AS slug, category, count(*) AS blocks FROM classed GROUP BY ALL)",
    "boundary_lead": rf"""WITH {_LINES}, starts AS (SELECT doc_id, n, line AS title FROM bare WHERE t <> '' AND {_COUNT} <= 10), sizes AS (SELECT doc_id, max(n) AS total FROM lines GROUP BY doc_id)
        SELECT doc_id, n - 1 AS line_start, coalesce(lead(n) OVER (PARTITION BY doc_id ORDER BY n) - 1, total) AS line_end, title, '' AS issue FROM starts JOIN sizes USING (doc_id)""",
    "size_split": rf"""WITH RECURSIVE {_LINES}, flags AS (SELECT doc_id, list(t = '' ORDER BY n) AS b, count(*) AS total FROM bare GROUP BY doc_id), cuts AS (
        SELECT doc_id, b, total, 1::BIGINT AS part, 0::BIGINT AS s,
          CASE WHEN total <= 20 THEN total ELSE coalesce(list_max([i FOR i IN range(8 - 3, 9) IF b[i]]), 8) END AS e FROM flags
        UNION ALL
        SELECT doc_id, b, total, part + 1, e,
          CASE WHEN total - e <= 8 THEN total ELSE coalesce(list_max([i FOR i IN range(greatest(e + 1, e + 8 - 3), e + 9) IF b[i]]), e + 8) END FROM cuts WHERE e < total)
        SELECT doc_id, part, s + 1 AS line_start, e AS line_end FROM cuts""",
    "chapter_names": r"""WITH first AS (SELECT doc_id, regexp_replace(string_split(text, chr(10))[1], '[^ -~]', '', 'g') AS line FROM documents), safe AS (
        SELECT doc_id, line, regexp_replace(regexp_replace(lower(trim(regexp_replace(line, '[^\w\s-]', '', 'g'))), '[-\s]+', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM first), named AS (
        SELECT doc_id, line, 'ch-' || printf('%02d', doc_id) || '-' || left(CASE WHEN s = '' THEN 'untitled' ELSE s END, 60) AS stem FROM safe)
        SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(line, '^#+\s*', ''), '<[^>]+>', '', 'g'), '\*\*(.*?)\*\*', '\1', 'g'), '\s+', ' ', 'g')) AS title, stem,
          'ch' || printf('%02d', doc_id) || CASE WHEN regexp_extract(stem, '(?i)(?:^|[-_])part[-_]?(\d+)(?:[-_]|$)', 1) = '' THEN '' ELSE '-part' || printf('%02d', regexp_extract(stem, '(?i)(?:^|[-_])part[-_]?(\d+)(?:[-_]|$)', 1)::BIGINT) END AS unit_id,
          regexp_matches(line, '^[a-z0-9]+(-[a-z0-9]+)*$') AND length(line) <= 80 AS is_slug FROM named""",
}
