"""The five written reports: candidates, rationale, balance, lexical overlap and image coverage, as lines of Markdown.

A report is a table of part, at and line: part orders its sections, at the rows of one.  So a report may be longer than a task
holds; ``markdown`` joins one that isn't.  Headings, fields and columns are the fixed layout; instructions for the person who reads
it are left to whoever writes the file.

Null values are empty cells, empty lists read ``none``; a report of empty tables has its headings and empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Headings, fields and columns of the reports.
OVERLAP_TABLE = ("| Status | Page | Cited blocks | Synthesis overlap | Full-page overlap |", "|---|---|---:|---:|---:|")
IMAGE_TABLE = ("| Image | Chapter refs | Concept pages | Team pages |", "|---|---:|---|---|")
BALANCE_TABLE = ("| Category | Citations | Unique blocks | Embeds | Body share | Total share |", "|---|---:|---:|---:|---:|---:|")
CANDIDATE_TABLE = ("| Rank | Slug | Score | Chapters | Confidence | Blocks |", "|---:|---|---:|---:|---:|---:|")
RATIONALE_TABLE = ("| Rank | Status | Slug | Score | Supporting lanes | Strongest block IDs | Source sections | Duplicate / alias risks | Reason |", "|---:|---|---|---:|---|---|---|---|---|")
WAITING = "status: awaiting_user_confirmation"
SHOWN_TEAMS = 4


def cell(c: Column) -> Column:
    """A value inside a table: bars escaped, line ends as spaces."""
    return F.replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def listed(c: str, quote: str = "") -> Column:
    """The members of a list, or none."""
    members = F.transform(c, lambda x: F.concat(F.lit(quote), x.cast("string"), F.lit(quote)))
    return F.when(F.coalesce(F.size(c), F.lit(0)) > 0, F.array_join(members, ", ")).otherwise("none")


def _row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def _code(c: Column) -> Column:
    return F.concat(F.lit("`"), c, F.lit("`"))


def _fixed(spark: SparkSession, part: int, *lines: str) -> DataFrame:
    return spark.createDataFrame([(part, f"{k:09d}", x) for k, x in enumerate(lines)], "part int, at string, line string")


def _rows(df: DataFrame, part: int, at: Column, line: Column) -> DataFrame:
    return df.select(F.lit(part).alias("part"), at.cast("string").alias("at"), line.alias("line"))


def _or_none(df: DataFrame, part: int, at: Column, line: Column) -> DataFrame:
    """The rows, or one line that says there are none."""
    none = df.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit(part).alias("part"), F.lit("").alias("at"), F.lit("- none").alias("line"))
    return _rows(df, part, at, line).unionByName(none)


def _fields(df: DataFrame, part: int, *fields: tuple[str, Column]) -> DataFrame:
    """A line for each aggregate over ``df``."""
    one = df.agg(*(c.alias(f"f{k}") for k, (_, c) in enumerate(fields)))
    each = F.array(*(F.struct(F.lit(f"{k:09d}").alias("at"), F.format_string(name, F.col(f"f{k}").cast("string")).alias("line")) for k, (name, _) in enumerate(fields)))
    return one.select(F.explode(each).alias("x")).select(F.lit(part).alias("part"), "x.at", "x.line")


def _place(c: Column | str) -> Column:
    return F.format_string("%09d", (F.col(c) if isinstance(c, str) else c).cast("long"))


def markdown(lines: DataFrame) -> DataFrame:
    """One row with the report's text; for reports that one task may hold."""
    rows = lines.agg(F.array_sort(F.collect_list(F.struct("part", "at", "line"))).alias("x"))
    return rows.select(F.concat(F.array_join(F.transform("x", lambda r: r["line"]), "\n"), F.lit("\n")).alias("markdown"))


def overlap(rows: DataFrame, slug: str, threshold: float = 0.12) -> DataFrame:
    """Lexical overlap of pages; ``rows`` has page, status, cited, synthesis_overlap and full_overlap."""
    spark = rows.sparkSession
    share = lambda c: F.format_string("%.4f", F.col(c))
    counts = _fields(rows, 2, ("Pages checked: %s", F.count("*")), ("Flagged pages: %s", F.count_if(F.col("status") != "PASS")))
    line = _row(cell(F.col("status")), _code(cell(F.col("page"))), F.col("cited").cast("string"), share("synthesis_overlap"), share("full_overlap"))
    head = _fixed(spark, 1, f"# Lexical Overlap Report — `{slug}`", "", f"Threshold: synthesis overlap ≥ `{threshold}`")
    return head.unionByName(counts).unionByName(_fixed(spark, 3, "", *OVERLAP_TABLE)).unionByName(_rows(rows, 4, F.col("page"), line))


def image_coverage(rows: DataFrame, refs: DataFrame, slug: str) -> DataFrame:
    """Images and the pages that show them; ``rows`` has image, refs, concept_pages and team_pages (lists), ``refs`` one row of chapter_files, local_refs, resolved, missing and status."""
    spark = rows.sparkSession
    said = _fields(refs, 2, *((f"- {name}: `%s`", F.coalesce(F.max(F.col(c).cast("string")), F.lit("unknown"))) for name, c in (("Chapter files", "chapter_files"), ("Local refs", "local_refs"), ("Resolved", "resolved"), ("Missing", "missing"), ("Status", "status"))))
    some = lambda c: F.count_if(F.size(c) > 0)
    counts = _fields(rows, 4, ("Images in chapter markdown: `%s`", F.count("*")), ("Images referenced by concept pages: `%s`", some("concept_pages")), ("Images referenced by team extraction pages: `%s`", some("team_pages")))
    more = F.size("team_pages") - SHOWN_TEAMS
    teams = F.concat(F.array_join(F.transform(F.slice("team_pages", 1, SHOWN_TEAMS), _code), ", "), F.when(more > 0, F.concat(F.lit(", … +"), more)).otherwise(""))
    shown = lambda c, text_: F.when(F.size(c) > 0, text_).otherwise("—")
    line = _row(_code(F.col("image")), F.col("refs").cast("string"), shown("concept_pages", F.array_join(F.transform("concept_pages", _code), ", ")), shown("team_pages", teams))
    head = _fixed(spark, 1, f"# Image-to-Page Coverage — `{slug}`", "", "## Source image-ref verification", "").unionByName(said).unionByName(_fixed(spark, 3, "", "## Coverage table", ""))
    return head.unionByName(counts).unionByName(_fixed(spark, 5, "", *IMAGE_TABLE)).unionByName(_rows(rows, 6, F.col("image"), line))


def balance(metrics: DataFrame, findings: DataFrame, slug: str) -> DataFrame:
    """The balance of presentations by unit; ``metrics`` is as of ``blocks.balance_metrics``, ``findings`` has unit_id, severity, code, category and message."""
    spark = metrics.sparkSession
    share = lambda c: F.format_string("%.0f%%", F.bround(100 * c))
    bad = findings.select("unit_id").distinct().withColumn("bad", F.lit(True))
    body = F.col("category") != "evidence_index"
    units = metrics.groupBy("unit_id").agg(
        F.sum(F.when(body, F.col("citations")).otherwise(0)).alias("inner"), F.sum("citations").alias("whole"), F.min(F.when(body, F.struct((-F.col("citations")).alias("n"), "category", "share_body"))).alias("top")
    ).join(bad, "unit_id", "left")
    state = F.when(F.col("bad"), "WARNING").otherwise("PASS")
    head = _fixed(spark, 1, f"# Presentation Evidence-Balance Audit — {slug}", "").unionByName(_fields(units, 2, ("status: %s", F.when(F.count("bad") > 0, "WARNING").otherwise("PASS")), ("unit_count: %s", F.count("*")), ("warning_count: %s", F.count("bad"))))
    at = lambda k, more=F.lit(""): F.concat("unit_id", F.lit(f"\u0001{k}"), more)
    lines = F.array(
        F.lit(""), F.concat(F.lit("## Unit "), _code(F.col("unit_id"))), F.lit(""), F.concat(F.lit("- status: "), state), F.concat(F.lit("- body_citation_count: "), F.col("inner").cast("string")), F.concat(F.lit("- total_citation_count: "), F.col("whole").cast("string")),
        F.concat(F.lit("- dominant_body_category: "), F.col("top.category"), F.lit(" ("), share(F.col("top.share_body")), F.lit(")")), F.lit(""), *map(F.lit, BALANCE_TABLE),
    )
    opened = units.select("unit_id", F.posexplode(lines).alias("k", "line"))
    row = _row(F.col("category"), F.col("citations").cast("string"), F.col("unique").cast("string"), F.col("embeds").cast("string"), share(F.col("share_body")), share(F.col("share_total")))
    closed = units.select("unit_id", F.posexplode(F.array(F.lit(""), F.lit("### Findings"), F.lit(""))).alias("k", "line"))
    said = F.concat(F.lit("- **"), F.concat_ws(" / ", "severity", "code", "category"), F.lit("** — "), F.coalesce("message", F.lit("")))
    fine = units.filter("bad is null").select(F.lit(3).alias("part"), at(4).alias("at"), F.lit("- none").alias("line"))
    out = head.unionByName(_rows(opened, 3, at(1, _place("k")), F.col("line"))).unionByName(_rows(metrics, 3, at(2, F.col("category")), row)).unionByName(_rows(closed, 3, at(3, _place("k")), F.col("line")))
    return out.unionByName(_rows(findings, 3, at(4, F.concat_ws(" ", "code", "category")), said)).unionByName(fine)


def candidates(clean: DataFrame, scored: DataFrame, removed: DataFrame, flags: DataFrame, slug: str, least: int = 9) -> DataFrame:
    """Concepts to choose from; ``clean`` has rank, slug, score, chapters, confidence and blocks (numbers), ``scored`` slug, score and blocks, ``removed`` slug, ``flags`` slugs, existing (lists) and reason."""
    spark = clean.sparkSession
    head = _fixed(spark, 1, f"# Phase 4 Concept Selection Candidates — {slug}", "", WAITING, f"min_score: {least}")
    head = head.unionByName(_fields(clean, 2, ("candidate_count: %s", F.count("*")))).unionByName(_fields(scored, 3, ("total_scored_concepts: %s", F.count("*"))))
    some = flags.agg(F.count("*").alias("n")).filter("n > 0").select(F.lit(4).alias("part"), F.posexplode(F.array(*map(F.lit, ("", "## Possible duplicates — resolve before confirming", "")))).alias("k", "line")).select("part", _place("k").alias("at"), "line")
    inside = F.coalesce(F.size("existing"), F.lit(0)) == 0
    pair = F.concat(F.lit("- in-batch: "), F.array_join(F.transform("slugs", _code), " vs "), F.lit(" — "), "reason")
    known = F.concat(F.lit("- vs-existing: "), _code(F.get("slugs", F.lit(0))), F.lit(" vs existing page(s) "), listed("existing", "`"), F.lit(" — "), "reason")
    flagged = _rows(flags, 5, F.concat(F.when(inside, "0").otherwise("1"), F.array_join("slugs", " ")), F.when(inside, pair).otherwise(known))
    number = lambda c: F.col(c).cast("string")
    row = _row(number("rank"), _code(F.col("slug")), number("score"), number("chapters"), F.format_string("%.2f", F.col("confidence")), number("blocks"))
    table = _fixed(spark, 6, "", "## Clean candidates", "", *CANDIDATE_TABLE).unionByName(_rows(clean, 7, _place("rank"), row))
    gone = _fixed(spark, 8, "", "## LaTeX/artifact slugs removed", "").unionByName(_or_none(removed, 9, F.col("slug"), F.concat(F.lit("- "), _code(F.col("slug")))))
    every = F.concat(F.lit("- "), _code(F.col("slug")), F.lit(" — score "), number("score"), F.lit(" — blocks "), number("blocks"))
    last = _fixed(spark, 10, "", "## All scored concepts", "").unionByName(_rows(scored, 11, F.concat(_place(F.lit(10**6) - F.col("score")), "slug"), every))
    return head.unionByName(some).unionByName(flagged).unionByName(table).unionByName(gone).unionByName(last)


def rationale(rows: DataFrame, claims: DataFrame, slug: str) -> DataFrame:
    """Why each scored concept may be chosen; ``rows`` has rank, status, slug, score, lanes, blocks, sections and risks (lists) and reason, ``claims`` ord, lane, block_id, text, confidence, effective_confidence and reason."""
    spark = rows.sparkSession
    head = _fixed(spark, 1, f"# Phase 4 Candidate Rationale Packet — {slug}", "", WAITING)
    head = head.unionByName(_fields(rows, 2, ("clean_candidate_count: %s", F.count_if(F.col("status") == "candidate")), ("total_scored_concepts: %s", F.count("*")))).unionByName(_fixed(spark, 3, "", *RATIONALE_TABLE))
    line = _row(cell(F.col("rank")), cell(F.col("status")), _code(cell(F.col("slug"))), cell(F.col("score")), *(cell(listed(c)) for c in ("lanes", "blocks", "sections", "risks")), cell(F.col("reason")))
    why = F.when(F.coalesce("reason", F.lit("")) != "", F.concat(F.lit(" — "), "reason")).otherwise("")
    said = F.concat(F.lit("- "), _code(F.col("lane")), F.lit(" claim at `^"), "block_id", F.lit("`: "), "text", F.lit(" ("), "confidence", F.lit(" → "), "effective_confidence", F.lit(")"), why)
    return head.unionByName(_rows(rows, 4, _place("rank"), line)).unionByName(_fixed(spark, 5, "", "## Needs human eyes", "")).unionByName(_or_none(claims, 6, _place("ord"), said))
