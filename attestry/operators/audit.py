"""The audit: checks of a book's tables as failing rows, and the table of all checks.

Each function gives rows of check_id and subject: what fails a check.  ``report`` sets them against
the list of all checks.  A check whose tables are empty has a failing row of its own where nothing
to check is a failure.  Manual checks pass only when acknowledged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from . import links, pages as page_operators

# The checks by category, manual ones apart; the least that pages must have; stray folders.
CHECKS = {
    "Phase 1-2": ("CH-01", "CH-02", "CH-03", "CH-04"),
    "Phase 3": ("EX-06", "EX-08", "EX-09", "EX-10", "EX-11", "EX-12", "EX-13", "EX-14"),
    "Phase 4": ("SC-15", "SC-16", "SC-17", "SC-18", "SC-19"),
    "Phase 4-5": ("SC-20",),
    "Phase 5": ("SC-21", "SC-22"),
    "Page Quality": ("PQ-23", "PQ-24", "PQ-27", "PQ-28", "PQ-29", "PQ-30", "PQ-31", "PQ-32", "PQ-33", "PQ-34", "PQ-35", "PQ-36", "PQ-37", "PQ-38", "PQ-39"),
    "Post-Ingest": ("PO-42", "PO-44", "PO-45", "PO-46"),
    "Wiki Integrity": ("WI-47", "WI-48", "WI-49", "WI-50", "WI-51"),
}
MANUAL = ("CH-01", "EX-06", "EX-09", "EX-13", "EX-14", "PQ-27", "PQ-29", "PQ-30", "PQ-31", "PQ-32", "PQ-33", "PQ-34", "PQ-35")
STRAY = ("test", "chunk", "chapters-auto", "split-pdfs")
NOT_STRAY = "pdf_chunks"
MOST_CONFIDENCE = 0.95
MIN_LINES, MIN_EMBEDS, MIN_QUOTES, QUOTE = 80, 2, 2, 10
WORDS_SECTION, EXAMPLE_SECTION = r"(?mi)^##\s*Author's\s*Words", r"(?msi)^##\s*Specific\s*Example.*?(?=^##|\z)"
DISPATCH, SCHEMA, SCORING, CONFIRMATION = "specialist-dispatch-report.json", "schema-validation-report.json", "phase4-scoring-report.json", "phase4-confirmation.json"
GATE_4, GATE_5, BLOCK_IDS, BUILT, SHOWN, SCORED = "gates/phase-4.json", "gates/phase-5.json", "blockid-validation-report.json", "page-build-report.json", "presentation-report.json", "master-scored.json"
FILTERED = ("master-top-clean.json", "master-top56-clean.json")
AGENT_MODE = "runtime-neutral-prompt-contracts"
#: Checks that are decided elsewhere: of programs' texts, and of YAML by a parser, which Spark has none of.
ELSEWHERE = ("PO-42", "SC-22")


def _failing(rows: DataFrame, subject: Column, checks: dict[str, Column]) -> DataFrame:
    """check_id and subject of each check that a row breaks, in one pass."""
    broken = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(k)) for k, bad in checks.items())))
    return rows.select(subject.cast("string").alias("subject"), F.explode(broken).alias("check_id")).select("check_id", "subject")


def _nothing(rows: DataFrame, *checks: str) -> DataFrame:
    """A failing row for each of the checks if there are no rows."""
    return rows.agg(F.count("*").alias("n")).filter("n = 0").select(F.explode(F.array(*map(F.lit, checks))).alias("check_id"), F.lit("nothing found").alias("subject"))


def chapter_checks(chapters: DataFrame, slug: str) -> DataFrame:
    """CH-02 of chapters (file, text): each holds ids of the slug."""
    bad = {"CH-02": ~F.coalesce("text", F.lit("")).rlike(rf"\^\Q{slug}\E-ch\d+-\d+")}
    return _failing(chapters, F.col("file"), bad).union(_nothing(chapters, "CH-02"))


def listing_checks(listing: DataFrame, book: str, contract: str) -> DataFrame:
    """CH-03, CH-04 and PQ-38 of all paths: the manifest, no stray folders (but in archives), the page contract."""
    has = lambda path, k: listing.filter(F.col("path") == path).agg(F.count("*").alias("n")).filter("n = 0").select(F.lit(k).alias("check_id"), F.lit(path).alias("subject"))
    inner = F.expr(f"substring(path, {len(book) + 2})")
    folders = listing.filter(F.startswith("path", F.lit(f"{book}/"))).select(F.split(inner, "/").alias("parts"))
    above = F.explode(F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda k: F.slice("parts", 1, k)))
    within = folders.filter(F.size("parts") > 1).select(above.alias("parts")).distinct().filter(~F.array_contains("parts", "archive"))
    name = F.element_at("parts", -1)
    stray = F.lit(False)
    for prefix in STRAY:
        stray |= name.startswith(prefix)
    bad = within.filter(stray & (name != NOT_STRAY)).select(F.lit("CH-04").alias("check_id"), F.array_join("parts", "/").alias("subject"))
    return has(f"{book}/manifest.json", "CH-03").union(has(contract, "PQ-38")).union(bad)


def extraction_checks(extractions: DataFrame) -> DataFrame:
    """EX-11 and EX-12 of extractions (file, json): each cites blocks or says that it has none to cite, each concept has a confidence."""
    v = extractions.select("file", F.try_parse_json("json").alias("v")).filter("v is not null")
    get = lambda c, path, t: F.try_variant_get(c, path, t)
    none = F.array().cast("array<variant>")
    whole = F.coalesce(F.expr("try_cast(v as array<variant>)"), none)
    listed = lambda k: F.coalesce(get("v", f"$.{k}", "array<variant>"), F.map_values(F.expr(f"try_cast(try_variant_get(v, '$.{k}', 'variant') as map<string, variant>)")), none)
    items = F.concat(whole, *map(listed, ("concepts", "entities", "formulas")))
    cites = F.exists(items, lambda i: F.coalesce(get(i, "$.block_id", "string") != "", F.lit(False)) | F.coalesce(F.size(get(i, "$.block_ids", "array<variant>")) > 0, F.lit(False)))
    absent = F.coalesce(get("v", "$.no_lane_content", "boolean"), F.lit(False))
    unsure = F.exists(F.coalesce(get("v", "$.concepts", "array<variant>"), none), lambda c: get(c, "$.confidence", "variant").isNull())
    return _failing(v, F.col("file"), {"EX-11": ~cites & ~absent, "EX-12": unsure}).union(_nothing(extractions, "EX-11"))


def report_checks(reports: DataFrame, marks: DataFrame, writers: dict[str, str]) -> DataFrame:
    """EX-08, EX-10, SC-15 to SC-20 and PO-45 of reports (name, json) and marker files (name, text).

    ``writers`` names the programs that must have written the pages, the schema mark and the block mark (pages, schema, blocks).
    """
    v = reports.select("name", F.try_parse_json("json").alias("v"))
    one = lambda name, path, t="string": F.max(F.when(F.col("name") == name, F.try_variant_get("v", path, t)))
    there = lambda name: F.coalesce(F.max((F.col("name") == name) & F.col("v").isNotNull()), F.lit(False))
    asked = {
        "mode": one(DISPATCH, "$.agent_mode"),
        "schema_status": one(SCHEMA, "$.status"), "schema_valid": one(SCHEMA, "$.valid", "long"), "schema_total": one(SCHEMA, "$.total", "long"),
        "scoring_status": one(SCORING, "$.status"), "candidates": one(SCORING, "$.candidate_count", "long"),
        "confirmed": one(CONFIRMATION, "$.status"), "selected": one(CONFIRMATION, "$.selected_count", "long"), "gate4": one(GATE_4, "$.status"), "gate5": one(GATE_5, "$.status"),
        "blocks_valid": one(BLOCK_IDS, "$.valid", "boolean"), "blocks_cited": one(BLOCK_IDS, "$.referenced_block_ids", "long"), "blocks_missing": one(BLOCK_IDS, "$.missing_count", "long"),
        "filtered": F.max(F.when(F.col("name").isin(*FILTERED), F.try_variant_get("v", "$._latex_filtered", "variant").isNotNull())),
        "writer": one(BUILT, "$.generated_by"), "pages_status": one(BUILT, "$.status"), "written": one(BUILT, "$.pages_written", "long"),
        "shown_status": one(SHOWN, "$.status"), "shown": one(SHOWN, "$.checked", "long"),
        "scored": there(SCORED), "has_blocks": there(BLOCK_IDS),
    }
    said = marks.agg(*(F.coalesce(F.max((F.col("name") == n) & F.contains("text", F.lit(f"validated_by: {w}"))), F.lit(False)).alias(n) for n, w in (("_validation_passed", writers["schema"]), ("_blockid_valid", writers["blocks"]))))
    state = v.agg(*(c.alias(k) for k, c in asked.items())).join(F.broadcast(said))  # a row each
    c = F.col
    good = {
        "EX-08": c("mode") == AGENT_MODE,
        "EX-10": c("_validation_passed") & (c("schema_status") == "PASS") & (c("schema_valid") == c("schema_total")) & (c("schema_total") > 0),
        "SC-15": c("scored") & c("scoring_status").isin("AWAITING_USER_CONFIRMATION", "PASS") & (c("candidates") > 0),
        "SC-16": (c("confirmed") == "PASS") & (c("gate4") == "PASS") & (c("selected") > 0),
        "SC-17": c("_blockid_valid") & c("blocks_valid") & (c("blocks_cited") > 0),
        "SC-18": c("has_blocks") & (F.coalesce("blocks_missing", F.lit(0)) == 0),
        "SC-19": c("filtered"),
        "SC-20": (c("writer") == writers["pages"]) & (c("pages_status") == "PASS") & (c("gate5") == "PASS") & (c("written") > 0),
        "PO-45": (c("shown_status") == "PASS") & (c("shown") > 0),
    }
    return _failing(state, F.lit("report"), {k: ~F.coalesce(g, F.lit(False)) for k, g in good.items()})


def page_checks(pages: DataFrame, slug: str) -> DataFrame:
    """SC-21, PQ-23, PQ-24, PQ-28, PQ-36, PQ-37, PQ-39, PO-46 and WI-50 of concept pages (page, text), in one pass."""
    t = F.coalesce("text", F.lit(""))
    own = rf"\^\Q{slug}\E-ch\d+-\d+"
    front = F.when(t.startswith("---") & (F.size(F.split(t, "---", 3)) == 3), F.split(t, "---", 3)[1])
    keys = F.transform(F.filter(F.split(front, "\n"), lambda x: x.contains(":")), lambda x: text.strip(F.substring_index(x, ":", 1)))
    wanted = page_operators.KEYS
    example = F.regexp_extract(t, EXAMPLE_SECTION, 0)
    rows = text.lines(t)
    embeds = F.size(F.regexp_extract_all(t, F.lit(r"(!\[\[[^\]]+#\^[^\]]+\]\])"), 1))
    quotes = F.size(F.filter(F.transform(rows, text.strip), lambda x: x.startswith(">") & (F.length(x) > QUOTE)))
    sure = F.regexp_extract(t, r"(?m)^confidence:\s*([0-9.]+)", 1).try_cast("double")
    bare = F.exists(F.filter(F.split(F.coalesce(front, F.lit("")), "\n"), lambda x: text.strip(x).startswith("title:")), lambda x: ~x.rlike(r""":\s*["']"""))
    checks = {
        "SC-21": front.isNull() | (F.slice(keys, 1, len(wanted)) != F.array(*map(F.lit, wanted))),
        "PQ-23": embeds < MIN_EMBEDS,
        "PQ-24": ~t.rlike(WORDS_SECTION),
        "PQ-28": ~example.rlike(own),
        "PQ-36": F.size(rows) < MIN_LINES,
        "PQ-37": ~t.contains("extracted_from::") | (t.contains("derived_from::") & t.contains(slug)),
        "PQ-39": bare,
        "PO-46": (F.size(rows) < MIN_LINES) | (embeds < MIN_EMBEDS) | (quotes < MIN_QUOTES),
        "WI-50": F.coalesce(sure > MOST_CONFIDENCE, F.lit(False)),
    }
    return _failing(pages, F.col("page"), checks)


def vault_checks(pages: DataFrame, vault: DataFrame, index: DataFrame, archive: DataFrame) -> DataFrame:
    """WI-47, WI-48 and WI-49 of concept pages (page, text): dead links, pages of one normal form, pages that the index lacks.

    ``vault`` has file and text, ``index`` the text of the index (a row or none), ``archive`` the stems of pages that went.
    """
    dead = page_operators.dead_link_issues(pages, vault, "page").select(F.lit("WI-47").alias("check_id"), F.concat_ws(" ", "page", "issue").alias("subject"))
    stems = pages.select(F.regexp_replace(text.basename("page"), r"\.md$", "").alias("stem")).distinct()
    same = stems.withColumn("norm", text.normal_slug("stem")).groupBy("norm").agg(F.count("*").alias("n"), F.min("stem").alias("one")).filter("n > 1")
    twice = same.select(F.lit("WI-48").alias("check_id"), F.col("one").alias("subject"))
    listed = index.select(F.explode(F.regexp_extract_all("text", F.lit(r"\[\[([^\]|#]+)\]\]"), 1)).alias("stem")).distinct()
    lacks = stems.join(listed, "stem", "left_anti").select(F.lit("WI-49").alias("check_id"), F.col("stem").alias("subject"))
    return dead.union(_nothing(pages, "WI-47")).union(twice).union(lacks).union(_nothing(index, "WI-49"))


def stale_entries(pages: DataFrame, index: DataFrame, archive: DataFrame) -> DataFrame:
    """stem of index entries without a page, kept apart or not: a warning, no failure."""
    listed = index.select(F.explode(F.regexp_extract_all("text", F.lit(r"\[\[([^\]|#]+)\]\]"), 1)).alias("stem")).distinct()
    stems = pages.select(F.regexp_replace(text.basename("page"), r"\.md$", "").alias("stem"))
    return listed.join(stems, "stem", "left_anti").join(archive, "stem", "left_anti").filter(~F.col("stem").isin(*links.NO_PAGES))


def log_checks(log: DataFrame, slug: str) -> DataFrame:
    """PO-44, WI-51, CH-01 and EX-14 of the log's lines (line): entries of the slug, one in the form of the contract; what it says of splitting and of fallbacks."""
    low = F.lower("line")
    n = log.agg(
        F.count_if(F.contains("line", F.lit(slug))).alias("named"),
        F.count_if(F.startswith("line", F.lit("## [")) & F.contains("line", F.lit(slug))).alias("entries"),
        F.count_if(F.contains(low, F.lit("chapter detection")) | F.contains(low, F.lit("split"))).alias("split"),
        F.count_if(F.contains(low, F.lit("regex fallback")) | F.contains(low, F.lit("keyword fallback"))).alias("fallback"),
    )
    return _failing(n, F.lit("log"), {"PO-44": F.col("named") == 0, "WI-51": F.col("entries") == 0, "CH-01": (F.col("named") == 0) | (F.col("split") == 0), "EX-14": F.col("fallback") > 0})


def report(failures: DataFrame, acknowledged: tuple[str, ...] = (), elsewhere: dict[str, bool] | None = None, shown: int = 5) -> DataFrame:
    """check_id, category, manual, acknowledged, passed, failures and examples (the first subjects) of all checks.

    ``elsewhere`` gives what was found for the checks in ``ELSEWHERE``; without it they fail.
    """
    spark = failures.sparkSession
    rows = [(k, c, k in MANUAL, k in acknowledged, (elsewhere or {}).get(k, k not in ELSEWHERE)) for c, ks in CHECKS.items() for k in ks]
    every = spark.createDataFrame(rows, "check_id string, category string, manual boolean, acknowledged boolean, fine boolean")
    first = Window.partitionBy("check_id").orderBy("subject")
    some = failures.distinct().withColumn("k", F.row_number().over(first)).filter(F.col("k") <= shown).groupBy("check_id").agg(F.array_sort(F.collect_list("subject")).alias("examples"))
    counted = failures.distinct().groupBy("check_id").agg(F.count("*").alias("failures")).join(some, "check_id")
    df = every.join(F.broadcast(counted), "check_id", "left")  # a row for each check
    passed = F.col("fine") & F.col("failures").isNull()
    return df.select("check_id", "category", "manual", "acknowledged", passed.alias("passed"), F.coalesce("failures", F.lit(0)).alias("failures"), F.coalesce("examples", F.array().cast("array<string>")).alias("examples"))
