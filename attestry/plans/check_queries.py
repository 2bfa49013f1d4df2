"""Queries on the checks of chapters, units, images, lanes, indexes, presentations and reports, made of the tables' rows, with their SQL.

Files, marks and sections stand among the documents' own lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import audit, blocks, chapters, control, dispatch, grounding, images, links, pages, validate
from ..sources import files as sources
from . import graph_queries, text_queries


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(k: Column, *choices: Column | str) -> Column:
    """The choice of the number ``k``, from 0 on, around and around."""
    return F.element_at(F.array(*(F.lit(c) if isinstance(c, str) else c for c in choices)), (k % len(choices) + 1).cast("int"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, n (from 1) and line, of printable ASCII, of each document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", F.posexplode(text.lines("text")).alias("p", "line"))
    return docs.select("doc_id", "source", (F.col("p") + 1).cast("long").alias("n"), F.regexp_replace("line", "[^ -~]", "").alias("line"))


def _joined(rows: DataFrame, line: Column, *keys: str) -> DataFrame:
    """keys and text: each key's lines put together in their order."""
    whole = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("n", line.alias("x")))).alias("xs"))
    return whole.select(*keys, F.array_join(F.transform("xs", lambda r: r["x"]), "\n").alias("text"))


def chapter_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twelfth line heads a chapter: as the title below a mark, or in the line itself; numbers repeat and the first one counts."""
    rows = _lines(spark, sf_dir)
    head = (F.col("n") % 12) == 1
    plain = F.concat(F.lit("Chapter "), F.expr("(n - 1) div 24 + 1"), F.lit(": "), "line")
    line = F.when(head & (F.col("doc_id") % 2 == 0), F.lit("<div class=:doc_title>")).when(head, plain).otherwise(F.col("line"))
    found = chapters.detect_boundaries(rows.select(F.col("doc_id").alias("slug"), F.col("n").alias("line_no"), line.alias("line")))
    return found.select(F.col("slug").alias("doc_id"), "method", F.col("chapter").cast("long"), "title", F.col("line_start").cast("long"))


def boundary_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lines as starts of chapters, some before or beyond the text or without a title; and numbers of units that don't agree."""
    rows = _lines(spark, sf_dir)
    sizes = rows.groupBy(F.col("doc_id").alias("slug")).agg(F.max("n").alias("line_count"))
    start = _pick(F.col("n"), F.col("n"), F.col("n") - 9, F.col("n") + 30, F.lit(None).cast("long"))
    end = F.when(F.col("n") % 3 == 0, F.col("n") - 1).when(F.col("n") % 5 == 0, F.col("n") + 40)
    made = rows.filter((F.length("line") > 0) & (F.length("line") <= 40)).select(F.col("doc_id").alias("slug"), F.when(F.col("n") % 7 == 0, "  ").otherwise(F.col("line")).alias("title"), start.alias("line_start"), end.alias("line_end"))
    found = chapters.boundary_issues(made, sizes, sizes.select("slug", F.lit(2).alias("units")))
    return found.select(F.col("slug").alias("doc_id"), F.coalesce("title", F.lit("-")).alias("title"), "issue")


def unit_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of six forms of names; which chapters and parts they are, and which names say the same."""
    d = F.col("doc_id")
    name = _pick(d, F.concat(F.lit("ch-"), d % 9, F.lit("-start.md")), F.concat(F.lit("Chapter_"), d % 9, F.lit(".md")), F.concat(F.lit("part-"), d % 9, F.lit(".md")), F.concat(F.lit("ch0"), d % 9, F.lit("-part-"), d % 4, F.lit(".md")), "notes.md", F.concat(F.lit("ch-"), d % 9, F.lit(".orig.md")))
    units = chapters.discover_units(_table(spark, sf_dir, "documents").select(F.col("source").alias("slug"), F.concat(F.lit("raw/"), d, F.lit("/"), name).alias("file")))
    return units.select("slug", "file", F.col("chapter_num").cast("long"), F.col("part_num").cast("long"), "unit_id", "ambiguous")


def oversized_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of over 30 lines; every third one is a part already."""
    sizes = _lines(spark, sf_dir).groupBy("doc_id").agg(F.max("n").alias("line_count"))
    units = sizes.select(F.concat(F.lit("ch"), "doc_id", F.when(F.col("doc_id") % 3 == 0, "-part01").otherwise("")).alias("unit_id"), "line_count")
    return chapters.oversized(units, 30)


def balance_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.balance_findings(text_queries.evidence_balance(spark, sf_dir))


def extracted_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth line ends in an anchor, every seventh is nothing but one; the texts that they name."""
    rows = _lines(spark, sf_dir)
    anchor = F.concat(F.lit("^"), "source", F.lit("-ch01-"), F.col("n") + 1000)
    line = F.when(F.col("n") % 7 == 0, anchor).when(F.col("n") % 5 == 0, F.concat("line", F.lit(" "), anchor)).otherwise(F.regexp_replace("line", r"\^", ""))
    files = _joined(rows, line, "doc_id").withColumnRenamed("doc_id", "file")
    found = blocks.extract_blocks(files, "", rf"\^[a-z0-9-]+-ch\d{{2}}-\d{{4,}}(?![{rules.WORD}])")
    return found.select("file", F.col("line_no").cast("long").alias("line_no"), "block_id", "text")


def image_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth line shows an image; beside the chapter lie those of even documents, among the recognition's those of every third line."""
    rows = _lines(spark, sf_dir).filter("n % 9 = 0")
    name = F.concat(F.lit("p"), F.col("n") % 30, F.lit(".png"))
    files = rows.select(F.concat(F.lit("raw/"), "doc_id", F.lit("/ch.md")).alias("file"), F.concat(F.lit("!["), F.regexp_replace("line", r"[\[\]()!]", ""), F.lit("](imgs/"), name, F.lit("#x)")).alias("text"))
    near = rows.filter("doc_id % 2 = 0").select(F.concat(F.lit("raw/"), "doc_id", F.lit("/imgs/"), name).alias("path"), F.lit("chapter").alias("kind"))
    far = rows.filter("n % 3 = 0 and n % 30 < 20").select(F.concat(F.lit("ocr/"), "source", F.lit("/"), name).alias("path"), F.lit("ocr").alias("kind"))
    found = images.sources(images.image_refs(files), near.union(far).distinct())
    return found.groupBy("file", "ref", "source").agg(F.count("*").alias("n"))


def image_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ninth line shows an image; remote ones, and those that lie nowhere, fail the gate."""
    rows = _lines(spark, sf_dir).filter("n % 9 = 0")
    ref = _pick(F.expr("n div 9"), F.lit("imgs/a.png"), F.lit("https://x.org/a.png"), F.lit("imgs/none.png"))
    files = rows.select(F.concat(F.lit("raw/"), "doc_id", F.lit("/ch.md")).alias("file"), F.concat(F.lit("![x]("), ref, F.lit(")")).alias("text"))
    there = rows.select(F.concat(F.lit("raw/"), "doc_id", F.lit("/imgs/a.png")).alias("path"), (F.col("doc_id") % 4).alias("length")).distinct()
    return images.gate(images.verify(images.image_refs(files), there), 5).select("refs", "missing", "remote", "status")


def image_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as pages of concepts and teams that name an image, in a reference or in words; how many images they cover."""
    rows = _lines(spark, sf_dir)
    name = F.concat(F.lit("fig"), F.col("doc_id") % 40 + F.col("n") % 50, F.lit(".png"))
    shown = F.when(F.col("n") % 2 == 0, F.concat(F.lit("![x](imgs/"), name, F.lit(")"))).otherwise(F.concat(F.lit("see "), name, F.lit(" here")))
    said = rows.filter("n % 11 = 0").select(F.concat("doc_id", F.lit("/"), "n").alias("page"), F.when(F.col("doc_id") % 3 == 0, "team").otherwise("concept").alias("kind"), F.concat(F.regexp_replace("line", r"\.", " "), F.lit(" "), shown).alias("text"))
    every = spark.range(120).select(F.concat(F.lit("imgs/fig"), "id", F.lit(".png")).alias("image"))
    known = every.join(_table(spark, sf_dir, "documents").agg(F.count("*").alias("c")).filter("c > 0"))
    return images.coverage(known.select("image"), said).select("image", "concept_pages", "team_pages", "concept_covered", "team_covered")


def vision_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth line has marks, twice the same; logs describe those of even documents, some without a confidence."""
    rows = _lines(spark, sf_dir).filter("n % 10 = 0")
    line = F.concat(F.regexp_replace("line", "[A-Z_]", ""), F.lit(" VISION_CHART and VISION_CHART, MISSING_IMAGE ^"), "source", F.lit("-ch01-"), F.col("n") + 1000)
    marks = images.markers(rows.select(F.concat(F.lit("ch"), "doc_id").alias("unit_id"), F.col("n").alias("line_no"), line.alias("line")))
    fields = [F.lit(f"- {f}: x\n") for f in images.FIELDS if f != "confidence"]
    log = rows.filter("doc_id % 2 = 0").select(F.concat(F.lit("ch"), "doc_id").alias("unit_id"), F.concat(F.lit("### "), F.lit("ch"), "doc_id", F.lit("-L"), text.two_digits("n", 4), F.lit("-VISION_CHART-2\n"), *fields, F.lit("- confidence: "), F.when(F.col("n") % 20 == 0, "").otherwise("high"), F.lit("\n")).alias("text"))
    resolved = images.vision_gate(marks, images.marker_sections(log))
    return marks.join(resolved, "id").select("id", "unit_id", "marker", "block_id", "resolved")


def index_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written indexes of the documents' lines, read back and held against the chapter: lines left out, twice, and of unknown categories."""
    rows = _lines(spark, sf_dir).filter("trim(line) <> ''")
    id_ = F.concat(F.lit("d-ch01-"), F.col("n") + 1000)
    chapter = rows.filter("doc_id % 10 <> 9").select(F.col("doc_id").cast("string").alias("unit_id"), id_.alias("block_id"))
    quoted = F.concat(F.lit("- ["), id_, F.lit('] — "'), F.regexp_replace("line", '"', "'"), F.lit('"'))
    written = _joined(rows.filter("n % 8 <> 0").unionByName(rows.filter("n % 8 = 1")), quoted, "doc_id")
    read = blocks.indexed_blocks(written.select(F.col("doc_id").cast("string").alias("unit_id"), "text"))
    number = F.substring_index("block_id", "-", -1).cast("int")
    index = read.select("unit_id", "block_id", F.when(number % 13 == 0, "Nonsense").otherwise(rules.CATEGORIES[0]).alias("category"))
    found = blocks.index_issues(index, chapter)
    return found.groupBy("unit_id", F.coalesce("block_id", F.lit("-")).alias("block_id"), "issue").agg(F.count("*").alias("n"))


def _lane_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """unit_id, lane and text: documents' lines under headings of their lane, some headings left out, and every third line cites a block."""
    rows = _lines(spark, sf_dir).filter("n <= 12")
    head = F.when(F.col("n") == 1, F.when(F.col("doc_id") % 5 != 0, "## Definitions\n").otherwise("")).when(F.col("n") == 3, "## Examples\n").when((F.col("n") == 5) & (F.col("doc_id") % 4 == 0), "## Notes\n").otherwise("")
    cite = F.when((F.col("n") % 3 == 0) & (F.col("doc_id") % 7 != 0), F.concat(F.lit(" ^d-ch01-"), F.col("n") + 1000)).otherwise("")
    body = F.concat(head, F.regexp_replace(F.regexp_replace("line", r"^#+", ""), r"[\^\[\]]", ""), cite)
    made = _joined(rows, body, "doc_id")
    return made.select(F.concat(F.lit("ch"), "doc_id").alias("unit_id"), _pick(F.col("doc_id"), "math", "prose").alias("lane"), F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.col("text")).alias("text"))


def lane_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes = spark.createDataFrame([("math", ["Definitions", "Examples"]), ("prose", ["Definitions", "Warnings"])], "lane string, required_sections array<string>")
    return validate.markdown_issues(_lane_texts(spark, sf_dir), lanes)


def presentation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same texts as presentations."""
    found = pages.presentation_issues(_lane_texts(spark, sf_dir), ["Definitions", "Examples"])
    return found.groupBy("unit_id", "issue").agg(F.count("*").alias("n"))


def dispatch_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as reports on planned pairs of orders and the first four line numbers: missing, extra, and with empty fields."""
    lines = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    unit = F.concat(F.lit("u"), "l_orderkey")
    reports = lines.select(unit.alias("unit_id"), F.col("l_linenumber").cast("string").alias("lane"), F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey").cast("string")).alias("job_id"), F.when(F.col("l_partkey") % 11 == 0, " ").otherwise("t").alias("runtime_task_id"), F.lit("r").alias("runtime"))
    tasks = _table(spark, sf_dir, "orders").select(F.concat(F.lit("u"), "o_orderkey").alias("unit_id"), F.explode(F.array(*map(F.lit, "1234"))).alias("lane"))
    found = validate.report_issues(reports, tasks)
    return found.groupBy("lane", "issue").agg(F.count("*").alias("n"))


def record_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as planned tasks, their lines as records: later lines over earlier ones; some ids are the planned ones or made up."""
    lines = _table(spark, sf_dir, "lineitem")
    id_ = F.col("l_orderkey").cast("string")
    job = F.when(F.col("l_linenumber") == 2, F.when(F.col("l_partkey") % 5 == 0, id_).when(F.col("l_partkey") % 7 == 0, "mock-1").otherwise(F.concat(F.lit("j"), "l_partkey")))
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    records = dispatch.normal_records(lines.select(id_.alias("id"), order.alias("ord"), job.alias("run_id"), F.when(F.col("l_linenumber") == 3, F.concat(F.lit("t"), "l_suppkey")).alias("task_id"), F.when(F.col("l_quantity") > 10, "tool").alias("launcher")))
    tasks = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("task_id"))
    return dispatch.record_issues(tasks, records)


def lane_discipline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority as planned tasks; records for finished ones, outputs where a line was returned."""
    orders, lines = _table(spark, sf_dir, "orders"), _table(spark, sf_dir, "lineitem")
    tasks = orders.select(F.concat(F.lit("u"), "o_orderkey").alias("unit_id"), F.col("o_orderpriority").alias("lane"), F.col("o_orderkey").cast("string").alias("task_id"))
    records = orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("id"))
    outputs = lines.filter("l_returnflag = 'R'").join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(F.concat(F.lit("u"), "o_orderkey").alias("unit_id"), F.col("o_orderpriority").alias("lane"))
    return dispatch.discipline(tasks, records, outputs)


def index_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web addresses that pages name, as an index, against the addresses that pages have."""
    named = links.hrefs(_table(spark, sf_dir, "pages")).select(F.lower(F.regexp_replace("href", "^/", "")).alias("stem")).filter("stem <> ''").distinct()
    have = _table(spark, sf_dir, "pages").select(F.lower(F.regexp_extract("url", r"([^/?#]*)(?:[?#].*)?$", 1)).alias("stem")).filter("stem <> ''").distinct()
    return links.index_gaps(named, have)


def repair_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = graph_queries.vault(spark, sf_dir)
    return links.repair_totals(files, links.repair(files, links.owners(files)))


def citation_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cite blocks of their own or another source; an index holds every second line."""
    rows = _lines(spark, sf_dir)
    id_ = F.concat(F.when(F.col("n") % 6 == 0, "src0").otherwise("src1"), F.lit("-ch01-"), F.col("n") + 1000)
    cited = rows.select(F.col("doc_id").alias("unit_id"), id_.alias("block_id"))
    index = rows.filter("n % 2 = 0").select(F.col("doc_id").alias("unit_id"), id_.alias("block_id"))
    return grounding.citation_issues(cited, index, "src1").groupBy("unit_id", "issue").agg(F.count("*").alias("n"))


def human_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines as claims of documents, some ambiguous by themselves, some by what was found of them in the text with every fifth line gone."""
    rows = _lines(spark, sf_dir).filter("trim(line) <> ''")
    claims = rows.filter("n <= 6").select(F.col("doc_id").alias("file"), F.col("n").alias("claim_index"), _pick(F.col("n"), "EXTRACTED", "INFERRED", "AMBIGUOUS").alias("confidence"), F.col("line").alias("quote_verbatim"), F.concat("doc_id", F.lit("-"), "n").alias("block_id"))
    held = rows.filter("n % 5 <> 3").select(F.concat("doc_id", F.lit("-"), "n").alias("block_id"), F.concat(F.lit("* "), "line", F.lit(" and more")).alias("text"))
    grounded = grounding.ground_claims(claims, held)
    found = grounding.claims_for_human_eyes(claims, grounded.filter("claim_index <> 4"))
    return found.select("file", "claim_index", "confidence", "effective_confidence", "reason")


def merge_preconditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as extractions that may be merged, with marks by number and totals of their labels."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    sums = docs.join(labels, "doc_id", "left").groupBy("source").agg(F.count("quality").alias("total"), F.sum(F.coalesce("quality", F.lit(0))).cast("long").alias("valid"))
    k = F.substring("source", 4, 9).cast("int")
    valid = F.when(k % 2 == 0, F.col("total")).otherwise(F.col("valid"))
    reports = sums.select(F.col("source").alias("slug"), F.when(k % 7 != 0, F.concat(F.lit("at: x\nvalidated_by: "), F.when(k % 5 == 0, "hand").otherwise("tool"))).alias("marker"), F.lit("PASS").alias("status"), valid.alias("valid"), "total")
    return validate.precondition_issues(reports, "tool")


def front_matters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages with a front matter of real lines, read by both parsers, and what follows it."""
    rows = _lines(spark, sf_dir).filter("n <= 3")
    said = F.regexp_replace("line", r"""["':#\\-]""", "")
    made = _joined(rows, F.concat(F.lit("key"), "n", F.lit(': "'), F.trim(said), F.lit('"')), "doc_id").select("doc_id", F.concat(F.lit("---\n"), "text", F.lit("\nscope: all\n---\nbody of "), "doc_id", F.lit(" --- and more")).alias("text"))
    one = sources.front_matter(made, ["doc_id"]).select("doc_id", F.col("fields").alias("f"))
    two = sources.agent_front_matter(made, ["doc_id"]).select("doc_id", F.col("fields").alias("g"))
    both = one.join(two, "doc_id").join(made, "doc_id")
    return both.select("doc_id", F.size("f").cast("long").alias("entries"), F.try_element_at("f", F.lit("key1")).alias("first"), F.try_element_at("g", F.lit("key2")).alias("second"), F.try_element_at("g", F.lit("scope")).alias("scope"), text.without_frontmatter("text").alias("rest"))


def hidden_indexes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON hidden in a comment behind the document's text, and JSON behind noise: read back whole."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    inner = F.to_json(F.struct("doc_id", F.array("source").alias("xs")))
    page = F.concat("text", F.lit("\n<!-- source_index_json\n"), inner, F.lit("\n-->\nend"))
    noisy = F.concat(F.regexp_replace("text", r"\{", "("), inner)
    made = docs.select("doc_id", page.alias("page"), noisy.alias("noisy"))
    read = made.select("doc_id", sources.embedded_index("page").alias("a"), sources.after_noise("noisy").alias("b"))
    at = lambda c: F.get_json_object(c, "$.xs[0]")
    return read.select("doc_id", at("a").alias("hidden"), at("b").alias("after_noise"), F.length("a").cast("long").alias("chars"))


def text_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's title, written lines, defects of evidence, quality and capped confidence, with marks put among its lines."""
    rows = _lines(spark, sf_dir)
    line = F.when((F.col("n") == 1) & (F.col("doc_id") % 3 == 0), F.concat(F.lit("title: '"), F.regexp_replace("line", "['\"]", ""), F.lit("'"))).when((F.col("n") == 2) & (F.col("doc_id") % 3 == 1), F.concat(F.lit("# "), "line"))
    line = line.when((F.col("n") == 4) & (F.col("doc_id") % 5 == 0), "see ^[a-b-ch01-0001]").when((F.col("n") == 5) & (F.col("doc_id") % 7 == 0), "- related_to::[[x#^y]]").when((F.col("n") == 6) & (F.col("doc_id") % 4 == 0), "- warned_by::[[x]]")
    # what other lines have of such marks goes, whatever stands before it; each line, a blank last one too, ends in a line feed
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("line", r"[\^\[]", ""), "related_to::", ""), r"^(?:#+|\s*title:)+", "")
    made = _joined(rows, line.otherwise(bare), "doc_id").withColumn("text", F.concat("text", F.lit("\n")))
    quality = text.page_quality(F.col("doc_id") % 7, F.col("doc_id") % 3 * 2, F.col("doc_id") % 5 * 2, 6)
    return made.select("doc_id", text.unit_title("text", F.lit("none")).alias("title"), text.rendered_lines("text").cast("long").alias("lines"), F.array_join(text.hygiene("text"), ",").alias("defects"), F.round(quality, 2).alias("quality"), text.capped_confidence((F.col("doc_id") % 12) / 10).alias("confidence"))


def preflights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as books: states, gates and reports by their lines; what keeps each phase from starting, by number."""
    lines = _table(spark, sf_dir, "lineitem")
    place = lambda c: _pick(c, *control.PHASES)
    states = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("slug"), _pick(F.col("o_custkey"), *control.READY).alias("status"), F.slice(F.array(*map(F.lit, control.PHASES)), F.lit(1), (F.col("o_custkey") % 15).cast("int")).alias("completed_phases"))
    gates = lines.select(F.col("l_orderkey").alias("slug"), place(F.col("l_partkey")).alias("phase"), F.when(F.col("l_returnflag") == "R", "FAIL").otherwise("PASS").alias("status"))
    reports = lines.select(F.col("l_orderkey").alias("slug"), _pick(F.col("l_suppkey"), "size", "dispatch", "verification", "presentation", "confirmation").alias("kind"), F.lit("PASS").alias("status"), (F.col("l_linenumber") - 1).alias("count"))
    found = control.preflight(states, gates, reports)
    return found.groupBy("phase", F.coalesce("issue", F.lit("ready")).alias("issue")).agg(F.count("*").alias("books"))


def audit_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one book: chapters, paths, extractions, reports, links, index and log, each with defects by number."""
    docs, d = _table(spark, sf_dir, "documents"), F.col("doc_id")
    chapter = docs.select(F.concat(F.lit("ch"), d).alias("file"), F.concat(F.regexp_replace(F.coalesce("text", F.lit("")), r"\^", ""), F.when(d % 4 != 0, F.concat(F.lit(" ^book-ch01-"), d)).otherwise("")).alias("text"))
    folder = F.when(d % 50 == 0, F.concat(F.lit("test-"), d)).when(d % 50 == 1, F.concat(F.lit("archive/test-"), d)).otherwise(F.col("source"))
    paths = docs.select(F.concat(F.lit("raw/book/"), folder, F.lit("/"), d, F.lit(".md")).alias("path")).union(docs.limit(1).select(F.lit("contract.md")))
    concept = F.struct(F.when(d % 5 != 0, F.concat(F.lit("b-"), d)).alias("block_id"), F.when(d % 3 != 0, 0.5).alias("confidence"), F.left(F.coalesce("text", F.lit("")), F.lit(40)).alias("name"))
    extraction = docs.select(d.cast("string").alias("file"), F.when(d % 19 == 0, "{").otherwise(F.to_json(F.struct(F.array(concept).alias("concepts"), (d % 7 == 0).alias("no_lane_content")))).alias("json"))
    total = docs.agg(F.count("*").alias("n"))
    report = lambda name, body: total.select(F.lit(name).alias("name"), F.to_json(body).alias("json"))
    passed = lambda **more: F.struct(F.lit("PASS").alias("status"), *(c.alias(k) for k, c in more.items()))
    n, none = F.col("n"), F.lit(0)
    reports = report("schema-validation-report.json", passed(valid=n, total=n)).union(report("phase4-scoring-report.json", passed(candidate_count=n))).union(report("master-scored.json", passed()))
    reports = reports.union(report("phase4-confirmation.json", passed(selected_count=none))).union(report("gates/phase-4.json", passed())).union(report("presentation-report.json", passed(checked=n)))
    reports = reports.union(report("blockid-validation-report.json", F.struct(F.lit(True).alias("valid"), n.alias("referenced_block_ids"), F.lit(1).alias("missing_count"))))
    marks = spark.createDataFrame([("_validation_passed", "validated_by: schemer"), ("_blockid_valid", "validated_by: other")], "name string, text string")
    vault = graph_queries.vault(spark, sf_dir)
    page = vault.filter("file like 'concepts/%'").select(F.col("file").alias("page"), "text")
    index = docs.filter(d % 2 == 0).agg(F.array_join(F.collect_list(F.concat(F.lit("[[p"), d, F.lit("]]"))), " ").alias("text"))
    log = docs.select(F.concat(F.when(d % 2 == 0, "## [").otherwise("- ["), F.lit("2024] book | "), F.regexp_replace(F.coalesce("text", F.lit("")), r"(?i)fallback|split|chapter", "")).alias("line"))
    found = audit.chapter_checks(chapter, "book").union(audit.listing_checks(paths, "raw/book", "contract.md")).union(audit.extraction_checks(extraction)).union(audit.report_checks(reports, marks, {"pages": "pager", "schema": "schemer", "blocks": "blocker"}))
    found = found.union(audit.vault_checks(page, vault, index, docs.select(F.lit("x").alias("stem")).limit(0))).union(audit.log_checks(log, "book"))
    return audit.report(found, ("CH-01",), {"PO-42": True}).select("check_id", "category", "manual", "passed", F.col("failures").cast("long").alias("failures"))


QUERIES = {
    f.__name__: f
    for f in (
        chapter_detect, boundary_check, unit_discover, oversized_units, balance_findings, extracted_blocks, image_sources, image_gate, image_coverage, vision_marks, index_validity, lane_markdown,
        presentation_gate, dispatch_reports, record_check, lane_discipline, index_gaps, repair_totals, citation_scope, human_claims, merge_preconditions, front_matters, hidden_indexes, text_marks, preflights, audit_book,
    )
}

_L = r"""l0 AS (SELECT doc_id, source, string_split(text, chr(10)) AS a FROM documents), l AS (
  SELECT doc_id, source, n, regexp_replace(line, '[^ -~]', '', 'g') AS line FROM (
    SELECT doc_id, source, unnest(b) AS line, unnest(range(len(b))) + 1 AS n FROM (SELECT doc_id, source, CASE WHEN a[-1] = '' THEN a[:-2] ELSE a END AS b FROM l0)))"""
_TITLE = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '^#+\s*', ''), '<[^>]+>', '', 'g'), '\*\*(.*?)\*\*', '\1', 'g'), '\s+', ' ', 'g'))"
_LANE = r"""made AS (SELECT doc_id, 'ch' || doc_id AS unit_id, CASE WHEN doc_id % 2 = 0 THEN 'math' ELSE 'prose' END AS lane, n,
    CASE WHEN n = 1 AND doc_id % 5 <> 0 THEN 'Definitions' WHEN n = 3 THEN 'Examples' WHEN n = 5 AND doc_id % 4 = 0 THEN 'Notes' END AS head, n % 3 = 0 AND doc_id % 7 <> 0 AS cites,
    regexp_replace(regexp_replace(line, '^#+', ''), '[\^\[\]]', '', 'g') AS body FROM l WHERE n <= 12),
  sect AS (SELECT *, count(head) OVER (PARTITION BY doc_id ORDER BY n) AS part FROM made),
  texts AS (SELECT doc_id, unit_id, lane, doc_id % 9 = 0 AS empty, list(head) FILTER (head IS NOT NULL) AS heads, bool_or(cites) AS cites, string_agg(CASE WHEN head IS NULL THEN '' ELSE '## ' || head || chr(10) END || body || CASE WHEN cites THEN ' ^d-ch01-' || (n + 1000) ELSE '' END, chr(10) ORDER BY n) AS text FROM made GROUP BY ALL)"""

ORACLES = {
    "chapter_detect": rf"""WITH {_L}, m AS (SELECT doc_id, n, CASE WHEN n % 12 = 1 AND doc_id % 2 = 0 THEN '<div class=:doc_title>' WHEN n % 12 = 1 THEN 'Chapter ' || ((n - 1) // 24 + 1) || ': ' || line ELSE line END AS line FROM l),
          c AS (SELECT *, {_TITLE.format('line')} AS clean FROM m), w AS (SELECT *, list(CASE WHEN clean <> '' AND NOT starts_with(lower(clean), 'div align') AND NOT starts_with(clean, '/') THEN clean END) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS ahead FROM c),
          f AS (SELECT doc_id, 0 AS m, NULL::BIGINT AS chapter, [x FOR x IN ahead IF x IS NOT NULL][1] AS title, n FROM w WHERE contains(line, ':doc_title')
            UNION ALL SELECT doc_id, 1, regexp_extract(clean, '(?i)^Chapter\s+(\d+)[:\s\-]*(.+)?$', 1)::BIGINT, {_TITLE.format("regexp_extract(clean, '(?i)^Chapter\\s+(\\d+)[:\\s\\-]*(.+)?$', 2)")}, n FROM w WHERE regexp_matches(clean, '(?i)^Chapter\s+(\d+)[:\s\-]*(.+)?$')),
          g AS (SELECT doc_id, m, coalesce(chapter, row_number() OVER (PARTITION BY doc_id, m ORDER BY n)) AS chapter, title, n FROM f WHERE m = 1 OR (title IS NOT NULL AND lower(title) NOT IN {chapters.NO_CHAPTERS})),
          h AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY doc_id, m, chapter ORDER BY n) = 1), k AS (SELECT *, count(*) OVER (PARTITION BY doc_id, m) AS c FROM h)
        SELECT doc_id, CASE m WHEN 0 THEN 'doc-title' ELSE 'plain-text-chapter' END AS method, chapter, CASE WHEN title = '' THEN 'Chapter ' || chapter ELSE title END AS title, n - 1 AS line_start FROM k WHERE c >= 2 QUALIFY m = min(m) OVER (PARTITION BY doc_id)""",
    "boundary_check": rf"""WITH {_L}, s AS (SELECT doc_id, max(n) AS lc FROM l GROUP BY doc_id), b AS (SELECT doc_id, CASE WHEN n % 7 = 0 THEN '  ' ELSE line END AS title, CASE n % 4 WHEN 0 THEN n WHEN 1 THEN n - 9 WHEN 2 THEN n + 30 END AS a, CASE WHEN n % 3 = 0 THEN n - 1 WHEN n % 5 = 0 THEN n + 40 END AS e FROM l WHERE length(line) BETWEEN 1 AND 40),
          i AS (SELECT doc_id, title, CASE WHEN trim(title) = '' THEN 'missing title' WHEN a IS NULL OR a < 1 OR a > lc THEN 'invalid line_start' WHEN e < a OR e > lc THEN 'invalid line_end' END AS issue FROM b JOIN s USING (doc_id))
        SELECT doc_id, title, issue FROM i WHERE issue IS NOT NULL UNION ALL SELECT doc_id, '-', 'unit count differs' FROM s LEFT JOIN (SELECT doc_id, count(*) AS c FROM b GROUP BY doc_id) USING (doc_id) WHERE coalesce(c, 0) <> 2""",
    "unit_discover": """WITH d AS (SELECT source AS slug, doc_id, doc_id % 6 AS k, doc_id % 9 AS c, doc_id % 4 AS p FROM documents WHERE doc_id % 6 < 4),
          u AS (SELECT slug, 'raw/' || doc_id || '/' || CASE k WHEN 0 THEN 'ch-' || c || '-start.md' WHEN 1 THEN 'Chapter_' || c || '.md' WHEN 2 THEN 'part-' || c || '.md' ELSE 'ch0' || c || '-part-' || p || '.md' END AS file,
            CASE WHEN k = 2 THEN 0 ELSE c END AS chapter_num, CASE k WHEN 2 THEN c WHEN 3 THEN p END AS part_num,
            CASE k WHEN 2 THEN 'ch00-part' || printf('%03d', c) WHEN 3 THEN 'ch' || printf('%02d', c) || '-part' || printf('%02d', p) ELSE 'ch' || printf('%02d', c) END AS unit_id FROM d)
        SELECT *, count(*) OVER (PARTITION BY slug, unit_id) > 1 AS ambiguous FROM u""",
    "oversized_units": rf"""WITH {_L}, s AS (SELECT doc_id, max(n) AS line_count FROM l GROUP BY doc_id) SELECT 'ch' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '-part01' ELSE '' END AS unit_id, line_count, doc_id % 3 = 0 AS nested FROM s WHERE line_count > 30""",
    "balance_findings": f"""WITH m AS ({text_queries.ORACLES["evidence_balance"]}), w AS (SELECT *, category <> 'evidence_index' AS body, sum(CASE WHEN category <> 'evidence_index' THEN citations ELSE 0 END) OVER u AS inner_sum, sum(citations) OVER u AS whole,
            bool_or(required AND category <> 'evidence_index' AND citations < 2) OVER u AS thin FROM m WINDOW u AS (PARTITION BY unit_id)),
          r AS (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY body DESC, citations DESC, category) AS k FROM w)
        SELECT unit_id, 'thin_citations' AS code, category FROM r WHERE required AND body AND citations < 2 UNION ALL SELECT unit_id, 'thin_embeds', category FROM r WHERE required AND body AND embeds < 2
        UNION ALL SELECT unit_id, 'citation_monopoly_with_thin_sections', category FROM r WHERE body AND k = 1 AND thin AND inner_sum > 0 AND round(citations / inner_sum, 4) >= 0.4
        UNION ALL SELECT unit_id, 'evidence_index_dominates_total_citations', category FROM r WHERE NOT body AND whole > 0 AND round(citations / whole, 4) >= 0.6""",
    "extracted_blocks": rf"""WITH {_L}, m AS (SELECT *, CASE WHEN n % 7 = 0 THEN '' WHEN n % 5 = 0 THEN line || ' ' ELSE regexp_replace(line, '\^', '', 'g') END AS own, source || '-ch01-' || (n + 1000) AS id, n % 7 = 0 OR n % 5 = 0 AS anchored FROM l),
          s AS (SELECT *, regexp_replace(own, '^\s+|\s+$', '', 'g') AS t, regexp_replace(CASE WHEN anchored THEN own || '^' || id ELSE own END, '^\s+|\s+$', '', 'g') AS shown FROM m),
          a AS (SELECT *, last_value(CASE WHEN shown <> '' THEN shown END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above FROM s)
        SELECT doc_id AS file, n AS line_no, id AS block_id, CASE WHEN t <> '' THEN t ELSE coalesce(above, shown) END AS text FROM a WHERE anchored""",
    "image_sources": rf"""WITH {_L}, r AS (SELECT doc_id, source, n, 'p' || n % 30 || '.png' AS name FROM l WHERE n % 9 = 0), far AS (SELECT name, min('ocr/' || source || '/' || name) AS p FROM r WHERE n % 3 = 0 AND n % 30 < 20 GROUP BY name)
        SELECT 'raw/' || doc_id || '/ch.md' AS file, 'imgs/' || name || '#x' AS ref, CASE WHEN doc_id % 2 = 0 THEN 'raw/' || doc_id || '/imgs/' || name ELSE p END AS source, count(*) AS n FROM r LEFT JOIN far USING (name) GROUP BY ALL""",
    "image_gate": rf"""WITH {_L}, r AS (SELECT doc_id, (n // 9) % 3 AS k FROM l WHERE n % 9 = 0), s AS (SELECT count(*) AS refs, count(*) FILTER (k = 2 OR (k = 0 AND doc_id % 4 = 0)) AS missing, count(*) FILTER (k = 1) AS remote FROM r)
        SELECT *, CASE WHEN missing > 0 OR remote > 0 OR refs = 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM s""",
    "image_coverage": rf"""WITH {_L}, p AS (SELECT DISTINCT doc_id, n, doc_id % 3 = 0 AS team, doc_id % 40 + n % 50 AS i FROM l WHERE n % 11 = 0), e AS (SELECT range AS i FROM range(120))
        SELECT 'imgs/fig' || e.i || '.png' AS image, count(*) FILTER (NOT team) AS concept_pages, count(*) FILTER (team) AS team_pages, count(*) FILTER (NOT team) > 0 AS concept_covered, count(*) FILTER (team) > 0 AS team_covered FROM e LEFT JOIN p USING (i) GROUP BY e.i""",
    "vision_marks": rf"""WITH {_L}, r AS (SELECT doc_id, source, n, 'ch' || doc_id || '-L' || printf('%04d', n) AS p FROM l WHERE n % 10 = 0), m AS (SELECT *, unnest(['VISION_CHART-1', 'VISION_CHART-2', 'MISSING_IMAGE-1']) AS k FROM r)
        SELECT p || '-' || k AS id, 'ch' || doc_id AS unit_id, left(k, -2) AS marker, source || '-ch01-' || (n + 1000) AS block_id, k = 'VISION_CHART-2' AND doc_id % 2 = 0 AND n % 20 <> 0 AS resolved FROM m""",
    "index_validity": rf"""WITH {_L}, r AS (SELECT doc_id::VARCHAR AS unit_id, 'd-ch01-' || (n + 1000) AS block_id, n, doc_id % 10 <> 9 AS held FROM l WHERE trim(line) <> ''), x AS (SELECT *, CASE WHEN n % 8 = 0 THEN 0 WHEN n % 8 = 1 THEN 2 ELSE 1 END AS times FROM r)
        SELECT unit_id, block_id, 'missing from the index' AS issue, 1 AS n FROM x WHERE held AND times = 0 UNION ALL SELECT unit_id, block_id, 'extra in the index', 1 FROM x WHERE times > held::INT
        UNION ALL SELECT unit_id, block_id, 'unknown category', times FROM x WHERE times > 0 AND (n + 1000) % 13 = 0 UNION ALL SELECT DISTINCT unit_id, '-', 'unknown unit', 1 FROM x WHERE NOT held AND times > 0""",
    "lane_markdown": rf"""WITH {_L}, {_LANE}, t AS (SELECT unit_id, lane, CASE WHEN empty THEN [] ELSE coalesce(heads, []) END AS heads, empty, CASE WHEN empty THEN '' ELSE text END AS text, cites AND NOT empty AS cites, CASE lane WHEN 'math' THEN ['Definitions', 'Examples'] ELSE ['Definitions', 'Warnings'] END AS need FROM texts)
        SELECT unit_id, lane, 'missing section: ' || h AS issue FROM (SELECT *, unnest([x FOR x IN need IF NOT list_contains(heads, x)]) AS h FROM t) UNION ALL SELECT unit_id, lane, 'forbidden section: ' || h FROM (SELECT *, unnest([x FOR x IN heads IF NOT list_contains(need, x)]) AS h FROM t WHERE lane = 'math')
        UNION ALL SELECT unit_id, lane, 'empty markdown output' FROM t WHERE empty UNION ALL SELECT unit_id, lane, 'no block ids cited' FROM t WHERE NOT cites UNION ALL SELECT unit_id, lane, 'placeholder' FROM t WHERE regexp_matches(lower(text), {text_queries._SLOP})""",
    "presentation_gate": rf"""WITH {_L}, {_LANE}, t AS (SELECT unit_id, CASE WHEN empty THEN [] ELSE coalesce(heads, []) END AS heads, CASE WHEN empty THEN '' ELSE text END AS text FROM texts),
          b AS (SELECT unit_id, max(head) AS head, bool_or(cites) AS cites, regexp_replace(string_agg(body, '' ORDER BY n), '^\s+|\s+$', '', 'g') AS body FROM sect WHERE part > 0 AND doc_id % 9 <> 0 GROUP BY unit_id, part)
        SELECT unit_id, issue, count(*) AS n FROM (SELECT unit_id, 'missing section: ' || h AS issue FROM (SELECT *, unnest([x FOR x IN ['Definitions', 'Examples'] IF NOT list_contains(heads, x)]) AS h FROM t) UNION ALL SELECT unit_id, 'unexpected section: Notes' FROM t WHERE list_contains(heads, 'Notes')
          UNION ALL SELECT unit_id, unnest(['too few embeds', 'too few quotes']) FROM t UNION ALL SELECT unit_id, 'placeholder' FROM t WHERE regexp_matches(lower(text), {text_queries._SLOP})
          UNION ALL SELECT unit_id, CASE WHEN body = '' AND NOT cites THEN 'empty section: ' ELSE 'section without citation: ' END || head FROM b WHERE head <> 'Notes' AND NOT cites) GROUP BY ALL""",
    "dispatch_reports": """WITH r AS (SELECT l_orderkey AS u, l_linenumber AS k, min(l_partkey) AS p FROM lineitem GROUP BY ALL), t AS (SELECT o_orderkey AS u, unnest([1, 2, 3, 4]) AS k FROM orders), i AS (
          SELECT t.k, 'missing' AS issue FROM t ANTI JOIN r USING (u, k) UNION ALL SELECT r.k, 'extra' FROM r ANTI JOIN t USING (u, k) UNION ALL SELECT k, 'no job_id' FROM r WHERE p % 9 = 0 UNION ALL SELECT k, 'no runtime_task_id' FROM r WHERE p % 11 = 0)
        SELECT k::VARCHAR AS lane, issue, count(*) AS n FROM i GROUP BY ALL""",
    "record_check": """WITH r AS (SELECT l_orderkey AS o, struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey) AS x, CASE WHEN l_linenumber = 2 THEN CASE WHEN l_partkey % 5 = 0 THEN l_orderkey::VARCHAR WHEN l_partkey % 7 = 0 THEN 'mock-1' ELSE 'j' || l_partkey END END AS j,
            CASE WHEN l_linenumber = 3 THEN 't' || l_suppkey END AS t, CASE WHEN l_quantity > 10 THEN 'tool' END AS l FROM lineitem),
          s AS (SELECT o_orderkey::VARCHAR AS task_id, arg_max(j, x) FILTER (j IS NOT NULL) AS j, arg_max(t, x) FILTER (t IS NOT NULL) AS t, max(l) AS l FROM orders LEFT JOIN r ON o = o_orderkey GROUP BY 1)
        SELECT task_id, 'missing job_id' AS issue FROM s WHERE j IS NULL UNION ALL SELECT task_id, 'synthetic job_id' FROM s WHERE j = task_id OR j = 'mock-1' UNION ALL SELECT task_id, 'missing runtime_task_id' FROM s WHERE t IS NULL UNION ALL SELECT task_id, 'missing runtime' FROM s WHERE l IS NULL""",
    "lane_discipline": """SELECT o_orderpriority AS lane, count(*) AS expected, count(*) FILTER (o_orderstatus = 'F') AS recorded, count(*) FILTER (NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')) AS missing_outputs FROM orders GROUP BY 1""",
    "index_gaps": f"""WITH {graph_queries._HREFS}, a AS (SELECT DISTINCT lower(regexp_replace(href, '^/', '')) AS stem FROM hrefs), b AS (SELECT DISTINCT lower(regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1)) AS stem FROM pages)
        SELECT stem, 'missing from index' AS issue FROM b ANTI JOIN a USING (stem) WHERE stem <> '' UNION ALL SELECT stem, 'stale entry' FROM a ANTI JOIN b USING (stem) WHERE stem <> ''""",
    "repair_totals": f"""WITH r AS ({graph_queries.ORACLES["vault_repair"]}) SELECT count(*) AS files, (SELECT count(*) FROM documents WHERE doc_id % 7 > 0)::BIGINT AS files_changed, sum(canonical)::BIGINT AS canonical, sum(rewritten)::BIGINT AS rewritten, sum(unresolved)::BIGINT AS unresolved FROM r""",
    "citation_scope": rf"""WITH {_L} SELECT doc_id AS unit_id, CASE WHEN n % 6 = 0 THEN 'wrong slug' ELSE 'outside unit source index' END AS issue, count(*) AS n FROM l WHERE n % 6 = 0 OR n % 2 = 1 GROUP BY ALL""",
    "human_claims": rf"""WITH {_L}, q AS (SELECT *, trim(regexp_replace(regexp_replace(line, '[*_`]+', '', 'g'), '\s+', ' ', 'g')) AS quote FROM l WHERE trim(line) <> '' AND n <= 6), c AS (SELECT *, ['EXTRACTED', 'INFERRED', 'AMBIGUOUS'][n % 3 + 1] AS confidence, n % 3 = 0 AND n <> 4 AND (n % 5 = 3 OR quote = '') AS lost FROM q)
        SELECT doc_id AS file, n AS claim_index, confidence, 'AMBIGUOUS' AS effective_confidence, CASE WHEN lost THEN '{grounding.REASON}' ELSE '' END AS reason FROM c WHERE lost OR confidence = 'AMBIGUOUS'""",
    "merge_preconditions": """WITH s AS (SELECT source, source[4:]::INT AS k, count(quality) AS total, sum(coalesce(quality, 0)) AS valid FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)
        SELECT source AS slug, CASE WHEN k % 7 = 0 THEN 'marker missing' WHEN k % 5 = 0 THEN 'marker of another writer' ELSE 'report is not a non-empty PASS' END AS issue FROM s WHERE k % 7 = 0 OR k % 5 = 0 OR total = 0 OR (k % 2 = 1 AND valid <> total)""",
    "front_matters": rf"""WITH {_L}, k AS (SELECT doc_id, n, trim(regexp_replace(line, '["'':#\\-]', '', 'g'), ' ') AS v FROM l WHERE n <= 3)
        SELECT doc_id, count(*) + 1 AS entries, max(v) FILTER (n = 1) AS first, max(v) FILTER (n = 2) AS second, 'all' AS scope, chr(10) || 'body of ' || doc_id || ' --- and more' AS rest FROM k GROUP BY doc_id""",
    "hidden_indexes": """SELECT doc_id, source AS hidden, source AS after_noise, length('{"doc_id":' || doc_id || ',"xs":["' || source || '"]}') AS chars FROM documents""",
    "text_marks": rf"""WITH {_L}, m AS (SELECT doc_id, n, CASE WHEN n = 1 AND doc_id % 3 = 0 THEN 'title: ''' || regexp_replace(line, '[''"]', '', 'g') || '''' WHEN n = 2 AND doc_id % 3 = 1 THEN '# ' || line WHEN n = 4 AND doc_id % 5 = 0 THEN 'x' WHEN n = 5 AND doc_id % 7 = 0 THEN 'y' WHEN n = 6 AND doc_id % 4 = 0 THEN 'z'
            ELSE regexp_replace(regexp_replace(line, '^(#+|title:)', ''), '[\^\[]', '', 'g') END AS line FROM l),
          t AS (SELECT doc_id, max(n) AS c, max(CASE WHEN doc_id % 3 = 0 AND n = 1 THEN regexp_replace(line, '^title: ''|''$', '', 'g') WHEN doc_id % 3 = 1 AND n = 2 THEN trim(regexp_replace(line, '^#+\s*', '')) END) AS title, bool_or(n = 4) AS four, bool_or(n = 5) AS five, bool_or(n = 6) AS six FROM m GROUP BY doc_id)
        SELECT doc_id, coalesce(nullif(title, ''), 'none') AS title, c AS lines, array_to_string([x FOR x IN [CASE WHEN four AND doc_id % 5 = 0 THEN 'bracketed block id' END, CASE WHEN six AND doc_id % 4 = 0 THEN 'predicate without anchor' END, CASE WHEN five AND doc_id % 7 = 0 THEN 'related_to for relates_to' END] IF x IS NOT NULL], ',') AS defects,
          round_even(0.5 * (doc_id % 7) / 6 + 0.3 * least(1.0, (doc_id % 3) / 2) + 0.2 * least(1.0, (doc_id % 5) / 4), 2)::DOUBLE AS quality, least(0.95, coalesce(nullif(doc_id % 12 / 10, 0), 0.5))::DOUBLE AS confidence FROM t""",
    "preflights": f"""WITH s AS (SELECT o_orderkey AS slug, {list(control.READY)}[o_custkey % {len(control.READY)} + 1] AS status, {list(control.PHASES)}[1:o_custkey % 15] AS done FROM orders),
          g AS (SELECT l_orderkey AS slug, {list(control.PHASES)}[l_partkey % 15 + 1] AS needs, max(CASE WHEN l_returnflag = 'R' THEN 'FAIL' ELSE 'PASS' END) AS gate FROM lineitem GROUP BY ALL),
          r AS (SELECT l_orderkey AS slug, ['size', 'dispatch', 'verification', 'presentation', 'confirmation'][l_suppkey % 5 + 1] AS kind, max(l_linenumber - 1) AS n FROM lineitem GROUP BY ALL),
          p(phase, needs, allowed, kind, counted) AS (VALUES {", ".join(f"('{p}', '{needs}', {list(allowed)}, {repr(k) if (k := control.REPORTS.get(p, (None, None))[0]) else 'NULL'}, {bool(control.REPORTS.get(p, (None, None))[1])})" for p, (needs, allowed) in control.PRECONDITIONS.items())}),
          i AS (SELECT phase, CASE WHEN gate IS NULL THEN 'gate missing' WHEN gate <> 'PASS' THEN 'gate not PASS' WHEN NOT list_contains(done, needs) THEN 'phase not complete' WHEN NOT list_contains(allowed, status) THEN 'state not ready'
            WHEN kind IS NOT NULL AND r.n IS NULL THEN 'report not PASS' WHEN counted AND r.n <= 0 THEN 'report empty' ELSE 'ready' END AS issue FROM s CROSS JOIN p LEFT JOIN g USING (slug, needs) LEFT JOIN r USING (slug, kind))
        SELECT phase, issue, count(*) AS books FROM i GROUP BY ALL""",
    "audit_book": f"""WITH {graph_queries._VAULT}, n AS (SELECT count(*) AS n FROM documents), failing(check_id, failures) AS (
          SELECT 'CH-01', 1 UNION ALL SELECT 'CH-02', count(*) FROM documents WHERE doc_id % 4 = 0 UNION ALL SELECT 'CH-03', 1 UNION ALL SELECT 'CH-04', count(DISTINCT doc_id) FROM documents WHERE doc_id % 50 = 0
          UNION ALL SELECT 'EX-11', count(*) FROM documents WHERE doc_id % 19 <> 0 AND doc_id % 5 = 0 AND doc_id % 7 <> 0 UNION ALL SELECT 'EX-12', count(*) FROM documents WHERE doc_id % 19 <> 0 AND doc_id % 3 = 0
          UNION ALL SELECT unnest(['EX-08', 'SC-16', 'SC-17', 'SC-18', 'SC-19', 'SC-20']), 1 UNION ALL SELECT 'WI-47', count(DISTINCT file || raw) FROM found WHERE status NOT IN ('ok', 'suffix_match')
          UNION ALL SELECT 'WI-48', 0 UNION ALL SELECT 'WI-49', count(*) FROM documents WHERE doc_id % 2 = 1),
          every(check_id, category, manual) AS (VALUES {", ".join(f"('{k}', '{c}', {k in audit.MANUAL})" for c, ks in audit.CHECKS.items() for k in ks)})
        SELECT check_id, category, manual, coalesce(failures, 0) = 0 AND check_id <> 'SC-22' AS passed, coalesce(failures, 0)::BIGINT AS failures FROM every LEFT JOIN failing USING (check_id)""",
}
