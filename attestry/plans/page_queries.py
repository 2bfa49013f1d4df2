"""Queries on pages, evidence, regions, ledgers and gates, made of the tables' rows, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import blocks, control, images, links, pages, reports
from ..sources import files as sources
from ..sources import scratch, sinks
from . import claim_queries, text_queries
from .check_queries import _L, _joined, _lines, _pick, _table


def ledger_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a ledger in two goes, with broken lines between; what reading it back gives, by phase."""
    events = _table(spark, sf_dir, "events")
    path = f"{scratch.shared_dir(spark)}/attestry/ledger-{uuid.uuid4().hex}"
    rows = events.select(F.col("event_type").alias("phase"), F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("tokens_in"), F.round(F.col("value") * 100).cast("long").alias("tokens_out"), "event_id")
    for part in (0, 1):
        sinks.append_events(rows.filter(F.col("event_id") % 2 == part).drop("event_id"), path)
    rows.filter("event_id % 10 = 0").select(F.concat(F.lit('{"phase": "'), "phase", F.lit('", "tokens_in": ')).alias("value")).write.mode("append").text(path)
    back = sources.ledger(spark, path)
    sums = (F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens_in", "tokens_out"))
    whole = back.filter("bad is null").groupBy("phase").agg(F.count("*").alias("events"), *sums)
    return whole.unionByName(back.filter("bad is not null").agg(F.count("*").alias("events")).select(F.lit("broken").alias("phase"), "events", F.lit(0).cast("long").alias("tokens_in"), F.lit(0).cast("long").alias("tokens_out")))


def overlap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overlaps of all pages as the lines of a report."""
    rows = claim_queries.lexical_overlap(spark, sf_dir).select(F.col("page").cast("string").alias("page"), "status", (F.col("page") % 4).alias("cited"), "synthesis_overlap", "full_overlap")
    return reports.overlap(rows, "all")


def image_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a language as images, their labelled ones as pages of concepts and teams, as the lines of a report."""
    docs = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id", "left")
    some = lambda c: F.array_sort(F.collect_list(F.when(c, F.concat(F.lit("p"), F.lpad(F.col("doc_id").cast("string"), 9, "0")))))
    rows = docs.groupBy(F.concat("source", F.lit(".png")).alias("image")).agg(F.count("*").alias("refs"), some((F.col("quality") == 0) & (F.col("doc_id") % 5 == 0)).alias("concept_pages"), some((F.col("quality") == 1) & (F.col("doc_id") % 3 == 0)).alias("team_pages"))
    refs = docs.agg(F.count("*").alias("chapter_files"), F.count("quality").alias("local_refs"), F.lit(None).cast("long").alias("resolved"), F.lit(0).alias("missing"), F.lit("PASS").alias("status"))
    return reports.image_coverage(rows, refs, "all")


def gate_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines appended as gates, by return flag in two goes; the last one of each order and phase counts."""
    lines = _table(spark, sf_dir, "lineitem")
    path = f"{scratch.shared_dir(spark)}/attestry/gates-{uuid.uuid4().hex}"
    gates = lines.select(F.col("l_orderkey").alias("slug"), _pick(F.col("l_partkey"), *control.PHASES).alias("phase"), _pick(F.col("l_suppkey"), "PASS", "FAIL").alias("status"), F.col("l_shipdate").alias("at"), "l_returnflag")
    for flags in (("R",), ("A", "N")):
        sinks.append_gate(gates.filter(F.col("l_returnflag").isin(*flags)), path)
    last = sinks.latest_gates(spark.read.parquet(path))
    return last.select("slug", "phase", "status", F.date_format("at", "yyyy-MM-dd").alias("at"))


def gate_marking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as gates of validation and of block ids, with totals by number."""
    o = F.col("o_orderkey")
    gates = _table(spark, sf_dir, "orders").select(o.alias("slug"), F.when(o % 2 == 0, "3.4").otherwise("4").alias("phase"), F.when(F.col("o_orderstatus") == "F", "FAIL").otherwise("PASS").alias("status"), F.lit("tool").alias("writer"), (F.col("o_custkey") % 4).alias("valid"), (F.col("o_custkey") % 5).alias("total"), F.when(o % 7 != 0, F.col("o_custkey") % 3).alias("missing"))
    return control.gate_marks(gates).select("slug", "phase", "validation_passed", "blockid_valid")


def finished_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as books that audit and grounding let end, and those whose content is another than the known one."""
    o = F.col("o_orderkey")
    states = _table(spark, sf_dir, "orders").select(o.alias("slug"), F.when(o % 3 == 0, "READY_FOR_POST").otherwise(F.col("o_orderstatus")).alias("status"), (F.col("o_custkey") % 4 != 0).alias("audit_pass"), F.when(o % 5 != 0, F.col("o_custkey") % 3 != 0).alias("grounding_pass"))
    known = _table(spark, sf_dir, "orders").select(o.alias("slug"), F.col("o_orderpriority").alias("sha256"))
    comes = known.select("slug", F.when(F.col("slug") % 11 == 0, "other").otherwise(F.col("sha256")).alias("sha256"))
    clash = control.identity_conflicts(known, comes).select("slug", F.lit(True).alias("conflict"))
    return control.finalize(states).join(clash, "slug", "left").select("slug", "status", F.coalesce("conflict", F.lit(False)).alias("conflict"))


def source_index_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' blocks written as indexes by category: the digest of each text."""
    start = lambda t: F.substring(F.regexp_replace(F.regexp_replace(t, "[^ -~]", ""), r"\s+", " "), 1, 60)
    found = blocks.shown_blocks(blocks.spread(text_queries.files(spark, sf_dir)), start)
    out = pages.source_index(found.select("slug", F.col("chapter").alias("unit_id"), "line_no", "block_id", "text", "category"), 60)
    return out.select(F.col("unit_id").alias("doc_id"), F.length("markdown").cast("long").alias("chars"), F.sha2(F.col("markdown").cast("binary"), 256).alias("digest"))


def page_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as concepts: two of their lines as sections, others as the author's words; the pages."""
    rows = _lines(spark, sf_dir)
    line = lambda k: F.coalesce(F.max(F.when(F.col("n") == k, F.col("line"))), F.lit(""))
    words = F.array_join(F.array_sort(F.collect_list(F.when(F.col("n").between(3, 7), F.struct("n", F.concat(F.lit("> "), "line").alias("x")))))["x"], "\n")
    made = rows.groupBy("doc_id").agg(line(1).alias("a"), line(2).alias("b"), words.alias("author_words"), F.count("*").alias("n"))
    sections = F.map_from_arrays(F.array(F.lit("Alpha"), F.lit("Beta")), F.array("a", "b"))
    name = F.concat(F.lit("4.2 "), F.regexp_replace(F.left("a", F.lit(30)), r'["\\]', ""))
    concepts = made.select(F.concat(F.lit("c-"), "doc_id").alias("slug"), name.alias("name"), ((F.col("doc_id") % 12) / 10).alias("confidence"), F.transform(F.sequence(F.lit(1), (F.col("doc_id") % 5 + 1).cast("int")), lambda i: i.cast("string")).alias("block_ids"), sections.alias("section_bodies"), "author_words")
    out = pages.render(concepts, 2)
    head = lambda k: F.regexp_extract("markdown", rf"(?m)^{k}: (.*)$", 1)
    return out.select("slug", head("title").alias("title"), head("confidence").cast("double").alias("confidence"), F.regexp_extract("markdown", r"(?s)\n# .*", 0).alias("body"))


def evidence_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as concepts of their lines' parts, documents' lines as presentations that cite parts: each concept's blocks with their units, written as rows."""
    lines = _table(spark, sf_dir, "lineitem")
    ids = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda x: F.concat(F.lit("d-ch01-"), x["l_partkey"] + 1000))
    concepts = lines.groupBy("l_orderkey").agg(ids.alias("block_ids")).select(F.col("l_orderkey").cast("string").alias("slug"), "block_ids")
    shown = _lines(spark, sf_dir).select(F.concat(F.lit("u"), "doc_id").alias("unit_id"), F.concat(F.regexp_replace("line", r"\^", ""), F.lit(" ^d-ch01-"), F.col("doc_id") * 7 % 300 + F.col("n") + 1000).alias("text"))
    index = pages.evidence_index(concepts, shown)
    refs = _table(spark, sf_dir, "part").filter("p_size < 10").select(F.concat(F.lit("d-ch01-"), F.col("p_partkey") + 1000).alias("block_id"), F.col("p_brand").alias("ref"))
    return pages.evidence_section(index, refs, "raw/d").select("slug", F.sha2(F.col("markdown").cast("binary"), 256).alias("digest"))


def filled_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sections of each document, of which some cite nothing: with the unit's evidence, put together, and what is still uncited before."""
    rows = _lines(spark, sf_dir).filter("n <= 6")
    id_ = F.concat(F.lit("d-ch01-"), F.col("n") + 1000)
    parts = rows.filter("n <= 2").select(F.col("doc_id").alias("unit_id"), F.when(F.col("n") == 1, "Relations").otherwise("Definitions").alias("header"), F.concat(F.regexp_replace("line", r"\^", ""), F.when((F.col("doc_id") + F.col("n")) % 3 == 0, F.concat(F.lit(" ^"), id_)).otherwise("")).alias("body"))
    own = rows.select(F.col("doc_id").alias("unit_id"), F.col("n").cast("int").alias("pos"), id_.alias("block_id"), F.col("line").alias("text"))
    targets = rows.select(F.col("doc_id").alias("unit_id"), F.concat(F.lit("raw/"), "source").alias("target")).distinct()
    order = spark.createDataFrame([("Definitions", 1), ("Relations", 2)], "header string, place int")
    whole = pages.assemble(pages.with_evidence(parts, own, targets), order)
    left = pages.uncited(own, whole.select("unit_id", F.col("markdown").alias("text"))).groupBy("unit_id").agg(F.count("*").alias("uncited"))
    out = whole.join(left, "unit_id", "left")
    return out.select(F.col("unit_id").alias("doc_id"), F.coalesce("uncited", F.lit(0)).alias("uncited"), F.sha2(F.col("markdown").cast("binary"), 256).alias("digest"))


def inferred_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as claims, a third of them inferred, half of these of blocks with a file of their own."""
    rows = _lines(spark, sf_dir).filter("trim(line) <> ''")
    claims = rows.select(F.concat(F.lit("c-"), "doc_id").alias("slug"), "source", F.col("n").alias("ord"), F.col("line").alias("text"), F.when(F.col("n") % 6 != 4, F.concat("doc_id", F.lit("-"), "n")).alias("block_id"), _pick(F.col("n"), "EXTRACTED", "INFERRED", "AMBIGUOUS").alias("confidence"))
    refs = rows.filter("doc_id % 2 = 0").select(F.concat("doc_id", F.lit("-"), "n").alias("block_id"), F.concat(F.lit("raw/"), "doc_id").alias("ref"))
    found = links.inferred_claims(claims, refs)
    return found.select("slug", "ord", F.sha2(F.col("note").cast("binary"), 256).alias("digest"))


def foreign_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' lines with relations among them, some of predicates that nothing defines."""
    rows = _lines(spark, sf_dir)
    name = _pick(F.col("n"), "extracted_from", "made_of", "defined_by", "kind_of")
    line = F.when(F.col("n") % 5 == 0, F.concat(F.lit("- "), name, F.lit("::[[p]]"))).otherwise(F.regexp_replace("line", "::", ":"))
    files = _joined(rows, line, "doc_id").select(F.concat("doc_id", F.lit(".md")).alias("file"), "text")
    return links.foreign_predicates(files, ("extracted_from", "defined_by"))


def region_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' lines as regions with addresses of images in fields and texts; what local names make of them."""
    rows = _lines(spark, sf_dir)
    url = F.concat(F.lit("https://a.org/img"), F.col("n") % 20, F.lit(".png"))
    k, none = F.col("n") % 5, F.lit(None).cast("string")
    said = F.regexp_replace("line", "[Hh]ttps?", "")
    regions = rows.select(
        "doc_id", "n", F.when(k == 0, "image").otherwise("text").alias("label"), none.alias("native_label"), F.when(k == 0, url).when(k == 1, F.concat(said, F.lit(" see "), url, F.lit(", ok"))).otherwise(said).alias("content"),
        F.when(k == 2, url).alias("image_path"), none.alias("source_url"), F.when(k == 3, F.concat(F.lit("at "), url)).alias("file_url"), none.alias("url"),
    )
    assets = spark.range(10).select(F.concat(F.lit("https://a.org/img"), "id", F.lit(".png")).alias("url"), F.concat(F.lit("imgs/"), "id", F.lit(".png")).alias("local"))
    out = images.local_regions(regions, assets, ["doc_id", "n"])
    return out.select("doc_id", "n", "is_image", F.sha2(F.col("content").cast("binary"), 256).alias("digest"), "image_path", "source_url")


def json_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in ragged JSON, some with addresses or folders of images at some depth, one line in 13 broken."""
    rows = _lines(spark, sf_dir)
    url = F.concat(F.lit("https://a.org/img"), F.col("n") % 20, F.lit(".png"))
    said = F.regexp_replace(F.regexp_replace("line", "(?i)https?|imgs/|images/", ""), r"[\\]", "")
    deep = F.when(F.col("n") % 3 == 0, F.concat(said, F.lit(" ("), url, F.lit(")"))).when(F.col("n") % 3 == 1, F.concat(said, F.lit(" imgs/x"))).otherwise(said)
    body = F.to_json(F.struct(F.array(F.struct(said.alias("https://a.org/key.png"), F.struct(F.array(deep, F.when(F.col("n") % 6 == 0, url)).alias("ys")).alias("x"))).alias("xs")))
    made = rows.select("doc_id", "n", F.when(F.col("n") % 13 == 0, "{").otherwise(body).alias("json"))
    return made.select("doc_id", "n", F.array_join(images.json_urls("json"), ",").alias("urls"), F.coalesce(images.json_has_images("json"), F.lit(False)).alias("has_images"))


QUERIES = {f.__name__: f for f in (overlap_report, image_report, ledger_round_trip, gate_log, gate_marking, finished_books, source_index_text, page_render, evidence_lists, filled_sections, inferred_notes, foreign_predicates, region_images, json_images)}

_PHASES = list(control.PHASES)

_FIXED = lambda part, *lines: " UNION ALL ".join(f"SELECT {part} AS part, '{k:09d}' AS at, {rules.quoted(x)} AS line" for k, x in enumerate(lines))

ORACLES = {
    "overlap_report": f"""WITH o AS ({claim_queries.ORACLES["lexical_overlap"]}), c AS (SELECT count(*) AS n, count(*) FILTER (status <> 'PASS') AS bad FROM o)
        {_FIXED(1, "# Lexical Overlap Report — `all`", "", "Threshold: synthesis overlap ≥ `0.12`")} UNION ALL SELECT 2, '000000000', 'Pages checked: ' || n FROM c UNION ALL SELECT 2, '000000001', 'Flagged pages: ' || bad FROM c
        UNION ALL {_FIXED(3, "", *reports.OVERLAP_TABLE)} UNION ALL SELECT 4, page::VARCHAR, '| ' || status || ' | `' || page || '` | ' || page % 4 || ' | ' || printf('%.4f', synthesis_overlap) || ' | ' || printf('%.4f', full_overlap) || ' |' FROM o""",
    "image_report": f"""WITH d AS (SELECT *, 'p' || printf('%09d', doc_id) AS p FROM documents LEFT JOIN labels USING (doc_id)), r AS (SELECT source || '.png' AS image, count(*) AS refs, coalesce(list(p ORDER BY p) FILTER (quality = 0 AND doc_id % 5 = 0), []) AS cs, coalesce(list(p ORDER BY p) FILTER (quality = 1 AND doc_id % 3 = 0), []) AS ts FROM d GROUP BY source)
        {_FIXED(1, "# Image-to-Page Coverage — `all`", "", "## Source image-ref verification", "")} UNION ALL SELECT 2, printf('%09d', k), line FROM (SELECT unnest([0, 1, 2, 3, 4]) AS k, unnest(['- Chapter files: `' || count(*) || '`', '- Local refs: `' || count(quality) || '`', '- Resolved: `unknown`', '- Missing: `0`', '- Status: `PASS`']) AS line FROM d)
        UNION ALL {_FIXED(3, "", "## Coverage table", "")} UNION ALL SELECT 4, printf('%09d', k), line FROM (SELECT unnest([0, 1, 2]) AS k, unnest(['Images in chapter markdown: `' || count(*) || '`', 'Images referenced by concept pages: `' || count(*) FILTER (len(cs) > 0) || '`', 'Images referenced by team extraction pages: `' || count(*) FILTER (len(ts) > 0) || '`']) AS line FROM r)
        UNION ALL {_FIXED(5, "", *reports.IMAGE_TABLE)} UNION ALL SELECT 6, image, '| `' || image || '` | ' || refs || ' | ' || CASE WHEN len(cs) = 0 THEN '—' ELSE array_to_string(['`' || x || '`' FOR x IN cs], ', ') END || ' | '
          || CASE WHEN len(ts) = 0 THEN '—' ELSE array_to_string(['`' || x || '`' FOR x IN ts[1:4]], ', ') || CASE WHEN len(ts) > 4 THEN ', … +' || (len(ts) - 4) ELSE '' END END || ' |' FROM r""",
    "ledger_round_trip": """SELECT event_type AS phase, count(*) AS events, coalesce(sum(CASE WHEN event_id % 3 <> 0 THEN event_id END), 0)::BIGINT AS tokens_in, sum(round(value * 100))::BIGINT AS tokens_out FROM events GROUP BY 1
        UNION ALL SELECT 'broken', count(*), 0, 0 FROM events WHERE event_id % 10 = 0""",
    "gate_log": f"""WITH g AS (SELECT l_orderkey AS slug, {_PHASES}[l_partkey % {len(_PHASES)} + 1] AS phase, ['PASS', 'FAIL'][l_suppkey % 2 + 1] AS status, l_shipdate AS t FROM lineitem)
        SELECT slug, phase, arg_max(status, struct_pack(a := t, b := status)) AS status, strftime(max(t), '%Y-%m-%d') AS at FROM g GROUP BY slug, phase""",
    "gate_marking": """WITH g AS (SELECT o_orderkey AS slug, CASE WHEN o_orderkey % 2 = 0 THEN '3.4' ELSE '4' END AS phase, o_orderstatus <> 'F' AND o_custkey % 5 > 0 AS ok, o_custkey % 4 = o_custkey % 5 AS whole, o_orderkey % 7 <> 0 AND o_custkey % 3 = 0 AS none FROM orders)
        SELECT slug, phase, ok AND whole AND phase = '3.4' AS validation_passed, ok AND none AND phase = '4' AS blockid_valid FROM g""",
    "finished_books": """SELECT o_orderkey AS slug, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_custkey % 4 <> 0 AND o_orderkey % 5 <> 0 AND o_custkey % 3 <> 0 THEN 'DONE' ELSE 'READY_FOR_POST' END ELSE o_orderstatus END AS status, o_orderkey % 11 = 0 AND o_orderpriority <> 'other' AS conflict FROM orders""",
    "source_index_text": rf"""WITH {text_queries._CLASSED}, r AS (SELECT doc_id, list_position({list(rules.CATEGORIES)}, category) AS p, category, n, '- `^' || block_id || '` ' || left(regexp_replace(regexp_replace(t, '[^ -~]', '', 'g'), '\s+', ' ', 'g'), 60) AS s FROM classed),
          c AS (SELECT doc_id, p, '## ' || category || chr(10) || string_agg(s, chr(10) ORDER BY n, s) AS s FROM r GROUP BY doc_id, p, category), m AS (SELECT doc_id, string_agg(s, chr(10) || chr(10) ORDER BY p) AS markdown FROM c GROUP BY doc_id)
        SELECT doc_id, length(markdown) AS chars, sha256(markdown) AS digest FROM m""",
    "page_render": rf"""WITH {_L}, m AS (SELECT doc_id, coalesce(max(CASE WHEN n = 1 THEN line END), '') AS a, coalesce(max(CASE WHEN n = 2 THEN line END), '') AS b FROM l GROUP BY doc_id), t AS (SELECT *, regexp_replace('4.2 ' || regexp_replace(left(a, 30), '["\\]', '', 'g'), '^\s+|\s+$', '', 'g') AS name FROM m),
          u AS (SELECT *, regexp_replace(name, '^\s*\d+(?:\.\d+)*\s+', '') AS title FROM t)
        SELECT 'c-' || doc_id AS slug, '"' || title || '"' AS title, least(0.95, coalesce(nullif(doc_id % 12 / 10, 0), 0.5))::DOUBLE AS confidence, chr(10) || '# ' || title || chr(10) || chr(10) || '## Alpha' || chr(10) || chr(10) || a || chr(10) || chr(10) || '## Beta' || chr(10) || chr(10) || b AS body FROM u""",
    "evidence_lists": rf"""WITH {_L}, c AS (SELECT DISTINCT 'u' || doc_id AS u, 'd-ch01-' || (doc_id * 7 % 300 + n + 1000) AS id FROM l), k AS (SELECT id, string_agg(u, ', ' ORDER BY u) AS us FROM c GROUP BY id),
          o AS (SELECT l_orderkey::VARCHAR AS slug, 'd-ch01-' || (l_partkey + 1000) AS id, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY min(struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey))) AS pos FROM lineitem GROUP BY l_orderkey, l_partkey),
          r AS (SELECT slug, pos, pos || '. `^' || id || '` — unit(s): ' || coalesce(us, 'unknown unit') || chr(10) || '   - ![[' || coalesce(p_brand, 'raw/d') || '#^' || id || ']]' AS s FROM o LEFT JOIN k USING (id) LEFT JOIN part ON p_partkey = l_partkey AND p_size < 10)
        SELECT slug, sha256('## Evidence index' || chr(10) || chr(10) || string_agg(s, chr(10) ORDER BY pos)) AS digest FROM r GROUP BY slug""",
    "filled_sections": rf"""WITH {_L}, r AS (SELECT *, 'd-ch01-' || (n + 1000) AS id, regexp_replace(line, '^\s+|\s+$', '', 'g') AS t FROM l WHERE n <= 6),
          b AS (SELECT doc_id, source, n, regexp_replace(regexp_replace(line, '\^', '', 'g') || CASE WHEN (doc_id + n) % 3 = 0 THEN ' ^' || id ELSE '' END, '^\s+|\s+$', '', 'g') AS body, (doc_id + n) % 3 = 0 AS cites FROM r WHERE n <= 2),
          e AS (SELECT doc_id, string_agg('- ![[raw/' || source || '#^' || id || ']]', chr(10) ORDER BY n) FILTER (n <= 2) AS two FROM r GROUP BY doc_id),
          f AS (SELECT b.doc_id, source, b.n, cites, CASE WHEN cites THEN body ELSE body || chr(10) || chr(10) || 'Evidence anchors:' || chr(10) || two END AS body FROM b JOIN e USING (doc_id)),
          c AS (SELECT f.doc_id, f.n, string_agg('- ![[raw/' || r.source || '#^' || id || ']] — ' || CASE WHEN t = '' THEN id ELSE t END, chr(10) ORDER BY r.n) AS rest FROM f JOIN r ON r.doc_id = f.doc_id AND NOT CASE WHEN f.cites THEN r.n = f.n ELSE r.n <= 2 END WHERE f.n = 1 GROUP BY ALL),
          g AS (SELECT f.doc_id, f.n, cites, '## ' || CASE WHEN f.n = 1 THEN 'Relations' ELSE 'Definitions' END || chr(10) || chr(10) || body || CASE WHEN rest IS NOT NULL THEN chr(10) || chr(10) || 'Unit evidence corpus:' || chr(10) || rest ELSE '' END AS s FROM f LEFT JOIN c ON c.doc_id = f.doc_id AND c.n = f.n)
        SELECT doc_id, 0::BIGINT AS uncited, sha256(string_agg(s, chr(10) || chr(10) ORDER BY n DESC)) AS digest FROM g GROUP BY doc_id""",
    "inferred_notes": rf"""WITH {_L} SELECT 'c-' || doc_id AS slug, n AS ord, sha256('⚠ **Inferred claim:** ' || line || ' (interpretation of ![[' || CASE WHEN doc_id % 2 = 0 THEN 'raw/' || doc_id ELSE source END || '#^' || doc_id || '-' || n || ']])') AS digest FROM l WHERE trim(line) <> '' AND n % 3 = 1 AND n % 6 <> 4""",
    "foreign_predicates": rf"""WITH {_L}, p AS (SELECT doc_id, ['extracted_from', 'made_of', 'defined_by', 'kind_of'][n % 4 + 1] AS predicate FROM l WHERE n % 5 = 0) SELECT predicate, count(*) AS edges, count(DISTINCT doc_id) AS files FROM p WHERE predicate IN ('made_of', 'kind_of') GROUP BY 1""",
    "region_images": rf"""WITH {_L}, r AS (SELECT doc_id, n, n % 5 AS k, n % 20 AS i, regexp_replace(line, '[Hh]ttps?', '', 'g') AS said FROM l), u AS (SELECT *, 'https://a.org/img' || i || '.png' AS url, CASE WHEN i < 10 THEN 'imgs/' || i || '.png' ELSE 'https://a.org/img' || i || '.png' END AS local FROM r)
        SELECT doc_id, n, k < 4 AS is_image, sha256(CASE k WHEN 0 THEN '' WHEN 1 THEN said || ' see ' || local || ', ok' ELSE said END) AS digest, CASE WHEN k < 4 THEN local END AS image_path, CASE WHEN k < 4 THEN url END AS source_url FROM u""",
    "json_images": rf"""WITH {_L} SELECT doc_id, n, CASE WHEN n % 13 <> 0 AND n % 3 = 0 THEN 'https://a.org/img' || n % 20 || '.png' ELSE '' END AS urls, n % 13 <> 0 AND n % 3 < 2 AS has_images FROM l""",
}
