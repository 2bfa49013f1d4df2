"""Queries on layouts, tables, extractions and texts of pages, all made of the tables' rows, with their SQL.

The SQL works on the rows themselves and never sees the JSON, HTML or Markdown that the queries make of them.
The literal inputs at the top serve the tests.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import images, ocr, pages, tables, validate

TABLE = "<table><tr><th>a</th><th colspan='2'>b|c</th></tr><tr><td rowspan=2>1</td><td>2</td><td>3</td></tr><tr><td>4</td><td>5<br>6</td></tr><tr><td></td></tr></table>"


def _region(index: int, label: str, content: str, **more) -> dict:
    return {"index": index, "label": label, "content": content, "bbox_2d": [1, 2, 3.7, 4], **more}


LAYOUTS = [
    ("plain", [[_region(1, "text", "Second"), _region(0, "text", "A Title", native_label="doc_title")], [_region(0, "formula", "x^2"), _region(1, "table", TABLE)]]),
    ("flat", [_region(0, "text", "import os\nprint(1)\nfor x in y: pass  # long enough to count as code"), _region(1, "text", "7", native_label="page_number")]),
    ("wrapped", {"result": {"layout_details": [[_region(0, "image", "", image_path="imgs/a.png"), _region(1, "image", "", native_label="chart")]]}}),
    ("chunked", {"chunks": [{"start_page": 3, "result": {"layout_details": [[_region(0, "text", "Later")]]}}, {"start_page": 1, "result": {"layout_details": [[_region(0, "text", "Earlier")]]}}]}),
]

_CLAIM = {"text": "A claim of some length", "block_id": "demo-ch01-0001", "confidence_marker": "tentative", "confidence": "EXTRACTED", "quote_verbatim": "of some"}
_CONCEPT = {"slug": "a-concept", "name": "A concept", "definitions": [{"chapter": 1, "chapter_title": "One", "definition": "A definition that is long enough", "block_id": "demo-ch01-0001"}], "block_ids": ["demo-ch01-0002"]}
_GOOD = {"source": "demo", "chapter": 1, "chapter_title": "One", "extracted_at": "2024", "concepts": [_CONCEPT], "claims": [_CLAIM]}
EXTRACTIONS = [
    ("good", _GOOD),
    ("no quote", _GOOD | {"claims": [_CLAIM | {"quote_verbatim": " "}]}),
    ("inferred", _GOOD | {"claims": [_CLAIM | {"confidence": "INFERRED", "quote_verbatim": ""}]}),
    ("short", _GOOD | {"concepts": [_CONCEPT | {"definitions": [_CONCEPT["definitions"][0] | {"definition": "short"}]}]}),
    ("empty definitions", _GOOD | {"concepts": [_CONCEPT | {"definitions": []}]}),
    ("omitted definitions", _GOOD | {"concepts": [{k: v for k, v in _CONCEPT.items() if k != "definitions"}]}),
    ("absent", _GOOD | {"concepts": [], "no_lane_content": True}),
    ("nothing", _GOOD | {"concepts": []}),
    ("text chapter", _GOOD | {"chapter": "3"}),
    ("bad bounds", _GOOD | {"chapter": 0, "concepts": [_CONCEPT | {"confidence": 1.5, "slug": "No"}]}),
]


def literal(spark: SparkSession, rows: list, key: str) -> DataFrame:
    """``rows`` of (key, JSON value or text) as a table of key and json."""
    return spark.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, v in rows], f"{key} string, json string")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return docs.select("doc_id", "source", F.posexplode(text.lines("text")).alias("p", "line"))


def html_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order as an HTML table: its key beside all its lines, flag and status over two columns."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    row = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.concat_ws("|", "l_returnflag", "l_linestatus").alias("s"))
    orders = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    key = F.concat(F.lit("<td rowspan='"), F.size("rows"), F.lit("'>"), "l_orderkey", F.lit("</td>"))
    cells = F.transform("rows", lambda r, i: F.concat(F.lit("<tr>"), F.when(i == 0, key).otherwise(""), F.lit("<td>"), r["l_linenumber"], F.lit("<br>"), r["l_partkey"], F.lit("</td><th colspan=2> "), r["s"], F.lit("</th></tr>")))
    content = F.concat(F.lit("<table><tr><td></td></tr>"), F.array_join(cells, "\n"), F.lit("</table>"))
    return tables.table_column(orders.select("l_orderkey", content.alias("content"))).select("l_orderkey", "md")


#: Lines to a page of the layouts that are made of documents.
PAGE = 10


def _layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as layouts in JSON: a region a line, labels by its place, regions of a page in falling order."""
    lines = _lines(spark, sf_dir).withColumn("k", F.col("p") % 6)
    label = F.when(F.col("k") == 1, "formula").when(F.col("k") == 2, "image").otherwise("text")
    native = F.when(F.col("k") == 0, "paragraph_title").when(F.col("k") == 3, "page_number").otherwise(label)
    path = F.when((F.col("k") == 2) & (F.col("p") % 4 == 0), F.concat(F.lit("imgs/"), "p", F.lit(".png")))
    box = F.array(F.lit(1.5), F.col("p") + 0.7)
    region = F.struct((F.col("p") % PAGE).alias("index"), label.alias("label"), native.alias("native_label"), F.col("line").alias("content"), box.alias("bbox_2d"), path.alias("image_path"))
    page = lines.groupBy("doc_id", F.floor(F.col("p") / PAGE).alias("page")).agg(F.sort_array(F.collect_list(region), False).alias("regions"))
    whole = page.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "regions"))).alias("pages"))
    details = F.to_json(F.struct(F.transform("pages", lambda x: x["regions"]).alias("layout_details")))
    wrapped = F.when(F.col("doc_id") % 2 == 0, details).otherwise(F.concat(F.lit('{"result": '), details, F.lit("}")))
    return whole.select(F.col("doc_id").cast("string").alias("slug"), wrapped.alias("json"))


def ocr_reconstruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ocr.rebuild(ocr.render_regions(ocr.layout_regions(_layouts(spark, sf_dir))))


def ocr_fidelity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ocr.fidelity(ocr.render_regions(ocr.layout_regions(_layouts(spark, sf_dir))))
    return found.select("slug", "total", "skipped", "accounted", F.round("fidelity", 6).alias("fidelity"), "status")


def artifact_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as results of readings: paths by number, validity by quality; the best one of each group of 20."""
    docs = _documents(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"), "doc_id", "left")
    slug = F.concat(F.lit("s"), F.floor(F.col("doc_id") / 20))
    name = F.element_at(F.array(F.lit("combined.json"), F.concat(slug, F.lit(".json")), F.lit("Layout.JSON"), F.lit("a_model.json"), F.lit("my-combined.json")), (F.col("doc_id") % 5 + 1).cast("int"))
    folder = F.element_at(F.array(F.lit("glmocr_output"), F.lit("glmocr_output/x"), slug, F.lit("old/ocr_outputs")), (F.col("doc_id") % 4 + 1).cast("int"))
    body = F.when(F.coalesce(F.col("quality"), F.lit(1)) == 1, F.to_json(F.struct(F.lit(True).alias("ok"), F.concat(F.lit("x"), "text").alias("text")))).otherwise(F.lit('{"ok": false}'))
    made = docs.select(slug.alias("slug"), F.concat_ws("/", F.col("doc_id").cast("string"), folder, name).alias("path"), body.alias("json"), (F.col("doc_id") % 3 == 0).alias("has_images"))
    valid = ocr.artifact_validity(made).join(made.select("path", "has_images"), "path")
    return ocr.best_artifact(valid).select("slug", "path", F.col("score").cast("long").alias("score"))


def _extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as extractions in JSON: lengths, chapters and ids by number, some out of bounds."""
    d = F.col("doc_id")
    block = F.concat("source", F.lit("-ch01-"), d)
    bad_block = F.when(d % 13 == 0, F.lit("No-ch1")).otherwise(block)
    formula = F.struct(F.lit("f").alias("name"), F.left(F.lit("x=y+z"), (d % 6).cast("int")).alias("expression"), block.alias("block_id"))
    definition = F.struct(F.lit(1).alias("chapter"), F.left("text", (d % 20).cast("int")).alias("definition"), bad_block.alias("block_id"))
    concept = F.struct(F.concat(F.when(d % 17 == 0, "C ").otherwise("c-"), d).alias("slug"), F.left(F.lit("name"), (d % 5).cast("int")).alias("name"), F.array(definition).alias("definitions"), F.array(block, F.concat(block, F.lit("0"))).alias("block_ids"), (d % 12 / 10).alias("confidence"))
    claim = F.struct(F.left("text", (d % 25).cast("int")).alias("text"), block.alias("block_id"), F.when(d % 9 == 0, "sure").otherwise("tentative").alias("confidence_marker"), F.when(d % 4 == 0, "EXTRACTED").otherwise("INFERRED").alias("confidence"), F.when(d % 8 == 0, " ").otherwise("q").alias("quote_verbatim"))
    whole = F.struct(
        F.when(d % 7 == 0, "X").otherwise(F.col("source")).alias("source"), (d % 5).alias("chapter"), F.left(F.lit("Title"), (d % 6).cast("int")).alias("chapter_title"), F.when(d % 11 != 0, "2024").alias("extracted_at"),
        F.when(d % 3 == 0, F.array().cast("array<string>").cast("string")).alias("nothing"), (d % 6 == 0).alias("no_lane_content"), F.when(d % 3 != 0, F.array(concept)).alias("concepts"), F.array(claim).alias("claims"), F.array(formula).alias("formulas"),
    )
    body = F.when(d % 19 == 0, "{").otherwise(F.to_json(whole.dropFields("nothing")))
    return _documents(spark, sf_dir).select(d.cast("string").alias("file"), F.col("source").alias("slug"), body.alias("json"))


def schema_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.schema_issues(validate.read_extractions(_extractions(spark, sf_dir)))


def slug_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block ids against the next source's slug for every tenth document's file, and definitions of less than 15 characters."""
    files = _extractions(spark, sf_dir).filter("json <> '{'").withColumn("slug", F.when(F.col("file").endswith("0"), F.concat("slug", F.lit("x"))).otherwise(F.col("slug")))
    return validate.scoped_issues(validate.read_extractions(files), 15)


def typed_block_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.block_ids(validate.read_extractions(_extractions(spark, sf_dir))).distinct()


def recursive_block_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extractions, each inside as many lists and objects as its number says, beside notes whose own ids, under the same keys, no schema knows; a text that looks like a key is none."""
    files = _extractions(spark, sf_dir)
    own = F.concat(F.lit("note-ch02-"), "file")
    note = F.to_json(F.struct(F.lit('an "block_id":"x" in words').alias("said"), F.struct(F.array(own, F.concat(own, F.lit("1"))).alias("block_ids"), F.when(F.length("file") % 2 == 0, F.concat(own, F.lit("2"))).alias("block_id")).alias("more")))
    n = F.col("file").cast("int") % 30
    deep = F.concat(F.repeat(F.lit('[{"a": '), n), F.lit('[{"b": '), "json", F.lit("}, "), note, F.lit("]"), F.repeat(F.lit("}, 1]"), n))
    return validate.recursive_block_ids(files.select("file", deep.alias("json"))).distinct()


def _sectioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with every third line as a heading of one of four names."""
    rows = F.transform(text.lines("text"), lambda x, i: F.when(i % 3 == 0, F.concat(F.lit("## H"), i % 4, F.lit(" "))).otherwise(x))
    return _documents(spark, sf_dir).select("doc_id", F.array_join(rows, "\n").alias("text"))


def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.sections(_sectioned(spark, sf_dir), ["doc_id"]).select("doc_id", "header", F.col("pos").cast("long").alias("pos"), "body")


def page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as drafts of pages, each short of something by its number; their lines are what they quote."""
    d = F.col("doc_id")
    front = F.concat(F.lit("---\n"), F.when(d % 4 == 0, "created: x\ntitle: x\n").otherwise("title: x\ncreated: x\n"), *(F.lit(f"{k}: x\n") for k in pages.KEYS[2:]), F.lit("---\n"))
    quotes = F.array_join(F.transform(text.lines(F.coalesce("text", F.lit(""))), lambda x: F.concat(F.lit("> "), x)), "\n")
    embed = F.concat(F.lit("![[c#^demo-ch01-"), d + 1000, F.lit("]]\n"))
    tail = F.concat(F.when(d % 3 != 0, "- extracted_from::[[c]]\n").otherwise(""), F.when(d % 6 == 0, "- derived_from::[[c]]\n").otherwise(""), F.when(d % 5 == 0, "see ^other-ch01-0001\n").otherwise(""), F.when(d % 7 != 0, "## Relations\n").otherwise(""))
    body = F.concat(front, F.lit("## Author's Words\n"), quotes, F.lit("\n## Rest\n"), F.repeat(embed, (d % 4).cast("int")), tail, F.repeat(F.lit("text\n"), (d % 90).cast("int")))
    made = _documents(spark, sf_dir).select(d.cast("string").alias("page"), body.alias("text"))
    return pages.page_issues(made, "demo", ["Author's Words", "Relations"])


def image_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that show an image of their own, one beside all of a language, and one elsewhere; labelled documents have theirs, empty if bad."""
    d, labels = F.col("doc_id"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    shown = F.concat(F.lit("![a](imgs/"), d, F.lit('.png "t") ![b]("../'), "lang", F.lit(".png#x\") ![c](https://x.org/"), d, F.lit(".png)"))
    files = _documents(spark, sf_dir).select(F.concat(F.lit("d/"), d, F.lit(".md")).alias("file"), shown.alias("text"))
    listing = labels.select(F.concat(F.lit("d/imgs/"), "doc_id", F.lit(".png")).alias("path"), F.col("quality").cast("long").alias("length")).union(labels.limit(0).select(F.lit("x"), F.lit(1).cast("long")))
    return images.verify(images.image_refs(files), listing)


QUERIES = {f.__name__: f for f in (html_table, ocr_reconstruct, ocr_fidelity, artifact_choice, schema_validate, slug_scope, typed_block_ids, recursive_block_ids, section_split, page_gate, image_check)}

_LINES = """lines AS (
  SELECT doc_id, source, unnest(l) AS line, unnest(range(len(l))) AS p FROM (SELECT doc_id, source, CASE WHEN a[-1] = '' THEN a[:-2] ELSE a END AS l FROM (SELECT doc_id, source, string_split(text, chr(10)) AS a FROM documents))
)"""
_TRIM = lambda c: rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
# a line that reads like code: a fence, a prompt, or two signs of code in over fifty characters
_CODE = r"""(contains(line, '```') OR regexp_matches(line, '^(>>>|\.\.\.) ') OR (length(line) > 50 AND
  regexp_matches(line, '^import [\p{L}\p{N}_]')::INT + regexp_matches(line, '^from [\p{L}\p{N}_]+ import')::INT + regexp_matches(line, '^def [\p{L}\p{N}_]+\(')::INT + regexp_matches(line, '^\s*class [\p{L}\p{N}_]+')::INT
  + regexp_matches(line, '^\s*for [\p{L}\p{N}_]+ in')::INT + regexp_matches(line, '^\s*if __name__')::INT + regexp_matches(line, 'return [\p{L}\p{N}_]')::INT + regexp_matches(line, 'print\(')::INT
  + regexp_matches(line, 'np\.')::INT + regexp_matches(line, 'pd\.')::INT + regexp_matches(line, 'plt\.')::INT >= 2))"""
_REGIONS = rf"""{_LINES}, regions AS (
  SELECT doc_id, p, p // 10 AS page, p % 10 AS i, p % 6 AS k, line, {_TRIM('line')} AS t FROM lines
), shown AS (
  SELECT *, CASE WHEN k = 3 THEN 'skipped' WHEN k = 2 THEN 'image' WHEN t = '' THEN CASE WHEN k = 0 THEN 'lost' ELSE 'skipped' END WHEN k = 0 THEN 'header' WHEN k = 1 THEN 'formula' WHEN {_CODE} THEN 'code' ELSE 'text' END AS kind FROM regions
), rendered AS (
  SELECT *, chr(10) || '<!-- block:' || CASE k WHEN 1 THEN 'formula' WHEN 2 THEN 'image' ELSE 'text' END || ':' || page || ':1,' || p || ':' || CASE k WHEN 0 THEN 'paragraph_title' WHEN 1 THEN 'formula' WHEN 2 THEN 'image' ELSE 'text' END || ' -->' || chr(10)
    || CASE kind WHEN 'header' THEN '## ' || regexp_replace(t, '^#+\s*', '')
       WHEN 'formula' THEN CASE WHEN starts_with(t, '$$') AND ends_with(t, '$$') THEN t WHEN starts_with(t, '\[') AND ends_with(t, '\]') THEN '$$' || t[3:-3] || '$$' ELSE '$$' || chr(10) || t || chr(10) || '$$' END
       WHEN 'image' THEN CASE WHEN p % 4 = 0 THEN '![Image](imgs/' || p || '.png)' ELSE 'MISSING' END
       WHEN 'code' THEN CASE WHEN contains(line, '```') THEN line ELSE '```python' || chr(10) || line || chr(10) || '```' END ELSE t END
    || chr(10) || '<!-- /block -->' AS r FROM shown WHERE kind NOT IN ('skipped', 'lost')
)"""
_MADE = """ex AS (
  SELECT doc_id::VARCHAR AS file, doc_id AS d, source, coalesce(text, '') AS text, source || '-ch01-' || doc_id AS block, doc_id % 19 <> 0 AS sound, doc_id % 3 <> 0 AS has FROM documents
)"""

ORACLES = {
    "html_table": r"""WITH l AS (SELECT *, row_number() OVER w AS k, count(*) OVER (PARTITION BY l_orderkey) AS n, l_linenumber || ' ' || l_partkey AS a, l_returnflag || '\|' || l_linestatus AS b FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)),
        z AS (SELECT l_orderkey, greatest(3, length(l_orderkey::VARCHAR)) AS x, greatest(3, max(length(a))) AS y, greatest(3, max(length(b))) AS w FROM l GROUP BY l_orderkey),
        r AS (SELECT l_orderkey, k, '| ' || rpad(CASE WHEN k = 1 THEN l_orderkey::VARCHAR ELSE '' END, x::INT, ' ') || ' | ' || rpad(a, y::INT, ' ') || ' | ' || rpad(b, w::INT, ' ') || ' |     |' AS s,
          '| ' || repeat('-', x) || ' | ' || repeat('-', y) || ' | ' || repeat('-', w) || ' | --- |' AS rule FROM l JOIN z USING (l_orderkey))
        SELECT l_orderkey, string_agg(CASE WHEN k = 1 THEN s || chr(10) || rule ELSE s END, chr(10) ORDER BY k) AS md FROM r GROUP BY l_orderkey""",
    "ocr_reconstruct": rf"WITH {_REGIONS} SELECT doc_id::VARCHAR AS slug, string_agg(replace(r, 'MISSING', '<!-- MISSING_IMAGE: page ' || page || ', index ' || i || ' -->'), chr(10) ORDER BY page, i) AS markdown FROM rendered GROUP BY doc_id",
    "ocr_fidelity": rf"""WITH {_REGIONS}, n AS (SELECT doc_id::VARCHAR AS slug, count(*) AS total, count(*) FILTER (kind = 'skipped') AS skipped, count(*) FILTER (kind NOT IN ('skipped', 'lost')) AS accounted FROM shown GROUP BY doc_id)
        SELECT *, round(accounted / greatest(1, total - skipped), 6) AS fidelity, CASE WHEN accounted / greatest(1, total - skipped) >= 0.95 THEN 'PASS' ELSE 'FAIL' END AS status FROM n""",
    "artifact_choice": """WITH c AS (SELECT d.doc_id AS i, 's' || d.doc_id // 20 AS slug, coalesce(quality, 1) = 1 AS valid FROM documents d LEFT JOIN labels USING (doc_id)),
        f AS (SELECT *, [100, 100, 0, 0][i % 4 + 1] + CASE WHEN i % 4 = 2 THEN 10 ELSE 0 END + [80, 70, 0, 20, 0][i % 5 + 1] + CASE WHEN i % 3 = 0 THEN 5 ELSE 0 END AS score,
          i || '/' || ['glmocr_output', 'glmocr_output/x', slug, 'old/ocr_outputs'][i % 4 + 1] || '/' || ['combined.json', slug || '.json', 'Layout.JSON', 'a_model.json', 'my-combined.json'][i % 5 + 1] AS path FROM c WHERE valid AND i % 5 <> 2)
        SELECT slug, path, score::BIGINT AS score FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY score DESC, len(string_split(path, '/')), path) AS k FROM f) WHERE k = 1""",
    "schema_validate": rf"""WITH {_MADE} SELECT file, unnest([x FOR x IN CASE WHEN NOT sound THEN ['invalid JSON'] ELSE [
          CASE WHEN d % 7 = 0 THEN 'source malformed' END, CASE WHEN d % 5 < 1 THEN 'chapter missing or below 1' END, CASE WHEN d % 6 < 3 THEN 'chapter_title too short' END, CASE WHEN d % 11 = 0 THEN 'extracted_at missing' END,
          CASE WHEN NOT has AND d % 6 <> 0 THEN 'no concepts and no declared absence' END, CASE WHEN has AND d % 17 = 0 THEN 'concepts[0]: slug malformed' END, CASE WHEN has AND d % 5 < 3 THEN 'concepts[0]: name too short' END,
          CASE WHEN has AND d % 12 > 10 THEN 'concepts[0]: confidence out of bounds' END, CASE WHEN has AND least(length(text), d % 20) < 10 THEN 'definitions[0]: definition too short' END, CASE WHEN has AND d % 13 = 0 THEN 'definitions[0]: block_id malformed' END,
          CASE WHEN least(length(text), d % 25) < 10 THEN 'claims[0]: text too short' END, CASE WHEN d % 9 = 0 THEN 'claims[0]: confidence_marker unknown' END, CASE WHEN d % 8 = 0 THEN 'claims[0]: EXTRACTED without quote' END,
          CASE WHEN least(5, d % 6) < 3 THEN 'formulas[0]: expression too short' END] END IF x IS NOT NULL]) AS issue FROM ex""",
    "slug_scope": rf"""WITH {_MADE}, ids AS (SELECT *, list_distinct(CASE WHEN has THEN [block, block || '0', CASE WHEN d % 13 = 0 THEN 'No-ch1' ELSE block END] ELSE [block] END) AS bs FROM ex WHERE sound)
        SELECT file, 'block id not of this slug: ' || b AS issue FROM (SELECT file, d, unnest(bs) AS b FROM ids) WHERE b = 'No-ch1' OR file LIKE '%0'
        UNION ALL SELECT file, 'definition too short: ' || CASE WHEN d % 17 = 0 THEN 'C ' ELSE 'c-' END || d FROM ex WHERE sound AND has AND length({_TRIM('left(text, (d % 20)::INT)')}) < 15""",
    "typed_block_ids": f"WITH {_MADE} SELECT DISTINCT file, unnest(CASE WHEN has THEN [block, block || '0', CASE WHEN d % 13 = 0 THEN 'No-ch1' ELSE block END] ELSE [block] END) AS block_id FROM ex WHERE sound",
    "recursive_block_ids": f"""WITH {_MADE} SELECT DISTINCT file, unnest(list_concat(CASE WHEN has THEN [block, block || '0', CASE WHEN d % 13 = 0 THEN 'No-ch1' ELSE block END] ELSE [block] END,
        list_concat(['note-ch02-' || file, 'note-ch02-' || file || '1'], CASE WHEN length(file) % 2 = 0 THEN ['note-ch02-' || file || '2'] ELSE [] END))) AS block_id FROM ex WHERE sound""",
    "section_split": rf"""WITH {_LINES}, s AS (SELECT *, p // 3 + 1 AS pos FROM lines), b AS (SELECT doc_id, pos, 'H' || ((pos - 1) * 3 % 4) AS header, {_TRIM("coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (p % 3 <> 0), '')")} AS body FROM s GROUP BY doc_id, pos)
        SELECT doc_id, header, min(pos) AS pos, arg_min(body, pos) AS body FROM b GROUP BY doc_id, header""",
    "page_gate": rf"""WITH t AS (SELECT doc_id AS d, coalesce(text, '') AS text, CASE WHEN a[-1] = '' THEN a[:-2] ELSE a END AS l FROM (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
        n AS (SELECT d, text, len(l) AS lines, len([x FOR x IN l IF NOT contains(x, '![[') AND length({_TRIM("'> ' || x")}) >= 20]) AS quotes FROM t)
        SELECT d::VARCHAR AS page, unnest([x FOR x IN [CASE WHEN d % 4 = 0 THEN 'front matter key order' END, CASE WHEN d % 6 = 0 THEN 'forbidden derived_from predicate' END, CASE WHEN d % 3 = 0 THEN 'no provenance' END,
          CASE WHEN 12 + 1 + greatest(lines, 1) + 1 + d % 4 + (d % 3 <> 0)::INT + (d % 6 = 0)::INT + (d % 5 = 0)::INT + (d % 7 <> 0)::INT + d % 90 < 80 THEN 'too few lines' END, CASE WHEN d % 4 < 2 THEN 'too few embeds' END, CASE WHEN quotes < 2 THEN 'too few quotes' END,
          CASE WHEN d % 5 = 0 THEN 'block ids of another slug' END, CASE WHEN regexp_matches(lower(text), {rules.quoted(rules.PLACEHOLDERS.replace('W', f'[^{rules.WORD}]'))}) THEN 'placeholder' END, CASE WHEN d % 7 = 0 THEN 'missing section: Relations' END] IF x IS NOT NULL]) AS issue FROM n""",
    "image_check": """WITH f AS (SELECT 'd/' || d.doc_id || '.md' AS file, d.doc_id AS d, lang, quality FROM documents d LEFT JOIN labels USING (doc_id))
        SELECT file, 'imgs/' || d || '.png' AS ref, 'd/imgs/' || d || '.png' AS resolved, CASE WHEN quality > 0 THEN 'resolved' ELSE 'missing' END AS state FROM f
        UNION ALL SELECT file, '../' || lang || '.png#x', 'd/../' || lang || '.png', 'missing' FROM f UNION ALL SELECT file, 'https://x.org/' || d || '.png', 'd/https://x.org/' || d || '.png', 'remote' FROM f""",
}
