"""Extractions: schema checks as issue rows, and block ids at any depth of ragged JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

BLOCK = r"^[a-z0-9-]+-ch\d+-\d+$"
SLUG = r"^[a-z0-9-]+$"

_DEFINITIONS = "array<struct<chapter:string,chapter_title:string,definition:string,block_id:string>>"
_FORMULA = "struct<name:string,expression:string,block_id:string,context:string>"
_CONCEPT = (
    "struct<slug:string,name:string,definitions:array<struct<chapter:string,chapter_title:string,definition:string,block_id:string>>,"
    f"examples:array<string>,warnings:array<string>,formulas:array<{_FORMULA}>,block_ids:array<string>,cross_references:array<string>,"
    "confidence:double,concepts_per_100_lines:double,chapters:array<int>>"
)
# chapters may be numbers or their texts
SCHEMA = (
    f"source string, chapter string, chapter_title string, extracted_at string, concepts array<{_CONCEPT}>, "
    f"entities array<struct<slug:string,name:string,role:string,mentions:array<string>>>, formulas array<{_FORMULA}>, "
    "claims array<struct<text:string,block_id:string,confidence_marker:string,confidence:string,quote_verbatim:string>>, "
    "no_lane_content boolean, _corrupt_record string"
)


def read_extractions(files: DataFrame) -> DataFrame:
    """``files`` (file, json) with x, the typed extraction; what does not parse keeps x._corrupt_record."""
    return files.withColumn("x", F.from_json("json", SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))


def _short(c: Column, n: int) -> Column:
    return F.coalesce(F.length(c) < n, F.lit(True))


def _unlike(c: Column, pattern: str) -> Column:
    return ~F.coalesce(c.rlike(pattern), F.lit(False))


def _each(c: str | Column, where: str, *checks) -> Column:
    """Messages of the checks (condition on an element, message) over an array, with the element's place."""
    c = F.col(c) if isinstance(c, str) else c
    made = F.transform(c, lambda e, i: F.array_compact(F.array(*(F.when(bad(e), F.concat(F.lit(f"{where}["), i, F.lit(f"]: {what}"))) for bad, what in checks))))
    return F.coalesce(F.flatten(made), F.array().cast("array<string>"))


def _formula_checks():
    return ((lambda e: e["name"].isNull(), "name missing"), (lambda e: _short(e["expression"], 3), "expression too short"), (lambda e: _unlike(e["block_id"], BLOCK), "block_id malformed"))


def schema_issues(extractions: DataFrame) -> DataFrame:
    """file and issue of each breach; ``extractions`` has file and x."""
    x = F.col("x")
    top = F.array_compact(
        F.array(
            F.when(x["_corrupt_record"].isNotNull() | x.isNull(), "invalid JSON"),
            F.when(_short(x["source"], 3) | _unlike(x["source"], SLUG), "source malformed"),
            F.when(F.coalesce(x["chapter"].try_cast("int") < 1, F.lit(True)), "chapter missing or below 1"),
            F.when(_short(x["chapter_title"], 3), "chapter_title too short"),
            F.when(x["extracted_at"].isNull(), "extracted_at missing"),
            F.when((F.coalesce(F.size(x["concepts"]), F.lit(0)) <= 0) & ~F.coalesce(x["no_lane_content"], F.lit(False)), "no concepts and no declared absence"),
        )
    )
    concepts = _each(
        x["concepts"],
        "concepts",
        (lambda e: _short(e["slug"], 3) | _unlike(e["slug"], SLUG), "slug malformed"),
        (lambda e: _short(e["name"], 3), "name too short"),
        (lambda e: F.coalesce(F.size(e["definitions"]) == 0, F.lit(False)), "definitions explicitly empty"),
        (lambda e: F.coalesce((e["confidence"] < 0) | (e["confidence"] > 1), F.lit(False)), "confidence out of bounds"),
        (lambda e: F.coalesce(e["concepts_per_100_lines"] < 0, F.lit(False)), "density negative"),
    )
    inner = F.flatten(F.transform(F.coalesce(x["concepts"], F.array().cast(f"array<{_CONCEPT}>")), lambda e: F.coalesce(e["definitions"], F.array().cast(_DEFINITIONS))))
    definitions = _each(inner, "definitions", (lambda e: _short(e["definition"], 10), "definition too short"), (lambda e: e["chapter"].try_cast("int").isNull(), "chapter missing"), (lambda e: _unlike(e["block_id"], BLOCK), "block_id malformed"))
    claims = _each(
        x["claims"],
        "claims",
        (lambda e: _short(e["text"], 10), "text too short"),
        (lambda e: _unlike(e["block_id"], BLOCK), "block_id malformed"),
        (lambda e: _unlike(e["confidence_marker"], "^(authoritative|tentative|opinion)$"), "confidence_marker unknown"),
        (lambda e: _unlike(e["confidence"], "^(EXTRACTED|INFERRED|AMBIGUOUS)$"), "confidence unknown"),
        (lambda e: F.coalesce((e["confidence"] == "EXTRACTED") & (F.coalesce(text.strip(e["quote_verbatim"]), F.lit("")) == ""), F.lit(False)), "EXTRACTED without quote"),
    )
    entities = _each(x["entities"], "entities", (lambda e: _unlike(e["slug"], SLUG), "slug malformed"), (lambda e: e["name"].isNull() | e["role"].isNull(), "name or role missing"))
    formulas = _each(x["formulas"], "formulas", *_formula_checks())
    every = F.when(x["_corrupt_record"].isNotNull() | x.isNull(), F.array(F.lit("invalid JSON"))).otherwise(F.concat(top, concepts, definitions, claims, entities, formulas))
    return extractions.select("file", F.explode(every).alias("issue"))


def block_ids(extractions: DataFrame) -> DataFrame:
    """file and block_id of each reference in the typed places."""
    return extractions.select("file", F.explode(_typed_ids(F.col("x"))).alias("block_id")).filter("block_id is not null")


def _typed_ids(x: Column) -> Column:
    none = F.array().cast("array<string>")
    ids = lambda c: F.coalesce(F.transform(c, lambda e: e["block_id"]), none)
    concept = F.flatten(F.transform(x["concepts"], lambda e: F.concat(F.coalesce(e["block_ids"], none), ids(e["definitions"]), ids(e["formulas"]))))
    return F.concat(F.coalesce(concept, none), ids(x["formulas"]), ids(x["claims"]))


def recursive_block_ids(files: DataFrame) -> DataFrame:
    """file and block_id: every value of block_id and member of block_ids at any depth of ragged JSON (file, json).

    The JSON is written anew in its plain form, in which a key is what stands between an unescaped quote and
    a quote and a colon; quotes inside of strings are all escaped, so that no string looks like a key.
    """
    plain = F.to_json(F.try_parse_json("json"))
    string = r'"(?:[^"\\]++|\\.)*+"'
    one = F.regexp_extract_all(plain, F.lit(rf'"block_id":({string}|[^,\[\]{{}}"]++)'), 1)
    many = F.regexp_extract_all(plain, F.lit(rf'"block_ids":\[((?:{string}|[^\[\]{{}}"])*+)\]'), 1)
    # the captured values are JSON themselves
    values = F.from_json(F.concat(F.lit("["), F.array_join(F.filter(F.concat(one, many), lambda x: x != ""), ","), F.lit("]")), "array<string>")
    return files.select("file", F.explode(values).alias("block_id")).filter("block_id is not null")


#: Least characters of a definition in a batch that is to be published.
DEFINITION = 30


def scoped_issues(extractions: DataFrame, least: int = DEFINITION) -> DataFrame:
    """file and issue: block ids that are not of the file's slug, and definitions that are too short to be of this book.

    ``extractions`` has file, slug and x.
    """
    x = F.col("x")
    none = F.array().cast("array<string>")
    ids = F.array_distinct(F.coalesce(_typed_ids(x), none))
    own = F.concat(F.lit("^"), F.regexp_replace("slug", r"([.^$*+?()\[{\\|])", r"\\$1"), F.lit(r"-ch\d+-\d+$"))
    wrong = F.transform(F.filter(ids, lambda i: ~F.rlike(i, own)), lambda i: F.concat(F.lit("block id not of this slug: "), i))
    concepts = F.coalesce(x["concepts"], F.array().cast(f"array<{_CONCEPT}>"))
    short = F.flatten(F.transform(concepts, lambda c: F.transform(F.filter(F.coalesce(c["definitions"], F.array().cast(_DEFINITIONS)), lambda d: _short(text.strip(d["definition"]), least)), lambda d: F.concat(F.lit("definition too short: "), F.coalesce(c["slug"], F.lit("?"))))))
    return extractions.select("file", F.explode(F.concat(wrong, short)).alias("issue"))


def lane_schema_issues(outputs: DataFrame, index: DataFrame) -> DataFrame:
    """unit_id, lane and issue of lane outputs: absent or empty, other source or chapter, schema, citations out of scope, lost quotes.

    ``outputs`` has slug, unit_id, chapter_num, lane and json (null where there is no file); ``index`` has slug,
    unit_id, block_id and text, the blocks that each unit may cite.
    """
    key = ["slug", "unit_id", "lane"]
    named = outputs.withColumn("file", F.concat_ws("\x1f", *key))
    x = F.col("x")
    read = read_extractions(named.filter("json <> ''").select("file", *key, "chapter_num", "json"))
    broken = x.isNull() | x["_corrupt_record"].isNotNull()
    head = F.array_compact(
        F.array(
            F.when(~broken & ~x["source"].eqNullSafe(F.col("slug")), F.concat(F.lit("source mismatch: "), F.coalesce(x["source"], F.lit("none")))),
            F.when(~broken & ~x["chapter"].try_cast("int").eqNullSafe(F.col("chapter_num").cast("int")), F.concat(F.lit("chapter mismatch: "), F.coalesce(x["chapter"], F.lit("none")))),
        )
    )
    absent = outputs.select("unit_id", "lane", F.when(F.col("json").isNull(), "missing schema output").when(F.col("json") == "", "empty schema output").alias("issue")).filter("issue is not null")
    whose = lambda df: df.join(named.select("file", "unit_id", "lane"), "file").select("unit_id", "lane", "issue")
    cited = recursive_block_ids(named.select("file", "json"))
    none_cited = read.filter(~broken & ~F.coalesce(x["no_lane_content"], F.lit(False))).join(cited, "file", "left_anti").select("file", F.lit("no block ids cited").alias("issue"))
    scope = cited.distinct().join(named.select("file", *key), "file")
    wrong = scope.filter(~F.startswith("block_id", F.concat("slug", F.lit("-")))).select("unit_id", "lane", F.concat(F.lit("wrong slug: "), "block_id").alias("issue"))
    known = index.select("slug", "unit_id", "block_id").distinct()
    outside = scope.filter(F.startswith("block_id", F.concat("slug", F.lit("-")))).join(known, ["slug", "unit_id", "block_id"], "left_anti").select("unit_id", "lane", F.concat(F.lit("outside the unit's index: "), "block_id").alias("issue"))
    out = absent.union(read.select("unit_id", "lane", F.explode(head).alias("issue"))).union(whose(schema_issues(read))).union(whose(scoped_issues(read))).union(whose(none_cited)).union(wrong).union(outside)
    return out.distinct()


def report_issues(reports: DataFrame, tasks: DataFrame) -> DataFrame:
    """unit_id, lane and issue of dispatch reports (unit_id, lane, job_id, runtime_task_id, runtime): missing and extra pairs, empty fields."""
    need = ("job_id", "runtime_task_id", "runtime")
    e, r = tasks.select("unit_id", "lane").distinct(), reports.select("unit_id", "lane").distinct()
    missing = e.join(r, ["unit_id", "lane"], "left_anti").select("unit_id", "lane", F.lit("missing").alias("issue"))
    extra = r.join(e, ["unit_id", "lane"], "left_anti").select("unit_id", "lane", F.lit("extra").alias("issue"))
    empty = F.array_compact(F.array(*(F.when(F.coalesce(text.strip(c), F.lit("")) == "", F.lit(f"no {c}")) for c in need)))
    return missing.union(extra).union(reports.select("unit_id", "lane", F.explode(empty).alias("issue")))


def markdown_issues(outputs: DataFrame, lanes: DataFrame) -> DataFrame:
    """unit_id, lane and issue of lane texts; ``outputs`` has unit_id, lane and text, ``lanes`` has lane and required_sections."""
    df = outputs.join(F.broadcast(lanes.select("lane", "required_sections")), "lane", "left").withColumn("found", text.sections(F.coalesce("text", F.lit(""))))
    lost = F.transform(F.array_except("required_sections", "found"), lambda s: F.concat(F.lit("missing section: "), s))
    extra = F.transform(F.when(F.col("lane") == "math", F.array_except("found", "required_sections")).otherwise(F.array().cast("array<string>")), lambda s: F.concat(F.lit("forbidden section: "), s))
    body = F.coalesce("text", F.lit(""))
    more = F.array_compact(F.array(F.when(body == "", "empty markdown output"), F.when(text.placeholder(body), "placeholder"), F.when(~body.rlike(text.BLOCK_ID), "no block ids cited")))
    return df.select("unit_id", "lane", F.explode(F.concat(F.coalesce(lost, F.array().cast("array<string>")), extra, more, text.hygiene(body))).alias("issue"))


def schema_batch(expected: DataFrame, found: DataFrame, results: DataFrame) -> DataFrame:
    """One row a slug: expected, total, valid, invalid, unexpected, missing, ungrounded and status.

    ``expected`` and ``found`` have slug and file, ``results`` also valid, extracted and demoted.
    Files whose names begin with an underscore are reports, not extractions.
    """
    e = expected.select("slug", "file").distinct().withColumn("e", F.lit(1))
    f = found.filter(~F.element_at(F.split("file", "/"), -1).startswith("_")).select("slug", "file").distinct().withColumn("f", F.lit(1))
    r = results.select("slug", "file", "valid", "extracted", "demoted", F.lit(1).alias("r"))
    both = e.join(f, ["slug", "file"], "full_outer").join(r, ["slug", "file"], "left")
    declared = F.col("e").isNotNull()
    sums = both.groupBy("slug").agg(
        F.count("e").alias("expected"),
        F.count_if(declared & F.col("r").isNotNull()).alias("total"),
        F.count_if(declared & F.coalesce("valid", F.lit(False))).alias("valid"),
        F.count_if(~declared).alias("unexpected"),
        F.count_if(F.col("f").isNull()).alias("missing"),
        F.count_if(declared & (F.col("extracted") > 0) & (F.col("demoted") / F.nullif("extracted", F.lit(0)) > 0.2)).alias("ungrounded"),
    )
    good = (F.col("valid") == F.col("expected")) & (F.col("unexpected") == 0) & (F.col("missing") == 0)
    return sums.withColumn("invalid", F.col("expected") - F.col("valid")).withColumn("status", F.when(good, "PASS").otherwise("FAIL"))


def precondition_issues(reports: DataFrame, writer: str) -> DataFrame:
    """slug and issue where merging may not start; ``reports`` has slug, marker (text), status, valid and total."""
    own = F.contains("marker", F.lit(f"validated_by: {writer}"))
    full = (F.col("status") == "PASS") & (F.col("valid") == F.col("total")) & (F.col("total") > 0)
    issue = F.when(F.col("marker").isNull(), "marker missing").when(~own, "marker of another writer").when(~F.coalesce(full, F.lit(False)), "report is not a non-empty PASS")
    return reports.select("slug", issue.alias("issue")).filter("issue is not null")
