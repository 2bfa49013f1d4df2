"""Sources: Markdown, JSON, JSONL, listings, configuration and embedded payloads as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

# Files beside extractions that are none.
NO_EXTRACTIONS = (
    "validation-report.json", "blockid-report.json", "scored-concepts.json", "top-concepts.json", "clean-concepts.json", "scoring-report.json",
    "concept-selection-candidates.json", "concept-selection-rationale-packet.json", "pipeline-state.json", "pipeline-run-manifest.json",
    "confirmed-concepts.json", "phase4-user-selection.json", "dispatch-result.json",
)


def whole_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file and text of all files under a path; malformed bytes are replaced."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).format("binaryFile").load(path)
    return df.select(F.col("path").alias("file"), F.expr("make_valid_utf8(string(content))").alias("text"))


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """Chapter files: Markdown without copies kept from before a split."""
    return whole_files(spark, path, "*.md").filter(~text.basename("file").contains(".orig."))


def json_objects(spark: SparkSession, path: str) -> DataFrame:
    """file and v (variant) of JSON files; anything but an object raises an error."""
    df = whole_files(spark, path, "*.json").withColumn("v", F.try_parse_json("text"))
    isnt = F.col("v").isNull() | ~F.schema_of_variant("v").startswith("OBJECT")
    return df.select("file", F.when(isnt, F.expr("cast(raise_error(concat('not a JSON object: ', file)) as variant)")).otherwise(F.col("v")).alias("v"))


def after_noise(c: Column | str) -> Column:
    """A text from its first brace on."""
    return F.expr(f"substring({c}, locate('{{', {c}))") if isinstance(c, str) else F.regexp_replace(c, r"(?s)\A[^{]*", "")


def embedded_index(c: Column | str) -> Column:
    """The JSON of a hidden source index inside Markdown."""
    return F.regexp_extract(text.col(c), r"(?s)<!--\s*source_index_json\s*\n(.*?)\n\s*-->", 1)


def extraction_files(spark: SparkSession, path: str) -> DataFrame:
    """file and json of extraction files: no reports, no names with a leading underscore; lists give a row each."""
    df = whole_files(spark, path, "*.json").withColumn("name", text.basename("file"))
    df = df.filter(~F.col("name").startswith("_") & ~F.col("name").endswith("-report.json") & ~F.col("name").isin(*NO_EXTRACTIONS)).withColumn("v", F.try_parse_json("text"))
    listed = F.coalesce(F.expr("try_cast(v as array<variant>)"), F.array("v"))
    return df.select("file", F.explode(listed).alias("v")).select("file", F.to_json("v").alias("json"))


# Reports beside extractions that an audit leaves out.
NO_AUDIT = (
    "specialist-verification.json", "blockid-validation.json", "page-build-report.json", "specialist-dispatch-report.json", "specialist-dispatch-plan.json",
    "dispatch-result.json", "pipeline-run-manifest.json", "image-to-page-coverage.json", "lexical-overlap-report.json", "schema-validation-report.json",
)


def audited_extractions(files: DataFrame) -> DataFrame:
    """The files (slug, folder, file) that an audit takes as extractions: those in the folder ``schema``, or, for slugs without it, those beside the reports."""
    json_ = files.filter(F.col("file").endswith(".json") & ~F.col("file").startswith("_"))
    inside = json_.filter(F.col("folder") == "schema")
    having = files.filter(F.col("folder") == "schema").select("slug").distinct()
    beside = json_.filter((F.col("folder") == "") & ~F.col("file").startswith("master") & ~F.col("file").endswith("-report.json") & ~F.col("file").isin(*NO_AUDIT))
    return inside.unionByName(beside.join(having, "slug", "left_anti"))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger events and, where a line does not parse, its raw text in bad."""
    schema = "generated_at string, phase string, provider string, model string, tokens_in bigint, tokens_out bigint, usd double, page_count_proxy bigint, bad string"
    return spark.read.text(path).filter("trim(value) <> ''").select(F.from_json("value", schema, {"columnNameOfCorruptRecord": "bad"}).alias("e")).select("e.*")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path and length of all files, without reading them."""
    return spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(path).select("path", "length")


def content_ids(spark: SparkSession, path: str) -> DataFrame:
    """path and SHA-256 of each file's content."""
    df = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(path)
    return df.select("path", F.sha2("content", 256).alias("sha256"))


def lanes(spark: SparkSession, path: str) -> DataFrame:
    """The lanes of a configuration file, with their positions; a lane without its required keys raises an error."""
    v = json_objects(spark, path).select(F.posexplode(F.variant_get("v", "$.lanes", "array<variant>")).alias("position", "l"))
    need = lambda k: F.coalesce(F.try_variant_get("l", f"$.{k}", "string"), F.expr(f"raise_error('lane without {k}')"))
    return v.select(need("id").alias("lane"), "position", need("output").alias("output"), need("schema_output_suffix").alias("schema_output_suffix"), F.try_variant_get("l", "$.focus_category", "string").alias("focus_category"), F.coalesce(F.try_variant_get("l", "$.required_sections", "array<string>"), F.array().cast("array<string>")).alias("required_sections"))


def front_matter(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys and fields: the scalar entries of each text's front matter."""
    head = F.when(F.col("text").startswith("---\n"), F.split("text", r"\n---", 2)[0]).otherwise("")
    rows = F.filter(F.split(head, "\n"), lambda x: x.rlike(r"^[A-Za-z_][\w-]*:"))
    entry = lambda x: F.struct(F.regexp_extract(x, r"^([A-Za-z_][\w-]*):", 1), F.regexp_replace(text.strip(F.regexp_replace(x, r"^[A-Za-z_][\w-]*:", "")), r"""^["']|["']$""", ""))
    distinct = F.array_distinct(F.transform(rows, entry))
    return docs.select(*keys, F.map_from_entries(distinct).alias("fields"))


def agent_front_matter(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys and fields of texts between the first two fences, wherever the first key stands; quotes of either kind go, lists stay as written."""
    inner = F.regexp_extract("text", r"(?s)\A---\s*\n(.*?)\n---", 1)
    rows = F.filter(F.split(inner, "\n"), lambda x: x.contains(":") & ~x.rlike(r"^[ \t#]"))
    entry = lambda x: F.struct(text.strip(F.substring_index(x, ":", 1)), F.btrim(F.btrim(text.strip(F.regexp_replace(x, r"^[^:]*:", "")), F.lit('"')), F.lit("'")))
    last = F.aggregate(F.transform(rows, entry), F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["col1"]), F.map_from_arrays(F.array(e["col1"]), F.array(e["col2"]))))
    return docs.select(*keys, last.alias("fields"))


def agent_output(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, front (the text before the body, fences taken off) and body of an agent's answer, which may stand in a code fence of its own."""
    bare = F.regexp_replace(F.regexp_replace(text.strip(F.coalesce("text", F.lit(""))), r"\A```\w*\n", ""), r"\n```\z", "")
    head = F.regexp_extract(bare, r"(?s)\A---\n(.*?)\n---(?:\n|\z)", 1)
    body = F.when(head != "", F.regexp_replace(bare, r"(?s)\A---\n.*?\n---(?:\n|\z)", "")).otherwise(bare)
    return docs.select(*keys, head.alias("front"), text.strip(body).alias("body"))
