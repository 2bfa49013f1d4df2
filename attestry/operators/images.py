"""Images and vision marks: references, where they lead, coverage, gates and inherited records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text

IMAGE = r"!\[[^\]]*\]\(([^)]+)\)"
MARK = r"(VISION_[A-Z_]+|MISSING_IMAGE)"
# The labels of image regions, and the fields that may hold their address, first ones first.
LABELS = ("image", "chart", "seal", "figure")
SOURCE_FIELDS = ("image_path", "source_url", "file_url", "url", "content")
#: An address up to what may follow it in prose, Markdown or JSON.
URL = r"""(?i)(https?://[^\s"'<>)\\]*)"""
FIELDS = ("status", "description", "content", "confidence", "source", "type")


def image_refs(files: DataFrame) -> DataFrame:
    """file, ref and target of each image reference; ``files`` has file and text."""
    refs = files.select("file", F.explode(F.regexp_extract_all("text", F.lit(IMAGE), 1)).alias("raw"))
    return refs.select("file", text.strip_ref("raw").alias("ref"), text.file_ref("raw").alias("target"))


def verify(refs: DataFrame, listing: DataFrame) -> DataFrame:
    """``refs`` with state: remote, resolved or missing; ``listing`` has path and length, and empty files do not count."""
    present = listing.filter("length > 0").select(F.col("path").alias("resolved")).distinct().withColumn("there", F.lit(True))
    folder = F.regexp_extract("file", r"^(.*/)?[^/]*$", 1)
    df = refs.withColumn("resolved", F.when(F.col("target").startswith("/"), F.col("target")).otherwise(F.concat(folder, "target")))
    state = F.when(text.is_remote("ref", folded=False), "remote").when(F.coalesce("there", F.lit(False)), "resolved").otherwise("missing")
    return df.join(present, "resolved", "left").withColumn("state", state).select("file", "ref", "resolved", "state")


def sources(refs: DataFrame, listing: DataFrame) -> DataFrame:
    """``refs`` with source: the file beside the chapter, else the recognition's image of the same name."""
    local = listing.filter("kind = 'chapter'").select("path", F.col("path").alias("near"))
    ocr = listing.filter("kind = 'ocr'").groupBy(text.basename("path").alias("name")).agg(F.min("path").alias("far"))
    folder = F.regexp_extract("file", r"^(.*/)?[^/]*$", 1)
    df = refs.withColumn("path", F.concat(folder, "target")).withColumn("name", text.basename("target"))
    return df.join(local, "path", "left").join(ocr, "name", "left").select("file", "ref", F.coalesce("near", "far").alias("source"))


def gate(refs: DataFrame, ocr_images: int) -> DataFrame:
    """status of the image gate: no reference missing or remote, and some reference if the recognition has images."""
    n = refs.agg(F.count("*").alias("refs"), F.count_if(F.col("state") == "missing").alias("missing"), F.count_if(F.col("state") == "remote").alias("remote"))
    bad = (F.col("missing") > 0) | (F.col("remote") > 0) | ((F.col("refs") == 0) & F.lit(ocr_images > 0))
    return n.withColumn("status", F.when(bad, "FAIL").otherwise("PASS"))


def coverage(images: DataFrame, pages: DataFrame) -> DataFrame:
    """image, concept_pages, team_pages and whether each kind covers it; ``pages`` has page, kind (concept or team) and text.

    An image counts where its name occurs in an image reference or as a word with its extension: names meet
    names, texts are not searched for each of them.
    """
    named = F.regexp_extract_all("text", F.lit(r"([^\s/\\()\[\]<>\"'`|#?!*,;:]+\.[A-Za-z0-9]{2,5})"), 1)
    shown = F.transform(F.regexp_extract_all("text", F.lit(IMAGE), 1), lambda r: text.basename(text.file_ref(r)))
    used = pages.select("page", "kind", F.explode(F.array_distinct(F.concat(F.coalesce(shown, F.array().cast("array<string>")), F.coalesce(named, F.array().cast("array<string>"))))).alias("name"))
    own = images.select("image", text.basename("image").alias("name")).distinct()
    both = own.join(used, "name", "left").groupBy("image")
    out = both.agg(F.count_if(F.col("kind") == "concept").alias("concept_pages"), F.count_if(F.col("kind") == "team").alias("team_pages"))
    return out.withColumn("concept_covered", F.col("concept_pages") > 0).withColumn("team_covered", F.col("team_pages") > 0)


def coverage_totals(covered: DataFrame) -> DataFrame:
    """One row: images, and how many of them concept pages and team pages cover."""
    return covered.agg(F.count("*").alias("images"), F.count_if("concept_covered").alias("concept_covered"), F.count_if("team_covered").alias("team_covered"))


def markers(lines: DataFrame) -> DataFrame:
    """id, unit_id, line_no, marker, block_id and image_ref of each mark; ordinals count equal marks of a line."""
    found = lines.select("unit_id", "line_no", "line", F.posexplode(F.regexp_extract_all("line", F.lit(MARK), 1)).alias("p", "marker"))
    nth = F.row_number().over(Window.partitionBy("unit_id", "line_no", "marker").orderBy("p"))
    name = F.concat("unit_id", F.lit("-L"), text.two_digits("line_no", 4), F.lit("-"), "marker", F.lit("-"), nth)
    block = F.regexp_extract("line", text.BLOCK_ID, 1)
    return found.select(name.alias("id"), "unit_id", "line_no", "marker", block.alias("block_id"), text.strip_ref(F.regexp_extract("line", IMAGE, 1)).alias("image_ref"))


def marker_sections(logs: DataFrame) -> DataFrame:
    """id and fields of each ``### id`` section of a log with its ``key: value`` lines; ``logs`` has unit_id and text."""
    parts = logs.select("unit_id", F.explode(F.slice(F.split("text", r"(?m)^### +"), 2, 1 << 20)).alias("s"))
    rows = F.transform(F.split("s", "\n"), lambda x: F.regexp_replace(x, r"^- ", ""))
    pairs = F.filter(F.slice(rows, F.lit(2), F.size(rows)), lambda x: x.rlike(r"^[A-Za-z_]+:"))
    entry = F.transform(pairs, lambda x: F.struct(F.regexp_extract(x, r"^([A-Za-z_]+):", 1), text.strip(F.regexp_replace(x, r"^[A-Za-z_]+:", ""))))
    return parts.select("unit_id", text.strip(rows[0]).alias("id"), F.map_from_entries(entry).alias("fields"))


def vision_gate(marks: DataFrame, sections: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """id and resolved of each mark: its section exists and all fields are filled."""
    df = marks.join(sections.select("id", "fields"), "id", "left")
    filled = F.lit(True)
    for f in fields:
        filled &= F.coalesce(F.col("fields")[f] != "", F.lit(False))
    return df.select("id", F.coalesce(filled & F.col("fields").isNotNull(), F.lit(False)).alias("resolved"))


def urls_in(c: Column | str) -> Column:
    """The image addresses in a string, in their order."""
    found = F.regexp_extract_all(text.col(c), F.lit(URL), 1)
    return F.filter(F.transform(found, lambda u: F.rtrim(u, F.lit("'\".,;)"))), text.is_image_url)


def json_strings(c: Column | str) -> Column:
    """The quoted string values of a JSON text at any depth, keys left out; empty where it does not parse."""
    whole = F.to_json(F.try_parse_json(text.col(c)))
    tokens = F.regexp_extract_all(whole, F.lit(r'("(?:[^"\\]++|\\.)*+":?)'), 1)
    return F.coalesce(F.filter(tokens, lambda t: ~t.endswith(":")), F.array().cast("array<string>"))


def json_urls(c: Column | str) -> Column:
    """The distinct image addresses in a JSON text's values."""
    return F.array_distinct(F.flatten(F.transform(json_strings(c), urls_in)))


def json_has_images(c: Column | str) -> Column:
    """Whether any value of a JSON text names an image folder or an image address."""
    named = lambda v: F.lower(v).contains("imgs/") | F.lower(v).contains("images/")
    return F.exists(json_strings(c), lambda v: named(v) | (F.size(urls_in(v)) > 0))


def region_source() -> Column:
    """A region's image address: the first that one of its five fields is or holds; null without any."""
    first = lambda k: F.when(text.is_image_url(k), F.col(k)).otherwise(F.get(urls_in(k), F.lit(0)))
    return F.coalesce(*map(first, SOURCE_FIELDS))


def is_image_region() -> Column:
    label = lambda k: F.coalesce(F.lower(k).isin(*LABELS), F.lit(False))
    return label("label") | label("native_label") | region_source().isNotNull()


def local_regions(regions: DataFrame, assets: DataFrame, keys: list[str]) -> DataFrame:
    """``regions`` with local names for image addresses: content, image_path and source_url.

    ``keys`` name one region; ``assets`` has url (unique) and local.  An image region's content
    that is nothing but its address becomes empty; other contents get each known address replaced.
    """
    df = regions.withColumn("is_image", is_image_region()).withColumn("source", region_source())
    uses = df.select(*keys, F.explode(F.array_distinct(F.concat(urls_in("content"), F.array_compact(F.array("source"))))).alias("url"))
    known = uses.join(assets.select("url", "local"), "url").groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("url", "local"))).alias("names"))
    df = df.join(known, keys, "left")
    # longer addresses first, so that none is cut by one that it begins with
    ordered = F.reverse(F.array_sort(F.transform(F.coalesce(F.map_keys("names"), F.array().cast("array<string>")), lambda u: F.struct(F.length(u).alias("n"), u.alias("u")))))
    written = F.aggregate(ordered, F.col("content"), lambda done, u: F.replace(done, u["u"], F.element_at("names", u["u"])))
    alone = F.coalesce(F.col("is_image") & (text.strip("content") == F.col("source")), F.lit(False))
    out = df.withColumn("content", F.when(alone, "").otherwise(written))
    led = F.col("is_image") & F.col("source").isNotNull()
    path = F.coalesce(F.element_at("names", F.col("source")), F.col("image_path"), F.col("source"))
    out = out.withColumn("image_path", F.when(led, path).otherwise(F.col("image_path")))
    return out.withColumn("source_url", F.when(led, F.coalesce("source_url", "source")).otherwise(F.col("source_url"))).drop("names", "source")
