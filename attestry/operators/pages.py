"""Presentations and pages: sections, evidence, rendering, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

# The keys of a page's front matter in order, and the least that a page must have.
KEYS = ("title", "created", "updated", "confidence", "last_reinforced", "tier", "quality", "quality_notes", "scope", "author")
MIN_LINES, MIN_EMBEDS, MIN_QUOTES = 80, 2, 2
EMBED = r"!\[\[[^\]#|]+#\^([a-z0-9-]+-ch\d+-\d+)\]\]"


def sections(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pos, header and body of the second-level sections; of equal headers the first counts."""
    parts = F.split(F.concat(F.lit("\n"), F.coalesce("text", F.lit(""))), r"\n##[ \t]+")
    df = docs.select(*keys, F.posexplode(parts).alias("pos", "part")).filter("pos > 0")
    header = text.strip(F.substring_index("part", "\n", 1))
    body = F.when(F.col("part").contains("\n"), text.strip(F.expr("substring(part, locate('\n', part) + 1)"))).otherwise("")
    df = df.select(*keys, "pos", header.alias("header"), body.alias("body"))
    return df.groupBy(*keys, "header").agg(F.min("pos").alias("pos"), F.min_by("body", "pos").alias("body"))


def source_index(blocks: DataFrame, shown: int = 160) -> DataFrame:
    """slug, unit_id and markdown: a unit's blocks by category, in the fixed order, with the start of each text."""
    from ..functions.rules import CATEGORIES

    place = F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col("category"))
    row = F.struct(place.alias("p"), "line_no", F.concat(F.lit("- `^"), "block_id", F.lit("` "), F.substring(F.regexp_replace("text", r"\s+", " "), 1, shown)).alias("s"))
    df = blocks.groupBy("slug", "unit_id", "category").agg(F.min(place).alias("p"), F.array_sort(F.collect_list(row)).alias("rows"))
    part = F.struct("p", F.concat(F.lit("## "), "category", F.lit("\n"), F.array_join(F.transform("rows", lambda r: r["s"]), "\n")).alias("s"))
    return df.groupBy("slug", "unit_id").agg(F.array_sort(F.collect_list(part)).alias("x")).select("slug", "unit_id", F.array_join(F.transform("x", lambda r: r["s"]), "\n\n").alias("markdown"))


def quoted_yaml(c: Column | str) -> Column:
    """A text as a double-quoted scalar."""
    return F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(F.regexp_replace(text.col(c), r"\\", r"\\\\"), '"', r'\\"'), "\n", r"\\n"), F.lit('"'))


def front_matter(df: DataFrame) -> Column:
    """The front matter of a page from columns of the keys' names; missing ones are empty."""
    value = lambda k: quoted_yaml("title") if k == "title" else F.coalesce(F.col(k).cast("string"), F.lit("")) if k in df.columns else F.lit("")
    return F.concat(F.lit("---\n"), *(x for k in KEYS for x in (F.lit(f"{k}: "), value(k), F.lit("\n"))), F.lit("---\n"))


def assemble(parts: DataFrame, order: DataFrame) -> DataFrame:
    """unit_id and markdown of the sections (unit_id, header, body) in the order of ``order`` (header, place)."""
    placed = parts.join(F.broadcast(order), "header")
    piece = F.struct("place", F.concat(F.lit("## "), "header", F.lit("\n\n"), "body").alias("s"))
    return placed.groupBy("unit_id").agg(F.array_sort(F.collect_list(piece)).alias("x")).select("unit_id", F.array_join(F.transform("x", lambda r: r["s"]), "\n\n").alias("markdown"))


def uncited(blocks: DataFrame, presentations: DataFrame) -> DataFrame:
    """unit_id and block_id of the blocks that a unit's presentation (unit_id, text) does not cite."""
    cited = presentations.select("unit_id", F.explode(F.regexp_extract_all("text", F.lit(text.BLOCK_ID), 1)).alias("block_id")).distinct()
    return blocks.select("unit_id", "block_id").join(cited, ["unit_id", "block_id"], "left_anti")


def with_evidence(parts: DataFrame, blocks: DataFrame, targets: DataFrame, corpus: str = "Relations", shown: int = 2) -> DataFrame:
    """``parts`` (unit_id, header, body) with the unit's evidence where a body cites none.

    ``blocks`` has unit_id, pos, block_id and text in the order of the unit's index, ``targets`` unit_id and target, the
    chapter that embeds lead to.  A body without citation gets the first blocks as anchors; the section ``corpus``
    also lists all blocks that it doesn't cite.
    """
    row = F.struct("pos", "block_id", "text")
    evidence = blocks.groupBy("unit_id").agg(F.array_sort(F.collect_list(row)).alias("__e")).join(targets, "unit_id")
    df = parts.withColumn("body", text.strip(F.coalesce("body", F.lit("")))).join(evidence, "unit_id", "left")
    none = F.array().cast("array<struct<pos:int,block_id:string,text:string>>")
    df = df.withColumn("__e", F.coalesce(F.col("__e").cast("array<struct<pos:int,block_id:string,text:string>>"), none))
    embed = lambda e: F.concat(F.lit("- ![["), F.col("target"), F.lit("#^"), e["block_id"], F.lit("]]"))
    anchors = F.concat(F.col("body"), F.lit("\n\nEvidence anchors:\n"), F.array_join(F.transform(F.slice("__e", 1, shown), embed), "\n"))
    df = df.withColumn("body", F.when((F.size("__e") > 0) & ~F.col("body").rlike(text.BLOCK_ID), anchors).otherwise(F.col("body")))
    cited = text.block_citations("body")
    df = df.withColumn("__cited", cited).withColumn("__left", F.filter("__e", lambda e: ~F.array_contains(F.col("__cited"), e["block_id"])))
    rest = F.array_join(F.transform("__left", lambda e: F.concat(embed(e), F.lit(" \u2014 "), F.coalesce(F.nullif(text.strip(e["text"]), F.lit("")), e["block_id"]))), "\n")
    whole = F.concat(F.col("body"), F.lit("\n\nUnit evidence corpus:\n"), rest)
    out = F.when((F.col("header") == corpus) & (F.size("__left") > 0), whole).otherwise(F.col("body"))
    return df.withColumn("body", out).select(*parts.columns)


def evidence_index(concepts: DataFrame, presentations: DataFrame) -> DataFrame:
    """slug, pos, block_id and units: a concept's blocks in their order, with the units that present each."""
    cited = presentations.select("unit_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(text.BLOCK_ID), 1))).alias("block_id"))
    units = cited.groupBy("block_id").agg(F.array_sort(F.collect_set("unit_id")).alias("units"))
    rows = concepts.select("slug", F.posexplode(F.array_distinct("block_ids")).alias("pos", "block_id"))
    return rows.join(units, "block_id", "left").select("slug", "pos", "block_id", F.coalesce("units", F.array().cast("array<string>")).alias("units"))


def evidence_section(index: DataFrame, refs: DataFrame, source: str) -> DataFrame:
    """slug and markdown of the evidence index: a numbered row for each block, its units and its embed; ``index`` is as of ``evidence_index``."""
    label = F.when(F.size("units") > 0, F.array_join("units", ", ")).otherwise("unknown unit")
    target = F.coalesce("ref", F.lit(source))
    row = F.concat((F.col("pos") + 1).cast("string"), F.lit(". `^"), "block_id", F.lit("` \u2014 unit(s): "), label, F.lit("\n   - ![["), target, F.lit("#^"), "block_id", F.lit("]]"))
    rows = index.join(refs, "block_id", "left").groupBy("slug").agg(F.array_sort(F.collect_list(F.struct("pos", row.alias("r")))).alias("x"))
    return rows.select("slug", F.concat(F.lit("## Evidence index\n\n"), F.array_join(F.transform("x", lambda r: r["r"]), "\n")).alias("markdown"))


def dead_citations(texts: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """key and issue of texts (key, text) that cite blocks which no chapter (block_id) has."""
    cited = texts.select(key, F.explode(F.array_distinct(text.block_citations("text"))).alias("block_id"))
    return cited.join(known.select("block_id").distinct(), "block_id", "left_anti").select(key, F.concat(F.lit("dead block id: "), "block_id").alias("issue"))


def dead_link_issues(texts: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """key and issue of texts (key, text) whose block links lead nowhere in a vault of ``files`` (file, text)."""
    from . import links

    asked = links.extract_links(texts.select(F.col(key).cast("string").alias("file"), "text"))
    dead = links.resolve_links(asked, files).filter(F.col("status").isin(*links.DEAD))
    return dead.select(F.col("file").alias(key), F.concat(F.col("status"), F.lit(": "), F.col("raw")).alias("issue"))


def render(concepts: DataFrame, wanted: int = 6) -> DataFrame:
    """slug and markdown of pages; ``concepts`` has slug, name, confidence, block_ids, section_bodies (map) and author_words."""
    found = F.size(F.filter(F.map_values("section_bodies"), lambda b: text.strip(b) != ""))
    df = concepts.withColumn("title", text.numberless_title(F.coalesce("name", "slug")))
    df = df.withColumn("quality", text.page_quality(found, text.quote_lines("author_words"), F.size("block_ids"), wanted)).withColumn("confidence", text.capped_confidence("confidence"))
    body = F.array_join(F.transform(F.array_sort(F.map_entries("section_bodies")), lambda e: F.concat(F.lit("## "), e["key"], F.lit("\n\n"), e["value"])), "\n\n")
    return df.select("slug", F.concat(front_matter(df), F.lit("\n# "), "title", F.lit("\n\n"), body).alias("markdown"))


def page_issues(pages: DataFrame, slug: str, required: list[str]) -> DataFrame:
    """page and issue of texts that break the page contract; ``pages`` has page and text."""
    t = F.coalesce("text", F.lit(""))
    head = F.when(t.startswith("---\n"), F.split(t, "---", 3)[1]).otherwise("")
    keys = F.transform(F.filter(F.split(head, "\n"), lambda x: x.contains(":")), lambda x: text.strip(F.substring_index(x, ":", 1)))
    embeds = F.size(F.regexp_extract_all(t, F.lit(EMBED), 1))
    words = F.regexp_extract(t, r"(?s)\n## Author's Words[ \t]*\n(.*?)(?=\n## |\z)", 1)
    cited = F.regexp_extract_all(t, F.lit(text.BLOCK_ID), 1)
    say = lambda condition, what: F.when(condition, what)
    checks = F.array_compact(
        F.array(
            say(F.slice(keys, 1, len(KEYS)) != F.array(*map(F.lit, KEYS)), "front matter key order"),
            say(t.contains("derived_from::"), "forbidden derived_from predicate"),
            say(~t.contains("extracted_from::"), "no provenance"),
            say(F.size(text.lines(t)) < MIN_LINES, "too few lines"),
            say(embeds < MIN_EMBEDS, "too few embeds"),
            say(text.quote_lines(words) < MIN_QUOTES, "too few quotes"),
            say(F.exists(cited, lambda b: ~b.startswith(f"{slug}-")), "block ids of another slug"),
            say(text.placeholder(t), "placeholder"),
        )
    )
    lost = F.transform(F.array_except(F.array(*map(F.lit, required)), text.sections(t)), lambda s: F.concat(F.lit("missing section: "), s))
    return pages.select("page", F.explode(F.concat(checks, lost)).alias("issue"))


def presentation_issues(presentations: DataFrame, required: list[str]) -> DataFrame:
    """unit_id and issue: sections missing, twice, empty or without citation, and too few embeds or quotes."""
    wanted = F.array(*map(F.lit, required))
    t = F.coalesce("text", F.lit(""))
    heads = text.sections(t)
    body = sections(presentations, ["unit_id"]).filter(F.col("header").isin(*required))
    inner = body.select("unit_id", F.when(F.col("body") == "", F.concat(F.lit("empty section: "), "header")).when(~F.col("body").rlike(text.BLOCK_ID), F.concat(F.lit("section without citation: "), "header")).alias("issue")).filter("issue is not null")
    words = F.regexp_extract(t, r"(?s)\n## Author's Words[ \t]*\n(.*?)(?=\n## |\z)", 1)
    outer = F.concat(
        F.transform(F.array_except(wanted, heads), lambda s: F.concat(F.lit("missing section: "), s)),
        F.transform(F.array_except(heads, wanted), lambda s: F.concat(F.lit("unexpected section: "), s)),
        F.array_compact(F.array(F.when(F.size(heads) != F.size(F.array_distinct(heads)), "duplicate section"), F.when(F.size(F.regexp_extract_all(t, F.lit(EMBED), 1)) < MIN_EMBEDS, "too few embeds"), F.when(text.quote_lines(words) < MIN_QUOTES, "too few quotes"), F.when(text.placeholder(t), "placeholder"))),
    )
    return presentations.select("unit_id", F.explode(outer).alias("issue")).union(inner)


def redraft(drafts: DataFrame, defaults: list[str]) -> DataFrame:
    """page, title and markdown of drafts (page, text, and any front matter columns), put into the page's form.

    New front matter, then the predicates of the draft (or the default ones), the body from its first
    non-blank line, and the relations.  The title is that of the draft's front matter, else the page's name.
    """
    df = drafts.withColumn("__rows", F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x, i: F.struct(i.alias("i"), x.alias("x"), text.strip(x).alias("t"))))
    fences = F.transform(F.filter("__rows", lambda r: r["t"] == "---"), lambda r: r["i"])
    df = df.withColumn("__one", F.coalesce(F.get(fences, F.lit(0)), F.size("__rows"))).withColumn("__two", F.coalesce(F.get(fences, F.lit(1)), F.size("__rows")))
    front = F.filter("__rows", lambda r: (r["i"] > F.col("__one")) & (r["i"] < F.col("__two")))
    rest = F.filter("__rows", lambda r: (r["i"] < F.col("__one")) | (r["i"] > F.col("__two")))
    df = df.withColumn("__front", front).withColumn("__rest", rest)
    given = F.try_element_at(F.filter("__front", lambda r: r["t"].startswith("title:")), F.lit(-1))["t"]
    given = F.btrim(F.btrim(text.strip(F.regexp_replace(given, "^title:", "")), F.lit('"')), F.lit("'"))
    df = df.withColumn("title", F.coalesce(F.nullif(given, F.lit("")), F.initcap(F.replace("page", F.lit("-"), F.lit(" ")))))
    headed = F.transform(F.filter("__rest", lambda r: r["t"].startswith("## Relations")), lambda r: r["i"])
    df = df.withColumn("__from", F.coalesce(F.get(headed, F.lit(0)), F.size("__rows")))
    is_predicate = lambda r: r["t"].rlike(r"^- (conforms_to|has_status|in_domain|in_precinct)::")
    related = lambda r: ~is_predicate(r) & (r["i"] >= F.col("__from")) & (r["t"].startswith("## Relations") | ~r["t"].startswith("#"))
    shown = lambda keep: F.transform(F.filter("__rest", keep), lambda r: r["x"])
    body = F.filter("__rest", lambda r: ~is_predicate(r) & ~related(r))
    start = F.coalesce(F.get(F.transform(F.filter(body, lambda r: r["t"] != ""), lambda r: r["i"]), F.lit(0)), F.size("__rows"))
    df = df.withColumn("__preds", shown(is_predicate)).withColumn("__relations", shown(related)).withColumn("__start", start)
    none = F.array().cast("array<string>")
    df = df.withColumn("__preds", F.when(F.size("__preds") > 0, F.col("__preds")).otherwise(F.array(*map(F.lit, defaults)) if defaults else none))
    head = F.when(F.size("__preds") > 0, F.array_append("__preds", F.lit("\n"))).otherwise(none)
    tail = F.when(F.size("__relations") > 0, F.concat(F.array(F.lit("\n")), "__relations")).otherwise(F.array(F.lit("\n## Relations\n\n")))
    kept = shown(lambda r: ~is_predicate(r) & ~related(r) & (r["i"] >= F.col("__start")))
    return df.select("page", "title", F.array_join(F.concat(F.array(front_matter(df)), head, kept, tail), "\n").alias("markdown"))
