"""The link graph: extraction, resolution, anchors, repair, typed edges and the index."""

from __future__ import annotations

from collections.abc import Iterator

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text

# The three forms of links and what counts as dead.
BRACKETED = r"(!?)\[\[([^\]\[#|]+)#\^\[([A-Za-z0-9-]+)\](?:\]\]|\])"
ANCHORLESS = r"(!?)\[\[([a-z0-9-]+-ch\d+-\d+)\]\]"
BLOCK_LINK = r"(!?)\[\[([^\]\[#|]+)#\^([A-Za-z0-9-]+)(?:\|([^\]]*))?\]\]"
DEAD = ("target_missing", "target_ambiguous", "anchor_missing", "malformed_bracket_anchor", "malformed_anchorless_id")


def extract_links(files: DataFrame) -> DataFrame:
    """file, raw, embed, target, anchor and status (null for well-formed links) of all block links; ``files`` has file and text.

    Malformed links are taken out before the next form is looked for.
    """

    def found(df: DataFrame, column: str, pattern: str) -> DataFrame:
        return df.select("file", F.explode(F.regexp_extract_all(column, F.lit(f"({pattern})"), 1)).alias("raw"))

    part = lambda p, k: F.regexp_extract("raw", p, k)
    df = files.select("file", "text").withColumn("rest", F.regexp_replace("text", BRACKETED, "\u0000")).withColumn("last", F.regexp_replace("rest", ANCHORLESS, "\u0000"))
    one = found(df, "text", BRACKETED).select("file", "raw", part(BRACKETED, 2).alias("target"), part(BRACKETED, 3).alias("anchor"), F.lit("malformed_bracket_anchor").alias("status"))
    two = found(df, "rest", ANCHORLESS).select("file", "raw", part(ANCHORLESS, 2), part(ANCHORLESS, 2), F.lit("malformed_anchorless_id"))
    three = found(df, "last", BLOCK_LINK).select("file", "raw", part(BLOCK_LINK, 2), part(BLOCK_LINK, 3), F.lit(None).cast("string"))
    out = one.union(two).union(three).withColumn("target", text.strip("target"))
    return out.select("file", "raw", F.col("raw").startswith("!").alias("embed"), "target", "anchor", "status")


def vault(files: DataFrame) -> DataFrame:
    """The Markdown files that links may lead to: no hidden and no legacy folders; file, path (without .md), stem, last."""
    out = files.filter(F.col("file").endswith(".md") & ~F.col("file").rlike(r"(^|/)\.") & ~F.col("file").rlike(r"(^|/)_legacy/"))
    path = F.regexp_replace("file", r"\.md$", "")
    return out.withColumn("path", path).withColumn("stem", text.basename(path))


def resolve_links(links: DataFrame, files: DataFrame) -> DataFrame:
    """``links`` with status and resolved (path): by exact path, by a path's end, or by name; then the anchor must exist.

    A path's end meets by its last component; the end itself is then compared as it stands.
    """
    index = vault(files).select("path", "stem", "text")
    name = F.regexp_replace("target", r"\.md$", "")
    df = links.withColumn("name", name).withColumn("is_path", name.contains("/"))
    key = df.filter("status is null").select("name", "is_path").distinct().withColumn("stem", F.substring_index("name", "/", -1))
    paths = index.select("path", "stem")
    by_name = key.filter("not is_path").join(paths, "stem")
    exact = key.filter("is_path").join(paths.withColumnRenamed("stem", "s"), F.col("name") == F.col("path")).select("name", "path")
    # the end of a path may also cut its last component short in front, if that has no further slash
    ends = key.filter("is_path").join(paths, "stem").filter(F.endswith("path", "name"))
    counted = by_name.unionByName(ends).groupBy("name").agg(F.count("*").alias("n"), F.min("path").alias("one"))
    out = df.join(exact.withColumnRenamed("path", "exact"), "name", "left").join(counted, "name", "left")
    target = F.coalesce("exact", F.when(F.col("n") == 1, F.col("one")))
    state = (
        F.when(F.col("status").isNotNull(), F.col("status"))
        .when(F.col("exact").isNotNull(), "ok")
        .when(F.coalesce("n", F.lit(0)) == 0, "target_missing")
        .when(F.col("n") > 1, "target_ambiguous")
        .when(F.col("is_path"), "suffix_match")
        .otherwise("ok")
    )
    out = out.withColumn("state", state).withColumn("resolved", F.when(F.col("status").isNull(), target))
    anchors = index.select(F.col("path").alias("resolved"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?m)\^([A-Za-z0-9-]+)(?=\s|$)"), 1))).alias("anchor")).withColumn("has", F.lit(True))
    out = out.join(anchors, ["resolved", "anchor"], "left")
    state = F.when(F.col("state").isin("ok", "suffix_match") & F.col("has").isNull(), "anchor_missing").otherwise(F.col("state"))
    return out.select("file", "raw", "embed", "target", "anchor", state.alias("status"), F.coalesce("resolved", F.lit("")).alias("resolved"))


def totals(links: DataFrame) -> DataFrame:
    """Links by status, and whether the status is dead."""
    return links.groupBy("status").agg(F.count("*").alias("links")).withColumn("dead", F.col("status").isin(*DEAD))


def by_file(links: DataFrame) -> DataFrame:
    return links.groupBy("file").agg(F.count("*").alias("links_checked"), F.count_if(F.col("status").isin(*DEAD)).alias("dead"))


def owners(files: DataFrame) -> DataFrame:
    """block_id and ref: the first file, in order, that holds each block's anchor."""
    anchors = vault(files).select("path", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?m)\^([a-z0-9-]+-ch\d+-\d+)(?=\s|$)"), 1))).alias("block_id"))
    return anchors.groupBy("block_id").agg(F.min("path").alias("ref"))


def short_anchor(block: str) -> str:
    return block[m.start() :] if (m := re.search(r"ch\d+-\d+$", block)) else block


def repair(files: DataFrame, refs: DataFrame) -> DataFrame:
    """file, text with canonical links, and the numbers of links left, rewritten and unresolved.

    Each file's ids meet their owners first, so that a task only holds the references of its files.
    """
    ids = files.select("file", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"([A-Za-z0-9-]+-ch\d+-\d+)"), 1))).alias("block_id"))
    known = ids.join(refs, "block_id").groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("block_id", "ref"))).alias("refs"))
    forms = [(re.compile(BRACKETED), 3), (re.compile(ANCHORLESS), 2), (re.compile(BLOCK_LINK), 3)]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts, counts = [], []
            for body, refs_ in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                owner, n = dict(refs_ or []), [0, 0, 0]

                def link(m: re.Match, k: int, owner=owner, n=n) -> str:
                    block, whole = m[k], m.re.groups == 4
                    if block not in owner:
                        n[2] += 1
                        return f"`^{block}` *(unresolved source block)*"
                    alias = m[4] if whole else None
                    same = whole and m[2].strip() == owner[block] and (m[1] == "!" or alias)
                    n[0 if same else 1] += 1
                    tail = "" if m[1] else f"|{alias or '^' + short_anchor(block)}"
                    return f"{m[1]}[[{owner[block]}#^{block}{tail}]]"

                body = body or ""
                for pattern, k in forms:
                    body = pattern.sub(lambda m, k=k: link(m, k), body)
                texts.append(body)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3))], ["file", "text", "canonical", "rewritten", "unresolved"])

    return files.select("file", "text").join(known, "file", "left").select("file", "text", "refs").mapInArrow(batches, "file string, text string, canonical long, rewritten long, unresolved long")


def typed_edges(concepts: DataFrame, refs: DataFrame | None = None, most: int = 3) -> DataFrame:
    """slug, predicate, block_id, pos and target of a page's relations: what it was taken from, defined, formulated and warned by.

    ``concepts`` has slug, source, block_ids, formula_ids and warning_ids (of the last two ``most`` each count);
    ``refs`` has block_id and ref, and a block without one leads to the source itself.
    """
    edge = lambda name, ids: concepts.select("slug", "source", F.lit(name).alias("predicate"), F.posexplode(ids).alias("pos", "block_id"))
    blocks = F.array_distinct("block_ids")
    every = edge("extracted_from", blocks).union(edge("defined_by", F.slice(blocks, 1, 1)))
    for name, ids in (("formulated_by", "formula_ids"), ("warned_by", "warning_ids")):
        every = every.union(edge(name, F.slice(F.coalesce(ids, F.array().cast("array<string>")), 1, most)))
    every = every.filter("block_id is not null")
    if refs is None:
        return every.select("slug", "predicate", "block_id", "pos", F.col("source").alias("target"))
    return every.join(refs, "block_id", "left").select("slug", "predicate", "block_id", "pos", F.coalesce("ref", "source").alias("target"))


def relation_lines(edges: DataFrame) -> DataFrame:
    """``edges`` with line: the edge as Markdown, the block shown by its short name."""
    short = F.coalesce(F.nullif(F.regexp_extract("block_id", r"(ch\d+-\d+)$", 1), F.lit("")), "block_id")
    return edges.withColumn("line", F.concat(F.lit("- "), "predicate", F.lit("::[["), "target", F.lit("#^"), "block_id", F.lit("|^"), short, F.lit("]]")))


def inferred_claims(claims: DataFrame, refs: DataFrame) -> DataFrame:
    """slug and note of each inferred claim (slug, source, ord, text, block_id, confidence) of a concept, in order.

    The note embeds the block that is interpreted; claims without a block have none.
    """
    own = claims.filter((F.col("confidence") == "INFERRED") & (F.coalesce("block_id", F.lit("")) != ""))
    df = own.join(refs, "block_id", "left").withColumn("target", F.coalesce("ref", "source"))
    note = F.concat(F.lit("\u26a0 **Inferred claim:** "), F.coalesce("text", F.lit("")), F.lit(" (interpretation of ![["), "target", F.lit("#^"), "block_id", F.lit("]])"))
    return df.select("slug", "ord", note.alias("note"))


# What a page of links may say besides a predicate.
NO_PAGES = ("concept-form-contract",)


def incoming_edges(files: DataFrame) -> DataFrame:
    """target and edges: how many typed edges lead to each note, by its name."""
    used = files.select(F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^\s*-\s+[a-z_]+::\[\[([^\]|#]+)"), 1)).alias("raw"))
    return used.groupBy(text.basename(text.strip("raw")).alias("target")).agg(F.count("*").alias("edges"))


def ghost_links(files: DataFrame) -> DataFrame:
    """target and n: notes that links name and no file is; ``files`` has file and text."""
    named = files.select(F.explode(F.regexp_extract_all("text", F.lit(r"\[\[([^\]|#]+)"), 1)).alias("raw")).select(F.regexp_replace(text.basename(text.strip("raw")), r"\.md$", "").alias("target"))
    there = vault(files).select(F.col("stem").alias("target")).distinct()
    return named.filter("target <> ''").join(there, "target", "left_anti").groupBy("target").agg(F.count("*").alias("n"))


def foreign_predicates(files: DataFrame, vocabulary: tuple[str, ...]) -> DataFrame:
    """predicate, edges and files of predicates outside the vocabulary."""
    return predicate_counts(files).filter(~F.col("predicate").isin(*vocabulary))


def predicate_counts(files: DataFrame) -> DataFrame:
    """How often each typed predicate is used, and by how many files."""
    used = files.select("file", F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^\s*-\s+([a-z_]+)::\[\["), 1)).alias("predicate"))
    return used.groupBy("predicate").agg(F.count("*").alias("edges"), F.count_distinct("file").alias("files"))


def index_gaps(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """stem and issue: pages the index lacks, entries without a page."""
    missing = pages.select("stem").join(entries, "stem", "left_anti").select("stem", F.lit("missing from index").alias("issue"))
    return missing.union(entries.select("stem").join(pages, "stem", "left_anti").select("stem", F.lit("stale entry")))


def hrefs(pages: DataFrame) -> DataFrame:
    """page_id and href of each anchor of raw pages (page_id, html)."""
    return pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r"(?i)<a\s[^>]*?href=[\"']([^\"'#]*)"), 1)).alias("href"))


def repair_totals(files: DataFrame, repaired: DataFrame) -> DataFrame:
    """One row: files, files_changed, canonical, rewritten and unresolved over what ``repair`` returned for ``files``."""
    both = files.select("file", F.col("text").alias("before")).join(repaired, "file")
    sums = (F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("canonical", "rewritten", "unresolved"))
    return both.agg(F.count("*").alias("files"), F.count_if(F.coalesce("before", F.lit("")) != F.col("text")).alias("files_changed"), *sums)


def unresolved_examples(repaired: DataFrame, most: int = 10) -> DataFrame:
    """block_id and n of the ids that repair could not resolve, the most frequent ones (ties by id)."""
    ids = repaired.select(F.explode(F.regexp_extract_all("text", F.lit(r"`\^([A-Za-z0-9-]+)` \*\(unresolved source block\)\*"), 1)).alias("block_id"))
    return ids.groupBy("block_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "block_id").limit(most)
