"""Evidence: quotes found in cited blocks, dead references, lexical overlap, claims for a human."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.scratch import materialize

#: Rows of quotes that are sent to every task at most, in place of a shuffle of the texts.
BROADCAST = 100_000

REASON = "quote_verbatim not found in cited source-index block"


def ground_claims(claims: DataFrame, blocks: DataFrame) -> DataFrame:
    """``claims`` with effective_confidence, demoted and reason.

    ``claims`` has block_id, confidence and quote_verbatim; an extracted claim whose quote is empty or
    not in its block (block_id, text) becomes ambiguous.
    """
    texts = blocks.groupBy("block_id").agg(F.min("text").alias("block_text"))
    df = claims.join(texts, "block_id", "left")
    quote = text.normal_quote(F.coalesce("quote_verbatim", F.lit("")))
    found = (quote != "") & F.contains(text.normal_quote(F.coalesce("block_text", F.lit(""))), quote)
    demoted = F.coalesce((F.col("confidence") == "EXTRACTED") & ~found, F.lit(False))
    return df.withColumns({"effective_confidence": F.when(demoted, "AMBIGUOUS").otherwise(F.col("confidence")), "demoted": demoted, "reason": F.when(demoted, REASON).otherwise("")}).drop("block_text")


def texts_by_unit(blocks: DataFrame, slug: str, unit: str) -> DataFrame:
    """block_id and text of one unit's blocks (slug, unit_id, block_id, text): what its claims may cite."""
    return blocks.filter((F.col("slug") == slug) & (F.col("unit_id") == unit)).groupBy("block_id").agg(F.min("text").alias("text"))


def grounding_totals(grounded: DataFrame) -> DataFrame:
    """One row: claims, extracted, demoted, inferred, ambiguous (effective) and ungrounded files' share over ``ground_claims`` rows."""
    state = lambda c, v: F.count_if(F.col(c) == v)
    out = grounded.agg(F.count("*").alias("claims"), state("confidence", "EXTRACTED").alias("extracted"), F.count_if("demoted").alias("demoted"), state("confidence", "INFERRED").alias("inferred"), state("effective_confidence", "AMBIGUOUS").alias("ambiguous"))
    return out.withColumn("rate", F.round(F.coalesce(F.try_divide("demoted", "extracted"), F.lit(0.0)), 4))


def quotes_in_texts(quotes: DataFrame, docs: DataFrame, words: int = 6) -> DataFrame:
    """item_id and doc_id of each text (doc_id, text) that holds a quote (item_id, text) verbatim, both in normal form.

    A text that holds a quote holds its inner words one after the other (its first one may end, its last
    one may begin a longer word of the text): texts and quotes meet by the hash of the first of these, at
    most ``words`` - 2, and only then, by their ids, with the texts themselves.  A quote of one word, or
    two, meets by its longest piece of three characters or fewer inside a word, so that no quote is
    compared with texts that have nothing of it.
    """
    normal = lambda c: text.normal_quote(F.coalesce(c, F.lit("")))
    n = words - 2
    # by kind: k inner words (1 to n), or pieces of characters where a quote has none
    q = quotes.select("item_id", normal("text").alias("quote")).filter("quote <> ''").distinct().withColumn("w", F.split("quote", " "))
    inner = F.size("w") - 2
    k = F.least(F.lit(n), inner)
    longest = F.array_max(F.transform("w", lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    piece = F.left(longest, F.lit(3))
    kind = F.when(inner > 0, k).otherwise(-F.length(piece))
    key = F.when(inner > 0, F.xxhash64(F.expr(f"slice(w, 2, least({n}, size(w) - 2))"))).otherwise(F.xxhash64(F.array(piece)))
    keyed = q.select("item_id", "quote", kind.alias("kind"), key.alias("key"))
    asked = sorted(r.kind for r in keyed.select("kind").distinct().collect())  # at most n + 3 kinds
    if not asked:
        return docs.join(quotes.select("item_id"), F.lit(False)).select("item_id", "doc_id")
    body = docs.select("doc_id", F.split(normal("text"), " ").alias("w"))
    made = []
    for i in asked:
        if i > 0:
            places = F.expr(f"if(size(w) >= {i}, transform(sequence(1, size(w) - {i - 1}), j -> xxhash64(slice(w, j, {i}))), cast(array() as array<bigint>))")
        else:
            places = F.expr(f"flatten(transform(w, x -> transform(sequence(1, greatest(1, length(x) - {-i - 1})), j -> xxhash64(array(substring(x, j, {-i}))))))")
        made.append(F.arrays_zip(F.array_repeat(F.lit(i), F.size(F.array_distinct(places))).alias("kind"), F.array_distinct(places).alias("key")))
    # few quotes go to every task and the texts' words stay where they are; many meet by their keys
    few = keyed.count() <= BROADCAST
    keys = F.broadcast(keyed) if few else keyed
    met = body.select("doc_id", F.explode(F.concat(*made)).alias("p")).select("doc_id", "p.kind", "p.key").join(keys, ["kind", "key"]).select("doc_id", "item_id", "quote").distinct()
    met = materialize(met)
    whole = docs.select("doc_id", normal("text").alias("body"))
    if met.count() <= BROADCAST:  # pairs of short quotes and ids: the texts don't move
        met = F.broadcast(met)
    return whole.join(met, "doc_id").filter(F.contains("body", "quote")).select("item_id", "doc_id").distinct()


def demotion_rates(grounded: DataFrame, keys: list[str], most: float = 0.2) -> DataFrame:
    """Keys, extracted, demoted, rate and whether the gate fails: over ``most``, strictly."""
    extracted = F.count_if(F.col("confidence") == "EXTRACTED")
    out = grounded.groupBy(*keys).agg(extracted.alias("extracted"), F.count_if("demoted").alias("demoted"))
    rate = F.coalesce(F.try_divide("demoted", "extracted"), F.lit(0.0))
    return out.withColumn("rate", F.round(rate, 4)).withColumn("fails", (F.col("extracted") > 0) & (rate > most))


def dead_references(refs: DataFrame, known: DataFrame, column: str = "block_id", source: str = "file", most: int = 5) -> DataFrame:
    """Referenced ids that no chapter holds, how often, and the first of the files that cite them."""
    dead = refs.join(known.select(column).distinct(), column, "left_anti")
    return dead.groupBy(column).agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set(source)), 1, most).alias("sources"))


def lexical_overlap(pages: DataFrame, cited: DataFrame, least: float = 0.12) -> DataFrame:
    """page, full_overlap, synthesis_overlap and status: words shared with the blocks that a page cites, by all its words and by its own.

    ``pages`` has page and text, ``cited`` has page and text, null where the block is missing.  The page's own
    words, without what it quotes, decide.
    """
    source = cited.groupBy("page").agg(F.array_distinct(F.flatten(F.collect_list(text.content_words("text")))).alias("ws"), F.max(F.col("text").isNull().cast("int")).alias("missing"))
    own = pages.select("page", text.content_words("text").alias("wp"), text.content_words(synthesis(F.coalesce("text", F.lit("")))).alias("wo"))
    df = own.join(source, "page", "left").withColumn("ws", F.coalesce("ws", F.array().cast("array<string>")))
    overlap = text.jaccard("wo", "ws")
    status = F.when(F.coalesce("missing", F.lit(0)) == 1, "MISSING_BLOCK").when(overlap >= least, "PASS").otherwise("LOW_OVERLAP")
    return df.select("page", F.round(text.jaccard("wp", "ws"), 4).alias("full_overlap"), F.round(overlap, 4).alias("synthesis_overlap"), status.alias("status"))


def synthesis(c: Column | str) -> Column:
    """A page's own words: no front matter, quotes, provenance lines and embeds."""
    rows = F.transform(text.lines(text.without_frontmatter(c)), text.strip)
    kept = F.filter(rows, lambda x: (x != "") & ~x.startswith(">") & ~x.startswith("- extracted_from::") & ~x.startswith("- `"))
    return F.array_join(F.transform(kept, lambda x: F.regexp_replace(x, r"!\[\[[^\]]+\]\]", "")), "\n")


def claims_for_human_eyes(claims: DataFrame, grounded: DataFrame) -> DataFrame:
    """Claims (file, claim_index, ...) that are ambiguous, by what was found or else by what they say."""
    checked = grounded.select("file", "claim_index", "effective_confidence", "reason")
    df = claims.join(checked, ["file", "claim_index"], "left").withColumn("effective_confidence", F.coalesce("effective_confidence", "confidence"))
    return df.filter("effective_confidence = 'AMBIGUOUS'").withColumn("reason", F.coalesce("reason", F.lit("")))


def citation_issues(citations: DataFrame, index: DataFrame, slug: str) -> DataFrame:
    """unit_id, block_id and issue: ids of another slug, and ids outside the unit's index."""
    own = F.col("block_id").startswith(f"{slug}-")
    wrong = citations.filter(~own).select("unit_id", "block_id", F.lit("wrong slug").alias("issue"))
    outside = citations.filter(own).join(index, ["unit_id", "block_id"], "left_anti").select("unit_id", "block_id", F.lit("outside unit source index"))
    return wrong.union(outside).distinct()


def anchored_texts(files: DataFrame) -> DataFrame:
    """block_id, file and text of the first anchor of each line, marks taken off; the last line of the last file counts.

    ``files`` has file and text.
    """
    rows = files.select("file", F.posexplode(text.lines("text")).alias("p", "line")).withColumn("block_id", F.regexp_extract("line", text.BLOCK_ID, 1)).filter("block_id <> ''")
    bare = text.strip(F.regexp_replace("line", r"\s*\^[\w-]+-ch\d{2}-\d+", ""))
    clean = text.strip(F.regexp_replace(bare, r"^#+\s*", ""))
    last = rows.groupBy("block_id").agg(F.max(F.struct("file", "p", clean.alias("text"))).alias("r"))
    return last.select("block_id", "r.file", "r.text")
