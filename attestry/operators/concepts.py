"""Concepts: merge, fold, score, threshold, duplicates, risks and rationale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.sql.window import Window

from ..functions import text
from ..sources.scratch import materialize, numbered

LISTS = ("definitions", "examples", "warnings", "formulas", "block_ids", "cross_references", "claims")


def _joined(df: DataFrame, lists: list[str], order: Column) -> tuple[list[Column], list[Column]]:
    """All lists of a group in one array of structs, sorted once, and the columns made of it."""
    empty = lambda c: F.coalesce(c, F.array().cast(df.schema[c].dataType))
    if not lists:
        return [], []
    gathered = F.array_sort(F.collect_list(F.struct(order.alias("o"), *(empty(c).alias(c) for c in lists)))).alias("__lists")
    return [gathered], [F.flatten(F.expr(f"transform(__lists, r -> r.{c})")).alias(c) for c in lists]


def merge(mentions: DataFrame) -> DataFrame:
    """One row for each slug over all its mentions; ``mentions`` has slug, name, chapter, confidence, density, ord and any of ``LISTS``.

    Lists are joined in the order of ord, the last name wins, chapters are distinct, and a missing
    confidence counts as 0.5.
    """
    lists = [c for c in LISTS if c in mentions.columns]
    gathered, joined = _joined(mentions, lists, F.col("ord"))
    out = mentions.filter(F.coalesce("slug", F.lit("")) != "").groupBy("slug").agg(
        F.max_by(F.coalesce("name", "slug"), "ord").alias("name"),
        F.array_sort(F.collect_set("chapter")).alias("chapters"),
        F.max(F.coalesce("confidence", F.lit(0.5))).alias("confidence"),
        F.max(F.coalesce("density", F.lit(0.0))).alias("density"),
        F.count("*").alias("source_count"),
        *gathered,
    )
    return out.select("slug", "name", "chapters", "confidence", "density", "source_count", *joined)


def tallied(mentions: DataFrame) -> DataFrame:
    """What ``score`` needs of the merged and folded concepts, without their lists: slug, norm, chapters, confidence, density, source_count, and the number of entries of each list.

    Mentions are counted by slug and chapter in hash tables before anything moves; names and lists stay where they are.
    """
    lists = [c for c in LISTS if c in mentions.columns]
    entries = [F.sum(F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0))).alias(c) for c in lists]
    own = mentions.filter(F.coalesce("slug", F.lit("")) != "").groupBy("slug", "chapter")
    by_chapter = own.agg(F.max(F.coalesce("confidence", F.lit(0.5))).alias("confidence"), F.max(F.coalesce("density", F.lit(0.0))).alias("density"), F.count("*").alias("source_count"), *entries)
    most = [F.max("confidence").alias("confidence"), F.max("density").alias("density")]
    sums = [F.sum(c).alias(c) for c in ("source_count", *lists)]
    normed = by_chapter.withColumn("norm", text.normal_slug("slug")).groupBy("norm", "chapter")
    first = F.min(F.struct(F.length("slug").alias("n"), "slug")).alias("first")
    folded = normed.agg(first, *most, *sums).groupBy("norm").agg(F.min("first").alias("first"), F.count("chapter").alias("chapters"), *most, *sums)
    return folded.select(F.col("first.slug").alias("slug"), "norm", "chapters", "confidence", "density", "source_count", *lists)


def fold(merged: DataFrame) -> DataFrame:
    """Slugs of one normal form become one concept, under the shortest of them; merged_slugs names them if there are several."""
    lists = [c for c in LISTS if c in merged.columns]
    rank = F.struct(F.length("slug").alias("n"), F.col("slug").alias("s"))
    gathered, joined = _joined(merged, lists, rank)
    out = merged.withColumn("norm", text.normal_slug("slug")).groupBy("norm").agg(
        F.min_by("slug", rank).alias("slug"),
        F.min_by("name", rank).alias("name"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("chapters")))).alias("chapters"),
        F.max("confidence").alias("confidence"),
        F.max("density").alias("density"),
        F.sum("source_count").alias("source_count"),
        F.array_sort(F.collect_set("slug")).alias("merged_slugs"),
        *gathered,
    )
    out = out.select("norm", "slug", "name", "chapters", "confidence", "density", "source_count", "merged_slugs", *joined)
    for c in ("block_ids", "cross_references"):
        if c in lists:
            out = out.withColumn(c, F.array_sort(F.array_distinct(c)))
    return out.withColumn("merged_slugs", F.when(F.size("merged_slugs") > 1, F.col("merged_slugs")))


def score(df: DataFrame) -> Column:
    """0 to 17: what a concept has, how often and how densely it occurs, and how sure it is; ``df`` has lists, or how many entries they have (``tallied``)."""
    many = lambda c: F.size(c) if isinstance(df.schema[c].dataType, ArrayType) else F.col(c)
    given = lambda c, points: F.when(many(c) > 0, points).otherwise(0) if c in df.columns else F.lit(0)
    met = lambda condition: F.when(condition, 1).otherwise(0)
    parts = [given("definitions", 3), given("examples", 3), given("formulas", 2), given("warnings", 2), given("cross_references", 1)]
    parts += [met(many("chapters") >= 2), met(many("chapters") >= 3), met(F.col("density") >= 2), met(F.col("density") >= 4), met(F.col("confidence") >= 0.8), met(F.col("source_count") >= 2)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def scored(concepts: DataFrame) -> DataFrame:
    return concepts.withColumn("score", score(concepts))


def threshold(concepts: DataFrame, least: int = 9, top: int | None = None) -> DataFrame:
    """Concepts of at least this score, the best ``top`` of them by score and slug."""
    kept = concepts.filter(F.col("score") >= least)
    return kept.orderBy(F.desc("score"), "slug").limit(top) if top else kept


def clean(concepts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Concepts with clean slugs, and those without."""
    return concepts.filter(text.is_clean_slug("slug")), concepts.filter(~text.is_clean_slug("slug"))


def downweight(concepts: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """Takes a point off for each distinct ambiguous block that a concept cites; ``ambiguous`` has block_id."""
    bad = ambiguous.filter(F.coalesce("block_id", F.lit("")) != "").select("block_id").distinct()
    cited = concepts.select("slug", F.explode(F.array_distinct("block_ids")).alias("block_id")).join(bad, "block_id", "left_semi")
    counts = cited.groupBy("slug").agg(F.count("*").alias("ambiguous_claim_count"))
    out = concepts.join(counts, "slug", "left").withColumn("ambiguous_claim_count", F.coalesce("ambiguous_claim_count", F.lit(0)))
    return out.withColumn("score", F.greatest(F.lit(0), F.col("score") - F.col("ambiguous_claim_count")))


#: Characters of the pieces by which a form meets longer ones that hold it.
PIECE = 4


def near_duplicates(slugs: DataFrame, least: float = 0.6) -> DataFrame:
    """a, b (a before b) and reason: same normal form, one inside the other, or token overlap of at least ``least``.

    No pair is compared that has nothing in common: equal forms and tokens meet by equality; a form meets those
    that hold it by its rarest piece of ``PIECE`` characters (or the whole of a shorter one), which they hold too.
    The slugs are written first: a dozen places read them, and each would make them anew from their source.
    """
    s = materialize(slugs.select("slug").distinct().withColumn("norm", text.normal_slug("slug")).withColumn("tokens", F.array_distinct(F.split("norm", "-"))))
    left = s.select(F.col("slug").alias("a"), F.col("norm").alias("na"))
    right = s.select(F.col("slug").alias("b"), F.col("norm").alias("nb"))
    same = left.join(right, (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))).select("a", "b", F.lit(0).alias("k"))
    forms = s.select("norm").distinct()
    pieces = lambda n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length("norm") - n + 1, F.lit(1))), lambda i: F.substring("norm", i, n)))
    # forms shorter than a piece are looked for by pieces of their own length: only lengths that occur, three at most
    short = sorted(r.n for r in forms.filter(F.length("norm").between(1, PIECE - 1)).select(F.length("norm").alias("n")).distinct().collect())
    held = forms.select("norm", F.explode(F.array_distinct(F.flatten(F.array(*map(pieces, [*short, PIECE]))))).alias("piece"))
    often = held.groupBy("piece").agg(F.count("*").alias("n"))
    own = forms.filter("norm <> ''").select("norm", F.explode(pieces(F.least(F.lit(PIECE), F.length("norm")))).alias("piece"))
    rare = own.join(often, "piece").groupBy("norm").agg(F.min(F.struct("n", "piece"))["piece"].alias("piece")).withColumnRenamed("norm", "na")
    met = held.join(rare, "piece").filter((F.col("norm") != F.col("na")) & F.contains("norm", "na")).select("na", F.col("norm").alias("nb"))
    # the empty form, one row at most, is inside of all others
    blank = F.broadcast(forms.filter("norm = ''").select(F.col("norm").alias("na")).limit(1))
    blank = forms.filter("norm <> ''").select(F.col("norm").alias("nb")).join(blank, F.lit(True)).select("na", "nb")
    inside = met.union(blank).join(left, "na").join(right, "nb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(1).alias("k"))
    # of sets that share 60 per cent, the rarest tokens of one always meet the other: the prefix filter
    freq = s.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    ranked = s.select("slug", F.size("tokens").alias("m"), "tokens", F.explode("tokens").alias("t")).join(freq, "t")
    ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy("slug").orderBy("n", "t"))).filter(F.col("r") <= F.col("m") - F.ceil(least * F.col("m")) + 1)
    one = ranked.select("t", F.col("slug").alias("a"), F.col("tokens").alias("ta"))
    two = ranked.select("t", F.col("slug").alias("b"), F.col("tokens").alias("tb"))
    alike = one.join(two, "t").filter("a < b").filter(text.jaccard("ta", "tb") >= least).select("a", "b", F.lit(2).alias("k"))
    reasons = F.array(F.lit("identical after plural/possessive normalization"), F.lit("one slug contains the other"), F.lit(f"token overlap >= {least}"))
    return same.union(inside).union(alike).groupBy("a", "b").agg(F.min("k").alias("k")).select("a", "b", reasons[F.col("k")].alias("reason"))


def attached_claims(concepts: DataFrame, claims: DataFrame) -> DataFrame:
    """slug and the columns of ``claims`` (file, block_id, ...) for each claim whose block a concept of the same file cites.

    ``concepts`` has file, slug and block_ids, in any number of rows a concept.
    """
    cited = concepts.select("file", "slug", F.explode(F.array_distinct("block_ids")).alias("block_id")).filter("block_id is not null").distinct()
    return claims.join(cited, ["file", "block_id"]).select("slug", *claims.columns)


def concept_sources(concepts: DataFrame, mentions: DataFrame) -> DataFrame:
    """slug, file, lane, chapter, chapter_title and block_ids (sorted) of each file in which a concept, or a slug merged into it, occurs.

    ``concepts`` has slug and merged_slugs (null without), ``mentions`` file, lane, slug, chapter, chapter_title and block_ids.
    """
    names = concepts.select("slug", F.explode(F.array_distinct(F.concat(F.array("slug"), F.coalesce("merged_slugs", F.array().cast("array<string>"))))).alias("alias"))
    found = mentions.withColumnRenamed("slug", "alias").join(names, "alias")
    ids = F.array_sort(F.array_distinct(F.filter(F.coalesce("block_ids", F.array().cast("array<string>")), lambda i: F.coalesce(i != "", F.lit(False)))))
    return found.select("slug", "file", "lane", "chapter", "chapter_title", ids.alias("block_ids"))


def known_duplicates(slugs: DataFrame, existing: DataFrame) -> DataFrame:
    """slug and existing page of one normal form but another slug."""
    pages = existing.select(F.col("slug").alias("existing"), text.normal_slug("slug").alias("norm"))
    own = slugs.select("slug", text.normal_slug("slug").alias("norm"))
    listed = existing.select("slug").distinct()
    return own.join(pages, "norm").select("slug", "existing").join(listed, "slug", "left_anti")


def strongest_blocks(votes: DataFrame, key: str, most: int = 5) -> DataFrame:
    """The ``most`` blocks of each key with the most rows, ties by id; ``votes`` has key and block_id."""
    counts = votes.groupBy(key, "block_id").agg(F.count("*").alias("votes"))
    order = Window.partitionBy(key).orderBy(F.desc("votes"), "block_id")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def ranked(concepts: DataFrame) -> DataFrame:
    """slug, score and rank by score and slug, numbered over ranges of both, so that neither one score nor one beginning meets in a task."""
    return numbered(concepts.select("slug", "score"), F.col("score").desc(), F.col("slug"), name="rank")


def selection_issues(selected: DataFrame, candidates: DataFrame, flagged: DataFrame, overridden: DataFrame | None = None) -> DataFrame:
    """slug and issue: chosen more than once, unknown, unclean, or chosen with a near duplicate, and an empty choice under a null slug.

    ``flagged`` has a and b; ``overridden`` (a, b) names pairs that may be chosen together.
    """
    again = selected.groupBy("slug").count().filter("count > 1").select("slug", F.lit("selected more than once").alias("issue"))
    unknown = selected.join(candidates, "slug", "left_anti").select("slug", F.lit("not a candidate"))
    unclean = selected.filter(~text.is_clean_slug("slug")).select("slug", F.lit("not a clean slug"))
    own = selected.select("slug").distinct()
    pairs = flagged.select("a", "b") if overridden is None else flagged.select("a", "b").join(overridden.select("a", "b"), ["a", "b"], "left_anti")
    pairs = pairs.join(own.withColumnRenamed("slug", "a"), "a").join(own.withColumnRenamed("slug", "b"), "b").select(F.col("a"), F.concat(F.lit("near duplicate of "), F.col("b")))
    empty = selected.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit(None).cast("string"), F.lit("nothing selected"))
    return again.union(unknown).union(unclean).union(pairs).union(empty)
