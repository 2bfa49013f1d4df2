"""Document fingerprints by winnowing, with DataFrame functions only.

A text's units are its words between white space, those of over ``PIECE`` code
points cut into all their pieces of that length, one from each place.  The hash of
each k-gram of units (the first ones are filled up in front) is made of its units'
hashes, each taken once, and combined with its place, so that the least value in
a window of w k-grams is the smallest hash, the rightmost among ties.  The minima
of all windows, with their places, are the fingerprint: two texts that share
w + k - 1 consecutive units share one.  The likeness of two fingerprints is the
Jaccard similarity of their hashes.

Each document also meets the next one in descending doc_id order.  Documents are
dealt to blocks between bounds that are themselves ids of documents, so that no
block is empty and the first row of each is that of its upper bound; this row is
repeated at the end of the block before.  There are at most ``QUANTILES`` bounds,
or, beyond ``QUANTILES * BLOCK_ROWS`` rows, as many between each two of them:
the table of bounds never exceeds ``QUANTILES`` squared numbers.  Nothing but
the rows' own blocks is shuffled.

Results on unusual input: a null text is empty; the fingerprint of an empty
text, or one of white space, is empty, and the likeness of two empty ones is 1,
of an empty and another one 0; rows with the same doc_id follow each other in the order of
their texts and share a block (doc_id is a key: a block is sorted by one task, on disk where
it must); a null doc_id comes last; after the last row follows the first;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 3
W = 4
#: Code points of a unit at most.
PIECE = 8
#: Rows of a block, about.
BLOCK_ROWS = 512
#: Bounds of doc_id at most, and further ones between each two of them.
QUANTILES = 1024
_PLACES = (1 << 31) - 1


def _winnowed(df: DataFrame, units: str, out: str, k: int, w: int) -> DataFrame:
    """Adds ``out``: the distinct window minima of the array column ``units``, as hash << 31 | (2^31 - 1 - place)."""
    df = df.withColumn("__h", F.expr(f"transform({units}, x -> xxhash64(x))"))
    before = "".join(f"if(i >= {j}, __h[i - {j}], 0L), " for j in range(k - 1, 0, -1))
    df = df.withColumn("__v", F.expr(f"transform(__h, (x, i) -> shiftleft(xxhash64({before}x) & 4294967295L, 31) | ({_PLACES}L - i))"))
    # least values of windows of 2, 4, ... places that end at each place; those at the start are shorter
    span = 1
    while span < w:
        step = min(span, w - span)
        df = df.withColumn("__v", F.expr(f"transform(__v, (x, i) -> if(i >= {step}, least(x, __v[i - {step}]), x))"))
        span += step
    return df.withColumn(out, F.array_distinct("__v")).drop("__h", "__v")


def fingerprints(df: DataFrame, text: str, out: str, k: int = K, w: int = W, piece: int = PIECE) -> DataFrame:
    """Adds ``out``, the fingerprint of the words of column ``text`` and of the pieces of longer ones."""
    # the characters of a long word are bound once; each piece is a slice of them
    pieces = f"flatten(transform(array(split(x, '')), c -> transform(sequence(1, size(c) - {piece - 1}), i -> array_join(slice(c, i, {piece}), ''))))"
    words = f"filter(split({text}, '(?U)\\\\s+'), x -> x <> '')"
    df = df.withColumn("__words", F.expr(words))
    cut = F.expr(f"flatten(transform(__words, x -> if(length(x) <= {piece}, array(x), {pieces})))")
    return _winnowed(df.withColumn("__units", cut), "__units", out, k, w).drop("__words", "__units")


def shown(out: str) -> Column:
    """A fingerprint as text: hash:place of each selected k-gram in order."""
    return F.array_join(F.expr(f"transform({out}, v -> concat(lower(lpad(hex(shiftright(v, 31)), 8, '0')), ':', {_PLACES}L - (v & {_PLACES}L)))"), ",")


def hashes(out: str) -> Column:
    return F.array_distinct(F.expr(f"transform({out}, v -> shiftright(v, 31))"))


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two array columns of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def _below(bounds: Column, most: int) -> Column:
    """How many of the sorted bounds, at most ``most``, are less than doc_id: by halving."""
    steps = F.lit([1 << k for k in range(most.bit_length() - 1, -1, -1)] or [1])
    step = lambda a, s: F.when((a + s <= F.size(bounds)) & (F.get(bounds, a + s - 1) < F.col("doc_id")), a + s).otherwise(a)
    return F.aggregate(steps, F.lit(0), step)


def _marks(parts: int) -> list[float]:
    return [k / parts for k in range(1, parts + 1)]


def in_blocks(docs: DataFrame, rows: int = BLOCK_ROWS, quantiles: int = QUANTILES) -> DataFrame:
    """Columns doc_id, text, block and ghost: each row in its block (descending with doc_id, from 0), then the ghosts.

    The ghost of a block repeats the first row of the next one, that of the
    last block the first row of all.
    """
    ids = docs.select("doc_id").filter("doc_id is not null")
    every, known = docs.agg(F.count("*"), F.count("doc_id")).first()
    blocks = max(1, known // rows)
    coarse, fine = min(quantiles, blocks), min(quantiles, -(-blocks // quantiles))
    near = ids.agg(F.percentile_approx("doc_id", _marks(coarse), 20 * quantiles)).first()[0] or []
    # approximate quantiles only propose; the bounds are the greatest ids up to each of them, and the greatest of all
    proposed = F.lit(sorted(set(near))).cast("array<long>")
    tops = sorted(r.top for r in ids.groupBy(_below(proposed, quantiles).alias("k")).agg(F.max("doc_id").alias("top")).collect())
    outer = F.lit(tops).cast("array<long>")
    held = docs.select("doc_id", "text", _below(outer, quantiles + 1).alias("c"))
    if fine > 1:
        inner = ids.select("doc_id", _below(outer, quantiles + 1).alias("c"))
        asked = inner.groupBy("c").agg(F.percentile_approx("doc_id", _marks(fine), 20 * fine).alias("q"))
        inner = inner.join(F.broadcast(asked), "c").groupBy("c", _below(F.col("q"), fine).alias("k")).agg(F.max("doc_id").alias("top"))
        found = sorted((r.c, r.tops) for r in inner.groupBy("c").agg(F.array_sort(F.collect_list("top")).alias("tops")).collect())
        last = sum(len(own) for _, own in found) - 1
        bounds, upto = [], 0
        for c, own in found:
            bounds.append((c, upto, own))
            upto += len(own)
        # at most ``quantiles`` + 1 rows of as many numbers
        held = held.join(F.broadcast(docs.sparkSession.createDataFrame(bounds, "c int, upto long, tops array<long>")), "c", "left")
        inside = _below(F.col("tops"), fine + 1)
        up, top = F.col("upto") + inside, F.get("tops", inside)
    else:
        last, up, top = len(tops) - 1, F.col("c"), F.get(outer, F.col("c"))
    block = F.when(F.col("doc_id").isNull(), F.lit(last + 1)).otherwise(F.lit(last) - up)
    placed = held.select("doc_id", "text", block.cast("long").alias("block"), top.alias("top"))
    # the first row of each block has its bound's id, and of those the least text
    first = placed.filter("doc_id is null or doc_id = top").groupBy("block").agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id"))
    greatest = last + (every > known)
    before = F.when(F.col("block") > 0, F.col("block") - 1).otherwise(F.lit(greatest))
    ghosts = first.select("doc_id", "text", before.cast("long").alias("block"), F.lit(1).alias("ghost"))
    return placed.select("doc_id", "text", "block", F.lit(0).alias("ghost")).unionByName(ghosts)


def compare(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """For each row: doc_id, text, edited, fp and edited_fp, own, changed and next: distinct hashes.

    ``edited`` is the text whose last third is replaced by the beginning of the next row's text.
    """
    rows = in_blocks(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    order = ["ghost", F.desc_nulls_last("doc_id"), "text"]
    rows = rows.repartition("block").sortWithinPartitions("block", *order)
    rows = fingerprints(rows, "text", "fp", k, w).withColumn("own", hashes("fp"))
    along = Window.partitionBy("block").orderBy(*order)
    rows = rows.withColumn("__text", F.lead("text").over(along)).withColumn("next", F.lead("own").over(along)).filter("ghost = 0")
    third = "cast(length(text) div 3 as int)"
    rows = rows.withColumn("edited", F.expr(f"concat(left(text, length(text) - {third}), left(__text, {third}))"))
    return fingerprints(rows, "edited", "edited_fp", k, w).withColumn("changed", hashes("edited_fp"))


def query(docs: DataFrame) -> DataFrame:
    return compare(docs).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        shown("fp").alias("fingerprint"),
        shown("edited_fp").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"),
        likeness("own", "next").alias("near_next"),
    )
