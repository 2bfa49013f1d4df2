"""Line dedup by winnowing over line hashes, with DataFrame functions only.

A window is a shortest sequence of consecutive non-blank lines with more than
``min_words`` words, forwards or backwards from some line.  Of each window one
line is selected, that of the smallest hash (the rightmost one among ties): the
fingerprints are these lines alone, with their places.  Every repeat of a run of
more than ``min_words`` words holds the same windows and thus the same selected
lines, so that no repeat is missed.

Selected lines meet by their hash, each with the first of all (never with each
other), and lines whose hash is selected once are gone here.  A match is extended
both ways from the selected line, line by line, as long as both sides agree; the
windows inside it are repeats.  What the first occurrence doesn't cover (the line
is common, what surrounds it differs) is compared with all others by the digest
of the lines around the selected one, again with the first of each digest.  As
both occurrences of a window agree on it, what the first one doesn't cover of one
it doesn't cover of the other, so that nothing is lost between the two steps.

A line is deleted exactly if it lies in a run of more than ``min_words`` words
whose lines have occurred before: in a document of smaller ``doc_id`` (ties: of
smaller text hash), or further up in the same one.  Lines are compared without
white space at their ends; words are runs of anything but ASCII white space.

Results on unusual input: null texts are empty and stay null; blank lines are
never deleted, but a document that loses all other lines becomes empty; rows
that repeat both doc_id and text count as one occurrence and get the same
result; a null doc_id comes first in order; empty tables give empty results;
further columns are ignored by ``removals`` and kept by ``dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

MIN_WORDS = 50
_SPACE = " \t\r\x0b\x0c"
#: A window is one number: its start times this, and its lines (at most one a word).
_CODE = 1 << 20


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, mark (hash of the text), hs and ws: hashes and word counts of the non-blank lines."""
    # texts with nothing but single spaces between words, as most are, are counted without a pattern
    wide = " or ".join(f"contains(text, '{x}')" for x in ("  ", *_SPACE[1:]))
    rows = f"filter(transform(split(coalesce(text, ''), '\n'), x -> btrim(x, '{_SPACE}')), x -> x <> '')"
    cleaned = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.expr(rows).alias("rows"), F.expr(wide).alias("wide"))
    count, fast = f"size(split(x, '[{_SPACE}]+'))", "length(x) - length(replace(x, ' ', '')) + 1"
    words = f"if(wide, transform(rows, x -> cast({count} as bigint)), transform(rows, x -> cast({fast} as bigint)))"
    return cleaned.select("doc_id", "mark", F.expr("transform(rows, x -> xxhash64(x))").alias("hs"), F.expr(words).alias("ws"))


def windows(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, mark, hs, at (the windows in order, start * 2^20 + lines) and anchors (the selected line of each) of each row.

    Starts and ends of the windows in order never go back, and neither do the selected lines.
    """
    # a slice of ``most`` lines holds any window; the sum is words * 2^20 + lines
    most = min_words + 1
    reach = f"(a, w) -> if(a >= {most * _CODE}, a, a + w * {_CODE} + 1), a -> if(a >= {most * _CODE}, a % {_CODE}, 0L)"
    forth = f"transform(ws, (w, i) -> i * {_CODE}L + aggregate(slice(ws, i + 1, {most}), 0L, {reach}))"
    back = f"transform(transform(ws, (w, i) -> aggregate(reverse(slice(ws, greatest(1, i + 2 - {most}), least(i + 1, {most}))), 0L, {reach})), (n, i) -> if(n > 0, (i - n + 1) * {_CODE}L + n, 0L))"
    found = _lines(docs).select("doc_id", "mark", "hs", F.expr(f"sort_array(array_distinct(filter(concat({forth}, {back}), x -> x % {_CODE} > 0)))").alias("at"))
    run = f"slice(hs, cast(x div {_CODE} as int) + 1, cast(x % {_CODE} as int))"
    anchor = f"cast(x div {_CODE} + x % {_CODE} as int) - cast(array_position(reverse({run}), array_min({run})) as int)"
    return found.withColumn("anchors", F.expr(f"transform(at, x -> {anchor})"))


def fingerprints(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each selected line: doc_id, mark, place, least (its hash), wins (the windows that select it), low and around.

    ``around`` holds the hashes of the lines that these windows cover, from line ``low`` on.
    """
    found = windows(docs, min_words)
    edges = F.expr("filter(sequence(0, size(anchors)), i -> i = 0 or i = size(anchors) or anchors[i] <> anchors[i - 1])")
    found = found.withColumn("edges", edges)
    found = found.select("doc_id", "mark", "hs", "at", "anchors", F.explode(F.expr("transform(slice(edges, 1, size(edges) - 1), (x, i) -> named_struct('from', x, 'to', edges[i + 1]))")).alias("e"))
    found = found.select("doc_id", "mark", "hs", F.expr("anchors[e.from]").alias("place"), F.expr("slice(at, e.from + 1, e.to - e.from)").alias("wins"))
    last = "element_at(wins, -1)"
    low, high = f"cast(wins[0] div {_CODE} as int)", f"cast({last} div {_CODE} + {last} % {_CODE} as int)"
    return found.select("doc_id", "mark", "place", F.expr("hs[place]").alias("least"), "wins", F.expr(low).alias("low"), F.expr(f"slice(hs, {low} + 1, {high} - {low})").alias("around"))


def _agreeing(most: str, here: str, there: str) -> Column:
    """How many lines agree from the selected one on, up to ``most``; ``here`` and ``there`` name the i-th line."""
    return F.expr(f"if({most} < 1, 0, coalesce(array_min(filter(sequence(1, greatest(1, {most})), i -> {here} <> {there})), {most} + 1) - 1)")


def extended(later: DataFrame) -> DataFrame:
    """``later`` with low_end and high_end: the first and the last line that agree with the first occurrence around the selected one.

    ``later`` has place, low, around, and first_at and first_around: where the first occurrence's line stands in its lines.
    """
    df = later.withColumn("own_at", F.col("place") - F.col("low"))
    back = _agreeing("least(own_at, first_at)", "around[own_at - i]", "first_around[first_at - i]")
    forth = _agreeing("least(size(around) - own_at, size(first_around) - first_at) - 1", "around[own_at + i]", "first_around[first_at + i]")
    return df.withColumn("low_end", F.col("place") - back).withColumn("high_end", F.col("place") + forth).drop("own_at")


def _covered(wins: str) -> Column:
    """The lines of windows."""
    return F.array_distinct(F.flatten(F.transform(wins, lambda x: F.sequence(F.floor(x / _CODE).cast("int"), (F.floor(x / _CODE) + x % _CODE - 1).cast("int")))))


def removals(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, mark and removed: the sorted places, among a text's non-blank lines, of those in repeated runs."""
    prints = materialize(fingerprints(docs, min_words))
    here = F.struct("doc_id", "mark", "place")
    first = prints.groupBy("least").agg(F.min(here).alias("first"), F.max(here).alias("last")).filter("not (first <=> last)").drop("last")
    shared = prints.join(first, "least")
    origin = shared.filter(here == F.col("first")).groupBy("least").agg(F.first(F.struct((F.col("place") - F.col("low")).alias("at"), "around")).alias("o"))
    origin = origin.select("least", F.col("o.at").alias("first_at"), F.col("o.around").alias("first_around"))
    later = extended(shared.filter(here > F.col("first")).join(origin, "least"))
    inside = F.expr(f"filter(wins, x -> x div {_CODE} >= low_end and x div {_CODE} + x % {_CODE} - 1 <= high_end)")
    later = materialize(later.select("doc_id", "mark", "place", "least", "low", "around", inside.alias("met"), F.array_except("wins", inside).alias("rest")))
    # common lines in other surroundings: each window by its digest, with the first of them
    rest = later.filter("size(rest) > 0").select("doc_id", "mark", "place", "least", "low", "around", F.explode("rest").alias("x"))
    start, size = f"cast(x div {_CODE} as int)", f"cast(x % {_CODE} as int)"
    rest = rest.select("doc_id", "mark", "place", "x", "least", F.expr(f"place - {start}").alias("before"), F.expr(f"xxhash64({size}, slice(around, {start} - low + 1, {size}))").alias("digest"))
    key = ["least", "before", "digest"]
    again = rest.groupBy(*key).agg(F.min(here).alias("first"), F.max(here).alias("last")).filter("not (first <=> last)").drop("last")
    repeated = rest.join(again, key).filter(here > F.col("first")).select("doc_id", "mark", F.array("x").alias("met"))
    lines = later.filter("size(met) > 0").select("doc_id", "mark", "met").unionByName(repeated).select("doc_id", "mark", F.explode(_covered("met")).alias("line"))
    return lines.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set("line")).alias("removed"))


def deduped(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with text rewritten, and n_lines (non-blank) and removed added under these names with two underscores before."""
    gone = removals(docs.select("doc_id", "text"), min_words).withColumnsRenamed({"doc_id": "__id", "mark": "__mark", "removed": "__removed"})
    same = docs["doc_id"].eqNullSafe(gone["__id"]) & (F.xxhash64(docs["text"]) == gone["__mark"])
    out = docs.join(gone, same, "left").drop("__id", "__mark")
    out = out.withColumn("__rows", F.expr("split(text, '\n')"))
    out = out.withColumn("__full", F.expr(f"filter(transform(__rows, (x, i) -> if(btrim(x, '{_SPACE}') <> '', i, -1)), i -> i >= 0)"))
    kept = "array_join(transform(array_except(sequence(0, size(__rows) - 1), transform(__removed, j -> __full[j])), i -> __rows[i]), '\n')"
    text = F.expr(f"case when __removed is null then text when size(__removed) = size(__full) then '' else {kept} end")
    return out.withColumn("__n_lines", F.coalesce(F.size("__full"), F.lit(0)).cast("long")).withColumn("text", text).drop("__rows", "__full")


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the later occurrences of repeated runs; documents that lose their whole text go."""
    out = deduped(docs, min_words)
    return out.filter("not (__removed is not null and text = '')").select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    out = deduped(docs.select("doc_id", "text"))
    removed = F.coalesce("__removed", F.array().cast("array<int>"))
    return out.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        F.array_join(removed.cast("array<string>"), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = """
WITH split AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS raw FROM documents
), rows AS (
  SELECT doc_id, unnest(raw) AS line, unnest(range(len(raw))) AS p FROM split
), full_rows AS (
  SELECT doc_id, line, p, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS t FROM rows
), lines AS (
  SELECT doc_id, t, p, row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS i,
         sum(w) OVER (PARTITION BY doc_id ORDER BY p) AS upto, w
  FROM (SELECT *, len(regexp_extract_all(t, '[^ \\t\\r\\x0b\\x0c]+')) AS w FROM full_rows WHERE t <> '')
), docs AS (
  SELECT doc_id, list(t ORDER BY i) AS ts, list(upto ORDER BY i) AS us, list(w ORDER BY i) AS ws, count(*) AS n FROM lines GROUP BY doc_id
), windows AS (
  SELECT DISTINCT a.doc_id, a.i AS s, b.i AS e
  FROM lines a JOIN lines b ON a.doc_id = b.doc_id AND a.i <= b.i
  WHERE b.upto - a.upto + a.w > 50 AND (b.upto - b.w - a.upto + a.w <= 50 OR b.upto - a.upto <= 50)
), keyed AS (
  SELECT w.doc_id, s, e, list_slice(ts, s + 1, e + 1) AS run FROM windows w JOIN docs USING (doc_id)
), firsts AS (
  SELECT run, min(struct_pack(d := doc_id, s := s)) AS f FROM keyed GROUP BY run
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS i FROM keyed JOIN firsts USING (run) WHERE struct_pack(d := doc_id, s := s) > f
), removed AS (
  SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS l FROM gone GROUP BY doc_id
), kept AS (
  SELECT r.doc_id, string_agg(r.line, chr(10) ORDER BY r.p) AS text
  FROM full_rows r LEFT JOIN lines l ON l.doc_id = r.doc_id AND l.p = r.p LEFT JOIN gone g ON g.doc_id = r.doc_id AND g.i = l.i
  WHERE g.i IS NULL GROUP BY r.doc_id
)
SELECT d.doc_id, coalesce(x.n, 0)::BIGINT AS n_lines, coalesce(r.n, 0)::BIGINT AS n_removed, coalesce(r.l, '') AS removed,
       sha256(CASE WHEN r.n = x.n THEN '' WHEN r.n IS NULL THEN coalesce(d.text, '') ELSE coalesce(k.text, '') END) AS kept_sha256
FROM documents d LEFT JOIN (SELECT doc_id, n FROM docs) x USING (doc_id) LEFT JOIN removed r ON r.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
