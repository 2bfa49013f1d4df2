"""Addressable blocks: lines, substantive lines, block ids, block texts and their categories.

A file's lines stay together in arrays, so that no step but the counter over
the files of a chapter moves text between tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import rules, text


def explode_lines(docs: DataFrame, keys: list[str]) -> DataFrame:
    """One row a line: the keys, line_no (from 1) and line."""
    return docs.select(*keys, F.posexplode(text.lines("text")).alias("p", "line")).select(*keys, (F.col("p") + 1).alias("line_no"), "line")


def marked_lines(docs: DataFrame, keys: list[str], extra: str = "") -> DataFrame:
    """Keys and rows: a struct of t (the stripped line), i (its place) and off (in front matter or a comment, or a fence) a line.

    The first fence opens the front matter wherever it stands and the second closes it; a comment
    runs from a line that opens it without closing it to the line that closes it.  ``extra`` names
    columns of ``docs`` to keep.
    """
    kept = [*keys, *extra.split()]
    df = docs.select(*kept, F.transform(text.lines("text"), text.strip).alias("bare"))
    # transform over an array of one member names a value, so that it is computed once
    off = "(f.one > 0 and i + 1 >= f.one and (f.two = 0 or i + 1 <= f.two))"
    # states: 1 inside a comment, 2 the line that closes it; only texts with a comment pay for the fold
    step = """case when size(a) in (f.one, f.two) then array_append(a, if(element_at(a, -1) = 1, 1, 0))
      when element_at(a, -1) = 1 then array_append(a, if(contains(x, '-->'), 2, 1))
      when startswith(x, '<!--') and not contains(x, '-->') then array_append(a, 1) else array_append(a, 0) end"""
    fold = f"slice(aggregate(b, array(0), (a, x) -> {step}), 2, size(b))"
    states = f"if(exists(b, x -> startswith(x, '<!--') and not contains(x, '-->')), {fold}, array_repeat(0, size(b)))"
    rows = f"zip_with(transform(b, (x, i) -> struct(x as t, i as i, {off} as off)), {states}, (r, c) -> struct(r.t as t, r.i as i, r.off or c > 0 as off))"
    second = "coalesce(nullif(array_position(slice(b, one + 1, size(b)), '---'), 0) + one, 0)"
    fences = f"transform(array(cast(array_position(b, '---') as int)), one -> named_struct('one', one, 'two', cast(if(one > 0, {second}, 0) as int)))"
    return df.select(*kept, F.expr(f"transform(array(bare), b -> transform({fences}, f -> {rows})[0])[0]").alias("rows"))


_COUNTS = "(not r.off and r.t <> '' and not startswith(r.t, '#') and not startswith(r.t, '```') and not startswith(r.t, '<!--'))"


def substantive_lines(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, line_no and line of the lines that carry content: no fence, front matter, comment, heading, code fence or blank."""
    rows = marked_lines(docs, keys).select(*keys, F.explode(F.expr(f"filter(rows, r -> {_COUNTS})")).alias("r"))
    return rows.select(*keys, (F.col("r.i") + 1).alias("line_no"), F.col("r.t").alias("line"))


def spread(df: DataFrame) -> DataFrame:
    """``df``, dealt out anew only where its scan has fewer tasks than the cluster has cores: rules are heavy for their bytes."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _granted(files: DataFrame) -> DataFrame:
    """slug, chapter, file, new (t and i of each line that gets an id) and highest (number of an id that exists)."""
    keys = ["slug", "chapter", "file"]
    df = marked_lines(files, keys)
    # a slug holds letters, digits, hyphens, dots and underscores only; nothing to escape but the dot
    own = "concat('\\\\^', replace(slug, '.', '[.]'), '-ch(\\\\d{2,})-(\\\\d{4,})(?![\\\\p{L}\\\\p{N}_])')"
    plain = "not exists(rows0, r -> contains(r.t, '^'))"  # no anchors at all: no pattern is needed
    mark = f"transform(rows0, r -> struct(r.t as t, r.i as i, r.off as off, not r.off and startswith(r.t, '|') as pipe, r.t rlike {own} as has, r.t rlike concat('^', {own}, '$') as only))"
    quick = "transform(rows0, r -> struct(r.t as t, r.i as i, r.off as off, not r.off and startswith(r.t, '|') as pipe, false as has, false as only))"
    # each line beside the next one
    pairs = "zip_with(m, slice(m, 2, size(m)), (r, n) -> struct(r.t as t, r.i as i, r.off as off, r.pipe as pipe, r.has as has, r.only as only, coalesce(startswith(n.t, '|'), false) as piped, coalesce(n.only, false) as closed))"
    start = "coalesce(array_max(filter(sequence(0, r.i), j -> not m[j].pipe)), -1)"
    anchored = f"r.closed or (exists(m, q -> q.has) and exists(slice(m, {start} + 2, r.i - {start}), q -> q.has))"
    grant = f"case when r.only then false when r.pipe then not r.piped and not ({anchored}) else {_COUNTS} and not r.has end"
    numbers = f"transform(flatten(transform(m, r -> regexp_extract_all(r.t, {own}, 2))), n -> cast(n as bigint))"
    new = f"transform(filter({pairs}, r -> {grant}), r -> struct(r.t as t, r.i as i))"
    both = f"named_struct('new', {new}, 'highest', if(exists(m, r -> r.has), coalesce(array_max({numbers}), 0L), 0L))"
    df = df.select(*keys, F.expr(f"transform(array(rows), rows0 -> transform(array(if({plain}, {quick}, {mark})), m -> {both})[0])[0]").alias("o"))
    return df.select(*keys, F.col("o.new").alias("new"), F.col("o.highest").alias("highest"))


def new_blocks(files: DataFrame) -> DataFrame:
    """slug, chapter, file, line_no and text of the blocks that ``annotate`` gives ids to: nothing moves."""
    out = _granted(files).select("slug", "chapter", "file", F.explode("new").alias("r"))
    return out.select("slug", "chapter", "file", (F.col("r.i") + 1).alias("line_no"), F.col("r.t").alias("text"))


def _numbered(df: DataFrame) -> DataFrame:
    """``df`` (slug, chapter, file, new, highest) with start: what the counter of the chapter has reached before the file's new blocks.

    One row a file: the counter is a running sum over the files of a chapter.
    """
    chapter = Window.partitionBy("slug", "chapter")
    before = F.sum(F.size("new")).over(chapter.orderBy("file").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.size("new")
    return df.withColumn("start", F.max("highest").over(chapter) + before)


def block_categories(files: DataFrame) -> DataFrame:
    """block_id and category of the new blocks of ``annotate``: judged where the files were read, so that only places and categories move to the counter."""
    df = _granted(files).withColumn("new", F.transform("new", lambda r: text.category(r["t"])))
    out = _numbered(df).select("slug", "chapter", "start", F.posexplode("new").alias("k", "category"))
    return out.select(text.block_id("slug", "chapter", F.col("start") + F.col("k") + 1).alias("block_id"), "category")


def shown_blocks(files: DataFrame, shown: Callable[[Column], Column]) -> DataFrame:
    """slug, chapter, file, line_no, block_id, category and text of the new blocks of ``annotate``; the text is what ``shown`` makes of it.

    Categories and shown texts are made where the files were read, so that whole texts don't move to the counter.
    """
    keys = ["slug", "chapter", "file"]
    df = _granted(files).withColumn("new", F.transform("new", lambda r: F.struct(r["i"].alias("i"), text.category(r["t"]).alias("category"), shown(r["t"]).alias("text"))))
    out = _numbered(df).select(*keys, "start", F.posexplode("new").alias("k", "r"))
    return out.select(*keys, (F.col("r.i") + 1).alias("line_no"), text.block_id("slug", "chapter", F.col("start") + F.col("k") + 1).alias("block_id"), "r.category", "r.text")


def annotate(files: DataFrame) -> DataFrame:
    """New block ids: slug, file, chapter, line_no (the block's last line), block_id, text.

    ``files`` has slug, chapter, file and text.  A run of table lines is one block, anchored after
    its last line.  Blocks that have an id keep it; the counter of a chapter goes on over its files,
    in their order, from the highest id that exists.
    """
    keys = ["slug", "chapter", "file"]
    df = _numbered(_granted(files))
    out = df.select(*keys, "start", F.posexplode("new").alias("k", "r"))
    return out.select(*keys, (F.col("r.i") + 1).alias("line_no"), text.block_id("slug", "chapter", F.col("start") + F.col("k") + 1).alias("block_id"), F.col("r.t").alias("text"))


def extract_blocks(files: DataFrame, slug: str, pattern: str | None = None) -> DataFrame:
    """The anchored blocks: keys, line_no, block_id and text.

    A block's text is the line before its anchor; a bare anchor names the nearest non-blank line above.
    """
    own = pattern or rf"\^\Q{slug}\E-ch\d{{2}}-\d{{4,}}(?![{rules.WORD}])"
    rows = files.select("file", text.lines("text").alias("raw")).select("file", F.posexplode("raw").alias("p", "line"), "raw")
    rows = rows.filter(F.col("line").rlike(own)).withColumn("id", F.explode(F.array_distinct(F.regexp_extract_all("line", F.lit(f"({own})"), 1))))
    head = text.strip(F.expr("left(line, locate(id, line) - 1)"))
    above = F.filter(F.reverse(F.slice("raw", F.lit(1), F.col("p"))), lambda x: text.strip(x) != "")
    borrowed = F.when(F.size(above) > 0, text.strip(F.get(above, F.lit(0)))).otherwise(text.strip("line"))
    return rows.select("file", (F.col("p") + 1).alias("line_no"), F.expr("substring(id, 2)").alias("block_id"), F.when(head != "", head).otherwise(borrowed).alias("text"))


def classify(blocks: DataFrame) -> DataFrame:
    """``blocks`` with category."""
    return blocks.withColumn("category", text.category("text"))


def category_pivot(blocks: DataFrame, key: str) -> DataFrame:
    """Blocks by category for each key, and their total; ``blocks`` has category."""
    counts = [F.count_if(F.col("category") == c).alias(c.split(" ")[0].lower()) for c in rules.CATEGORIES]
    return blocks.groupBy(key).agg(*counts, F.count("*").alias("total"))


def evidence_cube(blocks: DataFrame, source: str, chapter: str) -> DataFrame:
    """source, chapter, category, level, blocks and files over four groupings at once: by all three, by source and category, by source, and in all.

    ``blocks`` has category and file.  What is summed over is null, and ``level`` tells such nulls from those of the data: a bit for each
    of the three, the source's first, set where it is summed over.  The rows are read once; files count each once.
    """
    sets = [[F.col(source), F.col(chapter), F.col("category")], [F.col(source), F.col("category")], [F.col(source)], []]
    each = blocks.groupBy(source, chapter, "category", "file").agg(F.count("*").alias("n"))
    return each.groupingSets(sets, F.col(source), F.col(chapter), F.col("category")).agg(F.grouping_id().cast("long").alias("level"), F.sum("n").alias("blocks"), F.count_distinct("file").alias("files"))


def multiset_difference(expected: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """Members that either side has more often: column, missing and extra, by number; an empty result means equality."""
    both = expected.select(column, F.lit(1).alias("d")).unionAll(found.select(column, F.lit(-1).alias("d")))
    out = both.groupBy(column).agg(F.sum("d").alias("d")).filter("d <> 0")
    return out.select(column, F.greatest("d", F.lit(0)).alias("missing"), F.greatest(-F.col("d"), F.lit(0)).alias("extra"))


def duplicates(rows: DataFrame, keys: list[str], sample: str) -> DataFrame:
    """Keys that occur more than once, how often, and the smallest and largest of their ``sample`` values."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min(sample).alias("first"), F.max(sample).alias("last")).filter("n > 1")


def section_diversity(blocks: DataFrame, key: str) -> DataFrame:
    """The sorted distinct categories of each key's blocks, joined by commas, and their number."""
    found = F.array_sort(F.collect_set("category"))
    return blocks.groupBy(key).agg(F.array_join(found, ",").alias("categories"), F.size(found).cast("long").alias("n_categories"))


def evidence_share(blocks: DataFrame, key: str) -> DataFrame:
    """key, category, blocks and the category's share of the key's blocks, to four decimals."""
    counts = blocks.groupBy(key, "category").agg(F.count("*").alias("blocks"))
    return counts.withColumn("share", F.round(F.col("blocks") / F.sum("blocks").over(Window.partitionBy(key)), 4))


def balance_findings(metrics: DataFrame, body: str = "evidence_index", thin: int = 2, monopoly: float = 0.4, index_share: float = 0.6) -> DataFrame:
    """unit_id, code and category of thin citations, thin embeds, a monopoly beside thin sections, and an index that dominates.

    ``metrics`` has unit_id, category, citations, embeds and required.
    """
    unit = Window.partitionBy("unit_id")
    is_body = F.col("category") != body
    m = metrics.withColumn("in_body", F.sum(F.when(is_body, F.col("citations")).otherwise(0)).over(unit)).withColumn("in_all", F.sum("citations").over(unit))
    needed = F.col("required") & is_body
    m = m.withColumn("any_thin", F.max((needed & (F.col("citations") < thin)).cast("int")).over(unit) == 1)
    m = m.withColumn("rank", F.row_number().over(unit.orderBy(is_body.desc(), F.desc("citations"), "category")))
    codes = F.array_compact(
        F.array(
            F.when(needed & (F.col("citations") < thin), "thin_citations"),
            F.when(needed & (F.col("embeds") < thin), "thin_embeds"),
            F.when(is_body & (F.col("rank") == 1) & F.col("any_thin") & (F.round(F.try_divide("citations", "in_body"), 4) >= monopoly), "citation_monopoly_with_thin_sections"),
            F.when(~is_body & (F.round(F.try_divide("citations", "in_all"), 4) >= index_share), "evidence_index_dominates_total_citations"),
        )
    )
    return m.select("unit_id", F.explode(codes).alias("code"), "category")


def annotation_totals(files: DataFrame) -> DataFrame:
    """slug, file, added, preserved, block_ids and substantive_lines of each file, and a slug's sums under a null file.

    ``files`` has slug, chapter, file and text; preserved are the ids of the slug that a file held before.
    """
    keys = ["slug", "file"]
    added = annotate(files).groupBy(*keys).agg(F.count("*").alias("added"))
    own = F.concat(F.lit("\\^"), F.replace("slug", F.lit("."), F.lit("[.]")), F.lit(r"-ch\d{2,}-\d{4,}(?![\p{L}\p{N}_])"))
    lines = substantive_lines(files, keys).groupBy(*keys).agg(F.count("*").alias("lines"))
    held = files.select(*keys, F.size(F.array_distinct(F.regexp_extract_all("text", own, F.lit(0)))).cast("long").alias("preserved"))
    each = held.join(added, keys, "left").join(lines, keys, "left").fillna(0, ["preserved", "added", "lines"])
    sums = (F.sum(c).alias(n) for c, n in (("added", "added"), ("preserved", "preserved"), ("lines", "substantive_lines")))
    both = each.groupingSets([[F.col("slug"), F.col("file")], [F.col("slug")]], F.col("slug"), F.col("file")).agg(*sums)
    return both.withColumn("block_ids", F.col("added") + F.col("preserved"))


def annotation_issues(files: DataFrame) -> DataFrame:
    """slug, file, line_no, block_id and issue of annotated files: ids of another slug or form, of another chapter, and repeated ones.

    ``files`` has slug, chapter (null if the name tells none), file and text; a file with substantive lines and no
    id, and a slug without any, have a null id.
    """
    like = r"\^([A-Za-z0-9][A-Za-z0-9-]*-ch\d+-\d+)(?![\p{L}\p{N}_])"
    rows = files.select("slug", "chapter", "file", F.posexplode(text.lines("text")).alias("p", "line")).filter(F.contains("line", F.lit("^")))
    found = rows.select("slug", "chapter", "file", (F.col("p") + 1).alias("line_no"), F.explode(F.regexp_extract_all("line", F.lit(like), 1)).alias("block_id"))
    rest = F.when(F.startswith("block_id", F.concat("slug", F.lit("-ch"))), F.expr("substring(block_id, length(slug) + 4)")).otherwise("")
    of = F.regexp_extract(rest, r"^(\d{2})-\d{4,}$", 1)
    found = found.withColumn("of", of.try_cast("int"))
    at = ["slug", "file", "line_no", "block_id"]
    wrong = found.filter("of is null").select(*at, F.lit("another slug or form").alias("issue"))
    other = found.filter("of <> chapter").select(*at, F.lit("another chapter").alias("issue"))
    own = found.filter("of is not null")
    again = own.groupBy("slug", "block_id").agg(F.count("*").alias("n")).filter("n > 1").select("slug", F.lit(None).cast(files.schema["file"].dataType).alias("file"), F.lit(None).cast("int").alias("line_no"), "block_id", F.lit("repeated").alias("issue"))
    keys = ["slug", "file"]
    lines = substantive_lines(files, keys).select(*keys).distinct()
    bare = lines.join(own.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit(None).cast("int").alias("line_no"), F.lit(None).cast("string").alias("block_id"), F.lit("no block ids").alias("issue"))
    return wrong.union(other).union(again).union(bare)


# The sections that make up a presentation's categories, and the categories that it must have.
SECTIONS = {
    "executive_summary": ("Executive Summary",),
    "author_words": ("Author's Words",),
    "definition": ("Rich Definitions",),
    "formulas": ("Author's Formulation",),
    "examples": ("Specific Example", "Figures and Diagrams", "Implementation Details"),
    "limitations": ("Author's Warnings", "Limitations and Counter-Arguments"),
    "empirical_context": ("Historical / Empirical Context", "Calibration Data Sources"),
    "relations": ("Relations",),
    "evidence_index": ("Unit evidence corpus",),
}
REQUIRED = ("author_words", "definition", "formulas", "examples", "limitations", "relations", "evidence_index")


#: Sections that a task balances at most, but for those of one unit: its memory stays the same, however many there are.
DEALT = 1 << 17


def balance_metrics(sections: DataFrame) -> DataFrame:
    """unit_id, category, citations, unique, embeds, lines, share_total, share_body and required: what each category cites.

    ``sections`` has unit_id, header and body; every unit has all categories, and the evidence index is no body.
    Sections are dealt out once by their unit, as numbers and ids, in as many parts as ``DEALT`` asks for; all else, what
    reads the result by unit included, is done where they then are.
    """
    named = F.create_map(*(F.lit(x) for c, hs in SECTIONS.items() for h in hs for x in (h, c)))
    categories = F.array(*map(F.lit, SECTIONS))
    ids, embeds = text.block_citations("body"), text.block_embeds("body")
    full = F.size(F.filter(text.lines("body"), lambda x: text.strip(x) != ""))
    # sections of no category still name their unit; they count under a null one
    held = sections.select("unit_id", F.try_element_at(named, F.col("header")).alias("category"), ids.alias("ids"), F.size(ids).alias("n"), F.size(embeds).alias("embeds"), full.alias("lines"))
    parts = max(sections.sparkSession.sparkContext.defaultParallelism, -(-sections.count() // DEALT))
    some = held.repartition(parts, "unit_id").groupBy("unit_id", "category").agg(F.sum("n").alias("citations"), F.size(F.array_distinct(F.flatten(F.collect_list("ids")))).cast("long").alias("unique"), F.sum("embeds").alias("embeds"), F.sum("lines").alias("lines"))
    counts = ["citations", "unique", "embeds", "lines"]
    # at most a row a category
    units = some.groupBy("unit_id").agg(F.collect_list(F.struct("category", *counts)).alias("held"))
    each = units.select("unit_id", "held", F.explode(categories).alias("category"))
    own = F.filter("held", lambda x: x["category"] == F.col("category"))
    # sections of no unit cite nothing
    df = each.withColumn("own", F.when(F.col("unit_id").isNotNull(), F.get(own, F.lit(0)))).select("unit_id", "category", *(F.coalesce(F.col(f"own.{c}"), F.lit(0)).alias(c) for c in counts))
    unit = Window.partitionBy("unit_id")
    body = F.col("category") != "evidence_index"
    total, inner = F.sum("citations").over(unit), F.sum(F.when(body, F.col("citations")).otherwise(0)).over(unit)
    share = lambda whole: F.round(F.coalesce(F.try_divide("citations", whole), F.lit(0.0)), 4)
    return df.withColumn("share_total", share(total)).withColumn("share_body", F.when(body, share(inner)).otherwise(0.0)).withColumn("required", F.col("category").isin(*REQUIRED))


def index_issues(index: DataFrame, chapter: DataFrame) -> DataFrame:
    """unit_id, block_id and issue of source indexes (unit_id, block_id, category) against the chapter's blocks (unit_id, block_id).

    Ids that are missing or extra, by number; unknown categories; and units that no chapter has.
    """
    key = F.struct("unit_id", "block_id")
    diff = multiset_difference(chapter.select(key.alias("k")), index.select(key.alias("k")), "k")
    said = F.array_compact(F.array(F.when(F.col("missing") > 0, "missing from the index"), F.when(F.col("extra") > 0, "extra in the index")))
    numbers = diff.select("k.unit_id", "k.block_id", F.explode(said).alias("issue"))
    category = index.filter(~F.coalesce(F.col("category").isin(*rules.CATEGORIES), F.lit(False))).select("unit_id", "block_id", F.lit("unknown category").alias("issue"))
    unit = index.select("unit_id").distinct().join(chapter.select("unit_id").distinct(), "unit_id", "left_anti").select("unit_id", F.lit(None).cast("string").alias("block_id"), F.lit("unknown unit").alias("issue"))
    return numbers.union(category).union(unit)


def indexed_blocks(indexes: DataFrame) -> DataFrame:
    """unit_id, pos, block_id and text of the rows of written source indexes (unit_id, text).

    A row names the id in brackets and quotes its text; an index without such rows gives each id in it, as its own text.
    """
    row = r'(?md)^- \[([a-z0-9-]+-ch\d+-\d+)\] \u2014 "(.*?)"'
    ids, said = F.regexp_extract_all("text", F.lit(row), 1), F.regexp_extract_all("text", F.lit(row), 2)
    bare = F.regexp_extract_all("text", F.lit(r"(?<![\p{L}\p{N}_])([a-z0-9-]+-ch\d+-\d+)(?![\p{L}\p{N}_])"), 1)
    pairs = F.when(F.size(ids) > 0, F.arrays_zip(ids.alias("a"), said.alias("b"))).otherwise(F.arrays_zip(bare.alias("a"), bare.alias("b")))
    return indexes.select("unit_id", F.posexplode(pairs).alias("pos", "r")).select("unit_id", "pos", F.col("r.a").alias("block_id"), F.col("r.b").alias("text"))
