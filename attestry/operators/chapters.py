"""Chapters: boundaries from headings, their normal form, and units of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from ..sources.scratch import materialize

# Titles that open no chapter.
NO_CHAPTERS = ("acknowledgments", "acknowledgements", "about the author", "contents", "index", "notes", "figures", "tables")
METHODS = ("doc-title", "plain-text-chapter", "spaced-ocr-chapter")


def normal_boundaries(boundaries: DataFrame, sizes: DataFrame) -> DataFrame:
    """``boundaries`` (slug, chapter, title, line_start from 0, line_end or null) with ends, and an issue where they clash.

    ``sizes`` has slug and line_count; a missing end is the next start, or the end of the file.
    """
    along = Window.partitionBy("slug").orderBy("line_start")
    df = boundaries.join(sizes, "slug").withColumn("next", F.coalesce(F.lead("line_start").over(along), F.col("line_count")))
    df = df.withColumn("again", F.lag("line_start").over(along) == F.col("line_start")).withColumn("line_end", F.coalesce("line_end", "next"))
    issue = F.when(F.col("again"), "duplicate start").when(F.col("line_end") > F.col("next"), "overlaps the following chapter").when(F.col("line_end") <= F.col("line_start"), "empty")
    return df.withColumn("issue", issue).drop("next", "again", "line_count")


def detect_boundaries(lines: DataFrame) -> DataFrame:
    """slug, method, chapter, title and line_start (from 0) by the first method that finds two chapters or more.

    ``lines`` has slug, line_no (from 1) and line.
    """
    along = Window.partitionBy("slug").orderBy("line_no")
    clean = text.clean_title("line")
    usable = F.when((clean != "") & ~F.lower(clean).startswith("div align") & ~clean.startswith("/"), clean)
    long = F.when(F.length(clean) > 2, clean)
    df = lines.withColumn("clean", clean)
    df = df.withColumn("after7", F.first(usable, ignorenulls=True).over(along.rowsBetween(1, 7)))
    df = df.withColumn("after5", F.first(long, ignorenulls=True).over(along.rowsBetween(1, 5)))
    plain = r"(?i)^Chapter\s+(\d+)[:\s\-]*(.+)?$"
    spaced = r"(?i)C\s*H\s*A\s*P\s*T\s*E\s*R\s+(\d+)"
    found = [
        df.filter(F.col("line").contains(":doc_title") & F.col("after7").isNotNull() & ~F.lower("after7").isin(*NO_CHAPTERS)).select("slug", F.lit(0).alias("m"), F.lit(None).cast("int").alias("chapter"), F.col("after7").alias("title"), "line_no"),
        df.filter(F.col("clean").rlike(plain)).select("slug", F.lit(1), F.regexp_extract("clean", plain, 1).cast("int"), text.clean_title(F.regexp_extract("clean", plain, 2)), "line_no"),
        df.filter(F.col("line").rlike(spaced)).select("slug", F.lit(2), F.regexp_extract("line", spaced, 1).cast("int"), F.coalesce("after5", F.lit("")), "line_no"),
    ]
    every = found[0].union(found[1]).union(found[2])
    every = every.withColumn("chapter", F.coalesce("chapter", F.row_number().over(Window.partitionBy("slug", "m").orderBy("line_no"))))
    first = every.withColumn("k", F.row_number().over(Window.partitionBy("slug", "m", "chapter").orderBy("line_no"))).filter("k = 1")
    first = first.withColumn("n", F.count("*").over(Window.partitionBy("slug", "m"))).filter("n >= 2")
    first = first.withColumn("best", F.min("m").over(Window.partitionBy("slug"))).filter("m = best")
    title = F.when(F.col("title") == "", F.concat(F.lit("Chapter "), F.col("chapter"))).otherwise(F.col("title"))
    return first.select("slug", F.array(*map(F.lit, METHODS))[F.col("m")].alias("method"), "chapter", title.alias("title"), (F.col("line_no") - 1).alias("line_start"))


def chapter_files(boundaries: DataFrame) -> DataFrame:
    """``boundaries`` with file (the stem) and unit_id."""
    kind = F.coalesce("kind", F.lit("chapter")) if "kind" in boundaries.columns else F.lit("chapter")
    out = boundaries.withColumn("file", text.file_stem("title", "chapter", kind))
    return out.withColumn("unit_id", text.unit_id("chapter", "file"))


def discover_units(files: DataFrame) -> DataFrame:
    """slug, file, chapter_num, part_num, unit_id, and whether another file has the same unit; ``files`` has slug and file.

    ``in_order`` sorts them.
    """
    stem = F.regexp_replace(text.basename("file"), r"\.md$", "")
    part = F.regexp_extract(stem, r"(?i)(?:^|[-_])part[-_]?(\d+)(?:[-_]|$)", 1).try_cast("int")
    bare = text.is_bare_part(stem)
    unit = F.when(bare, F.concat(F.lit("ch00-part"), text.two_digits(part, 3))).otherwise(text.unit_id(text.chapter_number(stem), stem))
    out = files.filter(F.col("file").endswith(".md") & ~F.col("file").contains(".orig.")).select("slug", "file", text.chapter_number(stem).alias("chapter_num"), part.alias("part_num"), unit.alias("unit_id"))
    out = out.filter("chapter_num is not null")
    return out.withColumn("ambiguous", F.count("*").over(Window.partitionBy("slug", "unit_id")) > 1)


def in_order(units: DataFrame) -> DataFrame:
    """Units by slug, chapter, part (whole chapters first) and id, as a total order over partitions."""
    return units.orderBy("slug", "chapter_num", F.coalesce("part_num", F.lit(0)), "unit_id")


def split_points(blank: list[bool], max_lines: int, window: int) -> list[int]:
    """Ends of slices of at most ``max_lines`` lines, each after the last blank line of its last ``window`` lines, if any."""
    ends, at, n = [], 0, len(blank)
    while n - at > max_lines:
        target = at + max_lines
        cut = next((i for i in range(target, max(at, target - window - 1), -1) if blank[i - 1]), target)
        ends.append(cut)
        at = cut
    return [*ends, n] if n or not ends else ends


#: Lines that the front matter of a part takes.
METADATA = 12


def size_split(docs: DataFrame, key: str, max_lines: int = 2000, window: int = 100, metadata: int = METADATA) -> DataFrame:
    """key, part (from 1), line_start (from 1) and line_end of the parts of each text; parts never overlap.

    A text of at most ``max_lines`` lines is one part.  Longer ones are cut into parts that leave
    ``metadata`` lines for their front matter, so that no written part exceeds the limit.  Where a part
    ends depends on where the one before it did, so that each text is cut in one go, in Arrow batches
    of its blank-line flags.
    """
    if max_lines <= metadata + 1:
        raise ValueError(f"{max_lines} lines leave no room for a body")
    flags = docs.select(key, F.transform(text.lines("text"), lambda x: text.strip(x) == "").alias("blank"))
    span = pa.list_(pa.struct([("part", pa.int64()), ("line_start", pa.int64()), ("line_end", pa.int64())]))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for blank in b.column(1).to_pylist():
                blank = blank or []
                ends = split_points(blank, max_lines if len(blank) <= max_lines else max_lines - metadata, window)
                out.append([{"part": k + 1, "line_start": s + 1, "line_end": e} for k, (s, e) in enumerate(zip([0, *ends], ends))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, span)], [key, "parts"])

    kind = flags.schema[key].dataType.simpleString()
    cut = flags.mapInArrow(batches, f"{key} {kind}, parts array<struct<part:bigint,line_start:bigint,line_end:bigint>>")
    return cut.select(key, F.inline("parts"))


def source_ranges(parts: DataFrame) -> DataFrame:
    """``parts`` (line_start from 1, line_end, source_lines as first-last) with source_lines of the part: lines of the source book.

    Without a range the value stays as it is, or becomes unknown.
    """
    first = F.regexp_extract("source_lines", r"(\d+)\s*-\s*\d+", 1).try_cast("long")
    start = F.col("line_start") - 1
    own = F.concat_ws("-", first + start, first + F.greatest(F.col("line_end") - 1, start))
    return parts.withColumn("source_lines", F.when(first.isNotNull(), own).otherwise(F.coalesce("source_lines", F.lit("unknown"))))


def part_texts(docs: DataFrame, parts: DataFrame, slug: str) -> DataFrame:
    """file, part and text of each part of split chapters, with its front matter.

    ``docs`` has file (name.md), chapter, title, source_lines, page_range, ingested and text (the body); ``parts`` file, part, line_start and line_end.
    """
    numbered = parts.join(parts.groupBy("file").agg(F.max("part").alias("of")), "file").filter("of > 1")
    df = source_ranges(numbered.join(docs, "file"))
    stem = F.regexp_replace("file", r"\.md$", "")
    name = F.concat(stem, F.lit("_part"), text.two_digits("part"), F.lit(".md"))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    title = F.concat(F.coalesce("title", F.regexp_replace(stem, "[-_]", " ")), F.lit(" (part "), text.two_digits("part"), F.lit(")"))
    fields = {
        "source": quoted(F.lit(f"[[{slug}]]")), "chapter": F.col("chapter").cast("string"), "unit_id": quoted(F.concat(F.lit("ch"), text.two_digits("chapter"), F.lit("-part"), text.two_digits("part"))),
        "title": quoted(title), "source_lines": quoted(F.col("source_lines")), "page_range": quoted(F.coalesce("page_range", F.lit("unknown"))),
        "ingested": F.col("ingested").cast("string"), "phase_3_2_split_from": quoted(F.col("file")), "phase_3_2_part": quoted(F.concat_ws("/", "part", "of")),
    }
    head = F.concat(F.lit("---\n"), *(x for k, v in fields.items() for x in (F.lit(f"{k}: "), v, F.lit("\n"))), F.lit("---\n"))
    body = F.array_join(F.slice(text.lines("text"), F.col("line_start").cast("int"), (F.col("line_end") - F.col("line_start") + 1).cast("int")), "\n")
    return df.select(name.alias("file"), "part", F.concat(head, body, F.lit("\n")).alias("text"))


def oversized(units: DataFrame, max_lines: int = 2000) -> DataFrame:
    """Units over the limit, and whether they are parts already, which may not be split again."""
    return units.filter(F.col("line_count") > max_lines).withColumn("nested", F.col("unit_id").contains("-part"))


def boundary_issues(boundaries: DataFrame, sizes: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """slug, title and issue of given boundaries (slug, title, line_start from 1, line_end or null) that can't be used.

    ``sizes`` has slug and line_count, ``expected`` slug and units: a clash of their number has a null title.
    """
    df = boundaries.join(sizes, "slug")
    start, end, last = F.col("line_start"), F.col("line_end"), F.col("line_count")
    issue = F.when(F.coalesce(text.strip("title"), F.lit("")) == "", "missing title").when(start.isNull() | (start < 1) | (start > last), "invalid line_start").when((end < start) | (end > last), "invalid line_end")
    out = df.select("slug", "title", issue.alias("issue")).filter("issue is not null")
    if expected is None:
        return out
    counted = expected.join(boundaries.groupBy("slug").agg(F.count("*").alias("n")), "slug", "left").filter("units <> coalesce(n, 0)")
    return out.unionByName(counted.select("slug", F.lit(None).cast("string").alias("title"), F.lit("unit count differs").alias("issue")))


def manifest_issues(manifest: DataFrame, files: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """slug, file and issue where a manifest (slug, file), the files there are and their units disagree.

    ``files`` has slug and file, ``expected`` slug and units; issues of numbers have a null file.
    """
    listed, there = manifest.select("slug", "file"), files.select("slug", "file").distinct()
    nameless = listed.filter("coalesce(file, '') = ''").select("slug", "file", F.lit("entry without file").alias("issue"))
    absent = listed.filter("file <> ''").join(there, ["slug", "file"], "left_anti").select("slug", "file", F.lit("file missing").alias("issue"))
    units = discover_units(there)
    extra = units.select("slug", "file").join(listed, ["slug", "file"], "left_anti").select("slug", "file", F.lit("unit not listed").alias("issue"))
    number = lambda df, name: df.groupBy("slug").agg(F.count("*").alias(name))
    sums = number(listed, "entries").join(number(units, "found"), "slug", "full_outer").fillna(0, ["entries", "found"])
    wanted = F.lit(None).cast("long")
    if expected is not None:
        sums, wanted = sums.join(expected.select("slug", "units"), "slug", "full_outer").fillna(0, ["entries", "found"]), F.col("units")
    issues = F.array_compact(F.array(F.when(F.col("entries") == 0, "no chapters"), F.when(F.col("found") == 0, "no units"), F.when(F.col("entries") != F.col("found"), "entries and units differ"), F.when(F.col("entries") != wanted, "expected units differ")))
    counts = sums.select("slug", F.lit(None).cast("string").alias("file"), F.explode(issues).alias("issue"))
    return nameless.unionByName(absent).unionByName(extra).unionByName(counts)


#: Pages and bytes that one reading takes at most.
CHUNK_PAGES, CHUNK_BYTES = 100, 45 << 20


def chunk_plan(pages: DataFrame, key: str, order: str, size: str, max_pages: int = CHUNK_PAGES, max_bytes: int = CHUNK_BYTES) -> DataFrame:
    """key, chunk (from 1), first, last (pages from 1, in ``order``), bytes and too_large of the chunks that each book is read in.

    A chunk takes ``max_pages`` pages or what is left; while it is over ``max_bytes``, its last page moves to one before the
    middle, and a single page stays, however large.  Where a chunk would end is found for every page at once, from sums of
    sizes.  Which pages begin a chunk is found by jumps of doubled length from the first one: as many rounds of joins as the
    largest number of chunks has binary digits.  Null sizes are 0, null keys are no books.
    """
    own = Window.partitionBy(key).orderBy(order)
    rows = pages.filter(F.col(key).isNotNull()).select(key, order, F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"))
    rows = rows.select(key, F.row_number().over(own).alias("first"), F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), "size")
    ahead = Window.partitionBy(key).orderBy("first").rowsBetween(0, max_pages - 1)
    rows = rows.withColumn("sums", F.collect_list("upto").over(ahead))
    fits = f"sums[d] - upto + size <= {max_bytes}"
    rounds = max_pages.bit_length() + 1
    span = F.expr(f"aggregate(sequence(1, {rounds}), size(sums) - 1, (d, k) -> if(d <= 0 or {fits}, d, greatest(0, cast(d div 2 as int) - 1)))")
    rows = rows.withColumn("d", span.cast("int"))
    ends = materialize(rows.select(key, "first", (F.col("first") + F.col("d")).alias("last"), F.expr("sums[d] - upto + size").alias("bytes")))
    jump = ends.select(key, "first", (F.col("last") + 1).alias("next"))
    begun = ends.filter("first = 1").select(key, "first")
    left = begun
    while not left.isEmpty():
        step = begun.join(jump, [key, "first"]).select(key, F.col("next").alias("first"))
        found = materialize(step.join(ends.select(key, "first"), [key, "first"], "left_semi").union(begun).distinct())
        left, begun = found.join(begun, [key, "first"], "left_anti"), found
        on = jump.select(key, F.col("first").alias("next"), F.col("next").alias("further"))
        jump = materialize(jump.join(on, [key, "next"]).select(key, "first", F.col("further").alias("next")))
    chunk = F.row_number().over(Window.partitionBy(key).orderBy("first"))
    return ends.join(begun, [key, "first"]).select(key, chunk.alias("chunk"), "first", "last", "bytes", (F.col("bytes") > max_bytes).alias("too_large"))
