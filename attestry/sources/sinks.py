"""Sinks: tables, append-only events, Markdown files and index entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, by: list[str] | None = None, replace: bool = False) -> None:
    """A Parquet table that appears as a whole; an existing one is only replaced when asked to."""
    writer = df.write.mode("overwrite" if replace else "errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def append_events(events: DataFrame, path: str) -> None:
    """Appends JSON lines; null fields are left out."""
    events.write.mode("append").option("ignoreNullFields", "true").json(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Appends log lines of at (timestamp), action, subject and actor."""
    line = F.concat(F.lit("## ["), F.date_format("at", "yyyy-MM-dd HH:mm"), F.lit("] "), F.concat_ws(" | ", "action", "subject", "actor"))
    rows.select(line.alias("value")).write.mode("append").text(path)


def write_markdown(pages: DataFrame, path: str) -> None:
    """One folder a page (by name), each with its text."""
    pages.select("name", F.col("markdown").alias("value")).repartition("name").write.partitionBy("name").text(path)


def table_cell(c: Column) -> Column:
    """A value inside a Markdown table."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\|", r"\\|"), r"\s*\n\s*", " ")


def markdown_table(df: DataFrame, order: list[str]) -> DataFrame:
    """One row with the Markdown table of a report; for reports of a bounded size."""
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *(table_cell(F.col(c)) for c in df.columns)), F.lit(" |"))
    head = f"| {' | '.join(df.columns)} |\n| {' | '.join('---' for _ in df.columns)} |"
    rows = df.select(F.struct(*order, row.alias("r")).alias("x")).agg(F.array_sort(F.collect_list("x")).alias("x"))
    return rows.select(F.concat(F.lit(head + "\n"), F.array_join(F.transform("x", lambda r: r["r"]), "\n")).alias("markdown"))


def write_json(df: DataFrame, path: str, replace: bool = False) -> None:
    """JSON lines with their keys in order; the commit makes them appear as a whole."""
    df.select(*sorted(df.columns)).write.mode("overwrite" if replace else "errorifexists").option("ignoreNullFields", "false").json(path)


def append_gate(gates: DataFrame, path: str) -> None:
    """Appends rows of slug, phase, status and at; the last one counts."""
    gates.select("slug", "phase", "status", "at").write.mode("append").parquet(path)


def latest_gates(gates: DataFrame) -> DataFrame:
    """The last row of each slug and phase."""
    last = gates.groupBy("slug", "phase").agg(F.max(F.struct("at", "status")).alias("r"))
    return last.select("slug", "phase", "r.status", "r.at")


def write_chapters(chapters: DataFrame, path: str, force: bool = False) -> None:
    """Chapter files (slug, file, chapter, title, source_lines, text) with front matter, a folder a slug; an existing target is refused unless forced."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    head = F.concat(F.lit('---\nsource: "[['), "slug", F.lit(']]"\nchapter: '), "chapter", F.lit("\ntitle: "), quoted("title"), F.lit("\nsource_lines: "), quoted("source_lines"), F.lit("\n---\n\n"))
    writer = chapters.select("slug", "file", F.concat(head, "text").alias("value")).write.mode("overwrite" if force else "errorifexists")
    writer.partitionBy("slug", "file").text(path)


def index_with(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """The index's entries (stem) and those of the pages it lacks."""
    return entries.select("stem").union(pages.select("stem").join(entries, "stem", "left_anti")).distinct()


#: A new index, up to its section of concepts.
EMPTY_INDEX = "# Index\n\n> Last updated: |\n\n## Extracted Concepts\n"


def rebuilt_index(index: DataFrame, pages: DataFrame, day: str, new: str = EMPTY_INDEX) -> DataFrame:
    """markdown: the index (text, one row or none) with its section of concepts replaced by all pages (stem) and its date and count set.

    Other sections stay; without that section it comes last, and without an index ``new`` is one.  The index is one text, so that its entries meet in one row.
    """
    stems = pages.select("stem").distinct().agg(F.array_sort(F.collect_list("stem")).alias("stems"))
    old = index.agg(F.coalesce(F.first("text"), F.lit(new)).alias("text"))
    df = old.join(F.broadcast(stems))
    stamped = F.regexp_replace("text", r"(?m)\A((?:(?!^> Last updated:)[\s\S])*)^> Last updated:.*$", F.concat(F.lit("$1> Last updated: "), F.lit(day), F.lit(" | "), F.size("stems"), F.lit(" concept pages")))
    section = F.concat(F.lit("## Extracted Concepts\n"), F.array_join(F.transform("stems", lambda s: F.concat(F.lit("- [["), s, F.lit("]]"))), "\n"), F.lit("\n"))
    parts = F.split(stamped, r"(?m)^(?=## )")
    own = lambda p: p.rlike(r"\A## Extracted Concepts\s*(\n|\z)")
    first = F.array_position(F.transform(parts, own), F.lit(True))
    replaced = F.array_join(F.transform(parts, lambda p, i: F.when(i + 1 == first, section).otherwise(p)), "")
    added = F.concat(F.rtrim(F.regexp_replace(stamped, r"\s+\z", "")), F.lit("\n\n"), section)
    return df.select(F.concat(F.regexp_replace(F.when(first > 0, replaced).otherwise(added), r"\s+\z", ""), F.lit("\n")).alias("markdown"))
