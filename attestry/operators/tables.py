"""HTML tables as Markdown: a scan for tags, a placement that carries the open row spans, and a renderer.

The scan knows five kinds of tag and nothing of nesting; what stands outside cells is dropped.  A
table is as wide as the columns that its fullest row asks for, and cells beyond are dropped.
Column spans are at most 1,000, as in HTML.  A table with a span that is no number is laid out
loosely: its cells in order, in rows of as many as the first one has (two at least).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

#: Columns of one cell at most.
MOST_COLUMNS = 1000
#: Widths of rendered columns.
LEAST, MOST = 3, 40

_TOKEN = re.compile(r"<!--.*?-->|<(/?)(tr|td|th|br)\b([^>]*)>|<[a-zA-Z/!?][^>]*>|([^<]+|<)", re.IGNORECASE | re.DOTALL)
_SPAN = {k: re.compile(rf"\b{k}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*))", re.IGNORECASE) for k in ("colspan", "rowspan")}


class Cell(NamedTuple):
    row: int
    text: str
    columns: int
    rows: int


def _span(attributes: str, name: str) -> int | None:
    """The number that a tag gives; 1 without one, None for what is no number."""
    found = _SPAN[name].search(attributes)
    given = next((x for x in found.groups() if x is not None), "").strip() if found else ""
    if not given:
        return 1
    return max(1, int(given)) if re.fullmatch(r"[+-]?[0-9]+", given) else None


def scanned(markup: str) -> tuple[list[Cell], int, bool]:
    """The cells in order, the number of rows, and whether all spans are numbers."""
    found: list[Cell] = []
    row, sound = -1, True
    open_: tuple[int, int] | None = None
    said: list[str] = []
    for token in _TOKEN.finditer(markup):
        closing, tag, attributes, text = token.groups()
        tag = (tag or "").lower()
        if text is not None:
            said.append(text)
        elif tag == "br":
            said.append("\n")
        elif tag == "tr" and not closing:
            row += 1
        elif tag in ("td", "th"):
            if not closing:
                spans = _span(attributes, "colspan"), _span(attributes, "rowspan")
                sound = sound and None not in spans
                open_, said = (min(MOST_COLUMNS, spans[0] or 1), spans[1] or 1), []
            elif open_ is not None:
                if row >= 0:
                    found.append(Cell(row, html.unescape("".join(said)).strip(), *open_))
                open_ = None
    return found, row + 1, sound


def placed(cells: list[Cell]) -> tuple[dict[tuple[int, int], str], int]:
    """The text at (row, column) of each cell's first place, and the width; later rows keep clear of open row spans."""
    asked: dict[int, int] = {}
    for c in cells:
        asked[c.row] = asked.get(c.row, 0) + c.columns
    width = max(asked.values(), default=0)
    held = [0] * width  # for each column, the first row that is free again
    at: dict[tuple[int, int], str] = {}
    row, column = -1, 0
    for c in cells:
        if c.row != row:
            row, column = c.row, 0
        column = next((x for x in range(column, width) if held[x] <= row), width)
        if column < width:
            at[row, column] = c.text
            until = row + c.rows
            held[column : column + c.columns] = [max(until, h) for h in held[column : column + c.columns]]
            column += c.columns
    return at, width


def _cell(value: str) -> str:
    return value.replace("|", "\\|").replace("\n", " ")


def _bar(cells: list[str]) -> str:
    return f"| {' | '.join(cells)} |"


def pipe_table(markup: str | None) -> str:
    """A Markdown pipe table without the empty rows, its columns 3 to 40 wide; empty if there is no table."""
    if not markup or "<table" not in markup.lower():
        return ""
    cells, n, sound = scanned(markup)
    if not sound:
        first = max(2, sum(c.row == cells[0].row for c in cells)) if cells else 2
        said = [c.text for c in cells] + [""] * (-len(cells) % first)
        rows = [said[k : k + first] for k in range(0, len(said), first)]
        return "\n".join([_bar(rows[0]), _bar(["-" * LEAST] * first), *map(_bar, rows[1:])]) if rows else ""
    at, width = placed(cells)
    full = sorted({y for (y, _), text in at.items() if text})
    if not full:
        return ""
    rows = [[_cell(at.get((y, x), "")) for x in range(width)] for y in full]
    sizes = [min(MOST, max(LEAST, *map(len, column))) for column in zip(*rows)]
    lines = [_bar([v.ljust(k) for v, k in zip(r, sizes)]) for r in rows]
    return "\n".join([lines[0], _bar(["-" * k for k in sizes]), *lines[1:]])


def table_column(rows: DataFrame) -> DataFrame:
    """``rows`` with md: the pipe table of an HTML content, else the content itself; in Arrow batches, as spans are carried from row to row."""
    at = rows.columns.index("content")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for c in b.column(at).to_pylist():
                s = (c or "").strip()
                whole = s.startswith("<table") and s.endswith("</table>")
                out.append((pipe_table(c) if whole else "") or c or "")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], [*b.schema.names, "md"])

    return rows.mapInArrow(batches, StructType([*rows.schema.fields, StructField("md", StringType())]))
