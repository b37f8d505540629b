"""Tables of one CSS class out of page HTML, down to one row per cell.

Only the tag walk runs in Python, one page at a time.  It yields one record per table row with
the table's header rows and the row's cells; naming, role detection and unpivoting are array
expressions on that record, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.operators.reshape import with_settled

TABLE_CLASS = "wikitable"
# --- fixed values: words that give a column its role, tried in column order ----------------
INSTITUTE_WORDS = ("instituto", "contratante", "pesquisa")
PERIOD_WORDS = ("data", "período", "periodo")
SAMPLE_WORDS = ("amostra",)
MARGIN_WORDS = ("margem",)
# -------------------------------------------------------------------------------------------
ROW_SCHEMA = (
    "page_id long, table_idx int, row_idx int, headers array<array<string>>, cells array<string>"
)


class _TableWalk(HTMLParser):
    """Collects ``(is_header, text, rowspan, colspan)`` cells of the wanted tables."""

    def __init__(self, css_class: str) -> None:
        super().__init__(convert_charrefs=True)
        self.css_class, self.tables, self.open = css_class, [], []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "table":
            wanted = self.css_class in (attrs.get("class") or "").split()
            table = {"rows": [], "in_head": False, "cell": None}
            if wanted:
                self.tables.append(table)
            self.open.append(table)
        elif self.open:
            table = self.open[-1]
            if tag == "thead":
                table["in_head"] = True
            elif tag == "tr":
                table["rows"].append({"head": table["in_head"], "cells": []})
                table["cell"] = None
            elif tag in ("td", "th") and table["rows"]:
                table["cell"] = {
                    "th": tag == "th", "text": [],
                    "rows": _span(attrs.get("rowspan"), MAX_ROWSPAN), "cols": _span(attrs.get("colspan"), MAX_COLSPAN),
                }
                table["rows"][-1]["cells"].append(table["cell"])

    def handle_endtag(self, tag):
        if not self.open:
            return
        table = self.open[-1]
        if tag == "table":
            self.open.pop()
        elif tag == "thead":
            table["in_head"] = False
        elif tag in ("td", "th", "tr"):
            table["cell"] = None

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"] is not None:
            self.open[-1]["cell"]["text"].append(data)


# --- fixed values: the largest spans that HTML allows --------------------------------------
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534
# -------------------------------------------------------------------------------------------


def _span(value: str | None, most: int) -> int:
    value = (value or "").strip()
    if not (value.isascii() and value.isdigit()) or not value.strip("0"):
        return 1
    return most if len(value) > 9 else min(int(value), most)


def _tables(html: str, css_class: str) -> list[dict]:
    """Tables of the page as far as it can be read; broken declarations count as text."""
    parser = _TableWalk(css_class)
    try:
        parser.feed(html)
        parser.close()
    except AssertionError:  # what the standard parser raises on an unknown marked section
        parser = _TableWalk(css_class)
        parser.feed(re.sub(r"<!\[", "&lt;![", html))
        parser.close()
    return parser.tables


def _grid(rows: list[dict]) -> list[list[str]]:
    """Cell texts with row and column spans filled in."""
    pending: dict[int, tuple[str, int]] = {}
    grid = []
    for row in rows:
        line, cells, column = [], iter(row["cells"]), 0
        cell = next(cells, None)
        while cell is not None or column in pending:
            if column in pending:
                text, left = pending.pop(column)
                if left > 1:
                    pending[column] = (text, left - 1)
                line.append(text)
                column += 1
                continue
            text = re.sub(r"\s+", " ", "".join(cell["text"])).strip()
            for _ in range(cell["cols"]):
                if cell["rows"] > 1:
                    pending[column] = (text, cell["rows"] - 1)
                line.append(text)
                column += 1
            cell = next(cells, None)
        grid.append(line)
    return grid


def _table_rows(page_id: int, table_idx: int, rows: list[dict]) -> Iterator[tuple]:
    rows = [row for row in rows if row["cells"]]
    head = 0
    while head < len(rows) and (rows[head]["head"] or all(c["th"] for c in rows[head]["cells"])):
        head += 1
    grid = _grid(rows)
    headers = [line for line in grid[:head] if any(line)]
    width = max((len(line) for line in grid), default=0)
    pad = [line + [""] * (width - len(line)) for line in headers]
    for row_idx, line in enumerate(grid[head:]):
        yield page_id, table_idx, row_idx, pad, line + [""] * (width - len(line))


def read_table_rows(
    pages: DataFrame, id_column: str = "page_id", html_column: str = "html",
    css_class: str = TABLE_CLASS,
) -> DataFrame:
    """One record per body row of the tables of a class; pages without such text are skipped."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page_id, html in zip(batch["page_id"], batch["html"]):
                found = [
                    record
                    for index, table in enumerate(_tables(html, css_class))
                    for record in _table_rows(page_id, index, table["rows"])
                ]
                if found:
                    yield pd.DataFrame(
                        found, columns=["page_id", "table_idx", "row_idx", "headers", "cells"]
                    )

    wanted = pages.filter(F.col(html_column).contains(css_class)).select(
        F.col(id_column).cast("long").alias("page_id"), F.col(html_column).alias("html")
    )
    return wanted.mapInPandas(walk, ROW_SCHEMA)


def flat_headers(headers: Column) -> Column:
    """One name per column: its distinct header texts from top to bottom, joined by a space.

    A column that repeats all header texts of an earlier one gets ``.1``, ``.2`` on its lowest
    text.  In a single header row an empty text reads ``Unnamed: <position>``; in several rows
    empty texts are left out.
    """
    positions = F.sequence(F.lit(1), F.size(F.element_at(headers, 1)))
    columns = F.transform(
        positions,
        lambda p: F.transform(headers, lambda row: F.element_at(row, p.cast("int"))),
    )

    def name_of(texts: Column, index: Column) -> Column:
        repeats = F.size(F.filter(F.slice(columns, F.lit(1), index), lambda other: other == texts))
        lowest = F.element_at(texts, -1)
        marked = F.when((repeats > 0) & (lowest != ""), F.concat(
            lowest, F.lit("."), repeats.cast("string")
        )).otherwise(lowest)
        upper = F.slice(texts, F.lit(1), F.size(texts) - 1)
        shown = F.filter(
            F.concat(upper, F.array(marked)), lambda t: (t != "") & ~t.contains("Unnamed")
        )
        joined = F.trim(F.array_join(F.array_distinct(shown), " "))
        alone = F.when(lowest == "", F.concat(F.lit("Unnamed: "), index.cast("string")))
        return F.when(F.size(texts) == 1, F.coalesce(alone, marked)).otherwise(joined)

    return F.when(F.size(headers) > 0, F.transform(columns, name_of)).otherwise(
        F.array().cast("array<string>")
    )


def _first_with(names: Column, words: Sequence[str]) -> Column:
    """Position of the first column whose name contains one of the words; NULL if none does."""
    def hit(name: Column) -> Column:
        text = F.lower(name)
        found = text.contains(words[0])
        for word in words[1:]:
            found = found | text.contains(word)
        return found

    flags = F.transform(names, hit)
    return F.nullif(F.array_position(flags, True), F.lit(0)).cast("int")


def cells_by_role(rows: DataFrame) -> DataFrame:
    """One row per cell outside the identified roles.

    A table without an institute or a period column is skipped, as is one with no further
    column.  Of columns with the same name, the first counts.
    """
    # A repeated name keeps its first position; positions are 1-based into names and cells.
    positions = F.filter(
        F.sequence(F.lit(1), F.size("names")),
        lambda p: F.array_position(F.col("names"), F.element_at("names", p)) == p,
    )
    roles = {
        "institute_at": INSTITUTE_WORDS, "period_at": PERIOD_WORDS,
        "sample_at": SAMPLE_WORDS, "margin_at": MARGIN_WORDS,
    }
    named = with_settled(rows, {"names": flat_headers(F.col("headers"))}).filter(F.size("names") > 0)
    named = with_settled(
        named, {role: _first_with(F.col("names"), words) for role, words in roles.items()}
    )
    taken = F.array_compact(F.array(*roles))
    free = F.array_except(positions, taken)

    def cell_at(role: str) -> Column:
        return F.coalesce(F.try_element_at("cells", F.col(role)), F.lit(""))

    return (
        named.filter(F.col("institute_at").isNotNull() & F.col("period_at").isNotNull())
        .withColumn("at", F.explode(free))
        .select(
            "page_id", F.col("table_idx").cast("string").alias("tabela_idx"), "row_idx",
            cell_at("institute_at").alias("instituto_texto"),
            cell_at("period_at").alias("periodo_texto"),
            cell_at("sample_at").alias("amostra_texto"),
            cell_at("margin_at").alias("margem_texto"),
            F.element_at("names", F.col("at")).alias("coluna_candidato"),
            F.coalesce(F.try_element_at("cells", F.col("at")), F.lit("")).alias("valor_texto"),
        )
    )


def extract_html_tables(pages: DataFrame, css_class: str = TABLE_CLASS) -> DataFrame:
    """Pages to all-string cells, ready for the cleaning stage."""
    return cells_by_role(read_table_rows(pages, css_class=css_class))
