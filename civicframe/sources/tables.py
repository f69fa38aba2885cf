"""Tables of HTML pages as rows of cells, and the result tables of search pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.functions.text import fold, squeeze

#: What a heading must hold, and the field that its column is. Fixed values.
RESULT_FIELDS = {
    "bestuursorgaan": "organ",
    "datum zitting": "session",
    "document type": "doctype",
    "titel": "title",
    "documenten": "documents",
    "publicatie datum": "published",
}

CELL = "table int, row int, col int, head boolean, body boolean, text string, links array<string>"


class _Cells(HTMLParser):
    """Cells of the tables of a page, each table by itself; tables inside cells are tables of their own.

    A cell or row ends where the next one begins, also without its closing tag. A cell over several columns or rows fills its
    first place only; the other places are skipped, so that columns keep their numbers.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[dict] = []
        self.open: list[dict] = []
        self.hidden = 0

    def _end_cell(self, t: dict) -> None:
        if (c := t["cell"]) is not None:
            t["cells"].append((t["number"], t["row"], c["col"], c["head"], t["body"], " ".join("".join(c["text"]).split()), c["links"]))
            t["cell"] = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("script", "style"):
            self.hidden += 1
        if tag == "table":
            self.open.append({"number": len(self.tables), "row": -1, "cell": None, "body": False, "cells": [], "taken": {}})
            self.tables.append(self.open[-1])
        if not self.open:
            return
        t, given = self.open[-1], dict(attrs)
        if tag in ("tr", "tbody", "thead", "tfoot"):
            self._end_cell(t)
            if tag == "tr":
                t["row"] += 1
            else:
                t["body"] = tag == "tbody"
        elif tag in ("td", "th"):
            self._end_cell(t)
            t["row"] = max(t["row"], 0)
            col = 0
            while (t["row"], col) in t["taken"]:
                col += 1
            wide, deep = (min(int(v), 1000) if (v := (given.get(k) or "1").strip()).isdecimal() and int(v) else 1 for k in ("colspan", "rowspan"))
            t["taken"].update({(t["row"] + r, col + c): True for r in range(deep) for c in range(wide)})
            t["cell"] = {"col": col, "head": tag == "th", "text": [], "links": []}
        elif tag == "a" and t["cell"] is not None and (given.get("href") or "").strip():
            t["cell"]["links"].append(given["href"].strip())
        elif tag in ("br", "p", "div", "li"):
            self.handle_data(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.hidden = max(self.hidden - 1, 0)
        if self.open and tag in ("td", "th", "tr", "tbody", "thead", "tfoot", "table"):
            self._end_cell(self.open[-1])
            if tag in ("tbody", "thead", "tfoot"):
                self.open[-1]["body"] = False
            if tag == "table":
                self.open.pop()

    def handle_data(self, data: str) -> None:
        if not self.hidden and self.open and self.open[-1]["cell"] is not None:
            self.open[-1]["cell"]["text"].append(data)


@F.udtf(returnType=CELL)
class html_cells:
    """Table function: the cells of all tables of a page, in order. A null page has none."""

    def eval(self, html: str) -> Iterator[tuple]:
        if html is None:
            return
        parser = _Cells()
        parser.feed(html)
        parser.close()
        while parser.open:
            parser.handle_endtag("table")
        for t in parser.tables:
            yield from t["cells"]


def table_cells(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Rows (page, table, row, col, head, body, text, links) of the tables of ``pages``; only pages with a table leave the JVM."""
    some = pages.where(F.col(html).rlike("(?i)<table")).select(F.col(key).alias("page"), F.col(html).alias("_html"))
    return some.lateralJoin(html_cells(F.col("_html").outer())).drop("_html")


def field_of(heading: Column) -> Column:
    """The field of a heading by the last known name that it holds, accents and case aside; null if it holds none."""
    plain = squeeze(fold(heading))
    names = [F.when(F.contains(plain, F.lit(name)), field) for name, field in RESULT_FIELDS.items()]
    return F.coalesce(*reversed(names))


def search_results(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Rows (page, row, organ, session, doctype, title, published, links) of the result table of each page.

    The result table is the first one of which some headings (cells of the first row, or heading cells of any) name organ and title; its rows
    are those of its body, or all but the first. Missing fields are empty; rows with neither organ nor title go.
    """
    cells = table_cells(pages, key, html)
    heads = cells.where("row = 0 or head").select("page", "table", "col", "row", field_of(F.col("text")).alias("field")).where("field is not null")
    columns = heads.groupBy("page", "table", "col").agg(F.max_by("field", "row").alias("field"))
    known = columns.groupBy("page", "table").agg(F.collect_set("field").alias("fields")).where("array_contains(fields, 'organ') and array_contains(fields, 'title')")
    first = known.groupBy("page").agg(F.min("table").alias("table"))
    mine = cells.join(first, ["page", "table"]).join(columns, ["page", "table", "col"])
    bodies = cells.where("body and not head").select("page", "table").distinct().withColumn("has_body", F.lit(True))
    rows = mine.join(bodies, ["page", "table"], "left").where("not head").where(F.when(F.col("has_body"), F.col("body")).otherwise(F.col("row") > 0))
    value = lambda f: F.coalesce(F.max(F.when(F.col("field") == f, F.col("text"))), F.lit("")).alias(f)
    links = F.flatten(F.transform(F.sort_array(F.collect_list(F.when(F.col("field") == "documents", F.struct("col", "links")))), lambda s: s["links"]))
    found = rows.groupBy("page", "row").agg(*(value(f) for f in ("organ", "session", "doctype", "title", "published")), links.alias("links"))
    return found.where("organ <> '' or title <> ''")
