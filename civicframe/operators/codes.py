"""Codes in texts and the graph of items that they link."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Forms of budget, file and permit codes. Fixed values.
PATTERNS = {
    "mjp": r"(\bMJP\d{4,}\b)",
    "zaak": r"(?i)(\b20\d\d[_-](?:GR|CBS|VB|RMW|OCMW|BURG)[_-]\d+\b)",
    "omv": r"(?i)(\bOMV[_/]?\d{6,}\b)",
}


def mined(items: DataFrame, id_col: str, text: Column, patterns: dict[str, str] = PATTERNS) -> DataFrame:
    """Distinct rows (kind, code, item) of all codes in a text, in upper case with underscores."""
    rows = [items.select(F.lit(kind).alias("kind"), F.explode(F.regexp_extract_all(text, F.lit("(?U)" + p), F.lit(1))).alias("code"), F.col(id_col).alias("item")) for kind, p in patterns.items()]
    return reduce(DataFrame.unionByName, rows).select("kind", F.translate(F.upper("code"), "/-", "__").alias("code"), "item").distinct()


def linking(edges: DataFrame, least: int = 2) -> DataFrame:
    """Rows (kind, code, n_items, item) of the codes of ``least`` items or more; a code of any size is spread over rows."""
    counted = edges.groupBy("kind", "code").agg(F.count("*").alias("n_items")).where(F.col("n_items") >= least)
    return edges.join(counted, ["kind", "code"]).select("kind", "code", "n_items", "item")


def link_graph(edges: DataFrame, least: int = 2, *, row_items: int = 10_000) -> DataFrame:
    """The published graph: rows (kind, code, part, items) of codes of ``least`` items or more, items sorted.

    A code of more than ``row_items`` items has several rows, numbered by ``part``, so no code is one huge list.
    """
    held = linking(edges, least)
    parts = F.ceil(F.col("n_items") / row_items)
    return held.withColumn("part", F.pmod(F.xxhash64("item"), parts).cast("int")).groupBy("kind", "code", "part").agg(F.sort_array(F.collect_list("item")).alias("items"))


def related(edges: DataFrame, *, wide: int = 40) -> DataFrame:
    """Items that share a code. Rows (a, b, kind, code, n).

    For codes of up to ``wide`` items, pairs a < b with the number of such codes they share (kind and code null). A
    code of more items relates all of them: one row for each item (b null), with the code and its number of items.
    """
    held = linking(edges)
    short = held.where(F.col("n_items") <= wide)
    other = short.select("kind", "code", F.col("item").alias("b"))
    pairs = short.select("kind", "code", F.col("item").alias("a")).join(other, ["kind", "code"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))
    members = held.where(F.col("n_items") > wide).select(F.col("item").alias("a"), F.lit(None).cast(edges.schema["item"].dataType).alias("b"), "kind", "code", F.col("n_items").alias("n"))
    null = F.lit(None).cast("string")
    return pairs.select("a", "b", null.alias("kind"), null.alias("code"), "n").unionByName(members)
