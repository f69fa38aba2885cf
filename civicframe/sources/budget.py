"""Budget tables: cells of a page become lines with amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicframe.functions.money import amount
from civicframe.functions.text import squeeze

#: Codes of budget lines, goals, plans and actions. Fixed values.
CODES = {"mjp": r"^MJP\d{4,}$", "bd": r"^BD\d+$", "ap": r"^AP\d+$", "ac": r"^AC\d+$"}


def cells(tables: DataFrame) -> DataFrame:
    """Rows (doc, page, row, col, cell) of tables (doc, page, rows ARRAY<ARRAY<STRING>>); row 0 is the heading."""
    rows = tables.select("doc", "page", F.posexplode("rows").alias("row", "_cells"))
    return rows.select("doc", "page", "row", F.posexplode("_cells").alias("col", "cell")).withColumn("cell", squeeze(F.coalesce("cell", F.lit(""))))


def code_columns(cell_rows: DataFrame) -> DataFrame:
    """Column of each kind of code, by content: most hits (the last column on a tie), in half of the rows and two at least."""
    body = cell_rows.where("row > 0")
    n_rows = body.groupBy("doc", "page").agg(F.count_distinct("row").alias("n_rows"))
    hits = [body.groupBy("doc", "page", "col").agg(F.count_if(F.col("cell").rlike(p)).alias("hits")).withColumn("kind", F.lit(k)) for k, p in CODES.items()]
    found = hits[0]
    for h in hits[1:]:
        found = found.unionByName(h)
    best = Window.partitionBy("doc", "page", "kind").orderBy(F.col("hits").desc(), F.col("col").desc())
    ranked = found.withColumn("rn", F.row_number().over(best)).where("rn = 1").join(n_rows, ["doc", "page"])
    return ranked.where(F.col("hits") >= F.greatest(F.lit(2), F.floor(F.col("n_rows") / 2))).select("doc", "page", "kind", "col")


def year_columns(cell_rows: DataFrame) -> DataFrame:
    """Columns whose heading has a year and whose cells are amounts, in a third of the rows and two at least."""
    head = cell_rows.where("row = 0").select("doc", "page", "col", F.regexp_extract("cell", r"\b(20\d{2})\b", 1).alias("year"), F.lower("cell").alias("head")).where("year <> ''")
    body = cell_rows.where("row > 0")
    filled = body.groupBy("doc", "page", "col").agg(F.count(amount(F.col("cell"))).alias("filled"))
    n_rows = body.groupBy("doc", "page").agg(F.count_distinct("row").alias("n_rows"))
    kind = F.when(F.contains("head", F.lit("rekening")), "rekening").when(F.contains("head", F.lit("krediet")), "krediet").otherwise("raming")
    good = head.join(filled, ["doc", "page", "col"]).join(n_rows, ["doc", "page"]).where(F.col("filled") >= F.greatest(F.lit(2), F.floor(F.col("n_rows") / 3)))
    return good.select("doc", "page", "col", F.col("year").cast("int").alias("year"), kind.alias("kind"))


def field_columns(cell_rows: DataFrame) -> DataFrame:
    """Rows (doc, page, field, col) of the first page of each document that shows codes of lines: where its fields stand.

    A code's description stands beside it, if a column is left; the entity comes first; the service is named in the heading.
    """
    maps = code_columns(cell_rows)
    first = maps.where("kind = 'mjp'").groupBy("doc").agg(F.min("page").alias("page"))
    head = cell_rows.where("row = 0").join(first, ["doc", "page"], "left_semi")
    codes = maps.join(first, ["doc", "page"], "left_semi")
    text = codes.select("doc", "page", F.concat("kind", F.lit("_text")).alias("field"), (F.col("col") + 1).alias("col")).join(head.select("doc", "page", "col"), ["doc", "page", "col"], "left_semi")
    service = head.where(F.contains(F.lower("cell"), F.lit("dienst"))).groupBy("doc", "page").agg(F.min("col").alias("col")).select("doc", "page", F.lit("service").alias("field"), "col")
    entity = first.select("doc", "page", F.lit("entity").alias("field"), F.lit(0).alias("col"))
    found = codes.select("doc", "page", F.col("kind").alias("field"), "col")
    for more in (text, service, entity):
        found = found.unionByName(more.select("doc", "page", "field", "col"))
    return found


def budget_lines(tables: DataFrame) -> DataFrame:
    """Lines (doc, code, entity, goal, plan, action, service, description, amounts): the first row of each code.

    Columns are fixed on the first page that shows codes of lines and hold for all later pages; earlier pages have none.
    Goal, plan and action are pairs (code, text); what a document has no column for is empty. Amounts have year, kind and amount,
    in the order of these.
    """
    c = cells(tables)
    fields = field_columns(c)
    first = fields.select("doc", F.col("page").alias("first_page")).distinct()
    values = c.where("row > 0").join(fields.drop("page"), ["doc", "col"]).join(first, "doc").where(F.col("page") >= F.col("first_page"))
    at = lambda f: F.coalesce(F.max(F.when(F.col("field") == f, F.col("cell"))), F.lit(""))
    pair = lambda k: F.struct(at(k).alias("code"), at(f"{k}_text").alias("text"))
    rows = values.groupBy("doc", "page", "row").agg(at("mjp").alias("code"), at("entity").alias("entity"), pair("bd").alias("goal"), pair("ap").alias("plan"), pair("ac").alias("action"), at("service").alias("service"), at("mjp_text").alias("description"))
    order = Window.partitionBy("doc", "code").orderBy("page", "row")
    lines = rows.where(F.col("code").rlike(CODES["mjp"])).withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")
    use = year_columns(c).join(first, "doc").where(F.col("page") == F.col("first_page")).select("doc", "col", "year", "kind")
    per_row = c.join(use, ["doc", "col"]).withColumn("amount", amount(F.col("cell"))).where("amount is not null").groupBy("doc", "page", "row").agg(F.sort_array(F.collect_list(F.struct("year", "kind", "amount"))).alias("amounts"))
    return lines.join(per_row, ["doc", "page", "row"], "left").drop("page", "row")
