"""Parsers over documents whose every line comes from the rows of a table: the parsed rows must be these rows again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicframe.plans.registry import query, table
from civicframe.sources import lines, votes

#: A number for each line of an order: its line numbers repeat. In SQL and in Spark the same order of columns.
_NUMBERED = """
    n AS (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS n FROM lineitem
    )
"""


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus")
    return table(spark, sf_dir, "lineitem").withColumn("n", F.row_number().over(order))


def _documents(rows: DataFrame, line: Column, head: str) -> DataFrame:
    """One document (doc, text) an order: ``head`` and the lines of its rows in their order."""
    texts = F.transform(F.sort_array(F.collect_list(F.struct("n", line.alias("t")))), lambda x: x["t"])
    return rows.groupBy(F.col("l_orderkey").alias("doc")).agg(F.concat(F.lit(head + "\n"), F.array_join(texts, "\n")).alias("text"))


@query(
    f"""
    WITH {_NUMBERED}
    SELECT l_orderkey AS doc, CASE WHEN l_tax < 0.01 THEN 'TP' || n ELSE CAST(n AS VARCHAR) END AS number,
           CASE WHEN l_tax < 0.01 THEN '' ELSE 'RUBRIEK ' || l_returnflag END AS category, CASE WHEN l_tax < 0.01 THEN 'toegevoegd' ELSE 'gewoon' END AS type,
           CASE WHEN l_tax < 0.01 THEN 'Lid ' || l_suppkey END AS submitter,
           'Levering van deel ' || l_partkey || CASE WHEN l_linestatus = 'F' THEN ' in ' || CAST(l_quantity AS INT) || ' stuks, zie regel 2027. Vervolg' ELSE '' END AS title,
           CASE l_returnflag WHEN 'A' THEN 'Goedgekeurd' WHEN 'R' THEN 'Verdaagd' ELSE 'Aktename' END AS result
    FROM n
    """
)
def decision_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines written as decision lists, with titles over two lines, added items and page heads between, and parsed."""
    rows = _numbered(spark, sf_dir)
    part, pieces = F.col("l_partkey").cast("string"), F.col("l_quantity").cast("int").cast("string")
    number = F.col("n").cast("string")
    ordinary = F.concat(number, F.lit(". RUBRIEK "), "l_returnflag", F.lit(". Levering van deel "), part)
    added = F.concat(F.lit("TP"), number, F.lit(". TOEGEVOEGD PUNT. Lid "), F.col("l_suppkey").cast("string"), F.lit(" - Levering van deel "), part)
    more = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("\nin "), pieces, F.lit(" stuks, zie regel\nBeslissingenlijst 3\n2027. Vervolg"))).otherwise("")
    result = F.when(F.col("l_returnflag") == "A", "Goedgekeurd").when(F.col("l_returnflag") == "R", "Verdaagd").otherwise("Aktename")
    text = F.concat(F.when(F.col("l_tax") < 0.01, added).otherwise(ordinary), more, F.lit("\n"), result)
    docs = _documents(rows, text, "BESLISSINGENLIJST\nniet hier\nOpenbare zitting")
    return lines.parse_decisions(docs).select("doc", "number", "category", "type", "submitter", "title", "result")


@query(
    f"""
    WITH {_NUMBERED},
    v AS (SELECT *, CAST(l_quantity AS INT) % 20 + 1 AS voor, l_partkey % 20 + 1 AS tegen FROM n)
    SELECT l_orderkey AS doc, CAST(n AS VARCHAR) AS number, 'RUBRIEK ' || l_returnflag AS category, 'Deel ' || l_partkey AS title,
           CASE l_returnflag WHEN 'A' THEN 'eenparig' WHEN 'R' THEN 'geteld' ELSE 'geen' END AS modus,
           CAST(CASE l_returnflag WHEN 'R' THEN voor ELSE -1 END AS INT) AS voor, CAST(CASE l_returnflag WHEN 'R' THEN tegen ELSE -1 END AS INT) AS tegen,
           CASE WHEN l_linestatus = 'O' THEN 'Nagaan voor ' || l_suppkey || ' of het kan.' ELSE '' END AS promises
    FROM v
    """
)
def minutes_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines written as minutes, with votes of their own counts, names between them, and promises that run on over a page foot."""
    rows = _numbered(spark, sf_dir)
    number, part = F.col("n").cast("string"), F.col("l_partkey").cast("string")
    counted = F.concat((F.col("l_quantity").cast("int") % 20 + 1).cast("string"), F.lit(" stemmen voor (A Bee, C Dee) en\n3 maart 2026\n"), (F.col("l_partkey") % 20 + 1).cast("string"), F.lit(" stemmen tegen (E Eff)"))
    vote = F.when(F.col("l_returnflag") == "A", "Goedgekeurd met eenparigheid van stemmen").when(F.col("l_returnflag") == "R", counted).otherwise("Het punt wordt besproken")
    promise = F.when(F.col("l_linestatus") == "O", F.concat(F.lit("\nO1. OPDRACHT. Nagaan voor "), F.col("l_suppkey").cast("string"), F.lit("\n3 maart 2026\nof het kan.\nDe raad neemt kennis"))).otherwise("")
    text = F.concat(number, F.lit(". RUBRIEK "), "l_returnflag", F.lit(". Deel "), part, F.lit("\n"), vote, promise)
    docs = _documents(rows, text, "Aanwezig: A Bee, voorzitter\nopenbare zitting")
    # as the row of a generator the vote is read once, not again for each field
    found = lines.parse_minutes(docs).select("doc", "number", "category", "title", "promises", F.inline(F.array(votes.vote(F.col("text")))))
    count = lambda k: F.coalesce(k, F.lit(-1)).alias(k)
    return found.select("doc", "number", "category", "title", "modus", count("voor"), count("tegen"), F.array_join("promises", "|").alias("promises"))


@query(
    f"""
    WITH {_NUMBERED}
    SELECT l_orderkey AS doc, CASE l_returnflag WHEN 'R' THEN 'V' || n WHEN 'A' THEN CAST(n AS VARCHAR) ELSE 'ACT' || n END AS number,
           CASE l_returnflag WHEN 'R' THEN 'vraag' WHEN 'A' THEN 'gewoon' ELSE 'actuadebat' END AS type,
           CASE l_returnflag WHEN 'R' THEN 'Lid ' || l_suppkey END AS submitter, 'Over deel ' || l_partkey || ' vandaag' AS title
    FROM n
    """
)
def agenda_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines written as agendas of items, questions and debates, and parsed."""
    rows = _numbered(spark, sf_dir)
    number, about = F.col("n").cast("string"), F.concat(F.lit("Over deel "), F.col("l_partkey").cast("string"), F.lit("\nvandaag"))
    asked = F.concat(F.lit("V"), number, F.lit(". VRAAG. Lid "), F.col("l_suppkey").cast("string"), F.lit(" - "), about)
    plain = F.concat(number, F.lit(". RUBRIEK A. "), about)
    debate = F.concat(F.lit("ACT"), number, F.lit(". ACTUALITEITSDEBAT. "), about)
    text = F.when(F.col("l_returnflag") == "R", asked).when(F.col("l_returnflag") == "A", plain).otherwise(debate)
    return lines.parse_agenda(_documents(rows, text, "AGENDA\nOpenbare zitting")).select("doc", "number", "type", "submitter", "title")
