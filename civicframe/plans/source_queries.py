"""Queries of sources: files that Spark writes from the given tables are read back by the library's readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.operators.geo import in_districts
from civicframe.plans.registry import query, table
from civicframe.sources.documents import districts, gml_point, json_documents, session_files
from civicframe.sources.tables import search_results
from civicframe.store import shared_path, stored


@query(
    r"""
    SELECT doc_id // 25 AS page, source AS organ, coalesce(lang, '') AS doctype,
           trim(regexp_replace(split_part(text, chr(10), 1), '\s+', ' ', 'g')) AS title,
           '/d/' || doc_id || CASE WHEN doc_id % 3 = 0 THEN ' /e/' || doc_id ELSE '' END AS links
    FROM documents WHERE text IS NOT NULL AND source IS NOT NULL
    """
)
def result_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages of 25 documents, nested in a layout table, with headings in changing forms, read back as rows."""
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    docs = table(spark, sf_dir, "documents").where("text is not null and source is not null")
    link = lambda way: F.concat(F.lit(f'<a href=" /{way}/'), F.col("doc_id").cast("string"), F.lit('"><b>stuk</b></a>'))
    links = F.concat(link("d"), F.when(F.col("doc_id") % 3 == 0, link("e")).otherwise(""))
    parts = (F.col("source"), F.lit("1 mei"), F.coalesce("lang", F.lit("")), F.split_part("text", F.lit("\n"), F.lit(1)))
    row = F.concat(F.lit("<tr>"), *(x for c in parts for x in (F.lit("<td>"), escaped(c))), F.lit("<td><table><tr><td>"), F.lit("oud</table>"), links)
    page = F.floor(F.col("doc_id") / 25)
    head = F.when(page % 2 == 0, "<thead><tr><th>BESTUURSÓRGAAN<th>Datum  zitting<th>Document type<th>Titel (kort)<th>Documenten</tr></thead><tbody>").otherwise(
        "<tr><td>Bestuursorgaan</td><td>datum zitting</td><td>DOCUMENT TYPE</td><td>titel</td><td>documenten</td></tr>"
    )
    pages = docs.select(page.alias("page_id"), row.alias("row"), head.alias("head")).groupBy("page_id").agg(
        F.concat(F.lit("<html><table><tr><td>menu<td><table>"), F.first("head"), F.array_join(F.collect_list("row"), ""), F.lit("</table></table>")).alias("html")
    )
    return search_results(pages).select("page", "organ", "doctype", "title", F.array_join("links", " ").alias("links"))


@query(
    """
    SELECT conv_id, count(*) AS n_turns, CAST(sum(length(text)) AS BIGINT) AS n_chars, max_by(role, turn) AS last_role
    FROM conversations WHERE conv_id % 10 <> 3 GROUP BY conv_id
    """
)
def json_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations written as JSON documents of several lines, one file in two with a byte-order mark, one in ten cut off, read back."""
    turn = F.struct("turn", "role", "text")
    convs = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    text = F.to_json(F.struct("conv_id", "turns"), {"pretty": "true"})
    text = F.when(F.col("conv_id") % 10 == 3, F.substring(text, 1, 30)).otherwise(F.concat(F.when(F.col("conv_id") % 2 == 0, "﻿").otherwise(""), text))
    path = shared_path(spark, "json")
    convs.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    good, _ = json_documents(spark, path, "conv_id long, turns array<struct<turn:long,role:string,text:string>>")
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + F.length(t["text"]))
    return good.select("conv_id", F.size("turns").cast("long").alias("n_turns"), chars.alias("n_chars"), F.element_at("turns", -1)["role"].alias("last_role"))


@query(
    """
    SELECT o_orderpriority AS organ, strftime(o_orderdate, '%Y-%m') AS session, CAST(sum(length(o_orderkey || ' ' || o_custkey) + 1) AS BIGINT) AS bytes,
           count(*) AS lines, CAST(sum(o_custkey) AS BIGINT) AS keys
    FROM orders GROUP BY ALL
    """
)
def session_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as text files into folders of a priority and a month; the folders walked and their files read."""
    path = shared_path(spark, "raw")
    line = F.concat_ws(" ", "o_orderkey", "o_custkey").alias("value")
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month"), line)
    rows.repartition("o_orderpriority", "month").write.partitionBy("o_orderpriority", "month").text(path)
    files = session_files(spark, path, pattern="*.txt")
    lines = files.select("organ", "session", "size", F.regexp_extract_all(F.decode("content", "UTF-8"), F.lit(r"\d+ (\d+)\n"), F.lit(1)).alias("lines"))
    total = F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    return lines.groupBy("organ", "session").agg(F.sum("size").alias("bytes"), F.sum(F.size("lines")).alias("lines"), F.sum(total).alias("keys"))


@query(
    """
    WITH areas AS (SELECT n_nationkey AS k, n_name AS name FROM nation),
    points AS (SELECT c_custkey, (c_acctbal + 1000) / 100 AS x, c_custkey % 50 / 10.0 AS y FROM customer)
    SELECT c_custkey, min(name) AS district
    FROM points LEFT JOIN areas ON x > k * 4 AND x < k * 4 + 4 AND y > 0.05 AND y < 4.05 AND NOT (x > k * 4 + 1 AND x < k * 4 + 2 AND y > 1.05 AND y < 2.05)
    GROUP BY c_custkey
    """
)
def geojson_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares with a hole for each nation, written as GeoJSON of three kinds; customers placed by positions in GML."""
    ring = lambda x, y, side: F.concat(F.lit("["), F.array_join(F.array(*(F.format_string("[%s,%s]", (x + dx * side).cast("string"), (y + dy * side).cast("string")) for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0)))), ","), F.lit("]"))
    x = F.col("n_nationkey").cast("double") * 4
    rings = F.concat(F.lit("["), ring(x, F.lit(0.05), 4.0), F.lit(","), ring(x + 1, F.lit(1.05), 1.0), F.lit("]"))
    shape = lambda kind, body: F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), body, F.lit("}"))
    kind = F.col("n_nationkey") % 3
    geometry = (
        F.when(kind == 0, shape("Polygon", rings))
        .when(kind == 1, shape("MultiPolygon", F.concat(F.lit("["), rings, F.lit("]"))))
        .otherwise(F.concat(F.lit('{"type":"GeometryCollection","geometries":['), shape("Polygon", rings), F.lit("]}")))
    )
    entry = F.concat(F.lit('"'), F.col("n_name"), F.lit('":'), geometry)
    path = shared_path(spark, "areas")
    table(spark, sf_dir, "nation").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ","), F.lit("}")).alias("value")).write.text(path)
    gml = F.format_string("<gml:Point><gml:pos>%s %s</gml:pos></gml:Point>", ((F.col("c_acctbal") + 1000) / 100).cast("string"), (F.col("c_custkey") % 50 / 10).cast("string"))
    points = table(spark, sf_dir, "customer").select("c_custkey", gml_point(gml).alias("p")).select("c_custkey", "p.x", "p.y")
    areas = stored(districts(spark, path), "areas")
    return in_districts(points, areas, "x", "y", "c_custkey", cell=1.0, strict=True).select("c_custkey", "district")
