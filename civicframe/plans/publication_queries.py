"""Queries of catalogues, exports and what is asked of a judge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.operators import assemble, codes, index, linkage, pairs
from civicframe.plans.registry import query, table
from civicframe.sources import html, sinks
from civicframe.store import stored


def _overviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overview pages (organ, html) of the orders of each priority and month: a block an order, with a main document in one of seven."""
    o = table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "dd-MM-yyyy")
    kind = F.when(F.col("o_orderkey") % 7 == 0, "Agenda").when(F.col("o_orderkey") % 7 < 4, "Uittreksels").otherwise("Bijlage%20bij%20")
    link = lambda text: F.concat(F.lit('<a class="x" href="/d?id='), key, F.lit("&filename="), kind, F.lit("_"), day, F.lit("_"), key, F.lit('.pdf">'), text, F.lit("</a>"))
    block = F.concat(F.lit('<div class="publicatie-grid"><a href="/elders">x</a>'), link(F.concat(F.lit("Stuk <b>&lt;"), key, F.lit("&gt;</b>\n &amp;amp; klant "), F.col("o_custkey").cast("string"))), F.lit("<span> "), F.date_format(F.date_add("o_orderdate", 3), "dd/MM/yyyy"), F.lit(" 10:00</span></div>"))
    return o.select(F.col("o_orderpriority").alias("organ"), F.trunc("o_orderdate", "month").alias("m"), block.alias("b")).groupBy("organ", "m").agg(F.concat(F.lit("<html>"), F.array_join(F.collect_list("b"), "")).alias("html")).select("organ", "html")


_EXTRACTS = """
    SELECT o_orderpriority AS organ, o_orderdate::DATE AS session, 'Stuk <' || o_orderkey || '> &amp; klant ' || o_custkey AS title,
           CASE WHEN o_orderkey % 7 < 4 THEN 'uittreksel' ELSE 'bijlage' END AS kind, (o_orderdate + INTERVAL 3 DAY)::DATE AS published, CAST(o_orderkey AS VARCHAR) AS extract_id
    FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderdate >= DATE '1993-06-01'
"""


@query(_EXTRACTS)
def extract_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts and attachments of overview pages that are made of all orders, from a day on."""
    found = html.extract_catalogue(_overviews(spark, sf_dir), since="1993-06-01")
    return found.select("organ", "session", "title", "kind", "published", "extract_id")


@query(f"WITH e AS ({_EXTRACTS}) SELECT 'soort' AS what, kind AS key, count(*) AS n FROM e GROUP BY kind UNION ALL SELECT 'orgaan', organ, count(*) FROM e GROUP BY organ")
def catalogue_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents of each kind and organ a catalogue has; no url twice, no odd name."""
    return html.catalogue_report(html.extract_catalogue(_overviews(spark, sf_dir), since="1993-06-01"))


@query(
    """
    WITH e AS (SELECT DISTINCT l_returnflag || '-' || l_partkey AS code, l_orderkey AS item FROM lineitem WHERE l_quantity < 10),
    n AS (SELECT code, count(*) AS n FROM e GROUP BY code HAVING count(*) >= 2)
    SELECT code, array_to_string(list(item ORDER BY item), ',') AS items FROM e JOIN n USING (code) GROUP BY code
    """
)
def link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph of orders that share a part and its return, as published and read back from JSON."""
    edges = table(spark, sf_dir, "lineitem").where("l_quantity < 10").select(F.lit("deel").alias("kind"), F.concat_ws("-", "l_returnflag", "l_partkey").alias("code"), F.col("l_orderkey").alias("item")).distinct()
    texts = stored(codes.link_graph(edges).select(F.to_json(F.struct("kind", "code", "part", "items")).alias("value")), "graph")
    back = texts.select(F.from_json("value", "kind string, code string, part int, items array<long>").alias("r")).select("r.*")
    return back.select("code", F.array_join("items", ",").alias("items"))


def _described(title: Column, text: Column) -> Column:
    return pairs.described(title, F.lit(None), F.lit("Raad"), text)


@query(
    r"""
    WITH d AS (SELECT doc_id AS id, 'Titel: ' || coalesce(source, '') || chr(10) || 'Datum: ' || chr(10) || 'Orgaan: Raad' || chr(10) || 'Samenvatting: ' || substr(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'), 1, 900) AS description FROM documents),
    p AS (SELECT x.doc_id AS a, y.doc_id AS b FROM documents x JOIN documents y ON y.doc_id = x.doc_id + 1),
    both_ways AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
    m AS (SELECT sha1('judge|v1|Stuk A' || chr(10) || x.description || chr(10) || chr(10) || 'Stuk B' || chr(10) || y.description)[1:24] AS key FROM both_ways JOIN d x ON x.id = a JOIN d y ON y.id = b)
    SELECT DISTINCT key FROM m WHERE key[1:1] <> '0'
    """
)
def messages_to_ask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a judge must still be asked about neighbouring documents, in both orders; a sixteenth of the keys is cached."""
    docs = table(spark, sf_dir, "documents")
    items = docs.select(F.col("doc_id").alias("id"), _described(F.col("source"), F.col("text")).alias("description"))
    near = docs.select(F.col("doc_id").alias("a")).join(docs.select((F.col("doc_id") - 1).alias("a"), F.col("doc_id").alias("b")), "a")
    messages = stored(pairs.judge_messages(near, items, model="judge", prompt="v1"), "messages")
    return pairs.to_ask(messages, messages.where(F.col("key").startswith("0"))).select("key")


@query(
    """
    WITH m AS (SELECT c_custkey, c_nationkey AS item, round(c_acctbal / 10000, 6) AS score, c_name FROM customer)
    SELECT c_custkey % 20 AS keyword, count(*) FILTER (score >= 0.72) AS n_linked, count(*) FILTER (score < 0.72) AS n_unlinked,
           array_to_string(list(round(score, 3) ORDER BY item, c_custkey) FILTER (score >= 0.72), ',') AS scores
    FROM m GROUP BY ALL
    """
)
def dossier_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as hits of keywords, matched to nations with a score of their balance: linked and unlinked ones a keyword."""
    c = table(spark, sf_dir, "customer")
    hits = c.select((F.col("c_custkey") % 20).alias("keyword"), F.col("c_custkey").alias("hit_id"), F.col("c_name").alias("title"))
    matches = c.select(F.col("c_custkey").alias("hit_id"), F.col("c_nationkey").alias("item_id"), F.round(F.col("c_acctbal") / 10000, 6).alias("score"))
    items = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("item_id"), F.lit("Raad").alias("organ"), F.lit("2026-01-01").alias("day"), F.col("n_name").alias("title"))
    # equal items of a dossier are told apart by the hit
    items_of = linkage.dossier_report(hits, matches, items).select("keyword", "n_linked", "n_unlinked")
    linked = hits.join(matches.where("score >= 0.72"), "hit_id").groupBy("keyword").agg(F.transform(F.sort_array(F.collect_list(F.struct("item_id", "hit_id", F.round("score", 3).alias("s")))), lambda x: x["s"].cast("string")).alias("s"))
    return items_of.join(linked, "keyword", "left").select("keyword", "n_linked", "n_unlinked", F.array_join("s", ",").alias("scores"))


@query(
    """
    SELECT s_name || ' ' || s_suppkey AS name, CASE WHEN s_suppkey % 10 = 0 THEN 'Alias' WHEN n_name = 'FRANCE' THEN 'Frankrijk' ELSE n_name END AS party
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT 'Nieuw ' || s_suppkey, 'Alias' FROM supplier WHERE s_suppkey % 10 = 0
    """
)
def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as members of nations as parties: one party shown by another name, aliases that override and add."""
    s = table(spark, sf_dir, "supplier")
    members = s.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("first"), F.col("s_suppkey").cast("string").alias("last"), F.col("n_name").alias("party"))
    tenth = s.where("s_suppkey % 10 = 0")
    aliases = tenth.select(F.concat_ws(" ", "s_name", "s_suppkey").alias("name"), F.lit("Alias").alias("party")).unionByName(tenth.select(F.concat_ws(" ", F.lit("Nieuw"), "s_suppkey").alias("name"), F.lit("Alias").alias("party")))
    return assemble.roster(members, aliases, spark.createDataFrame([("FRANCE", "Frankrijk")], "party string, shown string"))


@query("SELECT count(*) AS n, CAST(sum(n_regionkey) AS BIGINT) AS regions, count(*) FILTER (n_nationkey % 2 = 0) AS marked FROM nation")
def filled_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations written into a page's script, some with text that would end it; the page read back."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", F.when(F.col("n_nationkey") % 2 == 0, "</script><b>").otherwise("x").alias("mark"))
    page = stored(sinks.filled_page(spark, "<script>var D = __DATA__;</script>", {"__DATA__": nations}), "page")
    inner = F.regexp_extract("page", r"(?s)var D = (.*?);</script>", 1)
    rows = page.select(F.explode(F.from_json(inner, "array<struct<n_nationkey:long,n_regionkey:long,mark:string>>")).alias("r")).select("r.*")
    return rows.agg(F.count("*").alias("n"), F.sum("n_regionkey").alias("regions"), F.count_if(F.col("mark") == "</script><b>").alias("marked"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'Overig' WHEN o_orderkey % 5 = 1 THEN 'Stedenbouw' WHEN o_orderkey % 5 = 2 THEN o_orderpriority WHEN o_orderkey % 5 = 3 THEN 'Sociale zaken' ELSE 'Financiën' END AS theme FROM orders")
def domain_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Themes of domains: known ones, unknown ones that stay, and none."""
    k = F.col("o_orderkey") % 5
    domain = F.when(k == 1, " Bouwdienst").when(k == 2, F.col("o_orderpriority")).when(k == 3, "Sociaal Beleid").when(k == 4, "Boekhouding ")
    return table(spark, sf_dir, "orders").select("o_orderkey", assemble.domain_theme(domain).alias("theme"))


@query(
    """
    WITH t AS (SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(strip_accents(lower(text)), '[a-z]{9,}')) AS token FROM documents),
    i AS (SELECT token, count(*) AS n, min(id) AS id FROM t GROUP BY token),
    picked AS (SELECT * FROM i ORDER BY sha1('x' || token), token LIMIT 200)
    SELECT token, id FROM picked WHERE n <= 4 ORDER BY token LIMIT 12
    """
)
def readable_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve sampled words of an index that few documents have, with their first document."""
    from civicframe.functions.text import fold

    tokens = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.explode(F.array_distinct(F.regexp_extract_all(fold(F.col("text")), F.lit("([a-z]{9,})"), F.lit(1)))).alias("token"))
    built = tokens.groupBy("token").agg(F.count("*").alias("df"), F.min("id").alias("first"))
    # the sample needs how many items a word has and the first of them, not the lists of common words
    lists = built.select("token", F.when(F.col("df") <= 4, F.array_repeat("first", F.col("df").cast("int"))).otherwise(F.array_repeat("first", 5)).alias("items"))
    return index.readable_examples(lists, seed="x")
