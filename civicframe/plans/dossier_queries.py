"""Queries of dossiers: signature words, judged cores, questions placed by verdicts, budget lines by plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.functions.text import title_words
from civicframe.operators.budget import plan_of_items, publication, publication_json
from civicframe.operators.dossiers import around_cores, placed_questions, signature_links
from civicframe.plans.registry import query, table
from civicframe.store import stored

_TITLE_WORDS = "SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(strip_accents(lower(string_split(text, chr(10))[1])), '[a-z][a-z-]{4,}')) AS token FROM documents"


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title words (id, token) of the documents."""
    return stored(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.explode(title_words(F.get(F.split("text", "\n"), 0))).alias("token")).distinct(), "title-words")


@query(
    f"""
    WITH w AS ({_TITLE_WORDS}),
    rare AS (SELECT token, count(*) AS df FROM w GROUP BY token HAVING count(*) BETWEEN 2 AND 40),
    mine AS (SELECT id, token FROM (SELECT id, token, row_number() OVER (PARTITION BY id ORDER BY df, token) AS rn FROM w JOIN rare USING (token)) WHERE rn = 1),
    pairs AS (SELECT x.id AS a, y.id AS b, x.token FROM mine x JOIN mine y ON x.token = y.token AND x.id < y.id),
    streets AS (SELECT doc_id AS id, n_chars % 7 AS street FROM documents),
    judged AS (
        SELECT a, b, token,
               CASE WHEN length(token) > 8 THEN 'woord'
                    WHEN EXISTS (SELECT 1 FROM w x JOIN w y ON x.token = y.token WHERE x.id = a AND y.id = b AND length(x.token) > 8) THEN 'onderwerp'
                    WHEN (SELECT source FROM documents WHERE doc_id = a) = (SELECT source FROM documents WHERE doc_id = b) THEN 'kernbegrip'
                    WHEN (SELECT street FROM streets WHERE id = a) = (SELECT street FROM streets WHERE id = b) THEN 'straat'
                    WHEN b - a <= 40 AND a % 2 = 0 THEN 'verwijzing' END AS reason
        FROM pairs
    )
    SELECT * FROM judged WHERE reason IS NOT NULL
    """
)
def signature_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by the rarest word of their titles; words of up to eight letters count as general and need a confirmation."""
    words, docs = _titles(spark, sf_dir), table(spark, sf_dir, "documents")
    general = words.where(F.length("token") <= 8).select("token").distinct()
    terms, streets = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("term")), docs.select(F.col("doc_id").alias("id"), (F.col("n_chars") % 7).alias("street"))
    ids = docs.where("doc_id % 2 = 0").select(F.col("doc_id").alias("a"))
    referrals = ids.select(F.explode(F.sequence(F.col("a") + 1, F.col("a") + 40)).alias("b"), "a")
    return signature_links(words, general, terms, streets, referrals)


@query()
def judged_cores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents around judged dossiers: of every five one is judged by its source and language, some are in series or alone; links by signature words."""
    words, docs = _titles(spark, sf_dir), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source", "lang")
    none = words.select("token").limit(0)
    nothing = words.select("id", F.col("token").alias("term")).limit(0)
    links = signature_links(words, none, nothing, nothing.withColumnRenamed("term", "street"), words.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0))
    part = F.pmod(F.xxhash64("id"), F.lit(10))
    core = docs.where(part < 2).select("id", F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-"))).alias("dossier"))
    series = docs.where(part == 2).select("id", F.concat(F.lit("reeks "), F.coalesce("lang", F.lit("-"))).alias("series"))
    text = lambda df: df.withColumn("id", F.col("id").cast("string"))
    pairs = links.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))
    return around_cores(text(docs), text(core), text(series), text(docs.where(part == 3)), stored(pairs, "links"))


@query()
def questions_by_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the documents as questions, judged against documents with a common signature word; verdicts by a hash of the pair."""
    words, docs = _titles(spark, sf_dir), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source")
    empty = words.limit(0)
    pairs = signature_links(words, empty.select("token"), empty.select("id", F.col("token").alias("term")), empty.select("id", F.col("token").alias("street")), empty.select(F.col("id").alias("a"), F.col("id").alias("b")))
    judged = stored(pairs.select("a", "b", (F.pmod(F.xxhash64("a", "b"), F.lit(3)) < 2).alias("same")), "verdicts")
    questions = docs.where("id % 3 = 0").select("id")
    groups = docs.where("id % 3 = 1").select("id", F.floor(F.col("id") / 30).alias("dossier"))
    return placed_questions(questions, judged.where("same"), judged.where("not same"), groups)


@query(
    """
    WITH years AS (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem),
    plans AS (SELECT 2000 - y AS plan, make_date(y, 1 + (y % 5)::INT, 3) AS valid_from FROM years),
    versions AS (SELECT DISTINCT 2000 - year(l_shipdate) AS plan, l_partkey AS code FROM lineitem WHERE l_linenumber <= 2),
    refs AS (SELECT DISTINCT l_partkey AS code, l_orderkey AS item, l_shipdate::DATE AS day FROM lineitem WHERE l_linenumber = 3),
    dated AS (
        SELECT code, item, day, coalesce((SELECT arg_max(plan, valid_from) FROM plans WHERE valid_from <= day), (SELECT arg_min(plan, valid_from) FROM plans)) AS plan FROM refs
    ),
    placed AS (
        SELECT d.code, item, coalesce(v.plan, (SELECT min(plan) FROM versions f WHERE f.code = d.code)) AS plan, v.plan IS NULL AS other_plan
        FROM dated d LEFT JOIN versions v ON v.code = d.code AND v.plan = d.plan WHERE d.code IN (SELECT code FROM versions)
    )
    SELECT code, item, CAST(plan AS INT) AS plan, other_plan FROM placed
    """
)
def budget_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as budget codes, years as plans, first lines of orders as versions, third lines as references by their ship day."""
    return plan_of_items(*_budget(table(spark, sf_dir, "lineitem")))


def _budget(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """References, plans and versions made from order lines."""
    year = F.year("l_shipdate")
    plans = lines.select(year.alias("y")).distinct().select((2000 - F.col("y")).alias("plan"), F.make_date("y", 1 + F.col("y") % 5, F.lit(3)).alias("valid_from"))
    versions = lines.where("l_linenumber <= 2").select((2000 - year).alias("plan"), F.col("l_partkey").alias("code"))
    references = lines.where("l_linenumber = 3").select(F.col("l_partkey").alias("code"), F.col("l_orderkey").alias("item"), F.col("l_shipdate").cast("date").alias("day"))
    return references, plans, versions


@query(
    """
    WITH lines AS (SELECT l_partkey AS code, 2000 - year(l_shipdate) AS plan, CAST(sum(l_quantity) AS BIGINT) AS total FROM lineitem WHERE l_linenumber <= 2 GROUP BY ALL),
    refs AS (SELECT DISTINCT l_partkey AS code, l_orderkey AS item FROM lineitem WHERE l_linenumber = 3)
    SELECT code, arg_min(total, plan) AS newest, count(*) AS n_versions, CAST(sum(total) AS BIGINT) AS total, (SELECT count(*) FROM refs WHERE refs.code = lines.code) AS n_items
    FROM lines WHERE code IN (SELECT code FROM refs) GROUP BY code
    """
)
def budget_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publication of all codes as JSON texts, written, read back by a schema and summed up."""
    orders = table(spark, sf_dir, "lineitem")
    references, plans, versions = _budget(orders)
    lines = orders.where("l_linenumber <= 2").groupBy((2000 - F.year("l_shipdate")).alias("plan"), F.col("l_partkey").alias("code")).agg(F.sum("l_quantity").cast("long").alias("total"))
    published = publication(lines.select("plan", "code", F.struct("total").alias("line")), plan_of_items(references, plans, versions))
    texts = stored(published.select(publication_json(published).alias("value")), "budget")
    back = texts.select(F.from_json("value", "code long, line struct<total:long>, versions map<string,struct<total:long>>, plan_of_item map<string,int>").alias("r")).select("r.*")
    sums = F.aggregate(F.map_values("versions"), F.lit(0).cast("long"), lambda a, v: a + v["total"])
    return back.select("code", F.col("line.total").alias("newest"), F.size("versions").cast("long").alias("n_versions"), sums.alias("total"), F.size("plan_of_item").cast("long").alias("n_items"))
