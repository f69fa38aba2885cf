"""Filters, look-ups, orders and small joins of the catalogue, over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.operators import catalogue as c
from civicframe.operators.assemble import result_slug
from civicframe.plans.registry import query, table


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a day."""
    return table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))


@query("SELECT o_orderstatus, count(*) AS n, min(o_orderdate::DATE) AS first_day FROM orders WHERE o_orderdate::DATE >= DATE '1998-03-01' GROUP BY 1")
def date_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a term that began on a day."""
    return c.since(_orders(spark, sf_dir), "day", "1998-03-01").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.min("day").alias("first_day"))


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(lower(p_name), '(^|[^a-z])[a-m][a-z]*[aeiou]') AND p_size > 10")
def title_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by a pattern of their title and a flag."""
    parts = table(spark, sf_dir, "part").withColumn("there", F.col("p_size") > 10).withColumn("low", F.lower("p_name"))
    return c.titled(parts, "low", "(^|[^a-z])[a-m][a-z]*[aeiou]", present="there").select("p_partkey", "p_name")


_RESULT = "CASE o_orderkey % 8 WHEN 0 THEN 'Goedgekeurd' WHEN 1 THEN 'Bekrachtigd' WHEN 2 THEN 'Vastgesteld' WHEN 3 THEN 'Niet ter stemming gelegd' WHEN 4 THEN 'Verdaagd' WHEN 5 THEN 'Verworpen' WHEN 6 THEN 'Kennisgenomen' ELSE NULL END"


@query(
    f"""
    WITH r AS (SELECT {_RESULT} AS result FROM orders)
    SELECT result, CASE WHEN result = 'Niet ter stemming gelegd' THEN 'niet-gestemd' ELSE lower(result) END AS slug, count(*) AS n FROM r GROUP BY 1, 2
    """
)
def result_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result lines and their slugs; one that isn't known goes in small letters."""
    r = table(spark, sf_dir, "orders").select(F.expr(_RESULT).alias("result"))
    return r.groupBy("result", result_slug(F.col("result")).alias("slug")).agg(F.count("*").alias("n"))


_ORGAN = "CASE c_custkey % 6 WHEN 0 THEN 'Gemeenteraad' WHEN 1 THEN 'Raad voor maatschappelijk welzijn' WHEN 2 THEN 'College van burgemeester en schepenen' WHEN 3 THEN 'Vast bureau' WHEN 4 THEN 'Burgemeester' ELSE '' END"


@query(
    f"""
    WITH o AS (SELECT {_ORGAN} AS organ, CASE c_custkey % 7 WHEN 0 THEN 'rmw-2026' WHEN 1 THEN 'gemeenteraad-2026' WHEN 2 THEN 'college-1' END AS session_id FROM customer),
    w AS (SELECT CASE WHEN organ <> '' THEN organ WHEN session_id = 'rmw-2026' THEN 'Raad voor maatschappelijk welzijn' WHEN session_id = 'gemeenteraad-2026' THEN 'Gemeenteraad' END AS organ FROM o),
    m(organ, organ_key, type_code, folder) AS (VALUES ('Gemeenteraad', 'Gemeenteraad', 'Gemeenteraad', 'gemeenteraad'),
        ('Raad voor maatschappelijk welzijn', 'RMW', 'RMW', 'raad_voor_maatschappelijk_welzijn'), ('College van burgemeester en schepenen', 'College', 'College van burgemeester en schepenen', 'college_van_burgemeester_en_schepenen'),
        ('Vast bureau', 'Vast bureau', 'Vast bureau', 'vast_bureau'), ('Burgemeester', 'Burgemeester', 'Burgemeester', 'burgemeester'))
    SELECT w.organ, organ_key, type_code, folder, count(*) AS n FROM w LEFT JOIN m ON w.organ = m.organ GROUP BY ALL
    """
)
def organ_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The organ of an item, its own or by its session, and what stands for it."""
    o = table(spark, sf_dir, "customer").select(F.expr(_ORGAN).alias("organ"), F.expr("CASE c_custkey % 7 WHEN 0 THEN 'rmw-2026' WHEN 1 THEN 'gemeenteraad-2026' WHEN 2 THEN 'college-1' END").alias("session_id"))
    w = o.select(c.organ_of(F.col("organ"), F.col("session_id")).alias("organ"))
    codes = (c.looked_up(F.col("organ"), t).alias(k) for k, t in (("organ_key", c.ORGAN_KEY), ("type_code", c.TYPE_CODE), ("folder", c.FOLDER)))
    return w.select("organ", *codes).groupBy("organ", "organ_key", "type_code", "folder").agg(F.count("*").alias("n"))


@query("SELECT doc_id, length(text[1:24000]) AS kept, coalesce(length(text) > 50000, false) AS bundle, md5(text[1:24000]) AS digest FROM documents")
def length_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of a source text goes to a model, and whether a question's file is a bundle."""
    text = c.capped(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.char_length(text).cast("long").alias("kept"), c.is_bundle(F.col("text")).alias("bundle"), F.md5(text.cast("binary")).alias("digest"))


@query(
    """
    WITH q AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 3 = 1 THEN NULL ELSE lang END AS lang, source FROM documents),
    cache AS (SELECT doc_id, 'kept ' || lang AS lang FROM documents WHERE doc_id % 2 = 0)
    SELECT q.doc_id, coalesce(nullif(q.lang, ''), cache.lang) AS lang, source FROM q LEFT JOIN cache ON q.doc_id = cache.doc_id
    """
)
def cached_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of questions, from a cache where they are empty."""
    d = table(spark, sf_dir, "documents")
    q = d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "").when(F.col("doc_id") % 3 == 2, F.col("lang")).alias("lang"), "source")
    return c.with_cached(q, d.where("doc_id % 2 = 0").select("doc_id", F.concat(F.lit("kept "), "lang").alias("lang")), "doc_id", ["lang"])


@query(
    """
    SELECT conv_id, count(*) AS n_texts, md5(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS digest
    FROM conversations WHERE role = 'assistant' AND text <> '' GROUP BY conv_id
    """
)
def linked_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers of a conversation as the texts that are linked to an item."""
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'").withColumn("text_id", F.concat_ws("-", "conv_id", "turn"))
    one = c.linked_texts(turns.select("conv_id", "text_id"), turns.select("text_id", "turn", "text"), item="conv_id", text_id="text_id", order="turn")
    n = turns.where("text <> ''").groupBy("conv_id").agg(F.count("*").alias("n_texts"))
    return one.join(n, "conv_id").select("conv_id", "n_texts", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(
    """
    SELECT doc_id, md5(concat_ws(chr(10), nullif(trim(text), ''), nullif(trim(source), ''), nullif(trim(lang), ''))) AS for_index,
           md5(concat_ws(chr(10), nullif(trim(lang), ''), nullif(trim(text), ''))) AS for_codes,
           md5((concat_ws(chr(10) || chr(10), CASE WHEN doc_id % 2 = 0 THEN nullif(trim(source), '') ELSE nullif(trim(lang), '') END, nullif(trim(text), '')))[1:24000]) AS for_tagging
    FROM documents
    """
)
def source_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of an item as the index, the codes and the tagging take it."""
    text, source, lang, none = F.col("text"), F.col("source"), F.col("lang"), F.lit(None).cast("string")
    digest = lambda x, name: F.md5(x.cast("binary")).alias(name)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        digest(c.source_text("index", source=text, result=source, terms=F.array(lang), minutes=none, extracts=none), "for_index"),
        digest(c.source_text("codes", title=lang, source=text, minutes=F.lit("")), "for_codes"),
        digest(c.source_text("tagging", source=text, extracts=F.when(F.col("doc_id") % 2 == 0, source), attachments=lang), "for_tagging"),
    )


@query(
    """
    WITH p AS (SELECT DISTINCT CASE o_custkey % 3 WHEN 0 THEN 'Gemeenteraad' WHEN 1 THEN 'Raad voor maatschappelijk welzijn' ELSE 'Commissie' END AS organ, o_orderdate::DATE AS day FROM orders),
    t AS (SELECT *, CASE organ WHEN 'Raad voor maatschappelijk welzijn' THEN 'RMW' ELSE organ END AS type, CASE organ WHEN 'Raad voor maatschappelijk welzijn' THEN 'rmw' ELSE 'gemeenteraad' END AS slug FROM p WHERE day >= DATE '2000-01-01'),
    k AS (SELECT DISTINCT CASE o_custkey % 2 WHEN 0 THEN 'RMW' ELSE 'Gemeenteraad' END AS type, o_orderdate::DATE AS day FROM orders WHERE o_orderpriority LIKE '1%')
    SELECT slug || '-' || strftime(day, '%Y%m%d') AS id, type, day FROM t WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.type = t.type AND k.day = t.day)
    """
)
def unknown_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned sessions that aren't known yet."""
    o = _orders(spark, sf_dir)
    planned = o.select(F.when(F.col("o_custkey") % 3 == 0, c.COUNCIL).when(F.col("o_custkey") % 3 == 1, c.WELFARE).otherwise("Commissie").alias("organ"), "day").distinct()
    known = o.where("o_orderpriority like '1%'").select(F.when(F.col("o_custkey") % 2 == 0, "RMW").otherwise("Gemeenteraad").alias("type"), "day")
    return c.unknown_sessions(planned, known, "2000-01-01").select("id", "type", "day")


@query("SELECT p_partkey, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def used_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that a line of many pieces names."""
    named = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return c.used_codes(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), named, "p_partkey")


@query(
    """
    SELECT c_custkey, CASE WHEN n_regionkey = 0 THEN 'single ' || n_name WHEN n_regionkey IN (1, 2) THEN CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'main ' || n_name END ELSE 'centre' END AS district
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """
)
def district_by_postcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Districts of customers, with nations as postcodes."""
    nation = table(spark, sf_dir, "nation")
    streets = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("postcode"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("located"))
    single = nation.where("n_regionkey = 0").select(F.col("n_nationkey").alias("postcode"), F.concat(F.lit("single "), "n_name").alias("district"))
    double = nation.where("n_regionkey in (1, 2)").select(F.col("n_nationkey").alias("postcode"), F.concat(F.lit("main "), "n_name").alias("main"))
    return c.districts(streets, single, double, default="centre").select("c_custkey", "district")


@query("SELECT DISTINCT c_name AS name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def names_without_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that no finished order has, by name in any case of letters."""
    names = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"))
    used = names.join(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select(F.upper("name").alias("name"))
    return c.without_match(names.select("name").distinct(), used, "name")


@query("SELECT i.item_id IS NOT NULL AS linked, count(*) AS n FROM documents d LEFT JOIN benchmark i ON d.doc_id = i.item_id GROUP BY 1")
def linked_unlinked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with and without a match."""
    hits = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"))
    with_, without = c.split_matches(hits, table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("title")), "item_id")
    parts = [x.select(F.lit(flag).alias("linked")) for x, flag in ((with_, True), (without, False))]
    return c.histogram(parts[0].unionByName(parts[1]), "linked")


@query("SELECT r_name AS organ, CAST(year AS INT) AS year FROM region, range(2019, 2027) y(year)")
def organ_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each organ and year to be asked for."""
    return c.organ_years(table(spark, sf_dir, "region").select(F.col("r_name").alias("organ")), 2019, 2026)


@query("SELECT event_type AS kind, count(DISTINCT user_id % 50) AS n_codes, count(DISTINCT event_id) AS n_items FROM events GROUP BY 1")
def kind_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and items of each kind."""
    return c.kind_counts(table(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), (F.col("user_id") % 50).alias("code"), F.col("event_id").alias("item_id")))


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS code, event_id AS item_id FROM events WHERE event_type = 'click'")
def codes_of_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the codes of one kind."""
    codes = table(spark, sf_dir, "events").select(F.concat_ws(":", "event_type", "user_id").alias("code"), F.col("event_id").alias("item_id"))
    return c.codes_of_kind(codes, "click")


@query("SELECT o_orderpriority AS organ, o_orderdate::DATE AS day, count(*) AS n_hits FROM orders GROUP BY 1, 2")
def keyword_dossier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of each session."""
    return c.keyword_dossier(_orders(spark, sf_dir).withColumnRenamed("o_orderpriority", "organ"))


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each source and language."""
    return c.histogram(table(spark, sf_dir, "documents"), "source", "lang")


@query("SELECT least((SELECT min(o_orderdate::DATE) FROM orders), (SELECT min(l_shipdate::DATE) FROM lineitem), (SELECT min(ts::DATE) FROM events)) AS day")
def earliest_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day of three collections."""
    return c.earliest((table(spark, sf_dir, "orders"), "o_orderdate"), (table(spark, sf_dir, "lineitem"), "l_shipdate"), (table(spark, sf_dir, "events"), "ts"))


@query(
    """
    WITH d AS (SELECT p_partkey, p_brand AS entity, 'Plan ' || (2000 + p_size % 20) || ' - ' || (2005 + p_size % 20) || ' deel' AS "set" FROM part),
    e AS (SELECT *, (2000 + p_partkey * 0)::VARCHAR AS unused, regexp_extract("set", '20\\d{2} - 20\\d{2}') AS plan FROM d WHERE starts_with(lower(entity), 'brand#1'))
    SELECT plan, min(p_partkey) AS p_partkey FROM e GROUP BY plan
    """
)
def newest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of each plan of some entities."""
    years = F.concat(F.lit("Plan "), (2000 + F.col("p_size") % 20).cast("string"), F.lit(" - "), (2005 + F.col("p_size") % 20).cast("string"), F.lit(" deel"))
    d = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("entity"), years.alias("set"))
    return c.newest_versions(d, entity="Brand#1", order="p_partkey").select("plan", "p_partkey")


_SPANS = "SELECT l_suppkey, l_orderkey AS a, l_orderkey + CAST(l_quantity AS BIGINT) * 20 AS b FROM lineitem"


@query(
    f"""
    WITH s AS ({_SPANS}), m AS (SELECT *, max(b) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM s),
    i AS (SELECT *, sum(CASE WHEN far IS NULL OR a > far THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT l_suppkey, min(a) AS a, max(b) AS b FROM i GROUP BY l_suppkey, island
    """
)
def merged_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of orders of a supplier, as one where they overlap."""
    spans = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_orderkey").alias("a"), (F.col("l_orderkey") + F.col("l_quantity").cast("long") * 20).alias("b"))
    return c.merged_spans(spans, "l_suppkey", "a", "b")


@query("SELECT o_orderkey AS id, o_orderdate::DATE AS day FROM orders ORDER BY day DESC, id DESC")
def listed_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as questions in the order of their list."""
    return c.listed(_orders(spark, sf_dir).select(F.col("o_orderkey").alias("id"), "day"), "questions")


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 300")
def next_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of a work list, as many as a run may ask for."""
    return c.next_work(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", 300)


@query("SELECT DISTINCT p_name AS token, md5(p_name || '|7') AS h FROM part ORDER BY h, token LIMIT 40")
def sampled_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of forty names that a seed decides."""
    got = c.sampled(table(spark, sf_dir, "part").select(F.col("p_name").alias("token")).distinct(), "token", 40, "7")
    return got.withColumn("h", F.md5(F.concat_ws("|", "token", F.lit("7")).cast("binary")))


@query(
    """
    WITH k AS (SELECT user_id, event_type, min(event_id) AS event_id FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2), f AS (SELECT user_id, event_type, -1 AS event_id FROM events GROUP BY 1, 2)
    SELECT * FROM k UNION ALL SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.user_id = f.user_id AND k.event_type = f.event_type)
    """
)
def append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that are known stay, and new ones are added once."""
    e = table(spark, sf_dir, "events")
    known = e.where("event_id % 2 = 0").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    return c.append_new(known, e.select("user_id", "event_type", F.lit(-1).cast("long").alias("event_id")), ["user_id", "event_type"])


@query("WITH l AS (SELECT doc_id, doc_id + 3 AS other, quality FROM labels WHERE quality IS NOT NULL) SELECT doc_id AS id FROM l UNION SELECT other FROM l")
def judged_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions that some verdict names."""
    return c.judged_questions(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("a"), (F.col("doc_id") + 3).alias("b"), F.col("quality").alias("verdict")))





def _extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as extracts: lines of presence, a head whose title runs over two lines, and a section."""
    n = F.col("p_size").cast("string")
    head = F.when(F.col("p_partkey") % 4 == 0, F.concat(n, F.lit(". "))).when(F.col("p_partkey") % 4 == 1, F.concat(n, F.lit(" B. "))).when(F.col("p_partkey") % 4 == 2, F.concat(n, F.lit("C "))).otherwise(F.concat(F.lit("artikel "), n, F.lit(" ")))
    text = F.concat(F.lit("Aanwezig: allen\n\n"), head, F.lit("Dienst Zaken. "), F.col("p_name"), F.lit("\nvoor "), F.col("p_brand"), F.lit(".\nVoorgeschiedenis\n9. ANDERS. Niet dit.\n"))
    organ = F.when(F.col("p_size") % 3 == 0, c.COLLEGE).when(F.col("p_size") % 3 == 1, c.MAYOR).otherwise(c.COUNCIL)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("publication"), "p_size", organ.alias("organ"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("p_partkey") % 300).cast("int")).alias("day"), text.alias("text"))


_EXPECTED = """
    x AS (SELECT p_partkey, p_size, p_partkey % 4 AS kind, CAST(CASE WHEN p_partkey % 4 = 3 THEN 9 ELSE p_size END AS INT) AS number, CASE p_partkey % 4 WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE '' END AS letter,
          CASE WHEN p_partkey % 4 = 3 THEN 'ANDERS' ELSE 'Dienst Zaken' END AS department, CASE WHEN p_partkey % 4 = 3 THEN 'Niet dit.' ELSE p_name || ' voor ' || p_brand || '.' END AS title FROM part)
"""


@query(f"WITH {_EXPECTED} SELECT p_partkey AS publication, number, letter, department, title FROM x")
def extract_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, letter, department and title of extracts' heads."""
    # as the row of a generator both heads are read once, not again for the filter and each field
    heads = _extracts(spark, sf_dir).select("publication", F.inline(F.array(F.struct(c.head_number(F.col("text")).alias("n"), c.head_of(F.col("text")).alias("h")))))
    return heads.where(F.col("n.number") == F.col("h.number")).select("publication", "n.number", "n.letter", "h.department", "h.title")


@query(
    f"""
    WITH {_EXPECTED}, e AS (SELECT *, p_size % 3 AS o, DATE '2026-01-01' + CAST(p_partkey % 300 AS INT) AS day FROM x WHERE p_size % 3 < 2),
    n AS (SELECT *, CASE o WHEN 0 THEN 'college' ELSE 'burgemeester' END || '-' || strftime(day, '%Y%m%d') || '-' || number || letter AS id, CASE o WHEN 0 THEN 'College' ELSE 'Burgemeester' END AS organ
          FROM e WHERE NOT (o = 0 AND dayofmonth(day) <= 10))
    SELECT id, organ, day, department AS category, title, true AS provisional FROM n QUALIFY row_number() OVER (PARTITION BY id ORDER BY p_partkey) = 1
    """
)
def provisional_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions made from extracts of sessions that have none yet."""
    e = _extracts(spark, sf_dir)
    known = e.where("dayofmonth(day) <= 10").select(F.lit("College").alias("organ"), "day")
    return c.provisional_decisions(e, known)


@query(
    """
    SELECT o_orderkey, CAST(o_custkey % 90 AS INT) AS number, CASE o_orderkey % 3 WHEN 0 THEN 'D' ELSE '' END AS letter, strftime(o_orderdate, '%Y-%m-%d') AS session FROM orders WHERE o_orderkey % 5 <> 4
    """
)
def id_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, letter and session in items' ids, some with the suffix of equal ids, some that are none."""
    key = F.col("o_orderkey")
    item = F.concat(F.lit("college-"), F.date_format("day", "yyyyMMdd"), F.lit("-"), (F.col("o_custkey") % 90).cast("string"), F.when(key % 3 == 0, "D").otherwise(""), F.when(key % 2 == 0, "-06de99").otherwise(""), F.when(key % 5 == 4, "-x").otherwise(""))
    ids = _orders(spark, sf_dir).select("o_orderkey", item.alias("id"))
    parts = ids.select("o_orderkey", c.number_in_id(F.col("id")).alias("n"), c.session_in_id(F.col("id")).alias("session")).where("n is not null")
    return parts.select("o_orderkey", "n.number", "n.letter", "session")


@query(
    """
    SELECT doc_id, CASE WHEN doc_id % 6 IN (0, 3) THEN 'ja' WHEN doc_id % 6 = 1 THEN 'twijfel' END AS verdict, CASE WHEN doc_id % 2 = 0 THEN NULL ELSE source || chr(10) || '- ' || lang END AS summary FROM documents
    """
)
def model_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts and tags in answers of a model: with fences, with line breaks in strings, cut off, without an object."""
    k = F.col("doc_id") % 6
    verdict = F.when(k == 0, 'Zeker: {"oordeel": "ja"} want {x}').when(k == 1, '```json\n{"oordeel":\n"twijfel"}\n```').when(k == 2, '{"oordeel": "misschien"}').when(k == 3, '{"a": 1, "oordeel": "ja"}').when(k == 4, '{"oordeel": "ja"')
    broken = F.concat(F.lit('```json\n{"summary": "'), F.col("source"), F.lit("\n- "), F.col("lang"), F.lit('", "n": 1}\n```'))
    d = table(spark, sf_dir, "documents").select("doc_id", verdict.alias("answer"), F.when(F.col("doc_id") % 2 == 1, broken).otherwise("geen antwoord").alias("tags"))
    return d.select("doc_id", c.verdict_in(F.col("answer")).alias("verdict"), c.tags_in(F.col("tags"), "summary string, n int")["summary"].alias("summary"))


@query(
    """
    SELECT o_orderkey, 'Onderzoek van ' || o_orderpriority || CASE WHEN o_orderkey % 4 = 3 THEN '.' ELSE ' en meer' || CASE WHEN o_orderkey % 4 = 0 THEN ' tot hier.' ELSE '' END END AS title FROM orders
    """
)
def promise_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of promises that run on over some lines, with a page footer between."""
    k = F.col("o_orderkey") % 4
    first = F.concat(F.lit("Onderzoek van "), "o_orderpriority", F.when(k == 3, ".").otherwise(""))
    following = F.when(k == 0, F.array(*map(F.lit, ["en meer", "27 januari 2025", "tot hier.", "niet meer"]))).when(k == 1, F.array(*map(F.lit, ["en meer", "Motivering", "niet"]))).when(k == 2, F.array(*map(F.lit, ["en meer", "V2. VRAAG", "niet"]))).otherwise(F.array(F.lit("niet")))
    return table(spark, sf_dir, "orders").select("o_orderkey", c.continued_title(first, following, stop=r"^V\d+\.", footer=r"^\s*\d{1,2} januari \d{4}\s*$").alias("title"))


@query(
    """
    WITH r AS (SELECT l_orderkey, l_linenumber, 'raad_' || strftime(o_orderdate, '%Y-%m-%d') || '_' || lower(l_returnflag) || '_20260901' AS stem FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    n AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY l_orderkey, l_linenumber) + CASE WHEN stem LIKE '%\\_r\\_%' ESCAPE '\\' THEN 2 ELSE 0 END AS k FROM r)
    SELECT l_orderkey, l_linenumber, stem || CASE WHEN k > 1 THEN '_' || k ELSE '' END || '.pdf' AS archive FROM n
    """
)
def archive_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for replaced files that none has yet."""
    o = _orders(spark, sf_dir).select("o_orderkey", "day")
    l = table(spark, sf_dir, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = l.select("l_orderkey", "l_linenumber", F.struct("l_orderkey", "l_linenumber").alias("file"), F.lit("raad").alias("folder"), "day", F.lower("l_returnflag").alias("kind"), F.lit("2026-09-01").cast("date").alias("seen"))
    taken = o.select(F.concat(F.lit("raad_"), F.date_format("day", "yyyy-MM-dd"), F.lit("_r_20260901")).alias("stem"), F.lit(2).alias("n")).distinct()
    return c.archive_names(rows, taken).select("l_orderkey", "l_linenumber", "archive")


@query("SELECT c_custkey, '' AS c_name, c_mktsegment FROM customer")
def blanked_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without their private field."""
    return c.blanked(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_name"])
