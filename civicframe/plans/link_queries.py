"""Deadlines, merges, links between records, pairs, dossiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.functions.text import norm_title, title_words
from civicframe.operators import dossiers, linkage, merge, pairs, timeliness
from civicframe.plans.registry import query, table
from civicframe.store import stored

FIRST_SHIP = "first_ship AS (SELECT l_orderkey, min(l_shipdate)::DATE AS shipped FROM lineitem GROUP BY l_orderkey)"


def _documents(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Orders as sessions and their first shipment as the publication of a document."""
    first_ship = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").cast("date").alias("published"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", F.col("o_orderdate").cast("date").alias("session"))
    return orders.join(first_ship, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("doctype", F.lit(kind)).withColumn("next_session", F.lit(None).cast("date"))


@query(
    f"""
    WITH {FIRST_SHIP}, d AS (SELECT o_orderpriority, date_diff('day', o_orderdate::DATE - INTERVAL 8 DAY, shipped) AS late FROM orders LEFT JOIN first_ship ON o_orderkey = l_orderkey)
    SELECT o_orderpriority, CASE WHEN late IS NULL THEN 'geen' WHEN late <= 0 THEN 'tijdig' ELSE 'te-laat' END AS status, count(*) AS n, CAST(sum(coalesce(greatest(late, 0), 0)) AS BIGINT) AS late_days
    FROM d GROUP BY ALL
    """
)
def timeliness_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status by the rule of eight days before, per priority."""
    d = timeliness.judged(_documents(spark, sf_dir, "agenda"))
    return d.groupBy("o_orderpriority", "status").agg(F.count("*").alias("n"), F.sum("late_days").alias("late_days"))


@query(
    f"""
    WITH {FIRST_SHIP},
    d AS (SELECT o_orderkey, shipped, lead(o_orderdate::DATE) OVER (PARTITION BY o_custkey ORDER BY o_orderdate::DATE, o_orderkey) AS nxt FROM orders LEFT JOIN first_ship ON o_orderkey = l_orderkey)
    SELECT CASE WHEN shipped IS NULL THEN 'geen' WHEN nxt IS NULL THEN 'wachtend' WHEN shipped < nxt THEN 'voor-goedkeuring' ELSE 'na-goedkeuring' END AS status, count(*) AS n FROM d GROUP BY 1
    """
)
def timeliness_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes against the next session of the same customer."""
    docs = timeliness.with_next_session(_documents(spark, sf_dir, "notulen").drop("next_session"), "o_custkey", "session", "o_orderkey")
    return timeliness.judged(docs).groupBy("status").agg(F.count("*").alias("n"))


@query(f"WITH {FIRST_SHIP}, d AS (SELECT o_orderkey, date_diff('day', o_orderdate::DATE, shipped) AS days FROM orders JOIN first_ship ON o_orderkey = l_orderkey) SELECT count(*) AS n, count(*) FILTER (o_orderkey % 11 = 0) AS n_different FROM d")
def ontime_crosscheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status recomputed from the rule's text against the stored one, of which one in eleven is turned round: these differ and no others."""
    stored = timeliness.judged(_documents(spark, sf_dir, "besluiten")).where("published is not null")
    again = stored.select("o_orderkey", F.when(F.col("published") <= F.date_add("session", 10), "tijdig").otherwise("te-laat").alias("status"))
    turned = F.when(F.col("status") == "tijdig", "te-laat").otherwise("tijdig")
    kept = stored.select("o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, turned).otherwise(F.col("status")).alias("status"))
    different = timeliness.disagreements(again, kept, ["o_orderkey"]).agg(F.count("*").alias("n_different"))
    return stored.agg(F.count("*").alias("n")).crossJoin(different)


@query(
    f"""
    WITH {FIRST_SHIP}, d AS (SELECT o_orderpriority, o_orderdate::DATE AS session, date_diff('day', o_orderdate::DATE, shipped) - 10 AS late FROM orders JOIN first_ship ON o_orderkey = l_orderkey)
    SELECT o_orderpriority, count(*) AS n_late, min(session) AS first_day, CAST(max(late) AS BIGINT) AS longest FROM d WHERE late > 0 GROUP BY o_orderpriority
    """
)
def late_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late decisions per priority: number, first day and longest delay of the list."""
    return timeliness.late_summary(timeliness.judged(_documents(spark, sf_dir, "besluiten")), "o_orderpriority")


@query("SELECT o_orderkey, o_orderdate::DATE AS session, o_orderstatus FROM orders WHERE o_orderdate::DATE >= DATE '1998-01-01' ORDER BY CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END, 2, 1 LIMIT 1")
def next_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first session from a day on, preferred ones first."""
    sessions = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("session"), "o_orderstatus")
    return timeliness.next_session(sessions, F.lit("1998-01-01").cast("date"), day="session", preferred=F.col("o_orderstatus") == "P", tie="o_orderkey")


@query(
    """
    WITH r AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS turn FROM orders)
    SELECT o_orderkey, o_orderpriority, CAST(turn AS INTEGER) AS turn FROM r ORDER BY turn, o_orderpriority LIMIT 37
    """
)
def round_robin_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, newest first, from each priority in turn."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return timeliness.round_robin(orders, "o_orderpriority", 37, F.col("o_orderdate").desc(), F.col("o_orderkey")).select("o_orderkey", "o_orderpriority", "turn")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and kind."""
    return merge.first_wins(table(spark, sf_dir, "events"), ["user_id", "event_type"], F.col("ts"), F.col("event_id")).select("user_id", "event_type", "event_id", "value")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user and kind."""
    return merge.last_wins(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "value")


@query("SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.lang, b.lang) AS lang FROM (SELECT * FROM documents WHERE doc_id % 3 <> 0) a FULL JOIN (SELECT doc_id, upper(lang) AS lang FROM documents WHERE doc_id % 3 <> 1) b USING (doc_id)")
def keep_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping tables merged, the first one preferred."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return merge.keep_both(docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 <> 1").withColumn("lang", F.upper("lang")), ["doc_id"])


@query("SELECT doc_id, CASE WHEN lang = 'en' OR quality IS NULL THEN lang ELSE 'q' || quality END AS lang FROM (SELECT doc_id, lang FROM documents) LEFT JOIN labels USING (doc_id)")
def merge_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field filled from labels where it is empty."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("was"), F.when(F.col("lang") == "en", F.col("lang")).otherwise("").alias("lang"))
    new = table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), "quality").alias("lang"))
    return merge.fill(docs, new, ["doc_id"], ["lang"]).select("doc_id", F.when(F.col("lang") == "", F.col("was")).otherwise(F.col("lang")).alias("lang"))


@query("SELECT CASE WHEN doc_id % 7 = 0 THEN 'nieuw' WHEN doc_id % 5 = 0 THEN 'verdwenen' WHEN doc_id % 11 = 0 THEN 'gewijzigd' ELSE 'gelijk' END AS change, count(*) AS n FROM documents WHERE NOT (doc_id % 7 = 0 AND doc_id % 5 = 0) GROUP BY 1")
def catalog_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each row between two snapshots."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars").where("not (doc_id % 7 = 0 and doc_id % 5 = 0)")
    new = docs.where("doc_id % 5 <> 0 or doc_id % 7 = 0").withColumn("n_chars", F.when(F.col("doc_id") % 11 == 0, -1).otherwise(F.col("n_chars")))
    return merge.snapshot_diff(docs.where("doc_id % 7 <> 0"), new, "doc_id", "n_chars").groupBy("change").agg(F.count("*").alias("n"))


@query("SELECT source, count(*) AS n_old, count(*) FILTER (doc_id % 4 <> 0) AS n_new, count(*) FILTER (doc_id % 4 <> 0) < 0.8 * count(*) AS shrank FROM documents GROUP BY source")
def shrink_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that lost more than a fifth between two snapshots."""
    n = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n_old"), F.count_if(F.col("doc_id") % 4 != 0).alias("n_new"))
    return n.withColumn("shrank", merge.shrank(F.col("n_old"), F.col("n_new")))


@query("SELECT doc_id, source, CASE WHEN source IN ('src1', 'src2') THEN 'nieuw' ELSE 'oud' END AS state FROM documents WHERE source NOT IN ('src1', 'src2') OR doc_id % 3 = 0")
def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources' rows replaced by a third of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source").withColumn("state", F.lit("oud"))
    return merge.replace_rows(docs, docs.where("source in ('src1', 'src2') and doc_id % 3 = 0").withColumn("state", F.lit("nieuw")), ["source"])


@query("SELECT doc_id, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1 THEN source ELSE source || '-' || substr(sha1(doc_id::VARCHAR), 1, 6) END AS id FROM documents")
def id_collision_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that come twice get a digest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("id"))
    return merge.suffix_duplicates(docs, [], "id", F.col("doc_id").cast("string"), F.col("doc_id"))


@query("WITH h AS (SELECT doc_id, sha1(lang || '|' || text) AS key FROM documents) SELECT min(doc_id) AS doc_id, key FROM h WHERE key NOT IN (SELECT key FROM h WHERE doc_id % 3 = 0) GROUP BY key")
def work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents that a cache does not have, each once."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha1(F.concat_ws("|", "lang", "text").cast("binary")).alias("key"))
    return merge.work_list(docs, docs.where("doc_id % 3 = 0"), "key", F.col("doc_id"))


@query("SELECT count(*) AS n_calls, CAST(floor(sum(length(text)) / 4.0::DOUBLE * 1.3::DOUBLE) AS BIGINT) AS tokens_in, count(*) * 400 AS tokens_out FROM documents")
def cost_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and tokens of a run over all documents."""
    return merge.estimated_cost(table(spark, sf_dir, "documents"), F.col("text")).withColumn("tokens_out", F.col("tokens_out").cast("long"))


@query(
    """
    WITH n AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS first_seen FROM events GROUP BY ALL)
    SELECT user_id, event_type, n FROM n QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first_seen) = 1
    """
)
def mode_postcode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commonest kind of event of each user, the first seen on a tie."""
    return merge.mode(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query(
    """
    WITH s AS (SELECT user_id, ts, event_id FROM events WHERE event_type = 'signup' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1),
    p AS (SELECT user_id, ts, event_id AS fact FROM events WHERE event_type = 'purchase'),
    j AS (SELECT p.fact, arg_max(s.event_id, s.ts) FILTER (s.ts <= p.ts) AS good, arg_min(s.event_id, s.ts) AS earliest FROM p LEFT JOIN s USING (user_id) GROUP BY p.fact)
    SELECT fact, coalesce(good, earliest) AS version, good IS NULL AS fallback FROM j
    """
)
def as_of_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest signup before each purchase, else the user's earliest, flagged."""
    events = table(spark, sf_dir, "events")
    versions = events.where("event_type = 'signup'").select("user_id", F.col("ts").alias("valid_from"), F.col("event_id").alias("version"))
    facts = events.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("fact"))
    return linkage.as_of(facts, versions, fact_id="fact", fact_day="ts", version="version", valid_from="valid_from", keys=["user_id"]).select("fact", "version", "fallback")


@query(
    """
    WITH p AS (SELECT p_partkey AS id, p_brand AS brand, string_split(p_name, ' ') AS w, p_name AS title FROM part),
    x AS (SELECT a.id AS q, b.id AS c, (a.title = b.title)::INT AS exact, len(list_filter(list_distinct(b.w), lambda u: length(u) >= 5 AND len(list_filter(list_distinct(a.w), lambda v: length(v) >= 5 AND (starts_with(v, u) OR starts_with(u, v)))) > 0)) AS score FROM p a JOIN p b ON a.brand = b.brand AND a.id <> b.id),
    r AS (SELECT *, sum(exact) OVER (PARTITION BY q) AS n_exact, row_number() OVER (PARTITION BY q ORDER BY score DESC, c DESC) AS rn, lead(score) OVER (PARTITION BY q ORDER BY score DESC, c DESC) AS nxt FROM x)
    SELECT q, c, CASE WHEN n_exact = 1 AND exact = 1 THEN 'titel' ELSE 'woorden' END AS how FROM r
    WHERE (n_exact = 1 AND exact = 1) OR (n_exact = 0 AND rn = 1 AND score >= 2 AND (nxt IS NULL OR score > nxt))
    """
)
def blocked_title_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the same brand that a part's name names, if one wins clearly."""
    return linkage.best_titles(table(spark, sf_dir, "part"), id_col="p_partkey", block="p_brand", title="p_name", least=2, stop=("",))


@query(
    """
    WITH c AS (SELECT c_custkey, c_nationkey AS nation, CAST(floor(c_acctbal / 150) AS BIGINT) AS band FROM customer),
    u AS (SELECT nation, band, min(c_custkey) AS c_custkey FROM c GROUP BY ALL HAVING count(*) = 1)
    SELECT s_suppkey, coalesce(u.c_custkey, -1) AS c_custkey FROM supplier LEFT JOIN u ON s_nationkey = nation AND CAST(floor(s_acctbal / 150) AS BIGINT) = band
    """
)
def unique_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one customer of a supplier's nation and balance band, if there is just one (-1 else)."""
    queries = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), F.floor(F.col("s_acctbal") / 150).alias("band"))
    roster = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), F.floor(F.col("c_acctbal") / 150).alias("band"))
    return linkage.unique_match(queries, roster, ["nation", "band"]).select("s_suppkey", F.coalesce("c_custkey", F.lit(-1).cast("long")).alias("c_custkey"))


@query()
def fuzzy_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line most like each benchmark text, among those of the same first word."""
    start = lambda df, i, t: df.select(F.col(i), norm_title(F.substring_index(t, "\n", 1)).alias(f"{i}_title")).withColumn("block", F.substring_index(f"{i}_title", " ", 1))
    hits, docs = start(table(spark, sf_dir, "benchmark"), "item_id", "text"), start(table(spark, sf_dir, "documents"), "doc_id", "text")
    return linkage.fuzzy_match(hits, docs, block="block", hit_title="item_id_title", candidate_title="doc_id_title", hit_id="item_id", candidate_id="doc_id")


@query()
def fuzzy_perturbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines with every ninth sign lost behind their first two words, and the whole line that each is most like among those of the same two words."""
    titles = table(spark, sf_dir, "documents").select("doc_id", norm_title(F.substring_index("text", "\n", 1)).alias("title")).withColumn("block", F.substring_index("title", " ", 2))
    titles = stored(titles, "first-lines")
    rest = F.substr("title", F.length("block") + 1)
    hits = titles.where(F.length(rest) > 20).select(F.col("doc_id").alias("hit_id"), "block", F.concat("block", F.regexp_replace(rest, "(.{8}).", "$1")).alias("hit_title"))
    return linkage.fuzzy_match(hits, titles, block="block", hit_title="hit_title", candidate_title="title", hit_id="hit_id", candidate_id="doc_id")


PAIR_TOKENS = """
    d AS (SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(strip_accents(lower(text)), '[a-z][a-z-]{4,}')) AS token FROM documents),
    b AS (SELECT DISTINCT item_id AS id, unnest(regexp_extract_all(strip_accents(lower(text)), '[a-z][a-z-]{4,}')) AS token FROM benchmark),
    w AS (SELECT token, ln((SELECT count(*) FROM documents)::DOUBLE / count(*)) AS weight FROM d GROUP BY token HAVING count(*) <= 40)
"""


def _pair_tokens(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    d = docs.select(F.col("doc_id").alias("id"), F.explode(title_words(F.col("text"))).alias("token"))
    b = items.select(F.col("item_id").alias("id"), F.explode(title_words(F.col("text"))).alias("token"))
    return d, b, pairs.idf(d, docs.count())


@query(f"WITH {PAIR_TOKENS} SELECT token, count(*) AS df, round(min(weight), 6) AS weight FROM d JOIN w USING (token) GROUP BY token")
def idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the rare tokens."""
    return _pair_tokens(spark, sf_dir)[2].select("token", "df", F.round("weight", 6).alias("weight"))


CANDIDATES = f"""
    {PAIR_TOKENS},
    s AS (SELECT b.id AS a, d.id AS b, round(sum(weight), 6) AS score FROM b JOIN w USING (token) JOIN d USING (token) WHERE b.id <> d.id GROUP BY ALL),
    c AS (SELECT *, CAST(row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS INTEGER) AS rn FROM s QUALIFY rn <= 6 AND score >= 6)
"""


@query(f"WITH {CANDIDATES} SELECT a, b, score, rn FROM c")
def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six documents that share the most weight of rare words with each benchmark text."""
    d, b, _ = _pair_tokens(spark, sf_dir)
    d = stored(d.join(b.select("token").distinct(), "token", "left_semi"), "asked_tokens")
    return pairs.candidate_pairs(b, d, pairs.idf(d, table(spark, sf_dir, "documents").count()))


@query(
    f"""
    WITH {CANDIDATES}, v AS (SELECT least(a, b) AS a, greatest(a, b) AS b, CASE WHEN score >= 9 THEN 'ja' ELSE 'nee' END AS v1, CASE WHEN b % 4 = 0 THEN NULL WHEN rn <= 3 THEN 'ja' ELSE 'twijfel' END AS v2 FROM c)
    SELECT a, b, CASE WHEN v2 IS NULL THEN 'open' WHEN v1 = 'ja' AND v2 = 'ja' THEN 'ja' ELSE 'nee' END AS outcome FROM v
    """.replace("b % 4 = 0", "c.b % 4 = 0")
)
def two_sided_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of the candidate pairs by two fixed judges, one for each order; one of them leaves some out."""
    found = candidate_pairs(spark, sf_dir)
    forth = found.select("a", "b", F.when(F.col("score") >= 9, "ja").otherwise("nee").alias("verdict"))
    back = found.select(F.col("b").alias("a"), F.col("a").alias("b"), F.when(F.col("b") % 4 == 0, None).when(F.col("rn") <= 3, "ja").otherwise("twijfel").alias("verdict"))
    return pairs.two_sided(forth.unionByName(back))


@query(
    """
    WITH d AS (SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(strip_accents(lower(text)), '[a-z][a-z-]{4,}')) AS token FROM documents),
    r AS (SELECT token FROM d GROUP BY token HAVING count(*) BETWEEN 2 AND 40),
    m AS (SELECT id, source AS author, token FROM d JOIN r USING (token) JOIN documents ON id = doc_id)
    SELECT DISTINCT x.id AS a, y.id AS b, author FROM m x JOIN m y USING (author, token) WHERE x.id < y.id
    """
)
def same_author_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one source that share a rare word: one of 2 to 40 documents."""
    d, _, weights = _pair_tokens(spark, sf_dir)
    rare = weights.where("df >= 2")
    return pairs.same_author_pairs(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("author")), d, rare)


@query(
    """
    WITH v AS (SELECT doc_id, quality AS a FROM labels UNION ALL SELECT doc_id, 1 - toxic FROM labels UNION ALL SELECT doc_id, (n_chars > 1500)::INT FROM documents JOIN labels USING (doc_id))
    SELECT doc_id, CASE WHEN 2 * sum(a) > count(*) THEN 'a' ELSE 'o' END AS verdict, count(*) AS n_votes FROM v GROUP BY doc_id
    """
)
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three verdicts on each labelled document."""
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    vote = lambda yes: F.when(yes, "a").otherwise("o").alias("verdict")
    votes = labels.select("doc_id", vote(F.col("quality") == 1)).unionByName(labels.select("doc_id", vote(F.col("toxic") == 0))).unionByName(docs.join(labels, "doc_id", "left_semi").select("doc_id", vote(F.col("n_chars") > 1500)))
    return pairs.majority(votes, "doc_id")


@query(
    """
    WITH RECURSIVE k AS (SELECT doc_id, md5(text) AS h, md5(left(text, 60)) AS p FROM documents),
    g AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS a, min(doc_id) OVER (PARTITION BY p) AS b FROM k),
    e AS (SELECT doc_id AS x, a AS y FROM g UNION SELECT doc_id, b FROM g), s AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
    r AS (SELECT x AS id, x AS seen FROM s UNION SELECT r.id, s.y FROM r JOIN s ON r.seen = s.x)
    SELECT id, min(seen) AS dossier FROM r GROUP BY id
    """
)
def dossier_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dossiers of documents with equal texts or equal beginnings."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.md5(F.col("text").cast("binary")).alias("h"), F.md5(F.substring("text", 1, 60).cast("binary")).alias("p"))
    star = lambda c: docs.groupBy(c).agg(F.min("id").alias("a")).join(docs, c).select("a", F.col("id").alias("b"))
    return dossiers.dossiers(docs, star("h").unionByName(star("p")).where("a <> b"))


