"""Masks, gates, parsers, amounts, geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.functions.money import amount, belgian
from civicframe.functions.text import let
from civicframe.operators import gates, geo, merge, privacy, redaction
from civicframe.plans.registry import query, table
from civicframe.sources import lines, votes
from civicframe.store import stored

EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}"


@query(f"SELECT doc_id, CAST(len(regexp_extract_all(text, '{EMAIL}')) AS BIGINT) AS n, md5(regexp_replace(text, '{EMAIL}', '[e-mailadres]', 'g')) AS masked FROM documents")
def mask_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses in all documents, and the texts without them."""
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_count("text", F.lit(privacy.EMAIL)).cast("long").alias("n"), F.md5(privacy.mask_email(F.col("text")).cast("binary")).alias("masked"))


@query("SELECT doc_id, md5(regexp_replace(regexp_replace(text, '\\b[A-Z]{2}\\d{2}(?:[ .]?\\d{4}){3,7}\\b', '[rekeningnummer]', 'g'), '\\b\\d{3}-\\d{7}-\\d{2}\\b', '[rekeningnummer]', 'g')) AS masked FROM documents")
def mask_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without account numbers."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(privacy.mask_accounts(F.col("text")).cast("binary")).alias("masked"))


@query(f"SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_unstable, count(*) FILTER (doc_id % 10 = 0 AND regexp_matches(text, '{EMAIL}')) AS n_planted FROM documents")
def mask_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the masks would change again: none; and those with an address among the tenth that is left unmasked: the gate finds all."""
    mask = lambda t: privacy.mask_context(privacy.mask_accounts(privacy.mask_email(t)))
    docs = table(spark, sf_dir, "documents")
    part = docs.select(F.when(F.col("doc_id") % 10 == 0, F.col("text")).otherwise(privacy.mask_email(F.col("text"))).alias("text"))
    planted = gates.unstable(part, "text", privacy.mask_email).agg(F.count("*").alias("n_planted"))
    return gates.unstable_count(docs, F.col("text"), mask).crossJoin(planted)


@query(f"WITH a AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{EMAIL}'))) AS address FROM documents) SELECT address FROM a WHERE address <> (SELECT min(address) FROM a)")
def leak_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses in texts or languages that an allow-list of one does not have."""
    docs = table(spark, sf_dir, "documents")
    every = stored(privacy.leaked_addresses([F.col("text"), F.col("lang")], docs, spark.createDataFrame([], "address string")), "addresses")
    return privacy.leaked_addresses([F.col("address")], every, every.agg(F.min("address").alias("address")))


@query("SELECT lang, count(*) AS n, count(l.doc_id) AS n_good, CAST(floor(100.0 * count(l.doc_id) / count(*)) AS BIGINT) AS pct FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang")
def coverage_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of labelled documents per language."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("has")), "doc_id", "left")
    return gates.coverage(docs, F.coalesce("has", F.lit(False)), "lang")


@query(
    """
    WITH w AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda x: trim(x)) AS w FROM documents),
    t AS (SELECT doc_id, u.x, u.i FROM w, LATERAL (SELECT unnest(w) AS x, generate_subscripts(w, 1) AS i) u WHERE length(u.x) BETWEEN 1 AND 60),
    f AS (SELECT doc_id, arg_min(x, i) AS x, min(i) AS i FROM t GROUP BY doc_id, lower(x)),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM f)
    SELECT doc_id, array_to_string(list(x ORDER BY i), '|') AS terms FROM r WHERE k <= 8 GROUP BY doc_id
    """
)
def tag_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key terms, made of the first words: trimmed, distinct whatever the case, eight at most."""
    text, near = F.col("text"), 32
    few = merge.clean_terms(F.slice(F.split(text, " ", near + 1), 1, near))  # the whole text is cut only if its first words hold too few
    terms = let(few, lambda t: F.when(F.size(t) >= 8, t).otherwise(merge.clean_terms(F.split(text, " "))))
    # as the row of a generator the terms are made once, not again for the filter
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(F.array_join(terms, "|"))).alias("terms")).where("terms <> ''")


@query("SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by a JSON property."""
    return table(spark, sf_dir, "events").groupBy(F.get_json_object("props", "$.k").cast("long").alias("k")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT o_orderkey, CAST(round_even(CAST(o_totalprice AS DECIMAL(18, 2)), 0) AS BIGINT) AS amount FROM orders")
def amount_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices written in Belgian notation and read back as whole numbers."""
    return table(spark, sf_dir, "orders").select("o_orderkey", amount(belgian(F.col("o_totalprice"))).alias("amount"))


@query(
    """
    WITH m AS (SELECT l_orderkey, max(l_linenumber) AS n, list(DISTINCT l_linenumber) AS has FROM lineitem WHERE l_quantity < 25 GROUP BY l_orderkey)
    SELECT l_orderkey AS doc, CAST(unnest(list_filter(range(1, n + 1), lambda x: NOT list_contains(has, x))) AS VARCHAR) AS number, 'gat' AS what FROM m
    """
)
def numbering_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing line numbers of orders."""
    items = table(spark, sf_dir, "lineitem").where("l_quantity < 25").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("pos"), F.col("l_linenumber").cast("string").alias("number"), F.lit("openbaar").alias("section"), F.lit("t").alias("title"), F.lit("r").alias("result"))
    return lines.numbering_errors(items).where("what = 'gat'")


@query(
    """
    WITH i AS (
        SELECT l_orderkey AS doc, l_linenumber * 10000000.0 + l_extendedprice AS pos, CAST(l_quantity AS INT) % 6 + 1 AS n, CASE WHEN l_tax > 0.05 THEN chr(65 + CAST(round(l_discount * 100) AS INT) % 3) ELSE '' END AS letter,
               l_linestatus AS section, l_returnflag AS flag FROM lineitem
    ),
    num AS (SELECT doc, n, bool_or(letter = '') AS whole, list_sort(list(DISTINCT letter) FILTER (letter <> '')) AS has FROM i GROUP BY doc, n),
    top AS (SELECT doc, max(n) AS top FROM i GROUP BY doc),
    run AS (SELECT *, sum(changed) OVER (PARTITION BY doc ORDER BY pos) AS run FROM (SELECT *, CAST(section <> lag(section, 1, section) OVER (PARTITION BY doc ORDER BY pos) AS INT) AS changed FROM i)),
    down AS (SELECT *, lag(n * 10 + ascii(letter || ' ') / 100.0) OVER (PARTITION BY doc, run ORDER BY pos) AS before FROM run)
    SELECT DISTINCT * FROM (
        SELECT doc, CAST(k AS VARCHAR) AS number, 'gat' AS what FROM (SELECT doc, unnest(range(1, top + 1)) AS k FROM top) t WHERE NOT EXISTS (SELECT 1 FROM num WHERE num.doc = t.doc AND num.n = t.k)
        UNION ALL SELECT doc, n || has[1], 'gat' FROM num WHERE NOT whole
        UNION ALL SELECT doc, n || x, 'gat' FROM (SELECT doc, n, has, unnest(['A', 'B', 'C']) AS x FROM num WHERE len(has) > 0) WHERE x < has[-1] AND NOT list_contains(has, x)
        UNION ALL SELECT doc, n || letter, 'dubbel' FROM i GROUP BY doc, n, letter HAVING count(*) > 1
        UNION ALL SELECT doc, n || letter, 'volgorde' FROM down WHERE n * 10 + ascii(letter || ' ') / 100.0 < before
        UNION ALL SELECT doc, n || letter, 'resultaat' FROM i WHERE flag = 'R'
    )
    """
)
def decision_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as decision lists whose numbers, letters, sections and results come from their lines: all that breaks a rule."""
    letter = F.when(F.col("l_tax") > 0.05, F.char(65 + F.round(F.col("l_discount") * 100).cast("int") % 3)).otherwise("")
    number = F.concat((F.col("l_quantity").cast("int") % 6 + 1).cast("string"), letter)
    result = F.when(F.col("l_returnflag") == "R", "Retour").when(F.col("l_returnflag") == "A", "Aktename / Goedgekeurd").otherwise("Verdaagd")
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), (F.col("l_linenumber") * 10000000.0 + F.col("l_extendedprice")).alias("pos"), number.alias("number"), F.col("l_linestatus").alias("section"), F.lit("titel").alias("title"), result.alias("result"))
    return lines.decision_errors(items)


@query(
    """
    SELECT conv_id, turn, text AS question, answer FROM (
        SELECT conv_id, turn, role, text, lead(role) OVER w AS next_role, lead(text) OVER w AS answer FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
    ) WHERE role = 'user' AND next_role = 'assistant'
    """
)
def qa_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with the answers that follow them."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").withColumn("next_role", F.lead("role").over(w)).withColumn("answer", F.lead("text").over(w))
    return turns.where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("question"), "answer")


DISTRICTS = [("noord", [[[[-0.5, 0.0], [0.5, 0.0], [0.5, 0.5], [-0.5, 0.5]], [[-0.1, 0.1], [0.1, 0.1], [0.1, 0.2]]]]), ("zuid", [[[[-0.3, 0.0], [0.3, 0.0], [0.0, -0.4]]]])]


@query(
    """
    WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
    s AS (SELECT vec_id, x, y,
        x < 0.1 AND y > 0.1 AND y < 0.2 AND x >= -0.1 + (y - 0.1) * 2 AS in_hole,
        x >= -0.5 AND x < 0.5 AND y >= 0 AND y < 0.5 AS in_north,
        y < 0 AND y >= -0.4 AND x >= -0.3 * (y + 0.4) / 0.4 AND x < 0.3 * (y + 0.4) / 0.4 AS in_south FROM p)
    SELECT vec_id, CASE WHEN in_north AND NOT in_hole THEN 'noord' WHEN in_south THEN 'zuid' END AS district FROM s
    """
)
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District of each embedding, taken as a point by its first two numbers."""
    points = table(spark, sf_dir, "embeddings").select("vec_id", F.get("embedding", 0).cast("double").alias("x"), F.get("embedding", 1).cast("double").alias("y"))
    districts = spark.createDataFrame(DISTRICTS, "name string, polygons array<array<array<array<double>>>>")
    return geo.in_districts(points, districts, "x", "y", "vec_id").select("vec_id", "district")


@query()
def lambert72(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degrees of a grid of Lambert coordinates, one point for each vector."""
    point = geo.lambert72_to_wgs84(F.lit(140000.0) + F.col("vec_id") * 60, F.lit(180000.0) + F.col("vec_id") * 40)
    return table(spark, sf_dir, "embeddings").select("vec_id", point.alias("p")).select("vec_id", F.round("p.lon", 8).alias("lon"), F.round("p.lat", 8).alias("lat"))


MINUTES = "De raad beslist.\n{n}. FINANCIEN. Titel {n}.\nGoedgekeurd met {v} stemmen voor (A, B) en {t} stemmen tegen (C)\nO1. OPDRACHT. Nagaan.\n"


@query(
    """
    SELECT o_orderkey AS doc, CAST(o_orderkey % 9 + 1 AS VARCHAR) AS number, 'Titel ' || (o_orderkey % 9 + 1) || '.' AS title, CAST(1 AS INTEGER) AS n_promises, 'geteld' AS modus,
        CAST(o_orderkey % 40 + 1 AS INTEGER) AS voor, CAST(40 - o_orderkey % 40 AS INTEGER) AS tegen FROM orders
    """
)
def vote_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes of minutes that are made for each order: items, promises and counts."""
    n, v = F.col("o_orderkey") % 9 + 1, F.col("o_orderkey") % 40 + 1
    text = F.format_string(MINUTES.replace("{n}", "%1$d").replace("{v}", "%2$d").replace("{t}", "%3$d"), n, v, 40 - v + 1)
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), text.alias("text"))
    # as the row of a generator the vote is read once, not again for each field
    found = lines.parse_minutes(docs).select("doc", "number", "title", F.size("promises").alias("n_promises"), F.inline(F.array(votes.vote(F.col("text")))))
    return found.select("doc", "number", "title", "n_promises", "modus", "voor", "tegen")


DECISIONS = "Beslissingenlijst 2\nOpenbare zitting\n1. MOBILITEIT. Heraanleg van straat %1$d\nvervolg\nGoedgekeurd\n2. CULTUUR. Subsidie\nKennisgenomen\nBesloten zitting\n3. PERSONEEL. Aanstelling\nGoedgekeurd\n"


@query(
    """
    SELECT c_custkey AS doc, number, category, section, replace(title, '#', CAST(c_custkey AS VARCHAR)) AS title, result FROM customer,
        (VALUES ('1', 'MOBILITEIT', 'openbaar', 'Heraanleg van straat # vervolg', 'Goedgekeurd'), ('2', 'CULTUUR', 'openbaar', 'Subsidie', 'Kennisgenomen'), ('3', 'PERSONEEL', 'besloten', 'Aanstelling', 'Goedgekeurd')) AS t(number, category, section, title, result)
    """
)
def parse_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of decision lists that are made for each customer."""
    docs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"), F.format_string(DECISIONS, "c_custkey").alias("text"))
    return lines.parse_decisions(docs).select("doc", "number", "category", "section", "title", "result")


#: Texts with a name (%1$s), and what the mask leaves of them.
PRIVATE_TEXTS = (
    ("Zitting van %1$s. Advocaat Els %1$s pleit, meester An Open ook.", "Zitting van %1$s. Advocaat [naam] pleit, meester An Open ook."),
    ("Plan opgemaakt door Tom %1$s, beedigd landmeter-expert.", "Plan opgemaakt door Tom %1$s, beedigd landmeter-expert."),
    ("Plan opgemaakt door Tom %1$s, landmeter-expert.", "Plan opgemaakt door [naam], landmeter-expert."),
    ("Landmeter %1$s Kaarten bv en landmeter %1$s.", "Landmeter %1$s Kaarten bv en landmeter [naam]."),
    ("Arbeidsarts: dokter %1$s; Tom %1$s is de vertrouwenspersoon.", "Arbeidsarts: dokter [naam]; [naam] is de vertrouwenspersoon."),
    ("Syndicaal overleg, voorzitter Tom %1$s, Els %1$s, An Open, Decreet Lokaal Bestuur, Groen: Bea %1$s.", "Syndicaal overleg, voorzitter [naam], [naam], An Open, Decreet Lokaal Bestuur, Groen: [naam]."),
    ("Jan Geheim woont bij Geheim en %1$s.", "[naam] woont bij [naam] en %1$s."),
    ("Geheim en Tom %1$s beslissen.", "Geheim en Tom %1$s beslissen."),
)
#: Digits, and the letters that stand for them in a name.
LETTERS = ("0123456789", "abcdefghij")
_NAME_SQL = "'Naam' || translate(CAST({key} AS VARCHAR), '0123456789', 'abcdefghij')"


def _name(key: str) -> Column:
    return F.concat(F.lit("Naam"), F.translate(F.col(key).cast("string"), *LETTERS))


def _case_sql(key: str, texts: list[str]) -> str:
    return f"CASE {key} % {len(texts)} " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(texts)) + " END"


def _case(key: str, texts: list[str]) -> Column:
    """One of ``texts`` for each row, with the row's name in it."""
    text = F.element_at(F.array(*map(F.lit, texts)), (F.col(key) % len(texts) + 1).cast("int"))
    return F.replace(text, F.lit("%1$s"), _name(key))


@query(f"SELECT c_custkey, replace({_case_sql('c_custkey', [m for _, m in PRIVATE_TEXTS])}, '%1$s', {_NAME_SQL.format(key='c_custkey')}) AS masked FROM customer")
def redaction_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered mask of persons over texts that are made for each customer."""
    lists = redaction.Lists(public=frozenset({"An Open"}), private=("Jan Geheim",), surnames=("Geheim",))
    text = _case("c_custkey", [t for t, _ in PRIVATE_TEXTS])
    return table(spark, sf_dir, "customer").select("c_custkey", redaction.redacted(text, lists).alias("masked"))


@query(f"SELECT c_custkey FROM customer WHERE c_custkey % {len(PRIVATE_TEXTS)} NOT IN (1, 7)")
def redaction_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose made texts the mask of persons would change."""
    lists = redaction.Lists(public=frozenset({"An Open"}), private=("Jan Geheim",), surnames=("Geheim",))
    made = table(spark, sf_dir, "customer").withColumn("text", _case("c_custkey", [t for t, _ in PRIVATE_TEXTS]))
    return redaction.leaks(made, ["text"], lists).select("c_custkey")


#: Sentences with a name, and the name that the watchdog reports of each (empty: none).
WATCHED = (
    ("Aanvraag ingediend door mevrouw Els %1$s.", "Els %1$s"),
    ("Verkocht aan de heer %1$s, eigenaar: stad Proef.", "%1$s"),
    ("Het goed is verkocht aan de heer %1$s.", "%1$s"),
    ("De heer en mevrouw %1$s-Van Proef Kerkstraat 3 tekenen.", "%1$s-Van Proef"),
    ("Eigenaar Publiek Persoon en huurder Van %1$sstraat.", ""),
    ("Gegund aan Tom %1$s BV.", ""),
    ("Er kwam een bezwaar van Tom %1$s, wonend in de stad.", "Tom %1$s"),
    ("Stad Proef en consorten, mevrouw Algemeen Directeur.", ""),
    ("%1$s en consorten vragen uitstel.", "%1$s"),
)


@query(
    f"""
    WITH t AS (SELECT replace({_case_sql("s_suppkey", [n for _, n in WATCHED])}, '%1$s', {_NAME_SQL.format(key="s_suppkey")}) AS name FROM supplier)
    SELECT DISTINCT name FROM t WHERE name <> ''
    """
)
def name_watchdog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in telling sentences that are made for each supplier, without public ones, bodies, streets and firms."""
    items = table(spark, sf_dir, "supplier").select(_case("s_suppkey", [t for t, _ in WATCHED]).alias("text"))
    return redaction.name_watchdog(items, "text", spark.createDataFrame([("Publiek Persoon",)], "name string")).select("name")
