"""Parsers, masks and links over texts that are made for each row of a driver table, a form for each remainder of its key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.operators import gates, linkage, pairs, privacy
from civicframe.plans.registry import query, table
from civicframe.sources import lines, questions, votes

#: ``%n`` is a name of letters, ``%d`` a number from 1 to 30.
_NAME = ("0123456789", "abcdefghij")


def made(key: str, texts: list[str]) -> Column:
    """The text of each row: one of ``texts`` by the key, with the row's name and number."""
    text = F.element_at(F.array(*map(F.lit, texts)), (F.col(key) % len(texts) + 1).cast("int"))
    text = F.replace(text, F.lit("%n"), F.concat(F.lit("Naam"), F.translate(F.col(key).cast("string"), *_NAME)))
    return F.replace(text, F.lit("%d"), (F.col(key) % 30 + 1).cast("string"))


def made_sql(key: str, texts: list[str]) -> str:
    """The same in SQL; null stays null."""
    forms = " ".join(f"WHEN {i} THEN " + ("NULL" if t is None else "'" + t.replace("'", "''") + "'") for i, t in enumerate(texts))
    name = f"'Naam' || translate(CAST({key} AS VARCHAR), '{_NAME[0]}', '{_NAME[1]}')"
    return f"replace(replace(CASE {key} % {len(texts)} {forms} END, '%n', {name}), '%d', CAST({key} % 30 + 1 AS VARCHAR))"


CONTEXTS = [
    ("mail %n@voorbeeld,be of %n [at] voorbeeld.be", "mail [e-mailadres] of [e-mailadres]"),
    ("vzw J@M. Aktename %n", "vzw J@M. Aktename %n"),
    ("rijksregisternummer 00.00.00-000.00 en 00.00.00-000.00, %n", "rijksregisternummer [rijksregisternummer] en [rijksregisternummer], %n"),
    ("°22-03-2021 en geboren te Proef, op %d januari 1970", "°··-··-2021 en geboren te Proef, op ·· ·· 1970"),
    ("kinderen geboren op 1 januari 2020 of later, katten geboren te worden", "kinderen geboren op 1 januari 2020 of later, katten geboren te worden"),
    ("Contactpersoon %n\nTelefoon: 015 00\nEmail a\nStraat 3\n", "Contactpersoon %n\nTelefoon: [verwijderd]\nEmail [verwijderd]\nStraat 3\n"),
]


@query(f"SELECT c_custkey, {made_sql('c_custkey', [m for _, m in CONTEXTS])} AS masked FROM customer")
def mask_context_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contact forms, hidden addresses, register numbers and birth dates."""
    return table(spark, sf_dir, "customer").select("c_custkey", privacy.mask_context(made("c_custkey", [t for t, _ in CONTEXTS])).alias("masked"))


VOTES = [
    ("Goedgekeurd met eenparigheid van stemmen", "eenparig", None, None, None),
    ("Met %d stemmen voor (A, B (X)) en 12 stemmen tegen (C)", "geteld", "%d", "12", "0"),
    ("%d stemmen voor\n26 mei 2026\n(A), 11 stemmen tegen en 1 onthouding", "geteld", "%d", "11", "1"),
    ("5 stemmen voor, 30 stemmen tegen. Stemresultaat agendapunt zelf: %d stemmen voor", "geteld", "%d", "0", "0"),
    ("5 stemmen voor, 30 stemmen tegen. %d stemmen voor", "meerdere", None, None, None),
    ("61 stemmen voor", "onbekend", None, None, None),
    ("Dit punt is niet ter stemming gelegd", "niet-ter-stemming", None, None, None),
    ("De vraag wordt mondeling beantwoord", "mondeling-beantwoord", None, None, None),
    ("%n spreekt", "geen", None, None, None),
]
_votes_sql = ", ".join(f"CAST(coalesce({made_sql('o_orderkey', [v[i] for v in VOTES])}, '-1') AS {kind}) AS {name}" for i, name, kind in ((1, "modus", "VARCHAR"), (2, "voor", "INTEGER"), (3, "tegen", "INTEGER"), (4, "onthoudingen", "INTEGER")))


@query(f"SELECT o_orderkey, {_votes_sql} FROM orders WHERE NOT (o_orderkey % {len(VOTES)} = 4 AND o_orderkey % 30 + 1 = 5)")
def vote_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How items were voted, in all modes (-1: no count). A second vote of the first's counts would be no other vote, so it is left out."""
    v = votes.vote(made("o_orderkey", [t[0] for t in VOTES]))
    rows = table(spark, sf_dir, "orders").where(~((F.col("o_orderkey") % len(VOTES) == 4) & (F.col("o_orderkey") % 30 + 1 == 5)))
    return rows.select("o_orderkey", v.alias("v")).select("o_orderkey", "v.modus", *(F.coalesce(f"v.{k}", F.lit(-1)).alias(k) for k in votes.KINDS))


ATTENDING = [
    ("Aanwezig: Jan %n, voorzitter An Proef\nTijdelijk afwezig: Els Van %n\nopenbare zitting", "Jan %n|An Proef", "Els Van %n"),
    ("Aanwezig: gemeenteraadsleden Jan %n, Jan %n, met twee\nopenbare zitting", "Jan %n", ""),
    ("Geen lijst van %n", "", ""),
]


@query(f"SELECT s_suppkey, {made_sql('s_suppkey', [a for _, a, _ in ATTENDING])} AS present, {made_sql('s_suppkey', [b for _, _, b in ATTENDING])} AS absent FROM supplier")
def attendance_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who was there and who was not."""
    a = lines.attendance(made("s_suppkey", [t for t, _, _ in ATTENDING]))
    return table(spark, sf_dir, "supplier").select("s_suppkey", a.alias("a")).select("s_suppkey", F.array_join("a.present", "|").alias("present"), F.array_join("a.absent", "|").alias("absent"))


#: Items (number, letter, title) and extracts (number, letter, title, item, how) of each session.
ITEMS = [(1, None, "heraanleg marktplein"), (1, "A", "heraanleg marktplein"), (2, None, "subsidie sportclub"), (3, None, "aankoop bussen")]
EXTRACTS = [(1, None, "heraanleg marktplein", 0, "titel"), (1, "A", "vergunning marktpleinen", 1, "woorden"), (2, None, "goedkeuring begroting", None, None), (None, None, "aankoop bussen", 3, "titel"), (None, None, "de aankopen van bussen", None, None), (9, None, "aankoop bussen", None, None)]


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT c_custkey * 100 + {e} AS extract_id, c_custkey * 100 + {x[3]} AS item_id, '{x[4]}' AS how FROM customer" for e, x in enumerate(EXTRACTS) if x[3] is not None) + ")")
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts linked to items by number and by title, in a session for each customer."""
    sessions = table(spark, sf_dir, "customer").select(F.lit("GR").alias("organ"), F.col("c_custkey").alias("session"))
    rows = lambda name, found: reduce(DataFrame.unionByName, [sessions.select((F.col("session") * 100 + i).alias(name), "organ", "session", F.lit(x[0]).cast("int").alias("number"), F.lit(x[1]).cast("string").alias("letter"), F.lit(x[2]).alias("title")) for i, x in enumerate(found)])
    return linkage.link_extracts(rows("extract_id", EXTRACTS), rows("item_id", ITEMS)).select("extract_id", "item_id", "how")


@query(
    """
    WITH n AS (SELECT c_custkey AS a, c_custkey + 1 AS b FROM customer WHERE c_custkey % 5 = 0 UNION SELECT c_custkey, c_custkey + 7 FROM customer WHERE c_custkey % 4 = 0)
    SELECT DISTINCT a, b FROM n WHERE a % 5 = 0 AND b = a + 1 OR (EXISTS (SELECT 1 FROM customer WHERE c_custkey = b) AND b = a + 7)
    """
)
def sticky_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh pairs, and the former ones whose items are still there."""
    items = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    fresh = items.where("id % 5 = 0").select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    former = items.where("id % 4 = 0").select(F.col("id").alias("a"), (F.col("id") + 7).alias("b"))
    return pairs.sticky(former, fresh, items)


IDS = ["gr-20260101-%d", "rmw-20260101-%d", "GR-20260101-%d", "gr-2026-%d", "gr-20260101-%dA", ""]


@query(f"SELECT {made_sql('c_custkey', IDS)} AS id FROM customer WHERE c_custkey % 6 IN (2, 3, 5)")
def id_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that break the grammar."""
    return gates.bad_ids(table(spark, sf_dir, "customer").select(made("c_custkey", IDS).alias("id")), "id", r"[a-z]+-\d{8}-\d+[A-Z]?").select("id")


QUESTION = "Schriftelijke vraag 2026/%d\nIndiener: Jan %n Datum indiening: 3 maart 2026\nOnderwerp: Fietsen.\nToelichtende nota: Hoeveel fietsen?\nNaam: x\nAntwoord college\nVeel fietsen.\nStad, 4 april"


@query(f"SELECT {made_sql('s_suppkey', ['Jan %n'])} AS submitter, DATE '2026-03-03' AS date, 'Fietsen' AS subject, 'Hoeveel fietsen?' AS question, true AS has_answer, count(*) AS n FROM supplier GROUP BY ALL")
def question_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of written questions."""
    text, number = made("s_suppkey", [QUESTION]), (F.col("s_suppkey") % 30 + 1).cast("string")
    files = table(spark, sf_dir, "supplier").select(text.alias("text"), F.concat(F.lit("2026-"), number, F.lit(" - X - Y.pdf")).alias("filename"), F.lit("2026-04").alias("month"))
    return questions.parse_questions(files).groupBy("submitter", "date", "subject", "question", "has_answer").agg(F.count("*").alias("n"))
