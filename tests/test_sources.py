"""Parsers and sources on small invented documents."""

import datetime

import pytest
from pyspark.sql import functions as F

from civicframe.functions import dates, money, text
from civicframe.sources import budget, html, lines, questions, sinks, votes

D = datetime.date


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize(
    "cell, value",
    [("4.768.384", 4768384), ("(1.234)", -1234), ("-12", -12), ("1.234,50", 1234), ("1.235,50", 1236), ("12a", None), ("", None), (None, None), ("10.00", None), ("0", 0)],
)
def test_amounts(spark, cell, value):
    assert one(spark, money.amount(F.col("x")), cell) == value


@pytest.mark.parametrize(
    "written, day",
    [("op 2026-04-28", D(2026, 4, 28)), ("28/04/2026", D(2026, 4, 28)), ("24 februari 2025", D(2025, 2, 24)), ("3 mrt 2025", D(2025, 3, 3)), ("31 februari 2025", None), ("niets", None)],
)
def test_written_dates(spark, written, day):
    assert one(spark, dates.written_date(F.col("x")), written) == day


def test_deadlines(spark):
    rows = [(D(2026, 4, 28), D(2026, 4, 20)), (D(2026, 4, 28), D(2026, 4, 21)), (D(2026, 4, 28), D(2026, 5, 8)), (D(2026, 4, 28), D(2026, 5, 9)), (D(2026, 4, 28), None)]
    df = spark.createDataFrame(rows, "s date, p date").select(dates.agenda_status(F.col("s"), F.col("p")).alias("a"), dates.decision_status(F.col("s"), F.col("p")).alias("d"))
    got = df.collect()
    assert [tuple(r.a) for r in got[:2]] == [("tijdig", 0), ("te-laat", 1)]
    assert [tuple(r.d) for r in got[2:]] == [("tijdig", 0), ("te-laat", 1), ("geen", 0)]


def test_text_functions(spark):
    assert one(spark, text.fold(F.col("x")), "ÀÉîøß Ñandú") == "aeiøß nandu"
    assert one(spark, text.fold_exact(F.col("x")), "ÀÉîøß Ñandú") == "aeiøß nandu"
    assert one(spark, text.slug(F.col("x")), " Stad -- & Co! ") == "stad-co" and one(spark, text.slug(F.col("x")), "!!") == "overig"
    assert one(spark, text.norm_title(F.col("x")), "Uittreksel - Één straat.") == "een straat"
    assert [one(spark, text.stem(F.col("x")), w) for w in ("straten", "auto", "autos", "open", "bus")] == ["strat", "auto", "auto", "open", "bus"]
    assert one(spark, text.html_unescape(F.col("x")), "a &amp; b") == "a & b"


DECISIONS = """Kop
Openbare zitting
1. MOBILITEIT. Eerste titel
loopt door
Goedgekeurd
Volgende punten werden door het bestuur
aan de agenda toegevoegd:
TP01. TOEGEVOEGD PUNT. Jan Voorbeeld - Over iets
Verworpen
7D. Cultuur. Vierde
Goedgekeurd
7E Bestuurlijk Beheer. Vijfde
Goedgekeurd
8. SPORT. Titel met lot
2027. Verwijzing hoort bij de titel
3. Verwijzing naar de raad
Kennisgenomen
14 A. GROEN. Zesde
26 mei 2026
Goedgekeurd
Besloten zitting
15. PERSONEEL. Zevende
Goedgekeurd"""


def test_decision_lists(spark):
    got = {r.number: r for r in lines.parse_decisions(spark.createDataFrame([("d", DECISIONS)], "doc string, text string")).collect()}
    assert list(sorted(got)) == ["1", "14A", "15", "7D", "7E", "8", "TP01"]
    assert (got["1"].title, got["1"].result, got["1"].category) == ("Eerste titel loopt door", "Goedgekeurd", "MOBILITEIT")
    assert (got["TP01"].submitter, got["TP01"].title, got["TP01"].type, got["TP01"].category) == ("Jan Voorbeeld", "Over iets", "toegevoegd", "")
    assert got["8"].title == "Titel met lot 2027. Verwijzing hoort bij de titel 3. Verwijzing naar de raad" and got["8"].result == "Kennisgenomen"
    assert got["15"].section == "besloten" and got["14A"].section == "openbaar" and got["14A"].result == "Goedgekeurd"


def test_all_checks_of_a_decision_list(spark):
    rows = [("1", "openbaar", "a", "Goedgekeurd", "gewoon", ""), ("2A", "openbaar", "b", "Goedgekeurd / Aktename", "gewoon", ""), ("2C", "openbaar", "c", "naar aanleiding van", "gewoon", ""), ("5", "openbaar", "GESCHRAPT punt", "", "gewoon", ""), ("4", "openbaar", "titel Goedgekeurd 7. Volgende", "Verdaagd", "gewoon", "POLITIEVERORDENINGEN"), ("ACT1", "besloten", "d", "Bespreking ter zitting", "actuadebat", ""), ("4", "besloten", "e", "", "gewoon", "")]
    items = spark.createDataFrame([("d", i, *r) for i, r in enumerate(rows)], "doc string, pos int, number string, section string, title string, result string, type string, category string")
    texts = spark.createDataFrame([("d", "ACT1. ACTUALITEITSDEBAT. x\n  ACT2. ACTUALITEITSDEBAT. y\n4. POLITIEVERORDENINGEN. z\nTP1. TOEGEVOEGD PUNT. q")], "doc string, text string")
    got = {(r.number, r.what) for r in lines.decision_errors(items, texts).collect()}
    expected = {("3", "gat"), ("2A", "gat"), ("2B", "gat"), ("4", "dubbel"), ("4", "volgorde"), ("2C", "resultaat"), ("4", "resultaat"), ("4", "opgeslokt"), ("ACTUALITEITSDEBAT", "punttype"), ("TOEGEVOEGD PUNT", "punttype")}
    assert got == expected
    known = spark.createDataFrame([("d", "2C", "resultaat"), ("e", "3", "gat")], "doc string, number string, what string")
    assert {(r.number, r.what) for r in lines.decision_errors(items, texts, known).collect()} == expected - {("2C", "resultaat")}


def test_promises_run_on_over_lines(spark):
    text = "1. MOBILITEIT. Titel\nO1. OPDRACHT. Nagaan hoe\n27 januari 2025\nde stad het doet.\nniet meer\nO2. OPDRACHT. Kort\nMotivering\nO3. OPDRACHT. Laatste\nregel een\n2. CULTUUR. Ander"
    got = {r.number: r.promises for r in lines.parse_minutes(spark.createDataFrame([("d", text)], "doc string, text string")).collect()}
    assert got == {"1": ["Nagaan hoe de stad het doet.", "Kort", "Laatste regel een"], "2": []}


def test_numbering_errors(spark):
    rows = [("d", 1, "1", "openbaar", "a", "ok"), ("d", 2, "3", "openbaar", "b", ""), ("d", 3, "2", "openbaar", "GESCHRAPT", ""), ("d", 4, "6", "besloten", "c", "ok"), ("d", 5, "6", "besloten", "c", "ok")]
    items = spark.createDataFrame(rows, "doc string, pos int, number string, section string, title string, result string")
    assert sorted((r.number, r.what) for r in lines.numbering_errors(items).collect()) == [("2", "volgorde"), ("3", "resultaat"), ("4", "gat"), ("5", "gat"), ("6", "dubbel")]


def test_agendas(spark):
    agenda = "Brief\nOpenbare zitting\nACT01.ACTUALITEITSDEBAT. Debat\n1. MOBILITEIT. Titel\nvervolg\n2027. geen punt\nVragen\nV1. MONDELINGE VRAAG. An Proef – Fietsen\nBesloten zitting\n2. PERSONEEL. Zaak"
    got = {r.number: r for r in lines.parse_agenda(spark.createDataFrame([("d", agenda)], "doc string, text string")).collect()}
    assert sorted(got) == ["1", "2", "ACT01", "V1"]
    assert got["1"].title == "Titel vervolg 2027. geen punt" and got["ACT01"].type == "actuadebat"
    assert (got["V1"].submitter, got["V1"].title, got["V1"].type) == ("An Proef", "Fietsen", "vraag") and got["2"].section == "besloten"


def test_minutes_and_attendance(spark):
    minutes = "Aanwezig: Jan Voorbeeld, burgemeester, An Proef, schepenen\nTijdelijk afwezig: Els Van Proef voorzitter\nOpenbare zitting\n1. MOBILITEIT. Titel\nTekst\n1. Geen kop\nO1. OPDRACHT. Nagaan hoe\n10.FINANCIEN-BELASTINGEN. Belasting\neenparigheid van stemmen"
    df = spark.createDataFrame([("d", minutes)], "doc string, text string")
    got = {r.number: r for r in lines.parse_minutes(df).collect()}
    assert sorted(got) == ["1", "10"] and got["1"].promises == ["Nagaan hoe"] and "Geen kop" in got["1"].text and got["10"].promises == []
    here = df.select(lines.attendance(F.col("text")).alias("a")).first().a
    assert here.present == ["Jan Voorbeeld", "An Proef"] and here.absent == ["Els Van Proef"]


@pytest.mark.parametrize(
    "minutes, expected",
    [
        ("met eenparigheid van stemmen", ("eenparig", None, None, None)),
        ("Met 31 stemmen voor (A, B (X)) en 12 stemmen tegen (C)", ("geteld", 31, 12, 0)),
        ("31 stemmen voor\n26 mei 2026\n(A), 11 stemmen tegen en 1 onthouding", ("geteld", 31, 11, 1)),
        ("5 stemmen voor, 30 stemmen tegen. Stemresultaat agendapunt zelf: 40 stemmen voor", ("geteld", 40, 0, 0)),
        ("5 stemmen voor. Dan 6 stemmen voor", ("meerdere", None, None, None)),
        ("40 stemmen voor en 4 stemmen tegen", ("onbekend", None, None, None)),
        ("61 stemmen voor", ("onbekend", None, None, None)),
        ("Dit punt is niet ter stemming", ("niet-ter-stemming", None, None, None)),
        ("De vraag wordt mondeling beantwoord", ("mondeling-beantwoord", None, None, None)),
        ("", ("geen", None, None, None)),
    ],
)
def test_votes(spark, minutes, expected):
    v = one(spark, votes.vote(F.col("x")), minutes)
    assert (v.modus, v.voor, v.tegen, v.onthoudingen) == expected


def test_questions(spark):
    body = "Schriftelijke vraag 2026/123\nIndiener: Jan Voorbeeld Datum indiening: 3 maart 2026\nOnderwerp: Fietsen.\nToelichtende nota: Hoeveel fietsen?\nNaam: x\nAntwoord college\nVeel fietsen.\nStad, 4 april"
    rows = [(body, "2026-123 - X - Y.pdf", "2026-04"), ("Leeg", "2026-9 - An Proef - Parkeren.pdf", "2026-05"), ("Leeg", "2026-9 - Els Proef - Lawaai.pdf", "2026-05")]
    got = sorted(questions.parse_questions(spark.createDataFrame(rows, "text string, filename string, month string")).collect(), key=lambda r: (r.date, r.subject))
    first = got[0]
    assert (first.id, first.date, first.submitter, first.subject, first.question, first.has_answer) == ("sv-2026-04-2026-123", D(2026, 3, 3), "Jan Voorbeeld", "Fietsen", "Hoeveel fietsen?", True)
    assert first.answer.startswith("Veel fietsen.") and first.source_text.endswith(first.answer)
    assert {r.date for r in got[1:]} == {D(2026, 5, 1)} and len({r.id for r in got}) == 3 and {r.submitter for r in got[1:]} == {"An Proef", "Els Proef"}


def test_budget_tables(spark):
    page = [["Entiteit", "Code", "Naam", "Raming 2026", "Rekening 2025"], ["S", "MJP0001", "Straat", "1.000", "(5)"], ["S", "MJP0002", "Plein", "2.000", "x"], ["S", "MJP0001", "dubbel", "9", "9"], ["S", "totaal", "", "3.000", "7"]]
    got = {r.code: r for r in budget.budget_lines(spark.createDataFrame([("d", 1, page)], "doc string, page int, rows array<array<string>>")).collect()}
    assert sorted(got) == ["MJP0001", "MJP0002"] and got["MJP0001"].description == "Straat"
    assert [tuple(a) for a in got["MJP0001"].amounts] == [(2025, "rekening", -5), (2026, "raming", 1000)]


def test_pages(spark):
    page = '<h2>Kruimelpad</h2><a href="/a.pdf">A</a><h2>Stad</h2><h3>Budget</h3><a class="x" href="/b.pdf">B <b>b</b></a><h2>Zorg</h2><a href="/b.pdf">weer</a><a href="/c.pdf">C</a>'
    df = spark.createDataFrame([(1, page)], "page_id int, html string")
    assert [(r.url, r.title, r.entity, r.set) for r in html.carried_links(df, chrome=("kruimelpad",)).orderBy("pos").collect()] == [("/b.pdf", "B b", "Stad", "Budget"), ("/c.pdf", "C", "Zorg", "")]
    plan = "<h3>Zittingen 2026</h3><ul><li>dinsdag 28 april</li><li>31 februari</li><li>5 mei 2027</li></ul>"
    assert {r.day for r in html.planned_sessions(spark.createDataFrame([(1, plan)], "page_id int, html string"), "page_id", "html").collect()} == {D(2026, 4, 28), D(2027, 5, 5)}
    grid = '<div class="publicatie-grid"><a href="/x?f=Agenda_28-04-2026.pdf">a</a><span>20/04/2026 10:00:00</span></div><div class="publicatie-grid"><a href="/x/Titel_28-04-2026_123.pdf">b</a></div>'
    got = html.publications(spark.createDataFrame([("raad", grid)], "organ string, html string")).orderBy("filename").collect()
    assert [(r.doctype, r.session, r.publication, r.published) for r in got] == [("agenda", D(2026, 4, 28), None, D(2026, 4, 20)), (None, D(2026, 4, 28), "123", None)]
    assert one(spark, html.safe_name(F.col("x"), F.lit("map")), "https://a/b/..%2Fc%3Fd.pdf") == ".._c_d.pdf"
    assert one(spark, html.allowed_host(F.col("x"), ["stad.be"]), "https://stad.be/x") and not one(spark, html.allowed_host(F.col("x"), ["stad.be"]), "https://kwaad.be/stad.be")


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "items")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, session string")
    sinks.replace_partitions(df, path, ["session"])
    for _ in range(2):
        sinks.replace_partitions(spark.createDataFrame([(9, "b")], "id int, session string"), path, ["session"])
        assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 9]
    assert sinks.same_content(df, df.orderBy(F.col("id").desc())) and not sinks.same_content(df, df.limit(2))
    index = spark.createDataFrame([("fiets", ["x", "y"])], "token string, items array<string>")
    out = sinks.export_index(index, spark.createDataFrame([("x", 0), ("y", 1)], "id string, number int"), spark.createDataFrame([("de",)], "token string"))
    assert ("tokens", '{"token":"fiets","n":[0,1]}') in {tuple(r) for r in out.collect()}
