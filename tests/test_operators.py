"""Links, masks, gates, assembly, geometry and streams on small invented tables."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from civicframe.operators import assemble, codes, dossiers, gates, geo, index, linkage, merge, pairs, privacy
from civicframe.sources import sinks
from civicframe.streaming import ingest

D = datetime.date


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first().y


def test_extracts_link_by_number_and_by_title(spark):
    items = spark.createDataFrame([("i1", "cbs", "s", 7, "D", "aanleg straat oost"), ("i2", "cbs", "s", 8, None, "subsidie verenigingen sport"), ("i3", "cbs", "s", 9, None, "subsidie verenigingen cultuur")], "item_id string, organ string, session string, number int, letter string, title string")
    rows = [("e1", "cbs", "s", 7, "D", "aanleg van straat"), ("e2", "cbs", "s", 77, None, "subsidie verenigingen sport"), ("e3", "cbs", "s", None, None, "subsidie verenigingen sport"), ("e4", "cbs", "s", None, None, "subsidies verenigingen"), ("e5", "cbs", "s", None, None, "subsidies verenigingen culturele")]
    extracts = spark.createDataFrame(rows, "extract_id string, organ string, session string, number int, letter string, title string")
    got = {r.extract_id: r.item_id for r in linkage.link_extracts(extracts, items).collect()}
    assert got == {"e1": "i1", "e3": "i2"}


def test_as_of(spark):
    versions = spark.createDataFrame([("k", "p1", D(2025, 1, 1)), ("k", "p2", D(2026, 1, 1))], "code string, plan string, f date")
    facts = spark.createDataFrame([(1, "k", D(2025, 6, 1)), (2, "k", D(2026, 1, 1)), (3, "k", D(2020, 1, 1)), (4, "k", None), (5, "z", D(2026, 1, 1))], "id int, code string, d date")
    got = {r.id: (r.plan, r.fallback) for r in linkage.as_of(facts, versions, fact_id="id", fact_day="d", version="plan", valid_from="f", keys=["code"]).collect()}
    assert got == {1: ("p1", False), 2: ("p2", False), 3: ("p1", True), 4: ("p1", True), 5: (None, True)}


def test_plan_validity(spark):
    plans = spark.createDataFrame([("a", 2026, 2031), ("b", 2020, 2025)], "plan string, first_year int, last_year int")
    titles = spark.createDataFrame([("Vaststelling meerjarenplan 2026-2031", D(2025, 12, 20)), ("Vaststelling van het meerjarenplan 2026 - 2031", D(2025, 12, 1))], "title string, day date")
    assert {r.plan: r.valid_from for r in linkage.plan_validity(plans, titles).collect()} == {"a": D(2025, 12, 1), "b": D(2020, 1, 1)}


def test_pairs_and_verdicts(spark):
    v = spark.createDataFrame([("a", "b", "ja"), ("b", "a", "ja"), ("a", "c", "ja"), ("c", "a", "nee"), ("a", "d", "ja"), ("b", "d", "ja"), ("d", "b", None)], "a string, b string, verdict string")
    assert {(r.a, r.b): r.outcome for r in pairs.two_sided(v).collect()} == {("a", "b"): "ja", ("a", "c"): "nee", ("a", "d"): "open", ("b", "d"): "open"}
    votes = spark.createDataFrame([("x", "a"), ("x", "a"), ("x", "o"), ("y", "a"), ("y", "o")], "word string, verdict string")
    assert {r.word: r.verdict for r in pairs.majority(votes, "word").collect()} == {"x": "a", "y": "o"}
    assert pairs.unfinished(spark.createDataFrame([("a", "b"), ("a", "d")], "a string, b string"), v).count() == 1
    extra = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "a"), ("a", "zz"), ("c", "d")], "a string, b string")
    items = spark.createDataFrame([("a", True), ("b", False), ("c", False), ("d", False)], "id string, is_question boolean")
    assert [tuple(r) for r in pairs.validated_extra(extra, items).collect()] == [("a", "b")]
    groups = spark.createDataFrame([("i", "g"), ("j", "g"), ("k", "h")], "item string, group string")
    yes, no = spark.createDataFrame([("q", "i"), ("q", "j"), ("q", "k"), ("r", "i")], "question string, item string"), spark.createDataFrame([("r", "j")], "question string, item string")
    assert [(r.question, r.group) for r in pairs.place_questions(yes, no, groups).collect()] == [("q", "g")]


def test_codes(spark):
    items = spark.createDataFrame([(1, "MJP000123 en 2026-GR-12"), (2, "zie mjp0001, MJP000123 en OMV/2026001234"), (3, "omv_2026001234 2026_gr_12x 2026_GR_12")], "id int, text string")
    edges = codes.mined(items, "id", F.col("text"))
    got = {(r.kind, r.code, r.n_items, r["item"]) for r in codes.linking(edges).collect()}
    assert got == {("mjp", "MJP000123", 2, 1), ("mjp", "MJP000123", 2, 2), ("omv", "OMV_2026001234", 2, 2), ("omv", "OMV_2026001234", 2, 3), ("zaak", "2026_GR_12", 2, 1), ("zaak", "2026_GR_12", 2, 3)}
    assert {tuple(r)[:2] + (r.n,) for r in codes.related(edges).collect()} == {(1, 2, 1), (2, 3, 1), (1, 3, 1)}
    assert {(r.a, r.b, r.n) for r in codes.related(edges, wide=1).collect()} == {(i, None, 2) for i in (1, 2, 3)}  # wide codes give members, none is lost
    assert codes.related(edges, wide=1).count() == 6


def test_as_of_against_brute_force(spark):
    import random

    rnd = random.Random(5)
    day = lambda: f"20{rnd.randint(20, 23)}-{rnd.randint(1, 12):02}-{rnd.randint(1, 28):02}"
    versions = [(rnd.choice("aabc"), day(), rnd.randint(0, 99)) for _ in range(60)]
    facts = [(i, rnd.choice("aaabcd") if i % 17 else None, day() if i % 13 else None) for i in range(300)] + [(0, "a", "2022-02-02")] * 2

    def brute(key, d):
        mine = sorted((f, v) for k, f, v in versions if k == key)
        good = [f for f, _ in mine if d and f <= d]
        if not mine:
            return None, True
        return (min(v for f, v in mine if f == max(good)), False) if good else (mine[0][1], True)

    f, v = spark.createDataFrame(facts, "id int, code string, d string"), spark.createDataFrame(versions, "code string, f string, plan int")
    f, v = f.withColumn("d", F.col("d").cast("date")), v.withColumn("f", F.col("f").cast("date"))
    for days in (32, 3, 100_000):
        got = linkage.as_of(f, v, fact_id="id", fact_day="d", version="plan", valid_from="f", keys=["code"], days=days)
        assert got.columns == ["id", "code", "d", "plan", "fallback"]
        assert sorted(str((r.id, r.plan, r.fallback)) for r in got.collect()) == sorted(str((i, *brute(k, d))) for i, k, d in facts)


def test_best_titles_against_pairs(spark):
    import random

    rnd = random.Random(3)
    words = ["heraanleg", "heraanlegging", "marktplein", "marktpleinen", "subsidies", "subsidie", "zon"]
    rows = [(i, rnd.choice(["x", "y", None]) if i else None, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 4))) if i % 19 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, b string, t string")
    pairs_ = df.select(F.col("id").alias("q"), "b", F.col("t").alias("qt")).join(df.select(F.col("id").alias("c"), "b", F.col("t").alias("ct")), "b").where("q <> c and qt is not null and ct is not null")
    want = linkage.best_title(pairs_, "q", "c", F.col("qt"), F.col("ct"), least=2, stop=("",))
    got = linkage.best_titles(df, id_col="id", block="b", title="t", least=2, stop=("",))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 5


def test_dossiers_with_corrections(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("d", "e")], "a string, b string")
    fixed = dossiers.corrected(links, spark.createDataFrame([("c",)], "id string"), spark.createDataFrame([("b", "d")], "a string, b string"))
    items = spark.createDataFrame([(x,) for x in "abcdef"], "id string")
    assert {r.id: r.dossier for r in dossiers.dossiers(items, fixed).collect()} == {"a": "a", "b": "a", "c": "c", "d": "a", "e": "a", "f": "f"}


@pytest.mark.parametrize(
    "text, masked",
    [
        ("mail x@voorbeeld,be nu", "mail [e-mailadres] nu"),
        ("jan [at] voorbeeld.be", "[e-mailadres]"),
        ("vzw J@M. Aktename", "vzw J@M. Aktename"),
        ("RR 00.00.00-000.00 x", "RR [rijksregisternummer] x"),
        ("nr 00.01.02-003.04 x", "nr [rijksregisternummer] x"),
        ("kind °22-03-2021.", "kind °··-··-2021."),
        ("geboren te Plaats, op 01-02-1970", "geboren te Plaats, op ··-··-1970"),
        ("geboren te Plaats, op 1 januari 1970", "geboren te Plaats, op ·· ·· 1970"),
        ("kinderen geboren op 1 januari 2020", "kinderen geboren op 1 januari 2020"),
        ("Contactpersoon X\nTelefoon: 015 00\nEmail a\n", "Contactpersoon X\nTelefoon: [verwijderd]\nEmail [verwijderd]\n"),
    ],
)
def test_context_masks(spark, text, masked):
    assert one(spark, privacy.mask_context(F.col("x")), text) == masked
    assert one(spark, privacy.mask_context(privacy.mask_context(F.col("x"))), text) == masked


def test_other_masks(spark):
    assert one(spark, privacy.mask_accounts(F.col("x")), "BE00 0000 0000 0000 en 000-0000000-00, 2026/7450100/08/89/01") == "[rekeningnummer] en [rekeningnummer], 2026/7450100/08/89/01"
    assert one(spark, privacy.mask_birth_tables(F.col("x"), F.lit(True)), "12/03/74 2026/7450100/08/89/01") == "··/··/74 2026/7450100/08/89/01"
    assert one(spark, privacy.mask_names(F.col("x"), ["Jan Van Proef"]), "Jan  Van Proef en Van Proef Jan; Van Proef") == "[naam] en [naam]; [naam]"
    assert one(spark, privacy.mask_names(F.col("x"), ["Jan Proef"]), "Proef alleen, Proefman") == "Proef alleen, Proefman"
    assert one(spark, privacy.mask_phrases(F.col("x"), ["ernstig ziek"]), "is ernstig\nziek") == "is [verwijderd]"
    assert one(spark, privacy.indexable(F.col("x")), "31 stemmen voor (Jan X, An Y), de heer Jan Proef en mevrouw de Gouverneur") == "31 stemmen voor,   en mevrouw de Gouverneur"
    cut = lambda t, *public: one(spark, privacy.indexable(F.col("x"), public), t)
    assert cut("Aanvrager 2 Jan Voorbeeld Kerkstraat 3") == "Aanvrager 2 Kerkstraat 3" and cut("Adres aanvrager: Kerkstraat 3") == "Adres aanvrager: Kerkstraat 3"
    assert cut("Exploitant: Els Proef Onderneming X") == "Exploitant: Onderneming X" and cut("contactpersoon: Jan De Proef Adres") == "contactpersoon: Adres"
    assert cut("OGV Voorbeeld en Meester Proefsma. a@b.be") == "  en  .  " or cut("OGV Voorbeeld en Meester Proefsma.") == "  en  ."
    named = "door de heer An  Open, mevrouw An Dicht, dhr. J. Proef en mr. Van Proef"
    assert cut(named, "An Open", "J. Proef", "Van Proef") == "door de heer An  Open,  ,   en  "


def test_index_is_true_and_search_finds(spark):
    items = spark.createDataFrame([("a", "Fietspad aangelegd in de wijk", "Fietspad"), ("b", "Het fietspaden netwerk", "Netwerk"), ("c", "", "x")], "id string, full string, seen string")
    tokens = index.item_tokens(items, "id", F.col("full"), F.col("seen"))
    built = index.inverted_index(tokens, max_items=1)
    assert {r.token: r["items"] for r in built.collect()} == {"aangelegd": ["a"], "wijk": ["a"], "fietspaden": ["b"]}
    assert index.index_errors(built, items, "id", F.col("full"), F.col("seen")).count() == 0
    lie = spark.createDataFrame([("fietspad", ["a"]), ("wijk", ["zz"])], "token string, items array<string>")
    assert index.index_errors(lie, items, "id", F.col("full"), F.col("seen")).count() == 2
    assert {r.id: r.hit_visible for r in index.search(items, "id", ["fietspad"], F.col("full"), F.col("seen")).collect()} == {"a": True, "b": False}
    words = spark.createDataFrame([("sport",), ("transport",), ("watersport",), ("water",), ("tran",), ("sportveld",)], "token string")
    assert {r.token for r in index.compounds(words, "sport", ["transport"]).collect()} == {"sport", "watersport", "sportveld"}


def test_gates(spark):
    df = spark.createDataFrame([("a-1", "x", "x"), ("B", "[dry-run]", "y")], "id string, decoded string, title string")
    assert gates.bad_ids(df, "id", "[a-z]-\\d").count() == 1 and gates.dry_run_texts(df, "decoded").count() == 1
    assert gates.coverage(df, gates.summarised(F.col("decoded"), F.col("title"))).first().pct == 50
    assert gates.assert_gate("leeg", df.limit(0)) == 0 and gates.assert_gate("demo", df, demo=True) == 2
    with pytest.raises(gates.GateError):
        gates.assert_gate("vol", df)
    page = spark.createDataFrame([("{{D}} {{D}}",), ("{{D}} https://bron.be/a",)], "page string")
    assert gates.not_once(page, "page", "{{D}}").count() == 1 and gates.host_leaks(page, "page", "bron.be", []).count() == 1 and gates.host_leaks(page, "page", "bron.be", ["https://bron.be/\\w"]).count() == 0
    links = spark.createDataFrame([("i", "e1", "u1", "uittreksel", "1", "k1"), ("i", "e2", "u2", "uittreksel", "2", "k2"), ("j", None, "u1", "bijlage", None, "k1")], "item_id string, extract_id string, url string, kind string, number string, key string")
    items = spark.createDataFrame([("i", "1"), ("j", "2")], "item_id string, number string")
    found = {(r.what, r.id) for r in gates.link_errors(links, items, spark.createDataFrame([("k1",)], "key string")).collect()}
    assert found == {("meer dan een uittreksel", "i"), ("stuk bij twee punten", "u1"), ("bijlage zonder uittreksel", "u1"), ("ander puntnummer", "i"), ("tekst ontbreekt", "k2")}


def test_files_behind_links(spark):
    import hashlib

    key = lambda *x: hashlib.sha1("|".join(map(str, x)).encode()).hexdigest()
    catalogue = spark.createDataFrame([("u1", "a.pdf"), ("u2", "b.pdf"), ("u3", "b.pdf"), ("u4", "gone.pdf")], "url string, path string")
    files = spark.createDataFrame([("a.pdf", 17, 5), ("b.pdf", 18, 6)], "path string, modified long, size long")
    links = spark.createDataFrame([("i", "u1", key("a.pdf", 17, 5)), ("j", "u2", key("a.pdf", 17, 5)), ("k", "u4", "x"), ("l", "u2", None), ("m", "other", "x")], "item_id string, url string, key string")
    assert {(r.what, r.id) for r in gates.file_errors(links, catalogue, files).collect()} == {("tekst van een ander stuk", "j"), ("tekst zonder bestand", "k"), ("bestandsnaam gedeeld", "b.pdf")}


def test_debates_missing_from_the_list(spark):
    agenda = spark.createDataFrame([("s", "ACT01", "actuadebat", " cd&v vraagt ", 1), ("s", "ACT1", "actuadebat", "later", 2), ("s", "ACT2", "actuadebat", "twee", 1), ("s", "ACT3", "actuadebat", "op lijst", 1), ("s", "V1", "vraag", "v", 1)], "session_id string, number string, type string, title string, ord int")
    minutes = spark.createDataFrame([("s", "ACT", 3, "actualiteitsdebat", "afgebroken", "tekst", None), ("s", "ACT9", 4, "actualiteitsdebat", "enkel notulen", "t9", "v")], "session_id string, number string, block int, type string, title string, text string, vote string")
    decisions = spark.createDataFrame([("s", "ACT03"), ("s", "1")], "session_id string, number string")
    got = {r.id: (r.status, r.title, r.source_text, r.result and r.result.text) for r in assemble.debates(minutes, agenda, decisions).collect()}
    assert got == {
        "s-ACT01": ("beslist", "cd&v vraagt", "tekst", "Bespreking ter zitting"), "s-ACT2": ("agenda", "twee", "ACT2. ACTUALITEITSDEBAT. twee", None), "s-ACT9": ("beslist", "enkel notulen", "t9", "Bespreking ter zitting"),
    }


def test_watchdogs(spark):
    items = spark.createDataFrame([(1, "De aanvrager Jan Proef woont hier. De heer Open Baar sprak."), (2, "Ernstig ziek in Proefstraat 12 meldt de heer Jan Proef."), (3, "bezwaar van Els Geheim; en een proef")], "id int, text string")
    public = spark.createDataFrame([("Open Baar",)], "name string")
    assert [r.id for r in privacy.health_watch(items, "id", "text", ["ziek"]).collect()] == [2]
    built = spark.createDataFrame([("geheim", [3]), ("els", [1])], "token string, items array<int>")
    assert [(r.id, r.token) for r in privacy.index_audit(items, "id", "text", built, public).collect()] == [(3, "geheim")]


def test_assembly(spark):
    decisions = spark.createDataFrame([("s", "1", "MOBILITEIT", "openbaar", False, None, "gewoon", "titel", "Goedgekeurd"), ("s", "2", "X", "besloten", False, None, "gewoon", "twee", "")], "session_id string, number string, category string, section string, added boolean, submitter string, type string, title string, result string")
    minutes = spark.createDataFrame([("s", "1", 1, "gewoon", "oud", "t", ["p"], "eenparig"), ("s", "1", 2, "gewoon", "nieuw", "t", None, "geteld"), ("s", "V1", 3, "vraag", "Antwoord ja", "vraag een", None, None)], "session_id string, number string, block int, type string, text string, title string, promises array<string>, vote string")
    themes = spark.createDataFrame([("MOBILITEIT", ["verkeer"])], "category string, themes array<string>")
    got = {r.id: r for r in assemble.decided_items(decisions, minutes, themes).collect()}
    assert got["s-1"].source_text == "nieuw" and got["s-1"].result.decision == "goedgekeurd" and got["s-1"].themes == ["verkeer"] and got["s-1"].title == "Titel"
    assert got["s-2"].result is None and got["s-2"].section == "besloten" and got["s-2"].themes == []
    agenda = spark.createDataFrame([("s", "V1", "vraag", "Vraag", "Jan", 1, ""), ("s", "V2", "vraag", "tweede", "An", 1, ""), ("s", "V2", "vraag", "later", "An", 2, "")], "session_id string, number string, type string, title string, submitter string, ord int, category string")
    asked = {r.number: (r.title, r.status, r.submitter) for r in assemble.oral_questions(minutes, agenda).collect()}
    assert asked == {"V1": ("Vraag een", "beslist", "Jan"), "V2": ("Tweede", "op-agenda", "An")}
    assert assemble.missing_questions(agenda, decisions).count() == 3
    assert {r.number: r.title for r in assemble.upcoming_items(agenda).collect()} == {"V1": "Vraag", "V2": "later"}


def test_repairs(spark):
    assert one(spark, merge.repaired_list(F.col("x")), "['a', \"b'c\"]") == ["a", "b'c"] and one(spark, merge.repaired_list(F.col("x")), "los") == []
    assert one(spark, merge.clean_terms(F.split("x", ",")), " Aa,,aa , b," + "c" * 61) == ["Aa", "b"]


def test_geometry(spark):
    p = spark.range(1).select(geo.lambert72_to_wgs84(F.lit(157942.0), F.lit(190700.0)).alias("p")).first().p
    assert p.lon == pytest.approx(4.4803, abs=2e-3) and p.lat == pytest.approx(51.0259, abs=2e-3)
    split = spark.createDataFrame([("Lange Straat 9 bus 205, 2800 Plaats",), ("Dam 106-108, 2800 Plaats",), ("zonder komma",)], "a string").select(geo.split_address(F.col("a")).alias("s")).collect()
    assert [tuple(r.s) for r in split] == [("Lange Straat", "2800", "Plaats"), ("Dam", "2800", "Plaats"), (None, None, None)]
    rows = [("Dam 1, 2800 P", "o1", 1), ("Dam 2, 2801 Q", "o2", 2), ("Dam 3, 2801 Q", "o3", 3), ("Kaai 1, 2801 Q", "o4", 4), ("Kaai 2, 2800 P", "o5", 5)]
    got = {r.street: r for r in geo.street_register(spark.createDataFrame(rows, "address string, object_id string, ord int")).collect()}
    assert got["Dam"].postcode == "2801" and got["Dam"].objects == {"2800": "o1", "2801": "o2"} and got["Kaai"].postcode == "2801"


def test_streams(spark, tmp_path):
    source, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    df = spark.createDataFrame([(1, "a", datetime.datetime(2026, 1, 1)), (2, "a", datetime.datetime(2026, 1, 1, 1)), (3, "b", datetime.datetime(2026, 1, 1, 2))], "id int, url string, ts timestamp")
    df.coalesce(1).write.mode("append").parquet(source)
    for expected in (2, 2):
        ingest.run_available(ingest.first_seen(ingest.new_files(spark, source, df.schema), "url", "ts"), out, check)
        assert spark.read.schema(df.schema).parquet(out).count() == expected
    table = str(tmp_path / "table")
    for batch, rows in enumerate([[(1, "x"), (2, "y")], [(2, "z")]]):
        ingest.upsert_into(table, "id")(spark.createDataFrame(rows, "id int, v string"), batch)
    assert {r.id: r.v for r in ingest.current(spark, table, "id").collect()} == {1: "x", 2: "z"}
    ingest.upsert_into(table, "id", order="v")(spark.createDataFrame([(2, "b"), (2, "zz"), (2, "a")], "id int, v string"), 9)
    assert {r.id: r.v for r in ingest.current(spark, table, "id").collect()} == {1: "x", 2: "zz"}


def test_fuzzy_title_compares_whole_first_lines(spark, tmp_path):
    from difflib import SequenceMatcher

    from civicframe.plans.link_queries import fuzzy_title

    r = random.Random(11)
    some = lambda n: " ".join(r.choice("plan straat water school markt brug park fiets".split()) for _ in range(n))
    head = "besluit " + some(16)
    items = [(1, head + " " + some(30)), (2, "besluit kort\nmet veel tekst"), (3, "anders " + some(9)), (4, head)]
    docs = [(10, head + " " + some(30)), (11, items[0][1] + " en"), (12, items[0][1] + " en"), (13, "besluit kort\nheel iets anders dan daar"), (14, items[2][1][:-3]), (15, "besluit kort met veel tekst"), (16, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    line = lambda t: t.split("\n")[0]
    expected = []
    for i, t in items:
        near = [(-SequenceMatcher(None, line(t), line(u)).ratio(), d) for d, u in docs if u is not None and line(u).split()[0] == line(t).split()[0]]
        best, d = min(near)
        if -best >= 0.72:
            expected.append((i, d, round(-best, 3)))
    got = sorted(tuple(x) for x in fuzzy_title(spark, str(tmp_path)).collect())
    assert got == expected and (1, 11) in [x[:2] for x in got]


def test_search_synonyms_has_no_limit_of_documents(spark, sf_dir):
    from civicframe.plans.search_queries import search_synonyms

    plan = search_synonyms(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "1000000" not in plan
    tokens = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, "c")], "id long, token string")
    groups = spark.createDataFrame([("a", "g"), ("b", "g"), ("c", "h")], "word string, group string")
    assert sorted(tuple(r) for r in index.synonym_items(tokens, groups, "a").collect()) == [(1, 0), (2, 1)]


def test_late_lists_gathers_no_list(spark, sf_dir):
    from civicframe.plans.link_queries import late_lists

    assert "collect_list" not in late_lists(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def test_messages_verdicts_and_reports(spark):
    items = spark.createDataFrame([("a", "A  een\n twee", "2026-01-01"), ("b", None, None)], "id string, text string, day string")
    said = items.select("id", pairs.described(F.col("id"), F.col("day"), F.lit("Raad"), F.col("text"), most=5).alias("description"))
    assert {r.id: r.description for r in said.collect()} == {"a": "Titel: a\nDatum: 2026-01-01\nOrgaan: Raad\nSamenvatting: A een", "b": "Titel: b\nDatum: \nOrgaan: Raad\nSamenvatting: "}
    asked = pairs.judge_messages(spark.createDataFrame([("a", "b")], "a string, b string"), said, model="m", prompt="1")
    rows = {r.order: r for r in asked.collect()}
    assert rows[1].message.startswith("Stuk A\nTitel: a") and rows[2].message.startswith("Stuk A\nTitel: b") and rows[1].key != rows[2].key
    assert pairs.to_ask(asked.unionByName(asked), asked.where("order = 1")).count() == 1
    answers = spark.createDataFrame([('zeg: {"oordeel": "ja"} {x}',), ('{"oordeel": "wie weet"}',), ("niets",), (None,), ('{"oordeel": "nee"',)], "x string")
    assert [r.v for r in answers.select(pairs.read_verdict(F.col("x")).alias("v")).collect()] == ["ja", "twijfel", "twijfel", None, "twijfel"]
    hits = spark.createDataFrame([("k", 1, "een"), ("k", 2, "twee"), ("k", 3, "drie"), ("l", 4, "vier")], "keyword string, hit_id int, title string")
    matches = spark.createDataFrame([(1, "i", 0.72049), (2, "i", 0.7199999), (3, "weg", 0.9)], "hit_id int, item_id string, score double")
    known = spark.createDataFrame([("i", "Raad", "2026", "Een")], "item_id string, organ string, day string, title string")
    got = {r.keyword: r for r in linkage.dossier_report(hits, matches, known).collect()}
    assert [(x.item_id, x.score) for x in got["k"]["items"]] == [("i", 0.72)] and [(x.hit_id, x.best_score) for x in got["k"].unlinked] == [(2, 0.72), (3, 0.9)] and got["l"].n_unlinked == 1


def test_fuzzy_titles_equal_difflib(spark, sf_dir):
    import re
    from difflib import SequenceMatcher

    from civicframe.functions.text import norm_title
    from civicframe.plans.registry import queries

    got = {r.hit_id: (r.doc_id, r.ratio) for r in queries()["fuzzy_perturbed"](spark, sf_dir).collect()}
    titles = {r.doc_id: r.t for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", norm_title(F.get(F.split("text", "\n"), 0)).alias("t")).collect()}
    block = lambda t: " ".join(t.split(" ")[:2])
    expected = {}
    for i, t in titles.items():
        if t is not None and len(t[len(block(t)):]) > 20:
            hit = block(t) + re.sub("(.{8}).", r"\1", t[len(block(t)):])
            rated = [(SequenceMatcher(None, hit, u).ratio(), -j) for j, u in titles.items() if u is not None and block(u) == block(t)]
            ratio, j = max(rated)
            if ratio >= 0.72:
                expected[i] = (-j, round(ratio, 3))
    assert got == expected and len(got) > 80


def test_fuzzy_match_by_bounds_equals_difflib(spark):
    import random
    from difflib import SequenceMatcher

    from civicframe.functions.text import _ratio_from

    draw = random.Random(3)
    names = ["x " + "".join(draw.choice("abcdefgh ") for _ in range(n)) for n in (60, 90, 120, 250, 700) for _ in range(8)]
    hits = [n[:20] + n[21:] for n in names]
    rows = spark.createDataFrame([(i + 100 * k, "x", t) for k in (0, 1) for i, t in enumerate(hits)], "h int, block string, a string")
    found = linkage.fuzzy_match(rows, spark.createDataFrame([(i, "x", n) for i, n in enumerate(names)], "c int, block string, b string"), block="block", hit_title="a", candidate_title="b", hit_id="h", candidate_id="c")
    got, expected = {r.h: (r.c, r.ratio) for r in found.collect()}, {}
    for i, t in enumerate(hits):
        ratio, c = max((SequenceMatcher(None, t, n).ratio(), -j) for j, n in enumerate(names))
        if ratio >= 0.72:
            expected |= {i: (-c, round(ratio, 3)), i + 100: (-c, round(ratio, 3))}
    assert got == expected and len(got) > 40
    assert all(_ratio_from(t, n, 0.0) == SequenceMatcher(None, t, n).ratio() for t in hits[::3] for n in names)


def test_sessions_replaced_and_pages_filled(spark):
    old = spark.createDataFrame([("demo-1", "c", "2026-01-01"), ("x-1", "c", "2026-01-02"), ("x-2", "c", "2026-01-03")], "id string, organ string, date string")
    new = spark.createDataFrame([("x-3", "c", "2026-01-02")], "id string, organ string, date string")
    assert [r.id for r in merge.replace_sessions(old, new, ["organ", "date"]).collect()] == ["x-2", "x-3"]
    with pytest.raises(ValueError, match="2 times"):
        sinks.filled_page(spark, "__D__ __D__", {"__D__": old})
    page = sinks.filled_page(spark, "a __D__ b", {"__D__": spark.createDataFrame([("</b>",)], "t string")}).first().page
    assert page == 'a [{"t":"<\\/b>"}] b'


def test_merged_spans_in_cells_equal_plain_merging(spark):
    from civicframe.operators.catalogue import merged_spans

    rng = random.Random(3)
    day = datetime.date(2026, 1, 1)
    rows = []
    for key in ("a", "b", None):
        for _ in range(300 if key == "a" else 20):
            s = rng.randrange(2000)
            rows.append((key, s, s + rng.choice([0, 1, 2, 5, 40])))
    rows += [("c", 5, 5), ("c", 5, 5), ("d", 0, 3000), ("d", 10, 11), ("d", 2000, 2001)]
    expected = []
    for key in {r[0] for r in rows}:
        merged = []
        for _, s, e in sorted(r for r in rows if r[0] == key):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        expected += [(key, s, e) for s, e in merged]
    df = spark.createDataFrame(rows, "k string, s int, e int")
    text = lambda got: sorted(map(str, map(tuple, got)))
    for cell_rows in (1, 7, 10_000):
        assert text(merged_spans(df, "k", "s", "e", cell_rows=cell_rows).collect()) == text(expected)
    days = df.select("k", F.date_add(F.lit(day), F.col("s")).alias("s"), F.date_add(F.lit(day), F.col("e")).alias("e"))
    got = merged_spans(days, "k", "s", "e", cell_rows=9).collect()
    assert text((r.k, (r.s - day).days, (r.e - day).days) for r in got) == text(expected)
    assert merged_spans(df.where("false"), "k", "s", "e").collect() == []


def test_personal_data_left_in_items(spark):
    texts = {
        "mail": ("x", "naar jan@x.be"), "hidden": ("jan[at]x.be", None), "comma": ("jan@x,be", "y"), "account": (None, "BE12 3456 7890 1234"), "born": ("\u00b0 01/02/1980", ""),
        "register": ("", "RR: 85.01.02-123.45"), "table": ("Geboortedatum  beroep", "01/02/80"), "no table": ("x", "01/02/80"), "form": ("Contactpersoon: A\ntel: 015 12", ""), "ill": ("is ernstig\nziek", ""), "clean": ("niets", None), "null": (None, None),
    }
    df = spark.createDataFrame([(k, *v) for k, v in texts.items()], "id string, title string, text string")
    got = {(r.id, r.what) for r in privacy.personal_data(df, "id", ["title", "text"], phrases=("ernstig ziek",)).collect()}
    assert got == {
        ("mail", "e-mailadres"), ("hidden", "verborgen e-mailadres"), ("comma", "verborgen e-mailadres"), ("account", "rekeningnummer"), ("born", "geboortedatum"), ("register", "rijksregisternummer"),
        ("table", "geboortedatum in een lijst"), ("form", "contactgegevens"), ("ill", "gezondheid"),
    }
    masked = df.select("id", *(privacy.mask_birth_tables(privacy.mask_context(privacy.mask_accounts(privacy.mask_email(F.col(c)))), F.col("id") == "table").alias(c) for c in ("title", "text")))
    assert privacy.personal_data(masked, "id", ["title", "text"]).count() == 0


def test_small_gates_and_filters(spark):
    from civicframe.operators import catalogue

    df = spark.createDataFrame([("College", 3), ("Gemeenteraad", 0), ("vast college", -1)], "organ string, late_days int")
    assert catalogue.chosen(df, organ="COLLEGE").count() == 2 and catalogue.chosen(df, only_late=True).count() == 1 and catalogue.chosen(df).count() == 3
    assert gates.assert_some("vol", df) is df
    with pytest.raises(gates.GateError, match="leeg"):
        gates.assert_some("leeg", df.limit(0))
    import hashlib

    prompts = spark.createDataFrame([("p", "1", "nieuw"), ("q", "1", "zelfde"), ("r", "2", "ander")], "name string, version string, text string")
    known = spark.createDataFrame([(n, "1", hashlib.sha256(t.encode()).hexdigest()) for n, t in (("p", "oud"), ("q", "zelfde"), ("r", "x"))], "name string, version string, digest string")
    assert [r.name for r in gates.changed_prompts(prompts, known).collect()] == ["p"]
    names = spark.createDataFrame([("Jan Proef",)], "name string")
    gates.assert_private_list(names)
    gates.assert_private_list(names.limit(0), empty_on_purpose=True)
    for bad in (None, names.limit(0)):
        with pytest.raises(gates.GateError):
            gates.assert_private_list(bad)
    assert {r.name for r in privacy.public_names(names, spark.createDataFrame([("Een",), (" An De Boer",)], "name string")).collect()} >= {"Jan Proef", "Proef Jan"}


def test_upserts_are_compacted(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch, rows in enumerate(([(1, "a"), (2, "b")], [(2, "c")], [(3, "d")])):
        ingest.upsert_into(path, "id")(spark.createDataFrame(rows, "id int, v string"), batch)
    before = {r.id: r.v for r in ingest.current(spark, path, "id").collect()}
    assert ingest.compact(spark, path, "id") == 2 and ingest.compact(spark, path, "id") == 0
    assert {r.id: r.v for r in ingest.current(spark, path, "id").collect()} == before == {1: "a", 2: "c", 3: "d"}
    assert spark.read.parquet(path).count() == 3
    ingest.upsert_into(path, "id")(spark.createDataFrame([(1, "z")], "id int, v string"), 3)
    assert {r.id: r.v for r in ingest.current(spark, path, "id").collect()} == {1: "z", 2: "c", 3: "d"}
