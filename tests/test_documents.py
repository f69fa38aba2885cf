"""Tables of pages, JSON documents, folders and geometry."""

import json

import pytest
from pyspark.sql import functions as F

from civicframe.operators.budget import export, plan_of_items, publication
from civicframe.sources.budget import budget_lines
from civicframe.sources.documents import districts, gml_point, json_documents, refuse_unreadable, session_files
from civicframe.sources.tables import search_results, table_cells


def cells(spark, html):
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    return [(r.table, r.row, r.col, r.text) for r in table_cells(df, "page_id", "html").orderBy("table", "row", "col").collect()]


def test_cells_of_odd_tables(spark):
    assert cells(spark, "<table><tr><td>a<td>b &amp; <b>c</b><tr><td colspan=2>d<td>e</table>") == [(0, 0, 0, "a"), (0, 0, 1, "b & c"), (0, 1, 0, "d"), (0, 1, 2, "e")]
    assert cells(spark, "<table><tr><td rowspan='2'>a<td>b<tr><td>c</table>") == [(0, 0, 0, "a"), (0, 0, 1, "b"), (0, 1, 1, "c")]
    assert cells(spark, "<table><tr><td>x<table><tr><td>in</table>y<td>z</table>") == [(0, 0, 0, "xy"), (0, 0, 1, "z"), (1, 0, 0, "in")]
    assert cells(spark, "<table><td>one<script>var t='<td>no';</script><br>two") == [(0, 0, 0, "one two")]
    assert cells(spark, "<p>none</p>") == [] and cells(spark, None) == [] and cells(spark, "<table></table>") == []
    assert cells(spark, "<table><tr><td colspan='x' rowspan=0>a<td>b</table>") == [(0, 0, 0, "a"), (0, 0, 1, "b")]


def test_result_table_of_a_search_page(spark):
    head = "<tr><th>Documenten<th>Bestuurs\u00f3rgaan<th>Titel van het stuk<th>Datum  zitting<th>iets"
    body = "<tr><td><a href=' /a '>a</a><a>x</a><a href='/b'>b</a><td>Raad<td>Een\n stuk<td>1 mei<td>n<tr><td><td> <td> <td>2 mei<td><tr><th>tussenkop</th></tr><tr><td><td><td>Los"
    page = f"<table><tr><td>titel</table><table>{head}{body}</table><table>{head}<tr><td><td>later<td>later</table>"
    got = search_results(spark.createDataFrame([(1, page), (2, None), (3, "<table><tr><td>titel")], "page_id int, html string")).orderBy("row").collect()
    assert [(r.organ, r.title, r.session, r.doctype, r.links) for r in got] == [("Raad", "Een stuk", "1 mei", "", ["/a", "/b"]), ("", "Los", "", "", [])]
    with_body = f"<table><thead>{head}</thead><tbody><tr><td><td>Eerste<td>rij</tbody></table>"
    assert [r.organ for r in search_results(spark.createDataFrame([(1, with_body)], "page_id int, html string")).collect()] == ["Eerste"]


def test_json_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('\ufeff{\n "id": 1,\n "extra": [1]}', encoding="utf-8")
    (tmp_path / "b.json").write_text('[{"id": 2, "name": "\u00e9"},\n {"id": 3}]', encoding="utf-8")
    (tmp_path / "c.json").write_text('{"id": 4, "na', encoding="utf-8")
    good, bad = json_documents(spark, str(tmp_path), "id long, name string")
    assert sorted((r.id, r.name, r.file[-6:]) for r in good.collect()) == [(1, None, "a.json"), (2, "\u00e9", "b.json"), (3, None, "b.json")]
    assert [r.file[-6:] for r in bad.collect()] == ["c.json"]
    with pytest.raises(ValueError, match="c.json"):
        refuse_unreadable(bad)
    refuse_unreadable(bad.where("false"))


def test_session_files(spark, tmp_path):
    for organ, day, name in (("raad", "2026-01-05", "a.pdf"), ("organ=col lege", "2026-02-01", "b.PDF"), ("raad", "2026-01-05", "c.txt")):
        (tmp_path / organ / day).mkdir(parents=True, exist_ok=True)
        (tmp_path / organ / day / name).write_bytes(b"x" * len(name))
    got = session_files(spark, str(tmp_path), pattern="*.{pdf,PDF}")
    assert sorted((r.organ, r.session, r.name, r.size) for r in got.drop("content").collect()) == [("col lege", "2026-02-01", "b.PDF", 5), ("raad", "2026-01-05", "a.pdf", 5)]


def test_geometry(spark, tmp_path):
    square = [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]
    shapes = {"p": {"type": "Polygon", "coordinates": square}, "m": {"type": "MultiPolygon", "coordinates": [square, square]}, "f": {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": square}}, "c": {"geometries": [{"type": "Polygon", "coordinates": square}], "type": "GeometryCollection"}, "x": {"type": "Point", "coordinates": [1, 2]}}
    (tmp_path / "g.json").write_text("\ufeff" + json.dumps(shapes, indent=1), encoding="utf-8")
    got = {r.name: r.polygons for r in districts(spark, str(tmp_path)).collect()}
    assert got == {"p": [square], "m": [square, square], "f": [square], "c": [square], "x": None}
    points = spark.createDataFrame([("<gml:Point><gml:pos>157000.5 188000</gml:pos>",), ("<gml:pos>a b</gml:pos>",), (None,), ("<gml:pos>1.2.3 4</gml:pos>",)], "g string")
    assert [r.p and tuple(r.p) for r in points.select(gml_point(F.col("g")).alias("p")).collect()] == [(157000.5, 188000.0), None, None, None]


def test_fields_of_budget_lines(spark):
    head = ["Entiteit", "BD", "Doel", "AP", "Plan", "AC", "Actie", "Code", "Naam", "Uitvoerende Dienst", "Raming 2026"]
    row = lambda n, **k: ["Stad", "BD1", "doel", "AP2", "plan", "AC3", "actie", f"MJP000{n}", f"lijn {n}", "Groen", f"{n}.000"]
    pages = [("d", 1, [["inhoud"], ["MJP0009"]]), ("d", 2, [head, row(1), row(2)]), ("d", 3, [["andere kop"] * 11, row(3), row(1), ["kort"]])]
    got = {r.code: r for r in budget_lines(spark.createDataFrame(pages, "doc string, page int, rows array<array<string>>")).collect()}
    assert sorted(got) == ["MJP0001", "MJP0002", "MJP0003"]
    r = got["MJP0003"]
    assert (r.entity, tuple(r.goal), tuple(r.plan), tuple(r.action), r.service, r.description) == ("Stad", ("BD1", "doel"), ("AP2", "plan"), ("AC3", "actie"), "Groen", "lijn 3")
    assert [tuple(a) for a in r.amounts] == [(2026, "raming", 3000)]


def test_plan_of_items_and_export(spark, tmp_path):
    from datetime import date as D

    plans = spark.createDataFrame([(0, D(2026, 1, 1)), (1, D(2020, 1, 1)), (2, D(2020, 1, 1))], "plan int, valid_from date")
    versions = spark.createDataFrame([(0, "a"), (1, "a"), (0, "b"), (2, "c"), (2, "c")], "plan int, code string")
    refs = [("a", "i", D(2026, 5, 1)), ("a", "j", D(2021, 1, 1)), ("a", "k", D(1999, 1, 1)), ("a", "l", None), ("b", "m", D(2021, 1, 1)), ("c", "n", D(2022, 2, 2)), ("z", "o", D(2026, 1, 1)), ("a", "i", D(2026, 5, 1))]
    placed = plan_of_items(spark.createDataFrame(refs, "code string, item string, day date"), plans, versions)
    assert sorted(map(tuple, placed.collect())) == [("a", "i", 0, False), ("a", "j", 1, False), ("a", "k", 1, False), ("a", "l", 1, False), ("b", "m", 0, True), ("c", "n", 2, True)]
    lines = spark.createDataFrame([(p, c, (f"{c}{p}",)) for p, c in ((0, "a"), (1, "a"), (0, "b"), (2, "c"), (0, "unused"))], "plan int, code string, line struct<name:string>")
    export(publication(lines, placed), str(tmp_path / "out"))
    got = {r["code"]: r for r in (json.loads(x.value) for x in spark.read.text(str(tmp_path / "out")).collect())}
    assert got["a"] == {"code": "a", "line": {"name": "a0"}, "versions": {"0": {"name": "a0"}, "1": {"name": "a1"}}, "plan_of_item": {"i": 0, "j": 1, "k": 1, "l": 1}}
    assert sorted(got) == ["a", "b", "c"] and got["b"]["from_other_plan"] == ["m"]


def test_item_that_refers_on_several_days_is_published_once(spark, tmp_path):
    placed = spark.createDataFrame([("a", "i", 0, True), ("a", "i", 1, False), ("a", "i", 2, False), ("a", "j", 0, True), ("a", "j", 0, True)], "code string, item string, plan int, other_plan boolean")
    lines = spark.createDataFrame([(p, "a", (p,)) for p in (0, 1, 2)], "plan int, code string, line struct<total:int>")
    export(publication(lines, placed), str(tmp_path / "out"))
    (got,) = (json.loads(x.value) for x in spark.read.text(str(tmp_path / "out")).collect())
    assert got["plan_of_item"] == {"i": 1, "j": 0} and got["from_other_plan"] == ["j"]


def test_points_on_edges_and_small_positions(spark):
    from civicframe.operators.geo import in_districts

    areas = spark.createDataFrame([("a", [[[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]], [[1.0, 1.0], [2.0, 1.0], [2.0, 2.0], [1.0, 2.0], [1.0, 1.0]]]])], "name string, polygons array<array<array<array<double>>>>")
    rows = [(1, "0 2"), (2, "4 2"), (3, "1 1.5"), (4, "2 1.5"), (5, "1.5 1.5"), (6, "3 0"), (7, "1.0E-4 +2"), (8, "-1e0 2"), (9, "3 3"), (9, "9 9")]
    points = spark.createDataFrame([(k, f"<gml:pos>{p}</gml:pos>") for k, p in rows], "k int, g string").select("k", gml_point(F.col("g")).alias("p")).select("k", "p.x", "p.y")
    inside = lambda **how: sorted(r.k for r in in_districts(points, areas, "x", "y", "k", cell=1.0, **how).where("district = 'a'").collect())
    assert inside(strict=True) == [3, 4, 7, 9] and inside() == [1, 4, 6, 7, 9]
