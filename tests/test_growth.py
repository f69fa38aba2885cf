"""Steps that must not grow faster than their input: what they read, shuffle or compute again."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from civicframe.functions import text as texts
from civicframe.functions.text import index_tokens
from civicframe.operators import index, linkage, merge, privacy
from civicframe.plans.registry import queries


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_synonyms_go_to_the_tokens(spark):
    tokens = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, token string")
    found = index.synonym_items(tokens, spark.createDataFrame([("a", "g"), ("c", "g")], "word string, group string"), "a")
    assert "strategy=broadcast" in _plan(found) and sorted(map(tuple, found.collect())) == [(1, 0), (2, 1)]


def test_index_tokens_are_whole_runs(spark):
    text = "de 12345 a1 123a 9abc9 ab Één x12345 naïef de NAIEF zij 1a2 été"
    row = spark.createDataFrame([(text,), (None,)], "x string").select(index_tokens(F.col("x"), index.stop_array(["zij"])).alias("t")).collect()
    assert [r.t for r in row] == [["123a", "9abc9", "een", "x12345", "naief", "1a2", "ete"], []]


def test_ids_of_the_dictionary_are_stored_before_they_are_sampled(spark, monkeypatch):
    labels, real = [], index.stored
    monkeypatch.setattr(index, "stored", lambda df, label: (labels.append(label), real(df, label))[1])
    got = index.dictionary(spark.createDataFrame([(7, "a"), (3, "b"), (7, "b")], "id int, token string"))
    assert labels[0] == "ids" and sorted(map(tuple, got.collect())) == [(3, 0), (7, 1)]


def test_truth_check_gathers_no_ids(spark, sf_dir):
    plan = _plan(queries()["index_truth_check"](spark, sf_dir))
    assert "collect_list" not in plan and plan.count("regexp_extract_all") <= 2


def test_addresses_are_read_in_one_scan(spark, sf_dir):
    df = spark.createDataFrame([("x A@b.be y", "c@d.nl"), ("geen", None), (None, "a@b.be")], "t string, u string")
    found = privacy.leaked_addresses([F.col("t"), F.col("u")], df, spark.createDataFrame([], "address string"))
    assert "Union" not in _plan(found) and sorted(r.address for r in found.collect()) == ["a@b.be", "c@d.nl"]
    assert "documents.parquet" not in str(queries()["leak_gate"](spark, sf_dir).inputFiles())


def test_heads_are_read_once(spark, sf_dir):
    assert "Generate" in _plan(queries()["extract_heads"](spark, sf_dir))


def test_candidates_keep_the_asked_tokens_only(spark, sf_dir):
    assert not any("documents.parquet" in f for f in queries()["candidate_pairs"](spark, sf_dir).inputFiles())


def test_terms_behind_many_repeats(spark):
    words = ["a"] * 40 + [" B", "b", "", "c" * 61, None, "c"]
    got = spark.createDataFrame([(words,), ([],), (None,)], "w array<string>").select(merge.clean_terms(F.col("w"), 3).alias("t")).collect()
    assert [r.t for r in got] == [["a", "B", "c"], [], None]


def test_lists_are_parsed_without_a_shuffle(spark):
    from civicframe.sources import lines

    docs = spark.createDataFrame([("d", "Openbare zitting\n1. A. Een\nGoedgekeurd")], "doc string, text string")
    for parse in (lines.parse_decisions, lines.parse_agenda, lines.parse_minutes):
        plan = _plan(parse(docs))
        assert not any(x in plan for x in ("Window", "Aggregate", "Join")), plan


def _near_copies(draw: random.Random, size: int, n: int) -> list[str]:
    """Titles of words of which the rare letters are few, each with some words changed."""
    word = lambda: "".join(draw.choices("ethanoirsdlwfvk", weights=[1 / (k + 1) for k in range(15)], k=draw.randint(2, 7)))
    words = ["x"]
    while len(" ".join(words)) < size:
        words.append(word())
    return list(dict.fromkeys(" ".join(w if k == 0 or draw.random() > 0.03 else word() for k, w in enumerate(words)) for _ in range(n)))


def test_few_of_many_near_copies_are_compared(monkeypatch):
    draw, calls, real = random.Random(5), [], texts._ratio_from
    monkeypatch.setattr(texts, "_ratio_from", lambda *a: (calls.append(1), real(*a))[1])
    for size in (120, 500):
        names = _near_copies(draw, size, 80)
        hits = ["".join(c for k, c in enumerate(t) if k % 9 != 8) for t in names]
        likened, calls[:] = texts.Likened(names), []
        found = [likened.best(h, 0.72) for h in hits]
        assert len(calls) < 4 * len(hits)  # of 80 each
        for h, got in zip(hits[:6], found[:6], strict=True):
            assert (likened.bounds(h, 0.0) >= [SequenceMatcher(None, h, t).ratio() for t in names]).all()
            ratio, k = max((SequenceMatcher(None, h, t).ratio(), -k) for k, t in enumerate(names))
            assert got == ((-k, ratio) if ratio >= 0.72 else None)


def test_fuzzy_match_in_cells_equals_difflib(spark, monkeypatch):
    monkeypatch.setattr(linkage, "CANDIDATE_CELL", 9)
    monkeypatch.setattr(linkage, "HIT_CELL", 14)
    monkeypatch.setattr(linkage, "TASK_TITLES", 40)
    draw = random.Random(7)
    names = [(b, t) for b, size, n in (("p", 60, 30), ("q", 260, 25), ("r", 90, 1), (None, 60, 2)) for t in _near_copies(draw, size, n)] + [("p", None), ("s", "alone")]
    known = [(f"d{i:03}", b, t) for i, (b, t) in enumerate(names + names[:20])]
    asked = [(i, b, None if t is None else "".join(c for k, c in enumerate(t) if k % 9 != 8)) for i, (b, t) in enumerate(names)] + [(900 + i, b, t) for i, (b, t) in enumerate(names[:40])] + [(990, "t", "none")]
    found = linkage.fuzzy_match(spark.createDataFrame(asked, "h long, b string, a string"), spark.createDataFrame(known, "c string, b string, t string"), block="b", hit_title="a", candidate_title="t", hit_id="h", candidate_id="c")
    plan = _plan(found)
    assert "zip_with" not in plan and "ArrowEvalPython" not in plan  # no row for each pair of titles
    expected = {}
    for i, b, t in asked:
        rated = [(-SequenceMatcher(None, t, u).ratio(), c) for c, d, u in known if b is not None and t is not None and u is not None and d == b]
        if rated and -min(rated)[0] >= 0.72:
            expected[i] = (min(rated)[1], round(-min(rated)[0], 3))
    assert {r.h: (r.c, r.ratio) for r in found.collect()} == expected and len(expected) > 45
