"""Signature words, judged cores and placed questions against plain Python."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from civicframe.operators.dossiers import around_cores, placed_questions, signature_links, without_conflicts


def frame(spark, rows, schema):
    return spark.createDataFrame(list(rows), schema)


def test_general_words_need_a_confirmation(spark):
    tokens = [(1, "uitrol"), (2, "uitrol"), (3, "uitrol"), (4, "uitrol"), (5, "uitrol"), (1, "zwembad"), (3, "zwembad"), (8, "zwembad"), (9, "zwembad"), (6, "lachgas"), (7, "lachgas")]
    general = frame(spark, [("uitrol",)], "token string")
    terms = frame(spark, [(1, "sport"), (2, "sport"), (2, "sport"), (None, "x")], "id int, term string")
    streets = frame(spark, [(2, "Laan"), (4, "Laan"), (3, "Laan"), (3, "Weg")], "id int, street string")
    referrals = frame(spark, [(5, 4), (1, 2)], "a int, b int")
    links = {(r.a, r.b): (r.token, r.reason) for r in signature_links(frame(spark, tokens, "id int, token string"), general, terms, streets, referrals).collect()}
    assert links == {
        (6, 7): ("lachgas", "woord"), (8, 9): ("zwembad", "woord"), (1, 3): ("zwembad", "woord"), (1, 8): ("zwembad", "woord"), (1, 9): ("zwembad", "woord"), (3, 8): ("zwembad", "woord"), (3, 9): ("zwembad", "woord"),
        (2, 4): ("uitrol", "straat"), (4, 5): ("uitrol", "verwijzing"),
    }
    assert signature_links(frame(spark, tokens, "id int, token string"), general, terms, streets, referrals, most=1).count() == 0


def test_a_common_subject_confirms(spark):
    tokens = [(i, "gebouw") for i in range(60)] + [(1, "uitrol"), (2, "uitrol"), (70, "uitrol")]
    none = lambda s: frame(spark, [], s)
    got = signature_links(frame(spark, tokens, "id int, token string"), frame(spark, [("uitrol",)], "token string"), none("id int, term string"), none("id int, street string"), none("a int, b int")).collect()
    assert [(r.a, r.b, r.reason) for r in got] == [(1, 2, "onderwerp")]


def plain_cores(items, core, series, alone, links):
    out = {}
    for kind, rows in (("kern", core), ("reeks", series), ("alleen", [(i, i) for i in alone])):
        for i, name in sorted(rows):
            if i in items and i not in out:
                out[i] = (name, kind)
    near = defaultdict(set)
    for a, b in links:
        if a != b and {a, b} <= items:
            near[a].add(b)
            near[b].add(a)
    front = {i: d for i, (d, k) in out.items() if k == "kern"}
    while front:
        told = defaultdict(Counter)
        for i, d in front.items():
            for j in near[i]:
                if j not in out:
                    told[j][d] += 1
        front = {j: min(c, key=lambda d: (-c[d], d)) for j, c in told.items()}
        out |= {j: (d, "eigen") for j, d in front.items()}
    for i in sorted(items - set(out)):
        if i not in out:
            seen, todo = {i}, [i]
            while todo:
                for k in near[todo.pop()]:
                    if k not in out and k not in seen:
                        seen.add(k)
                        todo.append(k)
            out |= {j: (min(seen), "los") for j in seen}
    return out


def test_cores_stay_apart(spark):
    rng = random.Random(4)
    for n, m in ((30, 30), (80, 90), (40, 160)):
        items = {f"i{i:03}" for i in range(n)}
        names = sorted(items) + ["gone"]
        core = [(rng.choice(names), f"d{rng.randrange(5)}") for _ in range(n // 6)]
        series, alone = [(rng.choice(names), "r") for _ in range(3)], [rng.choice(names) for _ in range(3)]
        links = [(rng.choice(names), rng.choice(names)) for _ in range(m)] + [("gone", "gone2")]
        got = around_cores(frame(spark, [(i,) for i in items], "id string"), frame(spark, core, "id string, dossier string"), frame(spark, series, "id string, series string"), frame(spark, [(a,) for a in alone], "id string"), frame(spark, links, "a string, b string"))
        rows = got.collect()
        assert len(rows) == n and {r.id: (r.dossier, r.kind) for r in rows} == plain_cores(items, core, series, alone, links)


def components(nodes, pairs):
    name = {n: n for n in nodes}
    while True:
        changed = False
        for a, b in pairs:
            low = min(name[a], name[b])
            changed |= name[a] != low or name[b] != low
            name[a] = name[b] = low
        if not changed:
            return name


def plain_groups(yes, no):
    nodes = {x for p in yes for x in p if p[0] != p[1]}
    left, gone = {p for p in yes if p[0] != p[1]}, set()
    while True:
        name = components({x for p in left for x in p}, left)
        count = defaultdict(Counter)
        for a, b in no:
            if a in name and b in name and name[a] == name[b] and a != b:
                count[name[a]][a] += 1
                count[name[a]][b] += 1
        if not count:
            return name | {n: n for n in nodes - set(name)}
        out = {min(c, key=lambda i: (-c[i], i)) for c in count.values()}
        gone |= out
        left = {p for p in left if not out & set(p)}


def plain_placed(questions, yes, no, groups):
    yes, no = ({(min(p), max(p)) for p in v} for v in (yes, no))
    both = lambda v: {p for p in v if set(p) <= questions}
    group = {q: q for q in questions} | plain_groups(both(yes), both(no))
    cross = lambda v: {(q, i) for p in v for q, i in (p, p[::-1]) if q in questions and i not in questions}
    won = {}
    for g in set(group.values()):
        n_yes = Counter(groups[i] for q, i in cross(yes) if group[q] == g and i in groups)
        n_no = Counter(groups[i] for q, i in cross(no) if group[q] == g and i in groups)
        if n_yes:
            best = min(n_yes, key=lambda d: (-n_yes[d], d))
            if n_yes[best] > n_no[best]:
                won[g] = best
    out = {q: won.get(g, g) for q, g in group.items()}
    follow = defaultdict(Counter)
    for q, i in cross(yes):
        if i not in groups:
            follow[i][out[q]] += 1
    return out | {i: min(c, key=lambda d: (-c[d], d)) for i, c in follow.items()}


def test_questions_choose_together_and_conflicts_leave(spark):
    rng = random.Random(8)
    for n in (12, 40):
        questions = set(range(0, n, 2))
        pair = lambda: (rng.randrange(n), rng.randrange(n))
        yes = {pair() for _ in range(2 * n)}
        no = {p for p in (pair() for _ in range(n)) if p not in yes and p[::-1] not in yes}
        groups = {i: 1000 + i // 8 for i in range(1, n, 4)}
        y, x = (frame(spark, [*v, *list(v)[:2]], "a int, b int") for v in (yes, no))
        got = placed_questions(frame(spark, [(q,) for q in questions], "id int"), y, x, frame(spark, groups.items(), "id int, dossier int")).collect()
        assert len(got) == len({r.id for r in got})
        assert {r.id: r.dossier for r in got} == plain_placed(questions, yes, no, groups)


def test_a_question_with_most_noes_leaves(spark):
    yes, no = frame(spark, [(1, 2), (2, 3), (3, 4)], "a int, b int"), frame(spark, [(1, 3), (4, 1), (9, 9)], "a int, b int")
    assert {r.question: r.group for r in without_conflicts(yes, no).collect()} == {1: 1, 2: 2, 3: 2, 4: 2}


def test_queries_equal_plain_python(spark, sf_dir):
    from civicframe.plans.registry import queries

    links = queries()["signature_pairs"](spark, sf_dir).collect()
    assert {r.reason for r in links} >= {"woord"} and all(r.a < r.b for r in links)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(10))).collect()
    title = {r.doc_id: r for r in docs}
    cores = queries()["judged_cores"](spark, sf_dir).collect()
    assert {r.id for r in cores} == {str(i) for i in title} and {"kern", "reeks", "alleen", "eigen", "los"} >= {r.kind for r in cores} >= {"kern", "eigen", "los"}
    assert all(r.kind == "kern" for r in cores if title[int(r.id)].part < 2) and all(r.dossier == r.id for r in cores if title[int(r.id)].part == 3)
    placed = queries()["questions_by_verdict"](spark, sf_dir).collect()
    assert {r.id for r in placed} >= {i for i in title if i % 3 == 0} and len({r.id for r in placed}) == len(placed)
