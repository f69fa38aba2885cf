"""Mixing, fingerprints, shards, near-duplicates and the pipeline against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from civicframe.llm.decontaminate import decontaminate
from civicframe.llm.fingerprint import edited_fingerprints, fingerprint, likeness
from civicframe.llm.mixing import NEAR, mix, targets
from civicframe.llm.neardup import near_duplicates
from civicframe.llm.sharding import grants, shard
from civicframe.llm.stages import mixed, one_of_each, with_language
from civicframe.operators.dossiers import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, n):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def water_fill(sizes, cap=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target, left = sum(sizes.values()), {}, set(names)
    while True:
        rest = total - sum(target.values())
        over = [s for s in left if rest * weight[s] / sum(weight[x] for x in left) > cap * sizes[s]]
        if not over:
            return target | {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        for s in over:
            target[s] = cap * sizes[s]
            left.remove(s)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 1000, None: 40}, {"a": 1, "b": 1000}, {"x": 7}, {"a": 0, "b": 10, "c": 3}])
def test_targets_equal_repeated_sharing(spark, sizes):
    t = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = F.lit(0)
    for i, s in enumerate(order):
        weight = F.when(F.col("source").eqNullSafe(F.lit(s)), i % 3 + 1).otherwise(weight)
    got = {r.source: r.target for r in targets(t, weight, cap=3.0).collect()}
    assert got == pytest.approx(water_fill(sizes))


def test_mix_of_all_documents(spark, sf_dir):
    from civicframe.llm.queries import op2_mixing

    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op2_mixing(spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op2_mixing(spark, sf_dir).collect()))
    sizes, taken = Counter(), Counter()
    for r in rows:
        assert r.size == len(words(texts[r.doc_id])) and r.taken <= 3 * r.size
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
    goal = water_fill(sizes)
    largest = Counter()
    for r in rows:
        largest[source[r.doc_id]] = max(largest[source[r.doc_id]], r.size)
    for r in rows:
        assert r.source_size == sizes[source[r.doc_id]] and r.target == pytest.approx(goal[source[r.doc_id]])
        assert abs(taken[source[r.doc_id]] - r.target) <= max(0.02 * r.target, largest[source[r.doc_id]] / 2)


def brute_copies(rows, seed="mix"):
    """Copies of (id, source, size) rows: whole parts, then ranks of random odds over inclusion odds, in plain Python."""
    total = Counter()
    for _, source, size in rows:
        total[source] += size
    goal, copies, chances = water_fill(total), {}, {}
    for source in total:
        ratio = min(goal[source] / total[source], 3.0) if total[source] else 0.0
        mine = [(k, size) for k, s, size in rows if s == source]
        wanted = goal[source] - math.floor(ratio) * total[source]
        copies |= {k: math.floor(ratio) for k, _ in mine}
        words = Counter()
        for _, size in mine:
            if size:
                words[math.floor(4 * math.log2(size))] += size
        if wanted <= 0 or not words:
            continue
        mean, low, high = sum(words) / len(words), -200.0, 200.0
        for _ in range(100):
            middle = (low + high) / 2
            p = {c: 1 / (1 + 2.0 ** -(middle + (c - mean) / 8)) for c in words}
            low, high = (middle, high) if sum(p[c] * words[c] for c in words) < wanted else (low, middle)
        ranked = []
        for k, size in mine:
            if size:
                chance = chances[k] = p[math.floor(4 * math.log2(size))]
                u = (int(hashlib.md5(f"{seed}|{k}|{'null' if source is None else source}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
                ranked.append((u / (1 - u) / (chance / (1 - chance)), k, size))
        rest, left = wanted, sorted(ranked)
        while left and (rest == wanted or rest > NEAR * goal[source]):
            n = 0
            while n < len(left) and left[n][2] <= rest:
                copies[left[n][1]] += 1
                rest -= left[n][2]
                n += 1
            left = [x for x in left[n:] if x[2] <= rest]
        if rest > NEAR * goal[source]:
            over = [(rank, k) for rank, k, size in sorted(ranked) if copies[k] == math.floor(ratio) and size < 2 * rest]
            copies.update((k, copies[k] + 1) for _, k in over[:1])
    return copies, chances


def test_copies_equal_brute_force_ranking(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    more = spark.createDataFrame([(10**6 + i, "few", "w " * n) for i, n in enumerate([1, 1, 2, 3, 50, 900])] + [(10**6 + 50 + i, None, "w " * (i + 1)) for i in range(40)], "doc_id long, source string, text string")
    docs = docs.unionByName(more)
    got = {r.key: r for r in mix(docs).collect()}
    copies, chances = brute_copies([(r.key, r.source, r.size) for r in got.values()])
    assert {k: r.copies for k, r in got.items()} == copies
    assert all(r.p == pytest.approx(chances.get(k, 0.0), abs=1e-9) for k, r in got.items())
    assert len({round(r.p, 6) for r in got.values() if r.source is None}) > 10


def test_inclusion_shares_are_near_the_probabilities():
    r = random.Random(11)
    rows = [(i, "a", int(10 ** r.uniform(0.5, 3))) for i in range(400)] + [(1000 + i, "b", 40) for i in range(700)] + [(2000 + i, "c", 9) for i in range(90)]
    seen, tries = Counter(), 200
    for seed in range(tries):
        copies, chances = brute_copies(rows, seed=str(seed))
        base = {"a": min(v for k, v in copies.items() if k < 1000)}
        seen.update(k for k, v in copies.items() if k < 1000 and v > base["a"])
    errors = [seen[k] / tries - chances[k] for k in range(400) if k in chances]
    assert abs(sum(errors)) / len(errors) < 0.02 and max(map(abs, errors)) < 0.2


def test_stages_keep_columns_of_any_name(spark):
    names = ["lang_pred", "score", "_score", "_lang", "copies", "_key", "_copy", "_found", "_report", "_mix_key", "_words", "_place"]
    rows = [(1, "the cat sat on the mat with the hat", "en", "a"), (2, "le chat est sur la table de la maison", None, "b"), (2, "le chat est sur la table de la maison", None, "b"), (3, None, None, None), (None, "words without an id are words too", "en", "a")]
    docs = spark.createDataFrame([(*r, 1, *range(len(names))) for r in rows], DOCS + "".join(f", {n} int" for n in names))
    item = spark.createDataFrame([(1, "cat sat on the mat")], "item_id long, text string")
    for stage in (with_language, one_of_each, mixed, lambda d: decontaminate(d, item), lambda d: decontaminate(d, item, remove="spans")):
        for some in (docs, docs.limit(0)):
            out = stage(some)
            assert out.columns == docs.columns
            assert all(tuple(r)[5:] == tuple(range(len(names))) for r in out.collect())
    assert {r.doc_id for r in decontaminate(docs, item).collect()} == {2, 3, None}
    assert [r.lang for r in with_language(docs).collect()] == ["en"] * 4  # the only language that has labels


def test_mix_of_odd_rows(spark):
    rows = [(1, None, None), (2, "", "a"), (None, "x y z", "a"), (None, "x y z", "a"), (3, "w " * 4000, "b"), (4, "one", None), (4, "one", None)] + [(i, "u v w x", "c") for i in range(10, 60)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    got = mix(docs).collect()
    assert len(got) == len(rows) and all(r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r in got)
    assert mix(docs.limit(0)).count() == 0
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    assert abs(taken["c"] - next(r.target for r in got if r.source == "c")) <= 8


def test_fingerprints_estimate_likeness(spark, sf_dir):
    from civicframe.llm.queries import op3_fingerprints

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in op3_fingerprints(spark, sf_dir).collect()}
    ids, errors = sorted(docs, reverse=True), []
    for k, d in enumerate(ids):
        text, nxt, cut = docs[d], docs[ids[(k + 1) % len(ids)]], len(docs[d]) // 3
        edited = text[: len(text) - cut] + nxt[:cut]
        assert rows[d].n_chars == len(text) and rows[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(rows[d].near_edited - jaccard(shingles(text, 5), shingles(edited, 5)))
        errors.append(rows[d].near_next - jaccard(shingles(text, 5), shingles(nxt, 5)))
    assert max(map(abs, errors)) < 0.16 and abs(sum(errors) / len(errors)) < 0.01
    same = defaultdict(set)
    for d, text in docs.items():
        same[text].add(rows[d].fingerprint)
    assert all(len(v) == 1 for v in same.values())


@pytest.mark.parametrize("n", [0, 1, 2, 5, 300])
def test_fingerprints_of_sparse_and_odd_texts(spark, n):
    base = " ".join(f"a{i}" for i in range(n + 4 if n else 0))
    more = base + " " + " ".join(f"b{i}" for i in range(n))
    one = spark.createDataFrame([(base, more)], "a string, b string").select(likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("x"), fingerprint(F.col("a")).alias("f")).first()
    assert one.x == pytest.approx(jaccard(shingles(base, 5), shingles(more, 5)), abs=0.2) and len(one.f) in (0, 512)


def test_next_documents_of_odd_rows(spark):
    rows = [(5, "one two"), (5, "one two"), (None, "nothing named"), (1, None), (9, ""), (7, "é" * 30)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fingerprint string")
    got = edited_fingerprints(docs).collect()
    order = [(9, ""), (7, "é" * 30), (5, "one two"), (5, "one two"), (1, ""), (None, "nothing named")]
    expected = []
    for k, (d, t) in enumerate(order):
        cut = len(t) // 3
        expected.append((d, len(t), hashlib.sha256((t[: len(t) - cut] + order[(k + 1) % len(order)][1][:cut]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(expected, key=str)
    assert edited_fingerprints(docs.limit(0)).count() == 0
    assert edited_fingerprints(docs.limit(1)).first().near_next == 1.0


def test_buckets_do_not_change_the_order(spark):
    from civicframe.llm.fingerprint import with_next

    docs = spark.range(0, 700).select((F.col("id") * 7 % 701).alias("doc_id"), F.concat(F.lit("t"), (F.col("id") * 7 % 701)).alias("text"), F.lit("f").alias("fingerprint"))
    ids = sorted((r.doc_id for r in docs.collect()), reverse=True)
    got = {r.doc_id: r.next_text for r in with_next(docs, id_col="doc_id", text_col="text", per_bucket=2).collect()}
    assert got == {d: f"t{ids[(k + 1) % len(ids)]}" for k, d in enumerate(ids)}


def test_rows_of_one_id_are_ordered_in_parts(spark):
    from civicframe.llm.fingerprint import id_buckets, with_next

    docs = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, F.col("id")).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"), F.lit("f").alias("fingerprint"))
    assert {(r._hot, r._parts > 10) for r in id_buckets(docs, "doc_id", 20)[1].collect()} == {(5, True), (None, True)}
    signed = lambda t: int(np.uint64(xxhash.xxh64(t.encode(), seed=42).intdigest()).astype(np.int64))
    rows = sorted((r.doc_id is None, -(r.doc_id or 0), signed(r.text), r.text) for r in docs.collect())
    got = {r.text: r.next_text for r in with_next(docs, id_col="doc_id", text_col="text", per_bucket=20).collect()}
    assert got == {t: rows[(k + 1) % len(rows)][3] for k, (*_, t) in enumerate(rows)}


def check_shards(rows, texts, shards=16):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by.values())
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    assert all(abs(sum(r.size for r in by[k]) - total / shards) <= largest for k in range(shards))
    where = defaultdict(set)
    for r in rows:
        where[texts[r.doc_id]].add(r.shard)
    return sum(len(v) > 1 for v in where.values())


def test_shards_are_even_and_keep_copies_together(spark, sf_dir):
    from civicframe.llm.queries import op8_sharding

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op8_sharding(spark, sf_dir).collect()
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.law == "bytes" and r.grown_shard is None for r in rows)
    assert check_shards(rows, texts) <= 15


def test_shards_of_a_group_that_is_larger_than_one(spark):
    texts = {i: "same text" if i % 3 == 0 else f"text {i // 2}" for i in range(4000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert check_shards(shard(docs).collect(), texts) <= 16
    assert shard(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, None, 1), (None, None, 1), (1, "x", 2)], "doc_id long, text string, group int")
    assert sorted((r.doc_id or 0, r.size) for r in shard(odd, shards=4).collect()) == [(0, 1), (0, 1), (1, 2)]


def test_grants_keep_loads_under_the_capacity():
    r = random.Random(1)
    for _ in range(50):
        loads = {s: r.randint(50, 150) for s in range(5)}
        flows = {(a, b): r.randint(1, 30) for a in range(5) for b in range(5) if a != b}
        after = dict(loads)
        for (a, b), p in grants(flows, loads, 110).items():
            assert 0 <= p <= 1
            after[a] -= p * flows[a, b]
            after[b] += p * flows[a, b]
        assert all(after[s] <= max(110, loads[s]) + 1e-6 for s in loads)


def brute_components(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(rows[i][0]), find(rows[j][0])))
                parent[y] = x
    return sorted((d, len(s), find(d), d == find(d)) for (d, _), s in zip(rows, sets, strict=True))


def test_near_duplicates_equal_brute_force(spark, sf_dir):
    from civicframe.llm.queries import op9_neardup

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, op9_neardup(spark, sf_dir).collect())) == brute_components(rows, 2, 80)


def test_near_duplicates_of_groups_passages_and_odd_rows(spark):
    r = random.Random(5)
    word = lambda: f"w{r.randint(0, 10**6)}"
    passage, base = [word() for _ in range(60)], [word() for _ in range(90)]
    rows = [(0, None), (1, ""), (2, "one"), (3, "One"), (4, "one two"), (5, "a b c d e"), (6, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (8, "b c d e f")]
    rows += [(100 + i, " ".join(passage + [word() for _ in range(r.randint(5, 60))])) for i in range(40)]  # unlike, but for the passage
    for i in range(60):  # a group of near copies, longer than a list
        text = list(base)
        for _ in range(r.randint(0, 6)):
            text[r.randrange(len(text))] = word()
        rows.append((200 + i, " ".join(text)))
    for i in range(30):  # a chain whose ends are unlike
        rows.append((300 + i, " ".join(f"c{j}" for j in range(i * 2, i * 2 + 40))))
    rows += [(400 + i, " ".join(r.choice("abcdefgh") for _ in range(r.randint(1, 9)))) for i in range(60)]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, id int")
    for n in (2, 5):
        assert sorted(map(tuple, near_duplicates(docs, shingle=n).collect())) == brute_components(rows, n, 80)


def test_near_duplicates_of_nothing_and_of_no_names(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, None)], "doc_id long, text string")
    assert sorted(((x.doc_id, x.component_id, x.kept) for x in near_duplicates(docs).collect()), key=str) == [(1, 1, True), (None, None, True), (None, None, True)]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_path(spark):
    links = spark.range(0, 40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(100, 90), (90, 90), (100, 90)], "a long, b long"))
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}


def test_stages_of_odd_rows(spark):
    text = " ".join(f"word{i} und" for i in range(40))
    rows = [(1, text, "de", "a", 1), (2, text + " ende", "de", "a", 1), (3, text.upper(), None, None, 2), (4, "123", "de", "a", 3), (5, None, "de", "b", 0), (6, "le chat est sur la table", "fr", "b", 24), (6, "le chat est sur la table", "fr", "b", 24)]
    docs = spark.createDataFrame(rows, DOCS)
    kept = with_language(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 6, 6] and kept.columns == docs.columns
    assert all(r.lang for r in kept.collect())
    assert sorted((r.doc_id for r in one_of_each(docs).collect())) == [1, 4, 5, 6]
    assert with_language(docs.limit(0)).count() == one_of_each(docs.limit(0)).count() == mixed(docs.limit(0)).count() == 0
    assert mixed(docs).columns == docs.columns


def test_texts_with_letters_stay_when_no_language_is_learned(spark):
    docs = spark.createDataFrame([(1, "een huis", None), (2, "123", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in with_language(docs).collect()] == [(1, "een huis", None)]


def test_pipeline_equals_brute_force(spark, sf_dir):
    """Each stage on the output of the one before, the last one against the token files' own test."""
    import corpus_pipeline as c
    from civicframe.llm.common import stored
    from tests.llm.test_files import expected_tokens
    from tests.llm.test_text import brute_contamination

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    outs = [docs.collect()]
    for name, stage in c.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        outs.append(docs.collect())
    start, named, single, clean, mix_, last = outs
    ids = lambda rows: sorted(r.doc_id for r in rows)
    assert ids(named) == sorted(r.doc_id for r in start if any(ch.isalpha() for ch in r.text or ""))
    assert ids(single) == [d for d, _, _, kept in brute_components([(r.doc_id, r.text) for r in named], 5, 80) if kept]
    bad = {d for d, *_, x in brute_contamination([(r.doc_id, r.text) for r in single], items) if x}
    assert ids(clean) == sorted(r.doc_id for r in single if r.doc_id not in bad)
    sizes, taken = Counter(), Counter()
    for r in clean:
        sizes[r.source] += len(words(r.text))
    for r in mix_:
        taken[r.source] += len(words(r.text))
    goal = water_fill(sizes)
    longest = {s: max(len(words(r.text)) for r in clean if r.source == s) for s in sizes}  # sources have ten documents here
    assert all(abs(taken[s] - goal[s]) <= max(0.02 * goal[s], longest[s] / 2) for s in sizes) and {tuple(r) for r in mix_} <= {tuple(r) for r in clean}
    assert sorted(map(tuple, last), key=lambda r: r[1]) == expected_tokens([(r.doc_id, r.text) for r in mix_])
