"""What has no cap: phrases over cuts, exact near-duplicates, equal rows, columns of any name; long texts; plain versions of results."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from civicframe.llm import fingerprint as fp
from civicframe.llm import langid, sharding
from civicframe.llm.decontaminate import contamination, decontaminate
from civicframe.llm.fingerprint import edited_fingerprints
from civicframe.llm.neardup import near_duplicates
from civicframe.llm.sharding import CELL_ROWS, even_cut, shard
from civicframe.llm.stages import mixed, one_of_each, with_language
from tests.llm.test_corpus import LOWER, jaccard, shingles


def plain_phrases(model, lang, sample, text):
    """Longest matches of ``text`` in ``sample``, one after the other."""
    code = lambda t: "".join(chr(x) for x in model.alphabet.encode(t).tolist())
    sample, t, n, i = code(sample), code(text), 0, 0
    while i < len(t):
        length = 1
        while i + length < len(t) and t[i : i + length + 1] in sample:
            length += 1
        i, n = i + length, n + 1
    return n, len(t)


def test_scores_of_long_texts_equal_plain_cross_parsing(monkeypatch):
    rng = random.Random(2)
    words = ["huis", "straat", "maison", "rue", "the", "street", "of", "van", "de", "la"]
    learned = {k: " ".join(rng.choices(words, [1 + 5 * (i % 3 == n) for i in range(10)], k=150)) for n, k in enumerate(("nl", "fr", "en"))}
    texts = [" ".join(rng.choices(words, k=n)) for n in (0, 1, 3, 20, 300, 900)]
    for segment in (7, 64, 2048):
        monkeypatch.setattr(langid, "SEGMENT", segment)
        model = langid.Model(learned)
        bits, n = model.entropies(texts, group=4)
        for row, text in enumerate(texts):
            for k, lang in enumerate(model.langs):
                count, size = plain_phrases(model, lang, learned[lang], text)
                assert size == n[row] and bits[row, k] == pytest.approx(count * model.bits[k] / max(size, 1))


def edited(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**9)}"
    return " ".join(out)


def test_exact_near_duplicates_of_large_groups(spark):
    rng = random.Random(9)
    rows = []
    for group in range(3):
        base = [f"g{group}x{rng.randrange(400)}" for _ in range(220)]
        rows += [edited(base, rng, rng.choice([0, 1, 2, 4, 8, 12])) for _ in range(45)]
    rows += [edited([f"z{rng.randrange(50)}" for _ in range(60)], rng, 3) for _ in range(40)]
    rng.shuffle(rows)
    sets = [shingles(t, 2) for t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    expected = {i: root(i) for i in range(len(rows))}
    assert 20 < len(set(expected.values())) < len(rows) - 60
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for exact in (True, False):
        got = {r.doc_id: r.component_id for r in near_duplicates(docs, shingle=2, exact=exact).collect()}
        assert got == expected
    assert jaccard(sets[0], sets[0]) == 1


def test_equal_rows_are_cut_into_cells(spark):
    n = 4 * CELL_ROWS
    docs = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text"))
    got = shard(docs, shards=4)
    assert [(r.shard, r["count"]) for r in got.groupBy("shard").count().orderBy("shard").collect()] == [(i, n // 4) for i in range(4)]
    assert got.groupBy("shard").agg(F.count_distinct("slot").alias("d"), F.max("slot").alias("m")).where("d <> m + 1").count() == 0
    plan = even_cut(spark.range(n).select(F.lit(1).alias("id"), F.lit(7).cast("long").alias("group"), F.lit(1).cast("long").alias("size"), F.lit(n).cast("long").alias("members"), F.lit(0).alias("shard"), F.col("id").alias("row")), 4)
    assert plan.count() == n


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_keep_columns_of_any_name(spark):
    rows = [(1, "the cat sat on the mat in the house", "en", "a", 1), (1, "the cat sat on the mat in the garden", "en", "a", 1), (2, "le chat dort dans la maison rouge", "fr", "b", 2), (3, None, None, None, None), (None, "12", "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"a.b": F.col("n_chars"), "m": F.create_map(F.lit("k"), F.col("n_chars")), "_key": F.lit(1), "Sketch": F.lit("x")})
    bench = spark.createDataFrame([(1, "the cat sat on the mat in the house")], "item_id long, text string")
    for stage in (with_language, one_of_each, mixed, lambda d: decontaminate(d, bench), lambda d: decontaminate(d, bench, remove="spans")):
        out = stage(docs)
        assert out.columns == docs.columns and out.count() > 0
        assert stage(docs.where("false")).count() == 0
        assert all(r["a.b"] == (r.m or {}).get("k") for r in out.collect())
    assert sorted(str(r.doc_id) for r in one_of_each(docs).collect()) == ["1", "2", "3", "None"]


def test_very_long_texts(spark):
    long = " ".join(f"w{i % 977}" for i in range(120_000))
    rows = [(1, long), (2, long + " end"), (3, "short text"), (4, long.replace("w5 ", "v5 ")), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {r.doc_id: r for r in edited_fingerprints(docs).collect()}
    assert prints[1].n_chars == len(long) and prints[2].near_next == 1.0 or prints[2].near_next > 0.99
    bench = spark.createDataFrame([(9, " ".join(f"w{i}" for i in range(100, 120)))], "item_id long, text string")
    hits = {r.doc_id: r._report for r in contamination(docs, bench).collect()}
    assert hits[1].n_words == 120_000 and hits[1].n_hit == 20 * sum(1 for k in range(123) if 977 * k + 119 < 120_000) and hits[3].n_hit == 0
    near = {r.doc_id: r.component_id for r in near_duplicates(docs, shingle=5).collect()}
    assert near == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5}
    placed = shard(docs, shards=2).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in placed} == {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows}
    assert Counter(r.shard for r in placed).total() == 5 and np.isfinite([r.slot for r in placed]).all()


def xx64(*values):
    """Spark's hash of several columns: numbers as their bytes, texts as UTF-8, a list as its elements one after the other."""
    seed = 42
    for v in values:
        for part in v if isinstance(v, list) else [v]:
            data = part.encode() if isinstance(part, str) else int(part).to_bytes(4 if isinstance(part, np.int32) else 8, "little", signed=True)
            seed = xxhash.xxh64(data, seed=seed).intdigest()
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_fingerprint(text):
    """One-permutation MinHash, bin by bin."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    if not words:
        return ""
    bins = {}
    for i in range(max(1, len(words) - fp.SHINGLE + 1)):
        h = xx64(words[i : i + fp.SHINGLE]) >> 1
        bins[h >> 55] = min(h, bins.get(h >> 55, h))
    out = []
    for j in range(fp.BINS):
        probes = [j, *(fp._mixed(j * fp.PROBES + t) % fp.BINS for t in range(fp.PROBES))]
        found = next((bins[p] for p in probes if p in bins), None)
        if found is None:
            found = bins[min(bins, key=lambda i: (signed(xx64(np.int32(j), np.int32(i))), bins[i]))]
        out.append(f"{found & 255:02x}")
    return "".join(out)


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    same = sum(a[i : i + 2] == b[i : i + 2] for i in range(0, len(a), 2)) / fp.BINS
    return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


def test_fingerprints_equal_plain_ones(spark, sf_dir):
    from civicframe.llm.queries import op3_fingerprints

    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in op3_fingerprints(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for k, (doc_id, text) in enumerate(docs):
        following = docs[(k + 1) % len(docs)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        r, mine, other = got[doc_id], plain_fingerprint(text), plain_fingerprint(edited)
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), mine, other)
        assert r.near_edited == pytest.approx(plain_likeness(mine, other)) and r.near_next == pytest.approx(plain_likeness(mine, plain_fingerprint(following)))


def plain_propagation(rows, shards, rounds):
    """Labels of rows (id, group, size, members, group_bytes), round by round."""
    unit = lambda *keys: signed(xx64(*keys)) % (1 << 52) / (1 << 52)
    label = [int(unit(r[0], r[1], "start") * shards) for r in rows]

    def wishes():
        held = defaultdict(Counter)
        for r, s in zip(rows, label, strict=True):
            if r[3] > 1:
                held[r[1]][s] += r[2]
        top = {g: max(c, key=lambda s: (c[s], signed(xx64(g, np.int32(s))), s)) for g, c in held.items()}
        return [top.get(r[1]) for r in rows]

    for k in range(rounds):
        loads, flows, to = Counter(), Counter(), wishes()
        for r, s, t in zip(rows, label, to, strict=True):
            loads[s] += r[2]
            if t is not None and t != s:
                flows[s, t] += r[2]
        capacity = (1 + sharding.SLACK) * sum(loads.values()) / shards
        allowed = sharding.grants(dict(flows), dict(loads), capacity)
        if not allowed:
            break
        for i, (r, s, t) in enumerate(zip(rows, list(label), to, strict=True)):
            chance = unit(r[0], r[1], np.int32(k)) if r[4] * 50 > capacity else unit(r[1], np.int32(k))
            if (s, t) in allowed and chance < allowed[s, t]:
                label[i] = t
    total = sum(r[2] for r in rows)
    return [t if t is not None and r[4] * 50 * shards <= total else s for r, s, t in zip(rows, label, wishes(), strict=True)]


def test_label_propagation_equals_plain_rounds(spark):
    rng = random.Random(6)
    rows, n = [], 0
    for group in range(120):
        members = rng.choice([1, 1, 2, 3, 9, 60])
        sizes = [rng.randrange(1, 400)] * members
        key = rng.randrange(-(1 << 62), 1 << 62)
        rows += [(n + i, key, s, members, sum(sizes)) for i, s in enumerate(sizes)]
        n += members
    df = spark.createDataFrame(rows, "id long, group long, size long, members long, group_bytes long")
    for shards, rounds in ((4, 3), (16, 4), (3, 0)):
        got = {r.id: r.shard for r in sharding.propagate(df, shards, rounds=rounds).collect()}
        assert got == dict(zip((r[0] for r in rows), plain_propagation(rows, shards, rounds), strict=True))
