"""Repair of conversations, exact duplicates and ranked search against plain Python."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from civicframe.llm import queries as llm
from civicframe.llm.exactdup import distinct_texts, exact_groups, repeat_filter, text_digest
from civicframe.llm.repair import _INITIALS, cheapest, repair, transcript_digests
from civicframe.llm.search import build_index, packed, search, unpacked
from civicframe.store import stored
from tests.conftest import SMALL

SPACE = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = getattr(llm, name)(spark, SMALL)
    expected = con.execute(llm.ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(got.columns) == sorted(names)
    rows = expected.fetchall()
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(rows) and rows


# --- repair -----------------------------------------------------------------


def best_by_search(rows):
    """Least (cost, audit) over all edits of rows (initial, truncated, must go), state by state: plain dynamic programming over whole strings."""
    moves = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    nxt = (2, 2, 3, 2)

    @functools.cache
    def rest(i, q, inserted):
        found = []
        if i == len(rows) and q in (0, 3):
            found.append((0, ""))
        if inserted < 3:
            c, a = rest(i, nxt[q], inserted + 1)
            found.append((c + 3, "I" + a))
        if i < len(rows):
            initial, late, gone = rows[i]
            options = [("D", q, 4)]
            if not gone:
                options.append(("R", nxt[q], 3 + 3 * late))
                if q in moves.get(initial, {}):
                    options.append(("K", moves[initial][q], 3 * late))
            for letter, to, cost in options:
                c, a = rest(i + 1, to, 0)
                found.append((c + cost, letter + a))
        return min(found, default=(1 << 30, ""))

    return rest(0, 0, 0)


def test_cheapest_equals_plain_search():
    rng = random.Random(1)
    for n in [*range(7)] * 40 + [40, 90]:
        rows = [(rng.choice("suuaaax"), rng.random() < 0.3, rng.random() < 0.2) for _ in range(n)]
        codes = bytes(max(_INITIALS.find(i, 1), 0) | 4 * (t and not g) | 8 * g for i, t, g in rows)
        expected = best_by_search(tuple((i, int(t and not g), g) for i, t, g in rows))
        assert cheapest(codes) == expected, rows
        for block in (1, 2, 3):
            assert cheapest(codes, block) == expected, rows


def brute_repair(rows, ids):
    """What op11 returns, for rows (conv_id, turn, role, text) in plain Python."""
    out = []
    for conv in ids:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = []
        for c, t, role, text in mine:
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            turns += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        seen, faults = set(), []
        for _, role, text in turns:
            end = text.rstrip(SPACE)
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = best_by_search(tuple((t[1][:1], int(f == "truncated"), f in ("blank", "duplicate")) for t, f in zip(turns, faults, strict=True)))
        lines, rest = [], iter(turns)
        length = sum(x != "D" for x in audit)
        roles = ["system"] * (length % 2) + ["user", "assistant"] * (length // 2)
        for letter in audit:
            turn = None if letter == "I" else next(rest)
            if letter != "D":
                role = roles[len(lines)]
                lines.append(f"{role}:" if letter == "I" else f"{role}:{turn[2]}" if letter == "R" else f"{turn[1]}:{turn[2]}")
        assert LEGAL.fullmatch("".join(x[0] for x in lines))
        known = [t for t, _, _ in turns if t is not None]
        initials = [r[:1] for _, r, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        count = Counter(faults)
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def brute_long(rows, conv):
    """Cost and audit of a long conversation, by the plain recurrence from its end."""
    seen, classes = set(), []
    for _, t, role, text in sorted(r for r in rows if r[0] == conv):
        kind = zlib.crc32(f"{conv}:{t}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        for _ in range((kind != 0) + (kind == 3)):
            gone = not text.strip(SPACE) or (role, text) in seen
            classes.append((role[0], text.rstrip(SPACE)[-1:] not in (".", "!", "?") and not gone, gone))
            seen.add((role, text))
    moves, nxt = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}, (2, 2, 3, 2)
    best = [(0, ""), (1 << 30, ""), (1 << 30, ""), (0, "")]
    inserted = lambda b: [min(b[q], (b[nxt[q]][0] + 3, "I" + b[nxt[q]][1]), (b[nxt[nxt[q]]][0] + 6, "II" + b[nxt[nxt[q]]][1])) for q in range(4)]
    best = inserted(best)
    for initial, late, gone in reversed(classes):
        now = []
        for q in range(4):
            found = [(best[q][0] + 4, "D" + best[q][1])]
            if not gone:
                found.append((best[nxt[q]][0] + 3 + 3 * late, "R" + best[nxt[q]][1]))
                if q in moves[initial]:
                    to = moves[initial][q]
                    found.append((best[to][0] + 3 * late, "K" + best[to][1]))
            now.append(min(found))
        best = inserted(now)
    return best[0]


COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def write_tables(spark, folder, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows_sorted(rows):
    return sorted(map(tuple, rows), key=str)


def test_repair_of_all_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = llm.op11_repair(spark, sf_dir).select(*COLUMNS).collect()
    assert rows_sorted(got) == rows_sorted(brute_repair(rows, {r[0] for r in rows}))


def test_repair_of_odd_conversations(spark, tmp_path):
    rng = random.Random(5)
    texts = ["Yes.", "no", "", " \n", "Why?", None, "a! ", "b" * 3000]
    rows = []
    for conv in [None, *range(60)]:
        turns = rng.sample([None, *range(-3, 40)], rng.randrange(1, 12))
        rows += [(conv, t, rng.choice(["user", "assistant", "system", "", None, "tool", "Up"]), rng.choice(texts)) for t in turns]
    rows += [(77, t, rng.choice(["user", "assistant"]), f"{rng.randrange(9)}.") for t in range(6000)]
    schema = "conv_id long, turn long, role string, text string"
    extra = spark.createDataFrame(rows, schema).withColumns({"digest": F.lit(1), "seen": F.lit("x"), "Blank": F.lit(None).cast("string")})
    path = write_tables(spark, tmp_path / "a", conversations=extra)
    got = {r.conv_id: tuple(r) for r in llm.op11_repair(spark, path).select(*COLUMNS).collect()}
    assert len(got) == 62
    expected = {r[0]: r for r in brute_repair([r for r in rows if r[0] != 77], [None, *range(60)])}
    assert {k: v for k, v in got.items() if k != 77} == expected
    mine = brute_long(rows, 77)
    assert got[77][7] == mine[1] and got[77][6] == mine[0] and len(mine[1]) > 5000
    empty = write_tables(spark, tmp_path / "b", conversations=spark.createDataFrame([], schema))
    assert llm.op11_repair(spark, empty).collect() == []


def test_a_conversation_that_is_dropped_whole_is_returned(spark, tmp_path):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    path = write_tables(spark, tmp_path / "a", conversations=spark.createDataFrame([(conv, 0, "user", "x")], "conv_id long, turn long, role string, text string"))
    assert [tuple(r) for r in llm.op11_repair(spark, path).select(*COLUMNS).collect()] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_turns_are_legal_and_ties_are_defined(spark):
    rows = [(1, 5, "user", "A."), (1, 5, "user", "A."), (1, 5, "assistant", "B."), (1, 2, "system", "S."), (2, 0, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plans, turns = repair(df)
    assert {r.conv_id: (r.duplicate, r.gaps, r.audit) for r in plans.collect()} == {1: (1, 2, "KIKKDI"), 2: (0, 0, "D")}
    placed = [(r.edit, r.role, r.text) for r in turns.orderBy("conv_id", "place").collect()]
    assert placed == [("K", "system", "S."), ("I", "user", ""), ("K", "assistant", "B."), ("K", "user", "A."), ("I", "assistant", "")]
    lines = [f"{r.role}:{r.text}" for r in turns.where("conv_id = 1").orderBy("place").collect()]
    assert LEGAL.fullmatch("".join(x[0] for x in lines))
    assert {r.conv_id: r.sha256 for r in transcript_digests(turns).collect()} == {1: hashlib.sha256("\n".join(lines).encode()).hexdigest()}


# --- exact duplicates -------------------------------------------------------


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_filter_flags_every_repeat_and_few_others(spark):
    values = [f"t{i}" for i in range(20000)] + ["t7"] * 3000 + [f"t{i}" for i in range(0, 2000, 2)]
    digests = spark.createDataFrame([(v,) for v in values], "text string").select("text", text_digest(F.col("text")).alias("digest"))
    from civicframe.llm.exactdup import flagged

    places, blocks = repeat_filter(digests)
    assert blocks == math.ceil(len(values) * 16 / 32768)
    count = Counter(values)
    marked = flagged(digests, "digest", places, blocks, "again").collect()
    assert len(marked) == len(values)
    assert all(r.again for r in marked if count[r.text] > 1)
    alone = [r.again for r in marked if count[r.text] == 1]
    assert sum(alone) / len(alone) < 0.03


def odd_documents(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "\t\n", "a b", "a  b", "a\x0bb", "a b", "A b", "ü", "long " * 60000]
    rows = [(i if rng.random() < 0.95 else None, rng.choice(texts), "x", rng.choice(["s", None]), i) for i in range(400)]
    rows += [(7, "a b", "y", "s", 0)] * 5 + [(-3, f"unique {i}", "x", "s", i) for i in range(50)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, digest string, again string, n_chars long")


def test_exact_groups_of_odd_documents(spark):
    rows, docs = odd_documents(spark)
    groups = {}
    for r in rows:
        groups.setdefault(normal(r[1]), []).append(r[0])
    got = exact_groups(docs).collect()
    assert len(got) == len(rows)
    by_digest = {}
    for r in got:
        by_digest.setdefault(bytes(r.digest), []).append(r)
    assert len(by_digest) == len(groups)
    for text, ids in groups.items():
        mine = by_digest[hashlib.sha256(text.encode()).digest()]
        keep = min((i for i in ids if i is not None), default=None)
        assert {(r.keep_id, r.group_size) for r in mine} == {(keep, len(ids))}
        assert sorted(map(str, (r.doc_id for r in mine))) == sorted(map(str, ids))
        assert [r.doc_id for r in mine if r.kept] == [keep]
    assert exact_groups(docs.where("false")).collect() == []


def test_distinct_texts_keep_one_row_with_all_columns(spark):
    rows, docs = odd_documents(spark)
    docs = docs.withColumns({"a.b": F.col("n_chars"), "m": F.create_map(F.lit("k"), F.col("n_chars"))})
    got = distinct_texts(docs).collect()
    assert distinct_texts(docs).columns == docs.columns
    groups = {}
    for r in rows:
        groups.setdefault(normal(r[1]), []).append(r)
    assert len(got) == len(groups)
    for r in got:
        mine = groups[normal(r.text)]
        assert (r.doc_id is None, r.doc_id or 0) == min((x[0] is None, x[0] or 0) for x in mine)
        assert (r.doc_id, r.text, r.digest, r.again, r.n_chars) in mine and r.m == {"k": r["a.b"]}
    assert distinct_texts(docs.where("false")).count() == 0


# --- search -----------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(docs, items, k):
    """item_id, rank, doc_id, score by scoring each document."""
    terms = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n_docs, n_terms = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, []).extend(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, query in wanted.items():
        scored = []
        for doc, c in terms:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in query if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


def test_packed_numbers_read_back():
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.integers(0, 1 << b, 50) for b in range(1, 56)] + [np.array([0, 127, 128, 16383, 16384])])
    data, lengths = packed(values)
    assert (unpacked(data) == values).all() and lengths.sum() == len(data)
    assert len(unpacked(packed(np.array([], np.int64))[0])) == 0


@pytest.mark.parametrize("shard_docs,block_terms,k", [(1 << 14, 1 << 15, 20), (7, 3, 5), (40, 30, 1)])
def test_search_equals_brute_force(spark, shard_docs, block_terms, k):
    rng = random.Random(shard_docs)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "日本", "x1", "Z"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i if i % 29 else None, " -".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 60)))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "\t-"), (5, docs[5][1]), (1003, docs[6][1]), (1004, "w3 " * 200000 + "rare")]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 15)))) for i in range(25)] + [(None, "w1 w2"), (3, "w50 w50"), (90, None), (91, "absent"), (92, "rare W3")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"terms": F.lit(1), "df": F.lit("x")})
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(1))
    index = stored(build_index(d.repartition(3), shard_docs=shard_docs), "index")
    got = search(index, q, k=k, block_terms=block_terms).collect()
    assert rows_sorted(got) == rows_sorted(brute_search(docs, items, k))


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(stored(build_index(none), "index"), items).collect() == []
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert search(stored(build_index(some), "index"), items.where("false")).collect() == []
