"""Repair of the structure of conversations at least cost.

A conversation is legal when the initials of its roles read ``(s?(ua)+)?``: nothing, or turns of user and assistant that
may follow one turn of the system. Edits keep, rerole, delete or insert turns at small whole costs. The cheapest edits are a
shortest path in a graph of (rows read, state of the pattern); Dial's queue, a ring of buckets one for each distance, finds the
distances to the end, and the walk from the start that always takes the least letter among tight arcs is the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import small, stored

_SPACE = " \t\n\x0b\x0c\r"
_KEYS = ("turn", "role", "digest")

# States: 0 at the start, 1 after the system, 2 after a user, 3 after an assistant.
KEEP_MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NEXT = (2, 2, 3, 2)  # the state after the one role that may be inserted or given here
ROLE = ("user", "user", "assistant", "user")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Labels in the queue differ by the dearest arc (6) or, at the border of two blocks, by the states of one place (7) at most.
RING = 16
_FAR = 1 << 60
_INITIALS = "?sua"


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults planted by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes ``[.!?]`` from it, 3 repeats the row, 4 sets its role to user. A null
    in any column counts as one space.
    """
    space = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    marked = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _turn_order(turn: Column) -> Column:
    return F.struct(turn.isNotNull().alias("known"), turn.alias("turn"))


def judged(turns: DataFrame) -> DataFrame:
    """``turns`` with what each row's faults follow from: digest of role and text, blank, truncated, seen (in an earlier turn).

    Nulls in role and text are one space, as in ``damaged``. Repeats are counted before they move; a
    repeated text of any number of rows is joined back in parts.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    end = F.rtrim("text", F.lit(_SPACE))
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    rows = stored(rows.withColumns({"digest": digest, "blank": end == "", "truncated": ~F.right(end, F.lit(1)).isin(".", "!", "?")}), "turns")
    repeats = rows.groupBy("conv_id", "digest").agg(F.min(_turn_order(F.col("turn"))).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeats = stored(repeats.select(F.col("conv_id").alias("conv"), F.col("digest").alias("same"), "first"), "repeated-turns")
    found = rows.join(small(repeats), F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("digest") == F.col("same")), "left")
    return found.withColumn("seen", F.coalesce(F.col("first") < _turn_order(F.col("turn")), F.lit(False))).drop("conv", "same", "first")


def _edges(initial: str, truncated: bool, gone: bool) -> list[dict[str, tuple[int, int]]]:
    """By state: the letter of each edit of a row, with the state it leads to and its cost."""
    late, arcs = TRUNCATED * truncated, []
    for q in range(4):
        arcs.append({"D": (q, DELETE)})
        if not gone:
            if q in (moves := KEEP_MOVES.get(initial, {})):
                arcs[q]["K"] = (moves[q], late)
            arcs[q]["R"] = (NEXT[q], REROLE + late)
    return arcs


#: A row's class in one byte: its role's initial, 4 if it is truncated, 8 if it must go.
ARCS = [_edges(_INITIALS[k & 3], bool(k & 4), bool(k & 8)) for k in range(16)]
_BACK = [[[(p, cost) for p in range(4) for to, cost in arcs[p].values() if to == q] for q in range(4)] for arcs in ARCS]
_INSERTS = [[p for p in range(4) if NEXT[p] == q] for q in range(4)]
#: Distances from the states behind the last row, before anything is inserted there.
END = (0, _FAR, _FAR, 0)


def distances(codes: bytes, ends: tuple[int, ...] = END) -> list[int]:
    """Cost from node 4 * i + state (i rows of ``codes`` are read) to the end, where ``ends`` holds from the last rows on: Dial's algorithm, backwards."""
    n = len(codes)
    dist = [_FAR] * (4 * n + 4)
    ring: list[list[int]] = [[] for _ in range(RING)]
    waiting = 0
    for q, d in enumerate(ends):
        if d < _FAR:
            dist[4 * n + q] = d
            ring[d % RING].append(4 * n + q)
            waiting += 1
    now = min(ends)
    while waiting:
        bucket = ring[now % RING]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if dist[node] != now:
                continue
            i, q = node >> 2, node & 3
            steps = [(4 * i + p, now + INSERT) for p in _INSERTS[q]]
            if i:
                steps += [(4 * i - 4 + p, now + cost) for p, cost in _BACK[codes[i - 1]][q]]
            for to, d in steps:
                if d < dist[to]:
                    dist[to] = d
                    ring[d % RING].append(to)
                    waiting += 1
        now += 1
    return dist


def walk(codes: bytes, dist: list[int], q: int, last: bool) -> tuple[str, int]:
    """The least letters of tight arcs from state ``q`` over a block, and the state they end in; the last block goes on to the end."""
    letters, i, n = [], 0, len(codes)
    while i < n or (last and dist[4 * i + q]):
        d = dist[4 * i + q]
        arcs = ARCS[codes[i]][q] if i < n else {}
        if i < n and dist[4 * i + 4 + q] + DELETE == d:
            letters.append("D")
            i += 1
        elif dist[4 * i + NEXT[q]] + INSERT == d:
            letters.append("I")
            q = NEXT[q]
        else:
            letter = next(x for x in "KR" if x in arcs and dist[4 * i + 4 + arcs[x][0]] + arcs[x][1] == d)
            letters.append(letter)
            q = arcs[letter][0]
            i += 1
    return "".join(letters), q


def cheapest(codes: bytes, block: int = 4096) -> tuple[int, str]:
    """Cost and audit of a conversation of these classes.

    Distances are kept for one block at a time: a first pass from the end keeps those of the borders, a second one from the start
    works each block off again and walks it.
    """
    starts = list(range(0, max(len(codes), 1), block))
    ends, held = [END], []
    for s in reversed(starts):
        held = distances(codes[s : s + block], ends[-1])
        ends.append(tuple(held[:4]))
    cost, state, audit = ends[-1][0], 0, []
    for k, s in enumerate(starts):
        dist = held if len(starts) == 1 else distances(codes[s : s + block], ends[len(starts) - 1 - k])
        letters, state = walk(codes[s : s + block], dist, state, s == starts[-1])
        audit.append(letters)
    return cost, "".join(audit)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of the batches, of which few at a time are Python objects."""
    return (r for b in batches for i in range(0, b.num_rows, 256) for r in zip(*(c.to_pylist() for c in b.slice(i, 256).columns), strict=True))


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds.values(), strict=True)], list(kinds))


_LONG = pa.int64()
_PLAN = {"conv_id": _LONG, "gaps": _LONG, "blank": _LONG, "duplicate": _LONG, "truncated": _LONG, "illegal": _LONG, "cost": _LONG, "audit": pa.string()}


def plans(rows: DataFrame) -> DataFrame:
    """For each conversation of ``judged`` rows: gaps, blank, duplicate, truncated, illegal, cost and audit.

    Texts don't move: a row is its class of one byte, of which a conversation keeps as many as its audit has letters. Rows
    are read by turn, nulls first, equal turns by role and by the digest of role and text, so equal rows are neighbours.
    A fault is the first of blank, duplicate, truncated. Rows with a null conv_id are one conversation.
    """

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv = before = low = high = None
        codes, counts, known, illegal = bytearray(), [0, 0, 0], 0, 0
        done: list[tuple] = []

        def close() -> tuple:
            cost, audit = cheapest(bytes(codes))
            return (conv, high - low + 1 - known if known else 0, *counts, illegal, cost, audit)

        started = False
        for cid, turn, role, digest, blank, truncated, seen in _stream(batches):
            if started and cid != conv:
                done.append(close())
                if len(done) >= 1024 or len(codes) > 1 << 20:
                    yield _batch(done, _PLAN)
                    done = []
            if not started or cid != conv:
                conv, before, low, high, started = cid, None, None, None, True
                codes, counts, known, illegal = bytearray(), [0, 0, 0], 0, 0
            initial = role[:1]
            if before is not None:
                illegal += before[1] + initial not in ("su", "ua", "au")
            again = seen or (before is not None and before[0] == (turn, digest))
            fault = 0 if blank else 1 if again else 2 if truncated else 3
            if fault < 3:
                counts[fault] += 1
            if turn is not None:
                known += high is None or turn != high
                low, high = turn if low is None else low, turn
            codes.append(max(_INITIALS.find(initial, 1), 0) * bool(initial) | 4 * (fault == 2) | 8 * (fault < 2))
            before = ((turn, digest), initial)
        if started:
            done.append(close())
            yield _batch(done, _PLAN)

    thin = rows.select("conv_id", *_KEYS, "blank", "truncated", "seen").repartition("conv_id").sortWithinPartitions("conv_id", *_KEYS)
    return thin.mapInArrow(plan, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")


_TURN = {"conv_id": _LONG, "place": _LONG, "edit": pa.string(), "turn": _LONG, "role": pa.string(), "text": pa.string()}


def mended(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns (conv_id, place, edit, turn, role, text) of ``judged`` rows by the audits of their ``plans``.

    The audit comes before the rows of its conversation, which stream past it. Inserted turns have a null turn number and an empty text.
    """

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        conv, audit, at, state, place = None, "", 0, 0, 0

        def inserts() -> Iterator[tuple]:
            nonlocal at, state, place
            while at < len(audit) and audit[at] == "I":
                yield conv, place, "I", None, ROLE[state], ""
                at, state, place = at + 1, NEXT[state], place + 1

        for cid, head, turn, role, _, text in _stream(batches):
            if head is not None:
                out.extend(inserts())
                conv, audit, at, state, place = cid, head, 0, 0, 0
                continue
            out.extend(inserts())
            edit, at = audit[at], at + 1
            if edit != "D":
                role, state = (ROLE[state], NEXT[state]) if edit == "R" else (role, KEEP_MOVES[role[0]][state])
                out.append((conv, place, edit, turn, role, text))
                place, size = place + 1, size + len(text)
            if len(out) >= 4096 or size > 1 << 22:
                yield _batch(out, _TURN)
                out, size = [], 0
        out.extend(inserts())
        if out:
            yield _batch(out, _TURN)

    none = F.lit(None)
    heads = audits.select("conv_id", F.col("audit").alias("head"), none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("binary").alias("digest"), none.cast("string").alias("text"))
    body = rows.select("conv_id", none.cast("string").alias("head"), *_KEYS, "text")
    both = heads.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", F.col("head").isNull(), *_KEYS)
    return both.mapInArrow(mend, "conv_id long, place long, edit string, turn long, role string, text string")


def transcript_digests(turns: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of ``role:text`` of its turns (conv_id, place, role, text) by place, joined by newlines.

    A digest reads one text from its start, so one task reads a conversation, but it streams.
    """
    kinds = {"conv_id": _LONG, "sha256": pa.string()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, done = None, None, []
        for cid, role, text in _stream(batches):
            if digest is None or cid != conv:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = cid, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            if len(done) >= 4096:
                yield _batch(done, kinds)
                done = []
        if digest is not None:
            yield _batch([*done, (conv, digest.hexdigest())], kinds)

    rows = turns.select("conv_id", "place", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "place").drop("place")
    return rows.mapInArrow(read, "conv_id long, sha256 string")


def repair(turns: DataFrame, conversations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of ``turns`` (conv_id and turn whole numbers, role, text): one plan a conversation, and the repaired turns.

    ``conversations`` (conv_id) names conversations that must have a plan though no row of theirs is left: zeros and an
    empty audit. Costs: keep 0, rerole 3, delete 4 (required for blank and duplicate turns), insert 3; a truncated turn that stays adds 3.
    Among cheapest edits the audit (their initials) is the least in ASCII. Nulls: role and text are one space, a null turn comes
    first, a null conv_id is a conversation. Repeated rows are duplicates of one another. An empty table has no plans. Other columns are ignored.
    """
    rows = stored(judged(turns), "judged-turns")
    found = plans(rows)
    if conversations is not None:
        found = found.unionByName(conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct(), allowMissingColumns=True)
        found = found.groupBy("conv_id").agg(*(F.coalesce(F.max(c), F.lit(0)).alias(c) for c in list(_PLAN)[1:-1]), F.coalesce(F.max("audit"), F.lit("")).alias("audit"))
    found = stored(found, "repair-plans")
    return found, mended(rows, found)
