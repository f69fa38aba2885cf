"""Ranked lexical search: compressed postings a shard, merged document by document.

Each task that reads documents writes them as shards: the documents in the order of their ids, the terms in
order, and for each term its postings (gap to the document before, occurrences) as bytes of seven bits. A shard answers all items of
a block of queries in one pass: the cursors of an item's terms lie on a heap by document, the least document is scored from all
cursors on it, and a bounded heap keeps the best. Terms that together can't lift a document into that heap don't lead; they are
looked up only for documents that other terms lead to. Best documents of the shards are merged by item.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicframe.llm.common import small, stored, words

#: What a term is made of: digits, letters A-Z in lower case, and all signs beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Bytes of UTF-8 to bytes of terms: other signs part terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))

_INT, _LONG = pa.int32(), pa.int64()
_SHARD = pa.schema(
    [("doc_ids", pa.list_(_LONG)), ("lengths", pa.list_(_LONG)), ("terms", pa.list_(pa.binary())), ("df", pa.list_(_INT)), ("gap_ends", pa.list_(_INT)), ("gaps", pa.binary()), ("tf_ends", pa.list_(_INT)), ("tfs", pa.binary())]
)
SHARD = "doc_ids array<long>, lengths array<long>, terms array<binary>, df array<int>, gap_ends array<int>, gaps binary, tf_ends array<int>, tfs binary"


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers from 0 as bytes of seven bits, the last of each below 128; and the length of each in bytes."""
    lengths = np.ones(len(values), np.int64)
    for k in range(1, 9):
        lengths += values >= (1 << 7 * k)
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    at, rest = ends - lengths, values.astype(np.int64)
    for k in range(int(lengths.max(initial=0))):
        more = lengths > k + 1
        here = lengths > k
        out[(at + k)[here]] = ((rest & 127) | np.where(more, 128, 0))[here]
        rest = rest >> 7
    return out, lengths


def unpacked(data: np.ndarray) -> np.ndarray:
    """The numbers of ``packed`` bytes."""
    last = np.flatnonzero(data < 128)
    first = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
    values = (data[first] & 127).astype(np.int64)
    for k in range(1, int((last - first).max(initial=0)) + 1):
        here = last - first >= k
        values[here] |= (data[first[here] + k] & 127).astype(np.int64) << 7 * k
    return values


def _shard(docs: list[tuple[int | None, Counter, int]]) -> pa.RecordBatch:
    """One shard of documents (id, terms with their counts, number of terms)."""
    docs.sort(key=lambda d: (d[0] is None, d[0] or 0))
    places: dict[bytes, array] = defaultdict(lambda: array("q"))
    for i, (_, counts, _) in enumerate(docs):
        for term, n in counts.items():
            p = places[term]
            p.append(i)
            p.append(n)
    terms = sorted(places)
    df = np.fromiter((len(places[t]) >> 1 for t in terms), np.int64, len(terms))
    flat = np.concatenate([np.frombuffer(places[t], np.int64) for t in terms]).reshape(-1, 2) if terms else np.zeros((0, 2), np.int64)
    begin = np.cumsum(df) - df
    gaps = flat[:, 0].copy()
    gaps[1:] -= flat[:-1, 0]
    gaps[begin] = flat[begin, 0]
    row: list = [[d[0] for d in docs], [d[2] for d in docs], terms, df]
    for values in (gaps, flat[:, 1] - 1):
        data, lengths = packed(values)
        row += [np.add.reduceat(lengths, begin).cumsum() if len(begin) else lengths, data.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _SHARD.types, strict=True)], schema=_SHARD)


def build_index(docs: DataFrame, *, shard_bytes: int = 8 << 20, shard_docs: int = 1 << 14) -> DataFrame:
    """The shards of ``docs`` (doc_id a whole number, text): no row moves, a task's documents are its shards.

    A shard takes documents until ``shard_bytes`` of text or ``shard_docs`` are reached, so memory is bounded by that and
    the longest text. Documents without a term (null or empty texts too) are in no shard. A null id comes last in its shard; rows that
    repeat an id are documents of their own. Other columns are ignored. Every shard is written once; read it from a stored table.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            ids, texts = batch.columns
            texts = texts.cast(pa.large_binary())
            for i, doc_id in enumerate(ids.to_pylist()):
                text = texts[i].as_py()
                tokens = (text or b"").translate(_FOLD).split()
                if not tokens:
                    continue
                held.append((doc_id, Counter(tokens), len(tokens)))
                size += len(text)
                if size >= shard_bytes or len(held) >= shard_docs:
                    yield _shard(held)
                    held, size = [], 0
        if held:
            yield _shard(held)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, SHARD)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term and occurrences of ``items`` (item_id, text); rows that share an item_id, null too, are one item."""
    found = items.select("item_id", F.explode(words(F.col("text"), TERM)).alias("term"))
    return found.groupBy("item_id", "term").agg(F.count("*").alias("times"))


def _best(k: int):
    """The function of tasks that search shards."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        names: dict[int, int | None] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                search_shard({n: batch.column(n)[i] for n in batch.schema.names}, best, names, k)
        rows = [(names[i], None if not known else -neg, score) for i, heap in best.items() for score, known, neg in heap]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, _LONG) for c in zip(*rows, strict=True)], ["item_id", "doc_id", "score"])

    return answer


def search_shard(row: dict, best: dict[int, list[tuple]], names: dict[int, int | None], k: int) -> None:
    """Put the documents of a shard (with a block of items, N and L) into the heaps ``best`` of the items, by their numbers."""
    ids = row["doc_ids"].as_py()
    lengths = row["lengths"].values.to_numpy(zero_copy_only=False)
    n_docs, n_terms = row["n_docs"].as_py(), row["n_terms"].as_py()
    if 25 * int(lengths.max()) * n_docs < 1 << 62:
        m = 75 + 25 * lengths * n_docs // n_terms
    else:
        m = np.array([75 + 25 * int(n) * n_docs // n_terms for n in lengths], np.int64)
    terms = row["terms"].values
    gap_ends, tf_ends = (row[c].values.to_numpy(zero_copy_only=False) for c in ("gap_ends", "tf_ends"))
    gaps, tfs = (np.frombuffer(row[c].as_py(), np.uint8) for c in ("gaps", "tfs"))
    lists: dict[bytes, tuple | None] = {}

    def postings(term: bytes) -> tuple | None:
        """Documents of a term and what an occurrence rating of 1 is worth there; None if the shard has none."""
        if term not in lists:
            low, high = 0, len(terms)
            while low < high:
                mid = (low + high) >> 1
                if terms[mid].as_py() < term:
                    low = mid + 1
                else:
                    high = mid
            if low < len(terms) and terms[low].as_py() == term:
                docs = unpacked(gaps[gap_ends[low - 1] if low else 0 : gap_ends[low]]).cumsum()
                tf = unpacked(tfs[tf_ends[low - 1] if low else 0 : tf_ends[low]]) + 1
                worth = 1_000_000_000 * tf // (1000 * tf + 12 * m[docs])
                lists[term] = (docs.tolist(), worth.tolist(), int(worth.max()))
            else:
                lists[term] = None
        return lists[term]

    for item in row["items"].as_py():
        cursors = []
        for t in item["terms"]:
            if t["weight"] and (p := postings(t["term"])):
                cursors.append((p[2] * t["weight"], t["weight"], p[0], p[1]))
        if cursors:
            names[item["number"]] = item["item_id"]
            _merge(sorted(cursors, key=lambda c: c[0]), ids, best.setdefault(item["number"], []), k)


def _merge(cursors: list[tuple], ids: list, heap: list[tuple], k: int) -> None:
    """Merge the cursors (bound, weight, documents, worth), least bound first, into a bounded heap of (score, id known, -id)."""
    bounds = np.cumsum([c[0] for c in cursors]).tolist()
    at = [0] * len(cursors)
    leaders = 0
    floor = heap[0][0] if len(heap) == k else 0

    def lead() -> int:
        """The first cursor that leads: those before it can't lift a document to the worst score kept."""
        first = leaders
        while first < len(cursors) and bounds[first] < floor:
            first += 1
        return first

    leaders = lead()
    queue = [(c[2][0], j) for j, c in enumerate(cursors) if j >= leaders]
    heapq.heapify(queue)
    while queue:
        doc = queue[0][0]
        score = 0
        while queue and queue[0][0] == doc:
            j = queue[0][1]
            _, weight, docs, worth = cursors[j]
            score += weight * worth[at[j]]
            at[j] += 1
            if at[j] < len(docs):
                heapq.heapreplace(queue, (docs[at[j]], j))
            else:
                heapq.heappop(queue)
        for j in range(leaders - 1, -1, -1):
            if score + bounds[j] < floor:
                break
            _, weight, docs, worth = cursors[j]
            at[j] = bisect_left(docs, doc, at[j])
            if at[j] < len(docs) and docs[at[j]] == doc:
                score += weight * worth[at[j]]
        else:
            if score > 0:
                key = (score, ids[doc] is not None, -(ids[doc] or 0))
                if len(heap) < k:
                    heapq.heappush(heap, key)
                elif key > heap[0]:
                    heapq.heapreplace(heap, key)
                if len(heap) == k and heap[0][0] > floor:
                    floor = heap[0][0]
                    if (now := lead()) > leaders:
                        leaders = now
                        queue = [x for x in queue if x[1] >= leaders]
                        heapq.heapify(queue)


def search(index: DataFrame, items: DataFrame, *, k: int = 20, block_terms: int = 1 << 15) -> DataFrame:
    """The ``k`` best documents of each item (item_id a whole number, text): item_id, rank, doc_id, score.

    ``index`` is a stored ``build_index``. Counts (N, L, df) are those of all its documents. The queries are dealt into blocks of
    about ``block_terms`` different terms, and each shard answers one block at a time, so memory is bounded by a shard and a block. Scores are
    whole numbers; equal scores go by ascending doc_id, null ids last, and rows that repeat an id have ranks of their own.
    Items without terms, or without a document above 0, have no rows. Rows that share an item_id are one item.
    """
    total = index.agg(F.coalesce(F.sum(F.size("doc_ids")), F.lit(0)).alias("n_docs"), F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)).alias("n_terms")).first()
    wanted = stored(item_terms(items), "item-terms")
    seen = index.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("key"), F.col("t.df").alias("df"))
    vocabulary = wanted.select(F.col("term").cast("binary").alias("key")).distinct()
    df = seen.join(small(vocabulary), "key").groupBy("key").agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * total.n_docs + 2) / (2 * F.col("df").cast("double") + 1)
    weight = F.floor(F.lit(1000.0) * F.log(ratio))
    weighted = wanted.withColumn("key", F.col("term").cast("binary")).join(df, "key")
    term = F.struct(F.col("key").alias("term"), (F.col("times") * weight).cast("long").alias("weight"))
    one_item = stored(weighted.groupBy("item_id").agg(F.collect_list(term).alias("terms")).withColumn("number", F.monotonically_increasing_id()), "items")
    n_blocks = 1 + one_item.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0] // block_terms
    blocks = one_item.groupBy(F.pmod(F.xxhash64("number"), F.lit(n_blocks)).alias("block")).agg(F.collect_list(F.struct("number", "item_id", "terms")).alias("items"))
    # a stated query set against all shards: each shard is read once for each block of items
    pairs = index.join(small(blocks.select("items")), how="cross").withColumns({"n_docs": F.lit(total.n_docs), "n_terms": F.lit(total.n_terms)})
    found = pairs.mapInArrow(_best(k), "item_id long, doc_id long, score long")
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    part = Window.partitionBy("item_id", "part").orderBy(*order)
    few = found.withColumn("part", F.spark_partition_id() % 64).withColumn("place", F.row_number().over(part)).where(F.col("place") <= k)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
