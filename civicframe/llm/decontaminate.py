"""Benchmark decontamination by a broadcast set of normalised n-grams, in DataFrame functions only.

A window is ``n`` words in a row of a benchmark item, or the whole of a shorter item. Hashes of the windows go to all
tasks, if they are counted to be few enough (else Spark shuffles); documents are scanned for windows of the same
lengths, hits are verified word by word, and what is found is laid over the document's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import let, quoted, small, stored, unused, words

#: Runs of digits, ASCII letters and all signs outside ASCII, once A-Z are in lower case.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words where A-Z are still in upper case; to count them needs no lower-cased copy of the text.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GRAM = 13


def item_words(text: Column) -> Column:
    """The words by which documents and items are compared."""
    return words(text, ITEM_WORD)


def benchmark_windows(benchmark: DataFrame, *, n: int = GRAM, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Windows of the items: item_id, len, words; each once an item. Null and wordless items have none."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item_id"), item_words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(n))
    windows = items.select("item_id", length.alias("len"), F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.slice("w", i, length))).alias("words"))
    return windows.distinct()


def _row_key(id_col: str, text_col: str) -> Column:
    """Rows with equal ids and texts have equal results and so may share a key."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("a"), F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("b"))


def _places(n: int) -> Column:
    """Position and hash of each window of ``n`` words of ``w``."""
    starts = F.when(F.size("w") >= n, F.sequence(F.lit(1), F.size("w") - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(n), F.slice("w", i, F.lit(n))).alias("window")))


def window_hits(docs: DataFrame, windows: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """Verified occurrences: key, spans (sorted array of pos from 1 and len), items (sorted array). Only keys with some."""
    distinct = stored(windows.groupBy("len", "words").agg(F.sort_array(F.collect_set("item_id")).alias("items")).withColumn("window", F.xxhash64("len", "words")), "windows")
    lengths = sorted(r.len for r in distinct.select("len").distinct().collect())  # at most as many as a window has words
    key, text = _row_key(id_col, text_col), F.col(text_col)
    scanned = docs.select(key.alias("key"), item_words(text).alias("w"))
    found = docs.select(key.alias("key"), F.lit(0).alias("pos"), F.lit(0).alias("len"), F.lit(0).cast("bigint").alias("window")).limit(0)
    for n in lengths:
        looked = scanned.select("key", F.explode(_places(n)).alias("h")).select("key", F.col("h.pos").alias("pos"), F.lit(n).alias("len"), F.col("h.window").alias("window"))
        found = found.unionByName(looked.join(small(distinct.where(F.col("len") == n).select("window").distinct()), "window", "left_semi"))
    per_key = stored(found.groupBy("key").agg(F.collect_set(F.struct("pos", "len", "window")).alias("found")), "window-hits")
    # exact check: the words at each place against those of the windows that the hash names
    again = docs.select(key.alias("key"), text.alias("text")).join(small(per_key.select("key")), "key", "left_semi").select("key", item_words(F.col("text")).alias("w"))
    places = again.join(per_key, "key").select("key", F.explode(F.transform("found", lambda f: F.struct(f["pos"].alias("pos"), f["len"].alias("len"), f["window"].alias("window"), F.slice("w", f["pos"], f["len"]).alias("words")))).alias("f")).select("key", "f.*")
    sure = places.join(small(distinct), ["len", "window", "words"])
    return sure.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("pos", "len"))).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def covered(spans: Column) -> Column:
    """Number of words in the union of sorted (pos, len) spans."""

    def put(acc: Column, s: Column) -> Column:
        end = s["pos"] + s["len"] - 1
        return F.struct(F.greatest(acc["upto"], end).alias("upto"), (acc["n"] + F.greatest(end - F.greatest(acc["upto"], s["pos"] - 1), F.lit(0))).alias("n"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n")), put)["n"].cast("long")


def contamination(docs: DataFrame, benchmark: DataFrame, *, n: int = GRAM, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", one_in: int = 20, report_col: str = "_report") -> DataFrame:
    """Add ``report_col`` to each row of ``docs``: n_words, n_hit, n_items, items, spans, contaminated.

    A row is contaminated if it has hit words and they are at least one in ``one_in`` of its words. Null texts have no
    words, null item ids are named ``null``. Repeated rows have equal reports; a column named as
    ``report_col`` is replaced, all others are kept, whatever their names. With an empty benchmark nothing is hit.
    """
    windows = benchmark_windows(benchmark, n=n, id_col=item_col, text_col=item_text_col)
    hits = stored(window_hits(docs, windows, id_col=id_col, text_col=text_col), "verified-hits")
    k, f, size = (unused(docs, c) for c in ("_key", "_found", "_words"))
    hits = hits.select(F.col("key").alias(k), F.struct(covered(F.col("spans")).alias("n_hit"), "items", "spans").alias(f))
    n_words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long")
    # counted before the join, so that a caller who needs no text moves none
    joined = docs.withColumn(k, _row_key(id_col, text_col)).withColumn(size, n_words).join(small(hits), k, "left")
    report = F.struct(
        F.col(size).alias("n_words"),
        F.coalesce(F.col(f"{f}.n_hit"), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size(f"{f}.items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce(F.col(f"{f}.items"), F.array().cast("array<string>")).alias("items"),
        F.col(f"{f}.spans").alias("spans"),
    )
    out = joined.withColumn(report_col, report)
    found = F.col(report_col)
    bad = (found["n_hit"] > 0) & (one_in * found["n_hit"] >= found["n_words"])
    return out.withColumn(report_col, found.withField("contaminated", bad)).drop(k, f, size)


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the words in ``spans`` and the signs that follow each; null spans leave it whole."""
    # a piece is a word with what follows it; what stands before the first word is a piece of its own
    pieces = F.regexp_extract_all(text, F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*|^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))

    def cut(p: Column) -> Column:
        lead = F.get(p, 0).rlike(r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]").cast("int")
        return F.array_join(F.filter(p, lambda x, i: ~F.exists(spans, lambda s: (i + 1 - lead >= s["pos"]) & (i + 1 - lead < s["pos"] + s["len"]))), "")

    return F.when(spans.isNull() | text.isNull(), text).otherwise(let(pieces, cut))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", **params) -> DataFrame:
    """``docs`` without its contaminated rows (``remove="documents"``) or with the hit words of these cut out (``"spans"``).

    Null texts have no words and stay; repeated rows are judged alike; an empty table stays empty, and with an empty
    benchmark all rows stay. All columns are kept, whatever their names.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    report = unused(docs, "_report")
    judged = contamination(docs, benchmark, report_col=report, **params)
    found = F.col(report)
    if remove == "documents":
        return judged.where(~found["contaminated"]).drop(report)
    text_col = params.get("text_col", "text")
    cleaned = F.when(found["contaminated"], without_spans(F.col(text_col), found["spans"])).otherwise(F.col(text_col))
    return judged.withColumn(text_col, cleaned).select(*quoted(docs))
