"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Shingles of words are hashed once. The low bits of a hash name one of ``BINS`` bins and the least of the other bits in
each bin is kept. An empty bin takes the value of a bin that has one: the first in a sequence of bins that a hash of
the empty bin's number gives (optimal densification), so equal sets fill alike. Of each value the low ``BITS`` bits are
stored, as hex digits. Two values that differ agree in these bits by chance once in 2 ** BITS; the likeness is
corrected for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.llm.common import let, small, stored, words

BINS = 256
BITS = 8
SHINGLE = 5
#: Bins that an empty bin tries by position; after these it takes the filled bin of least hash with its number.
PROBES = 16

_BIN_SHIFT = 55  # a hash is made non-negative; its high 8 of 63 bits are the bin


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """Non-negative hashes of the runs of ``n`` words; of fewer words, the whole sequence is one; of none, nothing."""
    return let(
        words(text),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))), lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(w, i, F.lit(n))), 1))
        ),
    )


def _filled_bins(hashes: Column) -> Column:
    """Array of BINS values: the least of the hashes in each bin, null where there is none."""
    nulls = lambda n: F.array_repeat(F.lit(None).cast("bigint"), n)
    bin_of = lambda h: F.shiftright(h, _BIN_SHIFT).cast("int")

    def spread(least: Column) -> Column:
        gaps = F.transform(least, lambda h, i: F.concat(nulls(bin_of(h) - F.when(i > 0, bin_of(F.get(least, i - 1))).otherwise(F.lit(-1)) - 1), F.array(h)))
        return F.concat(F.flatten(gaps), nulls(BINS - 1 - bin_of(F.element_at(least, -1))))

    # in sorted order, the first hash of each bin is its least
    firsts = let(F.sort_array(hashes), lambda s: F.filter(s, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(s, i - 1)))))
    return let(firsts, spread)


def _mixed(x: int) -> int:
    """A hash of a small number, for the fixed table of probes (the finaliser of a 64-bit mixer)."""
    x = (x * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
    return x ^ (x >> 31)


def _densified(bins: Column) -> Column:
    """The array with its null entries filled; none may be null afterwards, so one entry must be there before."""
    tables = [F.array(*(F.lit(_mixed(j * PROBES + t) % BINS) for j in range(BINS))) for t in range(PROBES)]
    rest = lambda j: F.array_min(F.transform(F.filter(F.transform(bins, lambda v, i: F.struct(F.xxhash64(j, i).alias("h"), v.alias("v"))), lambda x: x["v"].isNotNull()), lambda x: F.struct(x["h"], x["v"])))["v"]
    return F.transform(bins, lambda v, j: F.coalesce(v, *(F.get(bins, F.get(t, j)) for t in tables), rest(j)))


def fingerprint(text: Column, n: int = SHINGLE) -> Column:
    """Hex digits of the low bits of all bins; an empty string for a text without words, null counts as empty."""
    digits = BITS // 4
    low = lambda v: F.lpad(F.lower(F.hex(v.bitwiseAND(F.lit((1 << BITS) - 1)))), digits, "0")
    return let(
        shingle_hashes(text, n),
        lambda h: F.when(F.size(h) == 0, F.lit("")).otherwise(let(_filled_bins(h), lambda b: F.array_join(F.transform(_densified(b), low), ""))),
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of shingles that two texts have in common, from their fingerprints.

    Two texts without words are alike (1), one with and one without are not (0); a null stays null.
    """
    digits = BITS // 4
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.substring(a, i * digits + 1, F.lit(digits)) == F.substring(b, i * digits + 1, F.lit(digits))))
    chance = 1.0 / (1 << BITS)
    estimate = F.greatest((same / F.lit(float(BINS)) - F.lit(chance)) / F.lit(1 - chance), F.lit(0.0))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(estimate)


def id_buckets(docs: DataFrame, id_col: str, per_bucket: int, most: int = 1 << 16) -> tuple[Column, DataFrame]:
    """Number of the bucket of a row, in descending order of the id, nulls last; and ids (_hot) with their number of rows.

    The cuts are quantiles of the ids. They stand in the plan as two levels of at most 256 each. An id that has more
    rows than a bucket should, and the null id, have buckets of their own, which the caller can divide.
    """
    stats = docs.agg(F.count("*").alias("n"), F.count(id_col).alias("known")).first()
    n_buckets = max(1, min(most, stats.n // per_bucket))
    each = max(per_bucket, stats.n // n_buckets)
    hot = stored(docs.groupBy(F.col(id_col).cast("bigint").alias("_hot")).agg(F.count("*").alias("_rows")).where(F.col("_rows") > each), "hot-ids")
    cuts: set[int] = set()
    if stats.known and n_buckets > 1:
        at = F.array(*(F.lit(i / n_buckets) for i in range(1, n_buckets)))
        cuts.update(docs.agg(F.percentile_approx(F.col(id_col).cast("bigint"), at, F.lit(min(100 * n_buckets, 10_000_000))).alias("q")).first().q)
    for r in hot.where("_hot is not null").collect():  # fewer than the buckets, as each has more rows than one
        cuts.update({r._hot, r._hot - 1} if r._hot > -(2**63) else {r._hot})
    cuts = sorted(cuts, reverse=True)
    longs = lambda xs: F.array(*(F.lit(x).cast("bigint") for x in xs)) if xs else F.array().cast("array<bigint>")
    groups = [cuts[i : i + 256] for i in range(0, len(cuts), 256)] or [[]]
    not_below = lambda xs: F.size(F.filter(xs, lambda b: b >= F.col(id_col)))
    inner = let(not_below(longs([g[-1] for g in groups[:-1]])), lambda k: k * 256 + not_below(F.get(F.array(*map(longs, groups)), k)))
    parts = hot.select("_hot", F.ceil(F.col("_rows") / each).alias("_parts"))
    return F.when(F.col(id_col).isNull(), F.lit(len(cuts) + 1)).otherwise(inner), parts


def with_next(docs: DataFrame, *, id_col: str, text_col: str, per_bucket: int = 1024) -> DataFrame:
    """Add ``next_text`` and ``next_fingerprint``, of the next row in descending order of ``id_col``.

    ``docs`` has ``fingerprint``. After the last row comes the first; null ids come last and rows of equal ids are
    ordered by a hash of their text. Rows are ordered inside buckets of ids, and of hashes where rows share an id; the
    last row of a bucket gets the first row of the next one. The text is shuffled once.
    """
    bucket, hot = id_buckets(docs, id_col, per_bucket)
    rows = docs.withColumn("_bucket", bucket).withColumn("_h", F.xxhash64(text_col))
    rows = rows.join(small(hot), F.col(id_col).cast("bigint").eqNullSafe(F.col("_hot")), "left")
    share = (F.col("_h").cast("double") + float(1 << 63)) / float(1 << 64)
    rows = rows.withColumn("_part", F.least(F.floor(share * F.coalesce("_parts", F.lit(1))), F.coalesce("_parts", F.lit(1)) - 1).cast("int")).drop("_hot", "_parts")
    place = F.struct(F.col(id_col).isNull(), F.bitwise_not(F.coalesce(F.col(id_col).cast("bigint"), F.lit(0))), F.col("_h"), F.col(text_col))
    heads = rows.groupBy("_bucket", "_part").agg(F.min_by(F.struct(F.col(text_col).alias("_text")), place).alias("_head"))
    heads = heads.select("_bucket", "_part", F.struct("_head._text", fingerprint(F.col("_head._text")).alias("_print")).alias("_head"))
    line = Window.orderBy("_bucket", "_part")  # over two numbers a bucket
    after = F.coalesce(F.lead(F.struct("_bucket", "_part")).over(line), F.first(F.struct("_bucket", "_part")).over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    order = stored(rows.select("_bucket", "_part").distinct(), "buckets").withColumn("_after", after)
    heads = order.join(heads.select(F.struct("_bucket", "_part").alias("_after"), "_head"), "_after").select("_bucket", "_part", "_head")
    inside = Window.partitionBy("_bucket", "_part").orderBy(F.col(id_col).desc_nulls_last(), "_h", text_col)
    rows = rows.withColumn("_next", F.lead(F.struct(F.col(text_col).alias("_text"), F.col("fingerprint").alias("_print"))).over(inside))
    rows = rows.join(heads, ["_bucket", "_part"]).withColumn("_next", F.coalesce("_next", "_head"))
    return rows.select(*docs.columns, F.col("_next._text").alias("next_text"), F.col("_next._print").alias("next_fingerprint"))


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint each text and an edited copy, whose last third is replaced by the start of the next text.

    Returns the id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next. Null texts
    count as empty; repeated rows follow one another. A table of one row has itself as the next; an empty one gives no
    rows. Columns other than the two are ignored.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(texts.withColumn("fingerprint", fingerprint(F.col("text"))), id_col="doc_id", text_col="text")
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    rows = rows.select("doc_id", n.cast("bigint").alias("n_chars"), F.concat(F.substring("text", 1, n - cut), F.substring("next_text", 1, cut)).alias("_edited"), "fingerprint", "next_fingerprint")
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("_edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
