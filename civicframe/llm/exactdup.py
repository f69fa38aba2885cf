"""Exact duplicates by two passes over a Bloom filter: only rows whose hash may repeat are shuffled.

The first pass counts, for each place of a blocked Bloom filter, whether two rows or more fall on it; places are counted
before they move, so equal texts cost one place a task. What repeats becomes the filter: a bitmap a block. The second
pass looks each row up in the bitmap of its block. A row that finds one of its places hit only once is alone with its
text and passes straight through; the others are grouped by the SHA-256 of their normalised text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import small, stored, unused

#: Bits of a block: those of one bitmap that Spark's bitmap functions build.
BLOCK_BITS = 1 << 15


def normal_text(text: Column) -> Column:
    """``text`` with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(normal_text(text).cast("binary"), 256))


def _block(digest: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(blocks)).cast("int")


def _places(digest: Column) -> list[Column]:
    """Two places in a block, from bits that choose no block."""
    other = F.xxhash64(digest, F.lit("place"))
    return [(F.shiftrightunsigned(other, n).bitwiseAND(F.lit(BLOCK_BITS - 1))).cast("int") for n in (0, 32)]


def repeat_filter(digests: DataFrame, bits_a_row: int = 16) -> tuple[DataFrame, int]:
    """The filter (block, bits) of places that two rows or more of ``digests`` (a column digest) hit, and its number of blocks.

    It grows with the number of rows, by ``bits_a_row``; with 16 about one row in seventy that is alone is taken for a
    repeated one, which costs a shuffle of that row and changes no result.
    """
    blocks = max(1, -(-digests.count() * bits_a_row // BLOCK_BITS))
    hit = digests.select(_block(F.col("digest"), blocks).alias("block"), F.explode(F.array_distinct(F.array(*_places(F.col("digest"))))).alias("place"))
    twice = hit.groupBy("block", "place").agg(F.count("*").alias("n")).where("n > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits")), blocks


def _has(bits: Column, place: Column) -> Column:
    """Whether the bit of ``place`` is set; false where there is no bitmap."""
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, place.bitwiseAND(F.lit(7))) == 1, F.lit(False))


def flagged(rows: DataFrame, digest: str, places: DataFrame, blocks: int, flag: str) -> DataFrame:
    """``rows`` with a column ``flag``: whether the filter says that the digest may repeat.

    The filter is broadcast up to the bound of ``small``; a larger one meets the rows by a shuffle on the block.
    """
    block, bits = unused(rows, "_block"), unused(rows, "_bits")
    side = small(places.select(F.col("block").alias(block), F.col("bits").alias(bits)))
    first, second = _places(F.col(digest))
    joined = rows.withColumn(block, _block(F.col(digest), blocks)).join(side, block, "left")
    return joined.withColumn(flag, _has(F.col(bits), first) & _has(F.col(bits), second)).drop(block, bits)


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row a row of ``docs`` (doc_id of any type with an order, text): doc_id, keep_id, group_size, kept, digest.

    Of rows with equal normalised texts the least doc_id stays; null ids come last, and of rows that repeat the least id
    one stays, so each group keeps exactly one row (with keep_id null if all its ids are). Null texts are empty and equal
    to one another; an empty table gives no rows; other columns are ignored, whatever their names. Only ids and digests are stored and shuffled,
    never texts; groups are counted before they move, and a group of any size is joined back in parts.
    """
    rows = stored(docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text_digest(F.col("text")).alias("digest")), "digests")
    places, blocks = repeat_filter(rows.select("digest"))
    marked = flagged(rows, "digest", stored(places, "repeat-filter"), blocks, "again")
    several = stored(marked.where("again").drop("again"), "repeated")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    groups = stored(several.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("group_size")), "groups")
    one = F.lit(1).cast("long")
    alone = marked.where(~F.col("again")).select("doc_id", F.col("doc_id").alias("keep_id"), one.alias("group_size"), F.lit(True).alias("kept"), "digest")
    joined = several.join(small(groups), "digest").select("doc_id", F.col("first.id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "digest")
    return alone.unionByName(joined)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal normalised texts that with the least doc_id.

    Rows that are alone with their text pass straight through in the task that reads them. Null ids come last; of rows that repeat
    the least id, one stays, chosen by all its columns. Null texts are empty; an empty table stays empty.
    """
    digest, again = unused(docs, "_digest"), unused(docs, "_again")
    with_digest = docs.withColumn(digest, text_digest(F.col("text")))
    places, blocks = repeat_filter(with_digest.select(F.col(digest).alias("digest")))
    marked = flagged(with_digest, digest, stored(places, "repeat-filter"), blocks, again)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64(F.to_json(whole)))
    first = marked.where(F.col(again)).groupBy(digest).agg(F.min_by(whole, order).alias("row")).select("row.*")
    return marked.where(~F.col(again)).select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(first)
