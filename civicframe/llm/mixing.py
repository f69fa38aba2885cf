"""Mixing sources to target weights by Pareto order sampling.

Each source gets a share of all words by its weight, at most ``cap`` times its own; what is over goes to the others by
weight. The expected copies of a source's words are its target over its size. The whole part is copied for certain. For
the fraction one more copy of some documents is drawn, with unequal inclusion probabilities p: the odds of p grow with a
document's size to the power ``LEAN``, by classes of size that are a quarter of a power of two wide, and are scaled so that
the expected words are what the source still wants. Documents are ranked by the odds of a random number over the odds of p.
The sample's size is fixed in words, as targets are: those of least rank are taken until one would pass it. If the rest
is more than ``NEAR`` of the target, as in sources of few documents, the ranking goes on without what is longer than the
rest, again until one would pass it, and so on; at last the next document that passes the rest by less than is missing is
taken, if there is one. The random numbers are hashes of the document's key, its source and a
seed, so reruns agree.

The cut in each source's ranking comes from two histograms and a sort of what falls in one cell of the second, so no
source is sorted in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.llm.common import WORD, small, stored

#: Cells of each of the two histograms of ranks.
CELLS = 1024
#: How inclusion odds grow with the size of a document: 0 for not at all, 1 in proportion.
LEAN = 0.5
#: Share of a source's target that may stay open.
NEAR = 0.002


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_key() -> Column:
    """A hash of a row's id and text; rows that share an id, or have none, differ by their texts."""
    return F.xxhash64("doc_id", "text")


def targets(sizes: DataFrame, weights: Column, *, cap: float) -> DataFrame:
    """Add ``target`` to a table of one row for each source with ``source_size``.

    With a share a unit of weight, a source gets the lesser of weight times share and cap times its size. Sources run
    into the cap in the order of cap * size / weight; the window over them, which has a row a source, finds the share
    at which all sizes are given out. Sources of no words get 0.
    """
    order = Window.orderBy(F.col("_full"), F.col("source").asc_nulls_first())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    t = sizes.withColumn("_weight", weights.cast("double")).withColumn("_full", F.lit(cap) * F.col("source_size") / F.col("_weight"))
    t = t.withColumn("_total", F.sum("source_size").over(every)).withColumn("_weights", F.sum("_weight").over(every))
    t = t.withColumn("_left", F.col("_total") - F.lit(cap) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    t = t.withColumn("_share", F.col("_left") / (F.col("_weights") - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))))
    # the first source in this order whose share does not reach its cap has the share of all after it
    open_share = F.min(F.when(F.col("_share") <= F.col("_full"), F.struct("_full", F.col("source").isNotNull(), "source", "_share"))).over(every)["_share"]
    return t.withColumn("target", F.least(F.lit(cap) * F.col("source_size"), F.col("_weight") * F.coalesce(open_share, F.lit(float("inf"))))).drop("_weight", "_full", "_total", "_weights", "_left", "_share")


def uniform(*keys: Column, seed: str) -> Column:
    """A number in (0, 1) that the keys and the seed decide: 48 bits of an MD5."""
    text = F.concat_ws("|", F.lit(seed), *(F.coalesce(k.cast("string"), F.lit("null")) for k in keys))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def _cut(rows: DataFrame, cell: str, wanted: str) -> DataFrame:
    """Per source, the cell in which its wanted words are reached and the words of the cells before it."""
    cells = rows.groupBy("source", cell, wanted).agg(F.sum("size").alias("_words"))
    upto = F.sum("_words").over(Window.partitionBy("source").orderBy(cell))  # CELLS rows a source
    found = cells.withColumn("_upto", upto).where(F.col("_upto") >= F.col(wanted)).groupBy("source").agg(F.min(F.struct(cell, (F.col("_upto") - F.col("_words")).alias("_before"))).alias("_c"))
    return found.select(F.col("source").alias("_s"), F.col(f"_c.{cell}").alias(f"_cut{cell}"), F.col("_c._before").alias("_before"))


def size_class(size: Column) -> Column:
    """Number of a document's class of size; null for no words."""
    return F.floor(4 * F.log2(F.when(size > 0, size))).cast("int")


def inclusion(words: np.ndarray, classes: np.ndarray, wanted: float, lean: float) -> np.ndarray:
    """Inclusion probability of each class of size, which has so many ``words``, for ``wanted`` expected words."""
    lift = (classes - classes.mean()) * (lean / 4) if len(classes) else classes
    low, high = -200.0, 200.0  # powers of two
    for _ in range(100):
        middle = (low + high) / 2
        p = 1 / (1 + np.exp2(-np.clip(middle + lift, -300, 300)))
        low, high = (middle, high) if (p * words).sum() < wanted else (low, middle)
    return p


def _probabilities(rows: DataFrame, lean: float) -> DataFrame:
    """Per source and class of size: _s, _k, _p. At most some 250 classes a source come together."""

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        p = inclusion(part["_words"].to_numpy(float), part["_class"].to_numpy(float), float(part["_wanted"].iloc[0]), lean)
        return pd.DataFrame({"_s": part["source"], "_k": part["_class"], "_p": p})

    held = rows.where("size > 0 and _wanted > 0").groupBy("source", "_class", "_wanted").agg(F.sum("size").alias("_words"))
    return stored(held.groupBy("source").applyInPandas(solve, "_s string, _k int, _p double"), "mix-odds")


def _on(other: str) -> Column:
    """Equal sources, null with null."""
    return F.col("source").eqNullSafe(F.col(other))


def _take(ranked: DataFrame, wanted: str) -> DataFrame:
    """Per source, where the ranking stops: the last document (``_top``) with which the ``wanted`` words aren't passed.

    Columns _s, _cut_cell, _cut_fine, _top, ``_got``: the words taken. A source that has no more words than it wants has
    no cut. ``ranked`` has source, key, size, _rank, _cell, _fine and ``wanted``.
    """
    coarse = stored(_cut(ranked, "_cell", wanted), "mix-coarse")
    edge = ranked.join(small(coarse), _on("_s") & (F.col("_cell") == F.col("_cut_cell"))).withColumn("_rest", F.col(wanted) - F.col("_before")).drop("_s", "_before")
    fine = stored(_cut(edge, "_fine", "_rest"), "mix-fine")
    last = edge.join(small(fine), _on("_s") & (F.col("_fine") == F.col("_cut_fine"))).groupBy("source", "_rank", "key", (F.col("_rest") - F.col("_before")).alias("_need")).agg(F.sum("size").alias("size"))
    upto = F.sum("size").over(Window.partitionBy("source").orderBy("_rank", "key").rowsBetween(Window.unboundedPreceding, 0))
    fits = last.withColumn("_upto", upto).where(F.col("_upto") <= F.col("_need")).groupBy("source").agg(F.max(F.struct("_rank", "key")).alias("_top"), F.max("_upto").alias("_edge"))
    every = ranked.groupBy("source").agg(F.sum("size").alias("_all")).select(F.col("source").alias("_s0"), "_all")
    same = lambda other: F.col("_s0").eqNullSafe(F.col(other))
    bounds = every.join(coarse.withColumnRenamed("_before", "_far"), same("_s"), "left").join(fine.select(F.col("_s").alias("_s2"), "_cut_fine", F.col("_before").alias("_near")), same("_s2"), "left").join(fits.select(F.col("source").alias("_s3"), "_top", "_edge"), same("_s3"), "left")
    got = F.when(F.col("_cut_cell").isNull(), F.col("_all")).otherwise(F.col("_far") + F.col("_near") + F.coalesce("_edge", F.lit(0)))
    return stored(bounds.select(F.col("_s0").alias("_s"), "_cut_cell", "_cut_fine", "_top", got.alias("_got")), "mix-bounds")


def _before_cut() -> Column:
    """Whether a ranked document stands before its source's cut."""
    here = F.coalesce(F.struct("_rank", "key") <= F.col("_top"), F.lit(False))
    return F.col("_cut_cell").isNull() | (F.col("_cell") < F.col("_cut_cell")) | ((F.col("_cell") == F.col("_cut_cell")) & ((F.col("_fine") < F.col("_cut_fine")) | ((F.col("_fine") == F.col("_cut_fine")) & here)))


def _also(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with those marked ``_in`` that ``keys`` (source, key) name."""
    named = keys.select(F.col("source").alias("_s4"), F.col("key").alias("_k4"))
    return rows.join(small(named), _on("_s4") & (F.col("key") == F.col("_k4")), "left").withColumn("_in", F.col("_in") | F.col("_k4").isNotNull()).drop("_s4", "_k4")


def pareto_copies(docs: DataFrame, source_targets: DataFrame, *, seed: str = "mix", cap: float = 3.0, lean: float = LEAN, near: float = NEAR) -> DataFrame:
    """Copies of each document of ``docs`` (key, source, size); ``source_targets`` has source, source_size, target.

    Adds source_size, target, ``p`` (the inclusion probability of one more copy than the whole part) and ``copies``.
    Ranks that tie are ordered by key. Rows with equal keys and sources are taken or left together.
    """
    t = source_targets.select(F.col("source").alias("_s"), "source_size", "target")
    rows = docs.join(small(t), _on("_s"), "left").drop("_s")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(cap))).otherwise(F.lit(0.0))
    rows = rows.withColumn("_whole", F.floor(ratio)).withColumn("_wanted", F.col("target") - F.floor(ratio) * F.col("source_size")).withColumn("_class", size_class(F.col("size")))
    rows = stored(rows, "mix-sizes")  # the texts are read once
    rows = rows.join(small(_probabilities(rows, lean)), _on("_s") & (F.col("_class") == F.col("_k")), "left").drop("_s", "_k")
    u = uniform(F.col("key"), F.col("source"), seed=seed)
    rows = rows.withColumn("_rank", F.when(F.col("_p") > 0, (u / (1 - u)) / (F.col("_p") / F.greatest(1 - F.col("_p"), F.lit(1e-15)))))
    # cells of equal width in rank / (1 + rank), which keeps the order of ranks
    place = F.col("_rank") / (1 + F.col("_rank")) * CELLS
    rows = stored(rows.withColumn("_cell", F.floor(place)).withColumn("_fine", F.floor((place - F.floor(place)) * CELLS)), "mix-ranks")
    ranked = rows.where("_rank is not null")
    bounds = _take(ranked, "_wanted")
    rows = rows.join(small(bounds), _on("_s"), "left").withColumn("_in", F.col("_rank").isNotNull() & _before_cut())
    left = F.col("_wanted") - F.col("_got")
    open_ = (left > F.lit(near) * F.col("target")) & (F.col("size") <= left)
    places = rows.where("_rank is not null and not _in").where(open_).select("source", "key", "size", "_rank", "_cell", "_fine", "target", left.alias("_wanted"))
    places = stored(places, "mix-open")
    more = []
    while places.limit(1).count():  # a rest is less than the document that would have passed it, so it soon is small
        here = places.join(small(_take(places, "_wanted")), _on("_s"))
        more.append(stored(here.where(_before_cut()).select("source", "key").distinct(), "mix-more"))
        places = stored(here.where(~_before_cut()).where(open_).select("source", "key", "size", "_rank", "_cell", "_fine", "target", left.alias("_wanted")), "mix-open")
    rows = rows.drop("_s", "_cut_cell", "_cut_fine", "_top", "_got")
    for part in more:
        rows = _also(rows, part)
    rows = stored(rows, "mix-cut")
    # what is still open gets the next document that passes it by less than is missing
    rest = rows.groupBy("source", "target", "_wanted").agg(F.sum(F.when(F.col("_in"), F.col("size")).otherwise(0)).alias("_has"))
    rest = rest.select(F.col("source").alias("_s"), (F.col("_wanted") - F.col("_has")).alias("_rest"), "target").where(F.col("_rest") > F.lit(near) * F.col("target")).drop("target")
    last = rows.where("_rank is not null and not _in").join(small(stored(rest, "mix-rest")), _on("_s")).groupBy("source", "_rest", "_rank", "key").agg(F.sum("size").alias("size")).where("size < 2 * _rest")
    last = last.groupBy("source").agg(F.min(F.struct("_rank", "key")).alias("_next")).select("source", F.col("_next.key").alias("key"))
    rows = _also(rows, stored(last, "mix-last"))
    return rows.withColumn("copies", (F.col("_whole") + F.col("_in").cast("long")).cast("long")).select(*docs.columns, "source_size", "target", F.coalesce("_p", F.lit(0.0)).alias("p"), "copies")


def mix(docs: DataFrame, *, weights=None, cap: float = 3.0, seed: str = "mix") -> DataFrame:
    """Copies of each row of ``docs`` (doc_id, source, text) in a mix as large as all of them.

    ``weights`` makes a weight column from the number of the source in code-point order, null last, from 0; without
    it the weights are 1, 2, 3 and so on in turn. Returns doc_id, key, source, size, source_size, target, p, copies and
    taken, a row for each input row. Null texts have no words and are taken as often as their source's whole part says,
    which adds nothing. A null source is a source. Rows go by a hash of id and text, so repeated rows are taken or left
    together. An empty table gives no rows. Columns other than the three are ignored.
    """
    sized = docs.select("doc_id", document_key().alias("key"), "source", word_count(F.col("text")).alias("size"))
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # over one row a source
    per_source = per_source.withColumn("_n", number)
    weight = weights(F.col("_n")) if weights else F.col("_n") % 3 + 1
    goals = stored(targets(per_source, weight, cap=cap).select("source", "source_size", "target"), "mix-targets")
    return pareto_copies(sized, goals, seed=seed, cap=cap).withColumn("taken", F.col("copies") * F.col("size"))
