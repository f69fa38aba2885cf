"""Linking records: blocked titles, fuzzy titles, unique names, as-of versions."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from civicframe.functions.text import Likened, link_words, prefix_overlap
from civicframe.store import stored

#: Words of titles that say nothing about the matter; callers add the names of their place. Fixed values.
LINK_STOP = ("belang", "stedelijk", "stedelijke", "betreffende", "houdende", "beslissing", "beslissingslijst", "besluit", "besluiten", "goedkeuring", "vaststelling", "aanvullend", "toepassing", "algemeen")


def best_title(pairs: DataFrame, query: str, candidate: str, query_title: Column, candidate_title: Column, *, least: int, stop: tuple[str, ...] = LINK_STOP) -> DataFrame:
    """The candidate of each query that its title names, from pairs that already share a block.

    One equal title wins, two or more give nobody; else the largest word overlap wins if it is ``least`` or more and
    larger than the runner-up's.
    """
    stops = F.array(*map(F.lit, stop))
    scored = pairs.withColumn("_exact", (query_title == candidate_title).cast("int")).withColumn("_score", prefix_overlap(link_words(candidate_title, stops), link_words(query_title, stops)))
    every = Window.partitionBy(query)
    ranked = every.orderBy(F.col("_score").desc(), F.col(candidate).desc())
    scored = scored.withColumn("_n_exact", F.sum("_exact").over(every)).withColumn("_rn", F.row_number().over(ranked)).withColumn("_next", F.lead("_score").over(ranked))
    by_title = (F.col("_n_exact") == 1) & (F.col("_exact") == 1)
    by_words = (F.col("_n_exact") == 0) & (F.col("_rn") == 1) & (F.col("_score") >= least) & (F.col("_next").isNull() | (F.col("_score") > F.col("_next")))
    return scored.where(by_title | by_words).select(query, candidate, F.when(by_title, "titel").otherwise("woorden").alias("how"))


def best_titles(rows: DataFrame, *, id_col: str, block: str, title: str, least: int, stop: tuple[str, ...] = LINK_STOP) -> DataFrame:
    """For each row the other row of its block that its title names, by the rule of :func:`best_title`; (q, c, how).

    Titles are compared once, however many rows have them: equal titles meet in a grouping, others in a join on the
    block and the first five characters of a word. A title of several rows can't win by words, as these rows tie. Rows
    without a block or a title match nothing.
    """
    known = rows.where(F.col(block).isNotNull() & F.col(title).isNotNull()).select(F.col(block).alias("b"), F.col(title).alias("t"), F.col(id_col).alias("id"))
    titles = known.groupBy("b", "t").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))
    pair = titles.where("n = 2")
    exact = pair.select(F.col("first").alias("q"), F.col("last").alias("c")).unionByName(pair.select(F.col("last").alias("q"), F.col("first").alias("c")))
    word = titles.select("b", "t", "n", "first", F.explode(link_words(F.col("t"), F.array(*map(F.lit, stop)))).alias("w")).withColumn("p", F.substring("w", 1, 5))
    mine = word.where("n = 1").select("b", "p", F.col("first").alias("q"), F.col("t").alias("qt"), F.col("w").alias("v"))
    hit = mine.join(word, ["b", "p"]).where((F.col("qt") != F.col("t")) & (F.col("v").startswith(F.col("w")) | F.col("w").startswith(F.col("v"))))
    scored = hit.groupBy("q", "t").agg(F.count_distinct("w").alias("score"), F.first("n").alias("n"), F.first("first").alias("c"))
    # the best score of each query, how often it is reached, and by whom
    best = scored.groupBy("q").agg(F.max(F.struct("score", "n", "c")).alias("top"), F.max("score").alias("most"))
    ties = scored.join(best, "q").where(F.col("score") == F.col("most")).groupBy("q").agg(F.sum("n").alias("m"), F.first("top").alias("top"))
    by_words = ties.where((F.col("m") == 1) & (F.col("top.score") >= least)).select("q", F.col("top.c").alias("c"))
    return exact.withColumn("how", F.lit("titel")).unionByName(by_words.withColumn("how", F.lit("woorden")))


def link_extracts(extracts: DataFrame, items: DataFrame, *, places: tuple[str, ...] = ()) -> DataFrame:
    """Extracts (extract_id, organ, session, number, letter, title) to items (item_id, the same columns).

    An extract with a number links inside its number alone, with one shared word or more; if no such item exists it
    stays unlinked. An extract without a number links by title inside the session, with two shared words or more.
    ``places`` are names of the place, which say nothing about the matter either.
    """
    i = items.select("item_id", "organ", "session", "number", "letter", F.col("title").alias("item_title"))
    numbered = extracts.where("number is not null").withColumn("letter", F.coalesce("letter", F.lit("")))
    by_number = numbered.join(i.withColumn("letter", F.coalesce("letter", F.lit(""))), ["organ", "session", "number", "letter"])
    by_title = extracts.where("number is null").drop("number", "letter").join(i.drop("number", "letter"), ["organ", "session"])
    titles = ("extract_id", "item_id", F.col("title"), F.col("item_title"))
    stop = LINK_STOP + places
    return best_title(by_number, *titles, least=1, stop=stop).unionByName(best_title(by_title, *titles, least=2, stop=stop))


def link_attachments(attachments: DataFrame, linked: DataFrame) -> DataFrame:
    """Attachments (extract_id, organ, session, publication) follow the extract of the same publication."""
    return attachments.join(linked.select("organ", "session", "publication", "item_id").distinct(), ["organ", "session", "publication"])


#: Candidates and hits of a block that one cell holds, and titles for each task. Fixed values.
CANDIDATE_CELL, HIT_CELL, TASK_TITLES = 500, 2000, 2000


def _most_like(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most similar candidate of each hit inside its cell, the first of these; cells come one by one, candidates before hits.

    Rows are block, the cell's two numbers, hit (null: a candidate), candidate, title, least ratio, and whether one comparison will do.
    """
    types: list[pa.DataType] = []

    def rows() -> Iterator[tuple]:
        for batch in batches:
            types[:] = [batch.schema.field(k).type for k in (0, 3, 4)] + [pa.float64()]
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def found() -> Iterator[tuple]:
        for (name, *_), cell in groupby(rows(), lambda r: r[:3]):
            known, likened = [], None
            for *_, hit, candidate, title, least, only_first in cell:
                if hit is None:
                    known.append((candidate, title))
                    continue
                likened = likened or Likened([t for _, t in known])
                if top := likened.best(title, least, only_first):
                    yield name, hit, known[top[0]][0], top[1]

    matches = found()
    while some := list(islice(matches, 1000)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), types, strict=True)], names=["b", "h", "c", "r"])


def fuzzy_match(hits: DataFrame, candidates: DataFrame, *, block: str, hit_title: str, candidate_title: str, hit_id: str, candidate_id: str, least: float = 0.72) -> DataFrame:
    """The most similar candidate of each hit inside a block, if its ratio is ``least`` or more; ties by id.

    Hits and candidates of one title are compared once. A block is worked off in cells, which bounds what a task holds; inside a
    cell only candidates are compared whose upper bounds reach the best ratio so far. In a block of several cells that ratio is at
    first the best of the candidates with the largest bound in each.
    """
    titles = candidates.where(F.col(block).isNotNull() & F.col(candidate_title).isNotNull()).groupBy(block, candidate_title).agg(F.min(candidate_id).alias(candidate_id))
    titles = stored(titles.withColumn("_c", F.xxhash64(block, candidate_title)), "titles")
    asked = hits.where(F.col(block).isNotNull() & F.col(hit_title).isNotNull()).select(block, hit_title).distinct()
    asked = stored(asked.withColumn("_h", F.xxhash64(block, hit_title)), "hits")
    count = lambda df, size, name: df.groupBy(block).agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    cells = count(titles, CANDIDATE_CELL, "_cs").join(count(asked, HIT_CELL, "_hs"), block)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda i, n: F.pmod(i, n).cast("int")
    theirs = titles.join(cells, block).select(block, every("_hs").alias("_hc"), own("_c", "_cs").alias("_cc"), F.lit(None).cast("long").alias("_h"), candidate_id, F.col(candidate_title).alias("_t"), F.lit(None).cast("double").alias("_from"), F.lit(None).cast("boolean").alias("_first"), "_cs")
    mine = asked.join(cells, block).select(block, own("_h", "_hs").alias("_hc"), every("_cs").alias("_cc"), "_h", F.lit(None).cast(titles.schema[candidate_id].dataType).alias(candidate_id), F.col(hit_title).alias("_t"), F.lit(least).alias("_from"), (F.col("_cs") > 1).alias("_first"), "_cs")
    out = StructType([titles.schema[block], StructField("_h", LongType()), titles.schema[candidate_id], StructField("ratio", DoubleType())])

    def compared(mine: DataFrame, theirs: DataFrame, tasks: int) -> DataFrame:
        # the number keeps adaptive execution from merging the tasks: their rows are few, their comparisons many
        rows = theirs.unionByName(mine).drop("_cs").repartition(tasks, block, "_hc", "_cc")
        return rows.sortWithinPartitions(block, "_hc", "_cc", F.col("_h").isNotNull(), candidate_id).mapInArrow(_most_like, out)

    tasks = (titles.count() + asked.count()) // TASK_TITLES + 1
    ratios = first = stored(compared(mine, theirs, tasks), "first")
    if split := cells.where("_cs > 1").agg(F.sum(F.col("_cs") * F.col("_hs"))).first()[0]:
        reached = first.groupBy(block, "_h").agg(F.max("ratio").alias("_best"))
        again = mine.where("_cs > 1").join(reached, [block, "_h"], "left").withColumn("_from", F.coalesce("_best", "_from")).withColumn("_first", F.lit(False)).drop("_best")
        ratios = first.unionByName(compared(again, theirs.where("_cs > 1"), split))
    top = ratios.groupBy(block, "_h").agg(F.min(F.struct((-F.col("ratio")).alias("r"), F.col(candidate_id).alias("c"))).alias("_top"))
    found = hits.withColumn("_h", F.xxhash64(block, hit_title)).join(top, [block, "_h"]).select(hit_id, F.col("_top.c").alias(candidate_id), (-F.col("_top.r")).alias("ratio"))
    best = Window.partitionBy(hit_id).orderBy(F.col("ratio").desc(), candidate_id)
    return found.withColumn("_rn", F.row_number().over(best)).where("_rn = 1").select(hit_id, candidate_id, F.round("ratio", 3).alias("ratio"))


def dossier_report(hits: DataFrame, matches: DataFrame, items: DataFrame, *, least: float = 0.72) -> DataFrame:
    """One row a keyword dossier: keyword, n_linked, n_unlinked and the two lists.

    ``hits`` (keyword, hit_id, title), ``matches`` (hit_id, item_id, score) with the best score of each hit, ``items`` (item_id, organ, day, title).
    Scores are rounded to three digits after the comparison. A dossier lists what its keyword found, some hundred rows.
    """
    rows = hits.join(matches, "hit_id", "left").join(items.select("item_id", "organ", "day", F.col("title").alias("item_title")), "item_id", "left")
    linked = F.coalesce(F.col("score") >= least, F.lit(False)) & F.col("item_title").isNotNull()
    shown = F.round(F.coalesce("score", F.lit(0.0)), 3)
    item = F.struct("item_id", "organ", "day", F.col("item_title").alias("title"), shown.alias("score"))
    other = F.struct("hit_id", "title", shown.alias("best_score"))
    gather = lambda test, s: F.sort_array(F.collect_list(F.when(test, s)))
    return rows.groupBy("keyword").agg(F.count_if(linked).alias("n_linked"), F.count_if(~linked).alias("n_unlinked"), gather(linked, item).alias("items"), gather(~linked, other).alias("unlinked"))


def unique_match(queries: DataFrame, roster: DataFrame, keys: list[str]) -> DataFrame:
    """Queries with the one roster row of their keys; none where two or more share them."""
    single = roster.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where("_n = 1").drop("_n")
    return queries.join(single, keys, "left")


def as_of(facts: DataFrame, versions: DataFrame, *, fact_id: str, fact_day: str, version: str, valid_from: str, keys: list[str], days: int = 32) -> DataFrame:
    """Each fact with the latest version that was valid on its day; if none was yet, the earliest, flagged.

    Facts and versions are sorted together inside cells of a key and ``days`` days, so a key with very many of both is
    spread over its cells; what earlier cells hand on comes from a table of one row for each cell. Of versions of one day
    the least counts. A key without versions, or a null key, is flagged with a null version. A null day takes the
    earliest version. ``fact_id`` is kept for callers; repeated facts stay repeated.
    """
    cell = lambda day: F.coalesce(F.floor(F.unix_date(day.cast("date")) / days), F.lit(-(1 << 40)))
    f = facts.withColumn("_day", F.col(fact_day)).withColumn("_cell", cell(F.col(fact_day))).withColumn("_is_fact", F.lit(True))
    v = versions.select(*keys, F.col(valid_from).alias("_day"), F.col(version).alias("_v")).where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    v = v.groupBy(*keys, "_day").agg(F.min("_v").alias("_v")).withColumn("_cell", cell(F.col("_day"))).withColumn("_is_fact", F.lit(False))
    both = f.withColumn("_v", F.lit(None).cast(v.schema["_v"].dataType)).unionByName(v, allowMissingColumns=True)
    # a version goes as a struct, so that its own null is no gap
    both = both.withColumn("_held", F.when(~F.col("_is_fact") & F.col("_day").isNotNull(), F.struct(F.col("_v").alias("v"))))
    here = Window.partitionBy(*keys, "_cell").orderBy(F.col("_day"), F.col("_is_fact")).rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("_last", F.last("_held", ignorenulls=True).over(here)).where("_is_fact")
    versioned = F.when(~F.col("_is_fact"), F.struct(F.col("_day").alias("f"), F.col("_v").alias("v")))
    cells = both.groupBy(*keys, "_cell").agg(F.max(F.when(F.col("_day").isNotNull(), versioned)).alias("_newest"), F.min(versioned).alias("_oldest"))
    over = Window.partitionBy(*keys)
    before = over.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_cell").alias("_c"), F.last("_newest", ignorenulls=True).over(before).alias("_carried"), F.min("_oldest").over(over).alias("_earliest"))
    on = reduce(lambda a, b: a & b, (F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys))) & (F.col("_cell") == F.col("_c"))
    joined = placed.join(cells, on, "left")
    carried = F.when(F.col("_carried").isNotNull() & F.col("_day").isNotNull(), F.struct(F.col("_carried.v").alias("v")))
    chosen = F.coalesce("_last", carried)
    value = F.when(chosen.isNotNull(), chosen["v"]).otherwise(F.col("_earliest.v"))
    return joined.select(*facts.columns, value.alias(version), chosen.isNull().alias("fallback"))


def plan_validity(plans: DataFrame, decisions: DataFrame) -> DataFrame:
    """Valid-from of each plan (plan, first_year, last_year): the first decision whose title sets it, else New Year.

    The years are read from the titles (``decisions``: title, day) once and joined; titles that set no plan have none.
    """
    pattern = r"(?i)^\s*(?:vaststelling|goedkeuring)\s+(?:van\s+het\s+)?meerjarenplan\s+(20\d{2})\s*\W\s*(20\d{2})\b"
    year = lambda i: F.regexp_extract("title", pattern, i).try_cast("int")
    sets = decisions.select(year(1).alias("first_year"), year(2).alias("last_year"), "day").where("first_year is not null").groupBy("first_year", "last_year").agg(F.min("day").alias("day"))
    named = plans.join(sets, ["first_year", "last_year"], "left")
    return named.select(*plans.columns, F.coalesce("day", F.make_date("first_year", F.lit(1), F.lit(1))).alias("valid_from"))
