"""Inverted full-text index: build, check, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.functions.text import fold, index_tokens, stem
from civicframe.store import stored

#: Words that are no search terms, and the months. Fixed values.
STOP_WORDS = (
    "aan als bij dan dat de den der des deze die dit door een en er haar heeft hem het hij hun iets ik in is je kan maar met mij na naar "
    "niet nog nu of om onder ons ook op over te tegen toch tot uit van voor wat we wel werd wie wij wordt worden zal ze zich zij zijn zo zou zonder "
    "januari februari maart april mei juni juli augustus september oktober november december"
).split()
MAX_ITEMS = 120


def word_candidates(words: DataFrame, *, least: int = 2) -> DataFrame:
    """Rows (word, stem, n) of the words (rows id, word) whose stem stands in ``least`` items or more."""
    stems = words.select("id", "word", stem(F.col("word")).alias("stem"))
    often = stems.groupBy("stem").agg(F.count_distinct("id").alias("n")).where(F.col("n") >= least)
    return stems.select("word", "stem").distinct().join(often, "stem").select("word", "stem", "n")


def readable_examples(index: DataFrame, *, n: int = 12, most: int = 4, length: int = 6, pool: int = 200, seed: str = "") -> DataFrame:
    """``n`` tokens of letters with ``most`` postings at most, from ``pool`` sampled ones by a hash: rows (token, id) with their first item."""
    some = index.select("token", "items").orderBy(F.sha1(F.concat(F.lit(seed), "token").cast("binary")), "token").limit(pool)
    fit = some.where((F.size("items") <= most) & F.col("token").rlike(rf"^\p{{L}}{{{length},}}$"))
    return fit.orderBy("token").limit(n).select("token", F.get("items", F.lit(0)).alias("id"))


def stop_array(words: list[str] | None = None) -> Column:
    """Stop words as a constant array."""
    return F.array(*map(F.lit, STOP_WORDS if words is None else words))


def hidden_tokens(full: Column, visible: Column, *, stop: list[str] | None = None) -> Column:
    """The terms of the full text that the visible text does not have, each once."""
    return F.array_except(index_tokens(full, stop_array(stop)), index_tokens(visible, stop_array(stop)))


def item_tokens(items: DataFrame, id_col: str, full: Column, visible: Column, *, stop: list[str] | None = None) -> DataFrame:
    """Rows (id, token): the terms of the full text that the visible text does not have. No shuffle."""
    return items.select(F.col(id_col).alias("id"), F.explode(hidden_tokens(full, visible, stop=stop)).alias("token"))


def inverted_index(tokens: DataFrame, *, max_items: int = MAX_ITEMS) -> DataFrame:
    """Rows (token, df, items): sorted posting lists of the tokens in at most ``max_items`` items.

    One shuffle by token: of each token the first ``max_items`` items and one more are kept, in the tasks that read and again after
    the shuffle, so a common token moves a few rows a task; one that fills the room is too common. ``tokens`` has each (id, token) once.
    """
    first = Window.partitionBy("token").orderBy("id")
    few = tokens.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= max_items + 1)
    lists = few.groupBy("token").agg(F.count("*").alias("df"), F.sort_array(F.collect_list("id")).alias("items"))
    return lists.where(F.col("df") <= max_items)


def document_frequency(tokens: DataFrame) -> DataFrame:
    """Items of each token. ``tokens`` has each (id, token) once."""
    return tokens.groupBy("token").agg(F.count("*").alias("df"))


def boundary_tokens(tokens: DataFrame, *, max_items: int = MAX_ITEMS, stop: list[str] | None = None) -> DataFrame:
    """Words that are not indexed but mark where a compound may be cut: too common ones and stop words."""
    words = tokens.sparkSession.createDataFrame([(w,) for w in (STOP_WORDS if stop is None else stop)], "token string")
    return document_frequency(tokens).where(F.col("df") > max_items).select("token").unionByName(words).distinct()


def dictionary(tokens: DataFrame) -> DataFrame:
    """Number of each item that has a token, in the order of the ids, from 0."""
    # each task numbers its range of ids; what comes before it is summed up from one row a range
    # the ids are stored first, as their ranges are sampled before they are dealt out
    ids = stored(tokens.select("id").distinct(), "ids").repartitionByRange("id").withColumn("_cell", F.spark_partition_id())
    ids = stored(ids, "dictionary")
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = ids.groupBy("_cell").agg(F.count("*").alias("n")).select("_cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_cell").orderBy("id"))
    return ids.withColumn("number", place).join(starts, "_cell").select("id", (F.col("number") + F.col("_start") - 1).alias("number"))


def index_errors(index: DataFrame, items: DataFrame, id_col: str, full: Column, visible: Column, *, stop: list[str] | None = None) -> DataFrame:
    """Postings that are not true: the token must be in the full text of the item and not in the visible one."""
    posted = index.select("token", F.explode("items").alias("id"))
    texts = items.select(F.col(id_col).alias("id"), index_tokens(full, stop_array(stop)).alias("_full"), index_tokens(visible, stop_array(stop)).alias("_visible"))
    return posted.join(texts, "id", "left").where(F.coalesce(~F.array_contains("_full", F.col("token")) | F.array_contains("_visible", F.col("token")), F.lit(True))).select("token", "id")


def search(items: DataFrame, id_col: str, terms: list[str], full: Column, visible: Column) -> DataFrame:
    """Items that hold all terms as substrings, with whether the visible text alone does (else the full one)."""
    plain = [fold(F.lit(t)) for t in terms]
    hay, front = fold(F.concat_ws("\n", visible, full)), fold(F.coalesce(visible, F.lit("")))
    all_in = lambda text: F.forall(F.array(*plain), lambda t: F.contains(text, t))
    found = items.select(F.col(id_col).alias("id"), hay.alias("_hay"), front.alias("_front")).where(all_in(F.col("_hay")))
    return found.select("id", all_in(F.col("_front")).alias("hit_visible"))


def _wanted(groups: DataFrame, term: str) -> DataFrame:
    """Rows (token, rank): the term, and the other words of its groups."""
    mine = groups.where(F.col("word") == term).select("group")
    also = groups.join(mine, "group", "left_semi").where(F.col("word") != term).select(F.col("word").alias("token"), F.lit(1).alias("rank"))
    return also.distinct().unionByName(groups.sparkSession.createDataFrame([(term, 0)], "token string, rank int"))


def synonym_items(tokens: DataFrame, groups: DataFrame, term: str) -> DataFrame:
    """Items (id, rank) of item tokens (id, token) with a term, rank 0, or a word of its groups (rows word, group), rank 1.

    There is no posting list, so a word may be as common as it is; the few words go to the tokens, which are not shuffled.
    """
    return tokens.join(F.broadcast(_wanted(groups, term)), "token").groupBy("id").agg(F.min("rank").alias("rank"))


def compounds(vocabulary: DataFrame, term: str, false_compounds: list[str] = ()) -> DataFrame:
    """Words that hold ``term``: at their start, or after a part that is a word itself; false compounds only at the start."""
    v = vocabulary.select("token").distinct()
    held = v.where(F.contains(F.col("token"), F.lit(term))).withColumn("head", F.substring_index("token", term, 1))
    heads = v.select(F.col("token").alias("head"), F.lit(True).alias("known"))
    good = held.join(heads, "head", "left")
    return good.where((F.col("head") == "") | (F.coalesce("known", F.lit(False)) & ~F.col("token").isin(list(false_compounds) or [""]))).select("token")
