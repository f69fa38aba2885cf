"""Pairs of records about one matter: candidates, verdicts, groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_DF, TOP, LEAST, STREET_BONUS = 40, 6, 6.0, 2.0


def idf(tokens: DataFrame, n_items: int, *, max_df: int = MAX_DF) -> DataFrame:
    """Weight ln(n / df) of the tokens in at most ``max_df`` items."""
    counted = tokens.groupBy("token").agg(F.count("*").alias("df")).where(F.col("df") <= max_df)
    return counted.withColumn("weight", F.log(F.lit(float(n_items)) / F.col("df")))


def candidate_pairs(questions: DataFrame, others: DataFrame, weights: DataFrame, *, top: int = TOP, least: float = LEAST, bonus: Column | None = None, digits: int = 6) -> DataFrame:
    """Best partners of each question by the weight of shared tokens; both sides have (id, token), each once.

    Common tokens have no weight and leave before the join, so no token makes more than ``max_df`` pairs a question.
    """
    light = weights.select("token", "weight")
    left = questions.join(light, "token").select(F.col("id").alias("a"), "token", "weight")
    shared = left.join(others.select(F.col("id").alias("b"), "token"), "token").where(F.col("a") != F.col("b"))
    score = F.round(F.sum("weight") + (F.lit(0.0) if bonus is None else F.max(bonus)), digits)
    best = Window.partitionBy("a").orderBy(F.col("score").desc(), "b")
    return shared.groupBy("a", "b").agg(score.alias("score")).withColumn("rn", F.row_number().over(best)).where((F.col("rn") <= top) & (F.col("score") >= least))


def same_author_pairs(items: DataFrame, tokens: DataFrame, rare: DataFrame) -> DataFrame:
    """Pairs of one author (id, author) that share a rare token, smaller id first."""
    mine = tokens.join(rare.select("token"), "token", "left_semi").join(items.select("id", "author"), "id")
    other = mine.select(F.col("id").alias("b"), "author", "token")
    return mine.select(F.col("id").alias("a"), "author", "token").join(other, ["author", "token"]).where("a < b").select("a", "b", "author").distinct()


def canonical(pairs: DataFrame) -> DataFrame:
    """Distinct unordered pairs, smaller id first, none of an item with itself."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def sticky(former: DataFrame, fresh: DataFrame, items: DataFrame) -> DataFrame:
    """Fresh pairs and those former ones whose items both still exist."""
    alive = former.join(items.select(F.col("id").alias("a")), "a", "left_semi").join(items.select(F.col("id").alias("b")), "b", "left_semi")
    return canonical(fresh.select("a", "b").unionByName(alive.select("a", "b")))


def validated_extra(extra: DataFrame, items: DataFrame) -> DataFrame:
    """Hand-made pairs of two existing, different items (id, is_question) of which one is a question at least."""
    a, b = items.select(F.col("id").alias("a"), F.col("is_question").alias("qa")), items.select(F.col("id").alias("b"), F.col("is_question").alias("qb"))
    return canonical(extra.join(a, "a").join(b, "b").where("qa or qb"))


def both_orders(pairs: DataFrame) -> DataFrame:
    """Each pair in both orders: what is asked of a judge."""
    return pairs.select("a", "b", F.lit(1).alias("order")).unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(2).alias("order")))


def described(title: Column, day: Column, organ: Column, text: Column, most: int = 900) -> Column:
    """What a judge reads of an item: four labelled lines, the text squeezed and cut at ``most`` characters (its contract with the judge)."""
    cut = F.substring(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "), 1, most)
    line = lambda label, c: F.concat(F.lit(f"{label}: "), F.coalesce(c.cast("string"), F.lit("")))
    return F.concat_ws("\n", line("Titel", title), line("Datum", day), line("Orgaan", organ), line("Samenvatting", cut))


def judge_messages(pairs: DataFrame, items: DataFrame, *, model: str, prompt: str) -> DataFrame:
    """Rows (a, b, order, message, key) of :func:`both_orders` of ``pairs``; ``items`` (id, description) are :func:`described`.

    The key is a digest of model, prompt version and message, so a verdict counts as long as what was asked is the same.
    """
    side = lambda k, name: items.select(F.col("id").alias(k), F.col("description").alias(name))
    both = both_orders(pairs).join(side("a", "_first"), "a").join(side("b", "_second"), "b")
    message = F.concat(F.lit("Stuk A\n"), "_first", F.lit("\n\nStuk B\n"), "_second")
    rows = both.select("a", "b", "order", message.alias("message"))
    return rows.withColumn("key", F.substring(F.sha1(F.concat_ws("|", F.lit(model), F.lit(prompt), "message").cast("binary")), 1, 24))


def to_ask(messages: DataFrame, cache: DataFrame) -> DataFrame:
    """Messages (key, message), each once, whose key the ``cache`` (key) does not have."""
    return messages.groupBy("key").agg(F.min("message").alias("message")).join(cache.select("key"), "key", "left_anti")


def read_verdict(answer: Column) -> Column:
    """``ja``, ``nee`` or ``twijfel`` from the JSON object in an answer; what can't be read is ``twijfel``, a null answer stays open."""
    said = F.get_json_object(F.regexp_extract(answer, r"(?s)(\{.*?\})", 1), "$.oordeel")
    return F.when(answer.isNotNull(), F.when(said.isin("ja", "nee", "twijfel"), said).otherwise("twijfel"))


def two_sided(verdicts: DataFrame) -> DataFrame:
    """Outcome of each unordered pair: ``ja`` if both orders say so, ``nee`` if both are judged otherwise, else ``open``."""
    keyed = verdicts.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "verdict", (F.col("a") < F.col("b")).alias("forth"))
    n = F.count_distinct(F.when(F.col("verdict").isNotNull(), F.col("forth")))
    return keyed.groupBy("a", "b").agg(F.when(n < 2, "open").when((F.min("verdict") == "ja") & (F.max("verdict") == "ja"), "ja").otherwise("nee").alias("outcome"))


def majority(verdicts: DataFrame, key: str, *, yes: str = "a", no: str = "o") -> DataFrame:
    """``yes`` where more than half of a key's verdicts say so; a tie is ``no``."""
    return verdicts.groupBy(key).agg(F.when(2 * F.count_if(F.col("verdict") == yes) > F.count("verdict"), yes).otherwise(no).alias("verdict"), F.count("verdict").alias("n_votes"))


def unfinished(pairs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Ordered pairs without a verdict; the outcome may be published only if there are none."""
    return both_orders(pairs).join(verdicts.where("verdict is not null").select("a", "b"), ["a", "b"], "left_anti")


def place_questions(yes: DataFrame, no: DataFrame, groups: DataFrame) -> DataFrame:
    """The group that each question joins: most yes pairs with its members, if these outnumber the other verdicts there.

    ``yes`` and ``no`` have (question, item), ``groups`` (item, group). Ties go to the group of least name.
    """
    counted = yes.join(groups, "item").groupBy("question", "group").agg(F.count("*").alias("n_yes"))
    against = no.join(groups, "item").groupBy("question", "group").agg(F.count("*").alias("n_no"))
    both = counted.join(against, ["question", "group"], "left").fillna({"n_no": 0}).where("n_yes > n_no")
    best = Window.partitionBy("question").orderBy(F.col("n_yes").desc(), "group")
    return both.withColumn("_rn", F.row_number().over(best)).where("_rn = 1").select("question", "group", "n_yes", "n_no")
