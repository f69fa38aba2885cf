"""Quality gates: each gives the rows that break a rule; publishing stops if there are any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.functions.text import let


class GateError(RuntimeError):
    """A gate found violations."""


def assert_gate(name: str, violations: DataFrame, *, demo: bool = False, shown: int = 5) -> int:
    """Stop if there are violations, naming some; a demo run only counts them."""
    n = violations.count()
    if n and not demo:
        raise GateError(f"{name}: {n} violations, such as {[r.asDict() for r in violations.limit(shown).collect()]}")
    return n


def bad_ids(df: DataFrame, id_col: str, grammar: str) -> DataFrame:
    """Rows whose id is null or not of the grammar."""
    return df.where(~F.coalesce(F.col(id_col).rlike(rf"^(?:{grammar})$"), F.lit(False)))


def dry_run_texts(df: DataFrame, column: str, prefix: str = "[dry-run") -> DataFrame:
    """Rows that still hold a placeholder."""
    return df.where(F.col(column).startswith(prefix))


def summarised(decoded: Column, title: Column) -> Column:
    """Whether an item has a summary: one that is neither empty nor its title."""
    return F.coalesce((decoded != "") & (decoded != title), F.lit(False))


def coverage(df: DataFrame, good: Column, *by: str) -> DataFrame:
    """Share of rows that are good, in whole percent rounded down."""
    n, k = F.count("*"), F.count_if(good)
    return df.groupBy(*by).agg(n.alias("n"), k.alias("n_good"), F.floor(100 * k / n).cast("long").alias("pct"))


def below(covered: DataFrame, least: int = 90) -> DataFrame:
    """Groups whose share is too small."""
    return covered.where(F.col("pct") < least)


def not_once(df: DataFrame, column: str, placeholder: str) -> DataFrame:
    """Rows in which a placeholder does not stand exactly once."""
    return df.where((F.length(column) - F.length(F.replace(F.col(column), F.lit(placeholder), F.lit("")))) / len(placeholder) != 1)


def host_leaks(df: DataFrame, column: str, host: str, allowed: list[str]) -> DataFrame:
    """Rows that name a host outside the constructs that may (patterns)."""
    text = F.col(column)
    for pattern in allowed:
        text = F.regexp_replace(text, pattern, "")
    return df.where(F.contains(F.lower(text), F.lit(host.lower())))


def unstable(df: DataFrame, column: str, mask) -> DataFrame:
    """Rows that a mask would still change: it should have been applied."""
    return df.where(~mask(F.col(column)).eqNullSafe(F.col(column)))


def unstable_count(df: DataFrame, text: Column, mask) -> DataFrame:
    """One row (n, n_unstable): all rows, and those that the mask would change again after it was applied; one pass."""
    again = let(mask(text), lambda t: ~mask(t).eqNullSafe(t))
    return df.agg(F.count("*").alias("n"), F.count_if(again).alias("n_unstable"))


def collisions(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with two values or more."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n")).where("n > 1")


def link_errors(links: DataFrame, items: DataFrame, texts: DataFrame) -> DataFrame:
    """What is wrong in a link table (item_id, extract_id, url, kind, number, key): rows (what, id).

    Two extracts for an item, a document at two items, an attachment without its extract, another number in the head
    than the item's, a text key of two urls, a key without a text (``texts``: key).
    """
    extracts = links.where("kind = 'uittreksel'")
    say = lambda df, what, c: df.select(F.lit(what).alias("what"), F.col(c).cast("string").alias("id"))
    out = say(collisions(extracts, "item_id", "extract_id"), "meer dan een uittreksel", "item_id")
    out = out.unionByName(say(collisions(links, "url", "item_id"), "stuk bij twee punten", "url"))
    out = out.unionByName(say(links.where("kind = 'bijlage'").join(extracts.select("item_id"), "item_id", "left_anti"), "bijlage zonder uittreksel", "url"))
    out = out.unionByName(say(extracts.where("number is not null").join(items.select("item_id", F.col("number").alias("_n")), "item_id").where("number <> _n"), "ander puntnummer", "item_id"))
    out = out.unionByName(say(collisions(links, "key", "url"), "tekst van twee stukken", "key"))
    return out.unionByName(say(links.where("key is not null").join(texts.select("key"), "key", "left_anti"), "tekst ontbreekt", "key")).distinct()


def file_errors(links: DataFrame, catalogue: DataFrame, files: DataFrame) -> DataFrame:
    """What is wrong between a link table (item_id, url, key), the ``catalogue`` (url, path) and the ``files`` (path, modified in nanoseconds, size): rows (what, id).

    The key of a cached text is the digest of its file's path, time and size: another key means the text of another
    document, or of a former one. A text whose file is gone can't be checked and is an error too, and so is a path
    that two documents of the catalogue share.
    """
    keyed = links.where("key is not null").join(catalogue.select("url", "path"), "url").join(files, "path", "left")
    own = F.sha1(F.concat_ws("|", "path", F.col("modified").cast("string"), F.col("size").cast("string")).cast("binary"))
    say = lambda df, what, c: df.select(F.lit(what).alias("what"), F.col(c).cast("string").alias("id"))
    out = say(keyed.where(F.col("size").isNull()), "tekst zonder bestand", "item_id")
    out = out.unionByName(say(keyed.where(F.col("size").isNotNull() & (F.col("key") != own)), "tekst van een ander stuk", "item_id"))
    return out.unionByName(say(collisions(catalogue, "path", "url"), "bestandsnaam gedeeld", "path")).distinct()


def assert_some(name: str, df: DataFrame) -> DataFrame:
    """``df``, unless it is empty: an empty index replaces nothing, and a page without links is no page."""
    if df.limit(1).count() == 0:
        raise GateError(f"{name}: nothing found")
    return df


def changed_prompts(prompts: DataFrame, known: DataFrame) -> DataFrame:
    """Prompts (name, version, text) whose text differs from the known one (name, version, digest) of the same version."""
    now = prompts.select("name", "version", F.sha2(F.col("text").cast("binary"), 256).alias("now"))
    return now.join(known.select("name", "version", "digest"), ["name", "version"]).where(F.col("now") != F.col("digest"))


def assert_private_list(names: DataFrame | None, *, empty_on_purpose: bool = False) -> None:
    """Stop if there is no list of private names, or an empty one that isn't meant to be."""
    if names is None or (not empty_on_purpose and names.limit(1).count() == 0):
        raise GateError("the list of private names is missing or empty")
