"""First and last wins, fills, differences of snapshots, work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.functions.text import let


def first_wins(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order. State an order that is total, as rows have none of their own."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def last_wins(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key in the ascending order of some columns."""
    return first_wins(df, keys, *(F.col(c).desc() for c in order))


def keep_both(preferred: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer merge: each key once, each column from ``preferred`` if it has a value, else from ``other``."""
    columns = [c for c in preferred.columns if c not in keys]
    a = preferred.select(*keys, *(F.col(c).alias(f"_a_{c}") for c in columns))
    b = other.select(*keys, *(F.col(c).alias(f"_b_{c}") for c in columns))
    return a.join(b, keys, "full").select(*keys, *(F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns))


def fill(df: DataFrame, new: DataFrame, keys: list[str], columns: list[str], *, overwrite: bool = False, empty: Column | None = None) -> DataFrame:
    """Fields of ``df`` from ``new`` where they are null or empty text (or ``empty`` holds), or all with ``overwrite``."""
    joined = df.join(new.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in columns)), keys, "left")
    out = joined
    for c in columns:
        is_empty = F.col(c).isNull() | (F.col(c).cast("string") == "") | (F.lit(False) if empty is None else empty)
        out = out.withColumn(f"_to_{c}", F.when((F.lit(overwrite) | is_empty) & F.col(f"_new_{c}").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)))
    return out.select(*[F.col(f"_to_{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """Per key of either snapshot, what became of it: ``nieuw``, ``gewijzigd``, ``verdwenen`` or ``gelijk``."""
    a, b = old.select(key, F.col(value).alias("_old"), F.lit(True).alias("_was")), new.select(key, F.col(value).alias("_new"), F.lit(True).alias("_is"))
    what = F.when(F.col("_was").isNull(), "nieuw").when(F.col("_is").isNull(), "verdwenen").when(~F.col("_old").eqNullSafe(F.col("_new")), "gewijzigd").otherwise("gelijk")
    return a.join(b, key, "full").select(key, what.alias("change"))


def shrank(old_count: Column, new_count: Column, share: float = 0.8) -> Column:
    """Whether a catalogue lost more than it may."""
    return new_count < old_count * F.lit(share)


def suffix_duplicates(df: DataFrame, keys: list[str], id_col: str, content: Column, *order: Column) -> DataFrame:
    """Ids made unique: the first of equal ids stays, later ones get six digits of a digest of their content."""
    place = F.row_number().over(Window.partitionBy(*keys, id_col).orderBy(*order))
    fresh = F.concat(F.col(id_col), F.lit("-"), F.substring(F.sha1(content.cast("binary")), 1, 6))
    return df.withColumn(id_col, F.when(place == 1, F.col(id_col)).otherwise(fresh))


def work_list(items: DataFrame, cache: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row for each key that the cache does not have: what is still to be done."""
    return first_wins(items.join(cache.select(key).distinct(), key, "left_anti"), [key], *order)


def estimated_cost(df: DataFrame, text: Column, *, per_token: float = 4.0, overhead: float = 1.3, answer: int = 400) -> DataFrame:
    """Calls and tokens that a run over ``df`` would take."""
    return df.agg(F.count("*").alias("n_calls"), F.floor(F.coalesce(F.sum(F.length(text)), F.lit(0)) / per_token * overhead).cast("long").alias("tokens_in"), (F.count("*") * answer).alias("tokens_out"))


def replace_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` without the rows whose keys ``new`` has, and all of ``new``."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def mode(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The commonest ``value`` of each key with its count ``n``; of equally common ones that seen first by ``order``."""
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("_seen"))
    best = F.max_by(F.struct(value, "n"), F.struct(F.col("n"), -F.col("_seen"))).alias("_best")
    return counted.groupBy(*keys).agg(best).select(*keys, f"_best.{value}", "_best.n")


def replace_sessions(old: DataFrame, new: DataFrame, keys: list[str], *, id_col: str = "id", demo: str = "demo-", day: str = "date") -> DataFrame:
    """:func:`replace_rows` by session, without items of the demonstration (ids that begin with ``demo``), newest first."""
    return replace_rows(old.where(~F.col(id_col).startswith(demo)), new, keys).orderBy(F.col(day).desc(), id_col)


def repaired_list(text: Column) -> Column:
    """A list of strings that was stored as its Python notation; an empty list for anything else."""
    items = F.regexp_extract_all(text, F.lit(r"""'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)\""""), F.lit(0))
    return F.when(F.trim(text).rlike(r"(?s)^\[.*\]$"), F.transform(items, lambda x: F.substr(x, F.lit(2), F.length(x) - 2))).otherwise(F.array().cast("array<string>"))


def clean_terms(terms: Column, most: int = 8, longest: int = 60) -> Column:
    """Trimmed terms without empty and overlong ones, each once whatever its case, the first ``most``."""
    def add(acc: Column, term: Column) -> Column:
        fits = lambda x: (F.length(x) > 0) & (F.length(x) <= longest) & ~F.exists(acc, lambda y: F.lower(y) == F.lower(x))
        return F.when(F.size(acc) >= most, acc).otherwise(let(F.trim(term), lambda x: F.when(fits(x), F.array_append(acc, x)).otherwise(acc)))

    # the first terms mostly hold ``most``; the rest of the list is looked at only if they don't
    near, begin = 4 * most, F.array().cast("array<string>")
    rest = lambda acc: F.aggregate(F.slice(terms, F.lit(near + 1), F.greatest(F.size(terms) - near, F.lit(0))), acc, add)
    return let(F.aggregate(F.slice(terms, 1, near), begin, add), lambda acc: F.when((F.size(acc) >= most) | (F.size(terms) <= near), acc).otherwise(rest(acc)))


def allowed_only(values: Column, allowed: Column) -> Column:
    """The values that a register has, in their order; all if the register is empty."""
    return F.when(F.size(allowed) == 0, values).otherwise(F.filter(values, lambda x: F.array_contains(allowed, x)))
