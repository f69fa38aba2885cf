"""Writing tables and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write ``df`` over the partitions that it has rows of; other partitions stay. Writing it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def export_index(index: DataFrame, items: DataFrame, boundary: DataFrame) -> DataFrame:
    """One row a line of a compact index: ``items`` in order, ``tokens`` with item numbers, ``grens`` words."""
    numbers = items.select("id", "number")
    posted = index.select("token", F.explode("items").alias("id")).join(numbers, "id").groupBy("token").agg(F.sort_array(F.collect_list("number")).alias("n"))
    lines = items.select(F.lit("items").alias("part"), F.to_json(F.struct("number", "id")).alias("line"))
    lines = lines.unionByName(posted.select(F.lit("tokens").alias("part"), F.to_json(F.struct("token", "n")).alias("line")))
    return lines.unionByName(boundary.select(F.lit("grens").alias("part"), F.to_json(F.struct("token")).alias("line")))


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines without null fields; the committer makes the folder appear as a whole."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def page_safe(json: Column) -> Column:
    """Text that may stand inside a script element."""
    return F.replace(json, F.lit("</"), F.lit("<\\/"))


def filled_page(spark: SparkSession, template: str, values: dict[str, DataFrame]) -> DataFrame:
    """One row (page): ``template`` with each placeholder replaced by the JSON array of a table's rows, safe inside a script.

    A placeholder must stand in the template exactly once. The tables are what one page shows, so a page is one text.
    """
    for name in values:
        if (n := template.count(name)) != 1:
            raise ValueError(f"placeholder {name} stands {n} times in the template, not once")
    page = spark.createDataFrame([(template,)], "page string")
    for name, df in values.items():
        rows = df.agg(F.to_json(F.sort_array(F.collect_list(F.struct(*df.columns)))).alias("_json"))
        page = page.crossJoin(rows).select(F.replace("page", F.lit(name), page_safe(F.col("_json"))).alias("page"))
    return page


def change_log(old: DataFrame, new: DataFrame, *, keep: int = 50, day: str = "day", tie: str = "url") -> DataFrame:
    """The newest changes of both tables."""
    return old.unionByName(new).orderBy(F.col(day).desc(), tie).limit(keep)


def same_content(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables have the same rows, by a count and a sum of row hashes that does not depend on order."""
    digest = lambda df: df.select(F.xxhash64(*sorted(df.columns)).alias("h")).agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return sorted(a.columns) == sorted(b.columns) and digest(a) == digest(b)
