"""Named queries over the driver tables, each with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with its SQL if there is one."""

    def put(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    """
    WITH first_ship AS (SELECT l_orderkey, min(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey),
    judged AS (
        SELECT o_orderpriority, date_diff('day', o_orderdate::DATE, shipped::DATE) AS days
        FROM orders JOIN first_ship ON o_orderkey = l_orderkey
    )
    SELECT o_orderpriority, count(*) AS n, count(*) FILTER (days <= 10) AS n_on_time,
           round(100.0 * count(*) FILTER (days <= 10) / count(*), 6) AS pct_on_time,
           CAST(sum(greatest(days - 10, 0)) AS BIGINT) AS late_days
    FROM judged GROUP BY o_orderpriority
    """
)
def timeliness_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of orders whose first shipment comes within ten days, per priority."""
    first_ship = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("shipped"))
    judged = table(spark, sf_dir, "orders").join(first_ship, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderpriority", F.datediff("shipped", "o_orderdate").alias("days"))
    return judged.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("days") <= 10).alias("n_on_time"),
        F.round(F.lit(100.0) * F.count_if(F.col("days") <= 10) / F.count("*"), 6).alias("pct_on_time"),
        F.sum(F.greatest(F.col("days") - 10, F.lit(0))).cast("long").alias("late_days"),
    )


def _load() -> None:
    """Import the modules whose queries register themselves."""
    from civicframe.plans import catalogue_queries, dossier_queries, link_queries, made_queries, parser_queries, publication_queries, search_queries, source_queries, text_queries  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name and function of every query."""
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    _load()
    return dict(ORACLES)
