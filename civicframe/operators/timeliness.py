"""Legal deadlines: status of each document, ratios, cross-check, next session, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.functions.dates import agenda_status, decision_status, minutes_status


def with_next_session(sessions: DataFrame, organ: str, day: str, *tie: str) -> DataFrame:
    """Add ``next_session``: the day of the organ's following session."""
    return sessions.withColumn("next_session", F.lead(day).over(Window.partitionBy(organ).orderBy(day, *tie)))


def judged(documents: DataFrame, *, kind: str = "doctype", session: str = "session", published: str = "published", following: str = "next_session") -> DataFrame:
    """Status and late days of each document by its kind; kinds without a rule have the status ``geen-oordeel``."""
    agenda, decision = agenda_status(F.col(session), F.col(published)), decision_status(F.col(session), F.col(published))
    status = F.when(F.col(kind) == "agenda", agenda["status"]).when(F.col(kind) == "besluiten", decision["status"]).when(F.col(kind) == "notulen", minutes_status(F.col(following), F.col(published))).otherwise("geen-oordeel")
    late = F.when(F.col(kind) == "agenda", agenda["late_days"]).when(F.col(kind) == "besluiten", decision["late_days"]).otherwise(F.lit(0).cast("long"))
    return documents.withColumn("status", status).withColumn("late_days", late)


def on_time_ratio(documents: DataFrame, *by: str) -> DataFrame:
    """Share of on-time documents, among those with a verdict."""
    n, ok = F.count("*"), F.count_if(F.col("status") == "tijdig")
    return documents.where(F.col("status").isin("tijdig", "te-laat")).groupBy(*by).agg(n.alias("n"), ok.alias("n_on_time"), F.round(F.lit(100.0) * ok / n, 6).alias("pct_on_time"))


def late_summary(documents: DataFrame, *by: str, day: str = "session") -> DataFrame:
    """Number of late documents, their first day and longest delay, per group; no list is gathered."""
    return documents.where(F.col("status") == "te-laat").groupBy(*by).agg(F.count("*").alias("n_late"), F.min(day).alias("first_day"), F.max("late_days").alias("longest"))


def disagreements(computed: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose recomputed status is not the stored one."""
    return computed.join(stored.withColumnRenamed("status", "stored_status"), keys).where(~F.col("status").eqNullSafe(F.col("stored_status")))


def next_session(sessions: DataFrame, today: Column, *, day: str, preferred: Column, tie: str) -> DataFrame:
    """The earliest session from ``today``, preferred ones first."""
    return sessions.where(F.col(day) >= today).orderBy(F.when(preferred, 0).otherwise(1), day, tie).limit(1)


def round_robin(df: DataFrame, group: str, n: int, *order: Column) -> DataFrame:
    """``n`` rows, taken in turn from each group in its own order."""
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).orderBy("turn", group).limit(n)
