"""Dates and deadlines as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Dutch month names. Fixed values.
MONTHS = ("januari", "februari", "maart", "april", "mei", "juni", "juli", "augustus", "september", "oktober", "november", "december")
#: Abbreviations of these. Fixed values.
SHORT_MONTHS = ("jan", "feb", "mrt", "apr", "mei", "jun", "jul", "aug", "sep", "okt", "nov", "dec")


def iso_date(text: Column) -> Column:
    """A date of yyyy-mm-dd; null for null, empty or impossible ones."""
    return F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")), F.lit("yyyy-MM-dd")).cast("date")


def checked_date(year: Column, month: Column, day: Column) -> Column:
    """A date of three numbers as text; null if there is no such day."""
    return F.try_to_timestamp(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")


def month_number(name: Column) -> Column:
    """Number of a Dutch month, by its name or first three letters, as text."""
    out = F.lit(None).cast("string")
    for i, (full, short) in enumerate(zip(MONTHS, SHORT_MONTHS, strict=True), 1):
        out = F.when(F.lower(name).isin(full, short, full[:3]), F.lit(str(i))).otherwise(out)
    return out


def written_date(text: Column) -> Column:
    """The first date in a text: ISO, day-month-year with any of ``/-.``, or with a month's name; null if none."""
    iso = [F.regexp_extract(text, r"(\d{4})-(\d{1,2})-(\d{1,2})", i) for i in (1, 2, 3)]
    numeric = [F.regexp_extract(text, r"(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{4})", i) for i in (3, 2, 1)]
    pattern = r"(?i)(\d{1,2})\s+([a-z]{3,9})\.?\s+(\d{4})"
    named = (F.regexp_extract(text, pattern, 3), month_number(F.regexp_extract(text, pattern, 2)), F.regexp_extract(text, pattern, 1))
    return F.coalesce(checked_date(*iso), checked_date(*numeric), checked_date(*named))


def labelled_date(text: Column, label: str, reach: int = 40) -> Column:
    """The first valid date within ``reach`` characters after any occurrence of ``label`` (a pattern)."""
    near = F.regexp_extract_all(text, F.lit(rf"(?is){label}(.{{0,{reach}}})"), F.lit(1))
    return F.get(F.filter(F.transform(near, written_date), lambda d: d.isNotNull()), 0)


def agenda_status(session: Column, published: Column, days: int = 8) -> Column:
    """On time if published at least ``days`` before the session; days late against that day else; ``geen`` if never."""
    late = F.datediff(published, F.date_sub(session, days))
    return F.struct(F.when(published.isNull(), "geen").when(late <= 0, "tijdig").otherwise("te-laat").alias("status"), F.when(published.isNull(), 0).otherwise(F.greatest(late, F.lit(0))).cast("long").alias("late_days"))


def decision_status(session: Column, published: Column, days: int = 10) -> Column:
    """On time if published at most ``days`` after the session; days over else; ``geen`` if never."""
    late = F.datediff(published, session) - days
    return F.struct(F.when(published.isNull(), "geen").when(late <= 0, "tijdig").otherwise("te-laat").alias("status"), F.when(published.isNull(), 0).otherwise(F.greatest(late, F.lit(0))).cast("long").alias("late_days"))


def minutes_status(next_session: Column, published: Column) -> Column:
    """Minutes are never late: they wait for the next session, or came before or after it."""
    return F.when(published.isNull(), "geen").when(next_session.isNull(), "wachtend").when(published < next_session, "voor-goedkeuring").otherwise("na-goedkeuring")


def countdown(today: Column, day: Column) -> Column:
    """Label of the days to go, 0 at least, with the right plural."""
    left = F.greatest(F.datediff(day, today), F.lit(0))
    return F.concat(left.cast("string"), F.when(left == 1, " dag").otherwise(" dagen"))
