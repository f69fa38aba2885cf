"""Written questions: labelled fields of a document become a record."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.functions.dates import labelled_date
from civicframe.functions.text import first_nonempty, squeeze


class Field(NamedTuple):
    """Where a field stands in the text and, failing that, in the file name; what its text is rid of; its default."""

    in_text: tuple[str, ...]
    in_name: str | None = None
    rid_of: str = "^$"
    instead: str = ""
    default: str | None = None


#: Fields of a written question. Fixed values.
_QUESTION_END = r"(?:\n\s*Naam\s*:|SCHRIFTELIJK ANTWOORD|Antwoord\s+college|Met vriendelijke groet|$)"
_LEADING = r"^[\s:–—.\-]+"
FIELDS = {
    "number": Field((r"\b(20\d{2}\s*/\s*\d{2,4})\b",), r"^(\d{4}[-_]\d+)", r"\s*[-_/]\s*", "/"),
    "submitter": Field((r"(?s)Indiener\s*:\s*(.+?)\s*(?:Datum|Onderwerp|\n)",), r"^\d{4}[-_]\d+ - (.+?) - "),
    "subject": Field((r"Onderwerp(?:\s+vraag)?\s*:\s*(.+?)(?:\n|Toelichtende|$)",), r"^\d{4}[-_]\d+ - .+? - (.+)$", r"[. ;,]+$", default="Schriftelijke vraag"),
    "question": Field((rf"(?is)Toelichtende nota\s*(.+?){_QUESTION_END}", rf"(?is)\n\s*(?:Toelichting|Context|Vragen)\s*\n(.+?){_QUESTION_END}"), None, _LEADING, default=""),
    "answer": Field((r"(?is)Antwoord\s+college\s*(.+?)(?:\n[A-Z][a-z]+, \d|\nOpdracht burgemeester|$)",), None, _LEADING, default=""),
}
DAY_LABEL = r"Datum(?:\s+indiening)?\s*:?"


def read_field(field: Field, text: Column, name: Column) -> Column:
    """The first place that has the field, tidied; else its default."""
    places = [(text, p) for p in field.in_text] + ([(name, field.in_name)] if field.in_name else [])
    found = [F.regexp_replace(squeeze(F.regexp_extract(where, p, 1)), field.rid_of, field.instead) for where, p in places]
    return first_nonempty(*found) if field.default is None else F.coalesce(first_nonempty(*found), F.lit(field.default))


def parse_questions(docs: DataFrame, *, text: str = "text", filename: str = "filename", month: str = "month") -> DataFrame:
    """Records of written questions: id, date, number, submitter, subject, question, answer, has_answer, source_text.

    What the text does not say comes from the file name (number, submitter and subject, parted by hyphens) and from the
    month of publication. Ids that come twice get a digest of the file name, oldest date first.
    """
    t, f = F.col(text), F.regexp_replace(filename, r"(?i)\.pdf$", "")
    day = F.coalesce(labelled_date(t, DAY_LABEL), F.try_to_timestamp(F.concat(F.col(month), F.lit("-01")), F.lit("yyyy-MM-dd")).cast("date"))
    rows = docs.select("*", day.alias("date"), *(read_field(field, t, f).alias(column) for column, field in FIELDS.items()))
    who = F.coalesce("submitter", F.lit("een raadslid"))
    source = F.concat(F.lit("Schriftelijke vraag van "), who, F.lit(" aan de stad, onderwerp: "), F.col("subject"), F.lit(".\n\n"), F.col("question"), F.when(F.col("answer") != "", F.concat(F.lit("\n\nAntwoord van het college:\n"), F.col("answer"))).otherwise(""))
    rows = rows.withColumn("id", F.concat(F.lit("sv-"), F.col(month), F.lit("-"), F.translate(F.coalesce("number", F.lit("0")), "/", "-"))).withColumn("source_text", F.trim(source)).withColumn("has_answer", F.col("answer") != "")
    place = F.row_number().over(Window.partitionBy("id").orderBy("date", filename))
    unique = F.when(place == 1, F.col("id")).otherwise(F.concat("id", F.lit("-"), F.substring(F.sha1(F.col(filename).cast("binary")), 1, 6)))
    return rows.withColumn("id", unique).select("id", "date", "number", "submitter", "subject", "question", "answer", "has_answer", "source_text")


def since_others(questions: DataFrame, others: DataFrame, day: str = "date") -> DataFrame:
    """Questions not older than the oldest other item; all if there is none."""
    oldest = others.agg(F.min(day).alias("_oldest"))
    return questions.crossJoin(F.broadcast(oldest)).where(F.col("_oldest").isNull() | (F.col(day) >= F.col("_oldest"))).drop("_oldest")


def public_columns(df: DataFrame, private: tuple[str, ...] = ("question", "answer", "source_text")) -> DataFrame:
    """The columns that may be published."""
    return df.drop(*private)
