"""The operators as stages of a pipeline: from documents to documents of the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicframe.llm.common import quoted, small, stored, unused
from civicframe.llm.langid import UNKNOWN, has_letter, identify, learn
from civicframe.llm.mixing import document_key, mix
from civicframe.llm.neardup import near_duplicates


def with_language(docs: DataFrame) -> DataFrame:
    """Drop documents whose text is null or has no letter; name the language of those without one.

    Learns from all labelled texts. A null ``lang`` stays null if no language can be learned. Repeated rows are judged
    alike; an empty table stays empty; other columns are kept, whatever their names.
    """
    named, score = unused(docs, "_lang"), unused(docs, "_score")
    judged = identify(docs, learn(docs, held_out=F.lit(False)), out=(named, score))
    kept = judged.where((F.col(named) != UNKNOWN) | has_letter(F.col("text")))
    return kept.withColumn("lang", F.coalesce("lang", F.nullif(F.col(named), F.lit(UNKNOWN)))).select(*quoted(docs))


def one_of_each(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Keep the document of least id of each component of near-duplicates, and one row of each id.

    Documents without words have no near-duplicates and stay, as do all rows with a null id. Of rows that repeat an id
    the first in the order of their columns stays (maps by their JSON). An empty table stays empty; other columns are kept.
    """
    gone = stored(near_duplicates(docs, shingle=shingle, percent=percent).where("not kept").select("doc_id").distinct(), "near-copies")
    rest = docs.join(small(gone), "doc_id", "left_anti")
    twice = stored(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    if twice.limit(1).count():
        place = unused(docs, "_place")
        first = Window.partitionBy("doc_id").orderBy(*(F.to_json(F.struct(c)) if "map<" in kind else c for c, (name, kind) in zip(quoted(docs), docs.dtypes, strict=True) if name != "doc_id"))
        several = rest.join(small(twice), "doc_id", "left_semi").withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place)
        rest = rest.join(small(twice), "doc_id", "left_anti").unionByName(several)
    return rest.select(*quoted(docs))


def mixed(docs: DataFrame, **params) -> DataFrame:
    """Each document as often as the mix of sources takes it; the copies are repeated rows.

    A null source is a source; repeated rows are taken or left together. Texts without words come as often as their source's whole part says. An empty table stays empty; other
    columns are kept, whatever their names.
    """
    key, source, copies, copy = (unused(docs, c) for c in ("_mix_key", "_mix_source", "_mix_copies", "_mix_copy"))
    taken = mix(docs.select("doc_id", "source", "text"), **params).where("copies > 0").dropDuplicates(["key", "source"]).select(F.col("key").alias(key), F.col("source").alias(source), F.col("copies").alias(copies))
    rows = docs.withColumn(key, document_key()).join(taken, key).where(F.col("source").eqNullSafe(F.col(source)))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*quoted(docs))
