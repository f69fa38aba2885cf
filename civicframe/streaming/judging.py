"""Paid answers for a stream of questions: each batch is asked once, whatever fails, and its answers count only when they are whole.

A batch function for ``foreachBatch`` writes a control row before and after the part that costs: ``asked`` with the reference that the
judge gave for the batch, then ``done``. A restart finds the row and fetches the answers by the reference instead of asking again.
Rows are tables of their own in a folder a batch, so a repeated batch writes the same place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONTROL = "batch long, state string, reference string"


class NotReady(Exception):
    """The judge has not answered a batch yet: it stays asked, and a later run fetches it."""


def control(spark: SparkSession, root: str) -> DataFrame:
    """Rows (batch, state, reference) of all batches so far; none if nothing was ever asked."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/control")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CONTROL)
    return spark.read.schema(CONTROL).option("recursiveFileLookup", "true").json(f"{root}/control")


def pending(spark: SparkSession, root: str) -> DataFrame:
    """Batches that were asked and are not done: (batch, reference)."""
    rows = control(spark, root)
    return rows.where("state = 'asked'").join(rows.where("state = 'done'").select("batch"), "batch", "left_anti").select("batch", "reference")


def answers(spark: SparkSession, root: str) -> DataFrame | None:
    """Answers of the batches that are done; those of a failed round are never read. None before the first."""
    done = sorted(r.batch for r in control(spark, root).where("state = 'done'").collect())
    return spark.read.parquet(*(f"{root}/answers/batch={b}" for b in done)) if done else None


def judged_once(root: str, ask: Callable[[DataFrame, int], str], fetch: Callable[[SparkSession, str], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch function: ``ask`` hands questions to the judge and returns a reference, ``fetch`` gets the answers by it.

    ``fetch`` raises :class:`NotReady`, or anything, if it can't; the batch is then pending and the stream stops before its offsets are committed.
    The next run repeats the batch, finds what was asked and only fetches. What the judge left unanswered is
    no row of the answers, so the caller's next work list has it again.
    """

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        states = {r.state: r.reference for r in control(spark, root).where(F.col("batch") == number).collect()}
        note = lambda state, ref: spark.createDataFrame([(number, state, ref)], CONTROL).coalesce(1).write.mode("overwrite").json(f"{root}/control/{number}-{state}")
        if "done" in states:
            return
        if "asked" in states:
            reference = states["asked"]
        else:
            reference = ask(batch, number)
            note("asked", reference)
        fetch(spark, reference).write.mode("overwrite").parquet(f"{root}/answers/batch={number}")
        note("done", reference)

    return put
