"""Streams of documents and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from civicframe.store import stored


def new_files(spark: SparkSession, folder: str, schema: StructType, *, per_trigger: int = 1000) -> DataFrame:
    """Rows of Parquet files as they appear; a file is read once for each checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def first_seen(stream: DataFrame, key: str, time: str, delay: str = "7 days") -> DataFrame:
    """The first row of each key; keys are remembered as long as late rows may come."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now, then stop; a later run goes on where this one ended."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def upsert_into(path: str, key: str, order: str | None = None):
    """A batch function for ``foreachBatch`` that replaces the rows of equal keys; a repeated batch changes nothing.

    Of equal keys in a batch the row of the largest ``order`` stays, and of equal ones of these the largest row.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        columns = [c for c in batch.columns if c != key]
        newest = F.max(F.struct(*([F.col(order).alias("_order")] if order else []), *columns)).alias("_row")
        fresh = batch.groupBy(key).agg(newest).select(key, *(F.col("_row")[c].alias(c) for c in columns)).withColumn("_batch", F.lit(batch_id))
        fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)

    return put


def current(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest row of each key of a table that :func:`upsert_into` writes."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c not in (key, "_batch")]
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), "_batch").alias("_row")).select(key, "_row.*")


def compact(spark: SparkSession, path: str, key: str) -> int:
    """Put the newest rows of a table that :func:`upsert_into` writes into its last batch and drop the others; the number of batches dropped.

    The merged rows are written first, so a reader or a failure between the two steps finds the same newest rows.
    """
    batches = sorted(r[0] for r in spark.read.parquet(path).select("_batch").distinct().collect())
    if len(batches) < 2:
        return 0
    rows = stored(current(spark, path, key), "compacted")
    rows.withColumn("_batch", F.lit(batches[-1])).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)
    for batch in batches[:-1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_batch={batch}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(batches) - 1


def windowed_counts(stream: DataFrame, time: str, by: str, *, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Events of each kind in each window; late ones count until the delay has passed."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n"))


__all__ = ["compact", "current", "first_seen", "new_files", "run_available", "upsert_into", "windowed_counts"]
