"""Tables with versions: a write never touches what readers see, the pointer moves last, and an older version can be restored.

Each version is a folder of its own. A commit is a small table (version, folder) whose job is the last thing a write does;
readers take the largest committed version, so a write that fails leaves the former one. Commits are numbered by the writer and
refuse a number that exists, so of two writers at once one fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT = "version long, folder string, of long"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Rows (version, folder, of) of all commits; ``of`` is the version that a restored one repeats, else its own."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/commits")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).option("recursiveFileLookup", "true").json(f"{root}/commits")


def _newest(spark: SparkSession, root: str):
    return versions(spark, root).orderBy(F.col("version").desc()).first()


def _commit(spark: SparkSession, root: str, number: int, folder: str, of: int) -> int:
    spark.createDataFrame([(number, folder, of)], COMMIT).coalesce(1).write.mode("errorifexists").json(f"{root}/commits/{number:012d}")
    return number


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest version; None if there is none."""
    newest = _newest(spark, root)
    return None if newest is None else spark.read.parquet(f"{root}/{newest.folder}")


def publish(df: DataFrame, root: str, *gates: Callable[[DataFrame | None, DataFrame], None]) -> int:
    """Write ``df`` as the next version and return its number.

    The data is written first and each gate gets (the former version, the new one); a gate that raises leaves the former version.
    ``df`` may read the former version: its folder stays.
    """
    spark = df.sparkSession
    newest = _newest(spark, root)
    number = 1 if newest is None else newest.version + 1
    folder = f"v{number}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    written, former = spark.read.schema(df.schema).parquet(f"{root}/{folder}"), current(spark, root)
    for gate in gates:
        gate(former, written)
    return _commit(spark, root, number, folder, number)


def restore(spark: SparkSession, root: str, version: int) -> int:
    """Make an older version the newest again, as a commit of its own; nothing is copied or lost."""
    found = versions(spark, root).where(F.col("version") == version).first()
    if found is None:
        raise ValueError(f"no version {version}")
    return _commit(spark, root, _newest(spark, root).version + 1, found.folder, found.of)


def no_shrink(percent: int = 80) -> Callable[[DataFrame | None, DataFrame], None]:
    """A gate: a new version with fewer than ``percent`` of the former rows is refused."""

    def gate(former: DataFrame | None, new: DataFrame) -> None:
        if former is not None and 100 * (n := new.count()) < percent * (before := former.count()):
            raise ValueError(f"{n} rows where there were {before}")

    return gate


def run_stages(spark: SparkSession, root: str, stages: Iterable[tuple[str, Callable[[SparkSession], DataFrame], bool]]) -> DataFrame:
    """Run stages (name, function, soft) in turn and publish each result below its name; a report (stage, state, version, error).

    A soft stage that fails is reported and its former version stays in use; any other failure stops the run, with the
    versions before it published.
    """
    report = []
    for name, stage, soft in stages:
        try:
            report.append((name, "done", publish(stage(spark), f"{root}/{name}"), None))
        except Exception as e:
            if not soft:
                raise
            kept = _newest(spark, f"{root}/{name}")
            report.append((name, "failed", kept.version if kept else None, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"))
    return spark.createDataFrame(report, "stage string, state string, version long, error string")
