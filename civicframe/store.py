"""Stored intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a URI.

    It is ``spark.checkpoint.dir``. Only a local session, where driver and executors are one process, may go
    without; it gets a temporary folder that goes when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="civicframe-")
        atexit.register(shutil.rmtree, root, True)
        spark.conf.set("spark.checkpoint.dir", root)
    return root if "://" in root or root.startswith("file:") else f"file://{os.path.abspath(root)}"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: a cut of the lineage that outlives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
