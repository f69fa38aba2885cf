"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, StringType, StructType

from civicframe.store import shared_path, stored

#: White space as the contracts of this subpackage define it.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def open_store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path of a URI, for tasks that read or write files of their own."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri.removeprefix("file:")
    return arrow_fs.FileSystem.from_uri(uri)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and leave all other letters as they are."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, _UPPER, _UPPER.lower())).otherwise(F.lower(text))


def words(text: Column, pattern: str = WORD) -> Column:
    """The words of ``text``, A-Z in lower case; none for null."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(f"({pattern})"), F.lit(1))


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once a row however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def release() -> None:
    """Give memory that a task has freed back to the machine, as its worker waits for other tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only one kind of C library has it
        ctypes.CDLL(None).malloc_trim(0)


def quoted(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever signs their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


#: Bytes of a side that may be broadcast, as Spark holds its rows: fixed fields, and what strings and arrays take.
BROADCAST_BYTES = 64 << 20


def _weight(column: Column, kind: DataType) -> Column:
    """About the bytes that a value takes in memory."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, ArrayType):
        inner = F.transform(column, lambda x: _weight(x, kind.elementType).cast("bigint"))
        return F.coalesce(F.aggregate(inner, F.lit(0).cast("bigint"), lambda a, x: a + x), F.lit(0)) + 24
    if isinstance(kind, StructType):
        return sum((_weight(column[f.name], f.dataType) for f in kind.fields), F.lit(16))
    return F.lit(8)


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast if its bytes are summed up to be few; else Spark shuffles it."""
    row = sum((_weight(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(32))
    size = df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= limit else df


__all__ = ["BROADCAST_BYTES", "WORD", "let", "lower_ascii", "open_store", "quoted", "release", "shared_path", "small", "stored", "table", "unused", "words"]
