"""JSON documents, folders of files, and geometry in JSON and GML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from civicframe.store import stored

CORRUPT = "_corrupt_record"


def json_documents(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """Documents (an object, or an array of objects, a file, with or without a byte-order mark) and the files that can't be read.

    The schema is given, so no file is read to guess it and absent fields are null. The second table has (file, text):
    a broken file stops nothing, and whoever must not lose it can refuse a table that isn't empty.
    """
    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    with_bad = StructType([*kind.fields]).add(CORRUPT, "string")
    rows = spark.read.schema(with_bad).json(path, multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, recursiveFileLookup=True)
    rows = stored(rows.withColumn("file", F.col("_metadata.file_path")), "json")  # parsed once, for both tables
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, rows.where(F.col(CORRUPT).isNotNull()).select("file", F.col(CORRUPT).alias("text"))


def refuse_unreadable(bad: DataFrame) -> None:
    """Stop a run whose store of paid answers can't be read whole: else its answers would be asked for, and paid, again."""
    if names := [r.file for r in bad.select("file").limit(3).collect()]:
        raise ValueError(f"unreadable: {', '.join(names)}")


def session_files(spark: SparkSession, root: str, *, pattern: str = "*") -> DataFrame:
    """Files two folders below ``root``: organ, session (the folders' names), name, size, modified, content.

    Folders are listed by Spark; a folder written as ``organ=x`` counts as ``x``. Contents are read only by plans that use them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    part = lambda i: F.regexp_replace(F.url_decode(F.regexp_replace(F.element_at(F.split("path", "/"), i), r"\+", "%2B")), r"^[A-Za-z_]\w*=", "")
    return files.select(part(-3).alias("organ"), part(-2).alias("session"), F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content")


def gml_point(gml: Column) -> Column:
    """Struct (x, y) of the first position of a GML text, numbers with sign and exponent too; null if it has none."""
    number = r"([-+]?[\d.]+(?:[eE][-+]?\d+)?)"
    pattern = rf"<gml:pos>{number}\s+{number}</gml:pos>"
    x, y = (F.regexp_extract(gml, pattern, i).try_cast("double") for i in (1, 2))
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


_RINGS = "array<array<array<double>>>"


def polygons_of(geometry: Column) -> Column:
    """Polygons (arrays of rings of [x, y]) of a GeoJSON text: Polygon, MultiPolygon, a Feature of one, or a collection of these."""

    def own(text: Column) -> Column:
        kind, coordinates = F.get_json_object(text, "$.type"), F.get_json_object(text, "$.coordinates")
        one = F.array(F.from_json(coordinates, _RINGS))
        return F.when(kind == "Polygon", one).when(kind == "MultiPolygon", F.from_json(coordinates, f"array<{_RINGS}>"))

    plain = F.coalesce(F.get_json_object(geometry, "$.geometry"), geometry)
    several = F.from_json(F.get_json_object(plain, "$.geometries"), "array<string>")
    return F.coalesce(own(plain), F.flatten(F.transform(several, own)))


def districts(spark: SparkSession, path: str) -> DataFrame:
    """Rows (name, polygons) of JSON files that map names to geometries; names without a readable area have null polygons."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\\uFEFF", "").alias("value"))
    return files.select(F.explode(F.from_json("value", "map<string,string>")).alias("name", "geometry")).select("name", polygons_of(F.col("geometry")).alias("polygons"))
