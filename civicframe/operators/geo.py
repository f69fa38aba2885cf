"""Coordinates and districts, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Belgian Lambert 72 on the Hayford ellipsoid, and the shift to WGS 84 (metres, arc seconds, parts per million). Fixed values.
_A, _F = 6378388.0, 1 / 297.0
_PHI1, _PHI2, _LON0 = 49.8333339, 51.16666723333333, 4.367486666666666
_FALSE_EAST, _FALSE_NORTH = 150000.013, 5400088.438
_SHIFT, _TURN, _SCALE = (-106.8686, 52.2978, -103.7239), (-0.3366, 0.4570, -1.8422), -1.2747
_A84, _F84 = 6378137.0, 1 / 298.257223563


def lambert72_to_wgs84(x: Column, y: Column, rounds: int = 12) -> Column:
    """Struct (lon, lat) in degrees of Lambert 72 coordinates; latitudes by a fixed number of iterations."""
    e = math.sqrt(2 * _F - _F * _F)
    scale = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    conformal = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    p1, p2 = math.radians(_PHI1), math.radians(_PHI2)
    n = math.log(scale(p1) / scale(p2)) / math.log(conformal(p1) / conformal(p2))
    radius = _A * scale(p1) / (n * conformal(p1) ** n)
    dx, dy = x - F.lit(_FALSE_EAST), F.lit(_FALSE_NORTH) - y
    t = F.pow(F.hypot(dx, dy) / F.lit(radius), F.lit(1 / n))
    lon = F.atan2(dx, dy) / F.lit(n) + F.lit(math.radians(_LON0))
    steps = F.sequence(F.lit(1), F.lit(rounds))

    def closer(p: Column, _: Column) -> Column:
        s = F.lit(e) * F.sin(p)
        return F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(e / 2)))

    lat = F.aggregate(steps, F.lit(math.pi / 2) - 2 * F.atan(t), closer)
    big = F.lit(_A) / F.sqrt(1 - F.lit(e * e) * F.sin(lat) * F.sin(lat))
    at = (big * F.cos(lat) * F.cos(lon), big * F.cos(lat) * F.sin(lon), big * F.lit(1 - e * e) * F.sin(lat))
    rx, ry, rz = (math.radians(s / 3600) for s in _TURN)
    k = 1 + _SCALE * 1e-6
    turned = (at[0] + rz * at[1] - ry * at[2], -rz * at[0] + at[1] + rx * at[2], ry * at[0] - rx * at[1] + at[2])
    xw, yw, zw = (F.lit(s) + k * v for s, v in zip(_SHIFT, turned, strict=True))
    e2 = 2 * _F84 - _F84 * _F84
    p = F.hypot(xw, yw)

    def higher(f: Column, _: Column) -> Column:
        return F.atan2(zw + F.lit(e2 * _A84) / F.sqrt(1 - F.lit(e2) * F.sin(f) * F.sin(f)) * F.sin(f), p)

    return F.struct(F.degrees(F.atan2(yw, xw)).alias("lon"), F.degrees(F.aggregate(steps, F.atan2(zw, p * F.lit(1 - e2)), higher)).alias("lat"))


def ring_contains(x: Column, y: Column, ring: Column) -> Column:
    """Whether a ring (array of [x, y]) holds a point: an odd number of its edges lie right of it."""
    n = F.size(ring)
    edges = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i).alias("p"), F.get(ring, F.pmod(i + n - 1, n)).alias("q")))

    def crosses(e: Column) -> Column:
        px, py, qx, qy = F.get(e["p"], 0), F.get(e["p"], 1), F.get(e["q"], 0), F.get(e["q"], 1)
        return ((py > y) != (qy > y)) & (x < (qx - px) * (y - py) / F.nullif(qy - py, F.lit(0.0)) + px)

    return F.when(n < 3, False).otherwise(F.size(F.filter(edges, crosses)) % 2 == 1)


def on_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies on an edge of a ring (array of [x, y])."""
    n = F.size(ring)
    edges = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i).alias("p"), F.get(ring, F.pmod(i + n - 1, n)).alias("q")))

    def touches(e: Column) -> Column:
        px, py, qx, qy = F.get(e["p"], 0), F.get(e["p"], 1), F.get(e["q"], 0), F.get(e["q"], 1)
        within = x.between(F.least(px, qx), F.greatest(px, qx)) & y.between(F.least(py, qy), F.greatest(py, qy))
        return within & ((qx - px) * (y - py) == (qy - py) * (x - px))

    return F.when(n < 1, False).otherwise(F.exists(edges, touches))


def polygon_contains(x: Column, y: Column, polygons: Column, *, strict: bool = False) -> Column:
    """Whether one of several polygons (arrays of rings: an outline and its holes) holds a point.

    Of points on an edge those on left and lower edges count as inside a ring; with ``strict`` none does, be it an outline or a hole.
    """
    holds = (lambda r: ring_contains(x, y, r) & ~on_ring(x, y, r)) if strict else (lambda r: ring_contains(x, y, r))
    return F.exists(polygons, lambda rings: holds(F.get(rings, 0)) & ~F.exists(F.slice(rings, F.lit(2), F.size(rings)), holds))


def in_districts(points: DataFrame, districts: DataFrame, x: str, y: str, key: str, *, cell: float = 0.05, strict: bool = False) -> DataFrame:
    """Points with the first district (name, polygons) by name that holds them, or null; ``strict`` as in :func:`polygon_contains`.

    Districts are listed under the squares of side ``cell`` that their outlines' bounds touch, and a point is compared with
    those of its square only: an equal join that Spark shuffles, or broadcasts where it knows the districts to be few.
    """
    corners = F.flatten(F.transform("polygons", lambda rings: F.get(rings, 0)))
    square = lambda v: F.floor(v / F.lit(cell)).cast("long")
    span = lambda i: F.sequence(square(F.array_min(F.transform(corners, lambda c: F.get(c, i)))), square(F.array_max(F.transform(corners, lambda c: F.get(c, i)))))
    rows = districts.where(F.size(corners) > 0).select("name", "polygons", F.explode(span(0)).alias("_dx"), span(1).alias("_span")).select("name", "polygons", "_dx", F.explode("_span").alias("_dy"))
    here = (square(F.col(x)) == F.col("_dx")) & (square(F.col(y)) == F.col("_dy"))
    pairs = points.join(rows, here & polygon_contains(F.col(x), F.col(y), F.col("polygons"), strict=strict), "left")
    first = Window.partitionBy(key).orderBy(F.col("name").asc_nulls_last())
    return pairs.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").select(*points.columns, F.col("name").alias("district"))


def split_address(address: Column) -> Column:
    """Struct (street, postcode, place) of ``Street 9 bus 205, 2800 Place``; nulls if it has another form."""
    pattern = r"(?U)^(.*?)(?:\s+\d+\S*(?:\s+bus\s+\S+)?)?\s*,\s*(\d{4})\s+(.+)$"
    return F.struct(*(F.nullif(F.trim(F.regexp_extract(address, pattern, i)), F.lit("")).alias(n) for i, n in ((1, "street"), (2, "postcode"), (3, "place"))))


def street_register(addresses: DataFrame) -> DataFrame:
    """Per street: its commonest postcode (the first seen on a tie), all postcodes with counts, and an object of each.

    ``addresses`` has address, object_id and ord, the order in which they were read.
    """
    parts = addresses.select(split_address(F.col("address")).alias("s"), "object_id", "ord").select("s.street", "s.postcode", "object_id", "ord").where("street is not null and postcode is not null")
    per = parts.groupBy("street", "postcode").agg(F.count("*").alias("n"), F.min_by("object_id", "ord").alias("object_id"), F.min("ord").alias("first"))
    entries = F.sort_array(F.collect_list(F.struct("postcode", "n", "object_id")))
    best = F.max_by("postcode", F.struct("n", -F.col("first")))
    return per.groupBy("street").agg(best.alias("postcode"), F.map_from_entries(F.transform(entries, lambda e: F.struct(e["postcode"], e["n"]))).alias("postcodes"), F.map_from_entries(F.transform(entries, lambda e: F.struct(e["postcode"], e["object_id"]))).alias("objects"))
