"""Points near other points, and points inside regions.

Both operators are grid joins: an equi-join on a derived cell or strip, followed by the exact test.
Neither ever compares all points with all points or all points with all edges.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import Column, DataFrame, functions as F

from cartoria.functions.lineage import cut
from cartoria.operators.skew import blocked_join, small

#: Rows of one point that go through a join as one block.
BLOCK = 10_000
EARTH_RADIUS_M = 6_371_000.0


def haversine_m(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column, radius_m: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres between two points given in degrees."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lng = F.sin(F.radians(lng_b - lng_a) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lng * half_lng
    return F.lit(2 * radius_m) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def valid_points(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Rows with both coordinates finite and on the globe; null, NaN and out-of-range ones are left out."""
    return df.filter(F.col(lat).between(-90.0, 90.0) & F.col(lng).between(-180.0, 180.0))


def point_classes(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """One row for each distinct point (``lat``, ``lng``) with ``n``, the number of rows standing there.

    Copies of a point, however many, shrink here by map-side counting, so a point that holds a third
    of all rows costs the distance join no more than any other.
    """
    return valid_points(df, lat, lng).groupBy(F.col(lat).alias("lat"), F.col(lng).alias("lng")).agg(F.count("*").alias("n"))


def near_classes(points: DataFrame, metres: float, radius_m: float = EARTH_RADIUS_M, max_abs_lat: float = 85.0, cells: int = 4, hot: int = 4096) -> DataFrame:
    """Pairs of distinct points at most ``metres`` apart: ``lat_a, lng_a, lat_b, lng_b``, each pair once.

    ``points`` has distinct (``lat``, ``lng``). The grid has cells of ``cells`` times the distance.
    A point stands in its own cell on one side and, on the other, in every cell its distance box
    touches (2.25 of them on average for ``cells=4``). The pair is kept where the first point comes
    first in the order (lat, lng), so no second pass removes doubles. A cell with more than
    ``hot`` points is split into blocks of about that size; its probes are sent to every block.
    Distances across the antimeridian are not joined. ``max_abs_lat`` bounds the latitudes that occur:
    it fixes the cells' width in degrees.
    Empty input gives no rows; a single point gives none.
    """
    step = math.degrees(metres / radius_m) * (1 + 1e-9)
    if math.radians(step) / 2 >= math.pi / 2:
        raise ValueError("the distance is too large for a grid")
    shrink = math.cos(math.radians(max_abs_lat))
    step_lng = math.degrees(2 * math.asin(min(1.0, math.sin(math.radians(step) / 2) / shrink))) * (1 + 1e-9)
    tall, wide = step * cells, step_lng * cells
    row = lambda c: F.floor(c / F.lit(tall))
    column = lambda c: F.floor(c / F.lit(wide))
    own = points.select("lat", "lng", row(F.col("lat")).alias("r"), column(F.col("lng")).alias("c"))
    counted = own.groupBy("r", "c").count().filter(F.col("count") > hot).select("r", "c", F.ceil(F.col("count") / hot).cast("int").alias("blocks"))
    build = (
        own.join(counted, ["r", "c"], "left")
        .withColumn("block", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("lat", "lng"), F.col("blocks")).cast("int")))
        .select("r", "c", "block", F.col("lat").alias("lat_b"), F.col("lng").alias("lng_b"))
    )
    probe = (
        points.select(
            F.col("lat").alias("lat_a"),
            F.col("lng").alias("lng_a"),
            F.explode(F.sequence(row(F.col("lat")), row(F.col("lat") + step))).alias("r"),
            column(F.col("lng") - step_lng).alias("c0"),
            column(F.col("lng") + step_lng).alias("c1"),
        )
        .withColumn("c", F.explode(F.sequence("c0", "c1")))
        .drop("c0", "c1")
        .join(counted, ["r", "c"], "left")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1)))
        .drop("blocks")
    )
    first = (F.col("lat_a") < F.col("lat_b")) | ((F.col("lat_a") == F.col("lat_b")) & (F.col("lng_a") < F.col("lng_b")))
    close = (F.col("lat_b") - F.col("lat_a") <= step) & (F.abs(F.col("lng_b") - F.col("lng_a")) <= step_lng)
    exact = haversine_m(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b"), radius_m) <= metres
    return probe.join(build, ["r", "c", "block"]).filter(first & close & exact).select("lat_a", "lng_a", "lat_b", "lng_b")


def near_pairs(df: DataFrame, metres: float, id: str = "pos", lat: str = "lat", lng: str = "lng", **grid) -> DataFrame:
    """All pairs of rows at most ``metres`` apart: ``id_a < id_b``, each once.

    Rows without a usable point take no part. Equal points are 0 m apart. The distance join runs over
    distinct points (``near_classes``); rows come back by equi-joins on the point, in which a point with many rows is split into blocks.
    """
    rows = cut(valid_points(df, lat, lng).select(F.col(id).alias("id"), F.col(lat).alias("lat"), F.col(lng).alias("lng")))
    pairs = cut(near_classes(point_classes(rows), metres, **grid))
    side = lambda p, x: rows.select(F.col("id").alias(p), F.col("lat").alias(f"lat{x}"), F.col("lng").alias(f"lng{x}"))
    half = blocked_join(side("p", "_a"), pairs, ["lat_a", "lng_a"], BLOCK)
    across = blocked_join(side("q", "_b"), half, ["lat_b", "lng_b"], BLOCK).select(F.least("p", "q").alias("id_a"), F.greatest("p", "q").alias("id_b"))
    same = blocked_join(side("p", ""), side("q", ""), ["lat", "lng"], BLOCK).filter(F.col("p") < F.col("q")).select(F.col("p").alias("id_a"), F.col("q").alias("id_b"))
    return across.unionByName(same)


NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"


def polygon_edges(regions: DataFrame, id: str = "area_id", wkt: str = "contorno_wkt") -> DataFrame:
    """Edges of WKT polygons and multipolygons: ``area, ring, x1, y1, x2, y2``; each ring in brackets is one, outlines and holes alike.

    Of a vertex the first two numbers count, so heights and measures are left aside. Null or unparsable text gives no edges
    (``unparsed_regions`` lists it). A ring that doesn't close is closed.
    """
    rings = regions.filter(F.upper(F.trim(F.col(wkt))).rlike("^(MULTI)?POLYGON")).select(
        F.col(id).alias("area"), F.posexplode(F.regexp_extract_all(F.col(wkt), F.lit(r"\(([^()]+)\)"), F.lit(1))).alias("ring", "text")
    )
    vertex = lambda t: F.regexp_extract_all(t, F.lit(f"({NUMBER})"), F.lit(1)).cast("array<double>")
    points = rings.select("area", "ring", F.transform(F.split("text", ","), lambda t: F.struct(F.get(vertex(t), F.lit(0)).alias("x"), F.get(vertex(t), F.lit(1)).alias("y"))).alias("p"))
    whole = points.filter((F.size("p") >= 3) & ~F.exists("p", lambda v: v["x"].isNull() | v["y"].isNull()))
    closed = whole.withColumn("p", F.when(F.get("p", F.lit(0)) == F.element_at("p", -1), F.col("p")).otherwise(F.concat("p", F.slice("p", 1, 1))))
    edges = closed.select("area", "ring", F.explode(F.arrays_zip(F.slice("p", F.lit(1), F.size("p") - 1).alias("s"), F.slice("p", F.lit(2), F.size("p") - 1).alias("e"))).alias("d"))
    return edges.select("area", "ring", F.col("d.s.x").alias("x1"), F.col("d.s.y").alias("y1"), F.col("d.e.x").alias("x2"), F.col("d.e.y").alias("y2"))


def unparsed_regions(regions: DataFrame, id: str = "area_id", wkt: str = "contorno_wkt") -> DataFrame:
    """``area`` of the regions whose text gives no edge."""
    return regions.select(F.col(id).alias("area")).join(polygon_edges(regions, id, wkt).select("area").distinct(), "area", "left_anti")


def containing_regions(
    df: DataFrame, regions: DataFrame, id: str = "pos", lat: str = "lat", lng: str = "lng",
    area: str = "area_id", wkt: str = "contorno_wkt", strip: float = 0.02, tile: float = 0.25, broadcast_edges: int = 200_000,
) -> DataFrame:
    """Rows inside regions: ``id``, ``area``; a row may lie in several regions or in none.

    Crossing parity: edges are cut into strips of latitude, distinct points meet the edges of their own strip,
    and an odd number of edges crossed by the eastward ray means inside. Holes take part in the parity.
    An edge stands in the tiles of longitude from its region's western end to its own eastern end, so the points of one
    tile meet all edges east of them of the regions that reach so far west, and a strip isn't one task.
    An edge counts from its lower end (inclusive) to its upper end (exclusive), so a ray through a corner is
    counted once and horizontal edges never. A point exactly on an outline or on the rim of a hole
    belongs to the region. Edges are straight in degrees.
    The strips' edges are broadcast only if a count shows at most ``broadcast_edges`` of them; more are joined by shuffle. A point's rows, however many,
    come back by a join that splits them. Regions that can't be parsed are reported by a warning.
    """
    bad = [r["area"] for r in unparsed_regions(regions, area, wkt).limit(11).collect()]
    if bad:
        warnings.warn(f"regions without a polygon are left out: {bad[:10]}{' and more' if len(bad) > 10 else ''}", stacklevel=2)
    edges = polygon_edges(regions, area, wkt)
    west_end = edges.groupBy("area").agg(F.min(F.least("x1", "x2")).alias("west"))
    low, high, east = F.least("y1", "y2"), F.greatest("y1", "y2"), F.greatest("x1", "x2")
    cells = edges.join(west_end, "area").withColumns({"strip": F.explode(F.sequence(F.floor(low / strip), F.floor(high / strip))), "east": east})
    strips = cells.withColumn("tile", F.explode(F.sequence(F.floor(F.col("west") / tile), F.floor(F.col("east") / tile)))).drop("west")
    strips = small(strips, broadcast_edges)
    rows = valid_points(df, lat, lng).select(F.col(id).alias("id"), F.col(lat).alias("py"), F.col(lng).alias("px"))
    points = rows.select("py", "px").distinct().withColumns({"strip": F.floor(F.col("py") / strip), "tile": F.floor(F.col("px") / tile)})
    met = points.join(strips, ["strip", "tile"]).filter(F.col("py").between(F.least("y1", "y2"), F.greatest("y1", "y2")) & (F.col("px") <= F.col("east")))
    side = (F.col("x2") - F.col("x1")) * (F.col("py") - F.col("y1")) - (F.col("px") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    touches = (side == 0) & (F.col("px") >= F.least("x1", "x2"))
    spans = (F.least("y1", "y2") <= F.col("py")) & (F.col("py") < F.greatest("y1", "y2"))
    west = F.when(F.col("y2") > F.col("y1"), side > 0).otherwise(side < 0)
    crossed = met.select("py", "px", "area", F.when(spans & west, 1).otherwise(0).alias("cross"), touches.cast("int").alias("touch")).filter((F.col("cross") == 1) | (F.col("touch") == 1))
    inside = crossed.groupBy("py", "px", "area").agg(F.sum("cross").alias("n"), F.max("touch").alias("t")).filter((F.col("n") % 2 == 1) | (F.col("t") == 1))
    return blocked_join(rows, inside.select("py", "px", "area"), ["py", "px"], BLOCK).select("id", "area")
