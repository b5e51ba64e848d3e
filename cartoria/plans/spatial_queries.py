"""Problem 1: records near other records, and the areas that contain them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cartoria.operators.spatial import containing_regions, near_classes, near_pairs, point_classes
from cartoria.sources.tables import table

METRES = 50.0
SOUTH, NORTH, WEST, EAST = -18.5, -8.0, -47.0, -37.0


def inside_box(spark: SparkSession, directory: str) -> DataFrame:
    """The registry's records inside the bounding box; NaN, null and misplaced coordinates fall out."""
    rows = table(spark, directory, "terreiros_all_sources_v2").select("pos", "lat", "lng")
    return rows.filter(F.col("lat").between(SOUTH, NORTH) & F.col("lng").between(WEST, EAST))


def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    """``perto``: pairs of records at most 50 m apart; ``dentro``: records and the areas they are in."""
    rows = inside_box(spark, directory)
    near = near_pairs(rows, METRES, max_abs_lat=-SOUTH).select(F.lit("perto").alias("relacao"), "id_a", "id_b")
    within = containing_regions(rows, table(spark, directory, "areas_referencia")).select(F.lit("dentro").alias("relacao"), F.col("id").alias("id_a"), F.col("area").alias("id_b"))
    return near.unionByName(within)


def p1_point_classes(spark: SparkSession, directory: str) -> DataFrame:
    """One row for each distinct point: how many records stand there and how many other points are near.

    The compact form of ``perto``: it grows with the points, however many records share one.
    """
    points = point_classes(inside_box(spark, directory))
    pairs = near_classes(points.select("lat", "lng"), METRES, max_abs_lat=-SOUTH)
    ends = pairs.select(F.col("lat_a").alias("lat"), F.col("lng_a").alias("lng")).unionByName(pairs.select(F.col("lat_b").alias("lat"), F.col("lng_b").alias("lng")))
    degree = ends.groupBy("lat", "lng").agg(F.count("*").alias("near_points"))
    return points.join(degree, ["lat", "lng"], "left").select("lat", "lng", F.col("n").alias("records"), F.coalesce("near_points", F.lit(0)).alias("near_points"))


QUERIES = {"p1_found": p1_found, "p1_point_classes": p1_point_classes}

DISTANCE = "2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lng - {a}.lng) / 2), 2)))) <= 50"
BOX = "lat BETWEEN -18.5 AND -8.0 AND lng BETWEEN -47.0 AND -37.0"

SQL = {
    "p1_found": f"""
WITH r AS (SELECT pos, lat, lng FROM terreiros_all_sources_v2 WHERE {BOX}),
near AS (
  SELECT 'perto' AS relacao, least(a.pos, b.pos) AS id_a, greatest(a.pos, b.pos) AS id_b
  FROM r a JOIN r b ON b.lat BETWEEN a.lat AND a.lat + 0.00046
  WHERE (b.lat > a.lat OR b.pos > a.pos) AND {DISTANCE.format(a="a", b="b")}
),
rings AS (
  SELECT area_id, unnest(regexp_extract_all(contorno_wkt, '\\(([^()]+)\\)', 1)) AS ring FROM areas_referencia
),
vertices AS (
  SELECT area_id, ring, i, string_split(trim(string_split(ring, ',')[i]), ' ') AS v
  FROM (SELECT area_id, ring, unnest(generate_series(1, len(string_split(ring, ',')))) AS i FROM rings)
),
edges AS (
  SELECT s.area_id, s.v[1]::DOUBLE AS x1, s.v[2]::DOUBLE AS y1, e.v[1]::DOUBLE AS x2, e.v[2]::DOUBLE AS y2
  FROM vertices s JOIN vertices e ON s.area_id = e.area_id AND s.ring = e.ring AND e.i = s.i + 1
),
within AS (
  SELECT 'dentro' AS relacao, pos AS id_a, area_id AS id_b
  FROM r JOIN edges ON lat >= least(y1, y2) AND lat < greatest(y1, y2) AND lng < x1 + (lat - y1) * (x2 - x1) / (y2 - y1)
  GROUP BY pos, area_id HAVING count(*) % 2 = 1
)
SELECT * FROM near UNION ALL SELECT * FROM within""",
    "p1_point_classes": f"""
WITH p AS (SELECT lat, lng, count(*) AS records FROM terreiros_all_sources_v2 WHERE {BOX} GROUP BY lat, lng),
d AS (
  SELECT a.lat, a.lng, count(*) AS near_points FROM p a JOIN p b ON b.lat BETWEEN a.lat - 0.00046 AND a.lat + 0.00046
  WHERE (a.lat <> b.lat OR a.lng <> b.lng) AND {DISTANCE.format(a="a", b="b")} GROUP BY a.lat, a.lng
)
SELECT p.lat, p.lng, records, coalesce(near_points, 0) AS near_points FROM p LEFT JOIN d ON p.lat = d.lat AND p.lng = d.lng""",
}
