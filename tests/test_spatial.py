"""Distance and containment against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartoria.operators.spatial import containing_regions, near_classes, near_pairs, point_classes, polygon_edges


def metres(a, b):
    la, lb = math.radians(a[0]), math.radians(b[0])
    h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000 * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize(("cells", "hot"), [(1, 4096), (4, 4096), (4, 2)])
def test_near_pairs_is_brute_force(spark, cells, hot):
    random.seed(cells * 10 + hot)
    points = [(i, -12 + random.uniform(0, 0.004), -38 + random.uniform(0, 0.004)) for i in range(150)]
    points += [(200 + i, -12.0, -38.0) for i in range(5)]  # copies
    rows = [*points, (900, None, -38.0), (901, float("nan"), -38.0), (902, 95.0, -38.0), (903, -12.0, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "pos long, lat double, lng double, id string").withColumn("r", F.lit(1)).withColumn("block", F.lit(2))
    got = {(r["id_a"], r["id_b"]) for r in near_pairs(df, 50, max_abs_lat=20, cells=cells, hot=hot).collect()}
    want = {(a[0], b[0]) for a in points for b in points if a[0] < b[0] and metres(a[1:], b[1:]) <= 50}
    assert got == want
    assert near_pairs(df, 50, max_abs_lat=20, cells=cells, hot=hot).count() == len(want)  # none twice


def test_point_classes_count_copies(spark):
    df = spark.createDataFrame([(1, -12.0, -38.0), (2, -12.0, -38.0), (3, -12.00001, -38.0), (4, None, None)], "pos long, lat double, lng double")
    classes = point_classes(df)
    assert sorted(r["n"] for r in classes.collect()) == [1, 2]
    assert near_classes(classes.select("lat", "lng"), 50, max_abs_lat=20).count() == 1
    assert near_pairs(df.limit(0), 50).count() == 0


SQUARE = "POLYGON((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"


@pytest.mark.parametrize(
    ("x", "y", "inside"),
    [(5, 1, True), (5, 5, False), (0, 0, True), (10, 10, True), (10, 5, True), (4, 5, True), (6, 6, True), (5, 4, True), (-1, 5, False), (11, 5, False), (5, 10, True), (5, 10.01, False), (2, 4, True), (-1, 4, False), (-1, 0, False), (11, 10, False)],
)
@pytest.mark.parametrize("few", [0, 1000])
def test_boundaries(spark, x, y, inside, few):
    points = spark.createDataFrame([(1, float(y), float(x))], "pos long, lat double, lng double")
    areas = spark.createDataFrame([(7, SQUARE), (8, None), (9, "texto"), (10, "POINT(1 1)")], "area_id long, contorno_wkt string")
    got = [r["area"] for r in containing_regions(points, areas, strip=1.5, broadcast_edges=few).collect()]
    assert got == ([7] if inside else [])


def test_containment_is_brute_force(spark):
    random.seed(4)
    star = [(math.cos(a) * r, math.sin(a) * r) for k in range(14) for a, r in [(2 * math.pi * k / 14, 3 if k % 2 else 1)]]
    wkt = "POLYGON((" + ", ".join(f"{x:.6f} {y:.6f}" for x, y in [*star, star[0]]) + "))"
    ring = [(round(x, 6), round(y, 6)) for x, y in star]

    def inside(px, py):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
                odd = not odd
        return odd

    points = [(i, random.uniform(-3.2, 3.2), random.uniform(-3.2, 3.2)) for i in range(400)]
    df = spark.createDataFrame(points, "pos long, lat double, lng double")
    areas = spark.createDataFrame([(1, wkt)], "area_id long, contorno_wkt string")
    got = {r["id"] for r in containing_regions(df, areas).collect()}
    assert got == {i for i, lat, lng in points if inside(lng, lat)}


def test_open_ring_is_closed(spark):
    areas = spark.createDataFrame([(1, "POLYGON((0 0, 1 0, 1 1))")], "area_id long, contorno_wkt string")
    assert polygon_edges(areas).count() == 3
    assert containing_regions(spark.createDataFrame([], "pos long, lat double, lng double"), areas).count() == 0


@pytest.mark.parametrize(
    "wkt", ["POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))", "POLYGON Z ((0 0 7, 4 0 7, 4 4 7, 0 4 7, 0 0 7))", "POLYGON M ((0 0 1, 4 0 2, 4 4 3, 0 4 4))", "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0)), ((10 10, 12 10, 12 12, 10 10)))"]
)
def test_dimensions_and_parts(spark, wkt):
    regions = spark.createDataFrame([(1, wkt)], "area_id long, contorno_wkt string")
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 5.0, 2.0), (3, 10.5, 11.5), (4, 2.0, 2.0), (5, 2.0, -3.0)], "pos long, lat double, lng double")
    got = {r["id"] for r in containing_regions(points, regions).collect()}
    assert got - {3} == {1, 4} and (3 in got) == wkt.startswith("MULTI")


def test_unparsed_regions_are_reported(spark):
    regions = spark.createDataFrame([(1, "POINT (1 1)"), (2, None), (3, "POLYGON ((0 0, x y, 4 4))"), (4, "POLYGON ((0 0, 4 0, 4 4))")], "area_id long, contorno_wkt string")
    points = spark.createDataFrame([(1, 1.0, 2.0)], "pos long, lat double, lng double")
    with pytest.warns(UserWarning, match="left out"):
        assert [(r["id"], r["area"]) for r in containing_regions(points, regions).collect()] == [(1, 4)]


def test_a_hot_point_is_split(spark, monkeypatch):
    from cartoria.operators import spatial

    rows = [(i, 1.0, 1.0) for i in range(30)] + [(100 + i, 1.0001, 1.0) for i in range(3)]
    df = spark.createDataFrame(rows, "pos long, lat double, lng double")
    monkeypatch.setattr(spatial, "BLOCK", 4)
    got = {(r["id_a"], r["id_b"]) for r in near_pairs(df, 50.0).collect()}
    assert len(got) == near_pairs(df, 50.0).count() == 33 * 32 // 2
