"""Bounding box and GeoJSON structures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The inclusive bounding box.
SOUTH, NORTH, WEST, EAST = -18.5, -8.0, -47.0, -37.0


def in_box(lat: Column, lng: Column) -> Column:
    """Whether a point is in the box, edges included; false for null and NaN."""
    return F.coalesce(lat.between(SOUTH, NORTH) & lng.between(WEST, EAST), F.lit(False))


def geo_status(lat: Column, lng: Column) -> Column:
    return F.when(in_box(lat, lng), "in_bahia").otherwise("out_of_bahia")


def feature(lat: Column, lng: Column, properties: Column) -> Column:
    """A GeoJSON feature of a point: longitude first."""
    return F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lng, lat).alias("coordinates")).alias("geometry"), properties.alias("properties"))
