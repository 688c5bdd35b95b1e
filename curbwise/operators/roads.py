"""Snap points to roads by the roads' distance and direction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.functions.geo import with_destination
from curbwise.functions.text import bearing, opposite

# Fixed value: the kind of candidate that is a road rather than a crossing.
ROAD = "road"


def only_roads(roads: DataFrame) -> DataFrame:
    return roads.where(F.col("type") == ROAD)


def snapped(rows: DataFrame) -> DataFrame:
    """Move each row's point by its road's distance, against the stated direction.

    Rows without a road keep their point.
    """
    moved = with_destination(
        rows.withColumn("_bearing", opposite(bearing(F.col("direction")))),
        "lat", "lng", "_bearing", "distance", "_to_lat", "_to_lng",
    )
    return moved.select(
        *rows.columns,
        F.coalesce("_to_lat", "lat").alias("snap_lat"), F.coalesce("_to_lng", "lng").alias("snap_lng"),
    )


def nearest_roads(roads: DataFrame) -> DataFrame:
    """The nearest road per point, by numeric distance; a partial aggregate."""
    nearest = only_roads(roads).groupBy("point_id").agg(
        F.min(F.struct("distance", "name", "direction")).alias("_r")
    )
    return nearest.select(
        "point_id", F.col("_r.name").alias("road"), F.col("_r.distance").alias("distance"),
        F.col("_r.direction").alias("direction"),
    )


def snap_to_nearest(points: DataFrame, roads: DataFrame) -> DataFrame:
    """Each point moved onto its nearest road, or unchanged without one."""
    return snapped(points.select("point_id", "lat", "lng").join(nearest_roads(roads), "point_id", "left"))


def snap_to_all(points: DataFrame, roads: DataFrame, include_intersections: bool = False) -> DataFrame:
    """One snapped point per nearby road."""
    used = roads if include_intersections else only_roads(roads)
    near = used.select("point_id", F.col("name").alias("road"), "distance", "direction", "type")
    return snapped(points.select("point_id", "lat", "lng").join(near, "point_id"))
