"""Spot heat queries: counted spots around requested places, with statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbwise.functions import cells
from curbwise.functions.geo import FAR_STEPS, haversine_m, with_ellipsoid_m
from curbwise.functions.measures import describe
from curbwise.operators.cluster import label_bounded
from curbwise.operators.naming import searched_names, with_address_names
from curbwise.operators.nearby import within_metres
from curbwise.operators.recommend import cluster_centres
from curbwise.operators.quantiles import exact_quantiles
from curbwise.operators.spots import upper_quartile_bounded
from curbwise.session import stage

DEFAULT_LEVEL = 6
DEFAULT_RADIUS_M = 200.0
DEFAULT_TOP = 200


def prefix_filter(ordered: DataFrame, prefix: str) -> DataFrame:
    """Spots of an ordered table whose geohash starts with a prefix of any length.

    The prefix is a range of order ids, which the table's files are sorted by,
    so a reader opens the row groups that can have it.
    """
    first, beyond = cells.prefix_range(prefix, cells.SPOT_PRECISION)
    return ordered.where((F.col("order_id") >= first) & (F.col("order_id") < beyond))


def heat_candidates(
    requests: DataFrame, spots: DataFrame, level: int = DEFAULT_LEVEL, radius: float = DEFAULT_RADIUS_M
) -> DataFrame:
    """Spots that share a request's level cell and lie within its radius.

    Joined on grid cells of the radius, so the work per request follows the
    radius, not the size of a coarse level cell.
    """
    asked = cells.with_geohash(requests, "lat", "lng", "_prefix", level).select(
        "request_id", "city", F.col("lat").alias("req_lat"), F.col("lng").alias("req_lng"), "_prefix"
    )
    counted = spots.select("city", F.col("spot").alias("geohash"), F.col("cnt").alias("count"), "lat", "lng")
    near = within_metres(
        asked, counted, radius, ["city"], ("req_lat", "req_lng"), ("lat", "lng"),
        condition=cells.prefix(F.col("geohash"), level) == F.col("_prefix"),
    )
    return near.drop("_prefix")


def keep_busiest_quarter(candidates: DataFrame) -> DataFrame:
    """Per request, spots that reach the upper quartile of the candidates' counts; the radius bounds a request's candidates."""
    return upper_quartile_bounded(candidates.withColumnRenamed("count", "cnt"), ["request_id"]).withColumnRenamed(
        "cnt", "count"
    )


def request_statistics(candidates: DataFrame) -> DataFrame:
    """Count and distance statistics per request."""
    return candidates.groupBy("request_id").agg(
        *describe(F.col("count"), "count"), *describe(F.col("distance"), "distance")
    )


def statistics_any_size(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """The same statistics for groups of any size."""
    plain, shares = [], {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    for name in ("count", "distance"):
        value = F.col(name).cast("double")
        plain += [
            F.count(value).alias(f"{name}_count"), F.avg(value).alias(f"{name}_mean"), F.stddev_samp(value).alias(f"{name}_std"),
            F.min(value).alias(f"{name}_min"), F.max(value).alias(f"{name}_max"),
        ]
    out = candidates.groupBy(*keys).agg(*plain)
    for name in ("count", "distance"):
        quartiles = exact_quantiles(candidates, keys, name, {f"{name}_{p}": share for p, share in shares.items()})
        out = out.join(quartiles, keys, "left")
    return out


def clustered(candidates: DataFrame) -> DataFrame:
    """Per request, candidates merged into weighted cluster centres.

    Candidates are distinct cells inside the request's radius, so a group is
    bounded by geometry.
    """
    place = ["request_id", "city", "req_lat", "req_lng"]
    labels = label_bounded(candidates, ["request_id"], "geohash")
    rows = candidates.withColumnRenamed("count", "cnt").join(labels, ["request_id", "geohash"])
    centres = cluster_centres(rows, place).withColumnsRenamed({"cnt": "count", "cluster": "geohash"})
    return with_ellipsoid_m(centres, "req_lat", "req_lng", "lat", "lng", "distance", FAR_STEPS)


def by_count(candidates: DataFrame) -> DataFrame:
    """Candidates with their rank in the request, the largest count first."""
    return hottest(candidates, None)


def hottest(points: DataFrame, top: int | None = DEFAULT_TOP) -> DataFrame:
    """The points of each request ranked by count, the first ``top`` of them unless that is None."""
    order = Window.partitionBy("request_id").orderBy(F.desc("count"), "geohash")
    ranked = points.withColumn("rank", F.row_number().over(order))
    return ranked if top is None else ranked.where(F.col("rank") <= top)


def named(points: DataFrame, pois: DataFrame, addresses: DataFrame) -> DataFrame:
    """Points with the best name around them, else that of the nearest address in reach.

    Names are searched once per place, however many requests show it.
    """
    places = stage(points.select("city", "lat", "lng").distinct(), "heat-places")
    names = places.join(searched_names(places, pois), ["city", "lat", "lng"], "left")
    return points.join(with_address_names(names, addresses), ["city", "lat", "lng"], "left")


def annotate_bound(points: DataFrame, limit_m: float) -> DataFrame:
    """Great-circle distance of each point to its origin, and whether it is in bounds."""
    rows = points.withColumn("distance", haversine_m("req_lat", "req_lng", "lat", "lng"))
    return rows.withColumn("bound", F.when(F.col("distance") > limit_m, "out").otherwise("in"))
