"""Batch heat query: candidates, statistics, optional filter and clustering, names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.operators import heat
from curbwise.session import stage


def heat_query(
    requests: DataFrame, spots: DataFrame, pois: DataFrame, addresses: DataFrame,
    level: int = heat.DEFAULT_LEVEL, radius: float = heat.DEFAULT_RADIUS_M,
    filter_by_count: bool = False, cluster: bool = False, top: int | None = None,
) -> DataFrame:
    """Every point of every request, hottest first, named, with the request's statistics.

    ``top`` keeps that many points of a request; without it all are returned.

    Statistics cover the candidates after the filter and before clustering. A
    request that finds nothing keeps one row with status 1 and info EMPTY.
    Every distinct place is answered once, under the least id that asks for it,
    and its answer handed to all requests for it at the end.
    """
    here = ["city", "lat", "lng"]
    places = stage(requests.groupBy(*here).agg(F.min("request_id").alias("asked")), "heat-asked")
    found = heat.heat_candidates(places.withColumnRenamed("asked", "request_id"), spots, level, radius)
    if filter_by_count:
        found = heat.keep_busiest_quarter(found)
    found = stage(found, "heat")
    statistics = heat.request_statistics(found)
    points = heat.clustered(found) if cluster else found
    best = heat.named(stage(heat.hottest(points, top), "hottest"), pois, addresses)
    answers = statistics.join(
        best.select("request_id", "rank", "geohash", "lat", "lng", "count", "distance", "name"), "request_id"
    ).withColumnRenamed("request_id", "asked")
    rows = requests.select("request_id", *here).join(places, here, "left").drop(*here).join(answers, "asked", "left").drop("asked")
    empty = F.col("rank").isNull()
    return rows.select(
        "*", F.when(empty, 1).otherwise(0).alias("status"), F.when(empty, "EMPTY").otherwise("OK").alias("info"),
        F.lit(float(radius)).alias("radius"),
    )
