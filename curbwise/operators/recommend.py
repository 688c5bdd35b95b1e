"""From candidate chains to scored recommended points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbwise.functions import cells
from curbwise.functions.cells import FULL_PRECISION, ID_PRECISION, ROUGH_PRECISION
from curbwise.functions.geo import NEAR_STEPS, with_ellipsoid_m
from curbwise.functions.measures import mean_of_sum, weighted_sum
from curbwise.functions.text import unpack_chain
from curbwise.operators.cluster import label_arrays
from curbwise.operators.nearby import with_step
from curbwise.operators.spots import Chains, around_join

# Score smoothing, strategy tag, kinds of points.
SCORE_SMOOTHING = 3.9
STRATEGY_TAG = "AC01"
COOCCUR = "cooccur"
AROUND = "around"

# All of a point's rows share its rough cell: windows and aggregates that name
# the rough cell first reuse the partitioning of the chain join.
PLACE = ["city", "exp_rough", "exp_geohash"]
POINT = [*PLACE, "exp_lat", "exp_lng"]

_DEC = "decimal(38,0)"


def candidate_rows(chains: Chains) -> DataFrame:
    """Every expected point with each around-spot of its rough cell."""
    return around_join(chains.points, chains.around, "inner").select(*POINT, "spot", "cnt", "lat", "lng")


def unpacked_candidates(packed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidate rows and co-occurring spot arrays from the packed text form."""
    points = packed.withColumn("exp_rough", cells.prefix(F.col("exp_geohash"), ROUGH_PRECISION))
    around = points.select(*POINT, F.inline(unpack_chain(F.col("arounds")))).withColumnRenamed("geohash", "spot")
    linked = packed.select("city", "exp_geohash", F.inline(unpack_chain(F.col("cooccurs"))))
    linked = linked.withColumnRenamed("geohash", "spot").where(
        cells.prefix(F.col("spot"), ROUGH_PRECISION) == cells.prefix(F.col("exp_geohash"), ROUGH_PRECISION)
    )
    return around, linked.groupBy("city", "exp_geohash").agg(F.collect_set("spot").alias("shared"))


def mark_cooccurring(spots: DataFrame, cooccur: DataFrame) -> DataFrame:
    """Row form of the same mark: is a spot also a co-occurring one?"""
    marks = cooccur.select("city", "exp_geohash", "spot", F.lit(True).alias("_mark"))
    return spots.join(marks, ["city", "exp_geohash", "spot"], "left").withColumn(
        "tag", F.when(F.col("_mark"), COOCCUR).otherwise(AROUND)
    ).drop("_mark")


def within_step_radius(candidates: DataFrame) -> DataFrame:
    """Candidates inside the smallest search step that reaches any of them.

    The step of the nearest candidate is the least of all steps, and a
    candidate is inside a step if its own is not larger; so no distance is
    needed beyond the step it falls into.
    """
    stepped = with_step(candidates, "exp_lat", "exp_lng", "lat", "lng", "_step").where("_step IS NOT NULL")
    nearest = F.min("_step").over(Window.partitionBy(*PLACE))
    return stepped.withColumn("radius", nearest).where(F.col("_step") <= F.col("radius")).drop("_step")


def _uneven(n: Column, total: Column, squares: Column) -> Column:
    """Is the mean below the sample standard deviation? In whole numbers, so exact."""
    n, total = n.cast("decimal(10,0)"), total.cast("decimal(14,0)")
    spread = (n * squares.cast("decimal(27,0)")).cast(_DEC) - total * total
    return (n * spread.cast("decimal(28,0)")).cast(_DEC) > ((n - 1) * (total * total)).cast(_DEC)


def drop_rare_when_uneven(spots: DataFrame, keys: list[str] = PLACE) -> DataFrame:
    """Where counts vary a lot, keep the half that reaches the median."""
    whole = Window.partitionBy(*keys)
    n = F.count(F.lit(1)).over(whole)
    total = F.sum("cnt").over(whole)
    squares = F.sum((F.col("cnt").cast("decimal(13,0)") * F.col("cnt").cast("decimal(13,0)"))).over(whole)
    judged = spots.select(
        "*", _uneven(n, total, squares).alias("_uneven"), F.percentile("cnt", F.lit(0.5)).over(whole).alias("_median")
    )
    return judged.where(~F.col("_uneven") | (F.col("cnt") >= F.col("_median"))).drop("_uneven", "_median")


def cluster_spots(kept: DataFrame, shared: DataFrame) -> DataFrame:
    """Kept spots with a cluster number and their co-occurrence mark.

    A point's kept spots lie in one rough cell, at most 1,024 of them, so they
    travel as one array and the clustering needs no shuffle of its own.
    """
    arrays = kept.groupBy(*POINT, "radius").agg(
        F.sort_array(F.collect_list(F.struct("spot", "cnt", "lat", "lng"))).alias("spots")
    )
    labelled = label_arrays(arrays, "spots", "labels").join(shared, ["city", "exp_geohash"], "left")
    rows = F.transform("spots", lambda s, i: F.struct(
        s["spot"].alias("spot"), s["cnt"].alias("cnt"), s["lat"].alias("lat"), s["lng"].alias("lng"),
        F.coalesce(F.array_contains("shared", s["spot"]), F.lit(False)).alias("linked"),
        F.get(F.col("labels"), i).alias("cluster"),
    ))
    return labelled.select(*POINT, "radius", F.inline(rows))


def cluster_centres(spots: DataFrame, keys: list[str]) -> DataFrame:
    """Count-weighted centre and total count per cluster."""
    sums = spots.groupBy(*keys, "cluster").agg(
        F.sum("cnt").alias("cnt"),
        weighted_sum(F.col("lat"), F.col("cnt")).alias("_lat"),
        weighted_sum(F.col("lng"), F.col("cnt")).alias("_lng"),
        *([F.bool_or("linked").alias("linked")] if "linked" in spots.columns else []),
    )
    return sums.select(
        *[c for c in sums.columns if c not in ("_lat", "_lng")],
        mean_of_sum(F.col("_lat"), F.col("cnt")).alias("lat"),
        mean_of_sum(F.col("_lng"), F.col("cnt")).alias("lng"),
    )


def recommended_centres(spots: DataFrame) -> DataFrame:
    """Clusters as points: kind, 9-character id and distance to the expected point."""
    centres = cluster_centres(spots, [*POINT, "radius"])
    centres = centres.withColumn("kind", F.when(F.col("linked"), COOCCUR).otherwise(AROUND)).drop("linked")
    centres = with_ellipsoid_m(centres, "exp_lat", "exp_lng", "lat", "lng", "dist", NEAR_STEPS)
    full = cells.with_geohash(centres, "lat", "lng", "_full", FULL_PRECISION)
    return full.withColumn("id", cells.prefix(F.col("_full"), ID_PRECISION)).drop("_full")


def scored(centres: DataFrame, keys: list[str] = PLACE) -> DataFrame:
    """Score: count over the group's largest count plus a smoothing term."""
    top = F.max("cnt").over(Window.partitionBy(*keys))
    return centres.withColumn("score", F.round(F.col("cnt") / (top + SCORE_SMOOTHING), 6))


def annotated(points: DataFrame) -> DataFrame:
    """Add the constant bookkeeping fields of a recommended point."""
    return points.select(
        *POINT, "radius", "id", "lat", "lng", "score", F.col("cnt").alias("count"),
        F.lit(0).alias("status"), F.when(F.col("kind") == COOCCUR, COOCCUR).otherwise("").alias("ext"),
        F.lit(STRATEGY_TAG).alias("tag"), F.lit(0).alias("show"), F.lit(0).alias("pick"),
    )


POINT_FIELDS = ("id", "lat", "lng", "score", "count", "status", "ext", "tag", "show", "pick")


def by_score(points: Column) -> Column:
    """Array of points, best score first, ids breaking ties."""
    return F.array_sort(points, _score_order)


def _score_order(left: Column, right: Column) -> Column:
    return (
        F.when(left["score"] > right["score"], -1).when(left["score"] < right["score"], 1)
        .when(left["id"] < right["id"], -1).when(left["id"] > right["id"], 1).otherwise(0)
    )


def nested(points: DataFrame, run_epoch: int) -> DataFrame:
    """One row per expected point with its recommended points as an array."""
    grouped = points.groupBy(*POINT, "radius").agg(
        F.collect_list(F.struct(*POINT_FIELDS)).alias("recomms")
    )
    return grouped.select(
        "city", F.col("exp_geohash").alias("startPos"), F.col("exp_lat").alias("lat"),
        F.col("exp_lng").alias("lng"), "radius", F.size("recomms").alias("num"),
        F.lit(run_epoch).cast("bigint").alias("update"), by_score(F.col("recomms")).alias("recomms"),
    )


def flattened(recommendations: DataFrame) -> DataFrame:
    """One row per recommended point, ranked by score within its recommendation."""
    rows = recommendations.withColumnsRenamed({"lat": "exp_lat", "lng": "exp_lng"})
    return rows.select(
        *[c for c in rows.columns if c != "recomms"], F.posexplode("recomms").alias("_at", "_p")
    ).select(
        *[c for c in rows.columns if c != "recomms"], (F.col("_at") + 1).alias("rank"), "_p.*"
    )


def recommend_candidates(candidates: DataFrame, shared: DataFrame, run_epoch: int) -> DataFrame:
    """Candidate rows to nested recommendations; points without any are absent."""
    kept = drop_rare_when_uneven(within_step_radius(candidates))
    return nested(annotated(scored(recommended_centres(cluster_spots(kept, shared)))), run_epoch)


def recommend(chains: Chains, run_epoch: int) -> DataFrame:
    return recommend_candidates(candidate_rows(chains), chains.shared, run_epoch)


def with_recommendations(rows: DataFrame) -> DataFrame:
    """Only rows that recommend at least one point."""
    return rows.where(F.size("recomms") > 0)
