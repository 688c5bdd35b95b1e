"""Density clustering with a minimum of one sample.

Every point is then a core point, so a cluster is a connected component of the
graph that links points at most ``reach`` metres apart. A label is the
position (or the id) of the component's first point in id order.

``label_arrays`` and ``label_bounded`` are for groups that geometry keeps small;
``label_points`` is for groups of any size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.functions.geo import WGS84_A, WGS84_B, WGS84_F
from curbwise.operators.nearby import grid_index, within_metres
from curbwise.session import ship_package, stage

CLUSTER_REACH_M = 30.0

# Longest metres of one degree, a little more than anywhere on the ellipsoid.
_DEGREE_M = 111_700.0

# Candidate pairs examined at once inside a Python worker.
_PAIR_BUDGET = 2_000_000


def _distances(lat1, lng1, lat2, lng2) -> np.ndarray:
    """Vincenty distances of close point pairs, vectorised."""
    u1, u2 = (np.arctan((1 - WGS84_F) * np.tan(np.radians(v))) for v in (lat1, lat2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    dl = np.radians(lng2 - lng1)
    lam = dl
    for last in (False, False, False, True):
        across = c2 * np.sin(lam)
        along = c1 * s2 - s1 * c2 * np.cos(lam)
        ss = np.maximum(np.hypot(across, along), 1e-300)
        cs = s1 * s2 + c1 * c2 * np.cos(lam)
        sigma = np.arctan2(ss, cs)
        sa = c1 * across / ss
        ca = np.maximum(1 - sa * sa, 1e-300)
        mid = cs - 2 * s1 * s2 / ca
        if not last:
            big_c = WGS84_F / 16 * ca * (4 + WGS84_F * (4 - 3 * ca))
            lam = dl + (1 - big_c) * WGS84_F * sa * (
                sigma + big_c * ss * (mid + big_c * cs * (2 * mid * mid - 1))
            )
    u_sq = ca * (WGS84_A**2 - WGS84_B**2) / WGS84_B**2
    big_a = 1 + u_sq / 16384 * (4096 + u_sq * (-768 + u_sq * (320 - 175 * u_sq)))
    big_b = u_sq / 1024 * (256 + u_sq * (-128 + u_sq * (74 - 47 * u_sq)))
    correction = big_b * ss * (mid + big_b / 4 * (
        cs * (2 * mid * mid - 1) - big_b / 6 * mid * (4 * ss * ss - 3) * (4 * mid * mid - 3)
    ))
    return WGS84_B * big_a * (sigma - correction)


def _links(group, lat, lng, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one group's points within reach, by a sweep over latitude."""
    order = np.lexsort((lat, group))
    g, y, x = group[order], lat[order], lng[order]
    band = reach / 110_000.0
    # One sorted key for (group, latitude): groups sit 1,000 degrees apart.
    key = g * 1000.0 + y
    ahead = np.searchsorted(key, key + band, side="right") - np.arange(len(g)) - 1
    starts, total = np.cumsum(ahead) - ahead, int(ahead.sum())
    a = np.repeat(np.arange(len(g)), ahead)
    b = a + 1 + np.arange(total) - np.repeat(starts, ahead)
    widest = np.minimum(np.abs(y[a]) + band, 89.0)
    close = np.abs(x[a] - x[b]) <= band / np.cos(np.radians(widest))
    a, b = a[close], b[close]
    near = _distances(y[a], x[a], y[b], x[b]) <= reach
    return order[a[near]], order[b[near]]


def component_labels(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member index of each index's component."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        # Also lower the labels' own owners, then jump to the root.
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _batch_labels(lats: list, lngs: list, reach: float) -> list[np.ndarray]:
    """Labels for several groups at once, each relative to its group's start."""
    sizes = np.array([len(v) for v in lats])
    offsets = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(sizes)), sizes)
    a, b = _links(group, np.concatenate(lats), np.concatenate(lngs), reach)
    label = component_labels(int(sizes.sum()), a, b) - offsets[group]
    return np.split(label, offsets[1:])


def _labels_udf(reach: float):
    @F.pandas_udf("array<int>")
    def labels(lats: pd.Series, lngs: pd.Series) -> pd.Series:
        out: list = []
        held: list[int] = []
        work = 0
        for i, values in enumerate(lats):
            held.append(i)
            work += len(values) ** 2
            if work >= _PAIR_BUDGET or i == len(lats) - 1:
                out += _batch_labels([lats[j] for j in held], [lngs[j] for j in held], reach)
                held, work = [], 0
        return pd.Series(out)

    return labels


def label_arrays(groups: DataFrame, spots: str, out: str, reach: float = CLUSTER_REACH_M) -> DataFrame:
    """Add an array of cluster labels beside each row's array of spots.

    One row is one whole group, so an Arrow batch labels many groups in a few
    vectorised steps. Use it where groups are known to be small.
    """
    ship_package(groups.sparkSession)
    labels = _labels_udf(reach)
    return groups.withColumn(out, labels(F.col(f"{spots}.lat"), F.col(f"{spots}.lng")))


def label_bounded(
    points: DataFrame, keys: list[str], point_id: str = "spot", reach: float = CLUSTER_REACH_M
) -> DataFrame:
    """Cluster label of every point, for groups of distinct cells inside a few hundred metres.

    Returns keys, the point id and ``cluster``, the smallest id of its cluster.
    """
    grouped = points.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(point_id, "lat", "lng"))).alias("_spots")
    )
    labelled = label_arrays(grouped, "_spots", "_labels", reach)
    each = F.transform("_spots", lambda s, i: F.struct(
        s[point_id].alias(point_id), F.get(F.col("_spots"), F.get(F.col("_labels"), i))[point_id].alias("cluster")
    ))
    return labelled.select(*keys, F.inline(each))


def neighbour_links(points: DataFrame, keys: list[str], point_id: str, reach: float) -> DataFrame:
    """Both directions of every link between two points of a group within reach.

    Points of a group are distinct precision-8 cells, of which a circle of
    30 m meets only a handful, so links grow linearly with the points.
    """
    other = points.select(
        *keys, F.col(point_id).alias("other"), F.col("lat").alias("other_lat"), F.col("lng").alias("other_lng")
    )
    near = within_metres(
        points.select(*keys, point_id, "lat", "lng"), other, reach, keys,
        right_at=("other_lat", "other_lng"), condition=F.col(point_id) < F.col("other"),
    )
    forth = near.select(*keys, point_id, "other", "distance")
    back = near.select(
        *keys, F.col("other").alias(point_id), F.col(point_id).alias("other"), "distance"
    )
    return forth.unionByName(back)


def _with_node_cell(points: DataFrame, reach: float) -> DataFrame:
    """Add ``_cell``: a grid cell so small that any two points of it are within reach.

    A row's columns are as wide as its side nearest to the equator allows.
    """
    side = 0.99 * reach / math.sqrt(2)
    height = side / _DEGREE_M
    row = grid_index(F.col("lat"), height)
    widest = F.when(row >= 0, row).otherwise(-row - 1) * height
    columns = F.greatest(F.ceil(F.cos(F.radians(widest)) * (360.0 * _DEGREE_M / side)), F.lit(1))
    column = F.least(F.floor((F.col("lng") + 180.0) / 360.0 * columns), columns - 1)
    return points.withColumn("_cell", row * (1 << 32) + column)


def _spread(nodes: DataFrame, links: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, node, cluster): the smallest node of each node's component, by spreading with jumps.

    Each round offers the smallest label around a node to the node and to the
    owner of its present label, then replaces every label by that label's own.
    Offering to owners joins whole clusters at once, so even a long chain takes
    a number of rounds near the logarithm of its length. Rounds are staged
    tables: lineage stays short and a lost executor costs one round at most.
    """
    labels = nodes.select(*keys, "node", F.col("node").alias("cluster"))
    while True:
        seen = labels.select(*keys, F.col("node").alias("other"), F.col("cluster").alias("_near"))
        lowest = links.join(seen, [*keys, "other"]).groupBy(*keys, "node").agg(F.min("_near").alias("_near"))
        joined = labels.join(lowest, [*keys, "node"], "left")
        offer = F.least("cluster", "_near").alias("_new")
        to_self = joined.select(*keys, "node", F.col("cluster").alias("_old"), offer)
        to_owner = joined.where(F.col("_near") < F.col("cluster")).select(
            *keys, F.col("cluster").alias("node"), F.lit(None).cast(nodes.schema["node"].dataType).alias("_old"), offer
        )
        spread = stage(to_self.unionByName(to_owner).groupBy(*keys, "node").agg(
            F.max("_old").alias("_old"), F.min("_new").alias("_new")
        ), "cluster-spread")
        owners = spread.select(*keys, F.col("node").alias("_new"), F.col("_new").alias("_root"))
        jumped = stage(spread.join(owners, [*keys, "_new"]).select(
            *keys, "node", "_old", F.least("_new", "_root").alias("cluster")
        ), "cluster-labels")
        labels = jumped.select(*keys, "node", "cluster")
        if jumped.where(F.col("_old") != F.col("cluster")).isEmpty():
            return labels


def label_points(
    points: DataFrame, keys: list[str], point_id: str = "spot", reach: float = CLUSTER_REACH_M
) -> DataFrame:
    """Cluster label of every point within its group; groups may have any size and density.

    Returns keys, the point id and ``cluster``, the smallest id of its cluster.
    Points of a grid cell whose diagonal is within reach are one node without
    looking at any pair; only pairs in different cells are tested, equal
    places once, and labels spread over the nodes. The plan is the same at
    every size.
    """
    placed = _with_node_cell(points.select(*keys, point_id, "lat", "lng"), reach)
    firsts = placed.groupBy(*keys, "_cell").agg(F.min(point_id).alias("node"))
    placed = stage(placed.join(firsts, [*keys, "_cell"]).drop("_cell"), "cluster-points")
    places = placed.groupBy(*keys, "lat", "lng").agg(F.min("node").alias("node"))
    others = places.select(*keys, F.col("lat").alias("other_lat"), F.col("lng").alias("other_lng"), F.col("node").alias("other"))
    near = within_metres(
        places, others, reach, keys, right_at=("other_lat", "other_lng"), condition=F.col("node") < F.col("other")
    ).select(*keys, "node", "other").distinct()
    near = stage(near, "cluster-links")
    links = near.unionByName(near.select(*keys, F.col("other").alias("node"), F.col("node").alias("other")))
    labels = _spread(placed.select(*keys, "node").distinct(), links, keys)
    return placed.join(labels, [*keys, "node"]).select(*keys, point_id, "cluster")
