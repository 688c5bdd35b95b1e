"""Distance joins: everything within some metres of a point, the nearest thing, and search steps.

The ellipsoid formula is a long iteration. Over a few kilometres the distance
on the ellipsoid tangent at the middle latitude differs from it by far less
than ``FLAT_SHARE``, so that flat distance, a square root and a sine, decides
all pairs that are not within that share of a limit; only those are measured.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbwise.functions.geo import (
    CHORD_REACH_M, NEAR_STEPS, WGS84_A, WGS84_F, axis_and_plane_m, near_m, with_ellipsoid_m,
)
from curbwise.session import stage

# Fixed value: the search steps of the candidate radius, in metres.
RADIUS_STEPS = (100, 150, 200, 300, 500, 1000)

#: By what share the flat distance may be off, how far it may be used (metres), and up to which latitude.
FLAT_SHARE, FLAT_REACH_M, FLAT_LATITUDE = 1e-4, 5_000.0, 85.0
#: First radius of a nearest-place search, and by how much it is widened.
FIRST_RING_M, WIDER = 125.0, 3.0

#: Rows of a grid cell that are searched together, about, as a join's buffer holds them; and pairs that they may have.
BLOCK_POINTS, BLOCK_PAIRS = 512, 8_000_000
#: Where a block lies, besides the columns the sides are joined on.
BLOCK = ["_gy", "_gx", "_block"]

# Shortest metres of one degree of latitude, less a safety margin.
_METRES_PER_DEGREE = 110_000.0
# From this latitude on all longitudes share one grid cell per row.
_POLAR = 89.0


def step_radius(nearest: Column, steps: tuple[int, ...] = RADIUS_STEPS) -> Column:
    """The smallest search step that reaches ``nearest``; NULL beyond the last."""
    choice = F.lit(None).cast("int")
    for step in reversed(steps):
        choice = F.when(nearest <= step, F.lit(step)).otherwise(choice)
    return choice


def flat_m(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    """SQL text of the distance on the tangent ellipsoid; longitudes wrap at 180 degrees."""
    e2 = WGS84_F * (2 - WGS84_F)
    middle = f"radians(({lat1} + {lat2}) / 2)"
    turn = f"({lng2} - {lng1} - 360D * floor(({lng2} - {lng1} + 180D) / 360D))"
    curve = f"(1D - {e2}D * pow(sin({middle}), 2))"
    north = f"(radians({lat2} - {lat1}) * {WGS84_A * (1 - e2)}D / {curve})"
    east = f"(radians({turn}) * {WGS84_A}D * cos({middle}))"
    return f"sqrt(({north} * {north} + {east} * {east}) / {curve})"


def _unsure(flat: Column, lat: Column, limits: Sequence[float]) -> Column:
    """Could the exact distance lie on the other side of a limit than the flat one?"""
    straddles = [(flat * (1 - FLAT_SHARE) <= limit) & (flat * (1 + FLAT_SHARE) >= limit) for limit in limits]
    straddles += [F.abs(lat) > FLAT_LATITUDE] + [F.lit(True)] * any(limit > FLAT_REACH_M for limit in limits)
    return reduce(Column.__or__, straddles)


def with_step(
    pairs: DataFrame, lat1: str, lng1: str, lat2: str, lng2: str, out: str, steps: tuple[int, ...] = RADIUS_STEPS
) -> DataFrame:
    """Add the smallest step that reaches the pair's distance, as the exact formula gives it.

    Only pairs whose flat distance is within its error of a step go through the
    formula; for the others its inputs are NULL and nothing is computed.
    """
    keep = [F.col(f"`{c}`") for c in pairs.columns]
    flat = pairs.select(*keep, F.expr(f"explode(array({flat_m(lat1, lng1, lat2, lng2)}))").alias("_flat"))
    unsure = _unsure(F.col("_flat"), F.col(lat1), steps)
    asked = flat.select(*keep, "_flat", unsure.alias("_unsure"), F.when(unsure, F.col(lat1)).alias("_at"))
    exact = with_ellipsoid_m(asked, "_at", lng1, lat2, lng2, "_exact", NEAR_STEPS)
    metres = F.when(F.col("_unsure"), F.col("_exact")).otherwise(F.col("_flat"))
    return exact.select(*keep, step_radius(metres, steps).alias(out))


def _reach(metres: float, lat: Column) -> tuple[Column, Column]:
    """Degrees of latitude and longitude that cover ``metres`` around a latitude."""
    d_lat = metres / _METRES_PER_DEGREE
    widest = F.abs(lat) + d_lat
    d_lng = F.when(widest > _POLAR, 360.0).otherwise(d_lat / F.cos(F.radians(F.least(widest, F.lit(_POLAR)))))
    return F.lit(d_lat), F.least(d_lng, F.lit(360.0))


def grid_index(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("bigint")


class Grid:
    """Cells of about some metres: rows of latitude, and columns of longitude that close at 180 degrees.

    Rows that reach into the polar caps have a single column.
    """

    def __init__(self, metres: float) -> None:
        self.height = metres / _METRES_PER_DEGREE
        self.columns = max(1, math.floor(360.0 / (self.height / math.cos(math.radians(40.0)))))
        self.width = 360.0 / self.columns

    def row(self, lat: Column) -> Column:
        return grid_index(lat, self.height)

    def polar(self, row: Column) -> Column:
        return F.greatest(F.abs(row), F.abs(row + 1)) * self.height > _POLAR

    def column(self, row: Column, lng: Column) -> Column:
        return F.when(self.polar(row), F.lit(0).cast("bigint")).otherwise(
            F.pmod(grid_index(lng + 180.0, self.width), F.lit(self.columns).cast("bigint"))
        )

    def columns_around(self, row: Column, lng: Column, d_lng: Column) -> Column:
        """The columns of a row that a point's reach meets, each once."""
        first = grid_index(lng + 180.0 - d_lng, self.width)
        last = F.least(grid_index(lng + 180.0 + d_lng, self.width), first + (self.columns - 1))
        turned = F.transform(F.sequence(first, last), lambda c: F.pmod(c, F.lit(self.columns).cast("bigint")))
        return F.when(self.polar(row), F.array(F.lit(0).cast("bigint"))).otherwise(turned)


def within_metres(
    left: DataFrame, right: DataFrame, metres: float, on: list[str],
    left_at: tuple[str, str] = ("lat", "lng"), right_at: tuple[str, str] = ("poi_lat", "poi_lng"),
    out: str = "distance", condition: Column | None = None,
) -> DataFrame:
    """Inner join of rows at most ``metres`` apart on the ellipsoid.

    The right side gets one grid cell, the left side the few cells its circle
    touches, so the join is an equi-join whose work follows local density; the
    flat distance then drops what is surely too far, and the exact one decides.
    Longitudes wrap, and near a pole all of them are looked at.
    """
    lat, lng = F.col(left_at[0]), F.col(left_at[1])
    grid = Grid(metres)
    d_lat, d_lng = _reach(metres, lat)
    probes = left.withColumn("_gy", F.explode(F.sequence(grid.row(lat - d_lat), grid.row(lat + d_lat)))).withColumn(
        "_gx", F.explode(grid.columns_around(F.col("_gy"), lng, d_lng))
    )
    homes = right.withColumn("_gy", grid.row(F.col(right_at[0]))).withColumn(
        "_gx", grid.column(F.col("_gy"), F.col(right_at[1]))
    )
    pairs = probes.join(homes, [*on, "_gy", "_gx"])
    close = F.abs(lat - F.col(right_at[0])) <= d_lat
    if metres <= FLAT_REACH_M:
        flat = F.expr(flat_m(*left_at, *right_at))
        close = close & ((F.abs(lat) > FLAT_LATITUDE) | (flat * (1 - FLAT_SHARE) <= metres))
    if condition is not None:
        close = close & condition
    near = with_ellipsoid_m(pairs.where(close).drop("_gy", "_gx"), *left_at, *right_at, out, NEAR_STEPS)
    return near.where(F.col(out) <= metres)


def _blocks_to_tasks(rows: DataFrame, where: list[str]) -> DataFrame:
    """Rows dealt out by block to a stated number of tasks, as a block's few bytes say nothing about its pairs."""
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, *where)


def within_metres_by_block(
    left: DataFrame, right: DataFrame, metres: float, on: list[str], together: list[str] | None = None,
    left_at: tuple[str, str] = ("lat", "lng"), right_at: tuple[str, str] = ("poi_lat", "poi_lng"),
    out: str = "distance",
) -> DataFrame:
    """The pairs of ``within_metres``, for many pairs: up to ``CHORD_REACH_M`` apart.

    A left row stays in its own grid cell, in one of the cell's blocks of about
    ``BLOCK_POINTS`` rows and at most ``BLOCK_PAIRS`` pairs, if not of one row; a
    right row goes to all blocks of the cells that its circle touches. So all
    pairs of a left row come out of one task, a crowded cell is many tasks, and
    a pair costs a chord.

    With ``together``, the pairs of rows that agree in these columns stay in one
    task, and the pairs keep the columns ``BLOCK`` and ``_scattered``: whether
    such rows lie in several cells, so that this does not hold for them.
    """
    if metres > CHORD_REACH_M:
        raise ValueError(f"{metres} m is too far for the chord")
    grid, where = Grid(metres), [*on, *BLOCK]
    cell = [*on, "_gy", "_gx"]

    def measured(rows: DataFrame, at: tuple[str, str], side: str) -> DataFrame:
        axis, plane = axis_and_plane_m(f"`{at[0]}`")
        return rows.withColumns({f"_axis{side}": F.expr(axis), f"_plane{side}": F.expr(plane)})

    points = left.withColumn("_gy", grid.row(F.col(left_at[0]))).withColumn(
        "_gx", grid.column(F.col("_gy"), F.col(left_at[1]))
    ).dropna(subset=cell)
    if together is not None:
        same, home = Window.partitionBy(*together), F.struct(*cell)
        points = points.withColumn("_scattered", F.min(home).over(same) != F.max(home).over(same))
    lat, lng = F.col(right_at[0]), F.col(right_at[1])
    d_lat, d_lng = _reach(metres, lat)
    places = measured(right, right_at, "2").withColumn(
        "_gy", F.explode(F.sequence(grid.row(lat - d_lat), grid.row(lat + d_lat)))
    ).withColumn("_gx", F.explode(grid.columns_around(F.col("_gy"), lng, d_lng)))

    many = points.groupBy(*cell).agg(F.count(F.lit(1)).alias("_points")).join(
        places.groupBy(*cell).agg(F.count(F.lit(1)).alias("_places")), cell
    )
    by_rows, by_pairs = F.ceil(F.col("_points") / BLOCK_POINTS), F.ceil(F.col("_points") * F.col("_places") / BLOCK_PAIRS)
    sizes = many.select(*cell, F.least("_points", F.greatest(by_rows, by_pairs)).alias("_blocks"))
    apart = together or [c for c, kind in left.dtypes if "map<" not in kind]
    points = measured(points, left_at, "1").join(sizes, cell).withColumn(
        "_block", F.pmod(F.xxhash64(*apart), "_blocks")
    ).drop("_blocks")
    places = places.join(sizes, cell).withColumn(
        "_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1))
    ).drop("_blocks")

    # The right rows stream by and each meets the left rows of its block, which the join holds in memory. The other way
    # round, the pairs of a left row come one after the other, so that sorting them stays within a little memory.
    points, places = _blocks_to_tasks(points, where), _blocks_to_tasks(places, where)
    first, second = (places, points) if together is None else (points, places)
    pairs = first.hint("merge").join(second, where)
    away = F.expr(near_m("_axis1", "_plane1", f"`{left_at[1]}`", "_axis2", "_plane2", f"`{right_at[1]}`"))
    near = pairs.where(away <= metres).withColumn(out, away)
    kept = [*left.columns, *(c for c in right.columns if c not in on)]
    return near.select(*kept, *([*BLOCK, "_scattered"] if together is not None else []), out)


def nearest_place(
    points: DataFrame, places: DataFrame, metres: float, place_id: str, carried: list[str], on: Sequence[str] = (),
    place_at: tuple[str, str] = ("place_lat", "place_lng"),
) -> DataFrame:
    """The nearest place within ``metres`` of each distinct point (lat, lng), with its ``carried`` columns.

    Distances count in whole millimetres, equal ones by ``place_id``. The search
    widens in rings: what lies within a ring's radius is nearer than anything
    beyond it, so only points that found nothing go on to the next. A crowded
    place is settled by the first ring, and wide circles are only drawn where
    there is little to find.
    """
    here = [*on, "lat", "lng"]
    rest = [c for c in carried if c != place_id]
    # Of places at the same spot only the one with the least id can be the nearest.
    first = places.groupBy(*on, *place_at).agg(F.min(F.struct(place_id, *rest)).alias("_first"))
    places = stage(first.select(*on, *place_at, "_first.*"), "nearest-places")
    order = F.struct(F.round("distance", 3).alias("distance"), place_id, *rest)
    waiting, reach, found = points.select(*here).distinct(), min(FIRST_RING_M, metres), []
    while True:
        near = within_metres(waiting, places, reach, list(on), right_at=place_at)
        found.append(stage(near.groupBy(*here).agg(F.min(order).alias("_best")), "nearest"))
        if reach >= metres:
            break
        waiting, reach = waiting.join(found[-1], here, "left_anti"), min(reach * WIDER, metres)
    best = reduce(DataFrame.unionByName, found)
    return best.select(*here, F.col("_best.distance").alias("distance"), *[F.col(f"_best.{c}").alias(c) for c in carried])
