"""Names for recommended points from point-of-interest and address tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbwise.functions.geo import whole_mm
from curbwise.functions.text import decorated_name, name_or_fallback, trim_address
from curbwise.operators.nearby import BLOCK, nearest_place, within_metres_by_block
from curbwise.session import stage

# Type-code prefixes in order of preference, reach of a preferred
# type and of the search itself, in metres.
PREFERRED_TYPES = ("10", "99", "1507", "1505", "1508", "1506", "1504", "1502", "120302", "1903")
PREFERRED_REACH_M = 50.0
SEARCH_REACH_M = 300.0
# Fixed value: reach of the address search, in metres.
ADDRESS_REACH_M = 1000.0

_UNRANKED = 999


def type_rank(typecode: Column) -> Column:
    """Position of the first preferred prefix of a type code; NULL for none."""
    return F.coalesce(*[F.when(typecode.startswith(p), F.lit(i)) for i, p in enumerate(PREFERRED_TYPES)])


def preference(typecode: Column, distance: Column) -> Column:
    """Rank for choosing a name: preferred types within reach, then all others."""
    return F.when(distance <= PREFERRED_REACH_M, F.coalesce(type_rank(typecode), F.lit(_UNRANKED))).otherwise(
        _UNRANKED
    )


def of_preferred_type(pois: DataFrame) -> DataFrame:
    return pois.where(type_rank(F.col("typecode")).isNotNull())


def pois_around(
    points: DataFrame, pois: DataFrame, reach: float = SEARCH_REACH_M, together: list[str] | None = None
) -> DataFrame:
    """Every point of interest within reach of each point of the same city.

    ``points`` has city, lat, lng and any other columns. Candidates of points
    that agree in ``together`` are kept in one task for ``ranked_by_distance``.
    """
    places = pois.select(
        "city", "poi_id", F.col("name").alias("poi_name"), "typecode",
        F.col("lat").alias("poi_lat"), F.col("lng").alias("poi_lng"),
    )
    return within_metres_by_block(points, places, reach, ["city"], together).drop("poi_lat", "poi_lng")


def ranked_by_distance(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates with their ``place`` by distance, in whole millimetres, around each point.

    Candidates that ``pois_around`` kept together by these keys are sorted where
    they are; only those of keys with places in several cells are shuffled.
    """
    near = candidates.withColumn("distance", whole_mm(F.col("distance")))

    def placed(rows: DataFrame, *parts: str) -> DataFrame:
        order = Window.partitionBy(*keys, *parts).orderBy("distance", "poi_id")
        return rows.withColumn("place", F.row_number().over(order).cast("bigint"))

    if "_scattered" not in near.columns:
        return placed(near)
    settled, scattered = near.where(~F.col("_scattered")), near.where("_scattered")
    return placed(settled, "city", *BLOCK).unionByName(placed(scattered)).drop(*BLOCK, "_scattered")


def best_names(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """The best name per point: a preferred type close by, else the nearest.

    One partial aggregate: a point with very many candidates is reduced before
    the shuffle.
    """
    order = F.struct(
        preference(F.col("typecode"), F.col("distance")).alias("p"), "distance", "poi_id"
    )
    best = candidates.groupBy(*keys).agg(F.min(F.struct(order.alias("order"), F.col("poi_name"))).alias("_best"))
    return best.select(
        *keys, decorated_name(F.col("_best.poi_name"), F.col("_best.order.distance")).alias("name")
    )


def names_in_reach(places: DataFrame, pois: DataFrame) -> DataFrame:
    """The best name per distinct (city, lat, lng) place.

    Searched close by first: whatever lies there wins, since a preferred type
    within reach outranks anything farther and all others go by distance. Only
    places with nothing close search the full radius, and those are places where
    little lies around.
    """
    here = ["city", "lat", "lng"]
    close = stage(best_names(pois_around(places, pois, PREFERRED_REACH_M), here), "names-close")
    lonely = places.join(close, here, "left_anti")
    return close.unionByName(best_names(pois_around(lonely, pois), here))


def searched_names(places: DataFrame, pois: DataFrame) -> DataFrame:
    """The best name per distinct (city, lat, lng) place among preferred types."""
    return names_in_reach(places, of_preferred_type(pois))


def short_addresses(addresses: DataFrame) -> DataFrame:
    """Located reverse-geocode rows with their short form: (point_id, place_lat, place_lng, address)."""
    return addresses.select(
        "point_id", F.col("lat").alias("place_lat"), F.col("lng").alias("place_lng"),
        trim_address(
            F.col("formatted_address"), F.col("province"), F.col("address_city"), F.col("district"), F.col("township"),
        ).alias("address"),
    )


def nearest_addresses(places: DataFrame, addresses: DataFrame, reach: float = ADDRESS_REACH_M) -> DataFrame:
    """(lat, lng, address, point_id, distance): the nearest address within reach of each distinct place."""
    return nearest_place(places, short_addresses(addresses), reach, "point_id", ["address", "point_id"])


def address_names(points: DataFrame, addresses: DataFrame) -> DataFrame:
    """Points with the short form of their own reverse-geocode row, empty for none."""
    short = addresses.select("point_id", trim_address(
        F.col("formatted_address"), F.col("province"), F.col("address_city"),
        F.col("district"), F.col("township"),
    ).alias("_short"))
    return points.join(short, "point_id", "left").withColumn(
        "address", F.coalesce("_short", F.lit(""))
    ).drop("_short")


def _option(order: str) -> Column:
    return F.struct(
        F.col(order).alias("o"), F.col("poi_name").alias("raw"),
        decorated_name(F.col("poi_name"), F.col(f"{order}.distance")).alias("shown"),
    )


def _options(uses: DataFrame, pois: DataFrame) -> DataFrame:
    """Per distinct place: its best distinct names close by, and the nearest as a reserve.

    A point of rank r can lose at most r - 1 names to better points, so r names
    are enough for an exact choice. Only places with nothing close search the
    full radius for their reserve.
    """
    here = ["city", "lat", "lng"]
    places = stage(uses.groupBy(*here).agg(F.max("rank").alias("need")), "places")
    typed = of_preferred_type(pois)
    per_name = pois_around(places, typed, PREFERRED_REACH_M).groupBy(*here, "need", "poi_name").agg(
        F.min(F.struct(type_rank(F.col("typecode")).alias("p"), F.col("distance"), F.col("poi_id"))).alias("_best"),
        F.min(F.struct("distance", "poi_id")).alias("_near"),
    )
    at = F.row_number().over(Window.partitionBy(*here).orderBy("_best", "poi_name"))
    close = stage(per_name.withColumn("_at", at).groupBy(*here).agg(
        F.sort_array(F.collect_list(F.when(F.col("_at") <= F.col("need"), _option("_best")))).alias("options"),
        F.min(_option("_near")).alias("reserve"),
    ), "names-close")
    lonely = places.join(close, here, "left_anti")
    far = pois_around(lonely, typed).withColumn("_near", F.struct("distance", "poi_id"))
    none = F.array().cast(close.schema["options"].dataType)
    return close.unionByName(far.groupBy(*here).agg(F.min(_option("_near")).alias("reserve")).select(
        *here, none.alias("options"), "reserve"
    ))


def _pick(state: Column, point: Column) -> Column:
    """Give one point its best unused name, or its nearest one regardless."""
    free = F.filter(point["options"], lambda o: ~F.array_contains(state["used"], o["raw"]))
    raw = F.coalesce(F.get(free, F.lit(0))["raw"], point["reserve"]["raw"], F.lit(""))
    shown = F.coalesce(F.get(free, F.lit(0))["shown"], point["reserve"]["shown"], F.lit(""))
    return F.struct(
        F.array_append(state["used"], raw).alias("used"),
        F.array_append(state["named"], F.struct(point["rank"].alias("rank"), shown.alias("name"))).alias("named"),
    )


def chosen_names(uses: DataFrame, pois: DataFrame) -> DataFrame:
    """A name per (city, startPos, rank); a raw name serves one point per recommendation.

    ``uses`` has city, startPos, rank, lat, lng. Better-ranked points choose
    first. Names are searched once per distinct place, however many
    recommendations share it.
    """
    options = _options(uses, pois)
    offered = uses.join(options, ["city", "lat", "lng"], "left")
    per_recommendation = offered.groupBy("city", "startPos").agg(F.sort_array(F.collect_list(
        F.struct("rank", "options", "reserve")
    )).alias("points"))
    start = F.struct(
        F.array().cast("array<string>").alias("used"),
        F.array().cast("array<struct<rank:int,name:string>>").alias("named"),
    )
    return per_recommendation.select(
        "city", "startPos", F.inline(F.aggregate("points", start, _pick, lambda s: s["named"]))
    )


def attach_names(recommendations: DataFrame, names: DataFrame) -> DataFrame:
    """Recommendations with a name inside every point, joined by the point's rank.

    ``names`` has city, startPos, rank, name, a rank once. Ids do not tell the
    points of a recommendation apart, two of them may share a cell. Coordinates
    are rounded to six decimals as in the named form.
    """
    lists = names.groupBy("city", "startPos").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("rank").cast("int"), "name"))).alias("_names")
    )

    def named(point: Column, at: Column) -> Column:
        rest = ("score", "count", "status", "ext", "tag", "show", "pick")
        return F.struct(
            point["id"].alias("id"), F.round(point["lat"], 6).alias("lat"), F.round(point["lng"], 6).alias("lng"),
            *[point[field].alias(field) for field in rest], F.try_element_at("_names", at + 1).alias("name"),
        )

    joined = recommendations.join(lists, ["city", "startPos"], "left")
    return joined.withColumn("recomms", F.transform("recomms", named)).drop("_names")


def with_address_names(points: DataFrame, addresses: DataFrame) -> DataFrame:
    """Points (lat, lng, name) with the fallback name, from the nearest address, where they have none.

    Only the places of such points are searched.
    """
    found = F.nullif("name", F.lit(""))
    lonely = points.where(found.isNull())
    near = nearest_addresses(lonely, addresses).select("lat", "lng", "address")
    return points.join(near, ["lat", "lng"], "left").withColumn(
        "name", name_or_fallback(F.col("name"), F.col("address"))
    ).drop("address")
