"""Info and detail tables, nested documents and batch lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbwise.functions import cells
from curbwise.functions.cells import ROUGH_PRECISION, SPOT_PRECISION
from curbwise.operators.recommend import by_score
from curbwise.sources import schemas

# What a lookup answers for an unknown place, and its codes.
NOTHING_FOUND = "no recomms"
RET_OK, RET_NO_PLACE, RET_NO_CITY = 0, -1, -2

LOOKUP_POINT = ("id", "lat", "lng", "name", "score", "count", "tag", "ext")
DOCUMENT_POINT = ("id", "lat", "lng", "name", "score", "tag")


def cast_to(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def info_rows(named: DataFrame, run_epoch: int) -> DataFrame:
    """One row per expected point."""
    return cast_to(named.select(
        F.col("startPos").alias("geohash"), "city", "regeo", "radius", "num",
        F.lit(run_epoch).alias("create_time"), F.lit(run_epoch).alias("update_time"),
    ), schemas.INFO)


def detail_rows(named: DataFrame, run_epoch: int) -> DataFrame:
    """One row per recommended point."""
    points = named.select(F.col("startPos").alias("exp_geohash"), "city", F.inline("recomms"))
    return cast_to(points.select(
        "*", F.lit(run_epoch).alias("create_time"), F.lit(run_epoch).alias("update_time")
    ), schemas.DETAIL)


def numbered(detail: DataFrame) -> DataFrame:
    """Add ``no``: 1, 2, … per city in the order of expected cell and point id.

    A city's rows are never sorted in one task. Rough cells come in the same
    order as the cells inside them, so a row's number is the running count of
    the rough cells before its own plus its place in its rough cell, which
    holds at most 1,024 expected cells.
    """
    rows = detail.withColumn("_rough", cells.prefix(F.col("exp_geohash"), ROUGH_PRECISION))
    sizes = rows.groupBy("city", "_rough").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("city").orderBy("_rough").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("city", "_rough", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("city", "_rough").orderBy("exp_geohash", "id", "lat", "lng")
    placed = rows.withColumn("_at", F.row_number().over(inside)).join(offsets, ["city", "_rough"])
    return placed.select("*", (F.col("_before") + F.col("_at")).alias("no")).drop("_rough", "_at", "_before")


def info_with_points(info: DataFrame, detail: DataFrame) -> DataFrame:
    """Info rows with each of their detail rows."""
    points = detail.select(
        "city", F.col("exp_geohash").alias("geohash"), *LOOKUP_POINT, "status", "show", "pick"
    )
    return info.join(points, ["city", "geohash"])


def nested_points(detail: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Detail rows of an expected point as one array, best score first."""
    grouped = detail.groupBy("city", F.col("exp_geohash").alias("geohash")).agg(
        F.collect_list(F.struct(*fields)).alias("recomms")
    )
    return grouped.withColumn("recomms", by_score(F.col("recomms")))


def _or_empty(points: DataFrame, fields: tuple[str, ...]) -> Column:
    kind = points.schema["recomms"].dataType
    return F.coalesce("recomms", F.array().cast(kind))


def documents(info: DataFrame, detail: DataFrame) -> DataFrame:
    """Published documents from the two tables: one join instead of a query per row."""
    points = nested_points(detail, DOCUMENT_POINT)
    joined = info.select("geohash", "city", "regeo", "radius", "num", "update_time").join(
        points, ["city", "geohash"], "left"
    )
    return joined.withColumn("recomms", _or_empty(points, DOCUMENT_POINT)).withColumnRenamed("geohash", "_id").select(
        "_id", "city", "regeo", "radius", "num", "update_time", "recomms"
    )


def documents_from_results(named: DataFrame) -> DataFrame:
    """Published documents straight from named recommendations."""
    return named.withColumnsRenamed({"startPos": "_id", "update": "update_time"}).drop("lat", "lng")


def city_dimension(spark: SparkSession, areas: dict[str, str]) -> DataFrame:
    """The cities served and the area of each: a handful of rows."""
    return spark.createDataFrame(sorted(areas.items()), "city string, area string")


def with_area(rows: DataFrame, dimension: DataFrame) -> DataFrame:
    """Rows of served cities with their area; the dimension is a fixed small list."""
    return rows.join(dimension, "city")


def request_keys(requests: DataFrame) -> DataFrame:
    """Add the cell a request asks for: its geohash cut to 8, else its coordinates.

    Only NULL or an empty geohash counts as missing.
    """
    located = cells.with_geohash(requests, "lat", "lng", "_cell", SPOT_PRECISION)
    given = F.nullif(cells.prefix(F.col("geohash"), SPOT_PRECISION), F.lit(""))
    return located.withColumn("key", F.coalesce(given, F.col("_cell"))).drop("_cell")


def asked_info(requests: DataFrame, info: DataFrame) -> DataFrame:
    """The info row of each request's cell, for requests that have one."""
    asked = request_keys(requests).select("request_id", "city", F.col("key").alias("geohash"))
    return asked.join(info, ["city", "geohash"])


def asked_details(detail: DataFrame, places: DataFrame) -> DataFrame:
    """Detail rows of the distinct (city, geohash) places."""
    wanted = places.withColumnRenamed("geohash", "exp_geohash")
    return detail.join(wanted, ["city", "exp_geohash"], "left_semi")


def lookup(
    requests: DataFrame, info: DataFrame, detail: DataFrame, cities: DataFrame, now_epoch: int
) -> DataFrame:
    """Batch recommendation lookup, with the default document where none exists.

    ``requests`` has request_id, city, lat, lng, geohash. ``cities`` lists the
    served cities and is a small dimension. Details are cut down to the places
    asked for before anything is nested.
    """
    keyed = request_keys(requests).select("request_id", "city", F.col("key").alias("geohash"))
    known = cities.select("city", F.lit(True).alias("_known")).distinct()
    places = keyed.join(known, "city", "left_semi").select("city", "geohash").distinct()
    points = nested_points(asked_details(detail, places), LOOKUP_POINT)
    found = info.withColumn("_found", F.lit(True))
    rows = keyed.join(known, "city", "left").join(found, ["city", "geohash"], "left").join(points, ["city", "geohash"], "left")
    ret = (
        F.when(F.col("geohash").isNull(), RET_NO_PLACE)
        .when(F.col("_known").isNull(), RET_NO_CITY).otherwise(RET_OK)
    )
    good = F.col("ret") == RET_OK
    hit = good & F.col("_found").isNotNull()
    now = F.lit(now_epoch).cast("int")
    return rows.withColumn("ret", ret).select(
        "request_id", "ret", "geohash", "city",
        F.when(hit, F.col("regeo")).when(good, F.lit(NOTHING_FOUND)).alias("regeo"),
        F.when(hit, F.col("radius").cast("int")).when(good, 0).alias("radius"),
        F.when(hit, F.col("num").cast("int")).when(good, 0).alias("num"),
        F.when(hit, _or_empty(points, LOOKUP_POINT)).when(
            good, F.array().cast(points.schema["recomms"].dataType)
        ).alias("recomms"),
        F.when(hit, F.col("create_time")).when(good, now).alias("create_time"),
        F.when(hit, F.col("update_time")).when(good, now).alias("update_time"),
    )
