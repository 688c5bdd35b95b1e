"""Tables the registered queries read: demo inputs and the pipeline's interim results.

Each is derived by Spark from the given Parquet files and staged once per
session, as the production steps do between each other. A table whose folder
is gone is derived again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbwise.operators import publish
from curbwise.operators.recommend import (
    candidate_rows, drop_rare_when_uneven, recommend, within_step_radius,
)
from curbwise.operators.spots import Chains, build_chains, cell_pairs, spot_stats, spot_table
from curbwise.operators.spots import ordered_spots as ordered
from curbwise.plans.merge import merge_days
from curbwise.plans.name import name_recommendations
from curbwise.session import staged_path, still_staged
from curbwise.sources import tables
from curbwise.sources.demo import demo_table

# The demo orders span three 28-day months.
FIRST_DAY, LAST_DAY = 20170101, 20170328
MONTHS = [201701, 201702, 201703]
RUN_EPOCH = 1491000000
NOW_EPOCH = 1500000000
# The served cities and their areas.
AREAS = {"bj": "North"}

_paths: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf: str, label: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf, label)
    if key not in _paths or not still_staged(spark, _paths[key]):
        path = staged_path(spark, label)
        write(path)
        _paths[key] = path
    return _paths[key]


def demo(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return demo_table(spark, sf, name)


def addresses(spark: SparkSession, sf: str, name: str = "address") -> DataFrame:
    return demo(spark, sf, name).withColumnRenamed("city", "address_city")


def located_addresses(spark: SparkSession, sf: str) -> DataFrame:
    where = demo(spark, sf, "request").select(F.col("request_id").alias("point_id"), "lat", "lng")
    return addresses(spark, sf).join(where, "point_id")


def positions_path(spark: SparkSession, sf: str) -> str:
    def write(path: str) -> None:
        merged = merge_days(demo(spark, sf, "order"), demo(spark, sf, "order_ext"), FIRST_DAY, LAST_DAY)
        tables.write_day_partitions(merged, path)

    return _once(spark, sf, "positions", write)


def positions(spark: SparkSession, sf: str) -> DataFrame:
    return tables.read_positions(spark, positions_path(spark, sf))


def _interim(spark: SparkSession, sf: str, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    return spark.read.parquet(_once(spark, sf, label, lambda path: tables.write_parquet(make(), path)))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _interim(spark, sf, "pairs", lambda: cell_pairs(positions(spark, sf)))


def spots(spark: SparkSession, sf: str) -> DataFrame:
    return _interim(spark, sf, "spots", lambda: spot_table(spot_stats(pairs(spark, sf))))


def ordered_spots(spark: SparkSession, sf: str) -> DataFrame:
    return _interim(spark, sf, "ordered-spots", lambda: ordered(spots(spark, sf)))


def chains(spark: SparkSession, sf: str) -> Chains:
    return build_chains(pairs(spark, sf))


def kept(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates left after the radius and median filters."""
    return _interim(spark, sf, "kept", lambda: drop_rare_when_uneven(
        within_step_radius(candidate_rows(chains(spark, sf)))
    ))


def recommendations(spark: SparkSession, sf: str) -> DataFrame:
    return _interim(spark, sf, "recommendations", lambda: recommend(chains(spark, sf), RUN_EPOCH))


def named(spark: SparkSession, sf: str) -> DataFrame:
    return _interim(spark, sf, "named", lambda: name_recommendations(
        recommendations(spark, sf), demo(spark, sf, "poi"), located_addresses(spark, sf)
    ))


def info(spark: SparkSession, sf: str) -> DataFrame:
    return _interim(spark, sf, "info", lambda: publish.info_rows(named(spark, sf), RUN_EPOCH))


def detail(spark: SparkSession, sf: str) -> DataFrame:
    return _interim(spark, sf, "detail", lambda: publish.detail_rows(named(spark, sf), RUN_EPOCH))


def cities(spark: SparkSession) -> DataFrame:
    return publish.city_dimension(spark, AREAS)


def requests(spark: SparkSession, sf: str) -> DataFrame:
    return demo(spark, sf, "request").withColumn("geohash", F.lit(None).cast("string"))
