"""Persist named recommendations and publish them as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curbwise.operators import publish
from curbwise.sources import schemas, tables


#: Detail files are sorted by the place asked for, so that a lookup reads the row groups of its places.
DETAIL_ORDER = ("exp_geohash",)


def persist(named: DataFrame, info_path: str, detail_path: str, run_epoch: int, cities: list[str] | None = None) -> None:
    """Replace the info and detail rows of ``cities``, or of every city in ``named``."""
    tables.replace_cities(publish.info_rows(named, run_epoch), info_path, cities, ("geohash",))
    tables.replace_cities(publish.detail_rows(named, run_epoch), detail_path, cities, DETAIL_ORDER)


def persist_city(named: DataFrame, city: str, info_path: str, detail_path: str, run_epoch: int) -> None:
    """Replace one city, also when it no longer has any recommendation."""
    tables.replace_city(publish.info_rows(named, run_epoch), info_path, city, ("geohash",))
    tables.replace_city(publish.detail_rows(named, run_epoch), detail_path, city, DETAIL_ORDER)


def publish_tables(spark: SparkSession, info_path: str, detail_path: str, out: str) -> None:
    info = tables.read_city_table(spark, info_path, schemas.INFO)
    detail = tables.read_city_table(spark, detail_path, schemas.DETAIL)
    tables.publish_documents(publish.documents(info, detail), out)


def publish_results(named: DataFrame, out: str) -> None:
    tables.publish_documents(publish.documents_from_results(named), out)
