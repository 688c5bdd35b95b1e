"""Build the order-positions fact from raw orders and order-ext rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbwise.functions.calendar import days_between, month_bounds, month_key
from curbwise.operators.orders import (
    attach_ext, latest_rows, one_row_per_key, real_passenger, valid_ext, valid_order,
)
from curbwise.sources import schemas, tables

_FACT = [*schemas.POSITION_COLUMNS, "dt"]


def merge_days(orders: DataFrame, ext: DataFrame, first_day: int, last_day: int) -> DataFrame:
    """Latest valid row per order and day, with that day's ext coordinates.

    Any number of days is one plan: day and order id together are the key of
    both de-duplications and of the join.
    """
    keys = ["dt", "service_order_id"]
    span = F.col("dt").between(first_day, last_day)
    newest = latest_rows(
        orders.where(span & valid_order()).select(*schemas.ORDER_EXPORT.names, "update_time"),
        keys, "update_time",
    )
    newest_ext = latest_rows(
        ext.where(span & valid_ext()).select(*schemas.RAW_EXT.names), keys, "update_time"
    )
    return attach_ext(newest, newest_ext, keys).select(*_FACT)


def merge_days_to_table(orders: DataFrame, ext: DataFrame, first_day: int, last_day: int, path: str) -> None:
    """Merge and replace those days; a day of the span without a valid order fails first, before anything is written."""
    tables.require_days(orders.where(valid_order()), first_day, last_day)
    tables.replace_days(merge_days(orders, ext, first_day, last_day), path, days_between(first_day, last_day))


def merge_exports(orders: DataFrame, ext: DataFrame) -> DataFrame:
    """The same fact from monthly exports, which carry no version column.

    An order is unique within its month and takes its ext row from any day of
    that month.
    """
    keys = ["_month", "service_order_id"]
    once = one_row_per_key(orders.withColumn("_month", month_key(F.col("dt"))), keys)
    once_ext = one_row_per_key(ext.withColumn("_month", month_key(F.col("dt"))), keys)
    return attach_ext(once, once_ext, keys).select(*_FACT)


def export_months(orders: DataFrame, ext: DataFrame, months: list[int], folder: str) -> None:
    """Write the months' valid orders and ext rows as TSV: one job per table, a folder per month."""
    tables.write_tsv_months(
        orders, months, valid_order() & real_passenger(), schemas.ORDER_EXPORT.names, f"{folder}/orders"
    )
    tables.write_tsv_months(ext, months, valid_ext(), schemas.EXT_EXPORT.names, f"{folder}/ext")


def merge_tsv_to_table(spark: SparkSession, folder: str, months: list[int], path: str) -> None:
    """Load the months' TSV exports and replace all their days in the fact table, also those that have no orders any more."""
    orders = tables.read_tsv_months(spark, f"{folder}/orders", schemas.ORDER_EXPORT, months)
    ext = tables.read_tsv_months(spark, f"{folder}/ext", schemas.EXT_EXPORT, months)
    bounds = [month_bounds(month) for month in months]
    days = [day for first, last in bounds for day in range(first, last + 1)]
    tables.replace_days(merge_exports(orders, ext), path, days)
