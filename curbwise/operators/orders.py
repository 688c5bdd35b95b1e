"""Order cleaning: validity rules, one row per order, order-ext attachment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbwise.sources.schemas import EXT_COORDINATES

# The completed status and the mark of a test passenger.
COMPLETED_STATUS = 7
TEST_PASSENGER_MARK = "测试"

_ORDER_COORDINATES = (
    "start_latitude", "start_longitude", "expect_start_latitude", "expect_start_longitude",
)
_EXT_REQUIRED = (
    "create_order_longitude", "create_order_latitude", "arrive_latitude", "arrive_longitude",
)


def _all_positive(names: tuple[str, ...]) -> Column:
    rule = F.lit(True)
    for name in names:
        rule = rule & (F.col(name) > 0)
    return rule


def valid_order() -> Column:
    return (F.col("status") == COMPLETED_STATUS) & _all_positive(_ORDER_COORDINATES)


def valid_ext() -> Column:
    return _all_positive(_EXT_REQUIRED)


def real_passenger() -> Column:
    """Not a test passenger; like SQL's NOT LIKE, an unknown name does not pass."""
    return ~F.col("passenger_name").contains(TEST_PASSENGER_MARK)


def latest_rows(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The newest row per key; equal versions are ordered by all other columns.

    Written as row_number() = 1 so Spark keeps one row per key in each map
    task before the shuffle: a hot key never lands whole in one task.
    """
    others = [c for c in df.columns if c not in keys and c != version]
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(version), *others)
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """A single row per key, chosen by the order of all other columns."""
    order = Window.partitionBy(*keys).orderBy(*[c for c in df.columns if c not in keys])
    return df.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def attach_ext(orders: DataFrame, ext: DataFrame, keys: list[str]) -> DataFrame:
    """Orders with their ext coordinates, NULL where an order has none.

    Both sides are already partitioned by ``keys`` after de-duplication, so the
    join adds no shuffle.
    """
    return orders.join(ext.select(*keys, *EXT_COORDINATES), keys, "left")
