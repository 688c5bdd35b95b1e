"""Exact quantiles of groups of any size, without holding a group's values anywhere.

``percentile`` keeps every distinct value of a group in one buffer. Here a group
is a histogram first: its values fall into buckets a 64th of a doubling wide,
counted in each task and merged. Running counts tell which bucket holds a rank,
and only the values of those buckets are looked at again, counted by value. What
a task holds is a bounded number of buckets per group, and sorts spill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets for each doubling of a value.
FINE = 64
# More than the largest exponent of a double, so that buckets of positive values are positive.
_SHIFT = 1200 * FINE


def value_bucket(value: Column) -> Column:
    """A whole number that never falls as the value grows."""
    size = F.floor(F.log2(F.abs(value)) * FINE) + _SHIFT
    return F.when(value > 0, size).when(value < 0, -size).otherwise(0).cast("bigint")


def _running(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add ``before`` and ``upto``: the counts ``n`` of a group before and up to each row."""
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Per group the interpolated quantiles, named as in ``shares``; NULLs do not count.

    The same numbers as ``percentile``: the two values around the position
    (n - 1) * share, weighted by their distance to it.
    """
    known = rows.select(*keys, F.col(value).cast("double").alias("value")).where("value IS NOT NULL")
    known = known.withColumn("bucket", value_bucket(F.col("value")))
    histogram = _running(known.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("n")), keys, "bucket")
    histogram = histogram.withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    places = histogram.withColumn("position", F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), ((F.col("total") - 1) * F.lit(share)).alias("at")) for name, share in shares.items()
    ])))
    # Both neighbours of a position, each in the bucket that holds its rank.
    wanted = places.withColumn("rank", F.explode(F.array_distinct(F.array(
        F.floor("position.at").cast("bigint"), F.ceil("position.at").cast("bigint")
    )))).where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("upto")))
    wanted = wanted.select(
        *keys, "bucket", F.col("position.name").alias("name"), F.col("position.at").alias("at"), "rank",
        (F.col("rank") - F.col("before")).alias("place"),
    )
    asked = wanted.select(*keys, "bucket").distinct()
    same = [F.col(f"_{key}").eqNullSafe(F.col(key)) for key in keys]
    other = asked.select(*[F.col(key).alias(f"_{key}") for key in keys], F.col("bucket").alias("_bucket"))
    inside = known.join(other, [*same, F.col("_bucket") == F.col("bucket")], "left_semi")
    values = _running(inside.groupBy(*keys, "bucket", "value").agg(F.count(F.lit(1)).alias("n")), [*keys, "bucket"], "value")
    values = values.select(*[F.col(key).alias(f"_{key}") for key in keys], F.col("bucket").alias("_bucket"), "value", "before", "upto")
    found = wanted.join(values, [
        *same, F.col("_bucket") == F.col("bucket"), F.col("before") <= F.col("place"), F.col("place") < F.col("upto"),
    ])
    lower, higher = F.floor("at"), F.ceil("at")
    # A position on a rank is that rank's value.
    weight = F.when(lower == higher, 1.0).when(F.col("rank") == lower, higher - F.col("at")).otherwise(F.col("at") - lower)
    parts = found.groupBy(*keys).pivot("name", list(shares)).agg(F.sum(weight * F.col("value")))
    return parts.select(*keys, *shares)
