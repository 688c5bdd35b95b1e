"""Spot counts kept up to date while order files arrive (an extension; the batch plans do not need it).

Orders are folded per day, city and start cell in the stream's state, which is
kept until the watermark has passed the day. Every micro-batch hands on the
new totals of the groups it touched, and they are upserted into a table with a
folder per day. A total only grows, so of two rows of a group the one with the
larger count is the newer one: doing a batch again, splitting the input
otherwise or starting over from the first file all end in the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curbwise.functions import cells
from curbwise.functions.measures import PICO_SUM, joined_sum, pico_degrees, pico_sums, rounded_mean
from curbwise.sources import schemas
from curbwise.sources.replace import exists, replace_partitions, settled

#: How far behind the newest order one may arrive and still be counted.
DEFAULT_DELAY = "3 days"

KEYS = ["dt", "city", "start_cell"]
DAY_COUNTS = (
    "city string, start_cell bigint, since timestamp, cnt bigint, lat_sum decimal(30,0), lng_sum decimal(30,0),"
    " batch bigint, dt int"
)


def order_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The positions table as a stream of files."""
    reader = spark.readStream.schema(schemas.POSITIONS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def day_totals(orders: DataFrame, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Orders and exact coordinate sums per day, city and start cell; the same plan for a table and a stream.

    Rows that the watermark has passed are left out of a stream.
    """
    coded = cells.with_cell(orders, "start_latitude", "start_longitude", "start_cell").where("start_cell IS NOT NULL")
    timed = coded.select(
        *KEYS, F.timestamp_seconds("start_time").alias("at"),
        pico_degrees("start_latitude").alias("lat"), pico_degrees("start_longitude").alias("lng"),
    ).withWatermark("at", delay)
    folded = timed.groupBy(F.window("at", "1 day").alias("_day"), *KEYS).agg(
        F.count(F.lit(1)).alias("cnt"), *pico_sums("lat"), *pico_sums("lng")
    )
    return folded.select(
        *KEYS, F.col("_day.start").alias("since"), "cnt",
        joined_sum("lat").alias("lat_sum"), joined_sum("lng").alias("lng_sum"),
    )


def upsert_days(totals: DataFrame, path: str, batch: int) -> None:
    """Put the totals of a batch into their days' folders; groups the batch does not have keep their rows.

    Only the days of the batch are read and replaced, each as a whole.
    """
    spark = totals.sparkSession
    days = sorted(row["dt"] for row in totals.select("dt").distinct().collect())
    if not days:
        return
    new = totals.withColumn("batch", F.lit(batch).cast("bigint"))
    old = read_day_counts(spark, path).where(F.col("dt").isin(days))
    merged = new.unionByName(old).groupBy(*KEYS, "since").agg(
        F.max(F.struct("cnt", "batch", "lat_sum", "lng_sum")).alias("_newest")
    )
    rows = merged.select(*KEYS, "since", "_newest.*")
    replace_partitions(rows, path, "dt", [str(day) for day in days])


def read_day_counts(spark: SparkSession, path: str) -> DataFrame:
    """The upserted table; empty before the first batch."""
    if not exists(spark, path):
        return spark.createDataFrame([], DAY_COUNTS)
    return spark.read.schema(DAY_COUNTS).parquet(settled(spark, path))


def keep_counting(
    orders: DataFrame, path: str, checkpoint: str, delay: str = DEFAULT_DELAY, available_now: bool = True
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it stops when all present files are counted."""
    writer = day_totals(orders, delay).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(lambda totals, batch: upsert_days(totals, path, batch)).start()


def spots_of_days(counts: DataFrame) -> DataFrame:
    """Spot statistics per day from the table of totals: (dt, city, start_cell, cnt, lat, lng)."""
    total = counts.groupBy(*KEYS).agg(
        F.sum("cnt").alias("cnt"), F.sum("lat_sum").cast(PICO_SUM).alias("_lat"), F.sum("lng_sum").cast(PICO_SUM).alias("_lng")
    )
    return total.select(*KEYS, "cnt", rounded_mean("_lat", "cnt").alias("lat"), rounded_mean("_lng", "cnt").alias("lng"))
