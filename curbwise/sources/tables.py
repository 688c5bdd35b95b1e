"""Readers and writers: partitioned facts, TSV exports, staged results, documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbwise.functions.calendar import days_between, month_bounds, month_key
from curbwise.sources import schemas
from curbwise.sources.replace import gathered, replace_partitions

COORDINATE_COLUMNS = (
    "expect_start_latitude", "expect_start_longitude", "start_latitude", "start_longitude",
)

#: Partition column of the monthly exports.
MONTH = "month"
#: Written for NULL in chain files, so that an empty list stays empty.
CSV_NULL = "\\N"


class EmptyDayError(RuntimeError):
    """A day that should have orders has none."""


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.POSITIONS).parquet(path)


def scan_coordinates(
    spark: SparkSession, path: str, first_day: int, last_day: int, city: str | None = None
) -> DataFrame:
    """City and inclusive day-range scan of the fact, pruned to what mining needs.

    The day range is a static predicate on the partition column, so only those
    folders are listed; the city predicate reaches the Parquet reader.
    """
    orders = read_positions(spark, path).where(F.col("dt").between(first_day, last_day))
    if city is not None:
        orders = orders.where(F.col("city") == city)
    return orders.select("city", *COORDINATE_COLUMNS)


def write_day_partitions(positions: DataFrame, path: str) -> None:
    """Replace exactly the days present in ``positions``, leaving other days alone.

    One job covers any number of days. Rebalancing gathers each day's rows, so
    a day becomes few files, and splits a very full day by size over several
    tasks.
    """
    (
        positions.hint("rebalance", "dt")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt").parquet(path)
    )


def replace_days(positions: DataFrame, path: str, days: list[int]) -> None:
    """Replace those days as a whole: one without rows is gone afterwards, a failed job changes nothing."""
    replace_partitions(positions, path, "dt", [str(day) for day in days])


def require_days(rows: DataFrame, first_day: int, last_day: int) -> DataFrame:
    """The rows of the inclusive span; fails naming its calendar days without any row.

    One row per day of the span reaches the driver, however many orders there are.
    """
    span = rows.where(F.col("dt").between(first_day, last_day))
    missing = set(days_between(first_day, last_day)).difference(row["dt"] for row in span.select("dt").distinct().collect())
    if missing:
        raise EmptyDayError(f"no records for {', '.join(map(str, sorted(missing)))}")
    return span


def read_tsv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, null_value: str | None = None
) -> DataFrame:
    """Headerless TSV with positional types; a bad number fails the job."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST").option("sep", "\t")
    reader = reader.option("quote", "").option("emptyValue", "")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def read_tsv_months(spark: SparkSession, path: str, schema: T.StructType, months: list[int]) -> DataFrame:
    """Rows of those months from a ``write_tsv_months`` folder; other months' files are not opened."""
    rows = read_tsv(spark, path, T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType())]))
    return rows.where(F.col(MONTH).isin(months)).select(*schema.names)


def write_tsv_months(rows: DataFrame, months: list[int], keep: Column, columns: list[str], path: str) -> None:
    """Distinct projection of the months' valid rows as TSV, a folder per month, in one job; replaces ``path``."""
    month = month_key(F.col("dt"))
    kept = rows.where(month.isin(months) & keep).select(*columns, month.alias(MONTH)).distinct()
    (
        kept.hint("rebalance", MONTH).write.mode("overwrite").option("sep", "\t").option("quote", "")
        .option("emptyValue", "").partitionBy(MONTH).csv(path)
    )


def month_slice(rows: DataFrame, month: int) -> DataFrame:
    """Rows of one ``yyyymm`` month as a day-key range, so partitions prune."""
    return rows.where(F.col("dt").between(*month_bounds(month)))


def write_packed_chains(packed: DataFrame, path: str) -> None:
    """CSV lines in a folder per city; a large city is split by size."""
    packed.select(*schemas.PACKED_CHAIN.names, "city").hint("rebalance", "city").write.mode("overwrite").option(
        "escapeQuotes", "false"
    ).option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").option(
        "nullValue", CSV_NULL
    ).partitionBy("city").csv(path)


def read_packed_chains(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(T.StructType([*schemas.PACKED_CHAIN.fields, T.StructField("city", T.StringType())]))
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .option("nullValue", CSV_NULL).csv(path)
    )


def write_parquet(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def replace_city(rows: DataFrame, path: str, city: str, order: tuple[str, ...] = ()) -> None:
    """Replace one city's rows, also when the new set is empty."""
    replace_partitions(rows.where(F.col("city") == city), path, "city", [city], order)


def replace_cities(
    rows: DataFrame, path: str, cities: list[str] | None = None, order: tuple[str, ...] = ()
) -> None:
    """Replace cities in one job; a large city is split by size, files are sorted by ``order``.

    Given ``cities`` exactly those are replaced, also by nothing, and a failed
    job changes nothing; else every city present in ``rows`` is.
    """
    if cities is not None:
        replace_partitions(rows.where(F.col("city").isin(cities)), path, "city", cities, order)
        return
    (
        gathered(rows, "city", order)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("city").parquet(path)
    )


def read_city_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def publish_documents(documents: DataFrame, path: str) -> None:
    """One JSON document per line, in a folder per city."""
    documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "ignoreNullFields", "false"
    ).partitionBy("city").json(path)

