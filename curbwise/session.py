"""Session set-up and the shared staging folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("curbwise")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


_shared: set[tuple[str, str]] = set()


def staging_root(spark: SparkSession) -> str:
    """The folder for staged tables: ``spark.checkpoint.dir`` where it is set, else one below the warehouse.

    The driver and all executors must share it, as for Spark's own checkpoints
    and tables. A mounted folder has no scheme of its own, so that the name does
    not tell; on a cluster a small table shows it, once per application.
    """
    configured = spark.conf.get(_CHECKPOINT_KEY, None)
    root = configured.rstrip("/") if configured else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged"
    key = (spark.sparkContext.applicationId, root)
    if key not in _shared and not spark.conf.get("spark.master", "").startswith("local"):
        _require_shared(spark, root)
        _shared.add(key)
    return root


def _require_shared(spark: SparkSession, root: str) -> None:
    """Raise where the driver does not see what the executors write: staged tables would lack these rows."""
    path, rows = f"{root}/probe-{uuid.uuid4().hex}", max(2, spark.sparkContext.defaultParallelism)
    spark.range(0, rows, 1, rows).write.parquet(path)
    seen = spark.read.schema("id bigint").parquet(path).count()
    _delete(spark, path)
    if seen != rows:
        raise RuntimeError(f"executors and driver do not share {root}; set {_CHECKPOINT_KEY} to a folder that they do")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_run: list[str] = []


@contextmanager
def staging_run(spark: SparkSession) -> Iterator[str]:
    """Everything staged inside the ``with`` block goes into one folder, which is deleted at its end.

    Write final results elsewhere before the block ends.
    """
    folder = f"{staging_root(spark)}/run-{uuid.uuid4().hex}"
    _run.append(folder)
    try:
        yield folder
    finally:
        _run.remove(folder)
        _delete(spark, folder)


def staged_path(spark: SparkSession, label: str) -> str:
    return f"{_run[-1] if _run else staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def still_staged(spark: SparkSession, path: str) -> bool:
    """Whether a staged table is there: a staging run takes its tables along, and scratch folders get cleared."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the table read back.

    Unlike a cache this survives lost executors without recomputing the plan
    above it, and unlike an RDD checkpoint it stays columnar, so later readers
    still prune columns and push filters down.
    """
    spark = df.sparkSession
    path = staged_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='curbwise-ship-')}/curbwise", "zip", package.parent, package.name
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
