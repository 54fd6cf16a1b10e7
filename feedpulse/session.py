"""Session settings and the shared folder that written tables live in."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark.

    A cluster run brings its own session, and nothing in the library sets a
    master. The time zone is pinned because buckets are cut in session time.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feedpulse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    find_package(spark)
    return spark


#: Rows and bytes that Python workers get at once. A batch is in memory several times, as
#: Arrow and as objects, in each worker; Spark's 10,000 whole texts fill an executor.
PYTHON_ROWS, PYTHON_BYTES = 256, 8 << 20


def bound_python_batches(spark: SparkSession) -> None:
    """Hands rows to Python in small batches, so that its memory does not grow with the input."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(PYTHON_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(PYTHON_BYTES))


def find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    For local runs out of a checkout; on a cluster the package is installed or sent
    with ``--py-files``.
    """
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, paths]))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, reachable from every executor.

    Where that is unset, folders go below the warehouse, which a cluster shares as
    well; the driver's temporary folder would not do.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        base = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").rstrip("/") + "/feedpulse-work"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
