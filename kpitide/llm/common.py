"""Helpers the operators share: reading a table, cutting lineage, and Arrow columns."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kpitide.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends, and lost executors cost nothing done before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_AT_MOST = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches of a few MB between Spark and Python, unless the session says otherwise: texts are long, and a task holds several copies of a batch."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(BATCH_AT_MOST))


def released(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` of a task that gives what it held back to the system at its end: Python workers live on, beside the JVM, through the steps after it."""

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:  # glibc
            trim(0)

    return run


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this library's code, once per application, as ``--py-files`` would; and set the size of batches."""
    bounded_batches(spark)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="kpitide-code-")) / "kpitide_code.zip"  # read by the driver alone
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent).as_posix())
    spark.sparkContext.addPyFile(str(target))
