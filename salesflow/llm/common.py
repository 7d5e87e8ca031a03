"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go as soon as their job has ended, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a table in the shared folder and read it back.

    The table stands for its shuffles, whose files are freed: a long job then takes the disk of
    its largest step, not of all steps.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that no later step reads."""
    for t in tables:
        path = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def text_sample(docs: DataFrame, size: int) -> DataFrame:
    """About ``size`` different texts at most, chosen by their hash: copies and repeated or null ids count once."""
    u = F.shiftrightunsigned(F.xxhash64("text"), 11) / F.lit(float(1 << 53))
    some = docs.where(F.col("text").isNotNull() & (u < F.lit(min(1.0, size / max(docs.count(), 1)))))
    return some.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")).select("text")


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row ranges of about ``max_bytes`` of text (one row at least).

    Arrow batches are counted in rows; long documents would otherwise make the
    numpy work arrays of a batch as large as the documents are long. Those arrays
    are returned to the system after the batch.
    """
    n, start, size = batch.num_rows, 0, 0
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    for i in range(n):
        size += lengths[i] or 0
        if size >= max_bytes:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < n:
        yield batch.slice(start)
    give_back()
