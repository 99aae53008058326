"""Shared helpers."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwise.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; also makes the operators importable on the workers."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """``session.materialize`` for payloads: the copy in the shared folder is packed
    with zstd."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def crc_bucket(column: str, modulus: int):
    """crc32 of the column's decimal text, modulo ``modulus``."""
    return F.crc32(F.col(f"`{column}`").cast("string").cast("binary")) % F.lit(modulus)


RELEASE_BYTES = 4 << 20


def release_memory() -> None:
    """Give memory that a finished task no longer needs back to the system: workers wait for
    their next task beside the executor's JVM, and a large group would stay with them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc only
    if trim is not None:
        trim(0)


def releasing(task):
    """``task`` (a function of two co-grouped tables), with its memory released when it has
    returned; groups below ``RELEASE_BYTES`` leave nothing that matters."""
    def run(left, right):
        try:
            return task(left, right)
        finally:
            if left.nbytes + right.nbytes > RELEASE_BYTES:
                release_memory()
    return run


def releasing_batches(task):
    """``task`` (a generator over batches), with its memory released behind its last batch."""
    def run(batches):
        yield from task(batches)
        release_memory()
    return run
