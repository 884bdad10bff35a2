"""Shared scratch space of the session."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new path below the cluster's ``spark.checkpoint.dir``; a temporary folder only where
    that is unset and the session is local, as in a test."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(root or tempfile.mkdtemp(prefix='barloom-')).rstrip('/')}/barloom-{uuid.uuid4().hex}"


#: Shuffle files go when the query that wrote them has ended, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame) -> DataFrame:
    """Write a table that several scans will read to scratch, and scan it from there. Nothing reads
    the shuffles of that query again, so their files go with its end."""
    return settle_at(df)[0]


def settle_at(df: DataFrame) -> tuple[DataFrame, str]:
    """The same, and the path, for ``clear``."""
    spark = df.sparkSession
    path = scratch_dir(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


#: Rows that a Python worker gets at once.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs within this gives Python workers at most so many rows at once."""
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


def clear(spark: SparkSession, paths: list[str]) -> None:
    """Empty settled tables that nothing will read again."""
    for path in paths:
        spark.range(0).write.mode("overwrite").parquet(path)
