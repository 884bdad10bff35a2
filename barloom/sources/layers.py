"""Partitioned Parquet layers."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barloom.scratch import settle
from barloom.spec import BarSpec

#: The largest list of partitions that is broadcast, by its measured bytes.
LISTED_BYTES = 32 * 1024 * 1024


def scan_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A whole layer, all symbols and months. The schema is given: nothing is inferred, neither
    from files nor from directory names."""
    return spark.read.schema(schema).parquet(path)


def unify_symbols(*frames: DataFrame) -> DataFrame:
    """Bars of several tables in one, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_layer(
    df: DataFrame, path: str, spec: BarSpec = BarSpec(), cluster: bool = False, whole: bool = False
) -> None:
    """Write by symbol and month; only the partitions present in ``df`` are replaced, when the job is done: one that fails leaves the layer as it was.

    ``whole=True`` replaces the layer: partitions that ``df`` does not have are emptied after the write. ``df`` must not read it.

    ``cluster=True`` first brings each partition's rows together, for one file per partition.
    It is a rebalance, so a partition far above the others is split over several tasks. Tables
    that come out of a series window are together already.
    """
    rows = df.hint("rebalance", spec.key, spec.month) if cluster else df
    before = _layer_files(df.sparkSession, path) if whole else None
    if before is not None:
        before = settle(before)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(spec.key, spec.month)
        .parquet(path)
    )
    if before is not None:
        # A file that was there before is in a partition that was not replaced.
        left = _layer_files(df.sparkSession, path).join(before, "file", "left_semi")
        _empty_folders(df.sparkSession, left, StructType([f for f in df.schema.fields if f.name not in (spec.key, spec.month)]))


def _layer_files(spark: SparkSession, path: str) -> DataFrame | None:
    """The files of a layer by their paths; lists, reads nothing. None if there is no such folder."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return files.select(F.col("path").alias("file"))


def _empty_folders(spark: SparkSession, files: DataFrame, schema: StructType) -> None:
    """Overwrite the folders of these files without rows, one after the other."""
    for row in files.select(F.regexp_replace("file", "/[^/]*$", "")).distinct().collect():
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(row[0])


def empty_partitions(spark: SparkSession, path: str, schema: StructType, gone: DataFrame, spec: BarSpec = BarSpec()) -> None:
    """Empty the (symbol, month) partitions that ``gone`` lists, as far as the layer has them.

    A dynamic overwrite can't: it replaces what it has rows for. Their folders are named by the
    files that a scan finds in them, and each is overwritten without rows.
    """
    at = [spec.key, spec.month]
    files = scan_layer(spark, path, schema).select(*at, F.col("_metadata.file_path").alias("file"))
    found = files.join(gone.select(*at).distinct(), at, "left_semi").select(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))).alias("file"))
    _empty_folders(spark, found, StructType([f for f in schema.fields if f.name not in at]))


def _same(columns: list[str]) -> Column:
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"__listed_{c}")) for c in columns])


def at_partitions(df: DataFrame, listed: DataFrame, columns: list[str], inside: bool = True) -> DataFrame:
    """The rows of ``df`` whose ``columns`` are in a written list, or (``inside=False``) are not; null is a value here. The list is broadcast
    if it is small by its bytes."""
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 32 for c in columns])
    size = listed.agg(F.sum(width)).first()[0] or 0
    named = listed.select(*[F.col(c).alias(f"__listed_{c}") for c in columns])
    return df.join(F.broadcast(named) if size <= LISTED_BYTES else named, _same(columns), "left_semi" if inside else "left_anti")


def _versions(spark: SparkSession, path: str) -> int | None:
    """The last version of a table, by its folders' names."""
    number = F.regexp_extract("file", r"/version=(\d+)/[^/]*$", 1).cast("int")
    files = _layer_files(spark, path)
    return None if files is None else files.agg(F.max(number)).first()[0]


def write_version(df: DataFrame, path: str) -> None:
    """Write a small table beside a layer as a new version. The one before stays as it is, so a write that fails loses nothing,
    and ``df`` may read it."""
    last = _versions(df.sparkSession, path)
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={0 if last is None else last + 1}")


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The last version of such a table; None if there is none."""
    last = _versions(spark, path)
    return None if last is None else spark.read.parquet(f"{path}/version={last}")
