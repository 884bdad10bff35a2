"""Digests of a layer's partitions, and what changed between two of them.

The digest of a (key, month) is its number of rows and two sums of row hashes as decimals: it does not depend on
the order of the rows, on how they are split over files, or on the order of the columns, and it adds up over parts.
A digest of the files (names, sizes, times) is cheaper: it says which partitions were rewritten at all, and
only those are read to see whether their rows changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.scratch import settle
from barloom.sources.layers import at_partitions
from barloom.spec import BarSpec

#: What a digest consists of besides the number of rows.
DIGEST_COLUMNS = ["digest", "digest_2"]


def _decimal_sum(hashed: Column, name: str) -> Column:
    return F.sum(hashed.cast("decimal(38,0)")).alias(name)


def digest_aggs(df: DataFrame, at: Sequence[str]) -> list[Column]:
    """Aggregates for the rows and the digest over all columns of ``df`` but ``at``."""
    rest = sorted(c for c in df.columns if c not in at)
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(0).cast("long")
    # Sums of hashes can agree by chance where the hashes do not; a second sum, of hashes of the hashes, would have to agree too.
    again = F.xxhash64(F.lit(1), hashed)
    return [F.count("*").alias("rows"), _decimal_sum(hashed, DIGEST_COLUMNS[0]), _decimal_sum(again, DIGEST_COLUMNS[1])]


def partition_digests(layer: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """``rows``, ``digest`` and ``digest_2`` of each (key, month). One scan, reduced on the map side."""
    at = [spec.key, spec.month]
    return layer.groupBy(*at).agg(*digest_aggs(layer, at))


def file_digests(layer: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """``files`` of each (key, month): a sum of hashes of its files' names, sizes and times. Reads the files' footers, no column."""
    at = [spec.key, spec.month]
    name = F.substring_index("_metadata.file_path", "/", -1)
    one = layer.select(*at, name.alias("name"), F.col("_metadata.file_size").alias("size"), F.unix_micros("_metadata.file_modification_time").alias("time")).distinct()
    return one.groupBy(*at).agg(_decimal_sum(F.xxhash64("name", "size", "time"), "files"))


def changed_partitions(old: DataFrame, new: DataFrame, spec: BarSpec = BarSpec(), by: Sequence[str] = ("rows", *DIGEST_COLUMNS)) -> DataFrame:
    """The (key, month) whose digests differ, with ``change``: ``changed``, ``added`` (in ``new`` only) or ``vanished`` (in ``old`` only)."""
    at = [spec.key, spec.month]
    side = lambda df, name: df.select(*at, F.struct(*by).alias(name))
    # An aggregate of both in place of an outer join: a null key is a key.
    both = side(old, "was").unionByName(side(new, "now"), allowMissingColumns=True)
    met = both.groupBy(*at).agg(F.first("was", ignorenulls=True).alias("was"), F.first("now", ignorenulls=True).alias("now"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "vanished").otherwise("changed")
    return met.where(~F.col("was").eqNullSafe(F.col("now"))).select(*at, change.alias("change"))


def layer_changes(layer: DataFrame, known: DataFrame | None, spec: BarSpec = BarSpec()) -> tuple[DataFrame, DataFrame]:
    """What changed in a layer since the digests ``known`` (all is added without any), and the digests as they are now.

    Partitions whose files are the same are not read; of the others the rows decide, so one that was rewritten
    with the same rows is no change.
    """
    at = [spec.key, spec.month]
    files = settle(file_digests(layer, spec))
    if known is None:
        now = with_files(partition_digests(layer, spec), files, spec)
        return now.select(*at, F.lit("added").alias("change")), now
    rewritten = settle(changed_partitions(known, files, spec, by=["files"]).select(*at))
    fresh = with_files(partition_digests(at_partitions(layer, rewritten, at), spec), files, spec)
    now = at_partitions(known, rewritten, at, inside=False).unionByName(fresh)
    return changed_partitions(known, now, spec), now


def with_files(digests: DataFrame, files: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """Digests of rows beside those of the files."""
    at = [spec.key, spec.month]
    both = digests.unionByName(files, allowMissingColumns=True).groupBy(*at)
    met = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("rows", *DIGEST_COLUMNS, "files")])
    return met.where("rows IS NOT NULL")
