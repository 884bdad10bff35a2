"""Running sums over a total order, without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.scratch import settle


def running_before(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``rows`` with the column ``name``: the sum of ``value`` over all rows before, by the columns ``order`` ascending
    with nulls last. Rows alike in ``order`` come in any order, so it should tell them apart wherever that matters.

    Rows are range-partitioned; only one sum of each partition meets in one place. The sorted rows are
    written to scratch, since ranges drawn anew could differ.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    cut = settle(rows.repartitionByRange(*keys).withColumn("__part", F.spark_partition_id()))
    totals = cut.groupBy("__part").agg(F.sum(value).alias("__sum"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__part", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return placed.join(F.broadcast(offsets), "__part").withColumn(name, F.col("__offset") + F.col("__inside")).drop("__part", "__offset", "__inside")
