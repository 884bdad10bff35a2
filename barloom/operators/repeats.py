"""Where (key, time) repeats, without a shuffle of all keys.

Bars lie on a grid, so a span of it fits a bitmap with one bit per bar. The bitmaps are built on the
map side: what is shuffled is at most 4 KB per key, span and task in place of every (key, time). A
span with more rows than bits set, with times at different places of the grid's interval or with a missing
time may have a repeat; only the rows of such spans need a closer look.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.epoch import floor_div
from barloom.operators.series import BROADCAST_BYTES
from barloom.scratch import settle
from barloom.spec import BarSpec

# Fixed value: the number of bits of Spark's bitmaps.
_BITS = 32_768

_SPAN = "__span"


def _span(spec: BarSpec) -> Column:
    return floor_div(F.col(spec.time), _BITS * spec.interval_ms)


def _repeat_aggs(spec: BarSpec, counted: Column) -> tuple[list[Column], Column]:
    """Aggregates over the ``counted`` rows of a span, and from them whether a time may repeat there."""
    time = F.when(counted, F.col(spec.time))
    place = F.pmod(time, F.lit(spec.interval_ms))
    bit = F.pmod(floor_div(time, spec.interval_ms), F.lit(_BITS))
    aggs = [
        F.count_if(counted).alias("__rows"),
        F.bitmap_count(F.bitmap_construct_agg(bit)).alias("__seen"),
        (F.min(place) == F.max(place)).alias("__aligned"),
    ]
    sound = F.coalesce(F.col("__aligned"), F.lit(False)) & (F.col("__rows") <= F.coalesce("__seen", F.lit(0)))
    return aggs, ~sound & (F.col("__rows") > 0)


def suspect_spans(df: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """The (key, span) in which a time may repeat; every repeat is in one of them."""
    aggs, suspect = _repeat_aggs(spec, F.lit(True))
    return df.groupBy(spec.key, _span(spec).alias(_SPAN)).agg(*aggs).where(suspect).select(spec.key, _SPAN)


def span_counts(df: DataFrame, spec: BarSpec, reason: Column, at: Sequence[str] = (), more: Sequence[Column] = ()) -> DataFrame:
    """Rows of each (key, ``at``, span, ``reason``) as ``__rows_of``, and as ``suspect`` whether a time may repeat among those
    without a reason; with the ``more`` aggregates. One scan, reduced on the map side."""
    marked = df.withColumns({"reason": reason, _SPAN: _span(spec)})
    aggs, suspect = _repeat_aggs(spec, F.col("reason").isNull())
    found = marked.groupBy(spec.key, *at, _SPAN, "reason").agg(*aggs, F.count("*").alias("__rows_of"), *more)
    return found.withColumn("suspect", suspect).drop("__rows", "__seen", "__aligned")


def split_by_repeats(df: DataFrame, spec: BarSpec = BarSpec()) -> tuple[DataFrame, DataFrame | None]:
    """Rows that may repeat, and the others. Runs a job for the spans.

    Where the list of spans is too long to broadcast, all rows may repeat (and others is None).
    """
    return split_at(df, settle(suspect_spans(df, spec)), spec)


def split_at(df: DataFrame, spans: DataFrame, spec: BarSpec) -> tuple[DataFrame, DataFrame | None]:
    """Rows in the (key, span) of a written list, and the others; None if the list is too long to broadcast."""
    key_bytes = F.coalesce(F.octet_length(F.col(spec.key).cast("string")), F.lit(0)) + 64
    found = spans.agg(F.count("*").alias("spans"), F.sum(key_bytes).alias("bytes")).first()
    if not found["spans"]:
        return df.where(F.lit(False)), df
    if found["bytes"] > BROADCAST_BYTES:
        return df, None
    listed = F.broadcast(spans.select(F.col(spec.key).alias("__listed_key"), F.col(_SPAN).alias("__listed_span")))
    same = reduce(
        and_, [F.col(spec.key).eqNullSafe(F.col("__listed_key")), _span(spec).eqNullSafe(F.col("__listed_span"))]
    )
    return df.join(listed, same, "left_semi"), df.join(listed, same, "left_anti")
