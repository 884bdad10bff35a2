"""Bounds of sane values, from the data itself.

A quantile sketch (KLL, Spark's own) of each column is kept per key and month: a few KB whatever the number of rows. Sketches merge, so the
bounds of a key come from its months' sketches without reading the bars again, and a refresh replaces the sketches of
the months it touches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.scratch import settle
from barloom.sources.layers import LISTED_BYTES
from barloom.spec import BarSpec

#: The sketch's size: a quantile's rank is off by 0.35 percent of the rows at most, at 99 percent of sketches.
SKETCH_K = 800
RANK_ERROR = 0.0035


def _finite(name: str) -> Column:
    x = F.col(name).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def quantile_sketches(df: DataFrame, columns: Sequence[str], spec: BarSpec = BarSpec(), k: int = SKETCH_K) -> DataFrame:
    """``{column}_sketch`` of each (key, month), over its finite values. One scan, reduced on the map side."""
    return df.groupBy(spec.key, spec.month).agg(*[F.kll_sketch_agg_double(_finite(c), k).alias(f"{c}_sketch") for c in columns])


def merged_sketches(sketches: DataFrame, columns: Sequence[str], spec: BarSpec = BarSpec(), k: int = SKETCH_K) -> DataFrame:
    """The sketches of each key over all its months."""
    return sketches.groupBy(spec.key).agg(*[F.kll_merge_agg_double(f"{c}_sketch", k).alias(f"{c}_sketch") for c in columns])


def bounds_from_quantiles(
    sketches: DataFrame, columns: Sequence[str], spec: BarSpec = BarSpec(), low: float = 0.01, high: float = 0.99, spread: float = 3.0
) -> DataFrame:
    """Per key ``{column}_low`` and ``{column}_high``: the quantiles ``low`` and ``high``, moved apart by ``spread`` times the distance
    between them. Null where a key has no finite value."""

    def quantile(c: str, q: float) -> Column:
        sketch = F.col(f"{c}_sketch")
        return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(q)))

    out = merged_sketches(sketches, columns, spec).select(spec.key, *[quantile(c, q).alias(f"__{c}_{n}") for c in columns for n, q in (("low", low), ("high", high))])
    for c in columns:
        a, b = F.col(f"__{c}_low"), F.col(f"__{c}_high")
        out = out.withColumns({f"{c}_low": a - spread * (b - a), f"{c}_high": b + spread * (b - a)})
    return out.select(spec.key, *[f"{c}_{n}" for c in columns for n in ("low", "high")])


def out_of_bounds_by_key(df: DataFrame, bounds: DataFrame, columns: Sequence[str], spec: BarSpec = BarSpec()) -> DataFrame:
    """Per key ``out_of_bounds_{column}``: how many values lie outside the key's bounds; a NaN lies above all, a null counts nowhere."""
    listed = settle(bounds)
    width = F.coalesce(F.octet_length(F.col(spec.key).cast("string")), F.lit(0)) + 32 + 16 * len(columns)
    named = listed.withColumnRenamed(spec.key, "__bound_key")
    small = (listed.agg(F.sum(width)).first()[0] or 0) <= LISTED_BYTES
    joined = df.select(spec.key, *columns).join(F.broadcast(named) if small else named, F.col(spec.key).eqNullSafe(F.col("__bound_key")), "left")
    outside = [F.count_if(~F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high"))).alias(f"out_of_bounds_{c}") for c in columns]
    return joined.groupBy(spec.key).agg(*outside)


def rank_errors(df: DataFrame, bounds: DataFrame, column: str, low: float, high: float, spec: BarSpec = BarSpec()) -> DataFrame:
    """Per key ``rows`` and how far the ranks of the bounds (of ``spread`` 0) are from ``low`` and ``high``, as shares of the rows:
    ``{column}_low_error``, ``{column}_high_error``. A rank is a stretch where values repeat; the nearest end of it counts."""
    both = df.select(spec.key, column).join(bounds, spec.key)
    x = F.col(column)

    def error(end: str, q: float) -> Column:
        bound = F.col(f"{column}_{end}")
        below, upto = F.count_if(x < bound) / F.count(x), F.count_if(x <= bound) / F.count(x)
        return F.greatest(below - q, q - upto, F.lit(0.0)).alias(f"{column}_{end}_error")

    return both.groupBy(spec.key).agg(F.count("*").alias("rows"), error("low", low), error("high", high))


def worst(errors: DataFrame) -> Column:
    """The largest of the errors of a row."""
    return reduce(F.greatest, [F.col(c) for c in errors.columns if c.endswith("_error")])
