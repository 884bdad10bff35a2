"""De-duplication, validity filter, gap detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.epoch import int_div
from barloom.functions.rules import valid_bar
from barloom.operators.repeats import split_by_repeats
from barloom.operators.series import Slices, over_series
from barloom.spec import BarSpec


def dedup_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None, copies: str | None = None
) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    An aggregate and not a row number, so copies collapse before the shuffle and a key with
    very many of them stays cheap. Null keys count as equal. ``copies`` names a column for the number of
    rows that collapsed into each.
    """
    rest = [c for c in df.columns if c not in keys]
    first = [c for c in (order or []) if c in rest]
    ranked = first + [c for c in rest if c not in first]
    collapsed = [(F.count("*") - 1).alias(copies)] if copies else []
    if not rest and not copies:
        return df.distinct()
    one = df.groupBy(*keys).agg(*([F.min(F.struct(*ranked)).alias("__row")] if rest else []), *collapsed)
    columns = [F.col(c) if c in keys else F.col(f"__row.`{c}`").alias(c) for c in df.columns]
    return one.select(*columns, *([copies] if copies else []))


def dedup_bars(df: DataFrame, spec: BarSpec = BarSpec(), order: Sequence[str] | None = None) -> DataFrame:
    """One bar per (key, time)."""
    return dedup_rows(df, [spec.key, spec.time], order)


def dedup_repeated_bars(
    df: DataFrame, spec: BarSpec = BarSpec(), order: Sequence[str] | None = None
) -> DataFrame:
    """The same rows as ``dedup_bars``, for tables in which few bars or none repeat.

    Only rows from spans with a repeat are aggregated; all others go on without a shuffle.
    """
    suspect, single = split_by_repeats(df, spec)
    deduped = dedup_bars(suspect, spec, order)
    return deduped if single is None else single.unionByName(deduped)


def filter_invalid_bars(df: DataFrame, spec: BarSpec = BarSpec(), reject_nan: bool = True) -> DataFrame:
    """Keep usable bars."""
    return df.where(valid_bar(spec, reject_nan))


def _add_gaps(df: DataFrame, w: WindowSpec, spec: BarSpec) -> DataFrame:
    step = F.col(spec.time) - F.lag(spec.time).over(w)
    missing = F.coalesce(int_div(step - spec.interval_ms, spec.interval_ms), F.lit(0).cast("long"))
    return df.withColumn("gap_minutes_before", missing).withColumn(
        "has_gap_before", F.col("gap_minutes_before") > 0
    )


def detect_time_gaps(
    df: DataFrame,
    spec: BarSpec = BarSpec(),
    slices: Slices | None = None,
    months: DataFrame | None = None,
    times: DataFrame | None = None,
) -> DataFrame:
    """Count the missing bars before each bar (0 on the first) and flag where there are any.

    ``times`` may name a cheaper table with the same keys and times, duplicates allowed;
    ``months`` restricts what comes out, as in ``over_series``.
    """
    return over_series(
        df, spec, lambda d, w: _add_gaps(d, w, spec), slices, tail=1, months=months, tail_source=times
    )


def clean_bars(
    df: DataFrame,
    spec: BarSpec = BarSpec(),
    reject_nan: bool = True,
    dedup_first: bool = False,
    few_repeated: bool = False,
) -> DataFrame:
    """Filter, then de-duplicate, so a broken copy never wins over a sound one.

    ``dedup_first=True`` swaps the two: a key whose surviving copy is broken is then lost.
    ``few_repeated=True`` looks for repeated bars first and aggregates only these.
    """
    dedup = dedup_repeated_bars if few_repeated else dedup_bars
    if dedup_first:
        return filter_invalid_bars(dedup(df, spec), spec, reject_nan)
    return dedup(filter_invalid_bars(df, spec, reject_nan), spec)
