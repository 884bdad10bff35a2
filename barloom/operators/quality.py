"""Data quality of a bar table, as DataFrames.

``quality_profile`` reduces the table to one small row per key; completeness, continuity, the
totals and the status all derive from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.epoch import int_div
from barloom.functions.rules import drop_reason, invalid_price
from barloom.operators.repeats import split_by_repeats
from barloom.operators.series import Slices, over_series
from barloom.scratch import settle
from barloom.spec import BarSpec

# Completeness ratios below these fail or warn.
FAIL_BELOW = 0.90
WARN_BELOW = 0.98

_GAP, _HAS_GAP = "gap_minutes_before", "has_gap_before"


def present_fields(df: DataFrame, spec: BarSpec) -> list[str]:
    """The key fields that the table has; only these are checked for nulls."""
    return [f for f in spec.key_fields if f in df.columns]


def skipped_fields(df: DataFrame, spec: BarSpec = BarSpec()) -> list[str]:
    """The key fields that the table does not have."""
    return [f for f in spec.key_fields if f not in df.columns]


def _null_aggs(df: DataFrame, spec: BarSpec) -> list[Column]:
    return [F.count_if(F.col(f).isNull()).alias(f"null_{f}") for f in present_fields(df, spec)]


def null_counts(df: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """One row, ``null_{field}`` for every key field that the table has."""
    return df.agg(*_null_aggs(df, spec))


def invalid_price_count(df: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """One row: how many bars have a price that cannot be."""
    return df.agg(F.count_if(invalid_price(spec, df.columns)).alias("invalid_price_count"))


def duplicate_keys(df: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """Every (key, time) that occurs more than once, with its number of rows."""
    return df.groupBy(spec.key, spec.time).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def _extent(spec: BarSpec) -> list[Column]:
    return [
        F.count("*").alias("actual_rows"),
        F.min(spec.time).alias(f"min_{spec.time}"),
        F.max(spec.time).alias(f"max_{spec.time}"),
    ]


def _with_ratio(df: DataFrame, spec: BarSpec) -> DataFrame:
    span = F.col(f"max_{spec.time}") - F.col(f"min_{spec.time}")
    return df.withColumn(
        "expected_rows", int_div(span + spec.interval_ms, spec.interval_ms)
    ).withColumn("completeness_ratio", F.try_divide(F.col("actual_rows"), F.col("expected_rows")).cast("double"))


def completeness(df: DataFrame, spec: BarSpec = BarSpec(), by: Sequence[str] = ()) -> DataFrame:
    """Actual and expected bars between first and last, per key, and per ``by`` such as a date."""
    return _with_ratio(df.groupBy(spec.key, *by).agg(*_extent(spec)), spec)


def _gap_aggs() -> list[Column]:
    return [
        F.sum(_GAP).alias("total_missing_minutes"),
        F.sum(F.col(_HAS_GAP).cast("long")).alias("gap_events"),
    ]


def continuity(df: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """Missing bars and number of gaps per key; no rows where the table has no gap columns."""
    if _GAP not in df.columns:
        return df.select(
            spec.key, F.lit(0).cast("long").alias("total_missing_minutes"), F.lit(0).cast("long").alias("gap_events")
        ).where(F.lit(False))
    return df.groupBy(spec.key).agg(*_gap_aggs())


def reconcile_counts(raw: DataFrame, refined: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """Rows per key in both layers and how many were dropped between them."""
    before = raw.groupBy(spec.key).agg(F.count("*").alias("raw_rows"))
    after = refined.groupBy(spec.key).agg(F.count("*").alias("refined_rows"))
    return (
        before.join(after, spec.key, "full_outer")
        .fillna(0, subset=["raw_rows", "refined_rows"])
        .withColumn("dropped_rows", F.col("raw_rows") - F.col("refined_rows"))
    )


def reconcile_daily(raw: DataFrame, refined: DataFrame, spec: BarSpec = BarSpec(), day: str = "date") -> DataFrame:
    """Daily rows and volume in both layers, side by side."""

    def daily(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(spec.key, day).agg(
            F.count("*").alias(f"{name}_rows"), F.sum(spec.volume).alias(f"{name}_volume")
        )

    return (
        daily(raw, "raw")
        .join(daily(refined, "refined"), [spec.key, day], "full_outer")
        .fillna(0, subset=["raw_rows", "refined_rows"])
        .withColumn("dropped_rows", F.col("raw_rows") - F.col("refined_rows"))
    )


def drop_reasons(raw: DataFrame, spec: BarSpec = BarSpec(), reject_nan: bool = True) -> DataFrame:
    """How many rows of each key the validity filter drops, by the first rule they break."""
    return (
        raw.withColumn("reason", drop_reason(spec, reject_nan))
        .where(F.col("reason").isNotNull())
        .groupBy(spec.key, "reason")
        .agg(F.count("*").alias("dropped_rows"))
    )


def non_monotonic_times(df: DataFrame, arrival: str, spec: BarSpec = BarSpec(), slices: Slices | None = None) -> DataFrame:
    """Per key ``non_monotonic``: how many rows have a time that is not above the highest one before them in the order of ``arrival``, and
    ``rows``. ``arrival`` is a whole number that sorts as the rows came and does not repeat within a key; ``slices`` cut along it.

    A missing time does not count, and does not raise the highest. A long series is cut, with the highest time so far carried from slice to
    slice, so no task gets all rows of a key.
    """
    highest = "__highest"

    def add(rows: DataFrame, window: WindowSpec) -> DataFrame:
        before = F.max(highest).over(window.rowsBetween(Window.unboundedPreceding, -1))
        return rows.withColumn("late", F.coalesce(F.col(spec.time) <= before, F.lit(False)))

    narrow = df.select(spec.key, F.col(arrival).cast("long").alias("__arrival"), spec.time)
    along = replace(spec, time="__arrival", interval_ms=1)
    marked = over_series(narrow, along, add, slices, highest={highest: F.col(spec.time)})
    return marked.groupBy(spec.key).agg(F.count_if("late").alias("non_monotonic"), F.count("*").alias("rows"))


def out_of_bounds_count(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """One row: per column of ``bounds``, how many values lie outside [low, high]."""
    return df.agg(
        *[F.count_if(~F.col(c).between(lo, hi)).alias(f"out_of_bounds_{c}") for c, (lo, hi) in bounds.items()]
    )


def quality_profile(df: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """One row per key with all the figures the report needs.

    Two scans: one reduced on the map side to a row per key, and one of only (key, time) to find
    where there may be duplicates, which runs as a job. Only the rows there are grouped.
    """
    aggs = [*_extent(spec), *_null_aggs(df, spec), F.count_if(invalid_price(spec, df.columns)).alias("invalid")]
    if _GAP in df.columns:
        aggs += _gap_aggs()
    figures = df.groupBy(spec.key).agg(*aggs)
    suspect, _ = split_by_repeats(df.select(spec.key, spec.time), spec)
    duplicated = duplicate_keys(suspect, spec).groupBy(spec.key).agg(F.count("*").alias("duplicates"))
    first, last = f"min_{spec.time}", f"max_{spec.time}"
    sums = [c for c in figures.columns if c not in (spec.key, first, last)]
    both = figures.unionByName(duplicated, allowMissingColumns=True).groupBy(spec.key)
    merged = both.agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min(first).alias(first),
        F.max(last).alias(last),
        F.coalesce(F.sum("duplicates"), F.lit(0).cast("long")).alias("duplicates"),
    )
    return _with_ratio(merged, spec)


def _status(require_rows: bool) -> Column:
    worst = F.col("min_ratio")
    bad = (F.col("invalid_price_count") > 0) | (F.col("duplicate_count") > 0) | (F.col("total_nulls") > 0)
    if require_rows:
        bad = bad | (F.col("row_count") == 0)
    return (
        F.when(bad | (worst < FAIL_BELOW), "fail").when(worst < WARN_BELOW, "warning").otherwise("pass")
    )


def _total(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("long"))


def _summary_aggs(profile: DataFrame) -> list[Column]:
    nulls = [c for c in profile.columns if c.startswith("null_")]
    counted = F.map_from_arrays(
        F.array(*[F.lit(c.removeprefix("null_")) for c in nulls]), F.array(*[_total(c) for c in nulls])
    )
    return [
        _total("actual_rows").alias("row_count"),
        F.map_filter(counted, lambda _, n: n > 0).alias("null_counts"),
        reduce(lambda a, b: a + b, [_total(c) for c in nulls]).alias("total_nulls"),
        _total("invalid").alias("invalid_price_count"),
        _total("duplicates").alias("duplicate_count"),
        F.min("completeness_ratio").alias("min_ratio"),
    ]


def quality_summary(profile: DataFrame, require_rows: bool = False) -> DataFrame:
    """One row of totals and the status, from a ``quality_profile``."""
    totals = profile.agg(*_summary_aggs(profile))
    return totals.withColumn("status", _status(require_rows))


def validity_report(df: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    """One row: null counts (only those above 0), their total, invalid prices, duplicated keys."""
    return quality_summary(quality_profile(df, spec)).select(
        "null_counts", "total_nulls", "invalid_price_count", "duplicate_count"
    )


def quality_status(df: DataFrame, spec: BarSpec = BarSpec(), require_rows: bool = False) -> DataFrame:
    """One row: ``pass``, ``warning`` or ``fail``.

    Any null, invalid price or duplicated key fails, and so does a ratio below 0.90; one below
    0.98 warns. Gaps and dropped rows do not count. An empty table passes unless
    ``require_rows``.
    """
    return quality_summary(quality_profile(df, spec), require_rows).select("status")


def _completeness_columns(spec: BarSpec) -> list[str]:
    return [
        spec.key,
        "actual_rows",
        f"min_{spec.time}",
        f"max_{spec.time}",
        "expected_rows",
        "completeness_ratio",
    ]


def completeness_section(profile: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame:
    return profile.select(*_completeness_columns(spec))


def continuity_section(profile: DataFrame, spec: BarSpec = BarSpec()) -> DataFrame | None:
    if "gap_events" not in profile.columns:
        return None
    return profile.select(spec.key, "total_missing_minutes", "gap_events")


def report_document(
    profile: DataFrame,
    reconciliation: DataFrame | None = None,
    spec: BarSpec = BarSpec(),
    require_rows: bool = False,
    skipped: Sequence[str] = (),
) -> DataFrame:
    """The report, one row of totals whatever the number of keys; ``report_sections`` has the figures per key.

    ``skipped`` are the key fields that the table does not have. Totals of a section that is not given are null.
    """
    missing = [_total(c).alias(c) for c in ("total_missing_minutes", "gap_events") if c in profile.columns]
    parts = [profile.agg(*_summary_aggs(profile), F.count("*").alias("keys"), *missing)]
    counts = ["raw_rows", "refined_rows", "dropped_rows"]
    if reconciliation is not None:
        parts.append(reconciliation.agg(*[_total(c).alias(c) for c in counts]))
    # One-row tables side by side, without a cross join.
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])

    def given(name: str) -> Column:
        return (F.col(name) if name in stacked.columns else F.lit(None).cast("long")).alias(name)

    return row.select(
        "row_count",
        F.struct("null_counts", "total_nulls", "invalid_price_count", "duplicate_count").alias("validity"),
        F.struct("keys", F.col("min_ratio").alias("min_ratio")).alias("completeness"),
        F.struct(given("total_missing_minutes"), given("gap_events")).alias("continuity"),
        F.struct(*[given(c) for c in counts]).alias("reconciliation"),
        F.array(*[F.lit(c) for c in skipped]).cast("array<string>").alias("skipped_fields"),
        _status(require_rows).alias("status"),
    )


def report_sections(
    df: DataFrame, raw: DataFrame | None = None, refined: DataFrame | None = None, spec: BarSpec = BarSpec()
) -> dict[str, DataFrame]:
    """The figures per key: completeness, continuity where the table has gaps, reconciliation where both layers are given."""
    profile = settle(quality_profile(df, spec))
    found = {
        "completeness": completeness_section(profile, spec),
        "continuity": continuity_section(profile, spec),
        "reconciliation": None if raw is None or refined is None else reconcile_counts(raw, refined, spec),
    }
    return {name: section for name, section in found.items() if section is not None}


def quality_report(
    df: DataFrame,
    raw: DataFrame | None = None,
    refined: DataFrame | None = None,
    spec: BarSpec = BarSpec(),
    require_rows: bool = False,
) -> DataFrame:
    """The report of a table, one row; the reconciliation's totals are null unless both layers are given."""
    profile = settle(quality_profile(df, spec))
    compared = None if raw is None or refined is None else settle(reconcile_counts(raw, refined, spec))
    return report_document(profile, compared, spec, require_rows, skipped_fields(df, spec))
