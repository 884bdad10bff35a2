"""Price and volume metrics along every series.

The arithmetic is on doubles. Running sums are exact and rounded once (``functions/exact.py``), so they have the same
bits however a series is cut. With ``exact_scale=n`` prices and volumes are taken as decimals of
``n`` places and sums stay decimal until the last division; a value that ``n`` places would change, by more than the noise in a
double's last bits, is an error that names it, and ``exact_scale_of`` tells the least ``n`` that changes none.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.exact import ExactSum, plan_sums
from barloom.operators.series import Slices, over_series
from barloom.spec import BarSpec

# Window sizes of the curated layer.
MA_SIZES = (20, 50)
VOLATILITY_SIZE = 20

_PV, _V = "__pv", "__v"


# Digits of a decimal price or volume; decimals of more places than this are not tried.
DIGITS, MOST_PLACES = 18, 17
# What arithmetic on doubles may have changed of a decimal number: some units of the last of its 53 bits.
NOISE = 2.0**-49


def _places(x: Column, scale: int) -> Column:
    """x with ``scale`` decimal places, or null if they change it."""
    places = x.try_cast(f"decimal({DIGITS},{scale})")
    return F.when(F.abs(places.cast("double") - x.cast("double")) <= F.abs(x.cast("double")) * NOISE, places)


def _number(name: str, exact_scale: int | None, spec: BarSpec) -> Column:
    x = F.col(name)
    if exact_scale is None:
        return x
    places = _places(x, exact_scale)
    at = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (name, spec.key, spec.time)]
    message = F.format_string(f"{name} %s of %s at %s has no decimal({DIGITS},{exact_scale})", *at)
    return F.when(x.isNull() | places.isNotNull(), places).otherwise(F.raise_error(message))


def exact_scale_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: for each column ``{column}_scale``, the least number of decimal places that change no value, and
    ``{column}_unfit``, how many values have none up to 17 places in 18 digits (NaN and infinite ones too). Nulls don't count; without a value the scale is null."""

    def least(x: Column) -> Column:
        return F.coalesce(*[F.when(_places(x, n).isNotNull(), F.lit(n)) for n in range(MOST_PLACES + 1)])

    scales = df.select(*[F.col(c).isNotNull().alias(f"{c}_given") for c in columns], *[least(F.col(c)).alias(f"{c}_scale") for c in columns])
    aggs = [[F.max(f"{c}_scale").alias(f"{c}_scale"), F.count_if(F.col(f"{c}_given") & F.col(f"{c}_scale").isNull()).alias(f"{c}_unfit")] for c in columns]
    return scales.agg(*reduce(lambda a, b: a + b, aggs))


def _add_prev_close(df: DataFrame, w: WindowSpec, spec: BarSpec) -> DataFrame:
    return df.withColumn("prev_close", F.lag(spec.close).over(w))


def _add_returns(df: DataFrame, w: WindowSpec, spec: BarSpec) -> DataFrame:
    ratio = F.try_divide(F.col(spec.close), F.col("prev_close"))
    return _add_prev_close(df, w, spec).withColumn("returns", ratio - 1)


def _add_moving_averages(
    df: DataFrame, w: WindowSpec, spec: BarSpec, sizes: Sequence[int], exact_scale: int | None
) -> DataFrame:
    def average(frame: WindowSpec) -> Column:
        if exact_scale is None:
            return F.avg(spec.close).over(frame)
        total = F.sum(_number(spec.close, exact_scale, spec)).over(frame)
        return F.try_divide(total.cast("double"), F.count(spec.close).over(frame))

    return df.withColumns({f"close_ma_{n}": average(w.rowsBetween(1 - n, 0)) for n in sizes})


class _RunningVwap:
    """What a cumulative VWAP adds up along a series, and the VWAP from it."""

    def __init__(self, df: DataFrame, spec: BarSpec, exact_scale: int | None) -> None:
        close, volume = _number(spec.close, exact_scale, spec), _number(spec.volume, exact_scale, spec)
        sums = {_PV: close * volume, _V: volume}
        self.plans: dict[str, ExactSum] = plan_sums(df, sums) if exact_scale is None else {}
        self.running = sums
        if self.plans:
            self.running = {c: term for name, x in sums.items() for c, term in self.plans[name].terms(x).items()}

    def add(self, df: DataFrame, w: WindowSpec) -> DataFrame:
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        sums = {c: F.sum(c).over(so_far) for c in self.running}
        paid, traded = f"{_PV}_so_far", f"{_V}_so_far"
        if self.plans:
            summed = self.plans[_V].total(self.plans[_PV].total(df, sums, paid), sums, traded)
        else:
            summed = df.withColumns({paid: sums[_PV].cast("double"), traded: sums[_V].cast("double")})
        return summed.withColumn("vwap", F.try_divide(paid, traded)).drop(paid, traded)


def _add_volatility(df: DataFrame, w: WindowSpec, size: int) -> DataFrame:
    return df.withColumn(f"volatility_{size}", F.stddev_samp("returns").over(w.rowsBetween(1 - size, 0)))


def prev_close(df: DataFrame, spec: BarSpec = BarSpec(), slices: Slices | None = None) -> DataFrame:
    """Close of the bar before; null on a series' first bar."""
    return over_series(
        df, spec, lambda d, w: _add_prev_close(d, w, spec), slices, tail=1, tail_columns=[spec.close]
    )


def period_returns(df: DataFrame, spec: BarSpec = BarSpec(), slices: Slices | None = None) -> DataFrame:
    """``prev_close`` and ``returns`` = close / prev_close - 1; null where there is nothing to divide by."""
    return over_series(
        df, spec, lambda d, w: _add_returns(d, w, spec), slices, tail=1, tail_columns=[spec.close]
    )


def moving_average(
    df: DataFrame,
    spec: BarSpec = BarSpec(),
    sizes: Sequence[int] = MA_SIZES,
    slices: Slices | None = None,
    exact_scale: int | None = None,
) -> DataFrame:
    """``close_ma_{n}`` over the last n bars; the first bars average what there is."""
    return over_series(
        df,
        spec,
        lambda d, w: _add_moving_averages(d, w, spec, sizes, exact_scale),
        slices,
        tail=max(sizes, default=1) - 1,
        tail_columns=[spec.close],
    )


def cumulative_vwap(
    df: DataFrame,
    spec: BarSpec = BarSpec(),
    slices: Slices | None = None,
    exact_scale: int | None = None,
) -> DataFrame:
    """``vwap`` from the first bar of the series on; null until something was traded. Its bits do not depend on the cut: sums of
    price times volume (as doubles) are exact and rounded once. Runs a job for the range of the terms."""
    vwap = _RunningVwap(df, spec, exact_scale)
    return over_series(df, spec, vwap.add, slices, running=vwap.running)


def rolling_volatility(
    df: DataFrame,
    spec: BarSpec = BarSpec(),
    size: int = VOLATILITY_SIZE,
    slices: Slices | None = None,
) -> DataFrame:
    """``volatility_{size}``: sample deviation of the last ``returns``; null below two of them."""
    return over_series(
        df,
        spec,
        lambda d, w: _add_volatility(d, w, size),
        slices,
        tail=size - 1,
        tail_columns=["returns"],
    )


def curated_bars(
    df: DataFrame,
    spec: BarSpec = BarSpec(),
    sizes: Sequence[int] = MA_SIZES,
    volatility: int = VOLATILITY_SIZE,
    slices: Slices | None = None,
    exact_scale: int | None = None,
    months: DataFrame | None = None,
) -> DataFrame:
    """All metrics in one pass: one shuffle and one sort of the wide rows."""

    vwap = _RunningVwap(df, spec, exact_scale)

    def add(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = _add_returns(d, w, spec)
        d = _add_moving_averages(d, w, spec, sizes, exact_scale)
        d = vwap.add(d, w)
        return _add_volatility(d, w, volatility)

    # `volatility` returns need one close more than that.
    return over_series(
        df,
        spec,
        add,
        slices,
        tail=max([volatility, *[n - 1 for n in sizes]]),
        tail_columns=[spec.close],
        running=vwap.running,
        months=months,
    )
