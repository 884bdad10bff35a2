"""Windows along one key's series, without one task per key.

A window partitioned by key alone puts a whole series into one task. When a series is long it
is cut into time slices, and the window is partitioned by (key, slice). What a slice needs from
the past is added to it as a few extra rows before the one shuffle of the wide rows:

* halo: the ``tail`` rows just before the slice, for offsets and bounded ROWS frames. They are
  counted in rows, not in time, so gaps do not matter.
* carry: one row with the sums, and the highest values, over everything before the slice, for running sums and maxima.

Both come from scans of only the few columns they need, reduced on the map side (row-number
limit, partial sums), so what is shuffled for them is a few rows per slice. (Spark limits row
numbers before a shuffle up to ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000 rows.) The
wide rows are never joined. The extra rows are dropped after the window.

Rows should be distinct on (key, time); among ties the order is arbitrary, as in any window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.epoch import floor_div, int_div
from barloom.scratch import settle
from barloom.sources.layers import at_partitions
from barloom.spec import BarSpec

MAX_ROWS = 1_000_000
SLOTS_PER_SLICE = 40_000
BROADCAST_BYTES = 32 * 1024 * 1024
_SALTS = 64

_SLICE, _SUB, _PART = "__slice", "__sub", "__part"
# The order of the rows within a slice: what was before it comes first.
_CARRY, _HALO, _OWN = range(3)


@dataclass(frozen=True)
class Slices:
    """How to cut every series. The default leaves it whole: one task per key.

    ``width_ms`` cuts into fixed spans of time; ``column`` uses a column that sorts along time
    and is constant over spans of it, such as the ``yyyy-MM`` partition column of a layer.
    ``dense`` lists the keys that still have a slice of more than ``max_rows`` rows; these
    are cut again into spans of ``max_rows`` bars of the grid, or (``step_ms=1``, where the bars are denser than the
    grid) of ``max_rows`` milliseconds: those hold at most ``max_rows`` rows as long as times are distinct.
    """

    width_ms: int | None = None
    column: str | None = None
    max_rows: int = MAX_ROWS
    dense: DataFrame | None = None
    broadcast_dense: bool = False
    step_ms: int = 1

    @property
    def whole(self) -> bool:
        return self.width_ms is None and self.column is None

    def _base(self, spec: BarSpec) -> Column:
        return F.col(self.column) if self.column else floor_div(F.col(spec.time), self.width_ms)

    def assign(self, df: DataFrame, spec: BarSpec) -> DataFrame:
        sub = floor_div(F.col(spec.time), self.max_rows * self.step_ms)
        cut = df.withColumn(_SLICE, self._base(spec))
        if self.dense is None:
            return cut.withColumn(_SUB, F.lit(None).cast("long"))
        dense = self.dense.select(F.col(spec.key).alias("__dense_key"), F.lit(True).alias("__dense"))
        same = F.col(spec.key).eqNullSafe(F.col("__dense_key"))
        if self.broadcast_dense:
            cut = cut.join(F.broadcast(dense), same, "left")
        else:
            # The list is too long to broadcast: salt, so a hot key does not meet in one task.
            salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("__salt_of")
            cut = (
                cut.withColumn("__salt", F.pmod(F.xxhash64(spec.time), F.lit(_SALTS)))
                .join(
                    dense.select("*", salts),
                    same & (F.col("__salt") == F.col("__salt_of")),
                    "left",
                )
                .drop("__salt", "__salt_of")
            )
        return cut.withColumn(_SUB, F.when(F.col("__dense"), sub)).drop("__dense", "__dense_key")


def plan_slices(
    df: DataFrame,
    spec: BarSpec,
    max_rows: int = MAX_ROWS,
    width_ms: int | None = None,
    column: str | None = None,
) -> Slices:
    """Measure the series and choose the cut. Runs one job: row counts by key and slice.

    Series of at most ``max_rows`` rows stay whole. Otherwise slices are ``column`` where
    given, else ``width_ms``, by default 40 000 bars of the grid.
    """
    width = None if column else width_ms or SLOTS_PER_SLICE * spec.interval_ms
    slices = Slices(width_ms=width, column=column, max_rows=max_rows)
    per_key = (
        df.groupBy(spec.key, slices._base(spec).alias(_SLICE))
        .agg(F.count("*").alias("__n"))
        .groupBy(spec.key)
        .agg(F.sum("__n").alias("__series_rows"), F.max("__n").alias("__slice_rows"))
    )
    overfull = F.col("__slice_rows") > max_rows
    key_bytes = F.coalesce(F.octet_length(F.col(spec.key).cast("string")), F.lit(0)) + 64
    found = per_key.agg(
        F.max("__series_rows").alias("longest"),
        F.count_if(overfull).alias("overfull"),
        F.sum(F.when(overfull, key_bytes)).alias("bytes"),
    ).first()
    if (found["longest"] or 0) <= max_rows:
        return Slices(max_rows=max_rows)
    if not found["overfull"]:
        return slices
    dense = settle(per_key.where(overfull).select(spec.key))
    return Slices(
        width_ms=width,
        column=column,
        max_rows=max_rows,
        dense=dense,
        broadcast_dense=found["bytes"] <= BROADCAST_BYTES,
        step_ms=_dense_step(at_partitions(df, dense, [spec.key]), spec, max_rows),
    )


def _dense_step(df: DataFrame, spec: BarSpec, max_rows: int) -> int:
    """The widest step for which spans of ``max_rows`` steps have no more rows than that: the grid's, else a second, else one
    millisecond. A job for each that is tried."""
    for step in (spec.interval_ms, 1000):
        if 1 < step <= spec.interval_ms:
            counts = df.groupBy(spec.key, floor_div(F.col(spec.time), max_rows * step)).count()
            if (counts.agg(F.max("count")).first()[0] or 0) <= max_rows:
                return step
    return 1


def over_series(
    df: DataFrame,
    spec: BarSpec,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    slices: Slices | None = None,
    tail: int = 0,
    tail_columns: Sequence[str] = (),
    running: Mapping[str, Column] | None = None,
    months: DataFrame | None = None,
    tail_source: DataFrame | None = None,
    highest: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add window columns along every series.

    ``add(rows, window)`` adds the columns, with ``window`` ordered by time. It may look back
    ``tail`` rows at ``tail_columns``, sum the ``running`` columns over all rows so far, and take the maximum of the ``highest``
    columns over all rows so far or all before.
    ``months`` lists the (key, month) whose rows come out, while all rows are looked back at; it
    goes with slices along the month column. ``tail_source`` is a cheaper table with the same keys
    and times to take the halo from.
    """
    if slices is None:
        slices = plan_slices(df, spec, column=spec.month if months is not None else None)
    if months is not None and not slices.whole and slices.column != spec.month:
        raise ValueError("rows can be chosen by month only where the slices follow the months")

    # As a literal, the first month keeps the scan from the partitions before it.
    first = None if months is None else months.agg(F.min(spec.month)).first()[0]

    def chosen(rows: DataFrame) -> DataFrame:
        if months is None:
            return rows
        later = rows.where(F.col(spec.month) >= F.lit(first))
        return later.join(months, [spec.key, spec.month], "left_semi").select(*rows.columns)

    running, highest = dict(running or {}), dict(highest or {})
    carried = running | highest
    wide = df.withColumns(carried) if carried else df

    if slices.whole:
        return chosen(add(wide, Window.partitionBy(spec.key).orderBy(spec.time)).drop(*carried))

    cut = slices.assign(wide, spec)
    parts = [chosen(cut).withColumn(_PART, F.lit(_OWN))]
    if tail:
        source = cut if tail_source is None else slices.assign(tail_source, spec)
        parts.append(_halo(source, spec, tail, list(tail_columns)))
    if carried:
        parts.append(_carry(cut, spec, {c: F.sum if c in running else F.max for c in carried}))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    window = Window.partitionBy(spec.key, _SLICE, _SUB).orderBy(_PART, spec.time)
    return add(rows, window).where(F.col(_PART) == _OWN).drop(_PART, _SLICE, _SUB, *carried)


def _carry(cut: DataFrame, spec: BarSpec, carried: Mapping[str, Callable[[str], Column]]) -> DataFrame:
    """One row per slice but the first, holding the sums or maxima over all earlier slices."""
    at = [spec.key, _SLICE, _SUB]
    earlier = Window.partitionBy(spec.key).orderBy(_SLICE, _SUB).rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*at).agg(*[f(c).alias(c) for c, f in carried.items()])
    return (
        totals.select(
            *at,
            *[f(c).over(earlier).alias(c) for c, f in carried.items()],
            F.lit(_CARRY).alias(_PART),
        )
        .where(reduce(or_, [F.col(c).isNotNull() for c in carried]))
    )


def _halo(cut: DataFrame, spec: BarSpec, tail: int, columns: list[str]) -> DataFrame:
    """For every slice, the ``tail`` rows before it."""
    at = [spec.key, _SLICE, _SUB]
    if tail == 1 and not columns:
        kept = cut.groupBy(*at).agg(F.array(F.struct(F.max(spec.time).alias(spec.time))).alias("__rows"))
    else:
        latest = Window.partitionBy(*at).orderBy(F.desc_nulls_last(spec.time))
        kept = (
            cut.select(*at, spec.time, *columns)
            .withColumn("__rank", F.row_number().over(latest))
            .where(F.col("__rank") <= tail)
            .groupBy(*at)
            .agg(F.sort_array(F.collect_list(F.struct(spec.time, *columns))).alias("__rows"))
        )
    # Number the kept rows along the series. A slice keeps its own last `tail` rows, so the `tail`
    # rows before any slice are among the kept ones. Only one small row per slice goes through
    # the per-key window.
    earlier = Window.partitionBy(spec.key).orderBy(_SLICE, _SUB).rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.select(*at, F.size("__rows").cast("long").alias("__n")).select(
        *at, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start")
    )
    k, s = kept.alias("k"), starts.alias("s")
    same_slice = reduce(and_, [F.col(f"k.{c}").eqNullSafe(F.col(f"s.{c}")) for c in at])
    numbered = (
        k.join(s, same_slice)
        .select(F.col(f"k.{spec.key}").alias("__key"), "s.__start", F.posexplode("k.__rows").alias("__pos", "__row"))
        .select("__key", "__row", (F.col("__start") + F.col("__pos") + 1).alias("__number"))
    )
    # A row is wanted by the slices that start at its number, or up to tail - 1 after. Both sides
    # meet on blocks of `tail` numbers, so a row looks at two blocks and not at the whole series.
    low, high = F.col("__number"), F.col("__number") + (tail - 1)
    blocks = F.explode(F.sequence(int_div(low, tail), int_div(high, tail))).alias("__near")
    wanted = numbered.select("*", blocks)
    targets = starts.where(F.col("__start") > 0).withColumn("__block", int_div(F.col("__start"), tail))
    met = (
        F.col(spec.key).eqNullSafe(F.col("__key"))
        & (F.col("__block") == F.col("__near"))
        & F.col("__start").between(low, high)
    )
    return targets.join(wanted, met).select(*at, "__row.*", F.lit(_HALO).alias(_PART))
