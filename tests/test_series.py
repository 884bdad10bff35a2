"""Cut and whole series give the same rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from barloom.operators import series
from barloom.operators.clean import detect_time_gaps
from barloom.operators.metrics import curated_bars
from barloom.operators.series import Slices, plan_slices
from barloom.spec import BarSpec


def exact(df, slices, **kwargs):
    out = curated_bars(df, sizes=(3, 7), volatility=4, slices=slices, exact_scale=2, **kwargs)
    return out.withColumn("volatility_4", F.round("volatility_4", 8))


times = st.lists(st.integers(-50, 400), min_size=1, max_size=40, unique=True)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=times, b=times, width=st.sampled_from([1, 3, 10, 64, 1000]))
def test_cut_equals_whole(bars, a, b, width):
    rows = [("A", t, 10.0 + t % 13, float(t % 3)) for t in a] + [("B", t, 20.0 + t % 7, 1.5) for t in b]
    df = bars(*rows)
    assertDataFrameEqual(exact(df, Slices(width_ms=width)), exact(df, Slices()))
    spec = BarSpec(interval_ms=5)
    assertDataFrameEqual(
        detect_time_gaps(df, spec, Slices(width_ms=width)), detect_time_gaps(df, spec, Slices())
    )


def test_null_keys_and_times(bars):
    df = bars(*[(None, t, 5.0 + t, 1.0) for t in range(9)], *[("A", t, 1.0 + t, 1.0) for t in range(9)], ("A", None, 3.0))
    assertDataFrameEqual(exact(df, Slices(width_ms=2)), exact(df, Slices()))


@pytest.mark.parametrize("broadcast", [True, False])
def test_dense_keys_are_cut_again(bars, broadcast):
    df = bars(*[("A", t, 1.0 + t % 11, 1.0) for t in range(300)], *[("B", 50 * t, 2.0 + t, 2.0) for t in range(6)])
    dense = df.where("symbol = 'A'").select("symbol").distinct()
    cut = Slices(width_ms=1000, max_rows=20, dense=dense, broadcast_dense=broadcast)
    assigned = cut.assign(df, BarSpec()).groupBy("symbol", "__slice", "__sub").count().collect()
    assert max(r["count"] for r in assigned) == 20
    assert sum(r["symbol"] == "B" for r in assigned) == 1
    assertDataFrameEqual(exact(df, cut), exact(df, Slices()))


def test_plan(bars):
    df = bars(*[("A", t, 1.0) for t in range(100)], ("B", 5, 1.0))
    spec = BarSpec(interval_ms=1)
    assert plan_slices(df, spec, max_rows=100).whole
    regular = plan_slices(df, spec, max_rows=50, width_ms=10)
    assert regular.width_ms == 10 and regular.dense is None
    uneven = plan_slices(df, spec, max_rows=50, width_ms=1000)
    assert [r.symbol for r in uneven.dense.collect()] == ["A"] and uneven.broadcast_dense
    assertDataFrameEqual(exact(df, uneven), exact(df, Slices()))
    assert plan_slices(df.where("false"), spec).whole


def test_dense_series_on_the_grid_are_cut_by_bars_of_it(bars):
    spec = BarSpec(interval_ms=1000)
    df = bars(*[("A", 1000 * t, 1.0) for t in range(300)])
    planned = plan_slices(df, spec, max_rows=100, width_ms=10**9)
    counts = planned.assign(df, spec).groupBy("symbol", "__slice", "__sub").count().collect()
    assert planned.step_ms == 1000 and [r["count"] for r in counts] == [100] * 3
    closer = bars(*[("A", t, 1.0) for t in range(300)])
    planned = plan_slices(closer, spec, max_rows=100, width_ms=10**9)
    counts = planned.assign(closer, spec).groupBy("symbol", "__slice", "__sub").count().collect()
    assert planned.step_ms == 1 and max(r["count"] for r in counts) == 100


def test_long_list_of_dense_keys_is_not_broadcast(bars, monkeypatch):
    monkeypatch.setattr(series, "BROADCAST_BYTES", 10)
    df = bars(*[("A", t, 1.0) for t in range(100)])
    planned = plan_slices(df, BarSpec(), max_rows=50, width_ms=1000)
    assert not planned.broadcast_dense
    assertDataFrameEqual(exact(df, planned), exact(df, Slices()))


def test_months_restrict_the_rows_that_come_out(bars):
    # Stand-in months of 7 time units each.
    df = bars(*[("A", t, 1.0 + t, 1.0) for t in range(60)], ("B", 50, 1.0)).withColumn(
        "year_month", F.format_string("%02d", F.floor(F.col("open_time") / 7))
    )
    months = df.where("symbol = 'A' AND open_time >= 31").select("symbol", "year_month").distinct()
    expected = exact(df, Slices()).where("symbol = 'A' AND open_time >= 28")
    for slices in (None, Slices(), Slices(column="year_month")):
        assertDataFrameEqual(exact(df, slices, months=months), expected)
    with pytest.raises(ValueError):
        exact(df, Slices(width_ms=7), months=months)


def test_wide_rows_are_shuffled_once(spark, tmp_path, bars):
    path = str(tmp_path / "bars")
    df = bars(*[("A", t, 1.0, 1.0) for t in range(60)])
    df.withColumn("carried_along", F.lit("x")).write.parquet(path)
    cut = curated_bars(spark.read.parquet(path), slices=Slices(width_ms=7))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line]
    wide = [i for i in scans if "carried_along" in lines[i].split("ReadSchema")[0]]
    # The wide rows are read once, in the first branch of the union, with one exchange above.
    assert len(scans) > 1 and wide == scans[:1]
    assert sum("Exchange" in line for line in lines[: wide[0]]) == 1
