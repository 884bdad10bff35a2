import pytest
from pyspark.sql import functions as F

from barloom.operators.clean import clean_bars, dedup_bars, dedup_rows, detect_time_gaps, filter_invalid_bars
from barloom.operators.series import Slices
from barloom.spec import BarSpec

DDL = "symbol string, open_time long, open double, high double, low double, close double, volume double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def bar(open_time=1, open=7.5, high=8.25, low=7.0, close=7.75, volume=3.5, symbol="A"):
    return (symbol, open_time, open, high, low, close, volume)


def test_dedup_keeps_one_per_key(spark):
    out = dedup_bars(frame(spark, bar(1), bar(1, close=7.25), bar(2)))
    assert sorted((r.open_time, r.close) for r in out.collect()) == [(1, 7.25), (2, 7.75)]


def test_dedup_counts_null_keys_as_equal(spark):
    assert dedup_bars(frame(spark, bar(1, symbol=None), bar(1, symbol=None), bar(None))).count() == 2


def test_dedup_is_idempotent_and_keeps_columns(spark):
    once = dedup_bars(frame(spark, bar(1), bar(1, volume=3.0), bar(2)))
    assert once.columns == DDL.replace(",", "").split()[::2]
    assert sorted(once.collect()) == sorted(dedup_bars(once).collect())


def test_dedup_order(spark):
    rows = frame(spark, bar(1, close=90.0, volume=5.0), bar(1, close=95.0, volume=1.0))
    assert dedup_bars(rows, order=["volume"]).first().close == 95.0


def test_dedup_without_other_columns(spark):
    assert dedup_rows(spark.createDataFrame([(1,), (1,)], "k int"), ["k"]).count() == 1


def test_dedup_reduces_before_the_shuffle(spark):
    plan = dedup_bars(frame(spark, bar()))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


@pytest.mark.parametrize(
    "broken",
    [
        dict(close=0.0),
        dict(high=100.0, low=110.0),
        dict(open=-5.0),
        dict(low=0.0),
        dict(volume=-1.0),
        dict(symbol=None),
        dict(open_time=None),
        dict(open=None),
        dict(volume=None),
        dict(close=float("nan")),
        dict(volume=float("nan")),
    ],
)
def test_filter_drops(spark, broken):
    assert filter_invalid_bars(frame(spark, bar(**broken), bar(7))).select("open_time").collect() == [(7,)]


def test_filter_keeps(spark):
    rows = [bar(volume=0.0), bar(close=200.0), bar(high=90.0)]
    assert filter_invalid_bars(frame(spark, *rows)).count() == 3
    assert filter_invalid_bars(frame(spark, bar(close=float("nan"))), reject_nan=False).count() == 1


def test_a_broken_copy_never_wins(spark):
    rows = frame(spark, bar(1, open=1.0, close=-1.0), bar(1, open=2.0, close=5.0))
    assert [r.close for r in clean_bars(rows).collect()] == [5.0]
    assert clean_bars(rows, dedup_first=True).count() == 0


@pytest.mark.parametrize("slices", [None, Slices(), Slices(width_ms=60_000), Slices(width_ms=10**9)])
def test_gaps(spark, bars, slices):
    times = [0, 60_000, 240_000, 270_000, 600_000]
    out = detect_time_gaps(bars(*[("A", t, 1.0) for t in times], ("B", 90_000, 1.0)), slices=slices)
    got = [(r.symbol, r.open_time, r.gap_minutes_before, r.has_gap_before) for r in out.collect()]
    assert sorted(got) == [
        ("A", 0, 0, False),
        ("A", 60_000, 0, False),
        ("A", 240_000, 2, True),
        ("A", 270_000, 0, False),
        ("A", 600_000, 4, True),
        ("B", 90_000, 0, False),
    ]


def test_gaps_of_duplicate_times(spark, bars):
    out = detect_time_gaps(bars(("A", 0, 1.0), ("A", 0, 2.0)))
    assert sorted(r.gap_minutes_before for r in out.collect()) == [-1, 0]


def test_gaps_on_another_grid(spark, bars):
    spec = BarSpec(interval_ms=3_600_000)
    out = detect_time_gaps(bars(("A", 0, 1.0), ("A", 3 * 3_600_000, 1.0)), spec)
    assert out.agg(F.sum("gap_minutes_before")).first()[0] == 2
