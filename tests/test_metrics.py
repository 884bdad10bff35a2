import math
import random

import pytest

from barloom.operators.metrics import (
    cumulative_vwap,
    curated_bars,
    exact_scale_of,
    moving_average,
    period_returns,
    prev_close,
    rolling_volatility,
)
from barloom.operators.series import Slices

CUTS = [Slices(), Slices(width_ms=1), Slices(width_ms=2), Slices(width_ms=100)]


def column(df, name):
    return [r[name] for r in sorted(df.collect(), key=lambda r: r["open_time"])]


@pytest.mark.parametrize("slices", CUTS)
def test_returns(bars, slices):
    out = period_returns(bars(("A", 1, 100.0), ("A", 2, 110.0)), slices=slices)
    assert column(out, "prev_close") == [None, 100.0]
    assert column(out, "returns") == [None, pytest.approx(0.1, abs=1e-9)]


def test_returns_after_a_zero_close_are_null(bars):
    assert column(period_returns(bars(("A", 1, 0.0), ("A", 2, 1.0))), "returns") == [None, None]


def test_prev_close_stays_within_its_key(bars):
    out = prev_close(bars(("A", 1, 1.0), ("B", 2, 2.0), ("A", 3, 3.0)), slices=Slices(width_ms=1))
    assert column(out, "prev_close") == [None, None, 1.0]


@pytest.mark.parametrize("slices", CUTS)
@pytest.mark.parametrize("scale", [None, 2])
def test_moving_average(bars, slices, scale):
    rows = bars(("A", 1, 100.0), ("A", 2, 110.0), ("A", 3, 120.0))
    out = moving_average(rows, sizes=[1, 2], slices=slices, exact_scale=scale)
    assert column(out, "close_ma_1") == [100.0, 110.0, 120.0]
    assert column(out, "close_ma_2") == [100.0, 105.0, 115.0]


@pytest.mark.parametrize("slices", CUTS)
@pytest.mark.parametrize("scale", [None, 2])
def test_vwap(bars, slices, scale):
    out = cumulative_vwap(bars(("A", 1, 10.0, 1.0), ("A", 2, 20.0, 3.0)), slices=slices, exact_scale=scale)
    assert column(out, "vwap") == [10.0, 17.5]
    assert out.columns[-1] == "vwap" and len(out.columns) == 8


@pytest.mark.parametrize("slices", CUTS)
def test_vwap_before_any_volume(bars, slices):
    out = cumulative_vwap(bars(("A", 1, 10.0, 0.0), ("A", 2, 20.0, 2.0)), slices=slices)
    assert column(out, "vwap") == [None, 20.0]


@pytest.mark.parametrize("slices", CUTS)
def test_volatility(spark, slices):
    rows = [("A", 1, None), ("A", 2, 0.1), ("A", 3, -0.1)]
    df = spark.createDataFrame(rows, "symbol string, open_time long, returns double")
    out = column(rolling_volatility(df, size=3, slices=slices), "volatility_3")
    assert out[:2] == [None, None]
    assert out[2] == pytest.approx(math.sqrt(0.02))


def test_curated_columns(bars):
    out = curated_bars(bars(("A", 1, 1.0)))
    assert out.columns[7:] == ["prev_close", "returns", "close_ma_20", "close_ma_50", "vwap", "volatility_20"]


@pytest.mark.parametrize("seed", [1, 2])
def test_vwap_has_the_same_bits_for_any_cut_and_is_rounded_once(bars, seed):
    rng = random.Random(seed)
    rows = [(k, t, rng.lognormvariate(0, 3), rng.lognormvariate(0, 6)) for k in "AB" for t in range(300)]
    rows += [("A", 1000, 0.1, None), ("A", 1001, 0.0, 0.0), ("C", 1, 5.0, 0.0)]
    found = [column(cumulative_vwap(bars(*rows), slices=s).where("symbol = 'A'"), "vwap") for s in [*CUTS[::3], Slices(width_ms=7)]]
    assert found[0] == found[1] == found[2]
    terms = [(p * (v if v is not None else 1.0), v) for k, t, p, v in rows if k == "A"]
    for n in (1, 17, 300):
        paid, traded = (math.fsum(x) for x in zip(*terms[:n], strict=True))
        assert found[0][n - 1] == paid / traded


def test_vwap_of_what_is_no_number(bars):
    nan, inf = float("nan"), float("inf")
    rows = bars(("A", 1, 2.0, 1.0), ("A", 2, inf, 1.0), ("A", 3, nan, 1.0), ("B", 1, None, 1.0), ("B", 2, 3.0, 1.0))
    for s in CUTS[:3]:
        got = cumulative_vwap(rows, slices=s)
        assert [str(x) for x in column(got.where("symbol = 'A'"), "vwap")] == ["2.0", "inf", "nan"]
        assert column(got.where("symbol = 'B'"), "vwap") == [None, 1.5]


def test_a_scale_that_changes_a_value_is_an_error_with_its_key(bars):
    rows = bars(("A", 1, 0.12), ("A", 2, 0.12345), ("A", 3, 0.12389))
    with pytest.raises(Exception, match=r"close 0.123\d+ of A at [23] has no decimal\(18,2\)"):
        cumulative_vwap(rows, exact_scale=2).where("open_time = 2").collect()
    assert column(cumulative_vwap(rows, exact_scale=5), "vwap") == [0.12, pytest.approx(0.121725), pytest.approx(0.12244666666666667)]
    with pytest.raises(Exception, match="has no decimal"):
        moving_average(bars(("A", 1, 1e17)), exact_scale=2).collect()


def test_noise_of_doubles_does_not_count_as_a_change(bars):
    noisy = [0.1 + 0.2, 70.78999999999999, 60.230000000000004, 1e-9]
    rows = bars(*[("A", t, x) for t, x in enumerate(noisy)])
    assert exact_scale_of(rows, ["close"]).first()["close_scale"] == 9
    assert exact_scale_of(rows.where("open_time < 3"), ["close"]).first()["close_scale"] == 2
    assert len(column(cumulative_vwap(rows, exact_scale=9), "vwap")) == 4


def test_least_scale_that_changes_no_value(bars):
    nan = float("nan")
    rows = bars(("A", 1, 0.5, 100.0), ("A", 2, 0.125, -3.0), ("A", 3, 1e17, 0.0), ("A", 4, nan, 7.0), ("A", 5, None, 1.0))
    found = exact_scale_of(rows, ["close", "volume"]).first()
    assert found.asDict() == {"close_scale": 3, "close_unfit": 1, "volume_scale": 0, "volume_unfit": 0}
    none = exact_scale_of(rows.where("false"), ["close"]).first()
    assert none.asDict() == {"close_scale": None, "close_unfit": 0}
    assert exact_scale_of(bars(("A", 1, 1e18), ("A", 2, 1e-9 / 3)), ["close"]).first()["close_unfit"] == 2
