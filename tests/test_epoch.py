import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.functions.epoch import bar_date, epoch_ms_to_ts, floor_div, normalize_epoch_ms, year_month
from barloom.operators.normalize import raw_bars, tag_symbol
from barloom.sources.schema import RAW_SCHEMA


def _one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t long").select(expr(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "given, ms",
    [
        (1735689600123, 1735689600123),
        (1735689600123456, 1735689600123),
        (10**14, 10**14),
        (10**14 + 1, 10**11),
        (-5, -5),
        (None, None),
    ],
)
def test_normalize(spark, given, ms):
    assert _one(spark, given, normalize_epoch_ms) == ms


def test_calendar_of_a_bar(spark):
    ms = 1735689600123
    assert _one(spark, ms, lambda t: F.unix_seconds(epoch_ms_to_ts(t))) == 1735689600
    assert _one(spark, ms, bar_date) == dt.date(2025, 1, 1)
    assert _one(spark, ms, year_month) == "2025-01"
    assert _one(spark, ms - 200, year_month) == "2024-12"
    # Whole seconds, cut toward zero as for the time stamps.
    assert _one(spark, -86_400_999, bar_date) == dt.date(1969, 12, 31)
    assert _one(spark, -86_401_000, bar_date) == dt.date(1969, 12, 30)


@pytest.mark.parametrize("damaged", [-(2**63), 2**63 - 1, None])
def test_damaged_times_become_null(spark, damaged):
    assert _one(spark, damaged, epoch_ms_to_ts) is None
    assert _one(spark, damaged, year_month) is None


def test_calendar_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert _one(spark, 1735689600123, bar_date) == dt.date(2025, 1, 1)
        assert _one(spark, 1735689600123, year_month) == "2025-01"
        assert _one(spark, 1735689600123, lambda t: F.unix_seconds(epoch_ms_to_ts(t))) == 1735689600
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_floor_div(spark):
    assert [_one(spark, v, lambda t: floor_div(t, 10)) for v in (-11, -10, -1, 0, 9, 10)] == [-2, -1, -1, 0, 0, 1]


def test_raw_bars(spark):
    row = (1735689600000000, 1.0, 3.0, 0.5, 2.0, 10.0, 1735689659999999, 20.0, 7, 4.0, 8.0, "0")
    from barloom.sources.schema import BAR_SCHEMA

    out = raw_bars(spark.createDataFrame([row], BAR_SCHEMA), "BTCUSDT")
    assert out.columns == RAW_SCHEMA.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in RAW_SCHEMA]
    got = out.first()
    assert (got["symbol"], got["open_time"], got["close_time"]) == ("BTCUSDT", 1735689600000, 1735689659999)
    assert got["year_month"] == "2025-01"


def test_tag_symbol_from_column(spark):
    df = spark.createDataFrame([("x",)], "name string")
    assert tag_symbol(df, F.upper("name")).first()["symbol"] == "X"
