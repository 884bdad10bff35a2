"""Fixed schemas of the source files and of the layers."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    out = StructType()
    for name, kind in fields:
        out = out.add(name, kind, True)
    return out


_LONG, _DOUBLE, _STRING = LongType(), DoubleType(), StringType()

# Fixed format: the columns of a source file, in file order, without a header line.
BAR_SCHEMA = _schema(
    ("open_time", _LONG),
    ("open", _DOUBLE),
    ("high", _DOUBLE),
    ("low", _DOUBLE),
    ("close", _DOUBLE),
    ("volume", _DOUBLE),
    ("close_time", _LONG),
    ("quote_asset_volume", _DOUBLE),
    ("num_trades", _LONG),
    ("taker_buy_base", _DOUBLE),
    ("taker_buy_quote", _DOUBLE),
    ("ignore", _STRING),
)

RAW_SCHEMA = _schema(
    ("symbol", _STRING),
    ("date", DateType()),
    ("year_month", _STRING),
    ("open_time", _LONG),
    ("open_time_dt", TimestampType()),
    ("open", _DOUBLE),
    ("high", _DOUBLE),
    ("low", _DOUBLE),
    ("close", _DOUBLE),
    ("volume", _DOUBLE),
    ("close_time", _LONG),
    ("close_time_dt", TimestampType()),
    ("quote_asset_volume", _DOUBLE),
    ("num_trades", _LONG),
    ("taker_buy_base", _DOUBLE),
    ("taker_buy_quote", _DOUBLE),
)

REFINED_SCHEMA = StructType(
    RAW_SCHEMA.fields
    + _schema(("gap_minutes_before", _LONG), ("has_gap_before", BooleanType())).fields
)

CURATED_SCHEMA = StructType(
    REFINED_SCHEMA.fields
    + _schema(
        ("prev_close", _DOUBLE),
        ("returns", _DOUBLE),
        ("close_ma_20", _DOUBLE),
        ("close_ma_50", _DOUBLE),
        ("vwap", _DOUBLE),
        ("volatility_20", _DOUBLE),
    ).fields
)
