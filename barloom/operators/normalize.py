"""Source rows to raw bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.epoch import bar_date, epoch_ms_to_ts, normalize_epoch_ms, year_month


def tag_symbol(df: DataFrame, symbol: str | Column) -> DataFrame:
    """Set ``symbol``, from a constant or from a column such as one taken from the file name."""
    return df.withColumn("symbol", symbol if isinstance(symbol, Column) else F.lit(symbol))


def raw_bars(df: DataFrame, symbol: str | Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The raw layer's 16 columns from source rows; narrow, no shuffle.

    ``symbol=None`` expects a ``symbol`` column already in place. ``keep`` names further columns to pass on.
    """
    tagged = df if symbol is None else tag_symbol(df, symbol)
    timed = tagged.withColumns(
        {t: normalize_epoch_ms(F.col(t)) for t in ("open_time", "close_time")}
    )
    opened, closed = F.col("open_time"), F.col("close_time")
    return timed.select(
        "symbol",
        bar_date(opened).alias("date"),
        year_month(opened).alias("year_month"),
        opened,
        epoch_ms_to_ts(opened).alias("open_time_dt"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        closed,
        epoch_ms_to_ts(closed).alias("close_time_dt"),
        "quote_asset_volume",
        "num_trades",
        "taker_buy_base",
        "taker_buy_quote",
        *keep,
    )
