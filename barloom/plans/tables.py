"""Bars made from the test tables.

``events`` gives hourly bars per event type, and damaged 1-minute bars; ``lineitem`` gives daily
bars per return flag and line status. Times are built from date and clock fields, so no session
time zone enters.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.normalize import raw_bars
from barloom.scratch import scratch_dir, settle
from barloom.sources.schema import BAR_SCHEMA
from barloom.sources.stores import write_file
from barloom.spec import BarSpec

HOUR_MS = 3_600_000
DAY_MS = 86_400_000

HOURLY = BarSpec(interval_ms=HOUR_MS)
DAILY = BarSpec(interval_ms=DAY_MS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day_ms(ts: Column) -> Column:
    return F.unix_date(F.to_date(ts)).cast("long") * DAY_MS


def _bars(ticks: DataFrame, order: list[str]) -> DataFrame:
    """Open, high, low, close and volume of ticks (symbol, open_time, value) by symbol and time."""
    at = F.struct(*order)
    return ticks.groupBy("symbol", "open_time").agg(
        F.min_by("value", at).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", at).alias("close"),
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("volume"),
        F.count("*").alias("num_trades"),
    )


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        (_day_ms(F.col("ts")) + F.hour("ts") * F.lit(HOUR_MS)).alias("open_time"),
        "ts",
        "event_id",
        "value",
    )
    return _bars(events, ["ts", "event_id"])


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("symbol"),
        _day_ms(F.col("l_shipdate")).alias("open_time"),
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("value"),
    )
    return _bars(lines, ["l_orderkey", "l_linenumber", "value"])


def epoch_us(ts: Column) -> Column:
    """Microseconds since the epoch of a time stamp without zone."""
    seconds = F.extract(F.lit("SECOND"), ts)
    return (
        (_day_ms(ts) + F.hour(ts) * F.lit(HOUR_MS) + F.minute(ts) * F.lit(60_000)) * 1000
        + (seconds * 1_000_000).cast("long")
    )


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source-file rows, with their symbol: one 1-minute bar per event, over all events.

    Many events share a minute, which gives duplicates. The event id decides which rows get a
    fault (missing or wrong numbers, no symbol) and which have microsecond times.
    """
    event_id, value, ts = F.col("event_id"), F.col("value"), F.col("ts")

    def fault(every: int, broken: Column, sound: Column) -> Column:
        return F.when(event_id % every == 0, broken).otherwise(sound)

    minute = _day_ms(ts) + F.hour(ts) * F.lit(HOUR_MS) + F.minute(ts) * F.lit(60_000)
    unit = F.when(event_id % 2 == 0, F.lit(1000)).otherwise(F.lit(1)).cast("long")
    nothing = F.lit(None).cast("double")
    return table(spark, sf_dir, "events").select(
        fault(83, F.lit(None), F.col("event_type")).alias("symbol"),
        (minute * unit).alias("open_time"),
        fault(97, -value, value).alias("open"),
        fault(101, value - 2, value + 1).alias("high"),
        fault(103, -value, value - 0.5).alias("low"),
        fault(89, nothing, value).alias("close"),
        fault(107, -value, value * 2).alias("volume"),
        ((minute + 59_999) * unit).alias("close_time"),
        (value * 3).alias("quote_asset_volume"),
        event_id.alias("num_trades"),
        (value / 4).alias("taker_buy_base"),
        value.alias("taker_buy_quote"),
        F.lit("0").alias("ignore"),
    )


def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer's rows, faults and duplicates included."""
    return raw_bars(source_rows(spark, sf_dir))


def daily_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily bars as rows of the raw layer. A month of them is small, so the partitions are
    years here."""
    bars = daily_bars(spark, sf_dir)
    volume = F.col("volume")
    extra = {
        "close_time": F.col("open_time") + (DAY_MS - 1),
        "quote_asset_volume": volume * 2,
        "taker_buy_base": volume / 2,
        "taker_buy_quote": volume,
    }
    return raw_bars(bars.withColumns(extra)).withColumn("year_month", F.substring("year_month", 1, 4))


def landing_zone(rows: DataFrame) -> str:
    """Source rows as CSV files under the names they have in a landing zone."""
    spark = rows.sparkSession
    written, named = scratch_dir(spark), scratch_dir(spark)
    rows.select("symbol", *BAR_SCHEMA.fieldNames()).write.partitionBy("symbol").csv(written)
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    files = to_path(written).getFileSystem(spark._jsc.hadoopConfiguration())
    for number, status in enumerate(files.globStatus(to_path(f"{written}/symbol=*/part-*.csv"))):
        symbol = status.getPath().getParent().getName().removeprefix("symbol=")
        name = "unnamed" if symbol.startswith("__") else f"{symbol.upper()}-1m-2024-01"
        folder = to_path(f"{named}/{number}")
        files.mkdirs(folder)
        files.rename(status.getPath(), to_path(folder, f"{name}.csv"))
    return named


def archives(rows: DataFrame) -> DataFrame:
    """Zip archives of source rows as a column of binaries: one per symbol and Arrow batch."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = []
            for symbol, part in batch.to_pandas().groupby("symbol", dropna=False):
                name = f"{symbol}-1m-2024-01.csv" if isinstance(symbol, str) else "unnamed.csv"
                packed = io.BytesIO()
                with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(name, part.drop(columns="symbol").to_csv(header=False, index=False))
                contents.append(packed.getvalue())
            yield pa.RecordBatch.from_pydict({"content": pa.array(contents, pa.binary())})

    return rows.select("symbol", *BAR_SCHEMA.fieldNames()).mapInArrow(pack, "content binary")


def landed_archives(rows: DataFrame) -> str:
    """Zip archives of source rows in a landing zone: for each task and symbol one, of two members."""
    spark = rows.sparkSession
    root = scratch_dir(spark)

    def land(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            for k, (symbol, part) in enumerate(batch.to_pandas().groupby("symbol", dropna=False)):
                name = f"{symbol.upper()}-1m-2024-01" if isinstance(symbol, str) else "unnamed"
                lines = part.drop(columns="symbol")
                packed = io.BytesIO()
                with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(f"{name}.csv", lines[: len(lines) // 2].to_csv(header=False, index=False))
                    archive.writestr(f"more/{name}.csv", lines[len(lines) // 2 :].to_csv(header=False, index=False))
                path = f"{root}/{task}-{number}-{k}/{name}.zip"
                write_file(path, packed.getvalue())
                yield pa.RecordBatch.from_pydict({"path": [path]})

    settle(rows.select("symbol", *BAR_SCHEMA.fieldNames()).mapInArrow(land, "path string"))
    return root
