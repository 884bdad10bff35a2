"""Which (symbol, month) sources are wanted, and which are missing."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What an absent field of a source means.
DEFAULT_SYMBOL = "BTCUSDT"
DEFAULT_INTERVAL = "1m"
DEFAULT_YEAR = 2023
DEFAULT_MONTH = 1

_YEAR_FIELDS = ("start_year", "start_month", "end_year", "end_month", "year", "month")
_SPEC_DDL = "symbol string, interval string, " + ", ".join(f"{f} int" for f in _YEAR_FIELDS)


def expand_months(ranges: DataFrame) -> DataFrame:
    """One row per month from (start_year, start_month) to (end_year, end_month), both included.

    Null fields take the defaults: the end is the start, a single ``year`` and ``month`` may
    stand for the start. An end before the start gives no rows.
    """

    def field(*names: str, default: Column | str | int) -> Column:
        present = [F.col(n) for n in names if n in ranges.columns]
        return F.coalesce(*present, default if isinstance(default, Column) else F.lit(default))

    year = field("start_year", "year", default=DEFAULT_YEAR)
    month = field("start_month", "month", default=DEFAULT_MONTH)
    first = year * 12 + month - 1
    last = field("end_year", default=year) * 12 + field("end_month", default=month) - 1
    months = F.explode(F.when(first <= last, F.sequence(first, last))).alias("__month")
    return ranges.select(
        field("symbol", default=DEFAULT_SYMBOL).alias("symbol"),
        field("interval", default=DEFAULT_INTERVAL).alias("interval"),
        months,
    ).select(
        "symbol",
        "interval",
        F.floor(F.col("__month") / 12).cast("int").alias("year"),
        (F.col("__month") % 12 + 1).cast("int").alias("month"),
    )


def source_manifest(spark: SparkSession, config: Mapping[str, Any]) -> DataFrame:
    """The wanted sources of a configuration: its ``sources`` list, else its one ``source``, else the default.

    Entries of the list that are not mappings are left out.
    """
    listed, single = config.get("sources"), config.get("source")
    if isinstance(listed, list) and listed:
        entries = [s for s in listed if isinstance(s, Mapping)]
    else:
        entries = [single if isinstance(single, Mapping) else {}]
    rows = [
        (s.get("symbol"), s.get("interval"), *[None if s.get(f) is None else int(s[f]) for f in _YEAR_FIELDS])
        for s in entries
    ]
    return expand_months(spark.createDataFrame(rows, _SPEC_DDL))


def missing_sources(manifest: DataFrame, present: DataFrame) -> DataFrame:
    """Sources of the manifest without a (symbol, year_month) in ``present``.

    Where ``present`` tells the interval, that must agree too.
    """
    keys = [c for c in ("symbol", "interval", "year_month") if c in present.columns]
    wanted = manifest.withColumn("year_month", F.format_string("%04d-%02d", "year", "month"))
    return wanted.join(present.select(*keys).distinct(), keys, "left_anti").select(*manifest.columns)
