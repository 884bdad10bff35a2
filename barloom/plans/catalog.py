"""Every operator as a query over the test tables: (spark, directory) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.epoch import bar_date, epoch_ms_to_ts, int_div, normalize_epoch_ms, year_month
from barloom.operators import bounds, clean, metrics, quality
from barloom.operators.normalize import raw_bars, tag_symbol
from barloom.operators.series import Slices
from barloom.plans import pipeline
from barloom.plans.tables import (
    DAILY,
    DAY_MS,
    HOURLY,
    archives,
    daily_bars,
    daily_raw,
    dirty_bars,
    epoch_us,
    hourly_bars,
    landed_archives,
    landing_zone,
    source_rows,
    table,
)
from barloom.scratch import scratch_dir, settle
from barloom.sources.digests import layer_changes
from barloom.sources.files import bars_from_archives, scan_bars_csv, scan_bars_zip, symbol_of
from barloom.sources.layers import empty_partitions, scan_layer, unify_symbols, write_layer
from barloom.sources.manifest import expand_months, missing_sources, source_manifest
from barloom.sources.schema import BAR_SCHEMA, CURATED_SCHEMA, RAW_SCHEMA, REFINED_SCHEMA
from barloom.spec import BarSpec

Query = Callable[[SparkSession, str], DataFrame]

# Prices of the test tables have two decimal places.
SCALE = 2

_REGISTRY: dict[str, Query] = {}


def _query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn

    return register


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_bars(dirty_bars(spark, sf_dir))


def _epochs_instead_of_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps as epoch seconds: they compare the same whatever the session time zone."""
    return df.withColumns({c: F.unix_seconds(c) for c in ("open_time_dt", "close_time_dt")})


# --- bars from the test tables ---------------------------------------------------------------


@_query("hourly_bars")
def _hourly(spark, sf_dir):
    return hourly_bars(spark, sf_dir)


@_query("daily_bars")
def _daily(spark, sf_dir):
    return daily_bars(spark, sf_dir)


# --- sources ---------------------------------------------------------------------------------


def _landed_csv(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark)
    source_rows(spark, sf_dir).write.partitionBy("symbol").csv(root)
    return root


@_query("scan_bars_csv")
def _scan_csv(spark, sf_dir):
    return scan_bars_csv(spark, _landed_csv(spark, sf_dir)).drop("source_file")


@_query("scan_bars_zip")
def _scan_zip(spark, sf_dir):
    bars = bars_from_archives(archives(source_rows(spark, sf_dir)))
    return tag_symbol(bars, symbol_of(F.col("source_file"))).select("symbol", *BAR_SCHEMA.fieldNames())


@_query("scan_bars_zip_landed")
def _scan_zip_landed(spark, sf_dir):
    """Archives in a folder, each member read by a task of its own."""
    bars = scan_bars_zip(spark, landed_archives(source_rows(spark, sf_dir)), recursive=True)
    named = tag_symbol(bars, F.lower(symbol_of(F.col("source_file"))))
    return named.select("symbol", *BAR_SCHEMA.fieldNames())


@_query("source_manifest_config")
def _manifest_config(spark, sf_dir):
    """Manifests of configurations: a list with a source for each nation, some fields absent, and an entry that is none; a single source; nothing."""
    nations = table(spark, sf_dir, "nation").select("n_name", "n_nationkey").collect()
    listed = [{"symbol": n, "interval": "5m" if k % 2 else None, "start_year": 2020, "start_month": 1 + k % 12, "end_year": 2021 if k % 3 else None} for n, k in nations]
    configs = [{"sources": [*listed, "no source"], "source": {"symbol": "X"}}, {"sources": [], "source": {"symbol": nations[0][0], "year": 2022, "month": 5}}, {}]
    named = [source_manifest(spark, c).withColumn("config", F.lit(n)) for n, c in enumerate(configs)]
    return unify_symbols(*named)


def _sources_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month range per customer: first to last order."""
    orders = table(spark, sf_dir, "orders")
    first, last = F.min("o_orderdate"), F.max("o_orderdate")
    return orders.groupBy(F.concat(F.lit("C"), "o_custkey").alias("symbol")).agg(
        F.year(first).alias("start_year"),
        F.month(first).alias("start_month"),
        F.year(last).alias("end_year"),
        F.month(last).alias("end_month"),
    )


@_query("source_manifest")
def _manifest(spark, sf_dir):
    return expand_months(_sources_of(spark, sf_dir))


@_query("missing_sources")
def _missing(spark, sf_dir):
    present = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), "o_custkey").alias("symbol"),
        F.substring(F.to_date("o_orderdate").cast("string"), 1, 7).alias("year_month"),
    )
    return missing_sources(_manifest(spark, sf_dir), present)


@_query("unify_symbols")
def _unify(spark, sf_dir):
    return unify_symbols(hourly_bars(spark, sf_dir), daily_bars(spark, sf_dir))


@_query("scan_layer")
def _scan_layer(spark, sf_dir):
    """A layer's root, all its symbols; the scan reads the named columns only."""
    path = scratch_dir(spark)
    write_layer(daily_raw(spark, sf_dir), path, cluster=True)
    return scan_layer(spark, path, RAW_SCHEMA).select("symbol", "year_month", "open_time", "close")


@_query("tag_symbol")
def _tag(spark, sf_dir):
    return tag_symbol(hourly_bars(spark, sf_dir), "ALL")


@_query("write_layer")
def _write(spark, sf_dir):
    """Write all, write one symbol again: the others' partitions stay."""
    path = scratch_dir(spark)
    bars = dirty_bars(spark, sf_dir)
    write_layer(bars, path, cluster=True)
    write_layer(bars.where(F.col("symbol") == "click"), path)
    return _epochs_instead_of_timestamps(scan_layer(spark, path, RAW_SCHEMA))


# --- normalisation ---------------------------------------------------------------------------


@_query("normalize_epoch_ms")
def _normalize(spark, sf_dir):
    micros = epoch_us(F.col("ts"))
    mixed = F.when(F.col("event_id") % 2 == 0, micros).otherwise(int_div(micros, 1000))
    ms = F.col("open_time")
    return (
        table(spark, sf_dir, "events")
        .select("event_id", normalize_epoch_ms(mixed).alias("open_time"))
        .select(
            "event_id",
            ms,
            F.unix_seconds(epoch_ms_to_ts(ms)).alias("open_seconds"),
            bar_date(ms).alias("date"),
            year_month(ms).alias("year_month"),
        )
    )


@_query("raw_bars")
def _raw(spark, sf_dir):
    return _epochs_instead_of_timestamps(raw_bars(source_rows(spark, sf_dir)))


# --- cleaning --------------------------------------------------------------------------------


@_query("filter_invalid_bars")
def _filter(spark, sf_dir):
    return _epochs_instead_of_timestamps(clean.filter_invalid_bars(dirty_bars(spark, sf_dir)))


@_query("dedup_rows")
def _dedup_lines(spark, sf_dir):
    return clean.dedup_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("dedup_bars")
def _dedup(spark, sf_dir):
    return _epochs_instead_of_timestamps(clean.dedup_bars(dirty_bars(spark, sf_dir)))


@_query("dedup_repeated_bars")
def _dedup_repeated(spark, sf_dir):
    return _epochs_instead_of_timestamps(clean.dedup_repeated_bars(dirty_bars(spark, sf_dir)))


@_query("clean_bars")
def _clean_bars(spark, sf_dir):
    return _epochs_instead_of_timestamps(_clean(spark, sf_dir))


_GAP_COLUMNS = ["symbol", "open_time", "gap_minutes_before", "has_gap_before"]


@_query("detect_time_gaps")
def _gaps(spark, sf_dir):
    return clean.detect_time_gaps(_clean(spark, sf_dir)).select(*_GAP_COLUMNS)


@_query("detect_time_gaps_sliced")
def _gaps_sliced(spark, sf_dir):
    dirty = dirty_bars(spark, sf_dir)
    times = clean.filter_invalid_bars(dirty).select("symbol", "open_time")
    gaps = clean.detect_time_gaps(clean.clean_bars(dirty), slices=Slices(width_ms=DAY_MS), times=times)
    return gaps.select(*_GAP_COLUMNS)


# --- metrics ---------------------------------------------------------------------------------


@_query("prev_close")
def _prev_close(spark, sf_dir):
    return metrics.prev_close(hourly_bars(spark, sf_dir), HOURLY)


@_query("period_returns")
def _returns(spark, sf_dir):
    return metrics.period_returns(hourly_bars(spark, sf_dir), HOURLY)


@_query("moving_average")
def _moving_average(spark, sf_dir):
    return metrics.moving_average(hourly_bars(spark, sf_dir), HOURLY, exact_scale=SCALE)


@_query("cumulative_vwap")
def _vwap(spark, sf_dir):
    return metrics.cumulative_vwap(hourly_bars(spark, sf_dir), HOURLY, exact_scale=SCALE)


def _exact_vwap(df: DataFrame, slices: Slices) -> DataFrame:
    bars = df.withColumns({"close": F.col("close") / 3, "year_month": year_month(F.col("open_time"))})
    return metrics.cumulative_vwap(bars, DAILY, slices)


@_query("cumulative_vwap_cut")
def _vwap_cut(spark, sf_dir):
    """On doubles, not rounded: a series whole, cut at every 500 bars, and cut by months. ``alike`` counts the cuts with the same bits."""
    bars = settle(daily_bars(spark, sf_dir))
    cuts = [Slices(), Slices(width_ms=500 * DAY_MS), Slices(column="year_month")]
    found = [_exact_vwap(bars, s).select("symbol", "open_time", "vwap", F.lit(n).alias("cut")) for n, s in enumerate(cuts)]
    met = unify_symbols(*found).groupBy("symbol", "open_time")
    whole = F.max(F.when(F.col("cut") == 0, F.col("vwap")))
    same = met.agg(whole.alias("vwap"), F.count_distinct("vwap").alias("values"), F.count("*").alias("alike"))
    return same.select("symbol", "open_time", "vwap", F.when(F.col("values") == 1, F.col("alike")).otherwise(0).alias("alike"))


@_query("exact_scale_of")
def _exact_scale(spark, sf_dir):
    """Prices have two decimal places, a quarter of them up to four, an eighth up to five."""
    bars = daily_bars(spark, sf_dir).select("close", "volume", (F.col("close") / 4).alias("quarter"), (F.col("close") / 8).alias("eighth"))
    return metrics.exact_scale_of(bars, ["close", "volume", "quarter", "eighth"])


def _rounded(df: DataFrame) -> DataFrame:
    """The deviation is a double sum: its last bits depend on the order of summation."""
    return df.withColumn("volatility_20", F.round("volatility_20", 8))


@_query("rolling_volatility")
def _volatility(spark, sf_dir):
    returns = metrics.period_returns(hourly_bars(spark, sf_dir), HOURLY)
    return _rounded(metrics.rolling_volatility(returns, HOURLY))


@_query("curated_bars")
def curated_bars_query(spark, sf_dir):
    return _rounded(metrics.curated_bars(hourly_bars(spark, sf_dir), HOURLY, exact_scale=SCALE))


@_query("curated_bars_daily")
def _curated_daily(spark, sf_dir):
    return _rounded(metrics.curated_bars(daily_bars(spark, sf_dir), DAILY, exact_scale=SCALE))


@_query("curated_bars_sliced")
def _curated_sliced(spark, sf_dir):
    """The daily bars in slices of ten days: the 50 rows before a slice span several slices."""
    bars = settle(daily_bars(spark, sf_dir))
    slices = Slices(width_ms=10 * DAY_MS)
    return _rounded(metrics.curated_bars(bars, DAILY, slices=slices, exact_scale=SCALE))


# --- quality ---------------------------------------------------------------------------------


@_query("null_counts")
def _nulls(spark, sf_dir):
    return quality.null_counts(dirty_bars(spark, sf_dir))


@_query("invalid_price_count")
def _invalid(spark, sf_dir):
    return quality.invalid_price_count(dirty_bars(spark, sf_dir))


@_query("duplicate_keys")
def _duplicates(spark, sf_dir):
    return quality.duplicate_keys(dirty_bars(spark, sf_dir))


@_query("validity_report")
def _validity(spark, sf_dir):
    report = quality.validity_report(dirty_bars(spark, sf_dir))
    fields = BarSpec().key_fields
    nulls = [F.coalesce(F.element_at("null_counts", F.lit(f)), F.lit(0)).alias(f"null_{f}") for f in fields]
    return report.select(*nulls, "total_nulls", "invalid_price_count", "duplicate_count")


@_query("completeness")
def _completeness(spark, sf_dir):
    return quality.completeness(hourly_bars(spark, sf_dir), HOURLY)


@_query("completeness_by_day")
def _completeness_by_day(spark, sf_dir):
    return quality.completeness(_clean(spark, sf_dir), by=["date"])


@_query("continuity")
def _continuity(spark, sf_dir):
    return quality.continuity(clean.detect_time_gaps(_clean(spark, sf_dir)))


@_query("reconcile_counts")
def _reconcile(spark, sf_dir):
    return quality.reconcile_counts(dirty_bars(spark, sf_dir), _clean(spark, sf_dir))


@_query("reconcile_daily")
def _reconcile_daily(spark, sf_dir):
    daily = quality.reconcile_daily(
        _exact_volume(dirty_bars(spark, sf_dir)), _exact_volume(_clean(spark, sf_dir))
    )
    return daily.withColumns({c: F.col(c).cast("double") for c in ("raw_volume", "refined_volume")})


def _exact_volume(df: DataFrame) -> DataFrame:
    return df.withColumn("volume", F.col("volume").cast(f"decimal(18,{SCALE})"))


@_query("drop_reasons")
def _drop_reasons(spark, sf_dir):
    return quality.drop_reasons(dirty_bars(spark, sf_dir))


@_query("out_of_bounds_count")
def _bounds(spark, sf_dir):
    return quality.out_of_bounds_count(dirty_bars(spark, sf_dir), {"close": (1.0, 100.0), "volume": (0.0, 500.0)})


@_query("bounds_from_quantiles")
def _quantile_bounds(spark, sf_dir):
    """Bounds from the months' sketches: whether their ranks are within the sketches' error, and what lies outside once each last bar has a wrong price."""
    bars = settle(daily_bars(spark, sf_dir).withColumn("year_month", year_month(F.col("open_time"))))
    sketches = settle(bounds.quantile_sketches(bars, ["close"], DAILY))
    quantiles = settle(bounds.bounds_from_quantiles(sketches, ["close"], DAILY, 0.05, 0.95, spread=0.0))
    errors = bounds.rank_errors(bars, quantiles, "close", 0.05, 0.95, DAILY)
    within = errors.select("symbol", "rows", (bounds.worst(errors) <= bounds.RANK_ERROR).alias("within_error"))
    last = bars.groupBy("symbol").agg(F.max("open_time").alias("open_time")).withColumn("wrong", F.lit(True))
    broken = bars.join(last, ["symbol", "open_time"], "left").withColumn("close", F.when(F.col("wrong"), F.col("close") * 1000).otherwise(F.col("close")))
    wide = bounds.bounds_from_quantiles(settle(bounds.quantile_sketches(broken, ["close"], DAILY)), ["close"], DAILY, spread=10.0)
    return within.join(bounds.out_of_bounds_by_key(broken, wide, ["close"], DAILY), "symbol")


@_query("non_monotonic_times")
def _non_monotonic(spark, sf_dir):
    """Bars in the order of their event: how many are not after the latest one before."""
    return quality.non_monotonic_times(dirty_bars(spark, sf_dir), "num_trades", slices=Slices())


@_query("non_monotonic_times_cut")
def _non_monotonic_cut(spark, sf_dir):
    return quality.non_monotonic_times(dirty_bars(spark, sf_dir), "num_trades", slices=Slices(width_ms=100))


def _status_of(report: DataFrame, *also: str) -> DataFrame:
    return report.select(
        "row_count",
        "validity.total_nulls",
        "validity.invalid_price_count",
        "validity.duplicate_count",
        "completeness.keys",
        "completeness.min_ratio",
        *also,
        "status",
    )


@_query("quality_status")
def _status(spark, sf_dir):
    """The status of bars of three kinds: with faults, with holes, without either."""
    steady = quality.quality_status(daily_bars(spark, sf_dir), DAILY)
    holey = quality.quality_status(hourly_bars(spark, sf_dir), HOURLY)
    faulty = quality.quality_status(dirty_bars(spark, sf_dir))
    named = [(steady, "daily"), (holey, "hourly"), (faulty, "dirty")]
    return unify_symbols(*[status.withColumn("bars", F.lit(name)) for status, name in named])


@_query("quality_report")
def _report(spark, sf_dir):
    raw = dirty_bars(spark, sf_dir)
    refined = clean.detect_time_gaps(_clean(spark, sf_dir))
    report = quality.quality_report(refined, raw, refined)
    report = report.withColumns(
        {"dropped_rows": F.col("reconciliation.dropped_rows"), "missing_minutes": F.col("continuity.total_missing_minutes")}
    )
    return _status_of(report, "dropped_rows", "missing_minutes")


# --- layer builds ----------------------------------------------------------------------------


def _built_raw(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    return pipeline.build_raw(spark, _landed_csv(spark, sf_dir), f"{root}/raw", F.col("symbol"))


def _built_refined(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    _built_raw(spark, sf_dir, root)
    return pipeline.build_refined(spark, f"{root}/raw", f"{root}/refined")


def _built_curated(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    _built_refined(spark, sf_dir, root)
    return pipeline.build_curated(spark, f"{root}/refined", f"{root}/curated", exact_scale=SCALE)


@_query("build_raw")
def _build_raw(spark, sf_dir):
    return _epochs_instead_of_timestamps(_built_raw(spark, sf_dir, scratch_dir(spark)))


@_query("build_refined")
def _build_refined(spark, sf_dir):
    return _epochs_instead_of_timestamps(_built_refined(spark, sf_dir, scratch_dir(spark)))


@_query("build_curated")
def _build_curated(spark, sf_dir):
    return _rounded(_epochs_instead_of_timestamps(_built_curated(spark, sf_dir, scratch_dir(spark))))


@_query("build_quality")
def _build_quality(spark, sf_dir):
    """The figures of the report as written, read back from its JSON."""
    root = scratch_dir(spark)
    curated = _built_curated(spark, sf_dir, root)
    raw = scan_layer(spark, f"{root}/raw", RAW_SCHEMA)
    refined = curated.select("symbol", "open_time")
    report = pipeline.build_quality(spark, curated, f"{root}/quality", raw, refined)
    written = spark.read.schema(report.schema).json(f"{root}/quality/quality_report.json", multiLine=True)
    return _status_of(written)


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of every event type for two months, of which only the first has landed."""
    kinds = table(spark, sf_dir, "events").select(F.upper("event_type").alias("symbol")).distinct()
    spans = {"start_year": 2024, "start_month": 1, "end_year": 2024, "end_month": 2}
    return expand_months(kinds.withColumns({name: F.lit(value) for name, value in spans.items()}))


@_query("ingest_bars")
def _ingest(spark, sf_dir):
    landing, raw = landing_zone(source_rows(spark, sf_dir)), scratch_dir(spark)
    pipeline.ingest_bars(spark, landing, raw, _wanted(spark, sf_dir))
    return _epochs_instead_of_timestamps(scan_layer(spark, raw, RAW_SCHEMA))


@_query("ingest_new_bars")
def _ingest_new(spark, sf_dir):
    """Two ingests of one landing zone, the second after more symbols have landed: how many files each has read, and the rows of the layer."""
    raw, rows = scratch_dir(spark), settle(source_rows(spark, sf_dir).where("symbol IS NOT NULL"))
    early = F.col("symbol") < "m"
    first, later = landing_zone(rows.where(early)), landing_zone(rows.where(~early))
    read = [len(pipeline.ingest_new_bars(spark, zone, raw)) for zone in ([first], [first, later], [first, later])]
    layer = scan_layer(spark, raw, RAW_SCHEMA).groupBy("symbol").agg(F.count("*").alias("rows"))
    return layer.select("symbol", "rows", *[F.lit(n).cast("long").alias(f"files_{k}") for k, n in enumerate(read)])


@_query("ingest_bars_missing")
def _ingest_missing(spark, sf_dir):
    landing = landing_zone(source_rows(spark, sf_dir))
    return pipeline.ingest_bars(spark, landing, scratch_dir(spark), _wanted(spark, sf_dir))


@_query("ingest_bars_zip")
def _ingest_zip(spark, sf_dir):
    landing, raw = landed_archives(source_rows(spark, sf_dir)), scratch_dir(spark)
    pipeline.ingest_bars(spark, landing, raw, _wanted(spark, sf_dir), kind="zip")
    return _epochs_instead_of_timestamps(scan_layer(spark, raw, RAW_SCHEMA))


@_query("quality_sections_csv")
def _sections_csv(spark, sf_dir):
    """The completeness and the continuity of the build's report, read back from its CSV."""
    root = scratch_dir(spark)
    curated = _built_curated(spark, sf_dir, root)
    pipeline.build_quality(spark, curated, f"{root}/quality", csv=True)
    whole = spark.read.csv(f"{root}/quality/completeness", header=True, schema="symbol string, actual_rows long, min_open_time long, max_open_time long, expected_rows long, completeness_ratio double")
    gaps = spark.read.csv(f"{root}/quality/continuity", header=True, schema="symbol string, total_missing_minutes long, gap_events long")
    return whole.join(gaps, "symbol")


@_query("run_lakehouse")
def _run(spark, sf_dir):
    """Landing files to curated bars; the minutes have holes, so the gate raises at the end."""
    root = scratch_dir(spark)
    landing = landing_zone(source_rows(spark, sf_dir))
    paths = pipeline.LayerPaths(landing, *[f"{root}/{layer}" for layer in ("raw", "refined", "curated", "quality")])
    try:
        status = pipeline.run_lakehouse(spark, paths, _wanted(spark, sf_dir))
    except pipeline.QualityCheckFailed:
        status = "fail"
    curated = scan_layer(spark, paths.curated, CURATED_SCHEMA)
    return curated.select(*_GAP_COLUMNS, "close", "prev_close", "returns", F.lit(status).alias("status"))


@_query("refresh_layers")
def _refresh(spark, sf_dir):
    """Build from a raw layer with a wrong partition, put that right, refresh what it touches."""
    root = scratch_dir(spark)
    paths = pipeline.LayerPaths("", *[f"{root}/{layer}" for layer in ("raw", "refined", "curated", "quality")])
    bars = settle(daily_raw(spark, sf_dir))
    wrong = (F.col("symbol") == "N-F") & (F.col("year_month") == "1998")
    write_layer(bars.withColumn("close", F.when(wrong, F.col("close") * 2).otherwise(F.col("close"))), paths.raw)
    pipeline.build_refined(spark, paths.raw, paths.refined, DAILY)
    pipeline.build_curated(spark, paths.refined, paths.curated, DAILY, exact_scale=SCALE)
    write_layer(bars.where(wrong), paths.raw)
    changed = bars.where(wrong).select("symbol", "year_month").distinct()
    pipeline.refresh_layers(spark, paths, changed, DAILY, exact_scale=SCALE)
    curated = _rounded(scan_layer(spark, paths.curated, CURATED_SCHEMA))
    return curated.select(*_GAP_COLUMNS, "close", *CURATED_SCHEMA.names[-6:])


@_query("drop_accounting")
def _drop_accounting(spark, sf_dir):
    """Files with rows of another month, faults and copies: what became of the rows of each symbol, from the account that the build keeps."""
    unit = F.when(F.col("num_trades") % 2 == 0, F.lit(1000)).otherwise(F.lit(1)).cast("long")
    astray = F.when(F.col("num_trades") % 109 == 0, F.col("open_time") + 31 * DAY_MS * unit).otherwise(F.col("open_time"))
    landing, root = landing_zone(source_rows(spark, sf_dir).withColumn("open_time", astray)), scratch_dir(spark)
    pipeline.ingest_bars(spark, landing, f"{root}/raw")
    pipeline.build_refined(spark, f"{root}/raw", f"{root}/refined")
    return pipeline.account_for_drops(spark, f"{root}/raw", f"{root}/refined")


def _partition(symbol: str, year: str) -> Column:
    return (F.col("symbol") == symbol) & (F.col("year_month") == year)


@_query("changed_partitions")
def _changed(spark, sf_dir):
    """A layer of which one partition gets other rows, one comes new, one goes, and one is written again as it was."""
    path = scratch_dir(spark)
    bars = settle(daily_raw(spark, sf_dir))
    new, other, gone, same = _partition("R-F", "1993"), _partition("N-F", "1998"), _partition("A-F", "1992"), _partition("A-F", "1994")
    write_layer(bars.where(~new).withColumn("close", F.when(other, F.col("close") * 2).otherwise(F.col("close"))), path, cluster=True)
    layer = scan_layer(spark, path, RAW_SCHEMA)
    known = settle(layer_changes(layer, None)[1])
    write_layer(bars.where(new | other | same).orderBy(F.desc("open_time")), path)
    empty_partitions(spark, path, RAW_SCHEMA, bars.where(gone).select("symbol", "year_month").distinct())
    return layer_changes(scan_layer(spark, path, RAW_SCHEMA), known)[0]


@_query("refresh_changed_layers")
def _refresh_changed(spark, sf_dir):
    """As ``refresh_layers``, but what changed is found by the digests."""
    root = scratch_dir(spark)
    paths = pipeline.LayerPaths("", *[f"{root}/{layer}" for layer in ("raw", "refined", "curated", "quality")])
    bars = settle(daily_raw(spark, sf_dir))
    wrong = _partition("N-F", "1998")
    write_layer(bars.withColumn("close", F.when(wrong, F.col("close") * 2).otherwise(F.col("close"))), paths.raw, cluster=True)
    pipeline.build_refined(spark, paths.raw, paths.refined, DAILY)
    pipeline.build_curated(spark, paths.refined, paths.curated, DAILY, exact_scale=SCALE)
    write_layer(bars.where(wrong), paths.raw)
    pipeline.refresh_layers(spark, paths, spec=DAILY, exact_scale=SCALE)
    curated = _rounded(scan_layer(spark, paths.curated, CURATED_SCHEMA))
    return curated.select(*_GAP_COLUMNS, "close", *CURATED_SCHEMA.names[-6:])


def _lost(bars: DataFrame) -> Column:
    return (F.col("symbol") == "N-F") & (F.col("year_month") == "1998")


def _layers_before_loss(spark: SparkSession, sf_dir: str) -> tuple[pipeline.LayerPaths, DataFrame]:
    """Layers of sound bars, whose raw layer then has a (symbol, month) without a valid bar."""
    root = scratch_dir(spark)
    paths = pipeline.LayerPaths("", *[f"{root}/{layer}" for layer in ("raw", "refined", "curated", "quality")])
    bars = settle(daily_raw(spark, sf_dir))
    write_layer(bars, paths.raw)
    pipeline.build_refined(spark, paths.raw, paths.refined, DAILY)
    pipeline.build_curated(spark, paths.refined, paths.curated, DAILY, exact_scale=SCALE)
    write_layer(bars.where(_lost(bars)).withColumn("close", F.lit(-1.0)), paths.raw)
    return paths, bars


def _after_loss(spark: SparkSession, paths: pipeline.LayerPaths) -> DataFrame:
    """The curated layer, and the rows that reconciliation says were dropped."""
    raw, refined = scan_layer(spark, paths.raw, RAW_SCHEMA), scan_layer(spark, paths.refined, REFINED_SCHEMA)
    curated = scan_layer(spark, paths.curated, CURATED_SCHEMA)
    dropped = settle(quality.reconcile_counts(raw, refined, DAILY).select("symbol", "dropped_rows"))
    return curated.join(dropped, "symbol").select(*_GAP_COLUMNS, "close", "dropped_rows")


@_query("rebuild_after_loss")
def _rebuild_after_loss(spark, sf_dir):
    paths, _ = _layers_before_loss(spark, sf_dir)
    pipeline.build_refined(spark, paths.raw, paths.refined, DAILY)
    pipeline.build_curated(spark, paths.refined, paths.curated, DAILY, exact_scale=SCALE)
    return _after_loss(spark, paths)


@_query("refresh_after_loss")
def _refresh_after_loss(spark, sf_dir):
    paths, bars = _layers_before_loss(spark, sf_dir)
    changed = bars.where(_lost(bars)).select("symbol", "year_month").distinct()
    pipeline.refresh_layers(spark, paths, changed, DAILY, exact_scale=SCALE)
    return _after_loss(spark, paths)


@_query("invalid_price_not_finite")
def _not_finite(spark, sf_dir):
    """Closes that are no numbers, and infinite ones: how many count as invalid, and the status."""
    bars = daily_bars(spark, sf_dir)
    day = F.col("open_time") / DAY_MS
    close = F.when(day % 11 == 0, float("nan")).when(day % 13 == 0, float("inf")).otherwise(F.col("close"))
    broken = settle(bars.withColumn("close", close))
    return quality.quality_summary(quality.quality_profile(broken, DAILY)).select("row_count", "invalid_price_count", "status")
