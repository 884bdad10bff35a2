"""For every query the same result in DuckDB SQL over the same tables."""

from __future__ import annotations

_HOURLY = """
ticks AS (
  SELECT event_type AS symbol, CAST(epoch_ms(date_trunc('hour', ts)) AS BIGINT) AS open_time,
         ts, event_id, value
  FROM events),
hourly AS (
  SELECT symbol, open_time,
         arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, row(ts, event_id)) AS close,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS volume,
         count(*) AS num_trades
  FROM ticks GROUP BY symbol, open_time)"""

_DAILY = """
lines AS (
  SELECT l_returnflag || '-' || l_linestatus AS symbol,
         CAST(epoch_ms(date_trunc('day', l_shipdate)) AS BIGINT) AS open_time,
         l_orderkey, l_linenumber, l_extendedprice AS value
  FROM lineitem),
daily AS (
  SELECT symbol, open_time,
         arg_min(value, row(l_orderkey, l_linenumber, value)) AS open,
         max(value) AS high, min(value) AS low,
         arg_max(value, row(l_orderkey, l_linenumber, value)) AS close,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS volume,
         count(*) AS num_trades
  FROM lines GROUP BY symbol, open_time)"""

_SOURCE = """
minutes AS (
  SELECT *, CAST(epoch_ms(date_trunc('minute', ts)) AS BIGINT) AS minute,
         CASE WHEN event_id % 2 = 0 THEN 1000 ELSE 1 END AS unit
  FROM events),
source AS (
  SELECT CASE WHEN event_id % 83 = 0 THEN NULL ELSE event_type END AS symbol,
         minute * unit AS open_time,
         CASE WHEN event_id % 97 = 0 THEN -value ELSE value END AS open,
         CASE WHEN event_id % 101 = 0 THEN value - 2 ELSE value + 1 END AS high,
         CASE WHEN event_id % 103 = 0 THEN -value ELSE value - CAST(0.5 AS DOUBLE) END AS low,
         CASE WHEN event_id % 89 = 0 THEN NULL ELSE value END AS close,
         CASE WHEN event_id % 107 = 0 THEN -value ELSE value * 2 END AS volume,
         (minute + 59999) * unit AS close_time,
         value * 3 AS quote_asset_volume,
         event_id AS num_trades,
         value / 4 AS taker_buy_base,
         value AS taker_buy_quote,
         '0' AS "ignore"
  FROM minutes)"""

_RAW = (
    _SOURCE
    + """,
in_ms AS (
  SELECT * REPLACE (
    CASE WHEN open_time > 100000000000000 THEN open_time // 1000 ELSE open_time END AS open_time,
    CASE WHEN close_time > 100000000000000 THEN close_time // 1000 ELSE close_time END AS close_time)
  FROM source),
raw AS (
  SELECT symbol, CAST(epoch_ms(open_time) AS DATE) AS date,
         strftime(epoch_ms(open_time), '%Y-%m') AS year_month,
         open_time, open_time // 1000 AS open_time_dt, open, high, low, close, volume,
         close_time, close_time // 1000 AS close_time_dt,
         quote_asset_volume, num_trades, taker_buy_base, taker_buy_quote
  FROM in_ms)"""
)

_VALID = """symbol IS NOT NULL AND open_time IS NOT NULL AND open IS NOT NULL AND close IS NOT NULL
    AND high IS NOT NULL AND low IS NOT NULL AND volume IS NOT NULL
    AND open > 0 AND close > 0 AND low > 0 AND high >= low AND volume >= 0
    AND NOT isnan(open) AND NOT isnan(high) AND NOT isnan(low) AND NOT isnan(close) AND NOT isnan(volume)"""


def _first_copy(source: str) -> str:
    """One row per (symbol, open_time): the smallest by the other columns in their order."""
    rest = (
        "date, year_month, open_time_dt, open, high, low, close, volume, close_time, close_time_dt,"
        " quote_asset_volume, num_trades, taker_buy_base, taker_buy_quote"
    )
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in rest.split(","))
    return f"""SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, open_time ORDER BY {order}) AS copy FROM {source})
  WHERE copy = 1"""


_CLEAN = (
    _RAW
    + f""",
valid AS (SELECT * FROM raw WHERE {_VALID}),
clean AS ({_first_copy("valid")})"""
)


def _gaps(source: str, interval: int) -> str:
    return f"""SELECT *, gap_minutes_before > 0 AS has_gap_before FROM (
    SELECT *, coalesce(CAST(trunc((open_time - lag(open_time) OVER s) / {interval} - 1) AS BIGINT), 0)
              AS gap_minutes_before
    FROM {source} WINDOW s AS (PARTITION BY symbol ORDER BY open_time))"""


_REFINED = _CLEAN + f",\nrefined AS ({_gaps('clean', 60_000)})"

_SERIES = "PARTITION BY symbol ORDER BY open_time"


def _average(n: int) -> str:
    frame = f"OVER ({_SERIES} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CAST(sum(CAST(close AS DECIMAL(18,2))) {frame} AS DOUBLE) / count(close) {frame} AS close_ma_{n}"


_SO_FAR = f"OVER ({_SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_VWAP = f"""CAST(sum(CAST(close AS DECIMAL(18,2)) * CAST(volume AS DECIMAL(18,2))) {_SO_FAR} AS DOUBLE)
    / nullif(CAST(sum(CAST(volume AS DECIMAL(18,2))) {_SO_FAR} AS DOUBLE), 0) AS vwap"""
_PREV = f"lag(close) OVER ({_SERIES}) AS prev_close"
_RETURNS = "close / nullif(prev_close, 0) - 1 AS returns"
_VOLATILITY = f"""round(stddev_samp(returns) OVER ({_SERIES}
    ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 8) AS volatility_20"""


def _curated(source: str) -> str:
    return f"""SELECT *, {_average(20)}, {_average(50)}, {_VWAP}, {_VOLATILITY}
  FROM (SELECT *, {_RETURNS} FROM (SELECT *, {_PREV} FROM {source}))"""


_FIELDS = ("symbol", "open_time", "open", "high", "low", "close", "volume")
_NULLS = ", ".join(f"count(*) FILTER (WHERE {f} IS NULL) AS null_{f}" for f in _FIELDS)
_TOTAL_NULLS = " + ".join(f"count(*) FILTER (WHERE {f} IS NULL)" for f in _FIELDS)
_INVALID = "count(*) FILTER (WHERE close <= 0 OR high < low OR open <= 0 OR low <= 0)"


def _duplicates(source: str) -> str:
    return f"SELECT symbol, open_time, count(*) AS copies FROM {source} GROUP BY symbol, open_time HAVING count(*) > 1"


def _complete(source: str, interval: int, by: str = "symbol") -> str:
    return f"""SELECT *, CAST(actual_rows AS DOUBLE) / expected_rows AS completeness_ratio FROM (
    SELECT *, CAST(trunc((max_open_time - min_open_time) / {interval} + 1) AS BIGINT) AS expected_rows FROM (
      SELECT {by}, count(*) AS actual_rows, min(open_time) AS min_open_time, max(open_time) AS max_open_time
      FROM {source} GROUP BY {by}))"""


def _figures(source: str, interval: int) -> str:
    """row_count, total_nulls, invalid_price_count, duplicate_count, keys, min_ratio, status."""
    return f"""SELECT *, CASE
      WHEN total_nulls > 0 OR invalid_price_count > 0 OR duplicate_count > 0 OR min_ratio < 0.9 THEN 'fail'
      WHEN min_ratio < 0.98 THEN 'warning' ELSE 'pass' END AS status
    FROM (SELECT count(*) AS row_count, {_TOTAL_NULLS} AS total_nulls, {_INVALID} AS invalid_price_count,
            (SELECT count(*) FROM ({_duplicates(source)})) AS duplicate_count,
            (SELECT count(*) FROM ({_complete(source, interval)})) AS keys,
            (SELECT min(completeness_ratio) FROM ({_complete(source, interval)})) AS min_ratio
          FROM {source})"""


_COUNTS = """SELECT symbol, coalesce(raw_rows, 0) AS raw_rows, coalesce(refined_rows, 0) AS refined_rows,
       coalesce(raw_rows, 0) - coalesce(refined_rows, 0) AS dropped_rows
FROM (SELECT symbol, count(*) AS raw_rows FROM raw GROUP BY symbol)
FULL OUTER JOIN (SELECT symbol, count(*) AS refined_rows FROM clean GROUP BY symbol) USING (symbol)"""

_REASONS = " ".join(
    f"WHEN {test} THEN '{name}'"
    for name, test in [
        *[(f"null {f}", f"{f} IS NULL") for f in _FIELDS],
        ("open<=0", "open <= 0"),
        ("close<=0", "close <= 0"),
        ("low<=0", "low <= 0"),
        ("high<low", "high < low"),
        ("volume<0", "volume < 0"),
        *[(f"nan {f}", f"isnan({f})") for f in ("open", "high", "low", "close", "volume")],
    ]
)

_MONTHS = """
ranges AS (
  SELECT 'C' || o_custkey AS symbol,
         year(min(o_orderdate)) * 12 + month(min(o_orderdate)) - 1 AS first,
         year(max(o_orderdate)) * 12 + month(max(o_orderdate)) - 1 AS last
  FROM orders GROUP BY o_custkey),
manifest AS (
  SELECT symbol, "interval", CAST(m // 12 AS INTEGER) AS year, CAST(m % 12 + 1 AS INTEGER) AS month
  FROM (SELECT symbol, '1m' AS "interval", unnest(range(first, last + 1)) AS m FROM ranges))"""


def _after_loss(gap_columns: str) -> str:
    lost = "symbol = 'N-F' AND open_time >= 883612800000 AND open_time < 915148800000"
    return f"""WITH {_DAILY}, kept AS (SELECT * FROM daily WHERE NOT ({lost})), refined AS ({_gaps('kept', 86_400_000)})
SELECT {gap_columns}, close,
  CASE WHEN symbol = 'N-F' THEN (SELECT count(*) FROM daily WHERE {lost}) ELSE 0 END AS dropped_rows
FROM refined"""


_NON_MONOTONIC = """SELECT symbol, count(*) FILTER (WHERE open_time <= highest) AS non_monotonic, count(*) AS rows FROM (
  SELECT symbol, open_time, max(open_time) OVER (
    PARTITION BY symbol ORDER BY num_trades ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest FROM raw)
GROUP BY symbol"""


def _rounded_once(total: str) -> str:
    """The double nearest to a positive whole number in units of 2**-64: 61 bits of it, the last set if any bit below is."""
    shift = f"greatest(0, CAST(floor(log2({total}::DOUBLE)) AS INTEGER) - 60)"
    unit = f"CAST(pow(2, {shift}) AS HUGEINT)"
    return f"(CAST({total} // {unit} AS BIGINT) | (CASE WHEN {total} % {unit} <> 0 THEN 1 ELSE 0 END))::DOUBLE * pow(2, {shift} - 64)"


# Closes and volumes are at least 2**-11, so a term is a whole number of units of 2**-64.
_EXACT_VWAP = f"""terms AS (
  SELECT symbol, open_time, CAST((close / 3) * volume * pow(2, 64) AS HUGEINT) AS pv, CAST(volume * pow(2, 64) AS HUGEINT) AS v FROM daily),
sums AS (
  SELECT symbol, open_time, sum(pv) OVER w AS pv, sum(v) OVER w AS v
  FROM terms WINDOW w AS (PARTITION BY symbol ORDER BY open_time ROWS UNBOUNDED PRECEDING))
SELECT symbol, open_time, ({_rounded_once("pv")}) / ({_rounded_once("v")}) AS vwap, CAST(3 AS BIGINT) AS alike FROM sums"""


def _least_scale(x: str, name: str) -> str:
    fits = " ".join(f"WHEN abs(CAST(TRY_CAST({x} AS DECIMAL(18,{n})) AS DOUBLE) - {x}) <= abs({x}) * pow(2, -49) THEN {n}" for n in range(18))
    return f"max(CASE {fits} END) AS {name}_scale, count(*) FILTER (WHERE {x} IS NOT NULL AND (CASE {fits} END) IS NULL) AS {name}_unfit"


_ACCOUNT = f"""o AS (
  SELECT upper(symbol) AS symbol, open_time,
    CASE WHEN symbol IS NOT NULL AND num_trades % 109 = 0 THEN 'stray' ELSE CASE {_REASONS} END END AS outcome FROM raw),
k AS (SELECT *, row_number() OVER (PARTITION BY symbol, open_time, outcome) AS copy FROM o),
c AS (
  SELECT symbol, coalesce(outcome, CASE WHEN copy > 1 THEN 'copy' ELSE 'kept' END) AS outcome, count(*) AS rows
  FROM k GROUP BY ALL),
t AS (
  SELECT symbol, CAST(sum(rows) AS BIGINT) AS raw_rows,
    CAST(coalesce(sum(rows) FILTER (outcome = 'kept'), 0) AS BIGINT) AS refined_rows FROM c GROUP BY symbol)
SELECT t.symbol, outcome, coalesce(rows, 0) AS rows, raw_rows, refined_rows, raw_rows - refined_rows AS dropped_rows,
  CAST(0 AS BIGINT) AS unexplained_rows
FROM t LEFT JOIN (SELECT symbol AS s, outcome, rows FROM c WHERE outcome <> 'kept') ON s IS NOT DISTINCT FROM t.symbol"""

_CHANGES = """SELECT DISTINCT symbol, strftime(epoch_ms(open_time), '%Y') AS year_month,
  CASE symbol WHEN 'R-F' THEN 'added' WHEN 'N-F' THEN 'changed' ELSE 'vanished' END AS change
FROM daily
WHERE (symbol, strftime(epoch_ms(open_time), '%Y')) IN (('R-F', '1993'), ('N-F', '1998'), ('A-F', '1992'))"""


def oracle_sql() -> dict[str, str]:
    hourly, daily = f"WITH {_HOURLY}\n", f"WITH {_DAILY}\n"
    raw, clean, refined = f"WITH {_RAW}\n", f"WITH {_CLEAN}\n", f"WITH {_REFINED}\n"
    gap_columns = "symbol, open_time, gap_minutes_before, has_gap_before"
    refreshed = f"""WITH {_DAILY}, refined AS ({_gaps('daily', 86_400_000)})
SELECT {gap_columns}, close, prev_close, returns, close_ma_20, close_ma_50, vwap, volatility_20
FROM ({_curated("refined")})"""
    return {
        "hourly_bars": hourly + "SELECT * FROM hourly",
        "daily_bars": daily + "SELECT * FROM daily",
        "scan_bars_csv": f"WITH {_SOURCE} SELECT * FROM source",
        "scan_bars_zip": f"WITH {_SOURCE} SELECT * FROM source",
        "source_manifest": f"WITH {_MONTHS} SELECT * FROM manifest",
        "missing_sources": f"""WITH {_MONTHS}
SELECT * FROM manifest m WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE 'C' || o.o_custkey = m.symbol
    AND year(o.o_orderdate) = m.year AND month(o.o_orderdate) = m.month)""",
        "unify_symbols": f"WITH {_HOURLY}, {_DAILY}\nSELECT * FROM hourly UNION ALL BY NAME SELECT * FROM daily",
        "scan_layer": daily
        + """SELECT symbol, strftime(epoch_ms(open_time), '%Y') AS year_month, open_time, close
FROM daily""",
        "tag_symbol": hourly + "SELECT * REPLACE ('ALL' AS symbol) FROM hourly",
        "write_layer": raw + "SELECT * FROM raw",
        "normalize_epoch_ms": """
WITH mixed AS (
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN epoch_us(ts) ELSE epoch_us(ts) // 1000 END AS t FROM events),
in_ms AS (
  SELECT event_id, CAST(CASE WHEN t > 100000000000000 THEN t // 1000 ELSE t END AS BIGINT) AS open_time FROM mixed)
SELECT event_id, open_time, open_time // 1000 AS open_seconds,
       CAST(epoch_ms(open_time) AS DATE) AS date, strftime(epoch_ms(open_time), '%Y-%m') AS year_month
FROM in_ms""",
        "raw_bars": raw + "SELECT * FROM raw",
        "filter_invalid_bars": raw + f"SELECT * FROM raw WHERE {_VALID}",
        "dedup_rows": """
SELECT * EXCLUDE (copy) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS copy
  FROM lineitem) WHERE copy = 1""",
        "dedup_bars": raw + _first_copy("raw"),
        "dedup_repeated_bars": raw + _first_copy("raw"),
        "clean_bars": clean + "SELECT * FROM clean",
        "detect_time_gaps": refined + f"SELECT {gap_columns} FROM refined",
        "detect_time_gaps_sliced": refined + f"SELECT {gap_columns} FROM refined",
        "prev_close": hourly + f"SELECT *, {_PREV} FROM hourly",
        "period_returns": hourly + f"SELECT *, {_RETURNS} FROM (SELECT *, {_PREV} FROM hourly)",
        "moving_average": hourly + f"SELECT *, {_average(20)}, {_average(50)} FROM hourly",
        "cumulative_vwap": hourly + f"SELECT *, {_VWAP} FROM hourly",
        "rolling_volatility": hourly
        + f"SELECT *, {_VOLATILITY} FROM (SELECT *, {_RETURNS} FROM (SELECT *, {_PREV} FROM hourly))",
        "curated_bars": hourly + _curated("hourly"),
        "curated_bars_daily": daily + _curated("daily"),
        "curated_bars_sliced": daily + _curated("daily"),
        "null_counts": raw + f"SELECT {_NULLS} FROM raw",
        "invalid_price_count": raw + f"SELECT {_INVALID} AS invalid_price_count FROM raw",
        "duplicate_keys": raw + _duplicates("raw"),
        "validity_report": raw
        + f"""SELECT {_NULLS}, {_TOTAL_NULLS} AS total_nulls, {_INVALID} AS invalid_price_count,
  (SELECT count(*) FROM ({_duplicates("raw")})) AS duplicate_count FROM raw""",
        "completeness": hourly + _complete("hourly", 3_600_000),
        "completeness_by_day": clean + _complete("clean", 60_000, "symbol, date"),
        "continuity": refined
        + """SELECT symbol, CAST(sum(gap_minutes_before) AS BIGINT) AS total_missing_minutes,
  count(*) FILTER (WHERE has_gap_before) AS gap_events FROM refined GROUP BY symbol""",
        "reconcile_counts": clean + _COUNTS,
        "reconcile_daily": clean
        + """SELECT symbol, date, coalesce(raw_rows, 0) AS raw_rows, raw_volume,
       coalesce(refined_rows, 0) AS refined_rows, refined_volume,
       coalesce(raw_rows, 0) - coalesce(refined_rows, 0) AS dropped_rows
FROM (SELECT symbol, date, count(*) AS raw_rows,
        CAST(sum(CAST(volume AS DECIMAL(18,2))) AS DOUBLE) AS raw_volume FROM raw GROUP BY symbol, date)
FULL OUTER JOIN (SELECT symbol, date, count(*) AS refined_rows,
        CAST(sum(CAST(volume AS DECIMAL(18,2))) AS DOUBLE) AS refined_volume FROM clean GROUP BY symbol, date)
  USING (symbol, date)""",
        "drop_reasons": raw
        + f"""SELECT symbol, reason, count(*) AS dropped_rows
FROM (SELECT symbol, CASE {_REASONS} END AS reason FROM raw) WHERE reason IS NOT NULL GROUP BY symbol, reason""",
        "out_of_bounds_count": raw
        + """SELECT count(*) FILTER (WHERE NOT close BETWEEN 1 AND 100) AS out_of_bounds_close,
  count(*) FILTER (WHERE NOT volume BETWEEN 0 AND 500) AS out_of_bounds_volume FROM raw""",
        "quality_status": f"""WITH {_HOURLY}, {_DAILY}, {_RAW}
SELECT status, 'daily' AS bars FROM ({_figures("daily", 86_400_000)})
UNION ALL SELECT status, 'hourly' FROM ({_figures("hourly", 3_600_000)})
UNION ALL SELECT status, 'dirty' FROM ({_figures("raw", 60_000)})""",
        "quality_report": refined
        + f"""SELECT f.*,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM clean) AS dropped_rows,
  (SELECT CAST(sum(gap_minutes_before) AS BIGINT) FROM refined) AS missing_minutes
FROM ({_figures("refined", 60_000)}) f""",
        "build_raw": raw + "SELECT * FROM raw",
        "build_refined": refined + "SELECT * FROM refined",
        "build_curated": refined + _curated("refined"),
        "build_quality": refined + _figures("refined", 60_000),
        "ingest_bars": raw + "SELECT * REPLACE (upper(symbol) AS symbol) FROM raw WHERE symbol IS NOT NULL",
        "ingest_bars_missing": """SELECT DISTINCT upper(event_type) AS symbol, '1m' AS "interval",
  2024 AS year, 2 AS month FROM events""",
        "run_lakehouse": refined
        + f"""SELECT upper(symbol) AS symbol, open_time, gap_minutes_before, has_gap_before, close, prev_close,
  {_RETURNS}, (SELECT status FROM ({_figures("refined", 60_000)})) AS status
FROM (SELECT *, {_PREV} FROM refined)""",
        "rebuild_after_loss": _after_loss(gap_columns),
        "refresh_after_loss": _after_loss(gap_columns),
        "invalid_price_not_finite": f"""WITH {_DAILY}
SELECT count(*) AS row_count,
  CAST(count(*) FILTER (open_time // 86400000 % 11 = 0 OR open_time // 86400000 % 13 = 0) AS BIGINT) AS invalid_price_count,
  'fail' AS status FROM daily""",
        "refresh_layers": refreshed,
        "refresh_changed_layers": refreshed,
        "scan_bars_zip_landed": f"WITH {_SOURCE} SELECT * FROM source",
        "ingest_bars_zip": raw + "SELECT * REPLACE (upper(symbol) AS symbol) FROM raw WHERE symbol IS NOT NULL",
        "ingest_new_bars": """
SELECT upper(symbol) AS symbol, count(*) AS rows,
  (SELECT count(DISTINCT event_type) FROM events WHERE event_type < 'm') AS files_0,
  (SELECT count(DISTINCT event_type) FROM events WHERE event_type >= 'm') AS files_1, CAST(0 AS BIGINT) AS files_2
FROM (SELECT event_type AS symbol FROM events WHERE event_id % 83 <> 0) GROUP BY symbol""",
        "source_manifest_config": """
WITH ranges AS (
  SELECT 0 AS config, n_name AS symbol, CASE WHEN n_nationkey % 2 = 1 THEN '5m' ELSE '1m' END AS "interval",
         2020 * 12 + n_nationkey % 12 AS first,
         CASE WHEN n_nationkey % 3 <> 0 THEN 2021 ELSE 2020 END * 12 + n_nationkey % 12 AS last FROM nation
  UNION ALL SELECT 1, first(n_name ORDER BY n_nationkey), '1m', 2022 * 12 + 4, 2022 * 12 + 4 FROM nation
  UNION ALL SELECT 2, 'BTCUSDT', '1m', 2023 * 12, 2023 * 12)
SELECT config, symbol, "interval", CAST(m // 12 AS INTEGER) AS year, CAST(m % 12 + 1 AS INTEGER) AS month
FROM (SELECT *, unnest(range(CAST(first AS BIGINT), CAST(last AS BIGINT) + 1)) AS m FROM ranges)""",
        "bounds_from_quantiles": daily
        + "SELECT symbol, count(*) AS rows, true AS within_error, CAST(1 AS BIGINT) AS out_of_bounds_close FROM daily GROUP BY symbol",
        "non_monotonic_times": raw + _NON_MONOTONIC,
        "non_monotonic_times_cut": raw + _NON_MONOTONIC,
        "quality_sections_csv": refined
        + f"""SELECT * FROM ({_complete("refined", 60_000)}) JOIN (
  SELECT symbol, CAST(sum(gap_minutes_before) AS BIGINT) AS total_missing_minutes,
    count(*) FILTER (WHERE has_gap_before) AS gap_events FROM refined GROUP BY symbol) USING (symbol)""",
        "cumulative_vwap_cut": f"WITH {_DAILY},\n{_EXACT_VWAP}",
        "exact_scale_of": daily
        + f"""SELECT {_least_scale("close", "close")}, {_least_scale("volume", "volume")},
  {_least_scale("(close / 4)", "quarter")}, {_least_scale("(close / 8)", "eighth")} FROM daily""",
        "changed_partitions": daily + _CHANGES,
        "drop_accounting": f"WITH {_RAW},\n{_ACCOUNT}",
    }
