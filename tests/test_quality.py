import pytest
from pyspark.sql import functions as F

from barloom.operators import quality
from barloom.operators.bounds import bounds_from_quantiles, merged_sketches, out_of_bounds_by_key, quantile_sketches
from barloom.operators.clean import detect_time_gaps
from barloom.operators.quality import non_monotonic_times
from barloom.operators.series import Slices
from barloom.spec import BarSpec

MINUTE = 60_000


@pytest.fixture
def status_rows(spark):
    def make(times, close=42.5):
        rows = [("Q", t, close, 47.25, 39.5, 41.0) for t in times]
        return spark.createDataFrame(
            rows, "symbol string, open_time long, close double, high double, low double, open double"
        )

    return make


def test_validity(spark):
    rows = [("Q", 7, 3.5), ("R", 7, 3.25), ("R", 7, 3.0), ("Q", 8, -0.5)]
    df = spark.createDataFrame(rows, "symbol string, open_time long, close double").selectExpr(
        "*", "4.5D AS high", "2.75D AS low", "6D AS volume"
    )
    got = quality.validity_report(df).first()
    assert got["duplicate_count"] == 1 and got["invalid_price_count"] == 1
    assert got["total_nulls"] == 0 and got["null_counts"] == {}
    assert quality.present_fields(df, BarSpec()) == ["symbol", "open_time", "high", "low", "close", "volume"]
    assert quality.skipped_fields(df, BarSpec()) == ["open"]


def test_duplicates_count_keys_not_rows(bars):
    df = bars(("A", 1, 1.0), ("A", 1, 1.0), ("A", 1, 1.0), ("B", 1, 1.0), ("B", 1, 2.0), (None, 2, 1.0), (None, 2, 1.0))
    assert quality.validity_report(df).first()["duplicate_count"] == 3
    assert sorted(r["copies"] for r in quality.duplicate_keys(df).collect()) == [2, 2, 3]


def test_null_counts(bars):
    df = bars((None, 1, 1.0), ("A", None, 1.0), ("A", None, None), ("A", 4, 1.0))
    got = quality.validity_report(df).first()
    assert got["null_counts"] == {"symbol": 1, "open_time": 2, "open": 1, "high": 1, "low": 1, "close": 1}
    assert got["total_nulls"] == 7
    assert quality.null_counts(df).first()["null_open_time"] == 2


def test_null_prices_are_not_invalid(bars):
    df = bars(("A", 1, None), ("A", 2, 0.0), ("A", 3, float("nan")))
    assert quality.invalid_price_count(df).first()[0] == 2
    assert quality.quality_status(bars(("A", 1, float("nan")))).first()["status"] == "fail"
    assert quality.quality_status(bars(("A", 1, float("inf")))).first()["status"] == "fail"


def test_completeness(bars):
    got = quality.completeness(bars(*[("A", t * MINUTE, 1.0) for t in range(3)], ("B", 0, 1.0), ("B", 9 * MINUTE, 1.0)))
    rows = {r.symbol: r for r in got.collect()}
    assert (rows["A"].expected_rows, rows["A"].completeness_ratio) == (3, 1.0)
    assert (rows["B"].actual_rows, rows["B"].expected_rows, rows["B"].completeness_ratio) == (2, 10, 0.2)


def test_gaps_and_rows_add_up_to_the_grid(bars):
    times = [0, 1, 2, 5, 6, 11]
    df = detect_time_gaps(bars(*[("A", t * MINUTE, 1.0) for t in times]))
    missing = quality.continuity(df).first()
    extent = quality.completeness(df).first()
    assert (missing.total_missing_minutes, missing.gap_events) == (6, 2)
    assert missing.total_missing_minutes + extent.actual_rows == extent.expected_rows


def test_continuity_without_gap_columns(bars):
    assert quality.continuity(bars(("A", 1, 1.0))).count() == 0


def test_reconciliation(bars):
    raw = bars(*[("A", t, 1.0) for t in range(3)])
    refined = bars(("A", 1, 1.0), *[("C", t, 1.0) for t in range(5)])
    got = {r.symbol: (r.raw_rows, r.refined_rows, r.dropped_rows) for r in quality.reconcile_counts(raw, refined).collect()}
    assert got == {"A": (3, 1, 2), "C": (0, 5, -5)}


def test_null_symbols_do_not_match(bars):
    both = bars((None, 1, 1.0))
    got = quality.reconcile_counts(both, both).collect()
    assert sorted((r.raw_rows, r.refined_rows) for r in got) == [(0, 1), (1, 0)]


@pytest.mark.parametrize(
    "minutes, status",
    [
        (range(3), "pass"),
        ([0, 1000], "fail"),
        ([m for m in range(100) if m not in (10, 20, 30, 40)], "warning"),
        ([m for m in range(100) if m != 50], "pass"),
        ([m for m in range(100) if not 20 <= m < 30], "warning"),
        ([m for m in range(100) if not 20 <= m <= 30], "fail"),
        ([0, 1, 1, 2], "fail"),
        ([], "pass"),
    ],
)
def test_status(status_rows, minutes, status):
    assert quality.quality_status(status_rows([m * MINUTE for m in minutes])).first()["status"] == status


def test_status_of_prices_and_of_nothing(status_rows):
    assert quality.quality_status(status_rows([0], close=0.0)).first()["status"] == "fail"
    assert quality.quality_status(status_rows([0], close=None)).first()["status"] == "fail"
    assert quality.quality_status(status_rows([]), require_rows=True).first()["status"] == "fail"


def test_gaps_alone_do_not_fail(bars):
    df = detect_time_gaps(bars(*[("A", t * MINUTE, 1.0) for t in range(200) if t != 7]))
    assert quality.quality_status(df).first()["status"] == "pass"


def test_report(bars):
    raw = bars(*[("B", t * MINUTE, 1.0) for t in range(4)], ("A", 0, 1.0), ("A", 0, 1.0))
    refined = detect_time_gaps(raw.dropDuplicates(["symbol", "open_time"]).where("open_time != 120000"))
    got = quality.quality_report(refined, raw, refined).first()
    assert got["row_count"] == 4 and got["status"] == "fail"
    assert tuple(got["completeness"]) == (2, 0.75) and tuple(got["continuity"]) == (1, 1)
    assert tuple(got["reconciliation"]) == (6, 4, 2)
    sections = quality.report_sections(refined, raw, refined)
    assert sorted(r["symbol"] for r in sections["completeness"].collect()) == ["A", "B"]
    assert sorted(tuple(r) for r in sections["continuity"].collect()) == [("A", 0, 0), ("B", 1, 1)]
    assert sorted(tuple(r) for r in sections["reconciliation"].collect()) == [("A", 2, 1, 1), ("B", 4, 3, 1)]


def test_report_without_layers(status_rows):
    got = quality.quality_report(status_rows([0, MINUTE])).first()
    assert tuple(got["continuity"]) == (None, None) and got["status"] == "pass"
    assert tuple(got["reconciliation"]) == (None, None, None) and got["skipped_fields"] == ["volume"]


def test_report_of_an_empty_table(status_rows):
    got = quality.quality_report(status_rows([])).first()
    assert got["row_count"] == 0 and tuple(got["completeness"]) == (0, None) and got["status"] == "pass"


def test_report_is_one_row_of_totals_however_many_keys(spark):
    keys = spark.range(60_000).selectExpr(
        "CAST(id AS STRING) AS symbol", "0L AS open_time", "1D AS open", "1D AS high", "1D AS low", "1D AS close", "1D AS volume"
    )
    got = quality.quality_report(keys).first()
    assert got["row_count"] == 60_000 and got["completeness"]["keys"] == 60_000 and got["status"] == "pass"


def test_profile_is_reduced_before_the_shuffle(bars):
    plan = quality.completeness(bars(("A", 1, 1.0)))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_min" in plan


def test_completeness_by_day(bars):
    df = bars(("A", 0, 1.0), ("A", MINUTE, 1.0), ("A", 86_400_000, 1.0)).withColumn(
        "date", F.to_date(F.timestamp_millis("open_time"))
    )
    got = quality.completeness(df, by=["date"]).collect()
    assert sorted((r.actual_rows, r.expected_rows) for r in got) == [(1, 1), (2, 2)]


def test_drop_reasons(bars):
    df = bars(("A", 1, 0.0), ("A", 2, None), (None, 3, 1.0), ("A", 4, 1.0), ("A", 5, float("nan")))
    got = {(r.symbol, r.reason): r.dropped_rows for r in quality.drop_reasons(df).collect()}
    assert got == {("A", "open<=0"): 1, ("A", "null open"): 1, (None, "null symbol"): 1, ("A", "nan open"): 1}


def test_reconcile_daily(bars):
    day = lambda df: df.withColumn("date", F.to_date(F.timestamp_millis("open_time")))
    raw = day(bars(("A", 0, 1.0, 2.0), ("A", 1, 1.0, 3.0), ("A", 86_400_000, 1.0, 4.0)))
    got = quality.reconcile_daily(raw, raw.where("open_time = 0")).orderBy("date").collect()
    assert [(r.raw_rows, r.refined_rows, r.raw_volume, r.refined_volume, r.dropped_rows) for r in got] == [
        (2, 1, 5.0, 2.0, 1),
        (1, 0, 4.0, None, 1),
    ]


def test_out_of_bounds(bars):
    df = bars(("A", 1, 5.0), ("A", 2, 50.0), ("A", 3, None))
    assert quality.out_of_bounds_count(df, {"close": (0, 10)}).first()["out_of_bounds_close"] == 1


def test_times_that_are_not_after_the_latest(spark):
    rows = [("a", n, t) for n, t in enumerate([5, 6, 6, 4, None, 7, 7, 6, 8])] + [("b", n, t) for n, t in enumerate([None, 3, 4])] + [(None, 1, 1), (None, 2, 1)]
    df = spark.createDataFrame(rows, "symbol string, arrival long, open_time long").repartition(3)
    for slices in (None, Slices(), Slices(width_ms=1), Slices(width_ms=2), Slices(width_ms=4)):
        found = {r["symbol"]: (r["non_monotonic"], r["rows"]) for r in non_monotonic_times(df, "arrival", slices=slices).collect()}
        assert found == {"a": (4, 9), "b": (0, 3), None: (1, 2)}
    assert non_monotonic_times(df.where("false"), "arrival").collect() == []


def test_bounds_of_merged_months_find_an_outlier(spark):
    rows = [("a", f"2024-0{1 + k % 3}", float(100 + k % 50)) for k in range(3000)] + [("a", "2024-02", 9000.0), ("b", "2024-01", float("nan")), ("b", "2024-01", None), (None, "2024-01", 1.0)]
    df = spark.createDataFrame(rows, "symbol string, year_month string, close double")
    sketches = quantile_sketches(df, ["close"])
    assert sketches.count() == 5
    found = bounds_from_quantiles(sketches, ["close"])
    limits = {r["symbol"]: (r["close_low"], r["close_high"]) for r in found.collect()}
    assert limits["b"] == (None, None) and limits[None] == (1.0, 1.0) and -60 < limits["a"][0] < 0 and 250 < limits["a"][1] < 310
    outside = {r["symbol"]: r["out_of_bounds_close"] for r in out_of_bounds_by_key(df, found, ["close"]).collect()}
    assert outside == {"a": 1, "b": 0, None: 0}
    whole = merged_sketches(sketches, ["close"])
    assert whole.count() == 3 and bounds_from_quantiles(sketches.where("false"), ["close"]).count() == 0
