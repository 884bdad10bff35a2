import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from barloom.operators.clean import clean_bars, detect_time_gaps
from barloom.operators.metrics import curated_bars
from barloom.operators.series import Slices
from barloom.plans import pipeline
from barloom.plans.pipeline import (
    LayerPaths,
    QualityCheckFailed,
    build_curated,
    build_refined,
    ingest_bars,
    ingest_new_bars,
    refresh_layers,
    run_lakehouse,
)
from barloom.sources.layers import empty_partitions, scan_layer, write_layer
from barloom.sources.manifest import source_manifest
from barloom.sources.schema import CURATED_SCHEMA, RAW_SCHEMA, REFINED_SCHEMA
from barloom.spec import BarSpec

DAY = 86_400_000
DAILY = BarSpec(interval_ms=DAY)
JAN_2024 = 1_704_067_200_000
MONTHS = [("2024-01", 0, 31), ("2024-02", 31, 60), ("2024-03", 60, 91), ("2025-01", 366, 397)]


def line(t, price, volume=5.0):
    unit = 1000 if t >= JAN_2024 + 366 * DAY else 1
    return f"{t * unit},{price},{price + 1},{price - 1},{price},{volume},{(t + DAY - 1) * unit},1,1,1,1,0"


def land(folder: Path, symbol: str, skip=(), seed=1):
    rng = random.Random(seed)
    folder.mkdir(parents=True, exist_ok=True)
    for month, first, last in MONTHS:
        lines = [line(JAN_2024 + d * DAY, 50 + rng.randrange(4000) / 100) for d in range(first, last) if d not in skip]
        (folder / f"{symbol}-1d-{month}.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture
def paths(tmp_path):
    return LayerPaths(*[str(tmp_path / p) for p in ("landing", "raw", "refined", "curated", "quality")])


def test_whole_run(spark, paths):
    for symbol in ("AAA", "BBB"):
        land(Path(paths.landing) / symbol.lower(), symbol)
    # Two months are wanted that are not there, and one that is there is not wanted.
    config = {
        "sources": [
            {"symbol": "aaa", "interval": "1d", "start_year": 2024, "start_month": 1, "end_month": 3},
            {"symbol": "BBB", "interval": "1d", "start_year": 2024, "start_month": 1, "end_month": 5},
        ]
    }
    manifest = source_manifest(spark, config)
    missing = ingest_bars(spark, paths.landing, paths.raw, manifest)
    assert sorted(tuple(r) for r in missing.collect()) == [("BBB", "1d", 2024, 4), ("BBB", "1d", 2024, 5)]
    assert run_lakehouse(spark, paths, manifest, DAILY) == "pass"

    curated = scan_layer(spark, paths.curated, CURATED_SCHEMA)
    assert curated.count() == 182 and curated.where("symbol = 'AAA'").select("year_month").distinct().count() == 3
    assert curated.where("prev_close IS NULL").count() == 2
    [text] = Path(paths.quality, "quality_report.json").glob("part-*.txt")
    report = json.loads(text.read_text())
    assert text.read_text().count("\n") > 10
    assert report["status"] == "pass" and report["row_count"] == 182
    assert report["reconciliation"] == {"raw_rows": 182, "refined_rows": 182, "dropped_rows": 0}
    sections = {p.name for p in Path(paths.quality).iterdir()}
    assert {"completeness", "continuity", "reconciliation", "profile"} <= sections


def test_gate_raises_after_the_report(spark, paths):
    land(Path(paths.landing), "AAA")
    with pytest.raises(QualityCheckFailed):
        run_lakehouse(spark, paths, spec=DAILY)
    [text] = Path(paths.quality, "quality_report.json").glob("part-*.txt")
    assert json.loads(text.read_text())["status"] == "fail"


def test_warning_passes_the_gate(spark, paths):
    land(Path(paths.landing), "AAA", skip={5, 40, 41})
    (Path(paths.landing) / "AAA-1d-2025-01.csv").unlink()
    assert run_lakehouse(spark, paths, spec=DAILY) == "warning"


@pytest.mark.parametrize("max_rows", [10**6, 20])
def test_builds_do_not_depend_on_the_cut(spark, paths, max_rows):
    land(Path(paths.landing), "AAA", skip={3, 4, 30, 31, 32})
    land(Path(paths.landing), "BBB", seed=2)
    ingest_bars(spark, paths.landing, paths.raw)
    refined = build_refined(spark, paths.raw, paths.refined, DAILY, max_rows=max_rows)
    curated = build_curated(spark, paths.refined, paths.curated, DAILY, max_rows=max_rows, exact_scale=2)
    assert refined.columns[:-2] == [c for c in REFINED_SCHEMA.names if c not in ("symbol", "year_month")]
    gaps = {(r.symbol, r.gap_minutes_before) for r in refined.where("has_gap_before").collect()}
    assert gaps == {("AAA", 2), ("AAA", 3), ("AAA", 275), ("BBB", 275)}
    # One file per partition, without a repartition before the write.
    assert curated.select(F.input_file_name()).distinct().count() == 8
    once = curated.drop("volatility_20").collect()
    again = build_curated(spark, paths.refined, paths.curated + "-whole", DAILY, exact_scale=2)
    assertDataFrameEqual(once, again.drop("volatility_20").collect())


def test_refined_is_raw_less_what_was_dropped(spark, paths):
    folder = Path(paths.landing)
    land(folder, "AAA")
    extra = [line(JAN_2024, 50.0), line(JAN_2024 + DAY, -1.0), "garbage"]
    (folder / "AAA-1d-2024-01.csv").open("a").write("\n".join(extra) + "\n")
    ingest_bars(spark, paths.landing, paths.raw)
    assert scan_layer(spark, paths.raw, RAW_SCHEMA).count() == 125
    refined = build_refined(spark, paths.raw, paths.refined, DAILY)
    assert refined.count() == 122
    build_refined(spark, paths.raw, paths.refined, DAILY)
    assert scan_layer(spark, paths.refined, REFINED_SCHEMA).count() == 122


@pytest.mark.parametrize("gone, listed", [(False, 1000), (True, 1000), (False, 0)])
def test_refresh_equals_a_full_rebuild(spark, paths, gone, listed, monkeypatch):
    monkeypatch.setattr(pipeline, "MAX_LISTED_SYMBOLS", listed)
    land(Path(paths.landing), "AAA")
    land(Path(paths.landing), "BBB", seed=2)
    ingest_bars(spark, paths.landing, paths.raw)
    build_refined(spark, paths.raw, paths.refined, DAILY)
    build_curated(spark, paths.refined, paths.curated, DAILY)
    untouched = {p: p.stat().st_mtime_ns for p in Path(paths.curated).glob("symbol=BBB/*/*.parquet")}

    days = [d for d in range(31, 60) if d not in (31, 58, 59)]
    price = -1.0 if gone else 70.5
    lines = [line(JAN_2024 + d * DAY, price) for d in days]
    (Path(paths.landing) / "AAA-1d-2024-02.csv").write_text("\n".join(lines) + "\n")
    ingest_bars(spark, paths.landing, paths.raw)
    changed = spark.createDataFrame([("AAA", "2024-02")], "symbol string, year_month string")
    refresh_layers(spark, paths, changed, DAILY)

    refined = scan_layer(spark, paths.refined, REFINED_SCHEMA)
    curated = scan_layer(spark, paths.curated, CURATED_SCHEMA)
    whole = build_refined(spark, paths.raw, paths.refined + "-whole", DAILY)
    assertDataFrameEqual(refined.collect(), whole.collect())
    fresh = build_curated(spark, paths.refined + "-whole", paths.curated + "-whole", DAILY)
    assertDataFrameEqual(curated.collect(), fresh.collect(), rtol=1e-9)
    assert {p: p.stat().st_mtime_ns for p in Path(paths.curated).glob("symbol=BBB/*/*.parquet")} == untouched


def test_a_rebuild_drops_partitions_that_vanished(spark, paths):
    land(Path(paths.landing), "AAA")
    ingest_bars(spark, paths.landing, paths.raw)
    build_curated(spark, paths.refined, paths.curated, DAILY) if build_refined(spark, paths.raw, paths.refined, DAILY).count() else None
    lines = [line(JAN_2024 + d * DAY, -1.0) for d in range(31, 60)]
    (Path(paths.landing) / "AAA-1d-2024-02.csv").write_text("\n".join(lines) + "\n")
    ingest_bars(spark, paths.landing, paths.raw)
    assert build_refined(spark, paths.raw, paths.refined, DAILY).where("year_month = '2024-02'").count() == 0
    assert build_curated(spark, paths.refined, paths.curated, DAILY).where("year_month = '2024-02'").count() == 0


def test_a_file_leaves_other_months_alone(spark, paths):
    folder = Path(paths.landing)
    land(folder, "AAA")
    ingest_bars(spark, paths.landing, paths.raw)
    january = scan_layer(spark, paths.raw, RAW_SCHEMA).where("year_month = '2024-01'").count()
    for path in folder.glob("*.csv"):
        if "2024-02" not in path.name:
            path.unlink()
    (folder / "AAA-1d-2024-02.csv").open("a").write(line(JAN_2024 + 3 * DAY, 9.0) + "\nheader,a,b\n")
    for _ in range(2):
        ingest_bars(spark, paths.landing, paths.raw)
        raw = scan_layer(spark, paths.raw, RAW_SCHEMA)
        assert raw.where("year_month = '2024-01'").count() == january
        assert raw.where("year_month = '2024-02'").count() == 30 and raw.where("open_time IS NULL").count() == 1
        assert spark.read.parquet(paths.raw + "-strays").count() == 1


def test_two_intervals_of_a_month_are_refused(spark, paths):
    land(Path(paths.landing), "AAA")
    (Path(paths.landing) / "AAA-1h-2024-02.csv").write_text(line(JAN_2024 + 31 * DAY, 9.0) + "\n")
    with pytest.raises(ValueError, match="several intervals"):
        ingest_bars(spark, paths.landing, paths.raw)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from barloom.scratch import scratch_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(cluster)


def test_chosen_months_prune_the_scan(spark, paths):
    land(Path(paths.landing), "AAA")
    ingest_bars(spark, paths.landing, paths.raw)
    refined = build_refined(spark, paths.raw, paths.refined, DAILY)
    months = refined.where("year_month >= '2024-03'").select("symbol", "year_month").distinct()
    plan = curated_bars(refined, DAILY, slices=Slices(column="year_month"), months=months)
    scan = next(x for x in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    assert ">= 2024-03" in scan.split("PartitionFilters")[1].split("]")[0]


def test_whole_slices_are_replaced_for_a_refresh():
    from barloom.plans.pipeline import _by_month

    assert _by_month(Slices(), DAILY).column == "year_month"


def test_shuffles_of_the_refined_build(spark, paths):
    land(Path(paths.landing), "AAA")
    ingest_bars(spark, paths.landing, paths.raw)
    raw = scan_layer(spark, paths.raw, RAW_SCHEMA)
    times = raw.select("symbol", "open_time", "year_month")
    gaps = detect_time_gaps(clean_bars(raw, DAILY), DAILY, Slices(column="year_month"), times=times)
    lines = gaps._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    exchanges = [line for line in lines[:scan] if "Exchange" in line]
    # One to de-duplicate, one for the gaps; the filters reach the scan.
    assert len(exchanges) == 2 and "open_time" in exchanges[1]
    assert "GreaterThan(open,0.0)" in lines[scan]


def test_planning_a_layer_reads_no_data_columns(spark, paths):
    land(Path(paths.landing), "AAA")
    ingest_bars(spark, paths.landing, paths.raw)
    raw = scan_layer(spark, paths.raw, RAW_SCHEMA)
    counts = raw.groupBy("symbol", "year_month").count()
    assert "ReadSchema: struct<>" in counts._jdf.queryExecution().executedPlan().toString()


def test_many_copies_of_one_bar(spark, paths):
    """Copies far above the number of other rows, and one symbol far above ``max_rows``."""
    folder = Path(paths.landing)
    land(folder, "AAA")
    lines = [line(JAN_2024 + 31 * DAY, 50.0, 5.0 + i % 3) for i in range(3000)]
    (folder / "AAA-1d-2024-02.csv").open("a").write("\n".join(lines) + "\n")
    ingest_bars(spark, paths.landing, paths.raw)
    cut = build_refined(spark, paths.raw, paths.refined, DAILY, max_rows=20)
    whole = build_refined(spark, paths.raw, paths.refined + "-whole", DAILY)
    assert cut.count() == 122
    assertDataFrameEqual(cut.collect(), whole.collect())


def test_a_build_that_fails_leaves_the_old_layer(spark, paths):
    land(Path(paths.landing), "AAA")
    ingest_bars(spark, paths.landing, paths.raw)
    refined = build_refined(spark, paths.raw, paths.refined, DAILY)
    before = sorted(map(str, refined.collect()))
    fails = refined.withColumn("close", F.when(F.col("open_time") > JAN_2024 + 370 * DAY, F.raise_error(F.lit("lost"))).otherwise(F.col("close")))
    copy = fails.write.mode("overwrite")
    with pytest.raises(Exception, match="lost"):
        copy.parquet(paths.quality)
    source = spark.createDataFrame(refined.toPandas(), refined.schema)
    broken = source.withColumn("close", F.when(F.col("open_time") > JAN_2024 + 370 * DAY, F.raise_error(F.lit("lost"))).otherwise(F.col("close")))
    with pytest.raises(Exception, match="lost"):
        write_layer(broken, paths.refined, DAILY, whole=True)
    assert sorted(map(str, scan_layer(spark, paths.refined, REFINED_SCHEMA).collect())) == before
    write_layer(source.where("year_month = '2024-02'"), paths.refined, DAILY, whole=True)
    left = scan_layer(spark, paths.refined, REFINED_SCHEMA)
    assert left.count() == 29 and left.select("year_month").distinct().count() == 1
    write_layer(source.where("false"), paths.refined, DAILY, whole=True)
    assert scan_layer(spark, paths.refined, REFINED_SCHEMA).count() == 0


def test_partitions_with_odd_names_are_emptied(spark, tmp_path):
    path = str(tmp_path / "layer")
    rows = [(s, "2024-01", 1) for s in ("A B", "C%D", "E+F", "G=H", "I/J", "é")] + [("K", "2024-01", 1)]
    df = spark.createDataFrame(rows, "symbol string, year_month string, open_time long")
    write_layer(df, path)
    schema = df.schema
    empty_partitions(spark, path, schema, df.where("symbol IN ('A B', 'E+F', 'é')"))
    assert sorted(r["symbol"] for r in scan_layer(spark, path, schema).collect()) == ["C%D", "G=H", "I/J", "K"]
    write_layer(df.where("symbol = 'K'"), path, whole=True)
    assert [r["symbol"] for r in scan_layer(spark, path, schema).collect()] == ["K"]


def test_new_and_changed_files_are_ingested_once(spark, paths, monkeypatch):
    folder = Path(paths.landing)
    land(folder, "AAA")
    names = lambda found: sorted(Path(p).name for p in found)
    assert len(ingest_new_bars(spark, paths.landing, paths.raw)) == 4 and ingest_new_bars(spark, paths.landing, paths.raw) == []
    # A second file of a month, and a first one of another symbol.
    (folder / "more").mkdir()
    (folder / "more" / "AAA-1d-2024-02.csv").write_text(line(JAN_2024 + 59 * DAY, 9.0, 8.0) + "\n")
    (folder / "more" / "BBB-1d-2024-02.csv").write_text(line(JAN_2024 + 40 * DAY, 9.0) + "\n")
    with monkeypatch.context() as failing:
        failing.setattr(pipeline, "write_version", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest_new_bars(spark, paths.landing, paths.raw)
    assert names(ingest_new_bars(spark, paths.landing, paths.raw)) == ["AAA-1d-2024-02.csv", "BBB-1d-2024-02.csv"]
    raw = scan_layer(spark, paths.raw, RAW_SCHEMA)
    counts = {(r["symbol"], r["year_month"]): r["count"] for r in raw.groupBy("symbol", "year_month").count().collect()}
    assert counts == {("AAA", "2024-01"): 31, ("AAA", "2024-02"): 30, ("AAA", "2024-03"): 31, ("AAA", "2025-01"): 31, ("BBB", "2024-02"): 1}
    (folder / "more" / "BBB-1d-2024-02.csv").write_text("\n".join(line(JAN_2024 + d * DAY, 9.0) for d in (40, 41)) + "\n")
    assert names(ingest_new_bars(spark, paths.landing, paths.raw)) == ["BBB-1d-2024-02.csv"]
    assert scan_layer(spark, paths.raw, RAW_SCHEMA).where("symbol = 'BBB'").count() == 2


def test_the_report_is_one_file_too(spark, paths):
    land(Path(paths.landing), "AAA")
    with pytest.raises(QualityCheckFailed):
        run_lakehouse(spark, paths, spec=DAILY)
    one = json.loads(Path(paths.quality, "report.json").read_text())
    [text] = Path(paths.quality, "quality_report.json").glob("part-*.txt")
    assert one == json.loads(text.read_text()) and one["row_count"] == 122
    drops = spark.read.json(paths.quality + "/drops")
    assert drops.agg(F.sum("dropped_rows")).first()[0] == 0
