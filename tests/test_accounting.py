from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from barloom.operators import repeats
from barloom.operators.accounting import clean_with_account
from barloom.operators.clean import clean_bars
from barloom.operators.repeats import suspect_spans
from barloom.plans import pipeline
from barloom.plans.pipeline import LayerPaths, account_for_drops, build_curated, build_refined, ingest_bars, refresh_layers
from barloom.sources import layers
from barloom.sources.digests import changed_partitions, layer_changes, partition_digests
from barloom.sources.layers import empty_partitions, read_version, scan_layer, write_layer, write_version
from barloom.sources.schema import CURATED_SCHEMA, RAW_SCHEMA, REFINED_SCHEMA
from barloom.spec import BarSpec

DAY = 86_400_000
DAILY = BarSpec(interval_ms=DAY)
START = 1_704_067_200_000
FIRST_DAYS = {"2024-01": 0, "2024-02": 31, "2024-03": 60}


def row(day, price=10.0, volume=1.0):
    return f"{START + day * DAY},{price},{price + 1},{price - 1},{price},{volume},{START + day * DAY + 1},1,1,1,1,0"


def land(folder, symbol, month, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{symbol}-1d-{month}.csv").write_text("".join(f"{x}\n" for x in lines))


@pytest.fixture
def paths(tmp_path):
    return LayerPaths(*[str(tmp_path / p) for p in ("landing", "raw", "refined", "curated", "quality")])


def account(spark, paths):
    rows = account_for_drops(spark, paths.raw, paths.refined, DAILY).collect()
    assert all(r["unexplained_rows"] == 0 for r in rows)
    for r in rows:
        assert r["dropped_rows"] == sum(x["rows"] for x in rows if x["symbol"] == r["symbol"])
    return {(r["symbol"], r["outcome"]): r["rows"] for r in rows if r["rows"]}, {r["symbol"]: (r["raw_rows"], r["refined_rows"]) for r in rows}


def test_account_of_an_ingest_and_of_the_file_put_right(spark, paths):
    folder = Path(paths.landing)
    for month, first in FIRST_DAYS.items():
        land(folder, "AAA", month, [row(first + d) for d in range(20)])
        land(folder, "BBB", month, [row(first + d) for d in range(20)])
    dirty = [*[row(31 + d) for d in range(20)], row(33, 11.0), row(33, 12.0), row(40, -1.0), "x", *[row(d) for d in range(5)]]
    land(folder, "AAA", "2024-02", dirty)
    ingest_bars(spark, paths.landing, paths.raw)
    build_refined(spark, paths.raw, paths.refined, DAILY)
    drops, sizes = account(spark, paths)
    assert drops == {("AAA", "copy"): 2, ("AAA", "open<=0"): 1, ("AAA", "null open_time"): 1, ("AAA", "stray"): 5}
    assert sizes == {"AAA": (69, 60), "BBB": (60, 60)}

    land(folder, "AAA", "2024-02", [*[row(31 + d) for d in range(20)], row(31, 0.5)])
    ingest_bars(spark, paths.landing, paths.raw)
    refresh_layers(spark, paths, spec=DAILY)
    drops, sizes = account(spark, paths)
    assert drops == {("AAA", "low<=0"): 1} and sizes == {"AAA": (61, 60), "BBB": (60, 60)}


@pytest.mark.parametrize("listed_bytes", [repeats.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("dedup_first", [False, True])
def test_cleaned_rows_are_those_of_clean_bars(spark, bars, monkeypatch, dedup_first, listed_bytes):
    monkeypatch.setattr(repeats, "BROADCAST_BYTES", listed_bytes)
    monkeypatch.setattr(layers, "LISTED_BYTES", listed_bytes)
    rows = [("a", k * DAY, 5.0 + k) for k in range(40)] + [("a", 3 * DAY, 4.0), ("a", 3 * DAY, -4.0), ("a", 7 * DAY, -1.0), ("b", 5, 1.0), ("b", DAY, 1.0), ("b", DAY, 1.0)]
    rows += [(None, DAY, 1.0), ("a", None, 1.0), ("", DAY, 2.0), ("c", DAY, None), ("c", 70_000 * DAY, 1.0)]
    raw = bars(*rows).withColumn("year_month", F.lit("2024-01"))
    done = clean_with_account(raw, DAILY, dedup_first=dedup_first)
    assertDataFrameEqual(done.bars, clean_bars(raw, DAILY, dedup_first=dedup_first))
    totals = {r["symbol"]: r["n"] for r in raw.groupBy("symbol").agg(F.count("*").alias("n")).collect()}
    assert {r["symbol"]: r["n"] for r in done.account.groupBy("symbol").agg(F.sum("rows").alias("n")).collect()} == totals
    kept = {r["symbol"]: r["n"] for r in done.bars.groupBy("symbol").agg(F.count("*").alias("n")).collect()}
    assert {r["symbol"]: r["rows"] for r in done.account.where("outcome = 'kept'").collect()} == kept
    same = changed_partitions(partition_digests(raw, DAILY), done.digest, DAILY)
    assert same.count() == 0


def test_account_of_an_empty_table(spark, bars):
    done = clean_with_account(bars(("a", 1, 1.0)).where(F.lit(False)), DAILY)
    assert done.bars.count() == done.account.count() == done.digest.count() == 0


def test_a_grid_that_does_not_start_at_zero_is_a_grid(spark, bars):
    shifted = [("a", 30_000 + k * 60_000, 1.0) for k in range(50)] + [("b", 7 + k * 60_000, 1.0) for k in range(50)]
    assert suspect_spans(bars(*shifted)).count() == 0
    assert [r["symbol"] for r in suspect_spans(bars(*shifted, ("a", 30_000, 2.0))).collect()] == ["a"]
    assert [r["symbol"] for r in suspect_spans(bars(*shifted, ("b", 60_000, 2.0))).collect()] == ["b"]


def test_digests_depend_on_rows_only(spark, paths):
    bars = spark.createDataFrame([("a", "m1", 1, 2.0), ("a", "m1", 2, 3.0), ("a", "m2", 1, None), (None, "m1", 1, 1.0)], "symbol string, year_month string, open_time long, close double")
    known = partition_digests(bars)
    other_order = bars.repartition(3).select("close", "year_month", "open_time", "symbol")
    assert changed_partitions(known, partition_digests(other_order)).count() == 0
    swapped = bars.withColumn("open_time", F.when(F.col("year_month") == "m1", 3 - F.col("open_time")).otherwise(F.col("open_time"))).where("symbol IS NOT NULL")
    twice = swapped.unionByName(swapped.where("year_month = 'm2'"))
    found = {(r["symbol"], r["year_month"]): r["change"] for r in changed_partitions(known, partition_digests(twice)).collect()}
    assert found == {("a", "m1"): "changed", ("a", "m2"): "changed", (None, "m1"): "vanished"}
    assert changed_partitions(known.where(F.lit(False)), known).where("change = 'added'").count() == 3


def test_layer_changes_read_only_what_was_rewritten(spark, tmp_path):
    path = str(tmp_path / "layer")
    schema = REFINED_SCHEMA
    rows = spark.range(60).select(
        F.when(F.col("id") < 30, "a").otherwise("b").alias("symbol"), F.concat(F.lit("2024-0"), F.col("id") % 3 + 1).alias("year_month"), F.col("id").alias("open_time"), F.lit(1.0).alias("close")
    )
    write_layer(rows, path, cluster=True)
    first, known = layer_changes(scan_layer(spark, path, schema), None)
    known.write.parquet(str(tmp_path / "known"))
    known = spark.read.parquet(str(tmp_path / "known"))
    assert first.where("change = 'added'").count() == 6
    write_layer(rows.where("symbol = 'a' AND year_month < '2024-03'").withColumn("close", F.when(F.col("year_month") == "2024-01", 2.0).otherwise(F.col("close"))), path)
    empty_partitions(spark, path, schema, spark.createDataFrame([("b", "2024-02")], "symbol string, year_month string"))
    write_layer(rows.limit(1).withColumns({"symbol": F.lit("c"), "year_month": F.lit("2024-09")}), path)
    changes, now = layer_changes(scan_layer(spark, path, schema), known)
    assert sorted(tuple(r) for r in changes.collect()) == [("a", "2024-01", "changed"), ("b", "2024-02", "vanished"), ("c", "2024-09", "added")]
    assert now.count() == 6
    again, _ = layer_changes(scan_layer(spark, path, schema), now)
    assert again.count() == 0
    # A partition whose digest of rows is wrong, but not that of its files, is not read.
    broken = known.withColumn("digest", F.lit(0).cast("decimal(38,0)"))
    changes, _ = layer_changes(scan_layer(spark, path, schema), broken)
    assert ("b", "2024-01") not in {(r["symbol"], r["year_month"]) for r in changes.collect()}


def test_refresh_without_a_list_equals_a_rebuild_and_rests_without_changes(spark, paths, monkeypatch):
    folder = Path(paths.landing)
    for month, first in FIRST_DAYS.items():
        for symbol in ("AAA", "BBB"):
            land(folder, symbol, month, [row(first + d, 5.0 + d) for d in range(25)])
    ingest_bars(spark, paths.landing, paths.raw)
    build_refined(spark, paths.raw, paths.refined, DAILY)
    build_curated(spark, paths.refined, paths.curated, DAILY)
    untouched = {p: p.stat().st_mtime_ns for p in Path(paths.curated).glob("symbol=BBB/*/*.parquet")}
    ingest_bars(spark, paths.landing, paths.raw)  # the same files once more
    with monkeypatch.context() as only:
        only.setattr(pipeline, "write_layer", lambda *a, **k: pytest.fail("nothing changed"))
        refresh_layers(spark, paths, spec=DAILY)
    land(folder, "AAA", "2024-02", [row(31 + d, 7.0) for d in range(3, 25)])
    land(folder, "CCC", "2024-03", [row(60, 7.0)])
    ingest_bars(spark, paths.landing, paths.raw)
    refresh_layers(spark, paths, spec=DAILY)
    assert {p: p.stat().st_mtime_ns for p in Path(paths.curated).glob("symbol=BBB/*/*.parquet")} == untouched
    refined, curated = scan_layer(spark, paths.refined, REFINED_SCHEMA), scan_layer(spark, paths.curated, CURATED_SCHEMA)
    whole = replace(paths, refined=paths.refined + "-w", curated=paths.curated + "-w")
    assertDataFrameEqual(refined.collect(), build_refined(spark, whole.raw, whole.refined, DAILY).collect())
    assertDataFrameEqual(curated.collect(), build_curated(spark, whole.refined, whole.curated, DAILY).collect(), rtol=1e-9)
    for name in ("account", "source"):
        a, b = (read_version(spark, f"{p.refined}-{name}") for p in (paths, whole))
        assertDataFrameEqual(a.collect(), b.collect())


def test_versions_of_a_small_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_version(spark, path) is None
    for k in range(3):
        before = read_version(spark, path)
        write_version(spark.range(k) if before is None else before.unionByName(spark.range(k, k + 1)), path)
    assert [r["id"] for r in read_version(spark, path).orderBy("id").collect()] == [1, 2]
    write_version(spark.range(0), path)
    assert read_version(spark, path).count() == 0
