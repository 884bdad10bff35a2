import zipfile

import pytest
from pyspark.sql import functions as F

from barloom.sources.files import archive_members, bars_from_members, interval_of, landing_files, month_of, scan_bars_csv, scan_bars_zip, symbol_of
from barloom.sources.layers import scan_layer, unify_symbols, write_layer
from barloom.sources.manifest import missing_sources, source_manifest
from barloom.sources.schema import BAR_SCHEMA, RAW_SCHEMA
from barloom.sources.stores import opens

GOOD = "1672531200000,1.5,2.0,1.0,1.75,10.0,1672531259999,17.5,3,5.0,8.75,0"


def months(spark, **config):
    return [tuple(r) for r in source_manifest(spark, config).collect()]


def test_month_range(spark):
    source = dict(symbol="X", interval="1h", start_year=2022, start_month=11, end_year=2023, end_month=2)
    assert months(spark, source=source) == [("X", "1h", y, m) for y, m in [(2022, 11), (2022, 12), (2023, 1), (2023, 2)]]


def test_month_range_defaults(spark):
    assert months(spark) == [("BTCUSDT", "1m", 2023, 1)]
    assert months(spark, source={"symbol": "ETHUSDT"}) == [("ETHUSDT", "1m", 2023, 1)]
    assert months(spark, source={"year": 2024, "month": "5"}) == [("BTCUSDT", "1m", 2024, 5)]
    assert months(spark, source={"start_year": 2024, "start_month": 3}) == [("BTCUSDT", "1m", 2024, 3)]
    assert months(spark, source={"start_year": 2024, "end_year": 2023}) == []
    assert months(spark, source={"start_year": 2024, "start_month": 5, "end_month": 4}) == []


def test_list_of_sources(spark):
    listed = [{"symbol": "A", "year": 2024, "month": 2}, "not a source", {"symbol": "B", "end_month": 2}]
    assert months(spark, sources=listed, source={"symbol": "Z"}) == [
        ("A", "1m", 2024, 2),
        ("B", "1m", 2023, 1),
        ("B", "1m", 2023, 2),
    ]
    assert months(spark, sources=["not a source"]) == []
    assert months(spark, sources=[], source={"symbol": "Z"}) == [("Z", "1m", 2023, 1)]


def test_missing_sources(spark):
    manifest = source_manifest(spark, {"source": {"symbol": "A", "end_month": 3}})
    present = spark.createDataFrame([("A", "2023-02"), ("B", "2023-01")], "symbol string, year_month string")
    assert sorted(r.month for r in missing_sources(manifest, present).collect()) == [1, 3]
    hourly = present.withColumn("interval", F.lit("1h"))
    assert sorted(r.month for r in missing_sources(manifest, hourly).collect()) == [1, 2, 3]


def test_file_names(spark):
    paths = ["file:/x-1m-2020-01.csv/AB-C-1m-2023-04.csv", "/a/ETHUSDT-15m-2024-12.zip", "/a/part-0001.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = df.select(symbol_of(F.col("p")), interval_of(F.col("p")), month_of(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("AB-C", "1m", "2023-04"), ("ETHUSDT", "15m", "2024-12"), (None, None, None)]


@pytest.fixture
def landing(tmp_path):
    lines = [GOOD, "open_time,open,high,low,close,volume", "1672531260000,abc,2.0,1.0,1.75", ""]
    (tmp_path / "A-1m-2023-01.csv").write_text("\n".join(lines))
    with zipfile.ZipFile(tmp_path / "A-1m-2023-01.zip", "w") as z:
        z.write(tmp_path / "A-1m-2023-01.csv", "A-1m-2023-01.csv")
        z.writestr("README.txt", "not bars")
    return str(tmp_path)


SCANS = {"*.csv": scan_bars_csv, "*.zip": scan_bars_zip}


@pytest.mark.parametrize("files", SCANS)
def test_scan(spark, landing, files):
    df = SCANS[files](spark, landing, corrupt_column="damaged", files=files)
    assert df.columns == [*BAR_SCHEMA.fieldNames(), "damaged", "source_file"]
    rows = df.orderBy(F.col("open_time").asc_nulls_last()).collect()
    assert len(rows) == 3
    assert (rows[0].open_time, rows[0].close, rows[0].num_trades, rows[0].damaged) == (1672531200000, 1.75, 3, None)
    assert rows[1].open_time == 1672531260000 and rows[1].open is None and rows[1].damaged.startswith("16725")
    assert rows[2].open_time is None and rows[2].damaged.startswith("open_time")
    assert {r[0] for r in df.select(symbol_of(F.col("source_file"))).collect()} == {"A"}


def test_any_file_name_can_be_scanned(spark, tmp_path):
    (tmp_path / "bars.txt").write_text(GOOD + "\n")
    assert scan_bars_csv(spark, str(tmp_path / "bars.txt")).first().close == 1.75


def test_both_scans_agree(spark, landing):
    a, b = [scan(spark, landing, files=files).drop("source_file") for files, scan in SCANS.items()]
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_a_whole_archive_is_read(spark, tmp_path):
    lines = [f"{t},1,1,1,1,1,{t},1,1,1,1,0" for t in range(50_000)]
    with zipfile.ZipFile(tmp_path / "B-1m-2023-01.zip", "w") as z:
        z.writestr("B-1m-2023-01.csv", "\r\n".join(lines))
    got = scan_bars_zip(spark, str(tmp_path)).agg(F.count("*"), F.sum("open_time")).first()
    assert tuple(got) == (50_000, sum(range(50_000)))


def test_landing_files(spark, landing):
    got = landing_files(spark, landing).select("symbol", "interval", "year_month").collect()
    assert [tuple(r) for r in got] == [("A", "1m", "2023-01")]


def raw_rows(spark, *rows):
    df = spark.createDataFrame(list(rows), "symbol string, year_month string, open_time long")
    missing = [f for f in RAW_SCHEMA if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


@pytest.mark.parametrize("cluster", [False, True])
def test_only_written_partitions_are_replaced(spark, tmp_path, cluster):
    path = str(tmp_path / "layer")
    write_layer(raw_rows(spark, ("1", "2023-01", 1), ("1", "2023-02", 2), ("B", "2023-01", 3)), path, cluster=cluster)
    for _ in range(2):
        write_layer(raw_rows(spark, ("1", "2023-01", 9)), path, cluster=cluster)
    got = scan_layer(spark, path, RAW_SCHEMA)
    assert got.schema["symbol"].dataType.simpleString() == "string"
    assert sorted((r.symbol, r.year_month, r.open_time) for r in got.collect()) == [
        ("1", "2023-01", 9),
        ("1", "2023-02", 2),
        ("B", "2023-01", 3),
    ]


def test_scan_prunes_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "layer")
    write_layer(raw_rows(spark, ("A", "2023-01", 1), ("B", "2023-01", 3)), path)
    df = scan_layer(spark, path, RAW_SCHEMA).where("symbol = 'A' AND open_time > 0").select("open_time")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<open_time:bigint>" in plan
    assert "PartitionFilters: [isnotnull(symbol" in plan and "GreaterThan(open_time,0)" in plan


def test_unify_by_name(spark):
    a = spark.createDataFrame([("A", 1)], "symbol string, open_time long")
    b = spark.createDataFrame([(2, "B")], "open_time long, symbol string")
    assert sorted(unify_symbols(a, b).collect()) == [("A", 1), ("B", 2)]


def test_members_of_an_archive_are_read_in_tasks_of_their_own_and_in_chunks(spark, tmp_path):
    line = "{t},1,1,1,1,1,{t},1,1,1,1,0"
    for a in range(2):
        with zipfile.ZipFile(tmp_path / f"A{a}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            for m in range(4):
                z.writestr(f"{m}/S{a}-1m-2023-0{m + 1}.csv", "\n".join(line.format(t=10_000 * m + t) for t in range(5_000)))
            z.writestr("empty-1m-2023-01.csv", "")
            z.writestr("notes.txt", "no bars")
    members = archive_members(landing_files(spark, str(tmp_path), "zip"))
    assert members.count() == 10 and {r["size"] > 0 for r in members.collect()} == {True, False}
    bars = bars_from_members(members, lines_per_batch=700)
    placed = bars.withColumn("task", F.spark_partition_id())
    found = placed.groupBy("source_file").agg(F.count("*").alias("n"), F.count_distinct("task").alias("tasks")).collect()
    assert len(found) == 8 and {(r["n"], r["tasks"]) for r in found} == {(5_000, 1)}
    assert placed.select("task").distinct().count() >= 4
    whole = scan_bars_zip(spark, str(tmp_path))
    assert whole.agg(F.count("*"), F.sum("open_time")).first() == bars.agg(F.count("*"), F.sum("open_time")).first()
    assert sorted(whole.columns) == sorted(scan_bars_csv(spark, str(tmp_path)).columns)


def test_folders_without_archives_and_stores_of_spark(spark, tmp_path):
    (tmp_path / "x").mkdir()
    assert scan_bars_zip(spark, str(tmp_path / "x")).count() == 0
    assert opens("/a/b.zip") and opens("file:/a/b.zip") and not opens("viewfs://store/a.zip")
    with zipfile.ZipFile(tmp_path / "x" / "A b#1.zip", "w") as z:
        z.writestr("A-1m-2023-01.csv", GOOD)
    assert scan_bars_zip(spark, str(tmp_path / "x")).first().close == 1.75
