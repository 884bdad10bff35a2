"""Layer builds: landing files -> raw -> refined -> curated, and the quality report.

Every build writes its layer and returns a scan of what was written, so later steps see the
written rows and no lineage is carried along.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from barloom.operators.accounting import clean_with_account, drop_accounting, with_strays
from barloom.operators.clean import detect_time_gaps, filter_invalid_bars
from barloom.operators.metrics import curated_bars
from barloom.operators.normalize import raw_bars
from barloom.operators.quality import (
    completeness_section,
    continuity_section,
    quality_profile,
    reconcile_counts,
    report_document,
    skipped_fields,
)
from barloom.operators.series import MAX_ROWS, Slices, plan_slices
from barloom.scratch import settle
from barloom.sources.digests import file_digests, layer_changes, partition_digests, with_files
from barloom.sources.files import landing_files, month_of, scan_bars_csv, scan_bars_zip, symbol_of
from barloom.sources.layers import at_partitions, empty_partitions, read_version, scan_layer, write_layer, write_version
from barloom.sources.manifest import missing_sources
from barloom.sources.schema import CURATED_SCHEMA, RAW_SCHEMA, REFINED_SCHEMA
from barloom.sources.stores import opens, write_file
from barloom.spec import BarSpec

# Up to this many symbols a refresh names them in the scan's partition filter.
MAX_LISTED_SYMBOLS = 1_000


class QualityCheckFailed(RuntimeError):
    """The report's status is ``fail``."""


@dataclass(frozen=True)
class LayerPaths:
    landing: str
    raw: str
    refined: str
    curated: str
    quality: str


def build_raw(
    spark: SparkSession, paths: str | Sequence[str], raw_path: str, symbol: str | Column | None = None
) -> DataFrame:
    """CSV files to the raw layer. Without a ``symbol`` it is taken from the file names. No shuffle."""
    bars = scan_bars_csv(spark, paths)
    write_layer(raw_bars(bars, symbol_of(F.col("source_file")) if symbol is None else symbol), raw_path)
    return scan_layer(spark, raw_path, RAW_SCHEMA)


def ingest_bars(
    spark: SparkSession,
    landing: str | Sequence[str],
    raw_path: str,
    manifest: DataFrame | None = None,
    kind: str = "csv",
) -> DataFrame | None:
    """Bring all source files into the raw layer with one scan and one write.

    With a manifest only its sources are read, and those without a file are skipped and returned.
    Symbols are in upper case, as in the manifest. A symbol and month may have files of one interval only.

    A file owns the month in its name. Rows of another month go to the table ``{raw_path}-strays`` (see ``scan_strays``) and
    leave that month as it is; rows without a time stay with their file's month, and the validity filter counts them.
    A file that is read again replaces its strays too.
    """
    scan = scan_bars_zip if kind == "zip" else scan_bars_csv
    files = landing_files(spark, landing, kind).withColumn("symbol", F.upper("symbol"))
    if manifest is None:
        _one_interval(files)
        _write_raw(scan(spark, landing, files=f"*.{kind}", recursive=True), raw_path, files)
        return None
    named = manifest.withColumn("symbol", F.upper("symbol"))
    month = F.format_string("%04d-%02d", "year", "month")
    sources = named.select("symbol", "interval", month.alias("year_month"))
    found = files.join(sources, ["symbol", "interval", "year_month"], "left_semi")
    _one_interval(found)
    # A scan gets its paths from the driver in any case: one short string per file.
    paths = [row["path"] for row in found.select("path").collect()]
    if paths:
        _write_raw(scan(spark, paths), raw_path, found)
    return missing_sources(named, found)


def ingest_new_bars(spark: SparkSession, landing: str | Sequence[str], raw_path: str, kind: str = "csv") -> list[str]:
    """Bring the source files that are new or have changed since the last such ingest into the raw layer; returns their paths.

    Files are known by path, size and time, kept beside the layer (``{raw_path}-files``). What is new touches months of symbols, and those are written
    from all their files. The list is written last, so an ingest that fails is repeated by the next one, and a month
    written twice has its rows once. A month whose files have gone stays as it is.
    """
    files = settle(landing_files(spark, landing, kind).withColumn("symbol", F.upper("symbol")))
    known = read_version(spark, f"{raw_path.rstrip('/')}-files")
    at = ["path", "length", "modified"]
    new = files if known is None else files.join(known.select(*at), at, "left_anti")
    # One short string per file, as for any scan.
    paths = sorted(row["path"] for row in new.select("path").collect())
    if not paths:
        return []
    found = at_partitions(files, settle(new.select("symbol", "year_month").distinct()), ["symbol", "year_month"])
    _one_interval(found)
    scan = scan_bars_zip if kind == "zip" else scan_bars_csv
    _write_raw(scan(spark, [row["path"] for row in found.select("path").collect()]), raw_path, found)
    write_version(files, f"{raw_path.rstrip('/')}-files")
    return paths


def _one_interval(files: DataFrame) -> None:
    """The layers have no interval column: bars of two intervals would mix."""
    several = files.where("symbol IS NOT NULL").groupBy("symbol", "year_month").agg(F.count_distinct("interval").alias("n"))
    mixed = several.where("n > 1").first()
    if mixed is not None:
        raise ValueError(f"{mixed['symbol']} {mixed['year_month']} has files of several intervals")


_STRAYS_SCHEMA = StructType([f for f in RAW_SCHEMA.fields if f.name != "symbol"] + [StructField("symbol", StringType()), StructField("file_month", StringType())])
_STRAYS_SPEC = replace(BarSpec(), month="file_month")


def scan_strays(spark: SparkSession, raw_path: str) -> DataFrame | None:
    """The rows that ingests set apart: those of other months than their files'. None if there never were any."""
    try:
        return spark.read.schema(_STRAYS_SCHEMA).parquet(f"{raw_path.rstrip('/')}-strays")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _write_raw(bars: DataFrame, raw_path: str, files: DataFrame) -> None:
    """Write the rows of each file's own month; the strays too, in a second scan, only if there are any."""
    spark = bars.sparkSession
    named = bars.withColumn("file_month", month_of(F.col("source_file")))
    rows = raw_bars(named, F.upper(symbol_of(F.col("source_file"))), keep=["file_month"])
    own_month, file_month = F.col("year_month"), F.col("file_month")
    stray = F.coalesce(own_month != file_month, F.lit(False))
    seen = Observation()
    kept = rows.withColumn("stray", stray).observe(seen, F.count_if("stray").alias("strays")).where("NOT stray")
    write_layer(kept.withColumn("year_month", F.coalesce(own_month, file_month)).drop("stray", "file_month"), raw_path)
    path, at = f"{raw_path.rstrip('/')}-strays", ["symbol", "file_month"]
    apart = settle(rows.where(stray)) if seen.get["strays"] else None
    before = scan_strays(spark, raw_path)
    if before is not None:
        # Strays of files that are read again and have none any more.
        again = files.select("symbol", F.col("year_month").alias("file_month")).distinct()
        cleared = again if apart is None else again.join(apart.select(*at).distinct(), at, "left_anti")
        empty_partitions(spark, path, _STRAYS_SCHEMA, cleared, _STRAYS_SPEC)
    if apart is not None:
        write_layer(apart, path, _STRAYS_SPEC)


def build_refined(
    spark: SparkSession,
    raw_path: str,
    refined_path: str,
    spec: BarSpec = BarSpec(),
    reject_nan: bool = True,
    dedup_first: bool = False,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Raw to refined: one shuffle of the wide rows, for the gaps; another of those near repeats.

    It leaves every (symbol, month) together, so the write needs none. The layer is replaced: a
    partition that has no valid rows any more goes. Beside the layer stay the account of what became of the raw rows
    (``{refined_path}-account``) and the digests of the partitions it was built from (``{refined_path}-source``).
    """
    raw = scan_layer(spark, raw_path, RAW_SCHEMA)
    files = settle(file_digests(raw, spec))
    cleaned = clean_with_account(raw, spec, reject_nan, dedup_first)
    slices = plan_slices(raw, spec, max_rows, column=spec.month)
    # Copies do not change which times there are, so a slice's last time can be had without
    # de-duplicating first, unless broken copies may win.
    times = None if dedup_first else _valid_times(raw, spec, reject_nan)
    write_layer(detect_time_gaps(cleaned.bars, spec, slices, times=times), refined_path, spec, whole=True)
    write_version(cleaned.account, account_path(refined_path))
    write_version(with_files(cleaned.digest, files, spec), source_path(refined_path))
    return scan_layer(spark, refined_path, REFINED_SCHEMA)


def account_path(refined_path: str) -> str:
    return f"{refined_path.rstrip('/')}-account"


def source_path(refined_path: str) -> str:
    return f"{refined_path.rstrip('/')}-source"


def account_for_drops(spark: SparkSession, raw_path: str, refined_path: str, spec: BarSpec = BarSpec()) -> DataFrame | None:
    """The rows dropped between ingest and the refined layer by what became of them, strays included: see ``drop_accounting``.
    None if the layer has no account."""
    account = read_version(spark, account_path(refined_path))
    if account is None:
        return None
    strays = scan_strays(spark, raw_path)
    layers = scan_layer(spark, raw_path, RAW_SCHEMA), scan_layer(spark, refined_path, REFINED_SCHEMA)
    return drop_accounting(with_strays(account, strays, spec), *layers, spec, strays)


def _valid_times(raw: DataFrame, spec: BarSpec, reject_nan: bool) -> DataFrame:
    return filter_invalid_bars(raw, spec, reject_nan).select(spec.key, spec.time, spec.month)


def build_curated(
    spark: SparkSession,
    refined_path: str,
    curated_path: str,
    spec: BarSpec = BarSpec(),
    max_rows: int = MAX_ROWS,
    exact_scale: int | None = None,
) -> DataFrame:
    """Refined to curated: one shuffle of the wide rows. The layer is replaced."""
    refined = scan_layer(spark, refined_path, REFINED_SCHEMA)
    slices = plan_slices(refined, spec, max_rows, column=spec.month)
    bars = curated_bars(refined, spec, slices=slices, exact_scale=exact_scale)
    write_layer(bars, curated_path, spec, whole=True)
    return scan_layer(spark, curated_path, CURATED_SCHEMA)


def write_quality_report(report: DataFrame, quality_path: str) -> None:
    """The one-row report as indented JSON, in the dataset ``quality_report.json``, and as the single file ``report.json`` in a store
    that can be written to by path."""
    options = {"pretty": "true", "ignoreNullFields": "false"}
    text = settle(report.select(F.to_json(F.struct(*report.columns), options).alias("value")))
    text.coalesce(1).write.mode("overwrite").text(f"{quality_path}/quality_report.json")
    if opens(quality_path):
        write_file(f"{quality_path}/report.json", f"{text.first()['value']}\n".encode())


def build_quality(
    spark: SparkSession,
    curated: DataFrame,
    quality_path: str,
    raw: DataFrame | None = None,
    refined: DataFrame | None = None,
    spec: BarSpec = BarSpec(),
    require_rows: bool = False,
    csv: bool = False,
    drops: DataFrame | None = None,
) -> DataFrame:
    """Write the profile, the per-key sections (JSON lines or CSV) and the report; return the report.

    The layers are read once, for the profile; everything else comes from the written profile,
    one row per key. ``drops`` (see ``account_for_drops``) is one more section.
    """
    profile_path = f"{quality_path}/profile"
    quality_profile(curated, spec).write.mode("overwrite").parquet(profile_path)
    profile = spark.read.parquet(profile_path)
    compared = None
    if raw is not None and refined is not None:
        compared_path = f"{quality_path}/reconciliation_counts"
        reconcile_counts(raw, refined, spec).write.mode("overwrite").parquet(compared_path)
        compared = spark.read.parquet(compared_path)
    sections = {
        "completeness": completeness_section(profile, spec),
        "continuity": continuity_section(profile, spec),
        "reconciliation": compared,
        "drops": drops,
    }
    for name, section in sections.items():
        if section is not None:
            writer = section.write.mode("overwrite")
            writer.csv(f"{quality_path}/{name}", header=True) if csv else writer.json(f"{quality_path}/{name}")
    report = report_document(profile, compared, spec, require_rows, skipped_fields(curated, spec))
    write_quality_report(report, quality_path)
    return report


def enforce_quality_gate(report: DataFrame) -> str:
    """The report's status; raises on ``fail``, lets ``warning`` pass."""
    status = report.select("status").first()["status"]
    if status == "fail":
        raise QualityCheckFailed("quality status is fail")
    return status


def run_lakehouse(
    spark: SparkSession,
    paths: LayerPaths,
    manifest: DataFrame | None = None,
    spec: BarSpec = BarSpec(),
    kind: str = "csv",
) -> str:
    """Ingest, refine, curate, check. The report is written before the gate may raise."""
    ingest_bars(spark, paths.landing, paths.raw, manifest, kind)
    refined = build_refined(spark, paths.raw, paths.refined, spec)
    curated = build_curated(spark, paths.refined, paths.curated, spec)
    raw = scan_layer(spark, paths.raw, RAW_SCHEMA)
    drops = account_for_drops(spark, paths.raw, paths.refined, spec)
    return enforce_quality_gate(build_quality(spark, curated, paths.quality, raw, refined, spec, drops=drops))


def refresh_layers(
    spark: SparkSession,
    paths: LayerPaths,
    changed: DataFrame | None = None,
    spec: BarSpec = BarSpec(),
    reject_nan: bool = True,
    max_rows: int = MAX_ROWS,
    exact_scale: int | None = None,
) -> None:
    """Rewrite only what changed raw partitions touch; ``changed`` lists (symbol, year_month).

    Without a list the raw layer's digests are compared with those that the refined layer was built from; nothing is
    rewritten where they agree. The account and the digests beside the refined layer are brought up to date at the end, so
    a run that fails is made up for by the next.

    Refined: these months and the next one a symbol has, whose first gap looks back. Curated:
    from the first changed month of a symbol on, since its VWAP runs through. Earlier months are
    read for the halo and the carry only, in a few columns. A touched month that has no valid rows
    any more is emptied in both layers.
    """
    key, month = spec.key, spec.month
    layer, known = scan_layer(spark, paths.raw, RAW_SCHEMA), read_version(spark, source_path(paths.refined))
    if changed is None:
        changed, digests = layer_changes(layer, known, spec)
        digests = settle(digests)
    else:
        digests = None
    changed = settle(changed.select(key, month).distinct())
    if not changed.limit(1).count():
        return
    if digests is None and known is not None:
        fresh = with_files(partition_digests(at_partitions(layer, changed, [key, month]), spec), file_digests(layer, spec), spec)
        digests = settle(at_partitions(known, changed, [key, month], inside=False).unionByName(fresh))
    first = changed.agg(F.min(month)).first()[0]
    raw = _of_symbols(scan_layer(spark, paths.raw, RAW_SCHEMA), changed, spec)
    times = _valid_times(raw, spec, reject_nan)
    hits = changed.withColumn("hit", F.lit(True))
    later = times.where(F.col(month) >= first).select(key, month).distinct()
    along = Window.partitionBy(key).orderBy(month)
    touched = (
        later.unionByName(hits, allowMissingColumns=True)
        .groupBy(key, month)
        .agg(F.max("hit").alias("hit"))
        .withColumn("after", F.lag("hit").over(along))
        .where(F.coalesce("hit", "after"))
        .select(key, month)
    )
    touched = settle(touched)
    gone = settle(touched.join(later, [key, month], "left_anti"))
    own = raw.where(F.col(month) >= first).join(touched, [key, month], "left_semi")
    slices = _by_month(plan_slices(raw, spec, max_rows, column=month), spec)
    cleaned = clean_with_account(own, spec, reject_nan)
    write_layer(detect_time_gaps(cleaned.bars, spec, slices, times=times), paths.refined, spec)
    account = read_version(spark, account_path(paths.refined))
    if account is not None:
        # Partitions that are gone from the raw layer have no rows to account for.
        both = settle(touched.unionByName(changed).distinct())
        account = settle(at_partitions(account, both, [key, month], inside=False).unionByName(cleaned.account))
    empty_partitions(spark, paths.refined, REFINED_SCHEMA, gone, spec)

    refined = _of_symbols(scan_layer(spark, paths.refined, REFINED_SCHEMA), changed, spec)
    since = changed.groupBy(key).agg(F.min(month).alias("since"))
    following = refined.select(key, month).distinct().join(since, key).where(F.col(month) >= F.col("since"))
    months = settle(following.select(key, month))
    slices = _by_month(plan_slices(refined, spec, max_rows, column=month), spec)
    bars = curated_bars(refined, spec, slices=slices, months=months, exact_scale=exact_scale)
    write_layer(bars, paths.curated, spec)
    empty_partitions(spark, paths.curated, CURATED_SCHEMA, gone, spec)
    if account is not None:
        write_version(account, account_path(paths.refined))
    if digests is not None:
        write_version(digests, source_path(paths.refined))


def _of_symbols(layer: DataFrame, changed: DataFrame, spec: BarSpec) -> DataFrame:
    """The changed symbols' partitions. A short list is a literal, by which the scan is pruned."""
    symbols = changed.select(spec.key).distinct()
    if symbols.count() > MAX_LISTED_SYMBOLS:
        return layer.join(symbols, spec.key, "left_semi").select(*layer.columns)
    return layer.where(F.col(spec.key).isin([row[0] for row in symbols.collect()]))


def _by_month(slices: Slices, spec: BarSpec) -> Slices:
    """Months as slices also where the series are short: their past is then not read in full."""
    return Slices(column=spec.month, max_rows=slices.max_rows) if slices.whole else slices
