"""Scans of source files, plain or zipped."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from barloom.scratch import settle
from barloom.sources.schema import BAR_SCHEMA
from barloom.sources.stores import open_file, opens

# Fixed format of source file names: SYMBOL-interval-YYYY-MM, then the extension.
_MONTH = r"\d{4}-\d{2}"
_INTERVAL = r"\d+[A-Za-z]+"
_END = r"\.(csv|zip)$"

_LINES_PER_BATCH = 20_000

#: Tasks that read members of archives at most; beyond, a task reads several members, one after the other.
MOST_TASKS = 100_000


def _part_of_name(path: Column, pattern: str) -> Column:
    return F.regexp_substr(F.substring_index(path, "/", -1), F.lit(pattern))


def symbol_of(path: Column) -> Column:
    """Symbol from a source file's path; null where the name has another form."""
    return _part_of_name(path, rf"^.+(?=-{_INTERVAL}-{_MONTH}{_END})")


def interval_of(path: Column) -> Column:
    return _part_of_name(path, rf"{_INTERVAL}(?=-{_MONTH}{_END})")


def month_of(path: Column) -> Column:
    return _part_of_name(path, rf"{_MONTH}(?={_END})")


def _with_corrupt(corrupt_column: str | None) -> StructType:
    schema = StructType(list(BAR_SCHEMA.fields))
    return schema.add(corrupt_column, StringType(), True) if corrupt_column else schema


def _csv_options(corrupt_column: str | None) -> dict[str, str]:
    options = {"header": "false", "mode": "PERMISSIVE"}
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
    return options


def _lookup(files: str | None, recursive: bool) -> dict[str, str]:
    options = {"recursiveFileLookup": str(recursive).lower()}
    if files:
        options["pathGlobFilter"] = files
    return options


def scan_bars_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    corrupt_column: str | None = None,
    files: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Typed scan of header-less CSV: one scan over all paths, fields that do not parse become null.

    ``corrupt_column`` keeps the text of lines that did not parse. ``files`` is a pattern for file
    names, for folders that hold others too. ``source_file`` is the path.
    """
    return (
        spark.read.schema(_with_corrupt(corrupt_column))
        .options(**_csv_options(corrupt_column), **_lookup(files, recursive))
        .csv(paths)
        .select("*", F.col("_metadata.file_path").alias("source_file"))
    )


def scan_bars_zip(
    spark: SparkSession,
    paths: str | Sequence[str],
    corrupt_column: str | None = None,
    files: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """The same scan over zip archives of such files, of any size: each member is a task's own, which opens the archive by its
    path and streams it. The members are listed in tasks too; that is a job, and so are the listed members a table in scratch.

    In a store that only Spark can open an archive is one value, of 2 GB at most, whose members one task reads.
    """
    found = spark.read.format("binaryFile").options(**_lookup(files, recursive)).load(paths)
    one = found.select("path").first()
    if one is not None and opens(one["path"]):
        return bars_from_members(archive_members(found.select("path")), corrupt_column)
    return bars_from_archives(found.select("content"), corrupt_column)


def archive_members(archives: DataFrame, suffix: str = ".csv") -> DataFrame:
    """``path``, ``member`` and ``size`` of the files in the zip archives that ``path`` names, from their directories alone."""

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_file(path) as file, zipfile.ZipFile(file) as archive:
                    found = [x for x in archive.infolist() if x.filename.endswith(suffix)]
                names, sizes = [x.filename for x in found], [x.file_size for x in found]
                yield pa.RecordBatch.from_pydict({"path": [path] * len(found), "member": names, "size": pa.array(sizes, pa.int64())})

    schema = "path string, member string, size long"
    return settle(archives.select("path").mapInArrow(listed, schema))


def bars_from_members(members: DataFrame, corrupt_column: str | None = None, lines_per_batch: int = _LINES_PER_BATCH) -> DataFrame:
    """Bars of the archives' ``member`` at ``path``, one member to a task as far as the cluster has tasks for them."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name in zip(batch.column("path").to_pylist(), batch.column("member").to_pylist(), strict=True):
                with open_file(path) as file, zipfile.ZipFile(file) as archive, archive.open(name) as raw:
                    yield from _lines_of(raw, name, lines_per_batch)

    dealt = members.select("path", "member").repartition(min(max(members.count(), 1), MOST_TASKS))
    return _parsed(dealt.mapInArrow(read, "source_file string, line string"), corrupt_column)


def _lines_of(raw: IO[bytes], name: str, lines_per_batch: int) -> Iterator[pa.RecordBatch]:
    """The lines of an open member, a batch at a time."""
    with io.TextIOWrapper(raw, "utf-8", errors="replace") as text:
        lines = (line.rstrip("\r\n") for line in text)
        while chunk := list(islice(lines, lines_per_batch)):
            yield pa.RecordBatch.from_pydict({"source_file": [name] * len(chunk), "line": chunk})


def _line_reader(lines_per_batch: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function from archives to their lines. It is made here, and so sent to the workers by
    value: they need not have this package."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    for name in archive.namelist():
                        if not name.endswith(".csv"):
                            continue
                        with archive.open(name) as raw, io.TextIOWrapper(raw, "utf-8", errors="replace") as text:
                            lines = (line.rstrip("\r\n") for line in text)
                            while chunk := list(islice(lines, lines_per_batch)):
                                yield pa.RecordBatch.from_pydict({"source_file": [name] * len(chunk), "line": chunk})

    return read


def bars_from_archives(archives: DataFrame, corrupt_column: str | None = None) -> DataFrame:
    """Bars from a table with one zip archive per row in ``content``.

    Python only unpacks, a batch of lines at a time; the fields are parsed on the JVM.
    """
    return _parsed(archives.select("content").mapInArrow(_line_reader(_LINES_PER_BATCH), "source_file string, line string"), corrupt_column)


def _parsed(lines: DataFrame, corrupt_column: str | None) -> DataFrame:
    schema = _with_corrupt(corrupt_column)
    parsed = F.from_csv("line", schema.simpleString()[len("struct<") : -1].replace(":", " "), _csv_options(corrupt_column))
    return lines.where(F.trim("line") != "").select(parsed.alias("bar"), "source_file").select("bar.*", "source_file")


def landing_files(spark: SparkSession, root: str | Sequence[str], kind: str = "csv") -> DataFrame:
    """The source files under ``root``: path, symbol, interval, year_month, and their ``length`` and ``modified`` time. Lists, reads nothing."""
    path = F.col("path")
    return (
        spark.read.format("binaryFile")
        .options(**_lookup(f"*.{kind}", True))
        .load(root)
        .select(
            path,
            symbol_of(path).alias("symbol"),
            interval_of(path).alias("interval"),
            month_of(path).alias("year_month"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
    )
