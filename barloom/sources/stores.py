"""Files in a store, opened by their path in a task.

A path without a scheme is a local or mounted folder; others go to the store of their scheme as pyarrow knows it. Stores that
only Spark knows are read by Spark itself.
"""

from __future__ import annotations

import re
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs

#: Schemes whose files a task opens by itself.
OPENED = ("", "file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")


def _parts(path: str) -> tuple[str, str, str]:
    """Scheme, authority and name of a path as Spark writes it: nothing in the name is escaped."""
    found = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]*):(?://([^/]*))?(/.*)$", path, re.S)
    return (found[1], found[2] or "", found[3]) if found else ("", "", path)


def opens(path: str) -> bool:
    """Whether a task can open files at such a path."""
    return _parts(path)[0] in OPENED


def _located(path: str) -> tuple[fs.FileSystem, str]:
    scheme, authority, name = _parts(path)
    if scheme in ("", "file"):
        return fs.LocalFileSystem(), name
    return fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{authority}{quote(name)}")


def open_file(path: str) -> pa.NativeFile:
    """A file for reading at any place."""
    store, name = _located(path)
    return store.open_input_file(name)


def write_file(path: str, content: bytes) -> None:
    store, name = _located(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    with store.open_output_stream(name) as out:
        out.write(content)
