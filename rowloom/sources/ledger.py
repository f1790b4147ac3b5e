"""Parquet tables that grow by commits: readers see whole commits or nothing of them.

A ledger is a folder with ``data`` (one folder per write) and ``listings`` (one JSON file per
version).  A write first puts its files into a folder of its own and then adds a listing that
names every folder now in the table; a reader opens the newest listing and reads those folders
only.  A write that dies half-way leaves a folder that no listing names.

- A listing is written beside its place and renamed without overwriting, so of two writers
  of one version one fails and tries again on top of the other.  This needs a file system whose
  rename is atomic (HDFS and the like, not plain object stores).
- A writer may give a stream's name and a batch number: a batch that was committed already is
  not written again, so replays change nothing.
- :func:`compact` replaces many small parts by few ordered ones in one commit.  Readers of the old
  listing keep their files until :func:`vacuum`.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, types as T

from rowloom.errors import DataError
from rowloom.operators.ordering import ascending
from rowloom.functions.coerce import col

#: Rows of a part that compaction leaves alone, and of a file it writes.
FULL_ROWS = 1_000_000
#: Commits of a writer that meets another one each time.
MAX_TRIES = 20


@dataclass
class Listing:
    """One version: parts as ``{"path", "rows"}``, the schema as JSON, last batch per stream."""

    version: int = 0
    schema: str | None = None
    parts: list[dict[str, Any]] = field(default_factory=list)
    streams: dict[str, int] = field(default_factory=dict)


class _Folder:
    """The few file operations a ledger needs, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm = spark._jvm
        self.gateway = spark.sparkContext._gateway
        self.path = path.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.files = self.at("").getFileSystem(self.conf)

    def at(self, name: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        folder = self.at(name)
        return [s.getPath().getName() for s in self.files.listStatus(folder)] if self.files.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self.files.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Write a file in one step; False if there is one of that name."""
        draft = self.at(f"listings/.{uuid.uuid4().hex}")
        stream = self.files.create(draft, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), self.conf)
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, self.at(name), options)
        except Py4JJavaError as error:
            self.files.delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.files.delete(self.at(name), True)


def _versions(folder: _Folder) -> list[int]:
    return sorted(int(n[:-5]) for n in folder.names("listings") if n.endswith(".json") and n[:-5].isdigit())


def _latest(folder: _Folder) -> Listing:
    versions = _versions(folder)
    return Listing(**json.loads(folder.read(_name(versions[-1])))) if versions else Listing()


def _name(version: int) -> str:
    return f"listings/{version:012d}.json"


def listing(spark: SparkSession, path: str) -> Listing:
    """The newest version; version 0 without parts where nothing was committed."""
    return _latest(_Folder(spark, path))


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of all committed parts.  A ledger without a commit needs a ``schema`` and is empty."""
    return _scan(spark, path, listing(spark, path), schema)


def _scan(spark: SparkSession, path: str, seen: Listing, schema: T.StructType | None = None) -> DataFrame:
    if seen.schema is not None:
        schema = T.StructType.fromJson(json.loads(seen.schema))
    if schema is None:
        raise DataError(f"nothing was committed to {path}", "ledger_empty")
    if not seen.parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{p['path']}" for p in seen.parts])


def _nullable(schema: T.StructType) -> T.StructType:
    """As Parquet gives it back: every column may be NULL."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def _write_part(df: DataFrame, folder: _Folder, max_rows: int | None = None) -> dict[str, Any]:
    name = f"data/{uuid.uuid4().hex}"
    writer = df.write.option("maxRecordsPerFile", max_rows) if max_rows else df.write
    writer.parquet(f"{folder.path}/{name}")
    # Row counts come from the files' footers; no column is read.
    written = df.sparkSession.read.schema(df.schema).parquet(f"{folder.path}/{name}")
    return {"path": name, "rows": written.count()}


def append(df: DataFrame, path: str, stream: str | None = None, batch: int | None = None) -> int:
    """Commit the rows of ``df`` and return how many they are.

    With ``stream`` and ``batch`` (numbers that grow) a batch that is there already is left
    as it is: nothing is written and 0 is returned.
    """
    if (stream is None) != (batch is None):
        raise DataError("give a stream and its batch number together", "ledger_bad_batch")
    folder = _Folder(df.sparkSession, path)
    schema = _nullable(df.schema)
    part = None
    for _ in range(MAX_TRIES):
        seen = _latest(folder)
        if stream is not None and batch <= seen.streams.get(stream, -1):
            if part:
                folder.delete(part["path"])
            return 0
        if seen.schema is not None and T.StructType.fromJson(json.loads(seen.schema)) != schema:
            raise DataError(
                f"columns {schema.simpleString()} do not fit the ledger", "ledger_schema_changed", {"path": path}
            )
        part = part or _write_part(df, folder)
        streams = seen.streams | ({stream: batch} if stream is not None else {})
        parts = seen.parts + ([part] if part["rows"] else [])
        if _commit(folder, Listing(seen.version + 1, schema.json(), parts, streams)):
            return part["rows"]
    raise DataError(f"{MAX_TRIES} commits to {path} met other writers", "ledger_busy")


def _commit(folder: _Folder, new: Listing) -> bool:
    return folder.publish(_name(new.version), json.dumps(vars(new)))


def compact(spark: SparkSession, path: str, order: Sequence[str], full_rows: int = FULL_ROWS) -> int:
    """Replace all parts of fewer than ``full_rows`` rows by one of ordered files; gives how many went.

    The new part is divided by ranges of ``order`` and sorted in each, with at most
    ``full_rows`` rows a file.  Larger parts stay, so repeated calls rewrite no row often.
    Commits of others in between are kept.
    """
    folder = _Folder(spark, path)
    seen = _latest(folder)
    small = [p for p in seen.parts if p["rows"] < full_rows]
    if len(small) < 2:
        return 0
    rows = _scan(spark, path, Listing(schema=seen.schema, parts=small))
    keys = ascending([col(c) for c in order])
    files = math.ceil(sum(p["rows"] for p in small) / full_rows)
    merged = _write_part(rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys), folder, full_rows)
    gone = {p["path"] for p in small}
    for _ in range(MAX_TRIES):
        now = _latest(folder)
        if not gone <= {p["path"] for p in now.parts}:  # another one compacted the same parts
            folder.delete(merged["path"])
            return 0
        parts = [merged, *[p for p in now.parts if p["path"] not in gone]]
        if _commit(folder, Listing(now.version + 1, now.schema, parts, now.streams)):
            return len(small)
    raise DataError(f"{MAX_TRIES} commits to {path} met other writers", "ledger_busy")


def vacuum(spark: SparkSession, path: str, older_than: float = 86_400.0) -> int:
    """Delete old listings, and folders of data that the newest one does not name; gives how many folders went.

    Only what is older than ``older_than`` seconds goes: writers may be about to commit a
    newer folder, and readers of an older listing still read theirs.
    """
    folder = _Folder(spark, path)
    newest = _latest(folder)
    live = {p["path"] for p in newest.parts}
    before = (time.time() - older_than) * 1000
    old = lambda name: folder.files.getFileStatus(folder.at(name)).getModificationTime() <= before
    for version in _versions(folder):
        if version < newest.version and old(_name(version)):
            folder.delete(_name(version))
    unnamed = [f"data/{n}" for n in folder.names("data") if f"data/{n}" not in live]
    dead = [name for name in unnamed if old(name)]
    for name in dead:
        folder.delete(name)
    return len(dead)
