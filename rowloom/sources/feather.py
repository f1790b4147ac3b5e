"""Feather (Arrow IPC) scan: Spark has no built-in source for it.

Files are listed by Spark's ``binaryFile`` source without reading their content.  A
first small stage opens each file's footer and cuts it into runs of record batches; a
second reads only its run, so one large file is spread over many tasks and no file is
held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from rowloom.errors import DataError

_BATCHES_PER_TASK = 16


def _open(path: str):
    """The file through Arrow's file systems, addressed as the cluster addresses it."""
    from pyarrow import fs

    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[len("file:") :]
    system, inside = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(inside)


def _is_ipc(source) -> bool:
    source.seek(0)
    magic = source.read(6)
    source.seek(0)
    return magic == b"ARROW1"


def _first_version(source) -> pa.Table:
    from pyarrow import feather

    return feather.read_table(source)


def scan_feather(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Scan one file or a folder of files with one schema."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    if schema is None:
        schema = _schema(spark, path, files)
    elif isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    target = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("path").to_pylist():
                with _open(name) as source:
                    n = pa.ipc.open_file(source).num_record_batches if _is_ipc(source) else 1
                starts = list(range(0, n, _BATCHES_PER_TASK))
                yield pa.RecordBatch.from_pydict({"path": [name] * len(starts), "start": pa.array(starts, pa.int32())})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with _open(name) as source:
                    if not _is_ipc(source):
                        yield from _first_version(source).select(target.names).cast(target, safe=False).to_batches()
                        continue
                    reader = pa.ipc.open_file(source)
                    for i in range(start, min(start + _BATCHES_PER_TASK, reader.num_record_batches)):
                        part = reader.get_batch(i).select(target.names)
                        yield from pa.Table.from_batches([part]).cast(target, safe=False).to_batches()

    runs = files.mapInArrow(cut, "path string, start int").repartition(F.col("path"), F.col("start"))
    return runs.mapInArrow(read, schema)


def _schema(spark: SparkSession, path: str, files: DataFrame) -> T.StructType:
    """Schema of the first file, read from its footer in a task."""
    first = files.orderBy("path").limit(1)

    def footer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("path").to_pylist():
                with _open(name) as source:
                    found = pa.ipc.open_file(source).schema if _is_ipc(source) else _first_version(source).schema
                yield pa.RecordBatch.from_pydict({"schema": [found.remove_metadata().serialize().to_pybytes()]})

    found = first.mapInArrow(footer, "schema binary").collect()
    if not found:
        raise DataError(f"no file at {path}", "data_file_not_found", {"path": path})
    arrow = pa.ipc.read_schema(pa.py_buffer(bytes(found[0]["schema"])))
    plain = [pa.field(f.name, f.type.value_type) if pa.types.is_dictionary(f.type) else f for f in arrow]
    return from_arrow_schema(pa.schema(plain), prefer_timestamp_ntz=True)
