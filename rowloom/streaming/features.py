"""Row features and fitted preprocessing on unbounded tables.

Both are projections, so they need no state, watermark or output mode beyond append.
Row-window features do need bounded history and are refused on streams.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from rowloom.operators.preprocess import Preprocessor
from rowloom.operators.row_features import RowFeatures, build_row_features
from rowloom.sources import ledger


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "parquet",
    files_per_trigger: int | None = None,
    **options: Any,
) -> DataFrame:
    """New files below ``path`` as a stream, at most ``files_per_trigger`` in one batch."""
    reader = spark.readStream.format(format).schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def stream_row_features(stream: DataFrame, spec: RowFeatures) -> DataFrame:
    """Row features with value checks inside the projection."""
    return build_row_features(stream, spec, validate="lazy")


def stream_preprocess(stream: DataFrame, fitted: Preprocessor) -> DataFrame:
    """A fitted preprocessor on a stream."""
    return fitted.transform(stream, validate="lazy")


def append_to(stream: DataFrame, path: str, checkpoint: str, format: str = "parquet") -> StreamingQuery:
    """Process what is there now, exactly once, and stop."""
    writer = stream.writeStream.format(format).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)


def each_chunk(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand over one bounded chunk at a time, as a DataFrame that stays distributed."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def ingest(stream: DataFrame, path: str, checkpoint: str, name: str = "ingest") -> StreamingQuery:
    """Commit every chunk to the ledger at ``path``, once: see :mod:`rowloom.sources.ledger`.

    A batch that dies before its commit leaves nothing to be read, and one that is replayed
    after its commit is left out.  ``name`` tells the streams into one ledger apart and belongs
    to ``checkpoint``: with a new checkpoint, whose batches count from 0 again, give a new name.
    """
    return each_chunk(stream, lambda chunk, batch: ledger.append(chunk, path, name, batch), checkpoint)
