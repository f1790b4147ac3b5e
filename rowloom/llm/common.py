"""What the text operators share: the word pattern, and null-safe text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space between words: space, tab, line feed, vertical tab, form feed, return.
BLANK = r"[\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """The text column, null as the empty string."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text in order; empty for an empty text."""
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def crc32_of(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes; null counts as the empty text."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def held_out(doc_id: Column, fold: int) -> Column:
    """Is crc32(doc_id as text) mod 5 equal to ``fold``?  A null id counts as the empty text."""
    return crc32_of(doc_id.cast("string")) % 5 == fold


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def portions(batch: pa.RecordBatch, sizes: Sequence[int], rows: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices with few rows and, unless one row alone has more, a bounded sum of sizes."""
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and (at - start == rows or held + size > most):
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += size
    if batch.num_rows:
        yield batch.slice(start)
