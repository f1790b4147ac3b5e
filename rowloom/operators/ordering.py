"""Total order without a single task: dense row index, and segments with a halo.

Spark rows have no order, so every ordered operator here takes an explicit key.
``dense_index`` numbers the rows of a table 0, 1, 2, ... in key order:

1. range-partition by the key and sort each partition (one shuffle, no single task),
2. write that table, with ``monotonically_increasing_id`` as (partition, place),
3. add the number of rows in earlier partitions, one small row per partition.

``segments`` cuts the numbered rows into pieces of a fixed length and copies the
rows a window could need from the neighbouring piece.  A window partitioned by
(segment, series) then never holds more than one piece, however long a series is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rowloom.functions.coerce import col
from rowloom.session import written

# A series up to this many rows is handled by one plain window task.
MAX_SERIES_ROWS = 1_000_000
# Rows of one segment when a series is cut.
SEGMENT_ROWS = 250_000
# Rows with one and the same key that a single task may get, at least; and as a share of the table.
MAX_TIED_ROWS = 1_000_000
_TIED_SHARE = 0.0005
_TIE_SAMPLE = 1_000_000

_PLACE = "__place"
_PLACE_BITS = 33  # monotonically_increasing_id: partition above, row number in the low 33 bits


def as_list(names: str | Sequence[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype)
    return True


def tie_columns(df: DataFrame, used: Sequence[str], tie_breakers: Sequence[str] | None) -> list[str]:
    """Given tie-breakers, or all other orderable columns in schema order."""
    if tie_breakers is not None:
        return [c for c in as_list(tie_breakers) if c not in used]
    return [f.name for f in df.schema if f.name not in used and _orderable(f.dataType)]


def ascending(keys: Sequence[Column]) -> list[Column]:
    """Ascending with missing values last."""
    return [k.asc_nulls_last() for k in keys]


def dense_index(
    df: DataFrame, keys: Sequence[Column], name: str = "row_index", partitions: int | None = None
) -> DataFrame:
    """``df`` with a gap-free 0-based row number in the order of ``keys``.

    Counting, drawing range bounds and writing each read ``df``.  A table that is more
    than a selection from a source is written first, so that it is worked out once.

    Rows with equal keys fall into one range.  Where such a tie is heavier than a
    task should bear, the rows are written first with a fixed id, which then
    continues the key and lets the tie be divided.
    """
    order = ascending(keys)
    if costly(df):
        named = {f"__order{i}": k for i, k in enumerate(keys)}
        kept = written(df.withColumns(named), "order-input")
        return dense_index(kept, [F.col(n) for n in named], name, partitions).drop(*named)
    if heavy_tie(df, keys):
        named = {f"__order{i}": k for i, k in enumerate(keys)}
        df = written(df.withColumns(named).withColumn("__row_id", F.monotonically_increasing_id()), "tied-rows")
        order = [*ascending([F.col(n) for n in named]), F.col("__row_id").asc()]
        return _indexed(df, order, name, partitions).drop("__row_id", *named)
    return _indexed(df, order, name, partitions)


# What reading again would repeat at a price: everything but scans and projections of rows.
_COSTLY = ("Join", "Aggregate", "Window", "Sort", "Map", "Python", "Generate", "Distinct", "Repartition", "Pandas", "Arrow", "Sample")


def costly(df: DataFrame) -> bool:
    """Is more to be done than to read, filter and project rows?"""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    steps = [line.lstrip(" :+-").split(" ", 1)[0].split("(", 1)[0] for line in plan.splitlines()]
    return any(word in step for step in steps for word in _COSTLY)


def heavy_tie(df: DataFrame, keys: Sequence[Column]) -> bool:
    """Does one key value hold more rows than one task should get?

    Judged on a sample of the keys, as range partitioning itself does: it only chooses
    the plan, and both plans number every row.
    """
    n = df.count()
    if n <= MAX_TIED_ROWS:
        return False
    fraction = min(1.0, _TIE_SAMPLE / n)
    sampled = df.select(F.xxhash64(*keys).alias("key")).sample(fraction, 11)
    heaviest = sampled.groupBy("key").count().agg(F.max("count")).first()[0] or 0
    return heaviest > 0.7 * fraction * max(MAX_TIED_ROWS, n * _TIED_SHARE)


def _indexed(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None) -> DataFrame:
    spread = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = written(
        spread.sortWithinPartitions(*order).withColumn(_PLACE, F.monotonically_increasing_id()),
        "dense-index",
    )
    piece = F.shiftright(_PLACE, _PLACE_BITS)
    # One row per written partition: small by construction, whatever the table holds.
    before = (
        placed.groupBy(piece.alias("__piece"))
        .agg(F.count("*").alias("__rows"))
        .select(
            "__piece",
            F.coalesce(
                F.sum("__rows").over(Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ).alias("__before"),
        )
    )
    in_piece = col(_PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.withColumn("__piece", piece)
        .join(F.broadcast(before), "__piece")
        .withColumn(name, in_piece + F.col("__before"))
        .drop("__piece", "__before", _PLACE)
    )


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group: one scan of the group columns, combined map-side."""
    if not group:
        return df.count()
    counts = df.groupBy(*[col(g) for g in group]).count()
    return counts.agg(F.max("count")).first()[0] or 0


def needs_segments(df: DataFrame, group: Sequence[str], strategy: str, max_rows: int) -> bool:
    """``auto`` measures the largest series; ``plain`` and ``segments`` choose without a job."""
    if strategy == "auto":
        return largest_group(df, group) > max_rows
    if strategy not in ("plain", "segments"):
        raise ValueError(f"strategy must be auto, plain or segments, not {strategy!r}")
    return strategy == "segments"


def segments(
    df: DataFrame,
    keys: Sequence[Column],
    before: int = 0,
    after: int = 0,
    segment_rows: int = SEGMENT_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Cut the ordered table into pieces and copy ``before``/``after`` neighbour rows.

    Adds ``__pos`` (place in the whole order), ``__segment`` and ``__home`` (false on
    copies).
    """
    return cut(dense_index(df, keys, "__pos", partitions), before, after, segment_length(segment_rows, before, after))


def segment_length(segment_rows: int, before: int = 0, after: int = 0) -> int:
    """A piece is never shorter than the halo, so one neighbour is enough."""
    return max(segment_rows, before, after, 1)


def cut(indexed: DataFrame, before: int, after: int, length: int) -> DataFrame:
    """Assign ``__segment`` by ``__pos`` and copy the halo rows."""
    home = F.expr(f"__pos div {length}")
    inside = F.expr(f"__pos % {length}")
    places = [home]
    if before:
        places.append(F.when(inside >= length - before, home + 1))
    if after:
        places.append(F.when((inside < after) & (home > 0), home - 1))
    return (
        indexed.withColumn("__segment", F.explode(F.array_compact(F.array(*places))))
        .withColumn("__home", F.col("__segment") == home)
    )
