"""Gap segments: series cut where a step in time is too long, and what to do with the pieces.

Counting cuts, and finding the known values next to a missing one, read a series from end
to end.  ``plain`` does so in one window per series.  ``segments`` numbers the rows of the
whole table, cuts them into pieces of a fixed length, and scans each piece by itself; what
a piece hands on (its cuts, its first and last known value) is one short row per piece and
series, over which the scan goes on.  No task sees more than a piece, whether a series
holds a third of the rows or there is only one, and rows meet what is handed on by an
equijoin.  ``auto`` measures the largest series first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.errors import require_columns
from rowloom.functions.coerce import col, moment, number, seconds_between
from rowloom.operators.ordering import (
    MAX_SERIES_ROWS,
    SEGMENT_ROWS,
    as_list,
    ascending,
    dense_index,
    needs_segments,
    segment_length,
    tie_columns,
)
from rowloom.session import written

_PIECE, _POS = "__piece", "__pos"


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality column by column."""
    same: Column = F.lit(True)
    for a, b in zip(left, right):
        same &= col(a).eqNullSafe(col(b))
    return same


def _ordered(
    df: DataFrame, names: Sequence[str], order: Sequence[Column], divided: bool, segment_rows: int
) -> tuple[DataFrame, list[str], Column]:
    """``df``, the columns within which rows are scanned, and their order there."""
    if not divided:
        named = df.withColumn(_POS, F.row_number().over(Window.partitionBy(*[col(n) for n in names]).orderBy(*ascending(order))))
        return named, list(names), F.col(_POS)
    placed = dense_index(df, [*[col(n) for n in names], *order], _POS)
    placed = placed.withColumn(_PIECE, F.expr(f"{_POS} div {segment_length(segment_rows)}"))
    return written(placed, "segment-pieces"), [_PIECE, *names], F.col(_POS)


def _handed_on(pieces: DataFrame, names: Sequence[str], found: dict[str, Column], back: bool = False) -> DataFrame:
    """Per piece and series what the pieces before it (``back``: behind it) add up to.

    ``found`` maps names to functions of the summary columns over a window of other pieces.
    """
    order = F.col(_PIECE).desc() if back else F.col(_PIECE).asc()
    others = Window.partitionBy(*[col(n) for n in names]).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumns({n: c.over(others) for n, c in found.items()})


def _meet(rows: DataFrame, pieces: DataFrame, keys: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """Rows with what their piece was handed: an equijoin of two written tables."""
    other = [f"__m{i}" for i in range(len(keys))]
    right = pieces.select(*[col(k).alias(o) for k, o in zip(keys, other)], *wanted)
    return rows.join(right, _same(keys, other)).drop(*other)


def gap_segments(
    df: DataFrame,
    time_column: str,
    max_step: float,
    series: str | Sequence[str] | None = None,
    tie_breakers: str | Sequence[str] | None = None,
    strategy: str = "auto",
    max_series_rows: int = MAX_SERIES_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """``df`` with ``segment``: 0, 1, ... per series, one more after each step above ``max_step`` seconds.

    Rows of one moment share a segment whatever their order.  Rows without a time or
    without a series are in segment 0.
    """
    names = as_list(series)
    require_columns(df.columns, [*names, time_column], "ts_missing_datetime_column", "gap segments")
    divided = needs_segments(df, names, strategy, max_series_rows)
    when = "__when"
    rows = df.withColumn(when, moment(df, time_column))
    ties = tie_columns(df, [time_column, *names], as_list(tie_breakers))
    rows, keys, place = _ordered(rows, names, [F.col(when), *[col(t) for t in ties]], divided, segment_rows)
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(place)
    known = F.col(when).isNotNull()
    for n in names:
        known &= col(n).isNotNull()
    step = seconds_between(F.col(when), F.lag(when).over(window))
    cut = F.when(known & (step > max_step), 1).otherwise(0).cast("bigint")
    counted = rows.withColumn("__cut", cut).withColumn("__own", F.sum("__cut").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    if not divided:
        return _numbered(df, counted, known, F.col("__own"))

    counted = written(counted.drop("__cut"), "segment-counted")
    pieces = counted.groupBy(*[col(k) for k in keys]).agg(
        F.max("__own").alias("__cuts"), F.min(when).alias("__first"), F.max(when).alias("__last")
    )
    # The step from the piece before, then all cuts of earlier pieces and the steps between them.
    between = Window.partitionBy(*[col(n) for n in names]).orderBy(_PIECE)
    entry = seconds_between(F.col("__first"), F.lag("__last").over(between)) > max_step
    pieces = pieces.withColumn("__entry", F.coalesce(entry.cast("bigint"), F.lit(0)))
    pieces = _handed_on(pieces, names, {"__earlier": F.sum(F.col("__cuts") + F.col("__entry"))})
    pieces = pieces.withColumn("__before", F.coalesce("__earlier", F.lit(0)) + F.col("__entry"))
    counted = _meet(counted, written(pieces, "segment-cuts"), keys, ["__before"])
    return _numbered(df, counted, known, F.col("__own") + F.col("__before"))


def _numbered(df: DataFrame, rows: DataFrame, known: Column, number_: Column) -> DataFrame:
    segment = F.when(known, number_).otherwise(0).cast("int")
    return rows.select(*[col(c) for c in df.columns], segment.alias("segment"))


def drop_short_segments(df: DataFrame, least: int, series: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of segments with at least ``least`` rows."""
    keys = [*as_list(series), "segment"]
    sizes = df.groupBy(*[col(c) for c in keys]).agg(F.count("*").alias("__rows")).where(F.col("__rows") >= least)
    renamed = [f"__k{i}" for i in range(len(keys))]
    for c, k in zip(keys, renamed):
        sizes = sizes.withColumnRenamed(c, k)
    return df.join(sizes, _same(keys, renamed), "left_semi")


def interpolate(
    df: DataFrame,
    time_column: str,
    value: str,
    series: str | Sequence[str] | None = None,
    strategy: str = "auto",
    max_series_rows: int = MAX_SERIES_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """``df`` with ``{value}__filled``: missing values on the line between their neighbours in the segment.

    Before the first and after the last value of a segment nothing is filled.  Of values
    of one moment the smallest comes first.
    """
    names = [*as_list(series), "segment"]
    require_columns(df.columns, [*names, time_column, value], "ts_missing_datetime_column", "interpolation")
    divided = needs_segments(df, names, strategy, max_series_rows)
    rows = df.withColumns({"__t": moment(df, time_column), "__x": number(df, value)})
    rows, keys, place = _ordered(rows, names, [F.col("__t"), F.col("__x")], divided, segment_rows)
    within = Window.partitionBy(*[col(k) for k in keys])
    so_far = within.orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    # Backwards as a running window of the reversed order: one step per row.
    from_here = within.orderBy(place.desc()).rowsBetween(Window.unboundedPreceding, 0)
    point = F.when(F.col("__x").isNotNull() & F.col("__t").isNotNull(), F.struct(F.col("__t").alias("t"), F.col("__x").alias("x")))
    rows = rows.withColumn("__point", point)
    rows = rows.withColumn("__after", F.last("__point", ignorenulls=True).over(from_here))
    rows = rows.withColumn("__before", F.last("__point", ignorenulls=True).over(so_far))
    if divided:
        # Only what neither side of a piece knows is asked of the pieces around it.
        rows = written(rows, "segment-points")
        by_place = lambda pick: pick(F.when(F.col("__point").isNotNull(), F.struct(place, "__point")))["__point"]
        pieces = rows.groupBy(*[col(k) for k in keys]).agg(by_place(F.min).alias("__first"), by_place(F.max).alias("__last"))
        pieces = _handed_on(pieces, names, {"__earlier": F.last("__last", ignorenulls=True)})
        pieces = _handed_on(pieces, names, {"__later": F.last("__first", ignorenulls=True)}, back=True)
        rows = _meet(rows, written(pieces, "segment-ends"), keys, ["__earlier", "__later"])
        rows = rows.withColumns({"__before": F.coalesce("__before", "__earlier"), "__after": F.coalesce("__after", "__later")})
    b, a = F.col("__before"), F.col("__after")
    span = F.nullif(seconds_between(a["t"], b["t"]), F.lit(0.0))
    line = b["x"] + (a["x"] - b["x"]) * seconds_between(F.col("__t"), b["t"]) / span
    return rows.select(*[col(c) for c in df.columns], F.coalesce("__x", line).alias(f"{value}__filled"))
