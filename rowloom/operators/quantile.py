"""Exact quantiles at any size, in two passes over the table.

The first pass takes moments and sketches a share of the values; the sketch gives a bracket around each wanted rank.  The second pass counts, per
Arrow batch, the values between the brackets and keeps those inside, so a few percent of
the values are shuffled.  The counts show whether a bracket holds its rank; if one does
not, all values are sorted.  The sketch only chooses the brackets, it never enters the
result.  A small table skips the first pass: its values are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.functions.coerce import number
from rowloom.operators.ordering import dense_index
from rowloom.session import small_table, written

# Counted values that one window task per column may get.
PLAIN_ROWS = 1_000_000
# Tables up to this many rows are counted whole.
WHOLE_ROWS = 250_000
# Share of the values that is sketched, and the ranks read off the sketch.
SHARE = 0.03
GRID = 500
_ACCURACY = 10_000
_PILOT_ROWS = 1000


def quantiles(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float], approx: bool = False, rows: int | None = None
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation as plain numbers, a few per column.

    ``approx`` takes Spark's sketch instead; ``rows`` saves the count where it is known.
    """
    if approx:
        row = df.agg(
            *[F.percentile_approx(number(df, c), [float(q) for q in qs], 10_000).alias(f"q{i}") for i, c in enumerate(columns)]
        ).first()
        return {c: list(row[f"q{i}"] or [None] * len(qs)) for i, c in enumerate(columns)}
    found = {(r["column"], r["q"]): r["value"] for r in quantile_table(df, columns, qs, rows).collect()}
    return {c: [found.get((c, float(q))) for q in qs] for c in columns}


def quantile_table(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float], rows: int | None = None
) -> DataFrame:
    """``(column, q, value)``; a column without values has no rows."""
    n = df.count() if rows is None else rows
    if n <= WHOLE_ROWS:
        return _named(_plain(_counted(_long(df, columns)), qs), columns)
    return bracketed(df, columns, qs, with_sketches(df, columns))


@dataclass(frozen=True)
class ColumnSketch:
    """What the first pass finds in a column: exact moments and ends, and sketched ranks."""

    n: int
    mean: float | None
    std: float | None
    low: float | None
    high: float | None
    ranks: Sequence[float]


def with_sketches(df: DataFrame, columns: Sequence[str]) -> list[ColumnSketch]:
    """One pass over the values of all columns.

    Each Arrow batch becomes one row of sums per column, taken around a rough centre so
    that they lose no digits, and a share of its values, which Spark sketches map-side.
    """
    cells = df.select(*[number(df, c).alias(f"x{i}") for i, c in enumerate(columns)])
    pilot = cells.limit(_PILOT_ROWS).toArrow()
    centres = []
    for i in range(len(columns)):
        x = pilot.column(i).drop_null().to_numpy()
        x = x[np.isfinite(x)]
        centres.append(float(x.mean()) if len(x) else 0.0)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng()
        for batch in batches:
            place, drawn, n, first, second, low, high = [], [], [], [], [], [], []
            for i, centre in enumerate(centres):
                x = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                if not len(x):
                    continue
                some = x[draw.random(len(x)) < SHARE].tolist()
                moved = x - centre
                place += [i] * (len(some) + 1)
                drawn += [None, *some]
                for sums, value in ((n, len(x)), (first, moved.sum()), (second, moved @ moved), (low, x.min()), (high, x.max())):
                    sums += [value] + [None] * len(some)
            floats = [pa.array(v, pa.float64()) for v in (first, second, low, high)]
            arrays = [pa.array(place, pa.int32()), pa.array(drawn, pa.float64()), pa.array(n, pa.int64()), *floats]
            yield pa.RecordBatch.from_arrays(arrays, names=["place", "drawn", "n", "first", "second", "low", "high"])

    seen = cells.mapInArrow(look, "place int, drawn double, n bigint, first double, second double, low double, high double")
    ranks = F.percentile_approx("drawn", [i / GRID for i in range(GRID + 1)], _ACCURACY)
    sums = [F.sum("n").alias("n"), F.sum("first").alias("first"), F.sum("second").alias("second")]
    rows = {r["place"]: r for r in seen.groupBy("place").agg(ranks.alias("ranks"), *sums, F.min("low").alias("low"), F.max("high").alias("high")).collect()}
    out = []
    for i, centre in enumerate(centres):
        r = rows.get(i)
        if r is None:
            out.append(ColumnSketch(0, None, None, None, None, []))
            continue
        n, squares = r["n"], r["second"] - r["first"] ** 2 / r["n"]
        std = None if n < 2 else float(np.sqrt(squares / (n - 1))) if squares > 0 else squares * 0.0
        out.append(ColumnSketch(n, centre + r["first"] / n, std, r["low"], r["high"], r["ranks"] or []))
    return out


def bracketed(df: DataFrame, columns: Sequence[str], qs: Sequence[float], seen: Sequence[ColumnSketch]) -> DataFrame:
    """``(column, q, value)`` by one pass, given what :func:`with_sketches` found."""
    edges = [_edges(c.n, c.ranks, qs) for c in seen]
    counted = written(_bracket_counts(df, columns, edges), "bracketed-values")
    located = written(_located(counted, qs), "located-ranks")
    # A rank between two brackets shows as a hit without a value.
    if located.where("value is null").limit(1).count():
        return sorted_quantiles(df, columns, qs)
    return _named(located, columns)


def _bracket_counts(df: DataFrame, columns: Sequence[str], edges: list[list[float]]) -> DataFrame:
    """``(column, region, value, n)``: odd regions are brackets and keep their values.

    Even regions, between the brackets, keep only how many values there are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, region, value, n = [], [], [], []
            for i, bounds in enumerate(edges):
                x = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                where = np.zeros(len(x), np.int8)
                for k, bound in enumerate(bounds):
                    # Both ends belong to the bracket.
                    where += x >= bound if k % 2 == 0 else x > bound
                for r, rows in enumerate(np.bincount(where, minlength=len(bounds) + 1).tolist()):
                    if not rows:
                        continue
                    values, times = np.unique(x[where == r], return_counts=True) if r % 2 else (None, [rows])
                    place += [i] * len(times)
                    region += [r] * len(times)
                    value += [None] if values is None else values.tolist()
                    n += list(times)
            arrays = [pa.array(place, pa.int32()), pa.array(region, pa.int32()), pa.array(value, pa.float64()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["column", "region", "value", "n"])

    cells = df.select(*[number(df, c).alias(f"x{i}") for i, c in enumerate(columns)])
    found = cells.mapInArrow(count, "column int, region int, value double, n bigint")
    return found.groupBy("column", "region", "value").agg(F.sum("n").alias("n"))


def sorted_quantiles(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float], block_rows: int = 100_000
) -> DataFrame:
    """``(column, q, value)`` from all values in sorted order."""
    return _named(_blocked(_counted(_long(df, columns)), qs, block_rows), columns)


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, region, value)`` of all values, the column by its place in the list, all in one region."""
    cells = [F.struct(F.lit(i).alias("column"), number(df, c).alias("value")) for i, c in enumerate(columns)]
    values = df.select(F.inline(F.array(*cells))).where("value is not null")
    return values.select("column", F.lit(1).alias("region"), "value")


def _counted(values: DataFrame) -> DataFrame:
    return values.groupBy("column", "region", "value").agg(F.count("*").alias("n"))


def _edges(n: int, sketch: Sequence[float], qs: Sequence[float]) -> list[float]:
    """Ends of disjoint brackets around each quantile; open at the ends of the range."""
    if not sketch:
        return [float("-inf"), float("inf")]
    # Five times the error of a quantile of such a sample, as a share, and the sketch's own.
    slack = 2.5 / max(SHARE * n, 1.0) ** 0.5 + 1.0 / _ACCURACY
    brackets: list[list[float]] = []
    for q in sorted(qs):
        first, last = int(np.floor((q - slack) * GRID)), int(np.ceil((q + slack) * GRID))
        low = float("-inf") if first <= 0 else sketch[first]
        high = float("inf") if last >= GRID else sketch[last]
        if brackets and low <= brackets[-1][1]:
            brackets[-1][1] = max(high, brackets[-1][1])
        else:
            brackets.append([low, high])
    return [bound for bracket in brackets for bound in bracket]


def _ranks(totals: DataFrame, qs: Sequence[float]) -> DataFrame:
    """One or two 0-based ranks per column and quantile, with the share between them."""
    spot = (F.col("total") - 1) * F.col("q")
    return (
        totals.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
        .withColumn("share", spot - F.floor(spot))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor(spot), F.ceil(spot)))))
    )


def _located(counted: DataFrame, qs: Sequence[float]) -> DataFrame:
    return _plain(counted, qs) if counted.count() <= PLAIN_ROWS else _blocked(counted, qs, 100_000)


def _plain(counted: DataFrame, qs: Sequence[float]) -> DataFrame:
    """``(column, q, share, rank, value)`` by one running count per column."""
    column = Window.partitionBy("column")
    upto = column.orderBy("region", "value").rowsBetween(Window.unboundedPreceding, 0)
    running = counted.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(column)})
    spots = [(F.col("total") - 1) * F.lit(float(q)) for q in qs]
    wanted = F.array(
        *[
            F.struct(F.lit(float(q)).alias("q"), (s - F.floor(s)).alias("share"), rank.alias("rank"))
            for q, s in zip(qs, spots)
            for rank in (F.floor(s), F.ceil(s))
        ]
    )
    here = lambda w: (w["rank"] < F.col("upto")) & (w["rank"] >= F.col("upto") - F.col("n"))
    # The test for any rank compiles to plain comparisons; few rows reach the array.
    hit = reduce(lambda a, b: a | b, [here({"rank": rank}) for s in spots for rank in (F.floor(s), F.ceil(s))])
    return running.where(hit).select("column", "value", F.inline(F.filter(wanted, here)))


def _blocked(counted: DataFrame, qs: Sequence[float], block_rows: int) -> DataFrame:
    """As :func:`_plain` for any number of values: block totals tell which blocks to read."""
    ranked = dense_index(counted, [F.col("column"), F.col("region"), F.col("value")], "__pos").withColumn(
        "__block", F.expr(f"__pos div {block_rows}")
    )
    blocks = ranked.groupBy("column", "__block").agg(F.sum("n").alias("rows"))
    earlier = Window.partitionBy("column").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    wanted = _ranks(blocks.groupBy("column").agg(F.sum("rows").alias("total")), qs)
    # At most two ranks per column and quantile: the table of located blocks stays tiny.
    located = wanted.join(blocks, "column").where("rank >= before and rank < before + rows")
    within = Window.partitionBy("column", "__block").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    needed = located.select("column", "__block", "before").distinct()
    running = ranked.join(F.broadcast(needed), ["column", "__block"]).withColumn(
        "upto", F.col("before") + F.sum("n").over(within)
    )
    hit = (
        running.drop("before")
        .join(F.broadcast(located.select("column", "__block", "q", "share", "rank")), ["column", "__block"])
        .where("rank < upto and rank >= upto - n")
    )
    return hit.select("column", "value", "q", "share", "rank")


def _interpolated(located: DataFrame) -> DataFrame:
    low, high = F.min("value"), F.max("value")
    # Equal neighbours need no interpolation, which would turn infinities into NaN.
    between = F.when(low == high, low).otherwise(low + (high - low) * F.max("share"))
    return located.groupBy("column", "q").agg(between.alias("value"))


def _named(located: DataFrame, columns: Sequence[str]) -> DataFrame:
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("column") + 1)
    return _interpolated(located).withColumn("column", name)
