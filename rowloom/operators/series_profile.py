"""Series profiling: coverage, time steps, gaps and seasonality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowloom.errors import require_columns
from rowloom.functions.coerce import col, moment, number
from rowloom.operators.ordering import as_list
from rowloom.operators.profile import numeric_summary, value_counts
from rowloom.operators.quantile import quantiles
from rowloom.session import written


def coverage(df: DataFrame, time_column: str, series: str | Sequence[str] | None = None) -> DataFrame:
    """``time_min, time_max, n_points`` per series (or over all rows)."""
    names = as_list(series)
    require_columns(df.columns, [*names, time_column], "ts_missing_datetime_column", "coverage")
    kept = df
    for name in names:
        kept = kept.where(col(name).isNotNull())
    t = moment(df, time_column)
    return kept.groupBy(*[col(n) for n in names]).agg(
        F.min(t).alias("time_min"), F.max(t).alias("time_max"), F.count(t).alias("n_points")
    )


def series_overview(df: DataFrame, time_column: str, series: str) -> DataFrame:
    """Number of series, rows and the global time range, in one row."""
    return df.agg(
        F.count_distinct(col(series)).alias("n_series"),
        F.count("*").alias("n_rows"),
        F.min(moment(df, time_column)).alias("time_min"),
        F.max(moment(df, time_column)).alias("time_max"),
    )


def delta_summary(deltas: DataFrame) -> DataFrame:
    """Summary of ``delta_seconds`` (see :func:`time_deltas`)."""
    return numeric_summary(written(deltas.select("delta_seconds"), "deltas"), ["delta_seconds"])


def common_deltas(deltas: DataFrame, top: int | None = None) -> DataFrame:
    return value_counts(deltas, "delta_seconds", top)


def gap_threshold(deltas: DataFrame, factor: float = 1.5) -> float | None:
    """``factor`` times the median step."""
    median = quantiles(deltas, ["delta_seconds"], [0.5])["delta_seconds"][0]
    return None if median is None else median * factor


def large_gaps(deltas: DataFrame, factor: float = 1.5) -> DataFrame:
    """Steps longer than the threshold, with the threshold beside them."""
    deltas = written(deltas, "deltas")  # the window behind them is not run again for the median
    limit = F.lit(gap_threshold(deltas, factor)).cast("double")
    return deltas.where(F.col("delta_seconds") > limit).withColumn("threshold", limit)


def gap_summary(deltas: DataFrame, factor: float = 1.5) -> DataFrame:
    """One row: n_deltas, n_gaps, threshold, and the mean, longest and total gap in seconds."""
    deltas = written(deltas.select("delta_seconds"), "deltas")
    limit = F.lit(gap_threshold(deltas, factor)).cast("double")
    gap = F.when(F.col("delta_seconds") > limit, F.col("delta_seconds"))
    return deltas.agg(
        F.count("*").alias("n_deltas"),
        F.count(gap).alias("n_gaps"),
        F.first(limit).alias("threshold"),
        F.avg(gap).alias("mean_gap"),
        F.max(gap).alias("longest_gap"),
        F.sum(gap).alias("total_gap"),
    )


def seasonal_means(df: DataFrame, time_column: str, target: str, by: str = "hour") -> DataFrame:
    """Mean target by hour of day or by day of week (0 = Monday)."""
    t = moment(df, time_column)
    part: dict[str, Column] = {"hour": F.hour(t), "dow": F.weekday(t)}
    return df.groupBy(part[by].alias(by)).agg(F.avg(number(df, target)).alias("mean_target"))
