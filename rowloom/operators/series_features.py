"""Ordered per-series features: calendar, lag, difference and rolling aggregates.

Two plans give the same rows.  ``plain`` is one window per series.  ``segments``
cuts long series into pieces with a halo (see :mod:`rowloom.operators.ordering`),
so a series holding a third of the table is still spread over many tasks.
``auto`` measures the largest series and takes the second plan only beyond
``max_series_rows``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from rowloom.errors import DataError, require_columns
from rowloom.functions.calendar import calendar_parts
from rowloom.functions.coerce import (
    col,
    finite_number,
    is_fraction,
    is_numeric,
    is_temporal,
    moment,
    no_nan,
    seconds_between,
    type_of,
)
from rowloom.operators.ordering import (
    MAX_SERIES_ROWS,
    SEGMENT_ROWS,
    as_list,
    ascending,
    dense_index,
    needs_segments,
    segments,
    tie_columns,
)
from rowloom.operators.row_features import ColumnStages
from rowloom.operators.wide_windows import WIDE_ROWS, wide_rolling

ROLLING = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "std": F.stddev_samp}


@dataclass(frozen=True)
class SeriesFeatures:
    """What to derive along each series.

    Order is (datetime_column, tie_breakers); without a datetime column, or with
    ``sort_by_time=False``, it is ``order_by``.  ``tie_breakers=None`` means all
    other orderable columns: name a unique column to keep the sort key short.
    """

    datetime_column: str | None = None
    group_column: str | Sequence[str] | None = None
    sort_by_time: bool = True
    expand_datetime: bool = False
    drop_original_datetime: bool = False
    lag_features: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    diff_features: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    rolling_features: Mapping[str, tuple[str, int, str]] = field(default_factory=dict)
    rolling_min_periods: int | None = None
    order_by: str | Sequence[str] | None = None
    tie_breakers: str | Sequence[str] | None = None
    datetime_format: str | None = None


def build_series_features(
    df: DataFrame,
    spec: SeriesFeatures,
    strategy: str = "auto",
    max_series_rows: int = MAX_SERIES_ROWS,
    segment_rows: int = SEGMENT_ROWS,
    sort_output: bool = False,
) -> DataFrame:
    """Apply ``spec``; the output is in no order unless ``sort_output`` asks for one."""
    group = as_list(spec.group_column)
    ordered = bool(spec.lag_features or spec.diff_features or spec.rolling_features)
    if df.isStreaming and ordered:
        raise DataError("row windows need a bounded table", "ts_streaming_unsupported")
    _check_structure(df, spec, group)

    # A key that a feature overwrites or drops, or that must be parsed, is kept aside.
    work, group_names, key_names = df, [], []
    if ordered or sort_output:
        aside: dict[str, Column] = {}
        rewritten = _rewritten(spec)

        def place(name: str, label: str, value: Column | None = None) -> str:
            if value is None and name not in rewritten:
                return name
            aside[label] = col(name) if value is None else value
            return label

        group_names = [place(g, f"__group{i}") for i, g in enumerate(group)]
        key_names = [place(n, f"__key{i}", v) for i, (n, v) in enumerate(_order_keys(df, spec, group))]
        work = df.withColumns(aside) if aside else df

    start = ColumnStages(work)
    if spec.expand_datetime and spec.datetime_column:
        name = spec.datetime_column
        start.add(calendar_parts(moment(work, name, spec.datetime_format, "ts_datetime_conversion_error"), name))
        if spec.drop_original_datetime:
            start.drop(name)
    work = start.df

    if ordered:
        halo = _check_features(work, spec)
        group_keys, order_keys = [col(g) for g in group_names], [col(k) for k in key_names]
        split = needs_segments(df, group, strategy, max_series_rows)
        if split:
            work = segments(work, [*group_keys, *order_keys], before=halo, segment_rows=segment_rows)
            within, order = [F.col("__segment"), *group_keys], [F.col("__pos")]
        else:
            within, order = group_keys, ascending(order_keys)
        grouped = None
        for g in group_keys:
            grouped = g.isNotNull() if grouped is None else grouped & g.isNotNull()
        work = _add_features(ColumnStages(work), spec, within, order, grouped)
        if split:
            work = work.where("__home").drop("__segment", "__home", "__pos")

    if sort_output:
        work = work.orderBy(*ascending([col(k) for k in (*group_names, *key_names)]))
    return work.drop(*[n for n in (*group_names, *key_names) if n not in df.columns])


def _rewritten(spec: SeriesFeatures) -> set[str]:
    names = {*spec.lag_features, *spec.diff_features, *spec.rolling_features}
    if spec.drop_original_datetime and spec.expand_datetime and spec.datetime_column:
        names.add(spec.datetime_column)
    return names


def _check_structure(df: DataFrame, spec: SeriesFeatures, group: Sequence[str]) -> None:
    if spec.datetime_column is not None:
        require_columns(df.columns, [spec.datetime_column], "ts_missing_datetime_column", "series features")
    require_columns(df.columns, group, "ts_missing_group_column", "series features")
    require_columns(df.columns, as_list(spec.order_by), "ts_sort_error", "series order")
    require_columns(df.columns, as_list(spec.tie_breakers), "ts_sort_error", "series tie-breakers")


def _order_keys(
    df: DataFrame, spec: SeriesFeatures, group: Sequence[str]
) -> list[tuple[str, Column | None]]:
    """Names of the order columns, with an expression where the column must be parsed first."""
    keys: list[tuple[str, Column | None]] = []
    used = list(group)
    if spec.sort_by_time and spec.datetime_column:
        name = spec.datetime_column
        parsed = moment(df, name, spec.datetime_format, "ts_datetime_conversion_error")
        keys.append((name, None if is_temporal(type_of(df, name)) else parsed))
        used.append(name)
    elif not spec.order_by:
        raise DataError(
            "rows have no order of their own: give datetime_column or order_by", "ts_missing_datetime_column"
        )
    extra = [c for c in as_list(spec.order_by) if c not in used]
    extra += tie_columns(df, used + extra, spec.tie_breakers)
    return keys + [(c, None) for c in extra]


def _check_features(df: DataFrame, spec: SeriesFeatures) -> int:
    """Check every feature at plan time; return how many earlier rows the longest chain reads."""
    known = list(df.columns)
    reach: dict[str, int] = {}

    def reads(new: str, source: str, rows: int, code: str) -> None:
        require_columns(known, (source,), code, f"feature {new}")
        reach[new] = reach.get(source, 0) + rows
        known.append(new)

    def positive(new: str, steps: int, code: str) -> None:
        if steps <= 0:
            raise DataError(f"feature {new}: {steps} is not positive", code, {"feature": new})

    for new, (source, steps) in spec.lag_features.items():
        positive(new, steps, "ts_invalid_lag")
        reads(new, source, steps, "ts_missing_lag_source")
    for new, (source, steps) in spec.diff_features.items():
        positive(new, steps, "ts_invalid_diff_lag")
        reads(new, source, steps, "ts_missing_diff_source")
    for new, (source, rows, agg) in spec.rolling_features.items():
        positive(new, rows, "ts_invalid_rolling_window")
        if agg not in ROLLING:
            raise DataError(
                f"feature {new}: unknown aggregate {agg!r}", "ts_invalid_rolling_agg", {"valid": sorted(ROLLING)}
            )
        least = spec.rolling_min_periods
        if least is not None and not 0 <= least <= rows:
            raise DataError(f"feature {new}: min_periods {least} for {rows} rows", "ts_invalid_min_periods")
        reads(new, source, rows - 1, "ts_missing_rolling_source")
    return max(reach.values(), default=0)


def _add_features(
    stages: ColumnStages, spec: SeriesFeatures, within: Sequence[Column], order: Sequence[Column], grouped: Column | None
) -> DataFrame:
    # Rows of no series get no series features.
    keep = (lambda value: value) if grouped is None else (lambda value: F.when(grouped, value))
    window = Window.partitionBy(*within).orderBy(*order)
    wide: dict[str, tuple[str, int, str]] = {}

    def close(stages: ColumnStages) -> ColumnStages:
        """Apply the wide features gathered so far, which do not read each other."""
        if not wide:
            return stages
        frame = stages.df
        asked = {new: (finite_number(frame, source), rows, agg) for new, (source, rows, agg) in wide.items()}
        frame, found, helpers = wide_rolling(frame, asked, within, order)
        done = {}
        for new, (_, rows, agg) in wide.items():
            done[new] = keep(enough(*found[new], agg, _least(spec, rows)))
        wide.clear()
        return ColumnStages(frame.withColumns(done).drop(*helpers))

    for new, (source, steps) in spec.lag_features.items():
        stages.reading(source)
        stages.add({new: keep(F.lag(col(source), steps).over(window))})
    for new, (source, steps) in spec.diff_features.items():
        frame = stages.reading(source)
        stages.add({new: keep(difference(frame, source, F.lag(col(source), steps).over(window), new))})
    for new, (source, rows, agg) in spec.rolling_features.items():
        if rows >= WIDE_ROWS:
            if source in wide or new in wide or any(new == s for s, _, _ in wide.values()):
                stages = close(stages)
            wide[new] = (source, rows, agg)
            continue
        stages = close(stages)
        frame = stages.reading(source)
        stages.add({new: keep(rolling(finite_number(frame, source), window, rows, agg, _least(spec, rows)))})
    return close(stages).df


def _least(spec: SeriesFeatures, rows: int) -> int:
    return rows if spec.rolling_min_periods is None else spec.rolling_min_periods


def difference(df: DataFrame, source: str, earlier: Column, new: str) -> Column:
    """``source - earlier`` in the source's own type; times differ in seconds.  No coercion."""
    dtype = type_of(df, source)
    if is_temporal(dtype):
        return seconds_between(col(source), earlier)
    if not is_numeric(dtype):
        raise DataError(
            f"feature {new}: {dtype.simpleString()} has no difference", "ts_invalid_diff_source", {"source": source}
        )
    if is_fraction(dtype):
        return no_nan(col(source) - earlier)
    return F.try_subtract(col(source), earlier)


def rolling(value: Column, window: WindowSpec, rows: int, agg: str, min_periods: int) -> Column:
    """Aggregate over the last ``rows`` rows where at least ``min_periods`` have a value."""
    frame = window.rowsBetween(1 - rows, 0)
    return enough(ROLLING[agg](value).over(frame), F.count(value).over(frame), agg, min_periods)


def enough(result: Column, count: Column, agg: str, min_periods: int) -> Column:
    """``result`` where the window has enough values."""
    if min_periods == 0:
        return F.coalesce(result, F.lit(0.0)) if agg == "sum" else result
    return F.when(count >= min_periods, result)


def time_deltas(
    df: DataFrame,
    time_column: str,
    series: str | Sequence[str] | None = None,
    tie_breakers: str | Sequence[str] | None = None,
    strategy: str = "auto",
    **sizes: int,
) -> DataFrame:
    """``(series, time, delta_seconds)`` between neighbours, first row of each series dropped."""
    names = as_list(series)
    require_columns(df.columns, [time_column], "ts_missing_datetime_column", "time deltas")
    kept = list(dict.fromkeys([*names, time_column, *as_list(tie_breakers)]))
    spec = SeriesFeatures(
        datetime_column=time_column,
        group_column=names or None,
        diff_features={"delta_seconds": (time_column, 1)},
        tie_breakers=as_list(tie_breakers),
    )
    rows = df.select(*[col(c) for c in kept]).withColumn(time_column, moment(df, time_column))
    deltas = build_series_features(rows, spec, strategy, **sizes)
    return deltas.where("delta_seconds is not null").select(*[col(c) for c in (*names, time_column)], "delta_seconds")


def rolling_band(
    df: DataFrame,
    time_column: str,
    target_column: str,
    series: str | Sequence[str] | None = None,
    window: int = 24,
    tie_breakers: str | Sequence[str] | None = None,
    strategy: str = "auto",
    **sizes: int,
) -> DataFrame:
    """Rolling mean and standard deviation with the band one deviation around the mean."""
    spec = SeriesFeatures(
        datetime_column=time_column,
        group_column=series,
        rolling_features={
            "roll_mean": (target_column, window, "mean"),
            "roll_std": (target_column, window, "std"),
        },
        rolling_min_periods=1,
        tie_breakers=tie_breakers,
    )
    mean, std = F.col("roll_mean"), F.col("roll_std")
    return build_series_features(df, spec, strategy, **sizes).withColumns(
        {"band_low": mean - std, "band_high": mean + std}
    )


def normalize_per_series(
    df: DataFrame, columns: Sequence[str], series: str | Sequence[str], fit_on: DataFrame | None = None
) -> DataFrame:
    """``{c}__norm``: z-score of each column within its series, 0 where the series is constant.

    Statistics come from ``fit_on`` (the training rows) when given.  They are combined
    map-side, so a long series is no hot spot; the join back is left to AQE, which
    broadcasts small statistics and splits a skewed series otherwise.
    """
    names = as_list(series)
    source = df if fit_on is None else fit_on
    stats = source.groupBy(*[col(s) for s in names]).agg(
        *[F.avg(finite_number(source, c)).alias(f"__avg{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(finite_number(source, c)).alias(f"__sd{i}") for i, c in enumerate(columns)],
    )
    joined = df.join(stats, names, "left")
    scaled = {}
    for i, c in enumerate(columns):
        centred = finite_number(df, c) - F.col(f"__avg{i}")
        scaled[f"{c}__norm"] = F.when(F.col(f"__sd{i}") == 0, centred * 0).otherwise(centred / F.col(f"__sd{i}"))
    kept = [col(c) for c in df.columns]
    return joined.withColumns(scaled).select(*kept, *[col(n) for n in scaled])


def latest_rows(
    df: DataFrame,
    time_column: str,
    rows: int,
    series: str | Sequence[str] | None = None,
    tie_breakers: str | Sequence[str] | None = None,
    strategy: str = "auto",
    max_series_rows: int = MAX_SERIES_ROWS,
) -> DataFrame:
    """The most recent ``rows`` rows of each series.

    ``row_number() <= rows`` lets Spark cut every series to ``rows`` in each map task
    before the shuffle, so the largest series costs ``rows`` per task, not its length.
    That rule stops at ``spark.sql.optimizer.windowGroupLimitThreshold``; beyond it long
    series are numbered in one total order instead and kept by distance from their end.
    """
    names = as_list(series)
    require_columns(df.columns, [*names, time_column], "ts_missing_datetime_column", "latest rows")
    ties = tie_columns(df, [*names, time_column], tie_breakers)
    by = [col(s) for s in names]
    when = moment(df, time_column)
    time_type = df.select(when.alias("t")).schema["t"].dataType
    pruned = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if rows > pruned and needs_segments(df, names, strategy, max_series_rows):
        # The latest first, missing times last, as below.
        newest = [-seconds_between(when, F.lit("1970-01-01").cast(time_type)), *[col(c) for c in ties]]
        indexed = dense_index(df, [*by, *newest], "__pos")
        heads = indexed.groupBy(*[c.alias(f"__s{i}") for i, c in enumerate(by)]).agg(F.min("__pos").alias("__head"))
        if not names:
            return indexed.where(F.col("__pos") < rows).drop("__pos")
        same = reduce(lambda a, b: a & b, [c.eqNullSafe(F.col(f"__s{i}")) for i, c in enumerate(by)])
        kept = indexed.join(heads, same).where(F.col("__pos") < F.col("__head") + rows)
        return kept.select(*[col(c) for c in df.columns])
    order = [when.desc_nulls_last(), *[col(c).asc_nulls_last() for c in ties]]
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__recent", F.row_number().over(window)).where(F.col("__recent") <= rows).drop("__recent")
