"""Sliding input/target windows over ordered series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.errors import DataError, require_columns
from rowloom.functions.coerce import col, moment, number, target_column as target_value
from rowloom.operators.ordering import (
    MAX_SERIES_ROWS,
    SEGMENT_ROWS,
    as_list,
    ascending,
    cut,
    dense_index,
    needs_segments,
    segment_length,
    tie_columns,
)


def check_window(input_window: int, prediction_horizon: int, step_size: int) -> None:
    for value, code in (
        (input_window, "ts_invalid_input_window"),
        (prediction_horizon, "ts_invalid_prediction_horizon"),
        (step_size, "ts_invalid_step_size"),
    ):
        if value <= 0:
            raise DataError(f"{code[11:]} must be positive, not {value}", code)


def choose_value_columns(
    df: DataFrame,
    value_columns: Sequence[str] | None,
    target: Sequence[str] = (),
    without: Sequence[str] = (),
) -> list[str]:
    """The listed columns, or all but the target and the columns in ``without``."""
    require_columns(df.columns, target, "ts_target_missing", "window target")
    if value_columns is not None:
        require_columns(df.columns, value_columns, "ts_value_columns_missing", "window values")
        chosen = list(value_columns)
    else:
        chosen = [c for c in df.columns if c not in target and c not in without]
    if not chosen:
        raise DataError("no value columns remain", "ts_no_value_columns", {"target": list(target)})
    return chosen


def sliding_windows(
    df: DataFrame,
    input_window: int,
    order_by: str | Sequence[str],
    prediction_horizon: int = 1,
    step_size: int = 1,
    value_columns: Sequence[str] | None = None,
    target_column: str | Sequence[str] | None = None,
    series: str | Sequence[str] | None = None,
    tie_breakers: str | Sequence[str] | None = None,
    dropna: bool = True,
    feature_type: str = "float",
    target_type: str | None = None,
    on_short: str = "skip",
    strategy: str = "auto",
    max_series_rows: int = MAX_SERIES_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """One row per window: series columns, ``start``, ``X`` (W x D_in) and ``y`` (H x D_out).

    Windows start at rows 0, step, 2*step, ... of their series and lie fully inside
    it; a series shorter than W+H gives none (``on_short="error"`` raises instead).
    Only the used columns reach the shuffle.  Each series is one window task, or,
    beyond ``max_series_rows``, many: pieces overlap by the W+H-1 rows that a window
    starting at the end of a piece reaches into the next.
    """
    check_window(input_window, prediction_horizon, step_size)
    source = _prepared(df, order_by, value_columns, target_column, series, tie_breakers, dropna, feature_type, target_type)
    names, keys = as_list(series), [c for c in source.columns if c.startswith("__key")]
    span = input_window + prediction_horizon
    if on_short == "error":
        _refuse_short(source, names, span)

    content = ["x", "y"] if "y" in source.columns else ["x"]
    group = [col(n) for n in names]
    if needs_segments(source, names, strategy, max_series_rows):
        rows = _numbered_segments(source, names, keys, span, segment_length(segment_rows, after=span - 1))
        group = [F.col("__segment"), *group]
    else:
        order = Window.partitionBy(*group).orderBy(*ascending([F.col(k) for k in keys]))
        rows = source.withColumns(
            {"start": (F.row_number().over(order) - 1).cast("bigint"), "__home": F.lit(True)}
        )

    found = _framed(rows, group, content, span, step_size)
    picked = found.where((F.col("start") % step_size == 0) & F.col("__home") & (F.size("w") == span))
    result = [*[col(n) for n in names], F.col("start")]
    result.append(F.transform(F.slice("w", 1, input_window), lambda r: r["x"]).alias("X"))
    if "y" in content:
        result.append(F.transform(F.slice("w", input_window + 1, prediction_horizon), lambda r: r["y"]).alias("y"))
    return picked.select(*result)


def _prepared(
    df: DataFrame, order_by, value_columns, target, series, tie_breakers, dropna, feature_type, target_type
) -> DataFrame:
    """Series columns, order keys and the numbers as arrays; nothing else is carried along."""
    names, order, targets = as_list(series), as_list(order_by), as_list(target)
    if not order:
        raise DataError("windows need an order", "ts_sort_by_missing")
    require_columns(df.columns, order, "ts_sort_by_missing", "window order")
    require_columns(df.columns, names, "ts_missing_group_column", "window series")
    values = choose_value_columns(df, value_columns, targets, without=[*order, *names])
    ties = tie_columns(df, [*order, *names], tie_breakers)

    first = col(order[0])
    if df.schema[order[0]].dataType.typeName() in ("string", "date"):
        first = moment(df, order[0], code="ts_sort_error")
    keys = [first, *[col(c) for c in [*order[1:], *ties]]]
    xs = [number(df, c).cast(feature_type) for c in values]
    ys = [target_value(df, c) if target_type is None else number(df, c).cast(target_type) for c in targets]

    kept = df
    for name in names:
        kept = kept.where(col(name).isNotNull())
    if dropna:
        for c in dict.fromkeys([*values, *targets]):
            kept = kept.where(number(df, c).isNotNull())
    columns = [*[col(n) for n in names], *[k.alias(f"__key{i}") for i, k in enumerate(keys)]]
    columns.append(F.array(*xs).alias("x"))
    if targets:
        columns.append(F.array(*ys).alias("y"))
    return kept.select(*columns)


def _numbered_segments(
    source: DataFrame, names: Sequence[str], keys: Sequence[str], span: int, length: int
) -> DataFrame:
    """Segments with a halo behind them, and ``start`` counted from the head of each series."""
    indexed = dense_index(source, [*[col(n) for n in names], *[F.col(k) for k in keys]], "__pos")
    spans = indexed.groupBy(*[col(n) for n in names]).agg(F.min("__pos").alias("lo"), F.max("__pos").alias("hi"))
    # A piece opens inside at most one series, so this has at most one row per piece.
    opened = spans.where(F.expr(f"hi div {length} > lo div {length}")).select(
        F.col("lo").alias("__lo"),
        F.explode(F.expr(f"sequence(lo div {length} + 1, hi div {length})")).alias("__segment"),
    )
    rows = cut(indexed, 0, span - 1, length).join(opened, "__segment", "left")
    piece = Window.partitionBy("__segment", *[col(n) for n in names])
    first_here = F.min("__pos").over(piece)
    head = F.when((first_here == F.col("__segment") * length) & F.col("__lo").isNotNull(), F.col("__lo"))
    return rows.withColumn("start", F.col("__pos") - F.coalesce(head, first_here))


def _framed(
    rows: DataFrame, group: Sequence[Column], content: Sequence[str], span: int, step: int
) -> DataFrame:
    """``w``: the ``span`` rows from each start on.

    With a step, rows are first packed into blocks of ``step``: one frame per block
    is built instead of one per row, so the work follows the number of windows.  The
    blocks lie within the same partitioning, so packing adds no shuffle.
    """
    ahead = lambda order, n: Window.partitionBy(*group).orderBy(order).rowsBetween(0, n - 1)
    if step == 1:
        return rows.withColumn("w", F.collect_list(F.struct(*content)).over(ahead("start", span)))
    block = F.expr(f"start div {step}").alias("__block")
    packed = rows.groupBy(*group, block).agg(
        F.array_sort(F.collect_list(F.struct("start", "__home", *content))).alias("__rows")
    )
    frame = ahead("__block", -(-span // step))
    return packed.select(
        *group,
        F.col("__rows")[0]["start"].alias("start"),
        F.col("__rows")[0]["__home"].alias("__home"),
        F.slice(F.flatten(F.collect_list("__rows").over(frame)), 1, span).alias("w"),
    )


def _refuse_short(source: DataFrame, names: Sequence[str], span: int) -> None:
    sizes = source.groupBy(*[col(n) for n in names]).count()
    short = sizes.where(F.col("count") < span).limit(1).collect()
    if short:
        raise DataError(
            f"a series has {short[0]['count']} rows, a window needs {span}", "ts_series_too_short", short[0].asDict()
        )


def window_count(total: Column, input_window: int, prediction_horizon: int, step_size: int) -> Column:
    """Number of windows in a series of ``total`` rows."""
    room = total - F.lit(input_window + prediction_horizon)
    return F.when(room < 0, F.lit(0)).otherwise(F.floor(room / F.lit(step_size)) + 1).cast("bigint")


def series_lengths(df: DataFrame, series: str | Sequence[str] | None, used: Sequence[str] = ()) -> DataFrame:
    """``n_points`` per series, of rows with a value in every used column."""
    names = as_list(series)
    kept = df
    for name in names:
        kept = kept.where(col(name).isNotNull())
    for c in used:
        kept = kept.where(number(df, c).isNotNull())
    return kept.groupBy(*[col(n) for n in names]).agg(F.count("*").alias("n_points"))


def window_metadata(
    df: DataFrame,
    input_window: int,
    value_columns: Sequence[str],
    target_column: str | Sequence[str] | None = None,
    series: str | Sequence[str] | None = None,
    prediction_horizon: int = 1,
    step_size: int = 1,
) -> DataFrame:
    """Counts and names of a window set in one row, from series lengths: no window is built."""
    check_window(input_window, prediction_horizon, step_size)
    targets = as_list(target_column)
    names = lambda cs: F.array(*[F.lit(c) for c in cs]).cast("array<string>")
    lengths = series_lengths(df, series, [*value_columns, *targets])
    return lengths.agg(
        F.coalesce(F.sum(window_count(F.col("n_points"), input_window, prediction_horizon, step_size)), F.lit(0)).alias(
            "num_samples"
        ),
        F.coalesce(F.sum("n_points"), F.lit(0)).alias("total_length"),
    ).select(
        "num_samples",
        F.lit(len(value_columns)).alias("num_features"),
        F.lit(len(targets)).alias("num_targets"),
        F.lit(input_window).alias("input_window"),
        F.lit(prediction_horizon).alias("prediction_horizon"),
        F.lit(step_size).alias("step_size"),
        F.lit(bool(targets)).alias("has_targets"),
        "total_length",
        names(value_columns).alias("value_column_names"),
        names(targets).alias("target_column_names"),
    )


def window_design(
    df: DataFrame,
    input_window: int,
    prediction_horizon: int = 1,
    n_features: int = 1,
    n_targets: int = 1,
    series: str | Sequence[str] | None = None,
    step_size: int = 1,
) -> DataFrame:
    """Compare (W, H), (2W, H) and (W, 2H): windows each would give, and their shapes.

    A closed form on series lengths; shapes are NULL where no window fits.
    """
    check_window(input_window, prediction_horizon, step_size)
    candidates = [
        (input_window, prediction_horizon),
        (2 * input_window, prediction_horizon),
        (input_window, 2 * prediction_horizon),
    ]
    sums = series_lengths(df, series).agg(
        *[
            F.coalesce(F.sum(window_count(F.col("n_points"), w, h, step_size)), F.lit(0)).alias(f"n{i}")
            for i, (w, h) in enumerate(candidates)
        ]
    )
    rows = []
    for i, (w, h) in enumerate(candidates):
        n = F.col(f"n{i}")
        shape = lambda a, b, n=n: F.when(n > 0, F.array(F.lit(a), F.lit(b)))
        rows.append(
            F.struct(
                F.lit(i).alias("candidate"),
                F.lit(w).alias("input_window"),
                F.lit(h).alias("prediction_horizon"),
                n.alias("n_sequences"),
                shape(w, n_features).alias("x_shape"),
                shape(h, n_targets).alias("y_shape"),
            )
        )
    return sums.select(F.inline(F.array(*rows)))


def short_series(
    df: DataFrame, series: str | Sequence[str], input_window: int, prediction_horizon: int = 1
) -> DataFrame:
    """Series that cannot hold one window."""
    return series_lengths(df, series).where(F.col("n_points") < input_window + prediction_horizon)


def window_choice(input_window: int, prediction_horizon: int, step_size: int = 1) -> dict[str, int]:
    """The decision to hand on; write it with :func:`rowloom.sources.sinks.write_json`."""
    check_window(input_window, prediction_horizon, step_size)
    return {"input_window": input_window, "prediction_horizon": prediction_horizon, "step_size": step_size}


def flatten_windows(windows: DataFrame) -> DataFrame:
    """``X`` and ``y`` as flat arrays for feed-forward models."""
    flat = {c: F.flatten(col(c)) for c in ("X", "y") if c in windows.columns}
    return windows.withColumns(flat)


def first_step(windows: DataFrame, prediction: str, samples: int | None = None) -> DataFrame:
    """Truth and forecast of the first horizon step, optionally the first samples by start."""
    out = windows.select(
        "start", F.col("y")[0][0].alias("truth"), col(prediction)[0].alias("forecast")
    )
    return out if samples is None else out.orderBy("start", "truth", "forecast").limit(samples)
