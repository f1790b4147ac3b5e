"""Evaluation of forecasts and of training histories."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rowloom.errors import TrainingError, require_columns
from rowloom.functions.coerce import INF, col
from rowloom.functions.metrics import METRICS
from rowloom.operators.ordering import MAX_SERIES_ROWS, SEGMENT_ROWS, dense_index, largest_group, needs_segments
from rowloom.operators.stopping import last_improvement
from rowloom.session import written

#: Rows of a batch that a user's metric may get, and columns of an epoch summary.
MAX_BATCH_ROWS, MAX_NAMES = 1_000_000, 1000


def array_errors(truth: Column, prediction: Column) -> dict[str, Column]:
    """Sums of squared and absolute errors and the length, of two arrays, without exploding them."""
    gaps = F.zip_with(prediction, truth, lambda p, t: p - t)
    total = lambda f: F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + f(g))
    return {"sq": total(lambda g: g * g), "ab": total(F.abs), "n": F.size(truth)}


def horizon_metrics(df: DataFrame, truth: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """MSE, MAE and RMSE over all horizon steps of array columns, optionally per group."""
    parts = array_errors(col(truth), col(prediction))
    summed = df.select(*[col(c) for c in by], *[v.alias(k) for k, v in parts.items()])
    mean = lambda c: F.try_divide(F.sum(c), F.sum("n"))
    return summed.groupBy(*[col(c) for c in by]).agg(
        mean("sq").alias("mse"), mean("ab").alias("mae"), F.sqrt(mean("sq")).alias("rmse")
    )


def score(df: DataFrame, truth: str, prediction: str, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Named metrics over scalar columns, all in one aggregate."""
    unknown = [m for m in metrics if m not in METRICS]
    if unknown:
        raise TrainingError(f"unknown metrics {unknown}", "metric_computation_error", {"known": sorted(METRICS)})
    aggs = [METRICS[m](col(truth), col(prediction)).alias(m) for m in metrics]
    return df.groupBy(*[col(c) for c in by]).agg(*aggs)


def batch_weighted(df: DataFrame, truth: str, prediction: str, metrics: Sequence[str], batch: str = "batch") -> DataFrame:
    """Metrics per batch, averaged with the batch sizes as weights.

    For metrics that are no plain mean (rmse) this differs from the metric over all rows.
    """
    require_columns(df.columns, [batch, truth, prediction], "metric_computation_error", "batch metrics")
    per_batch = df.groupBy(col(batch)).agg(
        F.count("*").alias("__n"), *[METRICS[m](col(truth), col(prediction)).alias(m) for m in metrics]
    )
    weighted = lambda m: F.try_divide(F.sum(col(m) * F.col("__n")), F.sum("__n"))
    return per_batch.agg(*[weighted(m).alias(m) for m in metrics])


def batch_weighted_custom(
    df: DataFrame,
    truth: str,
    prediction: str,
    metric: Callable[[pd.Series, pd.Series], float],
    name: str,
    batch: str = "batch",
) -> DataFrame:
    """As :func:`batch_weighted` with a user's function, run once per batch on Arrow data.

    A batch is one task's data, so larger ones than ``MAX_BATCH_ROWS`` are refused first.
    :func:`rowloom.operators.splits.batches` makes batches of a given size.
    """
    require_columns(df.columns, [batch, truth, prediction], "metric_computation_error", "batch metrics")
    largest = largest_group(df, [batch])
    if largest > MAX_BATCH_ROWS:
        raise TrainingError(
            f"a batch of {largest} rows; {MAX_BATCH_ROWS} are possible", "metric_batch_too_large", {"rows": largest}
        )

    @F.pandas_udf("double")
    def per_batch(y: pd.Series, p: pd.Series) -> float:
        try:
            return float(metric(y, p))
        except Exception as error:
            raise TrainingError(f"metric {name!r} failed: {error}", "metric_computation_error") from error

    @F.pandas_udf("long")
    def rows_of(y: pd.Series) -> int:
        return len(y)

    scored = df.groupBy(col(batch)).agg(
        per_batch(col(truth), col(prediction)).alias("__m"), rows_of(col(truth)).alias("__n")
    )
    return scored.agg(F.try_divide(F.sum(F.col("__m") * F.col("__n")), F.sum("__n")).alias(name))


def require_samples(df: DataFrame) -> None:
    if df.isEmpty():
        raise TrainingError("no samples were seen", "no_samples_seen")


def non_finite_count(df: DataFrame, column: str) -> DataFrame:
    """How many losses are NaN or infinite."""
    value = col(column).cast("double")
    return df.agg(F.count_if(F.isnan(value) | (F.abs(value) == F.lit(INF))).alias("n_non_finite"))


def refuse_non_finite(df: DataFrame, column: str) -> None:
    n = non_finite_count(df, column).first()["n_non_finite"]
    if n:
        raise TrainingError(f"{n} losses in {column!r} are not finite", "non_finite_loss", {"count": n})


def epoch_summary(history: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Long history ``(run_id, phase, epoch, metric, value)`` to one row per epoch.

    Columns are ``{phase}_{metric}``; give ``names`` to save the job that looks them up, of
    which more than ``MAX_NAMES`` are refused.
    """
    named = history.withColumn("name", F.concat_ws("_", "phase", "metric"))
    if not names:
        names = sorted(r["name"] for r in named.select("name").distinct().limit(MAX_NAMES + 1).collect())
    if len(names) > MAX_NAMES:
        raise TrainingError(f"more than {MAX_NAMES} metrics, a column each", "too_many_metrics")
    if not names:
        return named.select("run_id", "epoch").distinct()
    return named.groupBy("run_id", "epoch").pivot("name", list(names)).agg(F.first("value", ignorenulls=True))


def last_epoch(history: DataFrame) -> DataFrame:
    """Value of every metric at its run's last epoch."""
    return history.groupBy("run_id", "metric").agg(
        F.max("epoch").alias("epoch"), F.max_by("value", "epoch").alias("value")
    )


def early_stopping(
    history: DataFrame,
    monitor: str = "val_loss",
    mode: str = "min",
    patience: int = 10,
    min_delta: float = 0.0,
    strategy: str = "auto",
    max_run_epochs: int = MAX_SERIES_ROWS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Replay early stopping over each run of ``(run_id, epoch, metric, value)``.

    Gives ``best_score, bad_epochs, stop_epoch`` (NULL if the run was never stopped) and
    ``stopped``.  An epoch improves when it beats the best score so far by more than
    ``min_delta``; the run stops at the ``patience``-th epoch in a row that does not.

    Only an epoch that beats every earlier one can improve, so a running extreme first
    thins each run to those records.  Where a run is divided and has more than
    ``segment_rows`` records, next improvements are pointers that are followed by doubling
    (:mod:`rowloom.operators.stopping`); otherwise one sorted pass over the records keeps
    only its state.
    """
    sign = {"min": 1.0, "max": -1.0}.get(mode.lower())
    if sign is None:
        raise TrainingError(f"mode must be min or max, not {mode!r}", "early_stopping_bad_mode")
    seen = history.where(F.col("metric") == monitor).select(
        "run_id", "epoch", (F.col("value").cast("double") * F.lit(sign)).alias("v")
    )
    divided = needs_segments(seen, ["run_id"], strategy, max_run_epochs)
    ranked = _ranked_epochs(seen, divided, segment_rows)
    if divided:
        ranked = written(ranked, "ranked-epochs")
    records = ranked.where((F.col("i") == 1) | (F.col("v") < F.col("low"))).select("run_id", "i", "v")
    if divided and largest_group(records, ["run_id"]) > segment_rows:
        ends = last_improvement(records, patience, min_delta, segment_rows)
        folded = ends.withColumn("stop", F.lit(0))
    else:
        folded = _fold_records(records, patience, min_delta)
    runs = ranked.groupBy(F.col("run_id").alias("__run")).agg(F.max("i").alias("n"))
    folded = folded.join(runs, F.col("run_id").eqNullSafe(F.col("__run")))
    stop = F.when(F.col("stop") > 0, F.col("stop")).when(
        F.col("n") >= F.col("at") + patience, F.col("at") + patience
    )
    placed = folded.select(
        "run_id",
        (F.col("best") * F.lit(sign)).alias("best_score"),
        (F.coalesce(stop, F.col("n")) - F.col("at")).alias("bad_epochs"),
        stop.alias("stop_at"),
    )
    epochs = ranked.select(F.col("run_id").alias("__run"), F.col("i").alias("__i"), F.col("epoch").alias("stop_epoch"))
    reached = F.col("run_id").eqNullSafe(F.col("__run")) & (F.col("stop_at") == F.col("__i"))
    return placed.join(epochs, reached, "left").select(
        "run_id", "best_score", "bad_epochs", "stop_epoch", F.col("stop_at").isNotNull().alias("stopped")
    )


def _fold_records(records: DataFrame, patience: int, min_delta: float) -> DataFrame:
    """Best score, place of the last improvement and place of the stop (0 = running) of each run."""
    run_type = records.schema["run_id"].dataType
    schema = T.StructType(
        [
            T.StructField("run_id", run_type),
            T.StructField("best", T.DoubleType()),
            T.StructField("at", T.IntegerType()),
            T.StructField("stop", T.IntegerType()),
        ]
    )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, best, at, stop, kind = None, None, 0, 0, None  # at = 0: no run yet

        def row() -> pa.RecordBatch:
            columns = [pa.array([run], kind), pa.array([best], pa.float64()), pa.array([at], pa.int32()), pa.array([stop], pa.int32())]
            return pa.RecordBatch.from_arrays(columns, names=["run_id", "best", "at", "stop"])

        for batch in batches:
            kind = batch.schema.field("run_id").type
            for r, i, v in zip(*[batch.column(c).to_pylist() for c in ("run_id", "i", "v")]):
                if i == 1:
                    if at:
                        yield row()
                    run, best, at, stop = r, v, 1, 0
                elif not stop and i > at + patience:
                    stop = at + patience
                elif not stop and best is not None and best - v > min_delta:
                    best, at = v, i
        if at:
            yield row()

    return records.repartition("run_id").sortWithinPartitions("run_id", "i").mapInArrow(fold, schema)


def _ranked_epochs(seen: DataFrame, divided: bool, segment_rows: int) -> DataFrame:
    """``i``: place of an epoch in its run; ``low``: smallest value before it.

    NaN never improves: Spark sorts it above every number, as a worse score should be.
    A long run is cut into pieces, and each piece starts from the totals of the earlier ones.
    """
    if not divided:
        order = Window.partitionBy("run_id").orderBy("epoch")
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        return seen.withColumns({"i": F.row_number().over(order), "low": F.min("v").over(earlier)})
    indexed = dense_index(seen, [F.col("run_id"), F.col("epoch")], "__pos")
    pieces = indexed.withColumn("__segment", F.expr(f"__pos div {segment_rows}"))
    totals = pieces.groupBy("run_id", "__segment").agg(F.count("*").alias("rows"), F.min("v").alias("lowest"))
    before = Window.partitionBy("run_id").orderBy("__segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col("run_id").alias("__run"),
        F.col("__segment").alias("__at"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("passed"),
        F.min("lowest").over(before).alias("floor"),
    )
    order = Window.partitionBy("run_id", "__segment").orderBy("__pos")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    same = (F.col("__segment") == F.col("__at")) & F.col("run_id").eqNullSafe(F.col("__run"))
    return (
        pieces.join(carried, same)
        .withColumns({"i": F.row_number().over(order) + F.col("passed"), "low": F.least(F.min("v").over(earlier), "floor")})
        .select("run_id", "epoch", "v", F.col("i").cast("int").alias("i"), "low")
    )


def require_metric(history: DataFrame, monitor: str) -> None:
    """Every run must carry the monitored metric."""
    lacking = (
        history.groupBy("run_id")
        .agg(F.count_if(F.col("metric") == monitor).alias("n"))
        .where("n = 0")
        .limit(1)
        .collect()
    )
    if lacking:
        raise TrainingError(
            f"run {lacking[0]['run_id']!r} has no metric {monitor!r}", "early_stopping_missing_metric"
        )
