"""Sinks for histories, decisions and run logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from rowloom.session import small_table
from rowloom.sources import ledger

_PARAMS = "run_id string, key string, value string"
_METRICS = "run_id string, step int, metric string, value double"


#: Commits after which a run log is compacted.
COMPACT_AFTER = 100


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header, one file per partition."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def flatten(nested: Mapping[str, Any], sep: str = ".") -> dict[str, Any]:
    """Nested settings as one level: the path of keys to each leaf, as text."""
    open_, leaves = [((str(k),), v) for k, v in nested.items()], {}
    for path, value in open_:  # grows while it is walked
        if isinstance(value, Mapping):
            open_ += [((*path, str(k)), v) for k, v in value.items()]
        else:
            leaves[sep.join(path)] = value
    return leaves


def params_frame(
    spark: SparkSession, run_id: str, params: Mapping[str, Any], prefix: str = "", flat: bool = False
) -> DataFrame:
    """``(run_id, key, value)``; values that are no plain scalar are kept as their text."""
    data = flatten(params) if flat else params
    rows = [(run_id, f"{prefix}{k}", None if v is None else str(v)) for k, v in data.items()]
    return small_table(spark, rows, _PARAMS)


def log_params(
    spark: SparkSession, path: str, run_id: str, params: Mapping[str, Any], prefix: str = "", flat: bool = False
) -> None:
    """Append a run's parameters to the Parquet table at ``path``; nothing to log writes nothing."""
    if params:
        params_frame(spark, run_id, params, prefix, flat).write.mode("append").parquet(path)


def log_metrics(
    spark: SparkSession, path: str, run_id: str, metrics: Mapping[str, float], step: int | None = None
) -> None:
    """Append one step's metrics to the Parquet table at ``path``: one small file per call.

    For many steps give them to :func:`log_steps` or :func:`log_history` at once.
    """
    if metrics:
        rows = [(run_id, step, name, float(value)) for name, value in metrics.items()]
        small_table(spark, rows, _METRICS).write.mode("append").parquet(path)


def log_steps(spark: SparkSession, path: str, run_id: str, steps: Mapping[int, Mapping[str, float]]) -> None:
    """Append the metrics of many steps in one write."""
    rows = [(run_id, step, name, float(value)) for step, metrics in steps.items() for name, value in metrics.items()]
    if rows:
        small_table(spark, rows, _METRICS).coalesce(1).write.mode("append").parquet(path)


def log_history(history: DataFrame, path: str) -> None:
    """Append a whole long history ``(run_id, step, metric, value)`` computed by Spark."""
    history.select("run_id", "step", "metric", "value").write.mode("append").parquet(path)


def log_committed(rows: DataFrame, path: str, order: Sequence[str], compact_after: int = COMPACT_AFTER) -> None:
    """Append rows to a run log that is a ledger, and merge its small parts from ``compact_after`` on.

    However many calls are made, fewer than ``compact_after`` small parts are left, each as many files
    as its frame had partitions.  Read the log with :func:`rowloom.sources.ledger.read`; files of merged
    parts go with :func:`rowloom.sources.ledger.vacuum`.
    """
    spark = rows.sparkSession
    ledger.append(rows, path)
    if sum(p["rows"] < ledger.FULL_ROWS for p in ledger.listing(spark, path).parts) >= compact_after:
        ledger.compact(spark, path, order)


def commit_metrics(
    spark: SparkSession,
    path: str,
    run_id: str,
    metrics: Mapping[str, float],
    step: int | None = None,
    compact_after: int = COMPACT_AFTER,
) -> None:
    """As :func:`log_metrics`, into a run log that stays compact."""
    if metrics:
        rows = [(run_id, step, name, float(value)) for name, value in metrics.items()]
        table = small_table(spark, rows, _METRICS).coalesce(1)
        log_committed(table, path, ["run_id", "metric", "step"], compact_after)
