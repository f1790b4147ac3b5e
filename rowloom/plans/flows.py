"""Whole flows: from a table to a trained and scored baseline."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, functions as F

from rowloom.errors import require_columns
from rowloom.functions.coerce import col
from rowloom.operators.evaluate import horizon_metrics
from rowloom.operators.models import (
    LinearForecaster,
    class_labels,
    classify,
    fit_classifier,
    fit_linear,
    index_label,
    label_index,
)
from rowloom.operators.preprocess import standardize
from rowloom.operators.splits import VALIDATION, TRAIN, chronological_split, random_split, stratified_split
from rowloom.operators.tables import assemble, features_and_target, infer_problem, numeric_columns
from rowloom.operators.windows import choose_value_columns, flatten_windows, sliding_windows
from rowloom.session import written


@dataclass(frozen=True)
class Trained:
    """A fitted model and its predictions on the validation rows."""

    model: Any
    predictions: DataFrame
    problem: str


def forecast_windows(
    df: DataFrame,
    time_column: str,
    target_column: str,
    input_window: int,
    prediction_horizon: int = 1,
    step_size: int = 1,
    value_columns: Sequence[str] | None = None,
    series: str | Sequence[str] | None = None,
    fraction: float = 0.2,
    tie_breakers: Sequence[str] | None = None,
    **window_options: Any,
) -> DataFrame:
    """Chronological split, then windows inside each part: none crosses the boundary."""
    require_columns(df.columns, [time_column], "ts_missing_datetime_column", "forecast")
    names = [] if series is None else [series] if isinstance(series, str) else list(series)
    values = choose_value_columns(df, value_columns, [target_column], without=[time_column, *names])
    used = list(dict.fromkeys([*names, time_column, *(tie_breakers or []), *values, target_column]))
    parts = chronological_split(df.select(*[col(c) for c in used]), time_column, fraction, tie_breakers)
    return sliding_windows(
        parts,
        input_window,
        time_column,
        prediction_horizon,
        step_size,
        values,
        target_column,
        ["split", *names],
        tie_breakers,
        **window_options,
    )


def train_forecaster(windows: DataFrame, horizon: int, weight_decay: float = 0.0) -> Trained:
    """One linear model per horizon step on flattened windows, scored on the validation part."""
    flat = written(flatten_windows(windows), "windows")
    model: LinearForecaster = fit_linear(
        flat.where(F.col("split") == TRAIN), "X", "y", horizon, weight_decay
    )
    return Trained(model, model.predict(flat.where(F.col("split") == VALIDATION), "X"), "regression")


def forecast_metrics(trained: Trained) -> DataFrame:
    return horizon_metrics(trained.predictions, "y", "prediction")


def train_tabular(
    df: DataFrame,
    target: str,
    id_column: str | None = None,
    fraction: float = 0.2,
    seed: int = 42,
    hidden: Sequence[int] = (16,),
    max_iter: int = 50,
) -> Trained:
    """Numeric features, problem type, split, scaling on training rows, model, predictions."""
    names, _ = features_and_target(df, target, id_column)
    numeric = [c for c in numeric_columns(df) if c in names]
    found = infer_problem(df, target).first()
    is_class = found["problem_type"] == "classification"
    key = id_column
    parts = (
        stratified_split(df, target, fraction, seed, key) if is_class else random_split(df, fraction, seed, key)
    )
    train = parts.where(F.col("split") == TRAIN)
    scaled = standardize(parts, numeric, fit_on=train)
    kept = ["split"] + ([id_column] if id_column else [])
    matrix = assemble(scaled, target, feature_columns=numeric, keep=kept)
    fit_rows, held = matrix.where(F.col("split") == TRAIN), matrix.where(F.col("split") == VALIDATION)
    if is_class:
        labels = class_labels(df, target, int(found["num_classes"]))
        indexed = fit_rows.withColumn("target", label_index(col("target"), labels))
        model = fit_classifier(indexed, len(numeric), len(labels), hidden, max_iter=max_iter, seed=seed)
        scored = classify(model, held).withColumn("prediction", index_label(F.col("prediction"), labels))
        return Trained(model, scored, "classification")
    forecaster = fit_linear(fit_rows)
    scored = forecaster.predict(held).withColumn("prediction", F.col("prediction")[0])
    return Trained(forecaster, scored, "regression")
