"""Metrics as aggregate expressions over (truth, prediction) columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

Metric = Callable[[Column, Column], Column]


def mse(truth: Column, prediction: Column) -> Column:
    error = prediction - truth
    return F.avg(error * error)


def mae(truth: Column, prediction: Column) -> Column:
    return F.avg(F.abs(prediction - truth))


def rmse(truth: Column, prediction: Column) -> Column:
    return F.sqrt(mse(truth, prediction))


def mape(truth: Column, prediction: Column) -> Column:
    """Mean absolute relative error; rows with a zero truth have none and are left out."""
    return F.avg(F.abs(F.try_divide(prediction - truth, truth)))


def accuracy(truth: Column, prediction: Column) -> Column:
    return F.avg((truth == prediction).cast("int").cast("double"))


def binary_log_loss(truth: Column, logit: Column) -> Column:
    """Mean log loss on logits, in the form that does not overflow."""
    return F.avg(F.greatest(logit, F.lit(0.0)) - logit * truth + F.log1p(F.exp(-F.abs(logit))))


def cross_entropy(label: Column, logits: Column) -> Column:
    """Mean cross-entropy on an array of logits; labels count from 0."""
    top = F.array_max(logits)
    shifted = F.zip_with(logits, F.array_repeat(top, F.size(logits)), lambda z, t: F.exp(z - t))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, e: acc + e)
    return F.avg(F.log(total) + top - F.get(logits, label.cast("int")))


METRICS: dict[str, Metric] = {"mse": mse, "mae": mae, "rmse": rmse, "mape": mape, "accuracy": accuracy}
