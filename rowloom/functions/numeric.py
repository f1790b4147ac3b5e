"""Numeric row expressions on doubles, NULL for anything without a value."""

from __future__ import annotations


from pyspark.sql import Column, functions as F

from rowloom.errors import ModelError
from rowloom.functions.coerce import no_nan


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient; a zero denominator gives NULL."""
    return no_nan(F.try_divide(numerator, denominator))


def power(value: Column, exponent: float) -> Column:
    """``value ** exponent``; NULL where no real result exists."""
    return no_nan(F.pow(value, F.lit(float(exponent))))


def product(left: Column, right: Column) -> Column:
    return no_nan(left * right)


def checked_log1p(value: Column, column: str, lazy: bool) -> Column:
    """``log(1 + value)``; with ``lazy`` a negative value fails the job that meets it."""
    result = F.log1p(value)
    if not lazy:
        return result
    message = f"[feature_log1p_negative_values] negative value in column {column}"
    return F.when(value < 0, F.raise_error(F.lit(message)).cast("double")).otherwise(result)


def shifted_log1p(value: Column, lowest: Column) -> Column:
    """``log1p`` after moving the lowest value just above zero, for skewed columns of any sign."""
    return F.log1p(value - lowest + F.lit(1e-6))


def activation(name: str, x: Column) -> Column:
    """Activation by name.  gelu needs erf, which Spark SQL lacks: the batch scorer has it."""
    key = name.lower()
    if key == "relu":
        return F.greatest(x, F.lit(0.0))
    if key in ("silu", "swish"):
        return x * sigmoid(x)
    if key == "leaky_relu":
        return F.when(x >= 0, x).otherwise(x * F.lit(0.01))
    if key == "tanh":
        return F.tanh(x)
    if key == "elu":
        return F.when(x > 0, x).otherwise(F.expm1(x))
    raise ModelError(f"unknown activation {name!r}", "tabular_mlp_bad_activation", {"activation": name})


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def softmax(logits: Column) -> Column:
    """Softmax over an array of logits, shifted by the maximum for stability.

    Maximum and total are bound once per row; inside the lambdas they would be
    worked out again for every element.
    """
    tops = F.array_repeat(F.array_max(logits), F.size(logits))
    weights = F.zip_with(logits, tops, lambda z, top: F.exp(z - top))
    return F.aggregate(
        weights,
        F.lit(0.0),
        lambda total, w: total + w,
        lambda total: F.transform(weights, lambda w: w / total),
    )


def class_probabilities(logits: Column, task_type: str) -> Column:
    """Probabilities of a classifier's logits: sigmoid for binary, softmax for multiclass."""
    if task_type == "binary":
        return sigmoid(logits)
    if task_type == "multiclass":
        return softmax(logits)
    raise ModelError(
        "probabilities exist for classification only",
        "tabular_mlp_predict_proba_on_regression",
        {"task_type": task_type},
    )


