"""Baseline models: least squares in one pass, MLlib's perceptron, Arrow-batched scoring of networks.

Closed-form and MLlib solvers differ from a gradient-descent network's, so fitted models
are comparable in purpose, not in weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from rowloom.errors import ModelError
from rowloom.functions.coerce import col


#: Features of a linear model: its matrix of products goes to the driver.
MAX_FEATURES = 4096
# Rows looked at for a rough centre, around which products are summed.
_PILOT_ROWS = 1000


@dataclass(frozen=True)
class LinearForecaster:
    """One linear model per horizon step."""

    coefficients: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]

    def predict(self, df: DataFrame, features: str = "features", output: str = "prediction") -> DataFrame:
        """Add the forecast as an array: one matrix product per Arrow batch, whatever the horizon."""
        return score_network(df, [Layer(np.array(self.coefficients), np.array(self.intercepts))], features, output)


def _numbers(column: pa.Array, width: int, what: str) -> np.ndarray:
    """A (rows, width) block of an array column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    if column.null_count or flat.null_count or len(flat) != len(column) * width:
        raise ModelError(f"{what} must have {width} values in every row", "linear_bad_input_shape")
    block = flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(column), width)
    if not np.isfinite(block).all():
        raise ModelError(f"{what} has a value that is no finite number", "linear_not_finite")
    return block


def product_sums(data: DataFrame, widths: tuple[int, int], centre: np.ndarray) -> np.ndarray:
    """Sums of products of (1, features - centre, targets - centre), over all rows in one pass.

    Each task multiplies its Arrow batches and sends one matrix, row by row; rows of one
    number are then added.  What is shuffled is tasks times matrix, never a row of data.
    """
    size = 1 + sum(widths)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            block = np.hstack([_numbers(batch.column(k), w, n) for k, (w, n) in enumerate(zip(widths, ("features", "target")))])
            block = np.hstack([np.ones((len(block), 1)), block - centre])
            total += block.T @ block
        bounds = pa.array(np.arange(0, size * size + 1, size, dtype=np.int32))
        lines = pa.ListArray.from_arrays(bounds, pa.array(total.reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), lines], names=["line", "sums"])

    def add(lines: pa.Table) -> pa.Table:
        whole = lines.column("sums").combine_chunks()
        total = whole.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).sum(axis=0)
        return pa.table({"line": lines.column("line").slice(0, 1), "sums": pa.array([total.tolist()], pa.list_(pa.float64()))})

    schema = "line int, sums array<double>"
    added = data.mapInArrow(multiply, schema).groupBy("line").applyInArrow(add, schema)
    out = np.zeros((size, size))
    for row in added.collect():  # one row per column of the matrix, which MAX_FEATURES bounds
        out[row["line"]] = row["sums"]
    return out


def fit_linear(
    df: DataFrame, features: str = "features", target: str = "target", horizon: int = 1, weight_decay: float = 0.0
) -> LinearForecaster:
    """Least squares on ``features`` (array); ``target`` is a number or an array of ``horizon`` steps.

    One pass over the rows gives the products that all steps share, and one solution of
    the normal equations their coefficients.  ``weight_decay`` is added to the variances;
    intercepts carry none.  Columns are scaled before solving; a column that depends on
    others shares its weight with them (the least solution), and a constant one has none.
    """
    is_array = df.schema[target].dataType.typeName() == "array"
    targets = F.slice(col(target), 1, horizon) if is_array else F.array(col(target))
    data = df.select(
        F.transform(col(features), lambda x: x.cast("double")).alias("x"),
        F.transform(targets, lambda y: y.cast("double")).alias("y"),
    )
    pilot = data.limit(_PILOT_ROWS).toArrow()
    if not pilot.num_rows:
        raise ModelError("no rows to fit", "linear_no_rows")
    inputs = len(pilot["x"][0]) if pilot["x"][0].is_valid else 0
    if not 0 < inputs <= MAX_FEATURES:
        raise ModelError(f"{inputs} features; 1 to {MAX_FEATURES} are possible", "linear_bad_input_shape")
    centre = np.hstack([_numbers(pilot[n], w, n).mean(axis=0) for n, w in (("x", inputs), ("y", horizon))])
    sums = product_sums(data, (inputs, horizon), centre)

    n, mean = sums[0, 0], sums[0, 1:] / sums[0, 0]
    spread = sums[1:, 1:] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(spread)[:inputs], 0.0))
    moves = scale > 1e-12 * np.maximum(np.abs(mean + centre)[:inputs], 1e-300)
    weights = np.zeros((inputs, horizon))
    if moves.any():
        s, at = scale[moves], np.flatnonzero(moves)
        inner = spread[np.ix_(at, at)] / np.outer(s, s) + np.diag(weight_decay / s**2)
        cross = spread[at, inputs:] / s[:, None]
        weights[moves] = np.linalg.lstsq(inner, cross, rcond=1e-13)[0] / s[:, None]
    bias = (mean + centre)[inputs:] - (mean + centre)[:inputs] @ weights
    return LinearForecaster(tuple(tuple(map(float, w)) for w in weights.T), tuple(map(float, bias)))


def fit_classifier(
    df: DataFrame,
    input_dim: int,
    num_classes: int,
    hidden: Sequence[int] = (16,),
    features: str = "features",
    target: str = "target",
    max_iter: int = 50,
    seed: int = 42,
):
    """Train MLlib's multilayer perceptron on array features; labels count from 0."""
    if num_classes < 2:
        raise ModelError(f"a classifier needs two classes, not {num_classes}", "tabular_mlp_bad_num_classes")
    data = df.select(
        array_to_vector(F.transform(col(features), lambda x: x.cast("double"))).alias("v"),
        col(target).cast("double").alias("label"),
    )
    layers = [input_dim, *hidden, num_classes]
    trainer = MultilayerPerceptronClassifier(
        featuresCol="v", labelCol="label", layers=layers, maxIter=max_iter, seed=seed
    )
    return trainer.fit(data)


def class_labels(df: DataFrame, target: str, num_classes: int) -> list:
    """The distinct labels in order; a label's place is its class.  ``num_classes`` bounds the list."""
    found = df.select(col(target).alias("label")).where("label is not null").distinct().orderBy("label")
    labels = [r["label"] for r in found.limit(num_classes + 1).collect()]
    if len(labels) > num_classes:
        raise ModelError(f"more than {num_classes} labels", "tabular_mlp_bad_num_classes")
    return labels


def label_index(label: Column, labels: Sequence) -> Column:
    """Class number of a label, NULL for one that is not listed."""
    place = F.array_position(F.array(*[F.lit(v) for v in labels]), label)
    return F.nullif(place, F.lit(0)) - 1


def index_label(index: Column, labels: Sequence) -> Column:
    """The label of a class number."""
    return F.get(F.array(*[F.lit(v) for v in labels]), index.cast("int"))


def classify(model, df: DataFrame, features: str = "features") -> DataFrame:
    """Add ``prediction`` and ``probability`` (array) of a fitted classifier."""
    ready = df.withColumn("v", array_to_vector(F.transform(col(features), lambda x: x.cast("double"))))
    scored = model.setFeaturesCol("v").transform(ready)
    return scored.select(
        *[col(c) for c in df.columns], "prediction", vector_to_array("probability").alias("probability")
    )


@dataclass(frozen=True)
class Layer:
    """Affine layer with optional normalisation at inference, then an activation.

    ``weight`` is (outputs, inputs).  ``norm`` is None, ``"batch"`` (with running
    ``mean``/``variance``) or ``"layer"``; ``gain``/``shift`` apply to both.
    """

    weight: np.ndarray
    bias: np.ndarray
    activation: str | None = None
    norm: str | None = None
    mean: np.ndarray | None = None
    variance: np.ndarray | None = None
    gain: np.ndarray | None = None
    shift: np.ndarray | None = None
    eps: float = 1e-5


def _erf(x: np.ndarray) -> np.ndarray:
    """Error function by its all-positive series; beyond 6 it is 1 in double precision."""
    near = np.clip(x, -6.0, 6.0)
    square = near * near
    term = total = near * (2.0 / math.sqrt(math.pi)) * np.exp(-square)
    for n in range(1, 200):
        term = term * (2.0 * square / (2 * n + 1))
        total = total + term
        if not (np.abs(term) > 1e-17).any():
            break
    return total


ACTIVATIONS = {
    "relu": lambda x: np.maximum(x, 0.0),
    "gelu": lambda x: 0.5 * x * (1.0 + _erf(x / math.sqrt(2.0))),
    "silu": lambda x: x / (1.0 + np.exp(-x)),
    "swish": lambda x: x / (1.0 + np.exp(-x)),
    "leaky_relu": lambda x: np.where(x >= 0, x, 0.01 * x),
    "tanh": np.tanh,
    "elu": lambda x: np.where(x > 0, x, np.expm1(np.minimum(x, 0.0))),
}


def forward(layers: Sequence[Layer], x: np.ndarray) -> np.ndarray:
    """Network output for a (rows, inputs) block."""
    for layer in layers:
        x = x @ layer.weight.T + layer.bias
        if layer.norm == "batch":
            x = (x - layer.mean) / np.sqrt(layer.variance + layer.eps)
        elif layer.norm == "layer":
            x = (x - x.mean(axis=1, keepdims=True)) / np.sqrt(x.var(axis=1, keepdims=True) + layer.eps)
        if layer.norm:
            x = x * (1.0 if layer.gain is None else layer.gain) + (0.0 if layer.shift is None else layer.shift)
        if layer.activation:
            x = ACTIVATIONS[layer.activation.lower()](x)
    return x


def score_network(df: DataFrame, layers: Sequence[Layer], features: str = "features", output: str = "logits") -> DataFrame:
    """Add the network's outputs as an array: one matrix product per Arrow batch.

    Weights travel once per executor as a broadcast variable; other columns pass through
    untouched.
    """
    width = layers[0].weight.shape[1]
    for layer in layers:
        if layer.activation and layer.activation.lower() not in ACTIVATIONS:
            raise ModelError(f"unknown activation {layer.activation!r}", "tabular_mlp_bad_activation")
    # Plain dictionaries: a broadcast value is pickled by reference to its classes.
    shared = df.sparkSession.sparkContext.broadcast([asdict(layer) for layer in layers])
    schema = df.select("*", F.lit(None).cast("array<double>").alias(output)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(features)
            rows = len(column)
            flat = column.flatten()
            if len(flat) != rows * width or column.null_count:
                raise ModelError(f"features must have {width} values", "tabular_mlp_bad_input_shape")
            block = flat.to_numpy(zero_copy_only=False).astype(float).reshape(rows, width)
            result = forward([Layer(**parts) for parts in shared.value], block)
            outputs = result.shape[1]
            offsets = pa.array(np.arange(0, (rows + 1) * outputs, outputs, dtype=np.int32))
            listed = pa.ListArray.from_arrays(offsets, pa.array(result.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, listed], names=[*batch.schema.names, output])

    return df.mapInArrow(run, schema)


def predicted_class(logits: Column) -> Column:
    """Index of the largest logit, the first on ties."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")
