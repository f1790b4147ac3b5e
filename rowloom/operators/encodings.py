"""Encodings fitted on training rows and applied anywhere: frequency, bins, target means.

A fitted encoding of a category column is a written table with a row per category, joined
without a hint: small ones are broadcast by Spark, long ones shuffled.  Bin edges are a
short list and travel in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rowloom.errors import require_columns
from rowloom.functions.coerce import col, number, present
from rowloom.operators.quantile import quantiles
from rowloom.session import written


@dataclass(frozen=True)
class CategoryEncoding:
    """``table`` holds (value, code); values that it lacks get ``default``."""

    column: str
    table: DataFrame
    default: float
    suffix: str

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``{column}__{suffix}``; missing values are a category of their own."""
        require_columns(df.columns, [self.column], "missing_columns_for_encoding", "encoding input")
        table = self.table.select(col("value").alias("__value"), col("code").alias("__code"), F.lit(True).alias("__known"))
        joined = df.withColumn("__key", _key(df, self.column)).join(table, F.col("__key") == F.col("__value"), "left")
        code = F.when(F.col("__known"), F.col("__code")).otherwise(F.lit(self.default))
        return joined.select(*[col(c) for c in df.columns], code.alias(f"{self.column}__{self.suffix}"))


def _key(df: DataFrame, column: str) -> Column:
    """Equal for equal values, missing included."""
    value = present(df, column)
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), value.cast("string")))


def fit_frequency(df: DataFrame, column: str) -> CategoryEncoding:
    """Share of the training rows that hold a category; unseen ones have 0."""
    require_columns(df.columns, [column], "missing_columns_for_encoding", "frequency encoding")
    counts = written(df.groupBy(_key(df, column).alias("value")).agg(F.count("*").alias("n")), "frequencies")
    rows = counts.agg(F.sum("n")).first()[0] or 1
    return CategoryEncoding(column, counts.select("value", (F.col("n") / F.lit(rows)).alias("code")), 0.0, "frequency")


def fit_target_mean(df: DataFrame, column: str, target: str, smoothing: float = 10.0) -> CategoryEncoding:
    """Mean target per category, drawn to the overall mean as if ``smoothing`` rows had it.

    Fit on training rows only: a row that is both fitted and transformed sees its own target.
    """
    require_columns(df.columns, [column, target], "missing_columns_for_encoding", "target encoding")
    y = number(df, target)
    sums = df.groupBy(_key(df, column).alias("value")).agg(F.count(y).alias("n"), F.coalesce(F.sum(y), F.lit(0.0)).alias("s"))
    sums = written(sums, "target-means")
    n, s = sums.agg(F.sum("n"), F.sum("s")).first()
    overall = s / n if n else 0.0
    code = (F.col("s") + smoothing * overall) / F.nullif(F.col("n") + F.lit(smoothing), F.lit(0.0))
    return CategoryEncoding(column, sums.select("value", F.coalesce(code, F.lit(overall)).alias("code")), overall, "target_mean")


@dataclass(frozen=True)
class Bins:
    """Inner edges in order: a value's bin is the number of edges at or below it."""

    column: str
    edges: tuple[float, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        require_columns(df.columns, [self.column], "missing_columns_for_encoding", "bin input")
        x = number(df, self.column)
        place = F.size(F.filter(F.array(*[F.lit(e) for e in self.edges]).cast("array<double>"), lambda e: e <= x))
        return df.withColumn(f"{self.column}__bin", F.when(x.isNotNull(), place))


def fit_bins(df: DataFrame, column: str, bins: int, how: str = "quantile") -> Bins:
    """Edges at quantiles (exact), or of equal width between the least and greatest finite value."""
    require_columns(df.columns, [column], "missing_columns_for_encoding", "bins")
    if how == "quantile":
        found: Sequence[float | None] = quantiles(df, [column], [i / bins for i in range(1, bins)])[column]
        edges = [e for e in found if e is not None]
    elif how == "width":
        x = number(df, column)
        finite = F.when(F.abs(x) < F.lit(float("inf")), x)
        low, high = df.agg(F.min(finite), F.max(finite)).first()
        edges = [] if low is None else [low + (high - low) * i / bins for i in range(1, bins)]
    else:
        raise ValueError(f"unknown way to choose bins {how!r}")
    return Bins(column, tuple(dict.fromkeys(float(e) for e in edges)))
