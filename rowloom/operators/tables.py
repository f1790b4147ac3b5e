"""Column selection, roles, contracts, matrix assembly and row concatenation."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rowloom.errors import DataError, require_columns
from rowloom.functions.coerce import (
    col,
    is_fraction,
    is_numeric,
    is_temporal,
    number,
    present,
    target_column as target_value,
    type_of,
)
from rowloom.operators.ordering import as_list, ascending
from rowloom.session import small_table


def features_and_target(df: DataFrame, target: str, id_column: str | None = None) -> tuple[list[str], str]:
    """Feature names once target and id are set apart."""
    require_columns(df.columns, [target], "missing_target_column", "target")
    if id_column is not None:
        require_columns(df.columns, [id_column], "missing_id_column", "id")
    return [c for c in df.columns if c not in (target, id_column)], target


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def datetime_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_temporal(f.dataType)]


def select_numeric(df: DataFrame) -> DataFrame:
    """Numeric columns only; an error when there is none."""
    names = numeric_columns(df)
    if not names:
        raise DataError("no numeric columns", "no_numeric_features", {"columns": df.columns})
    return df.select(*[col(c) for c in names])


def select_categorical(df: DataFrame) -> DataFrame:
    return df.select(*[col(c) for c in categorical_columns(df)])


def select_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Columns whose name contains a match of ``pattern``."""
    return df.select(*[col(c) for c in df.columns if re.search(pattern, c)])


def infer_roles(
    df: DataFrame,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    remainder: str = "drop",
) -> tuple[list[str], list[str]]:
    """(numeric, categorical) names: given lists or by type; a column in both is numeric."""
    require_columns(df.columns, numeric or (), "missing_numeric_features", "numeric features")
    require_columns(df.columns, categorical or (), "missing_categorical_features", "categorical features")
    chosen = [c for c in (numeric_columns(df) if numeric is None else numeric) if c not in drop]
    labels = [
        c
        for c in (categorical_columns(df) if categorical is None else categorical)
        if c not in drop and c not in chosen
    ]
    if not chosen and not labels and remainder == "drop":
        raise DataError(
            "no features remain", "no_features_after_inference", {"columns": df.columns, "drop": list(drop)}
        )
    return chosen, labels


def roles_table(
    df: DataFrame, target: str | None = None, derived_suffixes: Sequence[str] = ("_log1p", "_year", "_month", "_dow", "_hour")
) -> DataFrame:
    """``(role, column)``: candidate numeric, categorical, datetime and derived columns."""
    derived = [c for c in df.columns if c.endswith(tuple(derived_suffixes))]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    roles = {
        "numeric": [c for c in numeric_columns(df) if c != target and c not in derived],
        "categorical": [c for c in text if c != target],
        "datetime": datetime_columns(df),
        "derived": derived,
    }
    rows = [(role, name) for role, names in roles.items() for name in names]
    return small_table(df.sparkSession, rows, "role string, column string")


def audit_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``(column, present)`` for every column a configuration names."""
    rows = [(c, c in df.columns) for c in expected]
    return small_table(df.sparkSession, rows, "column string, present boolean")


def drop_missing(df: DataFrame, columns: Sequence[str], dropped_as: str | None = None):
    """Rows with a value in every column.

    With ``dropped_as`` also returns an observation that holds the number of dropped
    rows once an action has run: the count rides on that action, no job of its own.
    """
    require_columns(df.columns, columns, "ts_value_columns_missing", "drop missing")
    whole = reduce(lambda a, b: a & b, [present(df, c).isNotNull() for c in columns])
    if dropped_as is None:
        return df.where(whole)
    from pyspark.sql import Observation

    seen = Observation(dropped_as)
    return df.observe(seen, F.count_if(~whole).alias("dropped")).where(whole), seen


def with_row_count(df: DataFrame, name: str):
    """``df`` and an observation of its row count, filled by the next action."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def assemble(
    df: DataFrame,
    target_column: str | Sequence[str] | None = None,
    drop_columns: Sequence[str] = (),
    feature_columns: Sequence[str] | None = None,
    feature_type: str = "float",
    keep: Sequence[str] = (),
    refuse_empty: bool = False,
) -> DataFrame:
    """``features`` array and ``target``: the matrix form of a table."""
    targets = as_list(target_column)
    if len(targets) > 1:
        raise DataError(f"one target column, not {targets}", "tabular_targets_multi_column")
    require_columns(df.columns, targets, "tabular_target_missing", "matrix target")
    if feature_columns is not None:
        require_columns(df.columns, feature_columns, "tabular_feature_names_mismatch", "matrix features")
        names = list(feature_columns)
    else:
        names = [c for c in df.columns if c not in targets and c not in drop_columns and c not in keep]
    if not names:
        raise DataError("no feature columns remain", "tabular_no_features_after_drop", {"columns": df.columns})
    if refuse_empty and df.isEmpty():
        raise DataError("the table has no rows", "tabular_df_empty")
    out = [*[col(c) for c in keep], F.array(*[number(df, c).cast(feature_type) for c in names]).alias("features")]
    if targets:
        out.append(target_value(df, targets[0]).alias("target"))
    return df.select(*out)


def matrix_metadata(df: DataFrame, feature_columns: Sequence[str], target_column: str | None = None) -> DataFrame:
    require_columns(df.columns, feature_columns, "tabular_feature_names_mismatch", "matrix features")
    return df.agg(F.count("*").alias("num_samples")).select(
        "num_samples",
        F.lit(len(feature_columns)).alias("num_features"),
        F.array(*[F.lit(c) for c in feature_columns]).alias("feature_names"),
        F.lit(target_column is not None).alias("has_targets"),
        F.lit(target_column).cast("string").alias("target_name"),
    )


def flatten_columns(df: DataFrame, sep: str = ".", prefix: str = "") -> DataFrame:
    """Nested structs as flat columns named by their path."""

    def walk(schema: T.StructType, path: tuple[str, ...]) -> list:
        out = []
        for f in schema:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType, here)
            else:
                value = col(here[0])
                for step in here[1:]:
                    value = value.getField(step)
                out.append(value.alias(prefix + sep.join(here)))
        return out

    return df.select(*walk(df.schema, ()))


def concatenate(parts: Sequence[DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """All rows of all parts, columns matched by name; nothing gives an empty table."""
    if not parts:
        return (spark or SparkSession.getActiveSession()).createDataFrame([], T.StructType([]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def sorted_by(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending by the columns, missing values last."""
    require_columns(df.columns, columns, "ts_sort_error", "sort")
    return df.orderBy(*ascending([col(c) for c in columns]))


def first_series(df: DataFrame, series: str, k: int) -> DataFrame:
    """All rows of the first ``k`` series by name: a top-k of the distinct names, then a semi-join."""
    names = df.select(col(series)).where(col(series).isNotNull()).distinct().orderBy(col(series)).limit(k)
    return df.join(F.broadcast(names), series, "left_semi") if k <= 10_000 else df.join(names, series, "left_semi")


def infer_problem(
    df: DataFrame, target: str, requested: str = "auto", num_classes: int | None = None, max_classes: int = 20
) -> DataFrame:
    """``(problem_type, num_classes)``: text, boolean and few-valued integer targets are classes."""
    require_columns(df.columns, [target], "missing_target_column", "problem type")
    if requested not in ("auto", "classification", "regression"):
        raise ValueError(f"unknown problem type {requested!r}")
    dtype = type_of(df, target)
    distinct = F.count_distinct(present(df, target))
    counted = df.agg(distinct.cast("bigint").alias("k"))
    if requested != "auto":
        kind = F.lit(requested)
    elif isinstance(dtype, (T.StringType, T.BooleanType)):
        kind = F.lit("classification")
    elif is_fraction(dtype) or not isinstance(dtype, T.IntegralType):
        kind = F.lit("regression")
    else:
        kind = F.when(F.col("k") <= max_classes, "classification").otherwise("regression")
    classes = F.lit(num_classes).cast("bigint") if num_classes is not None else F.col("k")
    return counted.select(
        kind.alias("problem_type"), F.when(kind == "classification", classes).alias("num_classes")
    )
