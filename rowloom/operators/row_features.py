"""Declarative row features: calendar, log1p, ratio, power and interaction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from rowloom.errors import DataError, require_columns
from rowloom.functions import numeric
from rowloom.functions.calendar import calendar_parts, short_date_parts
from rowloom.functions.coerce import col, invalid_count, is_temporal, moment, number, parsed_time, present, type_of


@dataclass(frozen=True)
class RowFeatures:
    """What to derive from each row.  Later kinds may read the output of earlier ones."""

    datetime_columns: Sequence[str] = ()
    log1p_columns: Sequence[str] = ()
    ratio_features: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    power_features: Mapping[str, tuple[str, float]] = field(default_factory=dict)
    interaction_features: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    drop_original_datetime: bool = False
    datetime_format: str | None = None


class ColumnStages:
    """Collects new columns and applies them in as few projections as the order allows.

    A projection is closed only when a feature reads, or writes again, a column of
    the open one.
    """

    def __init__(self, df: DataFrame) -> None:
        self._df = df
        self._open: dict[str, Column] = {}

    @property
    def df(self) -> DataFrame:
        if self._open:
            self._df = self._df.withColumns(self._open)
            self._open = {}
        return self._df

    def reading(self, *names: str) -> DataFrame:
        """The frame in which ``names`` are up to date."""
        return self.df if any(n in self._open for n in names) else self._df

    def names(self) -> list[str]:
        return [*self._df.columns, *(n for n in self._open if n not in self._df.columns)]

    def add(self, new: Mapping[str, Column]) -> None:
        if any(name in self._open for name in new):
            _ = self.df
        self._open.update(new)

    def drop(self, *names: str) -> None:
        self._df = self.df.drop(*names)


def build_row_features(df: DataFrame, spec: RowFeatures, validate: str = "eager") -> DataFrame:
    """Apply ``spec``: one lazy projection chain, usable on batch and streaming frames.

    ``validate`` governs the value checks of log1p: ``eager`` runs one aggregate over
    all its columns now, ``lazy`` fails inside the job (the choice for streams),
    ``off`` skips them.  Column checks happen at plan time in every mode.
    """
    if validate not in ("eager", "lazy", "off"):
        raise ValueError(f"validate must be eager, lazy or off, not {validate!r}")
    stages = ColumnStages(df)

    require_columns(stages.names(), spec.datetime_columns, "feature_missing_datetime_columns", "calendar features")
    for name in spec.datetime_columns:
        stages.add(calendar_parts(moment(stages.reading(name), name, spec.datetime_format), name))
    if spec.drop_original_datetime and spec.datetime_columns:
        stages.drop(*spec.datetime_columns)

    if spec.log1p_columns:
        require_columns(stages.names(), spec.log1p_columns, "feature_missing_log1p_columns", "log1p features")
        source = stages.reading(*spec.log1p_columns)
        if validate == "eager":
            check_log1p(source, spec.log1p_columns)
        for name in spec.log1p_columns:
            stages.add({f"{name}__log1p": _log1p(source, name, validate == "lazy")})

    for new, (num, den) in spec.ratio_features.items():
        require_columns(stages.names(), (num, den), "feature_missing_ratio_columns", f"ratio {new}")
        source = stages.reading(num, den)
        stages.add({new: numeric.ratio(number(source, num), number(source, den))})

    for new, (base, exponent) in spec.power_features.items():
        require_columns(stages.names(), (base,), "feature_missing_power_source", f"power {new}")
        stages.add({new: numeric.power(number(stages.reading(base), base), exponent)})

    for new, (left, right) in spec.interaction_features.items():
        require_columns(
            stages.names(), (left, right), "feature_missing_interaction_columns", f"interaction {new}"
        )
        source = stages.reading(left, right)
        stages.add({new: numeric.product(number(source, left), number(source, right))})

    return stages.df


def _log1p(df: DataFrame, name: str, lazy: bool) -> Column:
    value = number(df, name)
    result = numeric.checked_log1p(value, name, lazy)
    if not lazy:
        return result
    message = f"[feature_log1p_non_numeric] value that is no number in column {name}"
    lost = present(df, name).isNotNull() & value.isNull()
    return F.when(lost, F.raise_error(F.lit(message)).cast("double")).otherwise(result)


def check_log1p(df: DataFrame, columns: Sequence[str]) -> None:
    """All value checks of the log1p columns in one aggregate."""
    checks = []
    for i, name in enumerate(columns):
        value = number(df, name)
        checks.append(invalid_count(df, name, value).alias(f"bad_{i}"))
        checks.append(F.count_if(value < 0).alias(f"neg_{i}"))
    seen = df.agg(*checks).first()
    for i, name in enumerate(columns):
        if seen[f"bad_{i}"]:
            raise DataError(
                f"column {name!r} holds {seen[f'bad_{i}']} values that are no numbers",
                "feature_log1p_non_numeric",
                {"column": name, "count": seen[f"bad_{i}"]},
            )
        if seen[f"neg_{i}"]:
            raise DataError(
                f"column {name!r} holds {seen[f'neg_{i}']} negative values",
                "feature_log1p_negative_values",
                {"column": name, "count": seen[f"neg_{i}"]},
            )


def add_date_parts(df: DataFrame, date_columns: Sequence[str]) -> DataFrame:
    """Exploratory date parts; absent and non-time columns are passed over."""
    new: dict[str, Column] = {}
    for name in date_columns:
        if name in df.columns and is_temporal(type_of(df, name)):
            new.update(short_date_parts(col(name), name))
    return df.withColumns(new) if new else df


def add_shifted_log1p(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``{c}_log1p = log1p(c - min(c) + 1e-6)``; all minima come from one scalar subquery."""
    if not columns:
        return df
    lowest = df.agg(*[F.min(number(df, c)).alias(f"m{i}") for i, c in enumerate(columns)])
    stats = lowest.select(F.struct(*[F.col(f"m{i}") for i in range(len(columns))])).scalar()
    return df.withColumns(
        {f"{c}_log1p": numeric.shifted_log1p(number(df, c), stats[f"m{i}"]) for i, c in enumerate(columns)}
    )


def parse_date_columns(df: DataFrame, max_cols: int | None = None) -> DataFrame:
    """Turn the text columns (the first ``max_cols``, if given) into timestamps where every value parses."""
    candidates = [f.name for f in df.schema if f.dataType.typeName() == "string"][:max_cols]
    if not candidates:
        return df
    parses = df.agg(
        *[
            F.bool_and(col(c).isNull() | parsed_time(c).isNotNull()).alias(f"p{i}")
            for i, c in enumerate(candidates)
        ]
    ).first()
    good = [c for i, c in enumerate(candidates) if parses[f"p{i}"] is not False]
    return df.withColumns({c: parsed_time(c) for c in good}) if good else df


def coercion_report(df: DataFrame, times: Sequence[str] = (), numbers: Sequence[str] = ()) -> DataFrame:
    """``(column, kind, n_invalid)``: what coercion would lose, all columns in one aggregate."""
    jobs = [("datetime", c, moment(df, c)) for c in times] + [("number", c, number(df, c)) for c in numbers]
    counted = df.agg(*[invalid_count(df, c, value).alias(f"n{i}") for i, (_, c, value) in enumerate(jobs)])
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"), F.col(f"n{i}").alias("n_invalid"))
        for i, (kind, c, _) in enumerate(jobs)
    ]
    return counted.select(F.inline(F.array(*rows)))
