"""Coercion rules.  Missing is NULL: NaN, unparsable text and invalid dates become NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowloom.errors import DataError

NAN = float("nan")
INF = float("inf")


def col(name: str) -> Column:
    """Reference a column by its literal name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_fraction(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def no_nan(value: Column) -> Column:
    """NaN to NULL, on a floating expression."""
    return F.nullif(value, F.lit(NAN))


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN read as missing; other types unchanged."""
    return no_nan(col(name)) if is_fraction(type_of(df, name)) else col(name)


def number(df: DataFrame, name: str) -> Column:
    """The column as double; text that is no number becomes NULL."""
    dtype = type_of(df, name)
    source = col(name)
    if is_fraction(dtype):
        return no_nan(source.cast("double"))
    if is_numeric(dtype):
        return source.cast("double")
    if isinstance(dtype, T.BooleanType):
        return source.cast("int").cast("double")
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        # The JVM parser accepts a type suffix ("1d", "2.5f"), which is not a number here.
        suffixed = source.rlike(r"(?i)[0-9.][df]\s*$")
        return F.when(~suffixed, no_nan(source.try_cast("double")))
    raise DataError(
        f"column {name!r} of type {dtype.simpleString()} has no numeric reading",
        "numeric_coercion_unsupported",
        {"column": name},
    )


def finite_number(df: DataFrame, name: str) -> Column:
    """Like :func:`number`, with infinities also read as missing (rolling aggregates)."""
    value = number(df, name)
    dtype = type_of(df, name)
    if is_numeric(dtype) and not is_fraction(dtype):
        return value
    # NaN sorts above infinity, so one comparison removes both.
    return F.when(F.abs(value) < F.lit(INF), value)


def moment(
    df: DataFrame,
    name: str,
    fmt: str | None = None,
    code: str = "feature_datetime_conversion_error",
) -> Column:
    """The column as a timestamp; unparsable text becomes NULL, numbers are refused."""
    dtype = type_of(df, name)
    if isinstance(dtype, T.DateType):
        return col(name).cast("timestamp_ntz")
    if is_temporal(dtype):
        return col(name)
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return parsed_time(name, fmt)
    raise DataError(
        f"column {name!r} of type {dtype.simpleString()} cannot be read as a time", code, {"column": name}
    )


# A clock time with a zone behind it (an offset, a name or an abbreviation): read as that
# moment in UTC.  A zone the JVM does not know gives NULL, as other text that is no time.
_CLOCK, _ZONE = r"([T ][0-9]{1,2}:[0-9]{1,2})", r"\s*((?:[A-Za-z]|[+-][0-9]).*)$"
_ZONED = _CLOCK + r"(?::[0-9]{1,2}(?:[.][0-9]+)?)?" + _ZONE
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _utc_clock(moment_: Column) -> Column:
    """Clock time in UTC of a moment, whatever the session's zone."""
    seconds = (F.unix_micros(moment_).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr(_EPOCH) + F.make_dt_interval(zero, zero, zero, seconds)


def _full(text: Column) -> Column:
    """Zoned text with seconds, without which Spark does not read it."""
    return F.regexp_replace(text, _CLOCK + _ZONE, "$1:00 $2")


def parsed_time(name: str, fmt: str | None = None) -> Column:
    """Text as a time without zone, NULL where it does not parse; the session's zone plays no part."""
    text = col(name)
    if fmt:
        # Read as UTC and written down in UTC.
        return _utc_clock(F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit(f"{fmt} xx")))
    return F.when(text.rlike(_ZONED), _utc_clock(_full(text).try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))


def strict_moment(df: DataFrame, name: str, fmt: str | None = None) -> Column:
    """Parse as timestamp and fail the job on the first bad value (ANSI)."""
    if is_temporal(type_of(df, name)):
        return moment(df, name)
    text = col(name)
    if fmt:
        return _utc_clock(F.to_timestamp(F.concat(text, F.lit(" +0000")), f"{fmt} xx"))
    return F.when(text.rlike(_ZONED), _utc_clock(_full(text).cast("timestamp"))).otherwise(text.cast("timestamp_ntz"))


def invalid_count(df: DataFrame, name: str, coerced: Column) -> Column:
    """Aggregate: values that were there and were lost in coercion."""
    return F.count_if(present(df, name).isNotNull() & coerced.isNull())


def target_column(df: DataFrame, name: str) -> Column:
    """Integer targets are class labels (bigint), all others float; text has no such reading."""
    dtype = type_of(df, name)
    if isinstance(dtype, T.IntegralType):
        return col(name).cast("bigint")
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        raise DataError(
            f"target {name!r} is text: index its labels first", "numeric_coercion_unsupported", {"column": name}
        )
    return number(df, name).cast("float")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds from ``earlier`` to ``later`` with microsecond resolution.

    Moments differ by elapsed time; times without zone by their clocks, whatever the
    session's zone.
    """
    moments = (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(1e6)
    a, b = later.cast("timestamp_ntz"), earlier.cast("timestamp_ntz")
    second = lambda c: F.extract(F.lit("SECOND"), c)
    minutes = F.datediff(a, b).cast("bigint") * 1440 + (F.hour(a) - F.hour(b)) * 60 + F.minute(a) - F.minute(b)
    clocks = (minutes.cast("decimal(20,0)") * 60 + second(a) - second(b)).cast("double")
    # The type is known when the plan is made, so one branch is left.
    return F.when(F.typeof(later) == "timestamp", moments).otherwise(clocks)
