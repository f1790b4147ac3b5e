"""File scans with format inference, column contracts and data zones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rowloom.errors import DataError, require_columns
from rowloom.functions.coerce import col
from rowloom.sources.feather import scan_feather

FORMATS = ("csv", "parquet", "feather")
BAD_ROW = "_bad_row"


def infer_format(path: str) -> str:
    """Format by the suffix of a file or folder; anything unknown is read as CSV."""
    suffix = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    return suffix if suffix in ("parquet", "feather") else "csv"


def load_table(
    spark: SparkSession,
    path: str,
    format: str | None = None,
    required_columns: Sequence[str] = (),
    schema: T.StructType | str | None = None,
    options: Mapping[str, Any] | None = None,
    bad_rows: str = "fail",
) -> DataFrame:
    """Scan a CSV, Parquet or Feather path.

    Give ``schema`` for CSV at scale: without one Spark reads the files twice.  Its
    fields are matched to the header by name; other header columns are left out.

    A CSV row that does not fit (a cell of another type, missing or extra fields) fails
    the job, so nothing is lost silently.  ``bad_rows="keep"`` keeps its text in the
    column ``BAD_ROW``, NULL for good rows; count them with :func:`row_quality`.
    """
    if bad_rows not in ("fail", "keep"):
        raise DataError(f"bad_rows is fail or keep, not {bad_rows!r}", "data_load_error")
    chosen = format.lower() if format else infer_format(path)
    if chosen not in FORMATS:
        raise DataError(f"unsupported format {chosen!r}", "data_unsupported_format", {"supported": list(FORMATS)})
    try:
        df = _scan(spark, path, chosen, schema, dict(options or {}), required_columns, bad_rows)
    except DataError:
        raise
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise DataError(f"no file at {path}", "data_file_not_found", {"path": path}) from error
        raise DataError(f"cannot read {path}", "data_load_error", {"path": path}) from error
    except (PySparkException, Py4JJavaError) as error:
        raise DataError(f"cannot read {path}", "data_load_error", {"path": path}) from error
    require_columns(df.columns, required_columns, "data_missing_columns", path)
    return df


def _scan(
    spark: SparkSession, path: str, format: str, schema, options: dict[str, Any], required: Sequence[str], bad_rows: str
) -> DataFrame:
    if format == "feather":
        return scan_feather(spark, path, schema)
    if format == "csv":
        return _scan_csv(spark, path, schema, {"header": True, **options}, required, bad_rows)
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(format).load(path)


def _scan_csv(spark: SparkSession, path: str, schema, options: dict[str, Any], required: Sequence[str], bad_rows: str) -> DataFrame:
    mode = {"mode": "FAILFAST"} if bad_rows == "fail" else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_ROW}
    options = {**mode, **options}
    keep = [] if bad_rows == "fail" else [T.StructField(BAD_ROW, T.StringType())]
    if schema is None:
        found = spark.read.options(**options, inferSchema=True).csv(path)
        if not keep:
            return found
        inferred = T.StructType([f for f in found.schema if f.name != BAD_ROW] + keep)
        return spark.read.options(**options).schema(inferred).csv(path)
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if str(options["header"]).lower() != "true":
        return spark.read.options(**options).schema(T.StructType(list(wanted) + keep)).csv(path)
    header = spark.read.options(**{**options, "mode": "PERMISSIVE"}).csv(path).columns  # reads one line
    require_columns(header, [*required, *wanted.names], "data_missing_columns", path)
    typed = {f.name: f for f in wanted}
    fields = [typed.get(name, T.StructField(name, T.StringType())) for name in header]
    # enforceSchema=False has Spark compare the header of every file with these names.
    df = spark.read.options(**options, enforceSchema=False).schema(T.StructType(fields + keep)).csv(path)
    return df.select(*[col(n) for n in [*wanted.names, *[f.name for f in keep]]])


def row_quality(df: DataFrame) -> DataFrame:
    """One row: good_rows and bad_rows of a table read with ``bad_rows="keep"``."""
    require_columns(df.columns, [BAD_ROW], "data_missing_columns", "row quality")
    # Cells are checked where they are read: the second condition, true for every row, reads all.
    cells = F.concat_ws("", *[col(c).cast("string") for c in df.columns if c != BAD_ROW])
    bad = F.count_if(col(BAD_ROW).isNotNull() & (F.length(cells) >= 0))
    return df.agg((F.count("*") - bad).alias("good_rows"), bad.alias("bad_rows"))


def load_zone(
    spark: SparkSession, zones: Mapping[str, str], zone: str, name: str, **kwargs: Any
) -> DataFrame:
    """Scan ``name`` below a named zone such as ``raw`` or ``processed``."""
    if zone not in zones:
        raise DataError(f"unknown zone {zone!r}", "data_unknown_zone", {"zones": sorted(zones)})
    return load_table(spark, zone_path(zones, zone, name), **kwargs)


def zone_path(zones: Mapping[str, str], zone: str, name: str) -> str:
    absolute = name.startswith("/") or "://" in name
    return name if absolute else f"{zones[zone].rstrip('/')}/{name}"
