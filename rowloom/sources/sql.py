"""SQL results and tables: Spark SQL over registered views, and external databases by JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from rowloom.errors import DataError
from rowloom.functions.coerce import col


def register(spark: SparkSession, **tables: DataFrame) -> None:
    """Make frames known to SQL by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def query(spark: SparkSession, text: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Result of a SQL text with named ``:name`` parameters."""
    try:
        return spark.sql(text, args=dict(params)) if params else spark.sql(text)
    except PySparkException as error:
        raise DataError(f"query failed: {text[:500]}", "sql_query_error") from error


def table(
    spark: SparkSession,
    name: str,
    schema: str | None = None,
    columns: Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Scan of a catalogue table: column list and limit reach the scan; a limit counts only above 0."""
    try:
        df = spark.table(f"{schema}.{name}" if schema else name)
        if columns:
            df = df.select(*[col(c) for c in columns])
    except PySparkException as error:
        raise DataError(f"cannot read table {name}", "sql_query_error") from error
    return df.limit(int(limit)) if limit is not None and limit > 0 else df


@dataclass(frozen=True)
class Partitioned:
    """How a JDBC read is divided: ranges of a numeric, date or timestamp column."""

    column: str
    lower: Any
    upper: Any
    partitions: int


def jdbc_options(
    url: str,
    dbtable: str | None = None,
    sql: str | None = None,
    schema: str | None = None,
    divided: Partitioned | None = None,
    fetch_rows: int | None = None,
    **extra: Any,
) -> dict[str, str]:
    """Reader options: a table (with optional schema) or a query, read in bounded pieces."""
    if (dbtable is None) == (sql is None):
        raise DataError("give a table or a query", "sql_load_error")
    options = {"url": url, **{k: str(v) for k, v in extra.items()}}
    if dbtable is not None:
        options["dbtable"] = f"{schema}.{dbtable}" if schema else dbtable
    elif divided is not None:
        options["dbtable"] = f"({sql}) q"  # a divided read needs a table expression
    else:
        options["query"] = sql
    if divided is not None:
        options.update(
            partitionColumn=divided.column,
            lowerBound=str(divided.lower),
            upperBound=str(divided.upper),
            numPartitions=str(divided.partitions),
        )
    if fetch_rows is not None:
        options["fetchsize"] = str(fetch_rows)
    return options


def jdbc(
    spark: SparkSession, options: Mapping[str, str], columns: Sequence[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Scan an external database.  ``where`` on the result is pushed to the database."""
    try:
        df = spark.read.format("jdbc").options(**options).load()
        if columns:
            df = df.select(*[col(c) for c in columns])
    except (PySparkException, Py4JJavaError) as error:
        raise DataError("cannot read from the database", "sql_load_error") from error
    return df.limit(int(limit)) if limit is not None and limit > 0 else df


def write_rows(df: DataFrame, path: str, mode: str = "append", format: str = "parquet", **options: str) -> int:
    """Write a frame and return how many rows were written, counted during the write itself."""
    seen = Observation("written")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    try:
        counted.write.mode(mode).format(format).options(**options).save(path)
    except PySparkException as error:
        raise DataError(f"write to {path} failed", "sql_execution_error") from error
    return int(seen.get["rows"])
