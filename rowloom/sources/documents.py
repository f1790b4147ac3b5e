"""Document collections: JSON lines with a filter, projection, sort and limit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rowloom.errors import DataError

COMPARISONS = {
    "$eq": lambda c, v: c.eqNullSafe(F.lit(v)),
    "$ne": lambda c, v: ~c.eqNullSafe(F.lit(v)),
    "$gt": lambda c, v: c > F.lit(v),
    "$gte": lambda c, v: c >= F.lit(v),
    "$lt": lambda c, v: c < F.lit(v),
    "$lte": lambda c, v: c <= F.lit(v),
    "$in": lambda c, v: reduce(lambda a, b: a | b, [c.eqNullSafe(F.lit(x)) for x in v], F.lit(False)),
    "$nin": lambda c, v: ~reduce(lambda a, b: a | b, [c.eqNullSafe(F.lit(x)) for x in v], F.lit(False)),
    "$exists": lambda c, v: c.isNotNull() if v else c.isNull(),
}


def _refuse(message: str) -> DataError:
    return DataError(message, "mongo_load_error")


def _field(df: DataFrame, path: str) -> Column:
    """A field by dotted path; a path the schema lacks reads as missing everywhere."""
    here: T.DataType = df.schema
    for step in path.split("."):
        if not isinstance(here, T.StructType) or step not in here.names:
            return F.lit(None)
        here = here[step].dataType
    return F.col(".".join(f"`{step}`" for step in path.split(".")))


def condition(df: DataFrame, query: Mapping[str, Any]) -> Column:
    """A filter document as a boolean column, so the scan can prune and push it down."""
    parts = []
    for key, wanted in query.items():
        if key in ("$and", "$or"):
            if not wanted:
                raise _refuse(f"{key} needs at least one filter")
            inner = [condition(df, q) for q in wanted]
            parts.append(reduce((lambda a, b: a & b) if key == "$and" else (lambda a, b: a | b), inner))
        elif key.startswith("$"):
            raise _refuse(f"unsupported operator {key}")
        elif isinstance(wanted, Mapping) and not any(str(k).startswith("$") for k in wanted):
            parts.append(_equals_document(df, key, wanted))
        elif isinstance(wanted, Mapping):
            for operator, value in wanted.items():
                if operator not in COMPARISONS:
                    raise _refuse(f"unsupported operator {operator}")
                parts.append(COMPARISONS[operator](_field(df, key), value))
        else:
            parts.append(COMPARISONS["$eq"](_field(df, key), wanted))
    # A comparison with a missing field does not match.
    return F.coalesce(reduce(lambda a, b: a & b, parts, F.lit(True)), F.lit(False))


def _equals_document(df: DataFrame, key: str, wanted: Mapping[str, Any]) -> Column:
    """An embedded document equals another when all fields do; fields it lacks must be missing."""
    fields = df.select(_field(df, key).alias("d")).schema["d"].dataType
    if not isinstance(fields, T.StructType):
        raise _refuse(f"{key} is no embedded document")
    if set(wanted) - set(fields.names):
        return F.lit(False)
    parts = [_field(df, key).isNotNull()]
    for name in fields.names:
        path, value = f"{key}.{name}", wanted.get(name)
        if isinstance(value, Mapping):
            parts.append(_equals_document(df, path, value))
        else:
            parts.append(_field(df, path).isNull() if value is None else _field(df, path) == F.lit(value))
    return reduce(lambda a, b: a & b, parts)


def _nested(df: DataFrame, projection: Mapping[str, int]) -> list[Column]:
    """Projection of fields inside embedded documents."""
    flags = {k: bool(v) for k, v in projection.items() if k != "_id"}
    if len(set(flags.values())) > 1:
        raise _refuse("a projection either includes or excludes fields")
    tops = {k.split(".")[0] for k in flags}
    keep_id = bool(projection.get("_id", True))
    out = []
    for c in df.columns:
        own = F.col(f"`{c}`")
        inner = [k.split(".", 1)[1] for k in flags if k.startswith(c + ".")]
        if c == "_id" and not keep_id:
            continue
        if inner and not isinstance(df.schema[c].dataType, T.StructType):
            raise _refuse(f"{c} is no embedded document")
        if not all(flags.values()):
            if c in flags:
                continue
            out.append(own.dropFields(*inner).alias(c) if inner else own)
        elif c in flags or (c == "_id" and keep_id and "_id" not in tops):
            out.append(own)
        elif inner:
            out.append(_picked(own, df.schema[c].dataType, inner).alias(c))
    return out


def _picked(value: Column, kind: T.StructType, paths: Sequence[str]) -> Column:
    """The named fields of an embedded document, itself missing where the document is."""
    fields = []
    for name in kind.names:
        below = [p.split(".", 1)[1] for p in paths if p.startswith(name + ".")]
        if name in paths:
            fields.append(value[name].alias(name))
        elif below:
            fields.append(_picked(value[name], kind[name].dataType, below).alias(name))
    if not fields:
        raise _refuse(f"no such field: {list(paths)}")
    return F.when(value.isNotNull(), F.struct(*fields))


def _projected(df: DataFrame, projection: Mapping[str, int] | None) -> list[str]:
    if not projection:
        return df.columns
    flags = {k: bool(v) for k, v in projection.items() if k != "_id"}
    if len(set(flags.values())) > 1:
        raise _refuse("a projection either includes or excludes fields")
    keep_id = bool(projection.get("_id", True))
    if flags and all(flags.values()):
        chosen = [c for c in df.columns if c in flags]
        return (["_id"] if keep_id and "_id" in df.columns else []) + [c for c in chosen if c != "_id"]
    if not flags and projection.get("_id"):
        return [c for c in df.columns if c == "_id"]
    return [c for c in df.columns if c not in flags and (c != "_id" or keep_id)]


def read_collection(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """Documents of a JSON-lines path; give a schema to save the inference pass.

    A line that is no document fails the job.  ``mode="PERMISSIVE"`` keeps it as a row,
    with its text where the schema has the column ``_corrupt_record``.
    """
    reader = spark.read.option("mode", mode)
    reader = reader if schema is None else reader.schema(schema)
    try:
        return reader.json(path)
    except PySparkException as error:
        raise DataError(f"cannot read {path}", "mongo_load_error", {"path": path}) from error


def find(
    documents: DataFrame,
    query: Mapping[str, Any] | None = None,
    projection: Mapping[str, int] | None = None,
    sort: Sequence[tuple[str, int]] | None = None,
    limit: int | None = None,
    drop_id: bool = True,
) -> DataFrame:
    """Matching documents.  Missing values sort first ascending, last descending."""
    df = documents.where(condition(documents, query)) if query else documents
    if sort:
        for _, direction in sort:
            if direction not in (1, -1):
                raise _refuse(f"sort direction must be 1 or -1, not {direction!r}")
        df = df.orderBy(*[_field(df, f).asc() if d == 1 else _field(df, f).desc() for f, d in sort])
    if limit is not None and limit > 0:
        df = df.limit(int(limit))
    if projection and any("." in k for k in projection):
        nested = df.select(*_nested(documents, projection))
        return nested.drop("_id") if drop_id else nested
    names = _projected(documents, projection)
    if drop_id:
        names = [c for c in names if c != "_id"]
    return df.select(*[F.col(f"`{c}`") for c in names])


def count_documents(documents: DataFrame, query: Mapping[str, Any] | None = None) -> DataFrame:
    """One row with the number of matching documents."""
    df = documents.where(condition(documents, query)) if query else documents
    return df.agg(F.count("*").alias("count"))
