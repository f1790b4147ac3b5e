"""Fitted preprocessing: impute, scale, one-hot.  Fit on training rows, apply anywhere.

Fitting runs one statistics job for the numeric columns and one counting job for the
categorical ones.  The fitted numbers are a few per column and travel in the plan;
the encoding of categories is chosen by the spec, never by their number: ``dense`` gives
an indicator column each, ``sparse`` one struct of size and set position, ``index`` the position.
The last two keep (value, index) as a table that is joined, for any number of categories.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rowloom.errors import DataError, require_columns
from rowloom.functions.coerce import col, number
from rowloom.operators.quantile import quantiles
from rowloom.operators.tables import infer_roles
from rowloom.session import scratch_path, small_table, written

INFREQUENT = "<infrequent>"
ENCODINGS = ("dense", "sparse", "index")
#: Indicator columns that ``dense`` gives one input column; more are refused.
MAX_DENSE = 2000
#: Infrequent values listed in the plan; more are a table that is joined.
MAX_LISTED = 100


@dataclass(frozen=True)
class PreprocessSpec:
    numeric_features: Sequence[str] | None = None
    categorical_features: Sequence[str] | None = None
    drop_features: Sequence[str] = ()
    numeric_imputer: str = "median"  # mean, median, most_frequent, constant
    numeric_fill: float | None = None
    scale_numeric: bool = True
    categorical_imputer: str = "most_frequent"  # most_frequent, constant
    categorical_fill: str | None = None
    handle_unknown: str = "ignore"  # ignore, error
    min_frequency: int | None = None
    max_categories: int | None = None
    remainder: str = "drop"  # drop, passthrough
    approx_median: bool = False
    encoding: str = "dense"  # dense, sparse, index


@dataclass(frozen=True)
class NumericFit:
    column: str
    fill: float
    centre: float | None = None
    scale: float | None = None


@dataclass(frozen=True)
class CategoryFit:
    """Sorted categories with an indicator each; the rest of the seen ones share one.

    ``table`` holds (value, index) for the encodings without a column per category, and
    ``size`` the number of positions.  ``rare_table`` holds (value) of the infrequent
    categories where they are too many to list.
    """

    column: str
    fill: str | None
    categories: tuple[str, ...] = ()
    infrequent: tuple[str, ...] = ()
    table: str | None = None
    size: int | None = None
    rare_table: str | None = None


@dataclass(frozen=True)
class Preprocessor:
    spec: PreprocessSpec
    numeric: tuple[NumericFit, ...] = ()
    categorical: tuple[CategoryFit, ...] = ()
    used: tuple[str, ...] = field(default=())

    def parameters(self, spark: SparkSession) -> DataFrame:
        """The fitted numbers as a table, one row per parameter."""
        rows = []
        for f in self.numeric:
            rows += [(f.column, "fill", f.fill, None), (f.column, "centre", f.centre, None)]
            rows.append((f.column, "scale", f.scale, None))
        for c in self.categorical:
            rows.append((c.column, "fill", None, c.fill))
            rows += [(c.column, "category", float(i), v) for i, v in enumerate(c.categories)]
            rows += [(c.column, "infrequent", None, v) for v in c.infrequent]
            if c.table is not None:
                rows.append((c.column, "table", float(c.size), c.table))
            if c.rare_table is not None:
                rows.append((c.column, "infrequent_table", None, c.rare_table))
        return small_table(spark, rows, "column string, parameter string, number double, text string")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write everything that was fitted below ``path``: it outlives the application."""
        moved = []
        for i, c in enumerate(self.categorical):
            if c.table is not None:
                spark.read.parquet(c.table).write.mode("overwrite").parquet(f"{path}/table-{i}")
                c = replace(c, table=f"table-{i}")
            if c.rare_table is not None:
                spark.read.parquet(c.rare_table).write.mode("overwrite").parquet(f"{path}/rare-{i}")
                c = replace(c, rare_table=f"rare-{i}")
            moved.append(c)
        kept = replace(self, categorical=tuple(moved))
        about = json.dumps({"spec": asdict(self.spec), "used": list(self.used), "order": [c.column for c in (*self.numeric, *self.categorical)]})
        extra = small_table(spark, [("", "about", None, about)], "column string, parameter string, number double, text string")
        kept.parameters(spark).union(extra).coalesce(1).write.mode("overwrite").parquet(f"{path}/parameters")

    def transform(self, df: DataFrame, validate: str = "eager") -> DataFrame:
        """Numeric columns in place, then the categories (``{column}__{category}`` indicators,
        ``{column}__onehot`` or ``{column}__index``), then the remainder.

        A projection (plus a join per written category table), so it also applies to
        streams; there use ``validate="lazy"`` with ``handle_unknown="error"``.
        """
        require_columns(df.columns, self.used, "missing_columns_for_preprocessor", "preprocessor input")
        strict = self.spec.handle_unknown == "error"
        if strict and validate == "eager":
            self._refuse_unknown(df)
        out = [_scaled(df, f).alias(f.column) for f in self.numeric]
        for c in self.categorical:
            if c.table is None:
                rare = None
                if c.rare_table is not None:
                    rare = col(f"__value_{c.column}")
                    table = df.sparkSession.read.parquet(c.rare_table).select(col("value").alias(f"__value_{c.column}"))
                    df = df.join(table, _text(df, c) == rare, "left")
                out += _indicators(df, c, strict and validate == "lazy", rare)
            else:
                value, index = f"__value_{c.column}", f"__index_{c.column}"
                table = df.sparkSession.read.parquet(c.table).select(col("value").alias(value), col("index").alias(index))
                text = _text(df, c)
                df = df.join(table, text == col(value), "left")
                found = col(index)
                if strict and validate == "lazy":
                    message = F.concat(F.lit(f"[unknown_category] {c.column}: "), text)
                    found = F.when(text.isNull() | found.isNotNull(), found).otherwise(F.raise_error(message).cast("bigint"))
                out.append(_placed(c, self.spec.encoding, found))
        if self.spec.remainder == "passthrough":
            used = {*self.used, *self.spec.drop_features}
            joined = {f"__{kind}_{c.column}" for c in self.categorical if c.table or c.rare_table for kind in ("value", "index")}
            out += [col(c) for c in df.columns if c not in used and c not in joined]
        return df.select(*out)

    def _refuse_unknown(self, df: DataFrame) -> None:
        tests = []
        for c in self.categorical:
            text = _text(df, c)
            if c.table is None and c.rare_table is None:
                unknown = text.isNotNull() & ~text.isin([*c.categories, *c.infrequent])
                tests.append((c.column, df.agg(F.min(F.when(unknown, text)).alias("bad"))))
            else:
                known = df.sparkSession.read.parquet(c.table or c.rare_table)
                values = df.select(text.alias("value")).distinct().where("value is not null")
                values = values.where(~col("value").isin(list(c.categories)))
                tests.append((c.column, values.join(known, "value", "left_anti").agg(F.min("value").alias("bad"))))
        for column, test in tests:
            bad = test.first()["bad"]
            if bad is not None:
                raise DataError(
                    f"column {column!r} holds the unknown category {bad!r}", "unknown_category", {"column": column}
                )


def build_preprocessor(df: DataFrame, spec: PreprocessSpec | None = None) -> Preprocessor:
    """Resolve column roles at plan time; nothing is fitted yet."""
    spec = spec or PreprocessSpec()
    numeric, categorical = infer_roles(
        df, spec.numeric_features, spec.categorical_features, spec.drop_features, spec.remainder
    )
    if not numeric and not categorical and spec.remainder == "drop":
        raise DataError("nothing to transform", "no_transformers_configured")
    return Preprocessor(spec, used=(*numeric, *categorical))


def fit_preprocessor(df: DataFrame, spec: PreprocessSpec | None = None) -> Preprocessor:
    """Fit every statistic on ``df``: give it the training rows only."""
    built = build_preprocessor(df, spec)
    spec = built.spec
    numeric, categorical = infer_roles(
        df, spec.numeric_features, spec.categorical_features, spec.drop_features, spec.remainder
    )
    return Preprocessor(
        spec,
        tuple(_fit_numeric(df, numeric, spec)) if numeric else (),
        tuple(_fit_categories(df, categorical, spec)) if categorical else (),
        built.used,
    )


def fit_transform_preprocessor(df: DataFrame, spec: PreprocessSpec | None = None) -> tuple[DataFrame, Preprocessor]:
    fitted = fit_preprocessor(df, spec)
    return fitted.transform(df), fitted


def standardize(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Scale columns to mean 0 and population variance 1, statistics from the training rows."""
    spec = PreprocessSpec(numeric_features=list(columns), categorical_features=(), numeric_imputer="mean")
    fitted = _fit_numeric(df if fit_on is None else fit_on, columns, spec)
    scaled = {f.column: (number(df, f.column) - F.lit(f.centre)) / F.lit(f.scale) for f in fitted}
    return df.withColumns(scaled)


def _fit_numeric(df: DataFrame, columns: Sequence[str], spec: PreprocessSpec) -> list[NumericFit]:
    aggs = [F.count("*").alias("rows")]
    for i, c in enumerate(columns):
        x = number(df, c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    seen = df.agg(*aggs).first()
    strategy = spec.numeric_imputer
    if strategy == "constant":
        fills = {c: 0.0 if spec.numeric_fill is None else float(spec.numeric_fill) for c in columns}
    elif strategy == "mean":
        fills = {c: seen[f"m{i}"] for i, c in enumerate(columns)}
    elif strategy == "median":
        fills = {c: q[0] for c, q in quantiles(df, columns, [0.5], spec.approx_median, seen["rows"]).items()}
    elif strategy == "most_frequent":
        pairs = df.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("column"), number(df, c).alias("value")) for c in columns]))
        )
        fills = _modes(pairs.where("value is not null").groupBy("column", "value").count())
    else:
        raise ValueError(f"unknown numeric imputer {strategy!r}")

    fitted = []
    for i, c in enumerate(columns):
        fill, n, rows = fills.get(c), seen[f"n{i}"], seen["rows"]
        if fill is None:
            continue  # a column without any value is left out, as nothing can fill it
        if not spec.scale_numeric:
            fitted.append(NumericFit(c, fill))
            continue
        # Moments of the filled column follow from those of the present values.
        m, v = (seen[f"m{i}"], seen[f"v{i}"]) if n else (fill, 0.0)
        centre = (n * m + (rows - n) * fill) / rows
        variance = (n * (v + (m - centre) ** 2) + (rows - n) * (fill - centre) ** 2) / rows
        noise = rows * 2.0**-52 * variance + (rows * 2.0**-52 * centre) ** 2
        fitted.append(NumericFit(c, fill, centre, variance**0.5 if variance > noise else 1.0))
    return fitted


def _modes(counted: DataFrame) -> dict:
    """Most frequent value per column, the smallest on ties: one row per column."""
    best = counted.groupBy("column").agg(F.min(F.struct((-F.col("count")).alias("less"), "value")).alias("best"))
    return {r["column"]: r["best"]["value"] for r in best.collect()}


def _scaled(df: DataFrame, f: NumericFit) -> Column:
    filled = F.coalesce(number(df, f.column), F.lit(f.fill))
    return filled if f.scale is None else (filled - F.lit(f.centre)) / F.lit(f.scale)


def _fit_categories(df: DataFrame, columns: Sequence[str], spec: PreprocessSpec) -> list[CategoryFit]:
    pairs = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in columns])
        )
    )
    counted = written(pairs.groupBy("column", "value").count(), "categories")
    present = counted.where("value is not null")
    if spec.categorical_imputer == "most_frequent":
        fills = _modes(present)
    elif spec.categorical_imputer == "constant":
        fills = {c: "missing" if spec.categorical_fill is None else spec.categorical_fill for c in columns}
    else:
        raise ValueError(f"unknown categorical imputer {spec.categorical_imputer!r}")
    fills = {c: fills.get(c) for c in columns}

    # Missing rows count for the value that fills them.
    filled = counted.withColumn("value", F.coalesce("value", _by_column(fills))).where("value is not null")
    filled = filled.groupBy("column", "value").agg(F.sum("count").alias("count"))
    if spec.min_frequency is not None:
        filled = filled.withColumn("rare", F.col("count") < spec.min_frequency)
    else:
        filled = filled.withColumn("rare", F.lit(False))
    if spec.encoding not in ENCODINGS:
        raise ValueError(f"unknown encoding {spec.encoding!r}")
    sizes = {r["column"]: r for r in filled.groupBy("column").agg(F.count("*").alias("k"), F.count_if("rare").alias("r")).collect()}
    dense = [c for c in columns if c in sizes and spec.encoding == "dense"]
    for c in dense:
        frequent = sizes[c]["k"] - sizes[c]["r"]
        width = frequent + (1 if sizes[c]["r"] else 0)
        width = width if spec.max_categories is None else min(width, max(spec.max_categories, 1))
        if width > MAX_DENSE:
            raise DataError(
                f"column {c!r} has {width} categories; a column each is possible for {MAX_DENSE}: "
                "set max_categories or min_frequency, or another encoding",
                "too_many_categories",
                {"column": c, "categories": width},
            )
    listed = [c for c in dense if sizes[c]["k"] <= MAX_DENSE + MAX_LISTED]
    rows = filled.where(F.col("column").isin(listed)).collect() if listed else []

    fitted = []
    for c in columns:
        if fills[c] is None or c not in sizes:
            continue
        if c in listed:
            counts = {r["value"]: (r["count"], r["rare"]) for r in rows if r["column"] == c}
            kept, rest = _frequent(counts, spec.max_categories)
            if len(rest) <= MAX_LISTED:
                fitted.append(CategoryFit(c, fills[c], kept, rest))
            else:
                rare = small_table(df.sparkSession, [(v,) for v in rest], "value string")
                fitted.append(CategoryFit(c, fills[c], kept, rare_table=_table_path(rare)))
        elif c in dense:
            kept, rare = _many_rare(filled.where(F.col("column") == c), spec.max_categories, sizes[c])
            fitted.append(CategoryFit(c, fills[c], kept, rare_table=rare))
        else:
            ranked = filled.where(F.col("column") == c)
            table, size = _index_table(ranked, spec.max_categories, sizes[c])
            fitted.append(CategoryFit(c, fills[c], table=table, size=size))
    return fitted


def _by_column(values: dict[str, str | None]) -> Column:
    choice = F.lit(None).cast("string")
    for name, value in values.items():
        choice = F.when(F.col("column") == name, F.lit(value)).otherwise(choice)
    return choice


def _frequent(counts: dict[str, tuple[int, bool]], limit: int | None) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """Categories that keep their own indicator, in order, and those that share one."""
    frequent = sorted(v for v, (_, rare) in counts.items() if not rare)
    outputs = len(frequent) + (len(frequent) < len(counts))
    if limit is not None and outputs > limit:
        # Least frequent first; equal counts give way in category order.
        by_count = sorted(frequent, key=lambda v: (counts[v][0], v))
        frequent = sorted(by_count[len(by_count) - (limit - 1) :]) if limit > 1 else []
    return tuple(frequent), tuple(sorted(v for v in counts if v not in frequent))


def _table_path(df: DataFrame) -> str:
    path = scratch_path(df.sparkSession, "categories")
    df.write.parquet(path)
    return path


def _many_rare(filled: DataFrame, limit: int | None, size) -> tuple[tuple[str, ...], str]:
    """As :func:`_frequent`, of any number of values: at most ``MAX_DENSE`` come to the driver, the others are written."""
    frequent = filled.where("not rare")
    if limit is not None and size["k"] - size["r"] + (1 if size["r"] else 0) > limit:
        frequent = frequent.orderBy(F.col("count").desc(), F.col("value").desc()).limit(max(limit - 1, 0))
    kept = tuple(sorted(r["value"] for r in frequent.select("value").collect()))
    own = small_table(filled.sparkSession, [(v,) for v in kept], "value string")
    return kept, _table_path(filled.select("value").join(own, "value", "left_anti"))


def _index_table(filled: DataFrame, limit: int | None, size) -> tuple[str, int]:
    """Write (value, index), index by category order with one shared last index for rare ones; and the number of indices.

    The categories kept under a limit are those of :func:`_frequent`.
    """
    from rowloom.operators.ordering import dense_index

    ranked = dense_index(filled, [F.col("rare"), F.col("value")], "index")
    n_kept = size["k"] - size["r"]
    outputs = n_kept + (1 if size["r"] else 0)
    if limit is not None and outputs > limit:
        # Least frequent first; equal counts give way in category order.
        by_count = dense_index(filled.where("not rare"), [F.col("count"), F.col("value")], "place")
        dropped = n_kept - max(limit - 1, 0)
        ranked = dense_index(
            filled.join(by_count.select("value", "place"), "value", "left").withColumn(
                "rare", F.coalesce(F.col("place") < dropped, F.lit(True))
            ),
            [F.col("rare"), F.col("value")],
            "index",
        )
        n_kept = max(limit - 1, 0)
        outputs = n_kept + 1
    path = scratch_path(filled.sparkSession, "category-index")
    ranked.select("value", F.least("index", F.lit(n_kept).cast("bigint")).alias("index")).write.parquet(path)
    return path, outputs


def _placed(c: CategoryFit, encoding: str, index: Column) -> Column:
    """The position as a column of its own, or as a one-hot vector with at most one set entry."""
    if encoding == "index":
        return index.alias(f"{c.column}__index")
    return F.struct(F.lit(c.size).cast("int").alias("size"), index.cast("int").alias("index")).alias(f"{c.column}__onehot")


def load_preprocessor(spark: SparkSession, path: str) -> Preprocessor:
    """A preprocessor that :meth:`Preprocessor.save` wrote."""
    rows = spark.read.parquet(f"{path}/parameters").collect()  # a few per column, and the listed categories
    about = json.loads(next(r["text"] for r in rows if r["parameter"] == "about"))
    numeric, categorical = [], []
    for column in about["order"]:
        mine = [r for r in rows if r["column"] == column]
        one = {r["parameter"]: r for r in mine}
        if "centre" in one:
            numeric.append(NumericFit(column, *(one[k]["number"] for k in ("fill", "centre", "scale"))))
            continue
        listed = tuple(r["text"] for r in sorted((r for r in mine if r["parameter"] == "category"), key=lambda r: r["number"]))
        rare = tuple(r["text"] for r in mine if r["parameter"] == "infrequent")
        table, rare_table = one.get("table"), one.get("infrequent_table")
        categorical.append(
            CategoryFit(
                column, one["fill"]["text"], listed, tuple(sorted(rare)),
                f"{path}/{table['text']}" if table else None, int(table["number"]) if table else None,
                f"{path}/{rare_table['text']}" if rare_table else None,
            )
        )
    return Preprocessor(PreprocessSpec(**about["spec"]), tuple(numeric), tuple(categorical), tuple(about["used"]))


def _text(df: DataFrame, c: CategoryFit) -> Column:
    return F.coalesce(col(c.column).cast("string"), F.lit(c.fill))


def _indicators(df: DataFrame, c: CategoryFit, raise_unknown: bool, rare: Column | None = None) -> list[Column]:
    """A column per category, and one for the infrequent; ``rare`` is set where the joined table has the value."""
    text = _text(df, c)
    infrequent = lambda t: t.isin(list(c.infrequent)) if rare is None else F.when(t.isNotNull(), rare.isNotNull())
    if raise_unknown:
        message = F.concat(F.lit(f"[unknown_category] {c.column}: "), text)
        known = text.isin(list(c.categories)) | infrequent(text)
        text = F.when(known, text).otherwise(F.raise_error(message).cast("string"))
    one = lambda condition: condition.cast("int").cast("double")
    out = [one(text == F.lit(v)).alias(f"{c.column}__{v}") for v in c.categories]
    if c.infrequent or rare is not None:
        out.append(one(infrequent(text)).alias(f"{c.column}__{INFREQUENT}"))
    return out
