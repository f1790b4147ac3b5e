"""Table profiling: counts, summaries, exact quantiles, histograms, correlation, skewness."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowloom.errors import require_columns
from rowloom.functions.coerce import col, is_fraction, number, present, type_of
from rowloom.operators.quantile import WHOLE_ROWS, bracketed, quantile_table, with_sketches
from rowloom.operators.tables import concatenate, numeric_columns
from rowloom.session import small_table, written

QUARTILES = (0.25, 0.5, 0.75)
_QUARTILE_NAMES = ("q25", "q50", "q75")


def _rows(df: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """One wide aggregate row as a long table."""
    return df.select(F.inline(F.array(*structs)))


def schema_table(df: DataFrame) -> DataFrame:
    """``(column, dtype, non_missing)``."""
    types = dict(df.dtypes)
    counted = df.agg(*[F.count(present(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return _rows(
        counted,
        [
            F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col(f"n{i}").alias("non_missing"))
            for i, c in enumerate(df.columns)
        ],
    )


def dtype_counts(df: DataFrame) -> DataFrame:
    """``(dtype, n_columns)``."""
    return (
        small_table(df.sparkSession, df.dtypes, "column string, dtype string")
        .groupBy("dtype")
        .agg(F.count("*").alias("n_columns"))
    )


def missing_table(df: DataFrame) -> DataFrame:
    """``(column, missing_count, missing_pct)``, most missing first; one aggregate."""
    counted = df.agg(
        F.count("*").alias("n"), *[F.count_if(present(df, c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)]
    )
    rows = _rows(
        counted,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"m{i}").alias("missing_count"),
                F.try_divide(F.col(f"m{i}") * 100.0, F.col("n")).alias("missing_pct"),
            )
            for i, c in enumerate(df.columns)
        ],
    )
    return rows.orderBy(F.desc("missing_pct"), "column")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """``(column, n_unique)`` of non-missing values, fewest first."""
    names = df.columns if columns is None else list(columns)
    require_columns(df.columns, names, "profile_missing_columns", "distinct counts")
    if approx:
        counted = df.agg(*[F.approx_count_distinct(present(df, c)).alias(f"n{i}") for i, c in enumerate(names)])
        rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_unique")) for i, c in enumerate(names)]
        return _rows(counted, rows).orderBy("n_unique", "column")
    # Columns of one type share a narrow (column, value) table; several distinct counts in
    # one aggregate would carry every column through the shuffle for every row and column.
    kinds: dict[str, list[int]] = {}
    for i, c in enumerate(names):
        kinds.setdefault(_shared_type(type_of(df, c)), []).append(i)
    parts = []
    for kind, places in kinds.items():
        cells = [
            F.struct(F.lit(i).alias("place"), present(df, names[i]).cast(kind).alias("value")) for i in places
        ]
        values = df.select(F.inline(F.array(*cells))).where("value is not null").distinct()
        parts.append(values.groupBy("place").agg(F.count("*").alias("n_unique")))
    every = small_table(df.sparkSession, list(enumerate(names)), "place int, column string")
    found = every.join(F.broadcast(concatenate(parts)), "place", "left")
    return found.select("column", F.coalesce("n_unique", F.lit(0)).alias("n_unique")).orderBy("n_unique", "column")


def _shared_type(dtype: T.DataType) -> str:
    """A type that holds every value of ``dtype`` apart from its neighbours."""
    if isinstance(dtype, T.IntegralType):
        return "bigint"
    return "double" if is_fraction(dtype) else dtype.simpleString()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(present(df, column).alias(column)).distinct()


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """``(value, count)`` with missing as a value of its own, most frequent first."""
    counted = df.groupBy(present(df, column).alias(column)).agg(F.count("*").alias("count"))
    ranked = counted.orderBy(F.desc("count"), F.asc_nulls_last(col(column)))
    return ranked if top is None else ranked.limit(top)


def class_summary(df: DataFrame, target: str, features: Sequence[str] = ()) -> DataFrame:
    """Rows, share and feature means per class."""
    total = df.agg(F.count("*")).scalar()
    return df.groupBy(present(df, target).alias(target)).agg(
        F.count("*").alias("n_rows"),
        (F.count("*") / total).alias("share"),
        *[F.avg(number(df, c)).alias(f"mean_{c}") for c in features],
    )


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """``(column, count, mean, std, min, q25, q50, q75, max)`` of the numeric columns.

    Two passes: moments and the sketch that brackets the quartiles, then the brackets.
    With ``approx`` the quartiles are the sketch's, from one pass.
    """
    names = numeric_columns(df) if columns is None else list(columns)
    require_columns(df.columns, names, "profile_missing_columns", "numeric summary")
    if approx:
        aggs = []
        for i, c in enumerate(names):
            x = number(df, c)
            parts = {"n": F.count(x), "mean": F.avg(x), "std": F.stddev_samp(x), "low": F.min(x), "high": F.max(x)}
            parts["q"] = F.percentile_approx(x, list(QUARTILES), 10_000)
            aggs.append(F.struct(*[v.alias(k) for k, v in parts.items()]).alias(f"c{i}"))
        seen = list(df.agg(*aggs).first())
        quartiles = [r["q"] or [None] * 3 for r in seen]
    else:
        seen = with_sketches(df, names)
        if max((r.n for r in seen), default=0) > WHOLE_ROWS:
            exact = bracketed(df, names, QUARTILES, seen)
        else:
            exact = quantile_table(df, names, QUARTILES, rows=0)
        found = {(r["column"], r["q"]): r["value"] for r in exact.collect()}  # three per column
        quartiles = [[found.get((c, q)) for q in QUARTILES] for c in names]
    rows = [(c, r.n, r.mean, r.std, r.low, *q, r.high) for c, r, q in zip(names, seen, quartiles)]
    schema = ", ".join(["column string, count bigint", *[f"{n} double" for n in ("mean", "std", "min", *_QUARTILE_NAMES, "max")]])
    return small_table(df.sparkSession, rows, schema)


def histogram(df: DataFrame, column: str, bins: int = 30, infinite: bool = False) -> DataFrame:
    """``(bin, lower, upper, count)``: equal-width bins of the finite values, the last closed, empty bins included.

    ``infinite=True`` adds bin 0, without edges, with the number of infinite values.
    """
    require_columns(df.columns, [column], "profile_missing_columns", "histogram")
    present_ = df.select(number(df, column).alias("x")).where("x is not null")
    values = present_.where(F.abs("x") < F.lit(float("inf")))
    ends = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    # A constant column gets one unit of room around its value.
    room = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(F.lit(0.0))
    span = ends.select(F.struct((F.col("lo") - room).alias("lo"), (F.col("hi") + room).alias("hi"))).scalar()
    placed = F.least(F.width_bucket(F.col("x"), span["lo"], span["hi"], F.lit(bins)), F.lit(bins))
    counted = values.groupBy(placed.alias("bin")).agg(F.count("*").alias("n"))
    width = (span["hi"] - span["lo"]) / F.lit(float(bins))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    binned = every.join(counted, "bin", "left").select(
        "bin",
        (span["lo"] + width * (F.col("bin") - 1)).alias("lower"),
        (span["lo"] + width * F.col("bin")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )
    if not infinite:
        return binned
    nothing = F.lit(None).cast("double")
    others = present_.agg(F.count_if(F.abs("x") == F.lit(float("inf"))).alias("count"))
    return binned.union(others.select(F.lit(0).cast("bigint"), nothing, nothing, "count"))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(column_a, column_b, corr)``: Pearson correlation over rows with both values.

    NULL where one side is constant, NaN where one has an infinity.  Each task adds up masked matrix products of
    its Arrow batches and sends one short row per pair: counts, means and central
    moments, which are merged around the overall means.
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    names = small_table(
        df.sparkSession, [(k, a, b) for k, (a, b) in enumerate(pairs)], "pair int, column_a string, column_b string"
    )
    values = df.select(*[number(df, c).alias(f"v{i}") for i, c in enumerate(columns)])
    place = {c: i for i, c in enumerate(columns)}
    moments = _pair_moments([place[a] for a, _ in pairs], [place[b] for _, b in pairs])
    schema = "pair int, n double, a double, b double, aa double, bb double, ab double"
    parts = written(values.mapInArrow(moments, schema), "pair-moments")
    n = F.col("n")
    means = parts.groupBy("pair").agg(
        F.sum("n").alias("rows"), (F.sum(n * F.col("a")) / F.sum("n")).alias("ma"), (F.sum(n * F.col("b")) / F.sum("n")).alias("mb")
    )
    # A row per pair: known by the columns, not by the rows.
    off_a, off_b = F.col("a") - F.col("ma"), F.col("b") - F.col("mb")
    merged = parts.join(F.broadcast(means), "pair").groupBy("pair").agg(
        F.sum(F.col("aa") + n * off_a * off_a).alias("aa"),
        F.sum(F.col("bb") + n * off_b * off_b).alias("bb"),
        F.sum(F.col("ab") + n * off_a * off_b).alias("ab"),
        F.first("rows").alias("rows"),
        F.first("ma").alias("ma"),
        F.first("mb").alias("mb"),
    )
    # What merging leaves of a constant is rounding noise.
    real = lambda m, mean: F.when(F.col(m) > F.col("rows") * F.pow(F.col(mean) * F.lit(2.0**-48), F.lit(2.0)), F.sqrt(m)).otherwise(0.0)
    corr = F.try_divide(F.col("ab"), real("aa", "ma") * real("bb", "mb"))
    return F.broadcast(names).join(merged.select("pair", corr.alias("corr")), "pair", "left").select("column_a", "column_b", "corr")


def _pair_moments(first: Sequence[int], second: Sequence[int]):
    """Arrow batches of double columns to one row per pair of columns: n, means, central moments."""
    a, b = np.array(first, int), np.array(second, int)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            there, infinite = ~np.isnan(x), np.isinf(x)
            finite = there & ~infinite
            if shift is None:
                shift, total = np.full(x.shape[1], np.nan), [np.zeros((x.shape[1],) * 2) for _ in range(5)]
            # The first value of a column is taken off: small numbers lose less.
            new = np.isnan(shift) & finite.any(0)
            shift[new] = x[finite.argmax(0), np.arange(x.shape[1])][new]
            y = np.where(finite, x - np.where(np.isnan(shift), 0.0, shift), 0.0)
            mask = there.astype(float)
            for t, part in zip(total, (mask.T @ mask, y.T @ mask, (y * y).T @ mask, y.T @ y, infinite.astype(float).T @ mask)):
                t += part
        if shift is None:
            return
        n, s, q, c, bad = total
        shift = np.where(np.isnan(shift), 0.0, shift)
        rows = n[a, b]
        used = rows > 0
        safe = np.maximum(rows, 1.0)
        sa, sb = s[a, b], s[b, a]
        spoilt = np.where(bad[a, b] + bad[b, a] > 0, np.nan, 0.0)
        cells = [
            np.arange(len(a), dtype=np.int32), rows, shift[a] + sa / safe, shift[b] + sb / safe,
            np.maximum(q[a, b] - sa * sa / safe, 0.0) + spoilt, np.maximum(q[b, a] - sb * sb / safe, 0.0) + spoilt,
            c[a, b] - sa * sb / safe + spoilt,
        ]
        yield pa.RecordBatch.from_arrays([pa.array(v[used]) for v in cells], names=["pair", "n", "a", "b", "aa", "bb", "ab"])

    return run


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_a, column_b, corr)`` for every ordered pair, diagonal included; one scan."""
    names = numeric_columns(df) if columns is None else list(columns)
    half = correlations(df, [(a, b) for i, a in enumerate(names) for b in names[i:]])
    sides = F.array(
        F.struct("column_a", "column_b"), F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"))
    )
    return half.select("corr", F.inline(F.array_distinct(sides))).select("column_a", "column_b", "corr")


def target_correlation(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, top: int | None = None
) -> DataFrame:
    """``(column, abs_corr)`` with the target, strongest first."""
    names = [c for c in (numeric_columns(df) if columns is None else columns) if c != target]
    require_columns(df.columns, [target, *names], "profile_missing_columns", "target correlation")
    found = correlations(df, [(c, target) for c in names])
    ranked = found.select(F.col("column_a").alias("column"), F.abs("corr").alias("abs_corr")).orderBy(
        F.desc_nulls_last("abs_corr"), "column"
    )
    return ranked if top is None else ranked.limit(top)


def high_correlation(
    df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 0.95, target: str | None = None
) -> DataFrame:
    """Pairs with ``|corr|`` above the threshold; ``leakage`` marks pairs with the target."""
    names = numeric_columns(df) if columns is None else list(columns)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    found = correlations(df, pairs).where(F.abs("corr") > threshold)
    if target is None:
        return found
    return found.withColumn("leakage", (F.col("column_a") == target) | (F.col("column_b") == target))


def skewness_table(df: DataFrame, columns: Sequence[str] | None = None, above: float | None = None) -> DataFrame:
    """``(column, skew)`` with bias correction, largest first; ``above`` keeps ``|skew| > above``."""
    names = numeric_columns(df) if columns is None else list(columns)
    aggs = []
    for i, c in enumerate(names):
        x = number(df, c)
        n = F.count(x).cast("double")
        unbiased = F.sqrt(n * (n - 1)) / (n - 2) * no_nan_skew(x)
        aggs.append(F.when(n >= 3, unbiased).alias(f"s{i}"))
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("skew")) for i, c in enumerate(names)]
    table = _rows(df.agg(*aggs), rows)
    if above is not None:
        table = table.where(F.abs("skew") > above)
    return table.orderBy(F.desc_nulls_last("skew"), "column")


def no_nan_skew(x: Column) -> Column:
    """Population skewness; a constant column counts as symmetric."""
    return F.when(F.var_pop(x) == 0, F.lit(0.0)).otherwise(F.skewness(x))
