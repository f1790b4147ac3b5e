import math

import pytest
from pyspark.sql import functions as F

import rowloom.operators.quantile as quantile
from rowloom.operators import profile, series_profile
from rowloom.operators.quantile import quantiles, sorted_quantiles
from rowloom.operators.series_features import time_deltas


def test_summary_and_skewness(spark):
    df = spark.createDataFrame([(y,) for y in (1.0, 2.0, 2.0, 10.0, 50.0, None, math.nan)], "y double")
    row = profile.numeric_summary(df).first()
    assert (row["count"], row["mean"], row["q25"], row["q50"], row["q75"]) == (5, 13.0, 2.0, 2.0, 10.0)
    assert row["std"] == pytest.approx(21.0, abs=0.1)
    assert profile.skewness_table(df).first()["skew"] == pytest.approx(2.080229, abs=1e-6)
    assert profile.skewness_table(df, above=3.0).count() == 0
    assert profile.skewness_table(df.limit(2)).first()["skew"] is None
    approx = profile.numeric_summary(df, approx=True).first()
    assert approx["q50"] == 2.0


@pytest.mark.parametrize("whole, plain_rows, share", [(50_000, 10**6, 0.1), (100, 10**6, 0.5), (100, 50, 0.5), (100, 50, 0.002), (100, 50, 0.0)])
def test_quantiles_whatever_the_plan(skewed, monkeypatch, whole, plain_rows, share):
    monkeypatch.setattr(quantile, "WHOLE_ROWS", whole)
    monkeypatch.setattr(quantile, "PLAIN_ROWS", plain_rows)
    monkeypatch.setattr(quantile, "SHARE", share)
    qs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = skewed.withColumns({"u": F.col("event_id") * 1.5, "n": F.lit(None).cast("double")})
    values = sorted(r["v"] for r in df.select("v").collect())
    at = lambda vs, q: vs[math.floor((len(vs) - 1) * q)] * (1 - ((len(vs) - 1) * q) % 1) + vs[
        math.ceil((len(vs) - 1) * q)
    ] * (((len(vs) - 1) * q) % 1)
    got = quantiles(df, ["v", "u", "n"], qs)
    assert got["v"] == pytest.approx([at(values, q) for q in qs])
    assert got["u"] == pytest.approx([1.5 * 2999 * q for q in qs])
    assert got["n"] == [None] * len(qs)


def test_summary_of_a_large_table_reads_it_twice(spark, monkeypatch):
    """Values far from zero, infinities, a constant and an empty column; and how often rows are made."""
    monkeypatch.setattr(profile, "WHOLE_ROWS", 100)
    monkeypatch.setattr(quantile, "SHARE", 0.2)
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    df = spark.range(0, 5000, 1, 3).selectExpr(
        "1e9D + id % 1000 as far", "case when id = 17 then double('Infinity') else id end as ends",
        "7 as same", "cast(null as double) as none", "case when id = 3 then double('NaN') else id * 0.5D end as half",
    )
    rows = {r.column: r for r in profile.numeric_summary(df.mapInArrow(count, df.schema)).collect()}
    assert made.value <= 2 * 5000 + 3 * quantile._PILOT_ROWS * 4
    far = rows["far"]
    assert (far["count"], far["min"], far.q25, far.q50, far.max) == (5000, 1e9, 1e9 + 249.75, 1e9 + 499.5, 1e9 + 999)
    assert far["mean"] == pytest.approx(1e9 + 499.5, rel=1e-15) and far["std"] == pytest.approx(288.704, abs=1e-3)
    assert rows["ends"].max == math.inf and rows["ends"].q50 == pytest.approx(2500.5, abs=1)
    assert (rows["same"].q25, rows["same"]["std"], rows["same"].max) == (7.0, 0.0, 7.0)
    assert rows["none"]["count"] == 0 and rows["none"].q50 is None and rows["none"]["mean"] is None
    assert rows["half"]["count"] == 4999


def test_sorted_quantiles_of_repeated_values(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 999, 1.0).otherwise(math.inf).alias("x"))
    got = {r["q"]: r["value"] for r in sorted_quantiles(df, ["x"], [0.5, 1.0], block_rows=1).collect()}
    assert got == {0.5: 1.0, 1.0: math.inf}


def test_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0, 7), (2.0, None, 7), (3.0, 2.0, 7), (4.0, 9.0, 7)], "a double, b double, c int")
    found = {(r["column_a"], r["column_b"]): r["corr"] for r in profile.correlation_matrix(df).collect()}
    assert found[("a", "b")] == found[("b", "a")] == pytest.approx(0.826033, abs=1e-6)
    assert found[("a", "a")] == pytest.approx(1.0) and found[("a", "c")] is None and len(found) == 9
    ranked = profile.target_correlation(df, "b").collect()
    assert [r["column"] for r in ranked] == ["a", "c"]
    pairs = profile.high_correlation(df, threshold=0.8, target="b").collect()
    assert [(r["column_a"], r["column_b"], r["leakage"]) for r in pairs] == [("a", "b", True)]


def test_histogram(spark):
    four = spark.createDataFrame([(float(i),) for i in range(4)], "x double")
    assert [r["count"] for r in profile.histogram(four, "x", 3).orderBy("bin").collect()] == [1, 1, 2]
    same = spark.createDataFrame([(5.0,)] * 3 + [(None,)], "x double")
    rows = profile.histogram(same, "x", 4).orderBy("bin").collect()
    assert sum(r["count"] for r in rows) == 3 and rows[0]["lower"] == 4.5 and rows[3]["upper"] == 5.5
    sparse = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    assert [r["count"] for r in profile.histogram(sparse, "x", 5).orderBy("bin").collect()] == [1, 0, 0, 0, 1]


def test_counts(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", math.nan), (None, 2.0), ("b", 2.0)], "s string, x double")
    missing = [(r["column"], r["missing_count"], r["missing_pct"]) for r in profile.missing_table(df).collect()]
    assert missing == [("s", 1, 25.0), ("x", 1, 25.0)]
    assert [(r["column"], r["n_unique"]) for r in profile.distinct_counts(df).collect()] == [("s", 2), ("x", 2)]
    assert [tuple(r) for r in profile.value_counts(df, "s").collect()] == [("a", 2), ("b", 1), (None, 1)]
    assert [tuple(r) for r in profile.value_counts(df, "x", top=1).collect()] == [(2.0, 2)]
    assert {r["column"]: r["non_missing"] for r in profile.schema_table(df).collect()} == {"s": 3, "x": 3}
    assert {r["dtype"]: r["n_columns"] for r in profile.dtype_counts(df).collect()} == {"string": 1, "double": 1}
    empty = profile.missing_table(df.limit(0)).first()
    assert empty["missing_count"] == 0 and empty["missing_pct"] is None


def test_gaps(hourly):
    gappy = hourly.where(~F.hour("timestamp").isin(5, 6))
    deltas = time_deltas(gappy, "timestamp", tie_breakers=[])
    gaps = series_profile.large_gaps(deltas).collect()
    assert [(r["delta_seconds"], r["threshold"]) for r in gaps] == [(10800.0, 5400.0)]
    assert tuple(series_profile.common_deltas(deltas).first()) == (3600.0, 8)
    assert series_profile.large_gaps(deltas.limit(0)).count() == 0
