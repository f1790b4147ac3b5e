import dataclasses
import math

import pytest
from pyspark.sql import functions as F

import rowloom.operators.ordering as ordering
from conftest import column, plan_of
from rowloom.errors import DataError
from rowloom.operators.ordering import dense_index
from rowloom.operators.series_features import (
    SeriesFeatures,
    build_series_features,
    latest_rows,
    normalize_per_series,
    time_deltas,
)


def rolled(df, agg, rows, least, **how):
    spec = SeriesFeatures(
        order_by="i", rolling_features={"r": ("v", rows, agg)}, rolling_min_periods=least, tie_breakers=[]
    )
    return column(build_series_features(df, spec, **how), "r", "i")


@pytest.mark.parametrize("how", [{"strategy": "plain"}, {"strategy": "segments", "segment_rows": 2}])
def test_rolling_with_gaps_and_infinity(spark, how):
    rows = [(1, 1.0), (2, None), (3, 3.0), (4, math.inf), (5, 5.0), (6, 6.0)]
    df = spark.createDataFrame(rows, "i int, v double")
    assert rolled(df, "sum", 2, 1, **how) == [1, 1, 3, 3, 5, 11]
    assert rolled(df, "std", 2, 1, **how)[:5] == [None] * 5
    assert rolled(df, "std", 2, 1, **how)[5] == pytest.approx(0.7071067812)
    assert rolled(df, "mean", 2, None, **how) == [None] * 5 + [5.5]
    empty = spark.createDataFrame([(1, None), (2, None), (3, 3.0)], "i int, v double")
    assert rolled(empty, "sum", 2, 0, **how) == [0.0, 0.0, 3.0]
    assert rolled(empty, "mean", 2, 0, **how) == [None, None, 3.0]


@pytest.mark.parametrize("how", [{"strategy": "plain"}, {"strategy": "segments", "segment_rows": 2}])
def test_rows_without_series(spark, how):
    df = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "a", 3), (4, None, 4), (5, "b", 5)], "i int, g string, v int")
    spec = SeriesFeatures(
        group_column="g",
        order_by="i",
        lag_features={"l": ("v", 1)},
        diff_features={"d": ("v", 1)},
        rolling_features={"s": ("v", 2, "sum")},
        rolling_min_periods=1,
    )
    out = build_series_features(df, spec, **how)
    assert column(out, "l", "i") == [None, None, 1, None, None]
    assert column(out, "d", "i") == [None, None, 2, None, None]
    assert column(out, "s", "i") == [1, None, 4, None, 5]


def test_divided_series_equal_plain(skewed):
    spec = SeriesFeatures(
        "t",
        "series",
        expand_datetime=True,
        drop_original_datetime=True,
        lag_features={"l": ("v", 3), "v": ("v", 1), "ll": ("l", 2)},
        diff_features={"d": ("ll", 2)},
        rolling_features={"m": ("d", 5, "mean"), "x": ("v", 9, "max")},
        tie_breakers=["event_id"],
    )
    plain = build_series_features(skewed, spec, "plain")
    cut = build_series_features(skewed, spec, "segments", segment_rows=50)
    assert plain.columns == cut.columns and "t" not in plain.columns
    assert plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0


def test_auto_divides_only_long_series(skewed):
    spec = SeriesFeatures("t", "series", lag_features={"l": ("v", 1)}, tie_breakers=["event_id"])
    assert "__segment" not in plan_of(build_series_features(skewed, spec))
    assert "__segment" in plan_of(build_series_features(skewed, spec, max_series_rows=500))


def test_one_window_and_one_shuffle_for_many_features(skewed):
    spec = SeriesFeatures(
        "t",
        "series",
        lag_features={"l": ("v", 1)},
        diff_features={"d": ("v", 2)},
        rolling_features={"m": ("v", 7, "mean"), "s": ("v", 30, "std")},
        tie_breakers=["event_id"],
    )
    plan = plan_of(build_series_features(skewed, spec, "plain"))
    assert plan.count("Exchange") == 1 and plan.count("+- Window") == 1 and plan.count("+- Sort") == 1


def test_ungrouped_series_has_no_single_task_over_rows(skewed):
    spec = SeriesFeatures("t", lag_features={"l": ("v", 1)}, tie_breakers=["event_id"])
    out = build_series_features(skewed, spec, "segments", segment_rows=100)
    window = plan_of(out).split("Window [lag")[1]
    assert "__segment" in window.split("\n")[0]
    assert out.count() == 3000


def test_partitioning_does_not_matter(spark):
    rows = [(f"2020-01-0{1 + i // 2}", i, float(i * i)) for i in range(8)]
    df = spark.createDataFrame(rows, "t string, id int, v double")
    spec = SeriesFeatures("t", diff_features={"d": ("v", 1)})
    results = [column(build_series_features(df.repartition(n), spec), "d", "id") for n in (1, 7)]
    assert results[0] == results[1] == [None, 1.0, 3.0, 5.0, 7.0, 9.0, 11.0, 13.0]


@pytest.mark.parametrize(
    "spec, code",
    [
        (dict(datetime_column="absent"), "ts_missing_datetime_column"),
        (dict(group_column="absent"), "ts_missing_group_column"),
        (dict(lag_features={"x": ("absent", 1)}), "ts_missing_lag_source"),
        (dict(lag_features={"x": ("v", 0)}), "ts_invalid_lag"),
        (dict(diff_features={"x": ("absent", 1)}), "ts_missing_diff_source"),
        (dict(diff_features={"x": ("v", -1)}), "ts_invalid_diff_lag"),
        (dict(diff_features={"x": ("s", 1)}), "ts_invalid_diff_source"),
        (dict(rolling_features={"x": ("absent", 2, "sum")}), "ts_missing_rolling_source"),
        (dict(rolling_features={"x": ("v", 0, "sum")}), "ts_invalid_rolling_window"),
        (dict(rolling_features={"x": ("v", 2, "median")}), "ts_invalid_rolling_agg"),
        (dict(rolling_features={"x": ("v", 2, "sum")}, rolling_min_periods=3), "ts_invalid_min_periods"),
        (dict(lag_features={"x": ("v", 1)}, sort_by_time=False), "ts_missing_datetime_column"),
        (dict(lag_features={"x": ("t", 1)}, expand_datetime=True, drop_original_datetime=True), "ts_missing_lag_source"),
    ],
)
def test_error_codes(skewed, spec, code):
    df = skewed.withColumn("s", F.lit("text"))
    with pytest.raises(DataError) as error:
        build_series_features(df, SeriesFeatures(**{"datetime_column": "t", **spec}))
    assert error.value.code == code


def test_dense_index_with_heavy_ties(skewed, monkeypatch):
    copies = skewed.select(F.lit(1).alias("k"), F.col("event_id"))
    monkeypatch.setattr(ordering, "MAX_TIED_ROWS", 100)
    assert ordering.heavy_tie(copies, [F.col("k")])
    assert not ordering.heavy_tie(copies, [F.col("event_id")])
    out = dense_index(copies, [F.col("k")], partitions=4)
    assert out.columns == ["k", "event_id", "row_index"]
    assert sorted(r["row_index"] for r in out.collect()) == list(range(3000))
    assert len(out.inputFiles()) > 2  # the tie was divided


def test_deltas_latest_and_norm(hourly, skewed):
    assert [r["delta_seconds"] for r in time_deltas(hourly, "timestamp", tie_breakers=[]).collect()] == [3600.0] * 11
    kept = latest_rows(skewed, "t", 5, "series", "event_id")
    assert kept.groupBy("series").count().where("count <> 5").count() == 0
    assert "WindowGroupLimit" in plan_of(kept)
    spark = skewed.sparkSession
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        cut = latest_rows(skewed, "t", 5, "series", "event_id", "segments")
        assert kept.exceptAll(cut).count() == 0 and cut.exceptAll(kept).count() == 0
        assert latest_rows(skewed, "t", 7, None, "event_id", "segments").count() == 7
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    normed = normalize_per_series(skewed, ["v"], "series")
    for r in normed.groupBy("series").agg(F.avg("v__norm").alias("m"), F.stddev_pop("v__norm").alias("s")).collect():
        assert abs(r["m"]) < 1e-9 and r["s"] == pytest.approx(1.0)
    flat = normalize_per_series(skewed.withColumn("v", F.lit(5.0)), ["v"], "series")
    assert flat.where("v__norm <> 0").count() == 0


def test_wide_windows_are_the_sliding_ones(spark, monkeypatch):
    import rowloom.operators.series_features as module

    odd = "case when id % 7 = 0 then 'NaN' when id % 11 = 0 then 'Infinity' when id % 5 = 1 then null else cast((id * 37) % 101 as string) end"
    df = spark.range(400).selectExpr(
        "id", "case when id % 3 < 2 then 0 when id % 30 = 2 then null else id % 30 end as k", f"cast({odd} as double) as v"
    )
    aggs = ("mean", "sum", "min", "max", "std")
    rolling = {f"{a}_{w}": ("v", w, a) for a in aggs for w in (1, 2, 9, 1000)}
    rolling |= {"again": ("mean_9", 4, "max"), "v": ("v", 3, "sum"), "last": ("v", 5, "std")}
    for least in (0, 1, None):
        spec = SeriesFeatures(order_by="id", group_column="k", rolling_features=rolling, rolling_min_periods=least, tie_breakers=[])
        if least is not None:
            spec = dataclasses.replace(spec, rolling_features={n: f for n, f in rolling.items() if least <= f[1]})
        found = {}
        for limit in (1, 10**6):
            monkeypatch.setattr(module, "WIDE_ROWS", limit)
            for strategy in ("plain", "segments"):
                made = build_series_features(df, spec, strategy, segment_rows=50)
                found[limit, strategy] = [tuple(r) for r in made.orderBy("id").collect()]
        first = found[1, "plain"]
        for other in found.values():
            assert len(other) == len(first) == 400
            for a, b in zip(first, other):
                assert [x is None for x in a] == [x is None for x in b]
                assert [x for x in a if x is not None] == pytest.approx([x for x in b if x is not None], abs=1e-9)


def test_wide_sums_forget_what_has_left(spark, monkeypatch):
    import rowloom.operators.series_features as module

    monkeypatch.setattr(module, "WIDE_ROWS", 2)
    df = spark.range(30).selectExpr("id", "case when id = 4 then 1e17D else 0.25D end as v")
    spec = SeriesFeatures(order_by="id", rolling_features={"s": ("v", 3, "sum"), "d": ("v", 3, "std")}, tie_breakers=[])
    rows = build_series_features(df, spec, "plain").where("id > 6").collect()
    assert {r.s for r in rows} == {0.75} and {r.d for r in rows} == {0.0}


def test_an_index_works_out_its_input_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    base = spark.range(500).selectExpr("id", "(id * 7919) % 500 as k", "'x' as __order9")
    assert not ordering.costly(base.where("k > 3").withColumn("j", F.col("k") + 1))
    indexed = dense_index(base.mapInArrow(count, base.schema), [F.col("k")])
    assert indexed.columns == ["id", "k", "__order9", "row_index"]
    assert all(r.k == r.row_index for r in indexed.collect()) and made.value == 500
    assert ordering.costly(base.join(base, "id")) and ordering.costly(base.groupBy("k").count())
