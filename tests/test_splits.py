import math

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

import rowloom.operators.splits as splits
from rowloom.errors import DataError
from rowloom.operators.splits import (
    batches,
    chronological_split,
    random_split,
    series_tail_split,
    shuffled_batches,
    stratified_split,
)


def sizes(df, *by):
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy("split", *by).count().collect()}


def held(df, key):
    return {r[key] for r in df.where("split = 'validation'").collect()}


@pytest.mark.parametrize("fraction", [0.2, 0.333, 0.001])
def test_random_split_is_exact_and_reproducible(skewed, fraction):
    parts = random_split(skewed, fraction, 42, "event_id")
    n = math.ceil(3000 * fraction)
    assert sizes(parts) == {("validation",): n, ("train",): 3000 - n}
    again = random_split(skewed.repartition(7), fraction, 42, "event_id")
    assert held(parts, "event_id") == held(again, "event_id")
    assert held(parts, "event_id") != held(random_split(skewed, fraction, 43, "event_id"), "event_id")


@pytest.mark.parametrize("bits, choice", [(12, 10_000), (3, 1), (12, 5)])
def test_selection_is_the_order_of_hashes(spark, skewed, monkeypatch, bits, choice):
    monkeypatch.setattr(splits, "RADIX_BITS", bits)
    monkeypatch.setattr(splits, "CHOICE_ROWS", choice)
    df = skewed.withColumn("c", F.when(F.col("event_id") % 11 > 0, F.col("series")))
    parts = stratified_split(df, "c", 0.3, 5, "event_id")
    rows = parts.select("c", "event_id", "split", F.xxhash64(F.lit(5), "event_id").alias("h")).collect()
    n_val = sizes(parts, "c")
    for c in {r.c for r in rows}:
        own = sorted((r.h, r.event_id) for r in rows if r.c == c)
        wanted = n_val.get(("validation", c), 0)
        assert {r.event_id for r in rows if r.c == c and r.split == "validation"} == {i for _, i in own[:wanted]}
    assert sum(n for (s, _), n in n_val.items() if s == "validation") == 900


def test_hash_splits_move_no_rows(skewed):
    for parts in (random_split(skewed, 0.2), stratified_split(skewed, "series", 0.2)):
        plan = plan_of(parts)
        assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_classes_that_differ_in_nulls_only(spark):
    rows = [(None, "a", i) for i in range(50)] + [("a", None, i) for i in range(50)]
    found = sizes(stratified_split(spark.createDataFrame(rows, "x string, y string, i int"), ["x", "y"], 0.2), "x")
    assert found[("validation", None)] == found[("validation", "a")] == 10


def test_copies_are_divided_exactly(skewed):
    copies = skewed.select(F.lit("same").alias("x"))
    assert sizes(random_split(copies, 0.3)) == {("validation",): 900, ("train",): 2100}
    classes = skewed.select((F.col("event_id") % 3).alias("c"))
    found = sizes(stratified_split(classes, "c", 0.25), "c")
    assert all(found[("validation", c)] == 250 for c in range(3))


@pytest.mark.parametrize("few", [50_000, 0])
def test_stratified_quotas(spark, monkeypatch, few):
    monkeypatch.setattr(splits, "BROADCAST_GROUPS", few)
    df = spark.range(399).selectExpr("id", "case when id < 58 then 0 when id < 60 then null else 1 end as c")
    found = sizes(stratified_split(df, "c", 0.2, 1, "id"), "c")
    assert sum(v for k, v in found.items() if k[0] == "validation") == 80
    # 58, 2 and 339 rows claim 11.63, 0.40 and 67.97 of the 80.
    assert found[("validation", 0)] == 12 and found[("validation", 1)] == 68 and ("validation", None) not in found
    assert found[("train", None)] == 2


def test_chronological_roundings(spark):
    df = spark.range(25).selectExpr("id", "timestamp_seconds(id) as t")
    count = lambda **k: len(held(chronological_split(df, "t", tie_breakers="id", **k), "id"))
    assert count(fraction=0.1) == 2  # 2.5 rounds to the even 2
    assert count(fraction=0.01) == 1
    assert count(fraction=0.3, rounding="floor") == 25 - int((1 - 0.3) * 25)
    assert held(chronological_split(df, "t", 0.2, "id"), "id") == {20, 21, 22, 23, 24}
    missing = df.withColumn("t", F.when(F.col("id") != 0, F.col("t")))
    assert held(chronological_split(missing, "t", 0.1, "id"), "id") == {0, 24}


def test_series_tail(skewed):
    parts = series_tail_split(skewed, "series", "t", 0.2, "event_id")
    for r in parts.groupBy("series").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("k")).collect():
        assert r["k"] == int((1 - 0.2) * r["n"])
    ends = parts.groupBy("series").agg(
        F.max(F.when(F.col("split") == "train", F.struct("t", "event_id"))).alias("a"),
        F.min(F.when(F.col("split") == "validation", F.struct("t", "event_id"))).alias("b"),
    )
    assert ends.where("a >= b").count() == 0


def test_refusals(spark, skewed):
    cases = [
        (lambda: random_split(skewed, 1.0), "split_bad_fraction"),
        (lambda: random_split(skewed, 0.2, 1, "absent"), "split_missing_key"),
        (lambda: random_split(spark.range(1), 0.5), "split_empty_train"),
        (lambda: random_split(spark.range(0), 0.5), "split_empty_table"),
        (lambda: stratified_split(skewed, "absent"), "missing_target_column"),
        (lambda: chronological_split(skewed, "absent"), "ts_missing_datetime_column"),
        (lambda: batches(skewed, 0, "t"), "batch_bad_size"),
    ]
    for call, code in cases:
        with pytest.raises(DataError) as error:
            call()
        assert error.value.code == code


def test_batches(hourly, skewed):
    made = batches(hourly.limit(9), 2, "timestamp")
    counts = {r["batch"]: r["count"] for r in made.groupBy("batch").count().collect()}
    assert counts == {0: 2, 1: 2, 2: 2, 3: 2, 4: 1}
    shuffled = shuffled_batches(skewed, 256, 3, "event_id")
    assert shuffled.select("row_index").distinct().count() == 3000
    assert shuffled.where("row_index <> event_id").count() > 2900
