import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from rowloom.functions.coerce import parsed_time, seconds_between
from rowloom.operators import encodings, profile, segments, series_profile
from rowloom.operators.series_features import latest_rows, time_deltas
from rowloom.plans.catalog.stream_queries import drained, stream_of


@pytest.fixture(scope="module")
def train(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 7.0)]
    return spark.createDataFrame(rows, "c string, y double")


def coded(encoding, df, name):
    return {r["c"]: r[name] for r in encoding.transform(df).collect()}


def test_frequency(spark, train):
    test = spark.createDataFrame([("a",), ("z",), (None,), ("-",)], "c string")
    assert coded(encodings.fit_frequency(train, "c"), test, "c__frequency") == {"a": 0.5, "z": 0.0, None: 0.25, "-": 0.0}
    assert coded(encodings.fit_frequency(train.limit(0), "c"), test, "c__frequency")["a"] == 0.0


def test_target_mean(spark, train):
    test = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    found = coded(encodings.fit_target_mean(train, "c", "y", smoothing=2.0), test, "c__target_mean")
    assert found == pytest.approx({"a": (4 + 8) / 4, "b": (5 + 8) / 3, "z": 4.0, None: (7 + 8) / 3})


def test_bins(spark):
    df = spark.createDataFrame([(float(i),) for i in range(8)] + [(None,)], "x double")
    place = lambda b: [r["x__bin"] for r in b.transform(df).orderBy(F.asc_nulls_last("x")).collect()]
    assert place(encodings.fit_bins(df, "x", 2)) == [0] * 4 + [1] * 4 + [None]
    assert place(encodings.fit_bins(df, "x", 7, "width")) == [0, 1, 2, 3, 4, 5, 6, 6, None]
    with pytest.raises(ValueError):
        encodings.fit_bins(df, "x", 2, "other")


@pytest.fixture(scope="module")
def gappy(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("s", start + dt.timedelta(hours=h), float(h) if h != 1 else None) for h in (0, 1, 2, 10, 11, 30)]
    return spark.createDataFrame(rows + [("t", start, 1.0)], "k string, t timestamp_ntz, v double")


def test_gap_segments(gappy):
    cut = segments.gap_segments(gappy, "t", 3600.0, "k")
    assert [r.segment for r in cut.where("k = 's'").orderBy("t").collect()] == [0, 0, 0, 1, 1, 2]
    assert segments.drop_short_segments(cut, 2, "k").count() == 5
    filled = segments.interpolate(cut, "t", "v", "k").where("k = 's'").orderBy("t").collect()
    assert [r["v__filled"] for r in filled] == [0.0, 1.0, 2.0, 10.0, 11.0, 30.0]
    summary = series_profile.gap_summary(time_deltas(gappy, "t", "k")).first()
    assert (summary.n_deltas, summary.n_gaps, summary.longest_gap, summary.total_gap) == (5, 2, 68400.0, 97200.0)


@pytest.mark.parametrize("series", [["k"], []])
def test_gaps_in_pieces_are_those_of_whole_series(spark, series):
    """A hot series, a missing series and time, ties, and long stretches without a value."""
    df = spark.range(900).selectExpr(
        "id",
        "case when id % 3 < 2 then 'hot' when id % 50 = 2 then null else concat('k', id % 5) end as k",
        "case when id % 97 <> 0 then timestamp_seconds(1700000000 + (id div 2) * 60 + (id div 40) * 500) end as t",
        "case when id % 7 = 0 and id % 400 < 250 then cast(id as double) when id % 13 = 0 then double('NaN') end as v",
    )
    series = series or None
    found = []
    for how in ({"strategy": "plain"}, {"strategy": "segments", "segment_rows": 25}):
        cut = segments.gap_segments(df, "t", 300.0, series, "id", **how)
        filled = segments.interpolate(cut, "t", "v", series, **how)
        plan = plan_of(filled)
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
        found.append({r.id: (r.segment, r["v__filled"]) for r in filled.collect()})
    plain, pieces = found
    assert len(plain) == 900 and max(s for s, _ in plain.values()) > 10
    assert {i: s for i, (s, _) in plain.items()} == {i: s for i, (s, _) in pieces.items()}
    assert {i: x for i, (_, x) in plain.items()} == pytest.approx({i: x for i, (_, x) in pieces.items()}, nan_ok=True)
    assert sum(x is not None for _, x in plain.values()) > 100
    empty = segments.interpolate(segments.gap_segments(df.limit(0), "t", 1.0, series, "id", **_PIECES), "t", "v", series, **_PIECES)
    assert empty.isEmpty()


_PIECES = {"strategy": "segments", "segment_rows": 10}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session(spark, zone):
    """A night when clocks change in New York."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-03-10 01:00:00",), ("2024-03-10 02:30:00",), ("2024-03-10 04:00:00",), ("x",)], "t string")
        times = df.select("t", parsed_time("t").alias("p"), parsed_time("t", "yyyy-MM-dd HH:mm:ss").alias("f")).where("p is not null")
        assert times.where("cast(p as string) <> t or cast(f as string) <> t").isEmpty() and times.count() == 3
        ends = times.agg(F.min("p").alias("a"), F.max("p").alias("b")).select(seconds_between(F.col("b"), F.col("a")))
        assert ends.first()[0] == 10800.0
        zoned = spark.createDataFrame([("2024-03-10T02:30:00+01:00",)], "t string").select(parsed_time("t").cast("string")).first()[0]
        assert zoned == "2024-03-10 01:30:00"
        named = {
            "2024-07-01 10:00:00 America/New_York": "2024-07-01 14:00:00",
            "2024-01-01 10:00:00 America/New_York": "2024-01-01 15:00:00",
            "2024-01-01 10:00:00 EST": "2024-01-01 15:00:00",
            "2024-01-01 10:00:00 GMT+5": "2024-01-01 05:00:00",
            "2024-01-01T10:00Z": "2024-01-01 10:00:00",
            "2024-01-01 10:00 +05:30": "2024-01-01 04:30:00",
            "2024-01-01 10:00:00 No/Such": None,
            "2024-01-01 10:00": "2024-01-01 10:00:00",
            "2024-01-01": "2024-01-01 00:00:00",
        }
        texts = spark.createDataFrame([(t,) for t in named], "t string")
        assert {r.t: r.p for r in texts.select("t", parsed_time("t").cast("string").alias("p")).collect()} == named
        steps = time_deltas(df.where("t <> 'x'").withColumn("k", F.lit(1)), "t", "k").orderBy("t").collect()
        assert [r.delta_seconds for r in steps] == [5400.0, 5400.0]
        dates = spark.createDataFrame([(1, "2024-1-3"), (1, "2024-1-10"), (1, "2024-1-9")], "k int, t string")
        assert latest_rows(dates, "t", 1, "k", strategy="plain").first().t == "2024-1-10"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_infinities_have_a_bin_of_their_own(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (float("inf"),), (float("nan"),), (None,)], "x double")
    rows = {r.bin: r for r in profile.histogram(df, "x", 2, infinite=True).collect()}
    assert [rows[i]["count"] for i in (0, 1, 2)] == [1, 1, 2] and (rows[1].lower, rows[2].upper) == (0.0, 2.0)


def test_tables_as_files_and_as_folders_stream_alike(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id * 2 as x")
    df.repartition(3).write.parquet(str(tmp_path / "folder" / "t.parquet"))
    df.coalesce(1).write.parquet(str(tmp_path / "made"))
    (tmp_path / "file").mkdir()
    next((tmp_path / "made").glob("part-*")).rename(tmp_path / "file" / "t.parquet")
    df.write.parquet(str(tmp_path / "folder" / "t.parquet_old"))
    for kind in ("folder", "file"):
        assert drained(spark, stream_of(spark, str(tmp_path / kind), "t"), kind).exceptAll(df).isEmpty()
        assert drained(spark, stream_of(spark, str(tmp_path / kind), "t"), kind).count() == 100
