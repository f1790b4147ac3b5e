"""Headline workloads, timed warm; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per workload, default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowloom.operators import profile, series_profile, splits
from rowloom.operators.preprocess import PreprocessSpec, fit_preprocessor
from rowloom.operators.row_features import RowFeatures, build_row_features
from rowloom.operators.series_features import SeriesFeatures, build_series_features, time_deltas
from rowloom.operators.windows import sliding_windows
from rowloom.session import local_session, written

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def row_features(spark):
    spec = RowFeatures(
        ["l_shipdate"],
        ["l_quantity"],
        {"unit_price": ("l_extendedprice", "l_quantity")},
        {},
        {"charge": ("l_extendedprice", "l_tax")},
    )
    yield build_row_features(scan(spark, "lineitem"), spec)


def _series(spark, group, strategy):
    spec = SeriesFeatures(
        "ts",
        group,
        lag_features={"lag_1": ("value", 1)},
        diff_features={"diff_1": ("value", 1)},
        rolling_features={
            f"{agg}_{n}": ("value", n, agg) for n in (7, 30) for agg in ("mean", "std", "max")
        },
        rolling_min_periods=1,
        tie_breakers=["event_id"],
    )
    events = scan(spark, "events").select("event_id", "ts", "user_id", "value")
    yield build_series_features(events, spec, strategy, segment_rows=20_000)


def series_features(spark):
    yield from _series(spark, "user_id", "auto")


def one_series_single_task(spark):
    yield from _series(spark, None, "plain")


def one_series_divided(spark):
    yield from _series(spark, None, "segments")


def sliding(spark):
    yield sliding_windows(
        scan(spark, "events"), 30, "ts", 7, 1, ["value"], "value", "user_id", "event_id"
    )


def preprocess(spark):
    part = scan(spark, "part")
    spec = PreprocessSpec(
        numeric_features=["p_size", "p_retailprice"], categorical_features=["p_brand", "p_type"]
    )
    yield fit_preprocessor(part, spec).transform(part)


def table_profile(spark):
    lines = scan(spark, "lineitem")
    yield profile.numeric_summary(lines)
    yield profile.missing_table(lines)
    yield profile.distinct_counts(lines)
    yield profile.correlation_matrix(lines)
    yield profile.skewness_table(lines)


def stratified_split(spark):
    yield splits.stratified_split(scan(spark, "orders"), "o_orderpriority", 0.2, 42, "o_orderkey")


def series_profiles(spark):
    events = scan(spark, "events")
    deltas = written(time_deltas(events, "ts", "user_id", "event_id"), "deltas")
    yield series_profile.coverage(events, "ts", "user_id")
    yield series_profile.delta_summary(deltas)
    yield series_profile.large_gaps(deltas)
    yield series_profile.seasonal_means(events, "ts", "value", "hour")


WORKLOADS = {
    "p1_row_features": row_features,
    "p2_series_features": series_features,
    "p3_one_series_single_task": one_series_single_task,
    "p3_one_series_divided": one_series_divided,
    "p4_sliding_windows": sliding,
    "p5_preprocess": preprocess,
    "p6_table_profile": table_profile,
    "p7_stratified_split": stratified_split,
    "p8_series_profile": series_profiles,
}


def run(spark: SparkSession, workload) -> float:
    start = time.perf_counter()
    for df in workload(spark):
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    timed = {}
    for name, workload in WORKLOADS.items():
        run(spark, workload)  # warm: code generation and file cache
        timed[name] = round(statistics.median(run(spark, workload) for _ in range(RUNS)), 3)
    rows = scan(spark, "lineitem").agg(F.count("*")).first()[0]
    print(
        json.dumps(
            {
                "metric": "sum of median warm workload times",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "lineitem_rows": rows,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
