"""Ordered per-series features, plain and over a divided series."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.functions.coerce import col
from rowloom.operators.ordering import dense_index
from rowloom.operators.series_features import (
    SeriesFeatures,
    build_series_features,
    latest_rows,
    normalize_per_series,
    rolling_band,
    time_deltas,
)
from rowloom.operators.tables import concatenate, first_series, sorted_by
from rowloom.plans.catalog.registry import query, rounded, scan
from rowloom.plans.catalog.row_queries import CALENDAR_SQL

USER = "over (partition by user_id order by ts, event_id)"
ALL = "over (order by ts, event_id)"


def frame(rows: int, scope: str = USER) -> str:
    return scope[:-1] + f" rows between {rows - 1} preceding and current row)"


def events(spark, folder):
    return scan(spark, folder, "events").select("event_id", "ts", "user_id", "value")


def features(spark, folder, strategy="auto", group="user_id", source=None, segment_rows=1500, **what):
    df = events(spark, folder) if source is None else source
    spec = SeriesFeatures("ts", group, tie_breakers=["event_id"], **what)
    return build_series_features(df, spec, strategy, segment_rows=segment_rows)


def made(df, *names):
    return rounded(df.select("event_id", *[col(n) for n in names]))


@query("series_lag", f"select event_id, lag(value, 1) {USER} as lag_1, lag(value, 3) {USER} as lag_3 from events")
def series_lag(spark, folder):
    return made(features(spark, folder, lag_features={"lag_1": ("value", 1), "lag_3": ("value", 3)}), "lag_1", "lag_3")


@query(
    "series_diff",
    f"select event_id, round(value - lag(value, 2) {USER}, 6) + 0.0 as diff_2, "
    f"round(epoch_us(ts - lag(ts) {USER}) / 1e6, 6) as step_seconds from events",
)
def series_diff(spark, folder):
    df = features(spark, folder, diff_features={"diff_2": ("value", 2), "step_seconds": ("ts", 1)})
    return made(df.withColumn("diff_2", F.col("diff_2") + 0.0), "diff_2", "step_seconds")


def _rolling(name: str, call: str, agg: str):
    over = frame(7)

    @query(
        f"series_rolling_{agg}",
        f"select event_id, case when count(value) {over} >= 7 then round({call}(value) {over}, 6) end as {name} from events",
    )
    def run(spark, folder):
        return made(features(spark, folder, rolling_features={name: ("value", 7, agg)}), name)

    return run


for _agg, _call in {"mean": "avg", "sum": "sum", "min": "min", "max": "max", "std": "stddev_samp"}.items():
    _rolling(f"{_agg}_7", _call, _agg)


@query(
    "series_rolling_min_periods",
    f"""with gappy as (select event_id, ts, user_id, case when event_id % 3 <> 0 then value end as value from events)
    select event_id, case when count(value) {frame(5)} >= 2 then round(avg(value) {frame(5)}, 6) end as mean_5,
        case when count(value) {frame(5)} >= 2 then round(stddev_samp(value) {frame(5)}, 6) end as std_5 from gappy""",
)
def series_rolling_min_periods(spark, folder):
    odd = F.when(F.col("event_id") % 6 == 0, F.lit(float("inf"))).when(F.col("event_id") % 3 == 0, F.lit(float("nan")))
    source = events(spark, folder).withColumn("value", odd.otherwise(F.col("value")))
    what = {"mean_5": ("value", 5, "mean"), "std_5": ("value", 5, "std")}
    return made(features(spark, folder, source=source, rolling_features=what, rolling_min_periods=2), "mean_5", "std_5")


_ODD = "case when event_id % 5 not in (0, 3) then value end"


def _wide_sql(scope):
    made_ = []
    for agg, call in {"mean": "avg", "sum": "sum", "min": "min", "max": "max", "std": "stddev_samp"}.items():
        for rows in (150, 400):
            over = frame(rows, scope)
            made_.append(f"case when count(value) {over} >= 60 then round({call}(value) {over}, 6) end as {agg}_{rows}")
    return f"with events as (select event_id, ts, user_id, {_ODD} as value from events) select event_id, {', '.join(made_)} from events"


def _wide_rolling(spark, folder, group, strategy):
    # NaN and infinities are missing values, as in narrow windows.
    odd = F.when(F.col("event_id") % 5 == 0, F.lit(float("-inf"))).when(F.col("event_id") % 5 == 3, F.lit(float("nan")))
    source = events(spark, folder).withColumn("value", odd.otherwise(F.col("value")))
    what = {f"{agg}_{rows}": ("value", rows, agg) for agg in ("mean", "sum", "min", "max", "std") for rows in (150, 400)}
    df = features(spark, folder, strategy, group, source, rolling_features=what, rolling_min_periods=60)
    return made(df, *what)


@query("series_rolling_wide", _wide_sql(USER))
def series_rolling_wide(spark, folder):
    return _wide_rolling(spark, folder, "user_id", "plain")


@query("series_rolling_wide_divided", _wide_sql(ALL))
def series_rolling_wide_divided(spark, folder):
    return _wide_rolling(spark, folder, None, "segments")


@query(
    "series_missing_group",
    """with g as (select event_id, ts, value, nullif(user_id, 8) as user_id from events), w as (select *,
        lag(value) over (partition by user_id order by ts, event_id) as l, sum(value) over (partition by user_id
        order by ts, event_id rows between 2 preceding and current row) as s from g)
    select event_id, case when user_id is not null then l end as lag_1,
        case when user_id is not null then round(s, 6) end as sum_3 from w""",
)
def series_missing_group(spark, folder):
    source = events(spark, folder).withColumn("user_id", F.nullif("user_id", F.lit(8)))
    df = features(
        spark,
        folder,
        source=source,
        lag_features={"lag_1": ("value", 1)},
        rolling_features={"sum_3": ("value", 3, "sum")},
        rolling_min_periods=1,
    )
    return made(df, "lag_1", "sum_3")


@query(
    "series_chained",
    f"""with a as (select *, lag(value, 1) {USER} as lag_1 from events), b as (select *, lag_1 - lag(lag_1, 1) {USER} as move from a)
    select event_id, lag_1, round(move, 6) + 0.0 as move,
        case when count(move) {frame(4)} >= 4 then round(avg(move) {frame(4)}, 6) + 0.0 end as trend from b""",
)
def series_chained(spark, folder):
    df = features(
        spark,
        folder,
        lag_features={"lag_1": ("value", 1)},
        diff_features={"move": ("lag_1", 1)},
        rolling_features={"trend": ("move", 4, "mean")},
    )
    made_ = made(df, "lag_1", "move", "trend")
    return made_.withColumns({c: F.col(c) + 0.0 for c in ("move", "trend")})


WIDE_SQL = f"""select event_id, {CALENDAR_SQL.format(t='ts', c='ts')}, lag(value, 1) {{scope}} as lag_1,
    round(value - lag(value, 1) {{scope}}, 6) + 0.0 as diff_1, round(avg(value) {{f7}}, 6) as mean_7,
    round(stddev_samp(value) {{f7}}, 6) as std_7, round(max(value) {{f30}}, 6) as max_30 from events"""


def wide(spark, folder, strategy="auto", group="user_id", segment_rows=1500):
    df = features(
        spark,
        folder,
        strategy,
        group,
        segment_rows=segment_rows,
        expand_datetime=True,
        lag_features={"lag_1": ("value", 1)},
        diff_features={"diff_1": ("value", 1)},
        rolling_features={
            "mean_7": ("value", 7, "mean"),
            "std_7": ("value", 7, "std"),
            "max_30": ("value", 30, "max"),
        },
        rolling_min_periods=1,
    )
    return rounded(df.withColumn("diff_1", F.col("diff_1") + 0.0).drop("ts", "user_id", "value"))


@query("series_features", WIDE_SQL.format(scope=USER, f7=frame(7), f30=frame(30)))
def series_features(spark, folder):
    return wide(spark, folder)


@query("series_features_divided", WIDE_SQL.format(scope=USER, f7=frame(7), f30=frame(30)))
def series_features_divided(spark, folder):
    return wide(spark, folder, "segments")


@query("series_features_ungrouped", WIDE_SQL.format(scope=ALL, f7=frame(7, ALL), f30=frame(30, ALL)))
def series_features_ungrouped(spark, folder):
    return wide(spark, folder, "segments", group=None)


@query(
    "orders_per_customer",
    """select o_orderkey, lag(o_totalprice) over w as previous, round(avg(o_totalprice) over (partition by o_custkey
        order by o_orderdate, o_orderkey rows between 2 preceding and current row), 4) as mean_3 from orders
        window w as (partition by o_custkey order by o_orderdate, o_orderkey)""",
)
def orders_per_customer(spark, folder):
    spec = SeriesFeatures(
        "o_orderdate",
        "o_custkey",
        lag_features={"previous": ("o_totalprice", 1)},
        rolling_features={"mean_3": ("o_totalprice", 3, "mean")},
        rolling_min_periods=1,
        tie_breakers=["o_orderkey"],
    )
    df = build_series_features(scan(spark, folder, "orders"), spec)
    return rounded(df.select("o_orderkey", "previous", "mean_3"), 4)


@query("sorted_series", "select user_id, ts, event_id from events order by user_id, ts, event_id")
def sorted_series(spark, folder):
    return sorted_by(events(spark, folder), "user_id", "ts", "event_id").select("user_id", "ts", "event_id")


@query(
    "dense_row_index",
    "select event_id, row_number() over (order by value desc nulls last, event_id) - 1 as row_index from events",
)
def dense_row_index(spark, folder):
    return dense_index(events(spark, folder), [-F.col("value"), F.col("event_id")]).select("event_id", "row_index")


@query(
    "time_deltas",
    f"select * from (select user_id, ts, round(epoch_us(ts - lag(ts) {USER}) / 1e6, 6) as delta_seconds from events) "
    "where delta_seconds is not null",
)
def deltas(spark, folder):
    return rounded(time_deltas(events(spark, folder), "ts", "user_id", "event_id"))


@query(
    "time_deltas_ungrouped",
    f"select * from (select ts, round(epoch_us(ts - lag(ts) {ALL}) / 1e6, 6) as delta_seconds from events) "
    "where delta_seconds is not null",
)
def deltas_ungrouped(spark, folder):
    found = time_deltas(events(spark, folder), "ts", None, "event_id", "segments", segment_rows=1500)
    return rounded(found.select("ts", "delta_seconds"))


@query(
    "rolling_band",
    f"""with w as (select event_id, avg(value) {frame(24)} as m, stddev_samp(value) {frame(24)} as s from events)
    select event_id, round(m, 6) as roll_mean, round(s, 6) as roll_std, round(m - s, 6) as band_low,
        round(m + s, 6) as band_high from w""",
)
def band(spark, folder):
    df = rolling_band(events(spark, folder), "ts", "value", "user_id", 24, "event_id")
    return made(df, "roll_mean", "roll_std", "band_low", "band_high")


@query(
    "normalized_per_series",
    """select event_id, round((value - avg(value) over (partition by user_id)) /
        nullif(stddev_pop(value) over (partition by user_id), 0), 6) + 0.0 as value__norm from events""",
)
def normalized(spark, folder):
    df = normalize_per_series(events(spark, folder), ["value"], "user_id")
    return made(df, "value__norm").withColumn("value__norm", F.col("value__norm") + 0.0)


@query(
    "latest_rows_per_series",
    "select event_id, user_id from events qualify row_number() over (partition by user_id order by ts desc, event_id) <= 20",
)
def latest(spark, folder):
    return latest_rows(events(spark, folder), "ts", 20, "user_id", "event_id").select("event_id", "user_id")


@query(
    "first_series_rows",
    "select event_id, user_id from events where user_id in (select distinct user_id from events order by 1 limit 3)",
)
def first_rows(spark, folder):
    return first_series(events(spark, folder), "user_id", 3).select("event_id", "user_id")


@query(
    "concatenated_parts",
    "select event_id, value, null::varchar as event_type from events where value > 5 union all "
    "select event_id, null, event_type from events where value <= 5",
)
def concatenated(spark, folder):
    df = scan(spark, folder, "events")
    high = df.where("value > 5").select("event_id", "value")
    low = df.where("value <= 5").select("event_id", "event_type")
    return concatenate([high, low])
