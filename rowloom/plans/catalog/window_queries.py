"""Sliding windows: their values, one row per element, and their counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import windows
from rowloom.operators.series_features import SeriesFeatures, build_series_features
from rowloom.plans.catalog.registry import query, rounded, scan

W, H = 14, 3


def elements(df, keys):
    """X and y as (place, x) rows; y continues the places of X."""
    flat = windows.flatten_windows(df)
    parts = [c for c in ("X", "y") if c in flat.columns]
    joined = F.concat(*[F.col(c) for c in parts])
    return flat.select(*keys, "start", F.posexplode(joined).alias("place", "x"))


def elements_sql(step: int, series: str | None, span: int = W + H, shown: int | None = None) -> str:
    """Every window of ``span`` rows at each ``step``-th start, ``shown`` elements of it."""
    by = f"partition by {series} " if series else ""
    key = f"{series}, " if series else ""
    match = f"r.{series} = s.{series} and " if series else ""
    out = f"s.{series}, " if series else ""
    return f"""with r as (select {key}value, row_number() over ({by}order by ts, event_id) - 1 as i,
            count(*) over ({by.strip()}) as n from events)
        select {out}s.i as start, (r.i - s.i)::integer as place, r.value as x from r join r s
        on {match}r.i between s.i and s.i + {(shown or span) - 1}
        where s.i % {step} = 0 and s.i + {span} <= s.n"""


def of_events(spark, folder, step=1, series="user_id", **options):
    events = scan(spark, folder, "events").select("event_id", "ts", "user_id", "value")
    options = {"target_column": "value", "feature_type": "double", "target_type": "double", **options}
    return windows.sliding_windows(
        events, W, "ts", H, step, ["value"], series=series, tie_breakers="event_id", **options
    )


@query("sliding_windows", elements_sql(1, "user_id"))
def sliding(spark, folder):
    return elements(of_events(spark, folder), ["user_id"])


@query("sliding_windows_stepped", elements_sql(5, "user_id"))
def stepped(spark, folder):
    return elements(of_events(spark, folder, 5), ["user_id"])


@query("sliding_windows_divided", elements_sql(3, "user_id"))
def divided(spark, folder):
    return elements(of_events(spark, folder, 3, strategy="segments", segment_rows=1000), ["user_id"])


@query("sliding_windows_ungrouped", elements_sql(7, None))
def ungrouped(spark, folder):
    return elements(of_events(spark, folder, 7, None, strategy="segments", segment_rows=1500), [])


@query("sliding_windows_without_target", elements_sql(5, "user_id", shown=W))
def without_target(spark, folder):
    return elements(of_events(spark, folder, 5, target_column=None), ["user_id"])


@query(
    "sliding_windows_past_target",
    f"""with r as (select user_id, value, hour(ts)::double as hour, row_number() over (partition by user_id order by ts, event_id) - 1 as i,
            count(*) over (partition by user_id) as n from events where value >= 1)
        select s.user_id, s.i as start, (r.i - s.i)::integer as step, r.hour, r.value from r join r s
        on r.user_id = s.user_id and r.i between s.i and s.i + {W - 1} where s.i % 10 = 0 and s.i + {W + H} <= s.n""",
)
def past_target(spark, folder):
    events = scan(spark, folder, "events").select(
        "event_id", "ts", "user_id", F.hour("ts").alias("hour"), F.when(F.col("value") >= 1, F.col("value")).alias("value")
    )
    made = windows.sliding_windows(
        events, W, "ts", H, 10, ["hour", "value"], "value", "user_id", "event_id", feature_type="double"
    )
    rows = made.select("user_id", "start", F.posexplode("X").alias("step", "x"))
    return rows.select("user_id", "start", "step", F.col("x")[0].alias("hour"), F.col("x")[1].alias("value"))


@query(
    "window_metadata",
    f"""with n as (select count(*) as t from events group by user_id)
    select sum(case when t >= {W + H} then (t - {W + H}) // 5 + 1 else 0 end)::bigint as num_samples, 1 as num_features,
        1 as num_targets, {W} as input_window, {H} as prediction_horizon, 5 as step_size, true as has_targets,
        sum(t)::bigint as total_length, 'value' as value_column_names, 'value' as target_column_names from n""",
)
def metadata(spark, folder):
    events = scan(spark, folder, "events")
    found = windows.window_metadata(events, W, ["value"], "value", "user_id", H, 5)
    return found.withColumns({c: F.array_join(c, ",") for c in ("value_column_names", "target_column_names")})


def _design_sql() -> str:
    rows = []
    for i, (w, h) in enumerate([(24, 6), (48, 6), (24, 12)]):
        rows.append(
            f"select {i} as candidate, {w} as input_window, {h} as prediction_horizon, "
            f"sum(case when t >= {w + h} then t - {w + h} + 1 else 0 end)::bigint as n_sequences, "
            f"case when max(t) >= {w + h} then '{w},1' end as x_shape, case when max(t) >= {w + h} then '{h},1' end as y_shape from n"
        )
    return "with n as (select count(*) as t from events group by user_id) " + " union all ".join(rows)


@query("window_design", _design_sql())
def design(spark, folder):
    found = windows.window_design(scan(spark, folder, "events"), 24, 6, series="user_id")
    return found.withColumns({c: F.array_join(c, ",") for c in ("x_shape", "y_shape")})


@query("short_series", "select user_id, count(*) as n_points from events group by user_id having count(*) < 64")
def short(spark, folder):
    return windows.short_series(scan(spark, folder, "events"), "user_id", 60, 4)


@query(
    "windows_on_features",
    f"""with f as (select user_id, ts, event_id, value, avg(value) over (partition by user_id order by ts, event_id
            rows between 2 preceding and current row) as m, row_number() over (partition by user_id order by ts, event_id) as k from events),
        r as (select *, row_number() over (partition by user_id order by ts, event_id) - 1 as i,
            count(*) over (partition by user_id) as n from f where k >= 3)
        select s.user_id, s.i as start, (r.i - s.i)::integer as step, round(r.m, 6) as m from r join r s
        on r.user_id = s.user_id and r.i between s.i and s.i + {W - 1} where s.i % 10 = 0 and s.i + {W + 1} <= s.n""",
)
def on_features(spark, folder):
    spec = SeriesFeatures("ts", "user_id", rolling_features={"m": ("value", 3, "mean")}, tie_breakers=["event_id"])
    featured = build_series_features(scan(spark, folder, "events"), spec)
    made = windows.sliding_windows(
        featured, W, "ts", 1, 10, ["m"], "value", "user_id", "event_id", feature_type="double"
    )
    rows = made.select("user_id", "start", F.posexplode(F.flatten("X")).alias("step", "m"))
    return rounded(rows)
