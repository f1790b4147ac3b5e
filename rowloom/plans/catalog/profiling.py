"""Table and series profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import profile, quantile, segments, series_profile, tables
from rowloom.operators.series_features import time_deltas
from rowloom.plans.catalog.registry import query, rounded, scan

LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
    "l_linestatus l_shipdate"
).split()
LINE_TYPES = dict(
    zip(LINE_COLUMNS, "bigint bigint bigint int double double double double string string timestamp_ntz".split())
)


def gappy_lines(spark, folder):
    """Line items with missing discounts, taxes and flags."""
    return scan(spark, folder, "lineitem").withColumns(
        {
            "l_discount": F.nullif("l_discount", F.lit(0.0)),
            "l_tax": F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")),
            "l_returnflag": F.nullif("l_returnflag", F.lit("R")),
        }
    )


GAPPY = """gappy as (select *replace (nullif(l_discount, 0) as l_discount, nullif(l_tax, 0) as l_tax,
    nullif(l_returnflag, 'R') as l_returnflag) from lineitem)"""


def union(parts):
    return " union all ".join(parts)


@query(
    "schema_table",
    f"with {GAPPY} "
    + union(f"select '{c}' as \"column\", '{t}' as dtype, count({c}) as non_missing from gappy" for c, t in LINE_TYPES.items()),
)
def schema_table(spark, folder):
    return profile.schema_table(gappy_lines(spark, folder))


@query(
    "missing_table",
    f"with {GAPPY} "
    + union(
        f"select '{c}' as \"column\", count(*) - count({c}) as missing_count, "
        f"round((count(*) - count({c})) * 100.0 / count(*), 6) as missing_pct from gappy"
        for c in LINE_COLUMNS
    ),
)
def missing_table(spark, folder):
    return rounded(profile.missing_table(gappy_lines(spark, folder)))


@query(
    "distinct_counts",
    f"with {GAPPY} " + union(f"select '{c}' as \"column\", count(distinct {c}) as n_unique from gappy" for c in LINE_COLUMNS),
)
def distinct_counts(spark, folder):
    return profile.distinct_counts(gappy_lines(spark, folder))


@query("distinct_values", f"with {GAPPY} select distinct l_tax from gappy")
def distinct_values(spark, folder):
    return profile.distinct_values(gappy_lines(spark, folder), "l_tax")


@query("value_counts", f"with {GAPPY} select l_returnflag, count(*) as count from gappy group by l_returnflag")
def value_counts(spark, folder):
    return profile.value_counts(gappy_lines(spark, folder), "l_returnflag")


@query(
    "class_summary",
    "select quality, count(*) as n_rows, round(count(*) / (select count(*) from labels), 6) as share, "
    "round(avg(toxic), 6) as mean_toxic from labels group by quality",
)
def class_summary(spark, folder):
    return rounded(profile.class_summary(scan(spark, folder, "labels"), "quality", ["toxic"]))


def _summary_sql(digits: int) -> str:
    parts = []
    for c in LINE_NUMBERS:
        quartile = lambda q: f"round(quantile_cont({c}, {q}), {digits})"
        parts.append(
            f"select '{c}' as \"column\", count({c}) as count, round(avg({c}), {digits}) as mean, "
            f"round(stddev_samp({c}), {digits}) as std, round(min({c}), {digits}) as min, {quartile(0.25)} as q25, "
            f"{quartile(0.5)} as q50, {quartile(0.75)} as q75, round(max({c}), {digits}) as max from gappy"
        )
    return f"with {GAPPY} " + union(parts)


@query("numeric_summary", _summary_sql(4))
def numeric_summary(spark, folder):
    return rounded(profile.numeric_summary(gappy_lines(spark, folder), LINE_NUMBERS), 4)


@query(
    "sorted_quantiles",
    f"with {GAPPY} "
    + union(
        f"select '{c}' as \"column\", {q}::double as q, round(quantile_cont({c}, {q}), 4) as value from gappy"
        for c in LINE_NUMBERS
        for q in (0.05, 0.25, 0.5, 0.75, 0.95)
    ),
)
def sorted_quantiles(spark, folder):
    qs = (0.05, 0.25, 0.5, 0.75, 0.95)
    return rounded(quantile.sorted_quantiles(gappy_lines(spark, folder), LINE_NUMBERS, qs, block_rows=1000), 4)


def _histogram_sql(table: str, column: str, bins: int) -> str:
    place = f"least(floor((x - lo) / ((hi - lo) / {bins}))::bigint + 1, {bins})"
    return f"""with v as (select {column} as x from {table} where {column} is not null),
        e as (select min(x) as lo, max(x) as hi from v),
        b as (select {place} as bin, count(*) as n from v, e group by 1)
        select r.i as bin, round(lo + (hi - lo) / {bins} * (r.i - 1), 4) as lower,
            round(lo + (hi - lo) / {bins} * r.i, 4) as upper, coalesce(n, 0) as count
        from range(1, {bins + 1}) r(i) cross join e left join b on b.bin = r.i"""


@query("histogram", _histogram_sql("orders", "o_totalprice", 30))
def histogram(spark, folder):
    return rounded(profile.histogram(scan(spark, folder, "orders"), "o_totalprice", 30), 4)


def _corr_sql(columns, pairs) -> str:
    return f"with {GAPPY} " + union(
        f"select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 6) + 0.0 as corr from gappy" for a, b in pairs
    )


@query("correlation_matrix", _corr_sql(LINE_NUMBERS, [(a, b) for a in LINE_NUMBERS for b in LINE_NUMBERS]))
def correlation_matrix(spark, folder):
    found = rounded(profile.correlation_matrix(gappy_lines(spark, folder), LINE_NUMBERS))
    return found.withColumn("corr", F.col("corr") + 0.0)


@query(
    "target_correlation",
    f"with {GAPPY}, c as ("
    + union(
        f"select '{c}' as \"column\", round(abs(corr({c}, l_extendedprice)), 6) as abs_corr from gappy"
        for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey")
    )
    + ') select * from c order by abs_corr desc, "column" limit 20',
)
def target_correlation(spark, folder):
    columns = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey"]
    return rounded(profile.target_correlation(gappy_lines(spark, folder), "l_extendedprice", columns, top=20))


@query(
    "high_correlation",
    f"""with {GAPPY}, g as (select *, l_quantity * 1.1 + l_linenumber / 100.0 as l_volume from gappy), c as ("""
    + union(
        f"select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 6) as corr from g"
        for a, b in (
            ("l_quantity", "l_extendedprice"),
            ("l_quantity", "l_volume"),
            ("l_extendedprice", "l_volume"),
        )
    )
    + ") select *, column_a = 'l_volume' or column_b = 'l_volume' as leakage from c where abs(corr) > 0.95",
)
def high_correlation(spark, folder):
    lines = gappy_lines(spark, folder).withColumn("l_volume", F.col("l_quantity") * 1.1 + F.col("l_linenumber") / 100.0)
    columns = ["l_quantity", "l_extendedprice", "l_volume"]
    return rounded(profile.high_correlation(lines, columns, 0.95, "l_volume"))


@query(
    "skewness_table",
    f"with {GAPPY} "
    + union(f"select '{c}' as \"column\", round(skewness({c}), 5) + 0.0 as skew from gappy" for c in LINE_NUMBERS),
)
def skewness_table(spark, folder):
    found = rounded(profile.skewness_table(gappy_lines(spark, folder), LINE_NUMBERS), 5)
    return found.withColumn("skew", F.col("skew") + 0.0)


@query(
    "skewed_columns",
    "select 'price_cubed' as \"column\", round(skewness(pow(o_totalprice / 1000, 3)), 5) as skew from orders "
    "having abs(skewness(pow(o_totalprice / 1000, 3))) > 1",
)
def skewed_columns(spark, folder):
    orders = scan(spark, folder, "orders").select(
        "o_totalprice", F.pow(F.col("o_totalprice") / 1000, F.lit(3)).alias("price_cubed")
    )
    return rounded(profile.skewness_table(orders, above=1.0), 5)


@query(
    "problem_types",
    "select 'quality' as target, 'classification' as problem_type, count(distinct quality) as num_classes from labels "
    "union all select 'p_retailprice', 'regression', null from part having count(*) > 0 "
    "union all select 'p_size', case when count(distinct p_size) <= 20 then 'classification' else 'regression' end, "
    "case when count(distinct p_size) <= 20 then count(distinct p_size) end from part "
    "union all select 'p_brand', 'classification', count(distinct p_brand) from part",
)
def problem_types(spark, folder):
    parts = []
    for table, target in (("labels", "quality"), ("part", "p_retailprice"), ("part", "p_size"), ("part", "p_brand")):
        found = tables.infer_problem(scan(spark, folder, table), target)
        parts.append(found.select(F.lit(target).alias("target"), "problem_type", "num_classes"))
    return tables.concatenate(parts)


@query(
    "series_coverage",
    "select user_id, min(ts) as time_min, max(ts) as time_max, count(*) as n_points from events group by user_id",
)
def series_coverage(spark, folder):
    return series_profile.coverage(scan(spark, folder, "events"), "ts", "user_id")


@query(
    "series_overview",
    "select count(distinct user_id) as n_series, count(*) as n_rows, min(ts) as time_min, max(ts) as time_max from events",
)
def series_overview(spark, folder):
    return series_profile.series_overview(scan(spark, folder, "events"), "ts", "user_id")


DELTAS = """d as (select user_id, ts, epoch_us(ts - lag(ts) over (partition by user_id order by ts, event_id)) / 1e6
    as delta_seconds from events qualify delta_seconds is not null)"""


def deltas(spark, folder):
    return time_deltas(scan(spark, folder, "events"), "ts", "user_id", "event_id")


@query(
    "delta_summary",
    f"""with {DELTAS} select 'delta_seconds' as "column", count(*) as count, round(avg(delta_seconds), 3) as mean,
        round(stddev_samp(delta_seconds), 3) as std, round(min(delta_seconds), 3) as min,
        round(quantile_cont(delta_seconds, 0.25), 3) as q25, round(quantile_cont(delta_seconds, 0.5), 3) as q50,
        round(quantile_cont(delta_seconds, 0.75), 3) as q75, round(max(delta_seconds), 3) as max from d""",
)
def delta_summary(spark, folder):
    return rounded(series_profile.delta_summary(deltas(spark, folder)), 3)


@query(
    "common_deltas",
    f"""with {DELTAS} select round(delta_seconds / 3600) as delta_seconds, count(*) as count from d group by 1
        order by 2 desc, 1 limit 10""",
)
def common_deltas(spark, folder):
    hours = deltas(spark, folder).select(F.round(F.col("delta_seconds") / 3600).alias("delta_seconds"))
    return series_profile.common_deltas(hours, 10)


@query(
    "large_gaps",
    f"""with {DELTAS}, m as (select median(delta_seconds) * 1.5 as threshold from d)
    select user_id, ts, round(delta_seconds, 6) as delta_seconds, round(threshold, 6) as threshold from d, m
    where delta_seconds > threshold""",
)
def large_gaps(spark, folder):
    return rounded(series_profile.large_gaps(deltas(spark, folder)))


@query("seasonal_by_hour", "select hour(ts)::integer as hour, round(avg(value), 6) as mean_target from events group by 1")
def seasonal_by_hour(spark, folder):
    return rounded(series_profile.seasonal_means(scan(spark, folder, "events"), "ts", "value", "hour"))


@query(
    "seasonal_by_weekday",
    "select (isodow(ts) - 1)::integer as dow, round(avg(value), 6) as mean_target from events group by 1",
)
def seasonal_by_weekday(spark, folder):
    return rounded(series_profile.seasonal_means(scan(spark, folder, "events"), "ts", "value", "dow"))


@query(
    "gap_summary",
    f"""with {DELTAS}, m as (select median(delta_seconds) * 1.5 as threshold from d), g as (select delta_seconds as g from d, m where delta_seconds > threshold)
    select (select count(*) from d) as n_deltas, count(*) as n_gaps, round((select threshold from m), 3) as threshold,
        round(avg(g), 3) as mean_gap, round(max(g), 3) as longest_gap, round(sum(g), 3) as total_gap from g""",
)
def gap_summary(spark, folder):
    return rounded(series_profile.gap_summary(deltas(spark, folder)), 3)


@query(
    "time_deltas_of_text",
    f"with {DELTAS} select user_id, round(sum(delta_seconds), 3) as total, count(*) as n from d group by user_id",
)
def time_deltas_of_text(spark, folder):
    events = scan(spark, folder, "events").withColumn("ts", F.col("ts").cast("string"))
    found = time_deltas(events, "ts", "user_id", "event_id")
    return rounded(found.groupBy("user_id").agg(F.sum("delta_seconds").alias("total"), F.count("*").alias("n")), 3)


@query(
    "histogram_with_infinities",
    """with v as (select case when o_orderkey % 100 = 0 then 'infinity'::double else o_totalprice end as x from orders),
        f as (select x from v where not isinf(x)), e as (select min(x) as lo, max(x) as hi from f),
        b as (select least(floor((x - lo) / ((hi - lo) / 10))::bigint + 1, 10) as bin, count(*) as n from f, e group by 1)
    select r.i as bin, round(lo + (hi - lo) / 10 * (r.i - 1), 4) as lower, round(lo + (hi - lo) / 10 * r.i, 4) as upper, coalesce(n, 0) as count
    from range(1, 11) r(i) cross join e left join b on b.bin = r.i
    union all select 0, null, null, count(*) from v where isinf(x)""",
)
def histogram_with_infinities(spark, folder):
    orders = scan(spark, folder, "orders")
    x = F.when(F.col("o_orderkey") % 100 == 0, F.lit(float("inf"))).otherwise(F.col("o_totalprice"))
    return rounded(profile.histogram(orders.select(x.alias("x")), "x", 10, infinite=True), 4)


def _cut_sql(series: str, order: str = "event_id") -> str:
    by = f"partition by {series}" if series else ""
    return f"""s as (select *, coalesce(epoch_us(ts - lag(ts) over ({by} order by ts, {order})) / 1e6 > {{step}}, false)::integer as cut from src),
        g as (select *, sum(cut) over ({by} order by ts)::integer as segment from s)"""


def _filled_sql(series: str) -> str:
    by = f"partition by {series + ', ' if series else ''}segment order by ts, v nulls last, event_id"
    return f"""n as (select *, last_value(case when v is not null then {{{{'t': epoch_us(ts), 'x': v}}}} end ignore nulls) over b as p,
            first_value(case when v is not null then {{{{'t': epoch_us(ts), 'x': v}}}} end ignore nulls) over a as q from g
            window b as ({by} rows between unbounded preceding and current row),
                a as ({by} rows between current row and unbounded following))
    select event_id, round(coalesce(v, p.x + (q.x - p.x) * ((epoch_us(ts) - p.t) / 1e6) / nullif((q.t - p.t) / 1e6, 0)), 5) as filled from n"""


def _gappy(spark, folder):
    return scan(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("hot_id"),
        "ts",
        F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("v"),
    )


_GAPPY_SQL = """with src as (select *, case when event_id % 3 = 0 then 0 else user_id end as hot_id,
        case when event_id % 4 <> 0 then value end as v from events),"""
#: Small pieces, so that the small tables have many of them.
_DIVIDED = {"strategy": "segments", "segment_rows": 700}


@query("gap_segments", (_GAPPY_SQL + _cut_sql("user_id") + " select event_id, segment from g").format(step=86400))
def gap_segments(spark, folder):
    return segments.gap_segments(_gappy(spark, folder), "ts", 86400.0, "user_id", "event_id").select("event_id", "segment")


@query("gap_segments_divided", (_GAPPY_SQL + _cut_sql("hot_id") + " select event_id, segment from g").format(step=5400))
def gap_segments_divided(spark, folder):
    """A series that holds a third of the rows, in pieces."""
    return segments.gap_segments(_gappy(spark, folder), "ts", 5400.0, "hot_id", "event_id", **_DIVIDED).select("event_id", "segment")


@query("interpolated_in_segments", (_GAPPY_SQL + _cut_sql("user_id") + "," + _filled_sql("user_id")).format(step=86400))
def interpolated_in_segments(spark, folder):
    cut = segments.gap_segments(_gappy(spark, folder), "ts", 86400.0, "user_id", "event_id")
    filled = segments.interpolate(cut, "ts", "v", "user_id")
    return rounded(filled.select("event_id", F.col("v__filled").alias("filled")), 5)


@query("interpolated_divided", (_GAPPY_SQL + _cut_sql("") + "," + _filled_sql("")).format(step=1800))
def interpolated_divided(spark, folder):
    """No series at all: the whole table is one, in pieces."""
    cut = segments.gap_segments(_gappy(spark, folder), "ts", 1800.0, None, "event_id", **_DIVIDED)
    filled = segments.interpolate(cut, "ts", "v", None, **_DIVIDED)
    return rounded(filled.select("event_id", F.col("v__filled").alias("filled")), 5)
