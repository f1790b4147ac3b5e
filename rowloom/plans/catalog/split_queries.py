"""Splits and batches.  Hash splits are checked by their exact sizes, ordered ones row by row."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.operators import splits
from rowloom.plans.catalog.registry import query, scan
from rowloom.plans.flows import forecast_windows


@query(
    "random_split",
    """with n as (select count(*) as n, ceil(count(*) * 0.2::double)::bigint as v from orders)
    select 'validation' as split, v as n_rows, v as n_keys, 0 as n_moved from n union all select 'train', n - v, n - v, 0 from n""",
)
def random_split(spark, folder):
    orders = scan(spark, folder, "orders")
    return membership(splits.random_split(orders, 0.2, 42, "o_orderkey"), splits.random_split(orders.repartition(5), 0.2, 42, "o_orderkey"))


def membership(parts, again, key="o_orderkey", *by):
    """Rows and distinct keys per part, and keys that another layout of the table puts elsewhere."""
    other = again.select(key, F.col("split").alias("other"))
    joined = parts.join(other, key)  # a key that one of them holds twice or lacks shows in the counts
    moved = F.count_if(F.col("split") != F.col("other"))
    return joined.groupBy(*by, "split").agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"), moved.alias("n_moved"))


@query(
    "stratified_split",
    """with c as (select o_orderpriority as k, count(*) as n from orders group by 1),
        w as (select ceil(sum(n) * 0.2::double)::double as wanted, sum(n)::double as total from c),
        e as (select k, n, floor(n * wanted / total) as whole, n * wanted / total - floor(n * wanted / total) as rest, wanted from c, w),
        q as (select k, n, (whole + (row_number() over (order by rest desc, k) <= wanted - sum(whole) over ())::integer)::bigint as v from e)
    select k as o_orderpriority, 'validation' as split, v as n_rows, v as n_keys, 0 as n_moved from q
    union all select k, 'train', n - v, n - v, 0 from q""",
)
def stratified_split(spark, folder):
    orders = scan(spark, folder, "orders")
    split = lambda df: splits.stratified_split(df, "o_orderpriority", 0.2, 42, "o_orderkey")
    return membership(split(orders), split(orders.repartition(5)), "o_orderkey", "o_orderpriority")


def _chronological(n_val: str) -> str:
    return f"""select event_id, case when row_number() over (order by ts, event_id) > (select count(*) - ({n_val}) from events)
        then 'validation' else 'train' end as split from events"""


@query("chronological_split", _chronological("greatest(1, round_even(count(*) * 0.2::double, 0))"))
def chronological_split(spark, folder):
    return splits.chronological_split(scan(spark, folder, "events"), "ts", 0.2, "event_id").select("event_id", "split")


@query("chronological_split_floor", _chronological("count(*) - floor((1.0::double - 0.3::double) * count(*))"))
def chronological_split_floor(spark, folder):
    parts = splits.chronological_split(scan(spark, folder, "events"), "ts", 0.3, "event_id", "floor")
    return parts.select("event_id", "split")


@query(
    "series_tail_split",
    """select event_id, case when row_number() over (partition by user_id order by ts, event_id) >
        floor((1.0::double - 0.2::double) * count(*) over (partition by user_id)) then 'validation' else 'train' end as split from events""",
)
def series_tail_split(spark, folder):
    parts = splits.series_tail_split(scan(spark, folder, "events"), "user_id", "ts", 0.2, "event_id")
    return parts.select("event_id", "split")


@query(
    "windows_within_split",
    """with s as (select *, case when row_number() over (order by ts, event_id) > (select count(*) - greatest(1,
            round_even(count(*) * 0.2::double, 0)) from events) then 'validation' else 'train' end as split from events),
        r as (select split, user_id, value, row_number() over (partition by split, user_id order by ts, event_id) - 1 as i,
            count(*) over (partition by split, user_id) as n from s)
    select s.split, s.user_id, s.i as start, (r.i - s.i)::integer as place, r.value as x from r join r s
        on r.split = s.split and r.user_id = s.user_id and r.i between s.i and s.i + 6 where s.i % 2 = 0 and s.i + 7 <= s.n""",
)
def windows_within_split(spark, folder):
    made = forecast_windows(
        scan(spark, folder, "events"),
        "ts",
        "value",
        5,
        2,
        2,
        ["value"],
        "user_id",
        0.2,
        ["event_id"],
        feature_type="double",
        target_type="double",
    )
    joined = F.concat(F.flatten("X"), F.flatten("y"))
    return made.select("split", "user_id", "start", F.posexplode(joined).alias("place", "x"))


@query(
    "ordered_batches",
    "select event_id, (row_number() over (order by ts, event_id) - 1) // 256 as batch from events",
)
def ordered_batches(spark, folder):
    return splits.batches(scan(spark, folder, "events"), 256, "ts", "event_id").select("event_id", "batch")


@query(
    "shuffled_batches",
    "select b as batch, least(256, n - 256 * b) as n_rows from (select count(*) as n from events), "
    "range((select (count(*) + 255) // 256 from events)) r(b)",
)
def shuffled_batches(spark, folder):
    made = splits.shuffled_batches(scan(spark, folder, "events"), 256, 7, "event_id")
    return made.groupBy("batch").agg(F.count("*").alias("n_rows"))
