"""Selection, coercion and row features."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.functions import numeric
from rowloom.functions.coerce import moment, number, strict_moment
from rowloom.operators import tables
from rowloom.operators.row_features import (
    RowFeatures,
    add_date_parts,
    add_shifted_log1p,
    build_row_features,
    coercion_report,
    parse_date_columns,
)
from rowloom.plans.catalog.registry import query, rounded, scan

CALENDAR_SQL = """
    year({t})::integer as {c}__year, month({t})::integer as {c}__month, day({t})::integer as {c}__day,
    (isodow({t}) - 1)::integer as {c}__dayofweek, hour({t})::integer as {c}__hour, week({t})::integer as {c}__weekofyear,
    coalesce((isodow({t}) >= 6)::integer, 0) as {c}__is_weekend,
    coalesce((day({t}) = 1)::integer, 0) as {c}__is_month_start,
    coalesce(({t}::date = last_day({t}::date))::integer, 0) as {c}__is_month_end"""


def gappy_events(spark, folder):
    """Events with text in place of times and numbers, some of it unreadable, some missing."""
    return scan(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 10 == 0, F.lit("bad"))
        .when(F.col("event_id") % 10 == 1, F.lit(None))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("t"),
        F.when(F.col("event_id") % 7 == 0, F.lit("n/a"))
        .when(F.col("event_id") % 7 == 1, F.lit(None))
        .otherwise(F.col("value").cast("string"))
        .alias("v"),
    )


GAPPY_SQL = """gappy as (select event_id, ts,
    case when event_id % 10 in (0, 1) then null else date_trunc('second', ts) end as t,
    case when event_id % 7 in (0, 1) then null else value end as v from events)"""


@query("select_numeric", "select p_partkey, p_size, p_retailprice from part")
def select_numeric(spark, folder):
    return tables.select_numeric(scan(spark, folder, "part"))


@query("select_categorical", "select p_name, p_brand, p_type from part")
def select_categorical(spark, folder):
    return tables.select_categorical(scan(spark, folder, "part"))


@query("select_matching", "select l_orderkey, l_partkey, l_suppkey from lineitem")
def select_matching(spark, folder):
    return tables.select_matching(scan(spark, folder, "lineitem"), "key$")


@query("select_features", "select p_name, p_brand, p_type, p_size from part")
def select_features(spark, folder):
    part = scan(spark, folder, "part")
    names, _ = tables.features_and_target(part, "p_retailprice", "p_partkey")
    return part.select(*names)


@query(
    "drop_missing_rows",
    "select event_id, value from events where event_id % 5 <> 0 and event_type <> 'error'",
)
def drop_missing_rows(spark, folder):
    events = scan(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 5 != 0, F.col("value")).otherwise(F.lit(float("nan"))).alias("value"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
    )
    return tables.drop_missing(events, ["value", "kind"]).select("event_id", "value")


@query(
    "filter_rows",
    "select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity > 45 and l_returnflag = 'R'",
)
def filter_rows(spark, folder):
    return (
        scan(spark, folder, "lineitem")
        .where((F.col("l_quantity") > 45) & (F.col("l_returnflag") == "R"))
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


@query("coerce_datetime", f"with {GAPPY_SQL} select event_id, t from gappy")
def coerce_datetime(spark, folder):
    gappy = gappy_events(spark, folder)
    return gappy.select("event_id", moment(gappy, "t").alias("t"))


@query("coerce_datetime_format", f"with {GAPPY_SQL} select event_id, t from gappy")
def coerce_datetime_format(spark, folder):
    gappy = gappy_events(spark, folder)
    return gappy.select("event_id", moment(gappy, "t", "yyyy-MM-dd HH:mm:ss").alias("t"))


@query("parse_datetime_strictly", "select event_id, date_trunc('second', ts) as t from events")
def parse_datetime_strictly(spark, folder):
    text = scan(spark, folder, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"))
    return text.select("event_id", strict_moment(text, "t").alias("t"))


#: Zone text behind a clock time, and what brings that clock to UTC.
_ZONES = (
    (":07 America/New_York", "(c + interval 7 seconds) at time zone 'America/New_York' at time zone 'UTC'"),
    (":07.25 EST", "c + interval 5 hours + interval 7250 milliseconds"),
    (":07 GMT+5", "c - interval 5 hours + interval 7 seconds"),
    ("Z", "c"),
    (" +0530", "c - interval 330 minutes"),
    (":07Europe/Berlin", "(c + interval 7 seconds) at time zone 'Europe/Berlin' at time zone 'UTC'"),
    ("", "c"),
    (":07 Nowhere/Town", "null"),
)


@query(
    "zoned_text",
    f"""with n as (select event_id, date_trunc('day', ts) + interval 12 hours + interval 1 minute * minute(ts) as c from events)
    select event_id, (case event_id % {len(_ZONES)} {' '.join(f'when {i} then {sql}' for i, (_, sql) in enumerate(_ZONES))} end)::timestamp as t from n""",
)
def zoned_text(spark, folder):
    """Clock times with named zones, abbreviations and offsets, with and without seconds, as moments in UTC."""
    events = scan(spark, folder, "events")
    zone = F.element_at(F.array(*[F.lit(z) for z, _ in _ZONES]), (F.col("event_id") % len(_ZONES) + 1).cast("int"))
    letter = F.when(F.col("event_id") % 16 < 8, "T").otherwise(" ")
    clock = F.concat(F.date_format("ts", "yyyy-MM-dd"), letter, F.date_format("ts", "'12':mm"), zone)
    text = events.select("event_id", clock.alias("t"))
    return text.select("event_id", moment(text, "t").alias("t"))


@query("coerce_number", f"with {GAPPY_SQL} select event_id, v from gappy")
def coerce_number(spark, folder):
    gappy = gappy_events(spark, folder)
    return gappy.select("event_id", number(gappy, "v").alias("v"))


@query(
    "coercion_report",
    "select 't' as \"column\", 'datetime' as kind, count(*) filter (event_id % 10 = 0) as n_invalid from events union all "
    "select 'v', 'number', count(*) filter (event_id % 7 = 0) from events",
)
def coercion_counts(spark, folder):
    return coercion_report(gappy_events(spark, folder), times=["t"], numbers=["v"])


@query(
    "detect_datetime_columns",
    "select event_id, date_trunc('second', ts) as t, event_type from events",
)
def detect_datetime_columns(spark, folder):
    text = scan(spark, folder, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), "event_type"
    )
    return parse_date_columns(text)


@query(
    "assemble_matrix",
    "select p_partkey, i::integer as place, [p_size, p_retailprice][i + 1]::double as value, p_partkey % 3 as target "
    "from part, range(2) r(i)",
)
def assemble_matrix(spark, folder):
    part = scan(spark, folder, "part").withColumn("cls", F.col("p_partkey") % 3)
    matrix = tables.assemble(
        part, "cls", drop_columns=["p_name", "p_brand", "p_type"], feature_type="double", keep=["p_partkey"]
    )
    return matrix.select("p_partkey", "target", F.posexplode("features").alias("place", "value"))


@query(
    "matrix_metadata",
    "select count(*) as num_samples, 2 as num_features, 'p_size,p_retailprice' as feature_names, true as has_targets, "
    "'p_partkey' as target_name from part",
)
def matrix_metadata(spark, folder):
    found = tables.matrix_metadata(scan(spark, folder, "part"), ["p_size", "p_retailprice"], "p_partkey")
    return found.withColumn("feature_names", F.array_join("feature_names", ","))


@query(
    "target_types",
    "select l_orderkey, l_linenumber, l_linenumber::bigint as label, l_tax::float::double as level from lineitem",
)
def target_types(spark, folder):
    from rowloom.functions.coerce import target_column

    lines = scan(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        target_column(lines, "l_linenumber").alias("label"),
        target_column(lines, "l_tax").cast("double").alias("level"),
    )


@query("calendar_features", f"select o_orderkey, {CALENDAR_SQL.format(t='o_orderdate', c='o_orderdate')} from orders")
def calendar_features(spark, folder):
    orders = scan(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return build_row_features(orders, RowFeatures(["o_orderdate"], drop_original_datetime=True))


@query("calendar_features_of_text", f"with {GAPPY_SQL} select event_id, {CALENDAR_SQL.format(t='t', c='t')} from gappy")
def calendar_features_of_text(spark, folder):
    gappy = gappy_events(spark, folder).select("event_id", "t")
    return build_row_features(gappy, RowFeatures(["t"], drop_original_datetime=True))


@query(
    "short_date_parts",
    "select event_id, year(ts)::integer as ts_year, month(ts)::integer as ts_month, day(ts)::integer as ts_day, "
    "(isodow(ts) - 1)::integer as ts_dow, hour(ts)::integer as ts_hour from events",
)
def short_parts(spark, folder):
    events = scan(spark, folder, "events").select("event_id", "ts", "event_type")
    return add_date_parts(events, ["ts", "event_type", "absent"]).drop("ts", "event_type")


@query(
    "log1p_feature",
    "select l_orderkey, l_linenumber, round(ln(1 + l_extendedprice), 6) as l_extendedprice__log1p, "
    "round(ln(1 + l_tax), 6) as l_tax__log1p from lineitem",
)
def log1p_feature(spark, folder):
    lines = scan(spark, folder, "lineitem")
    made = build_row_features(lines, RowFeatures(log1p_columns=["l_extendedprice", "l_tax"]))
    return rounded(made.select("l_orderkey", "l_linenumber", "l_extendedprice__log1p", "l_tax__log1p"))


@query(
    "shifted_log1p",
    "select c_custkey, round(ln(1 + c_acctbal - (select min(c_acctbal) from customer) + 1e-6), 6) as c_acctbal_log1p "
    "from customer",
)
def shifted_log(spark, folder):
    made = add_shifted_log1p(scan(spark, folder, "customer"), ["c_acctbal"])
    return rounded(made.select("c_custkey", "c_acctbal_log1p"))


@query(
    "ratio_feature",
    "select l_orderkey, l_linenumber, round(l_tax / nullif(l_discount, 0), 6) as tax_per_discount from lineitem",
)
def ratio_feature(spark, folder):
    made = build_row_features(
        scan(spark, folder, "lineitem"), RowFeatures(ratio_features={"tax_per_discount": ("l_tax", "l_discount")})
    )
    return rounded(made.select("l_orderkey", "l_linenumber", "tax_per_discount"))


@query(
    "power_feature",
    "select c_custkey, case when c_acctbal >= 0 then round(pow(c_acctbal, 0.5), 6) end as root, "
    "round(pow(c_acctbal / 1000, 2), 6) as square from (select c_custkey, c_acctbal from customer)",
)
def power_feature(spark, folder):
    customers = scan(spark, folder, "customer").withColumn("balance_k", F.col("c_acctbal") / 1000)
    made = build_row_features(
        customers, RowFeatures(power_features={"root": ("c_acctbal", 0.5), "square": ("balance_k", 2)})
    )
    return rounded(made.select("c_custkey", "root", "square"))


@query(
    "interaction_feature",
    "select l_orderkey, l_linenumber, round(l_quantity * l_discount, 6) as discounted from lineitem",
)
def interaction_feature(spark, folder):
    made = build_row_features(
        scan(spark, folder, "lineitem"), RowFeatures(interaction_features={"discounted": ("l_quantity", "l_discount")})
    )
    return rounded(made.select("l_orderkey", "l_linenumber", "discounted"))


@query(
    "row_features",
    f"""with made as (select l_orderkey, l_linenumber, {CALENDAR_SQL.format(t='l_shipdate', c='l_shipdate')},
        ln(1 + l_quantity) as l_quantity__log1p, l_extendedprice / nullif(l_quantity, 0) as unit_price from lineitem)
    select *exclude (l_quantity__log1p, unit_price), round(l_quantity__log1p, 6) as l_quantity__log1p,
        round(unit_price, 8) as unit_price, round(pow(unit_price, 0.5), 6) as unit_root,
        round(unit_price * l_quantity__log1p, 4) as unit_by_log from made""",
)
def row_features(spark, folder):
    lines = scan(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    spec = RowFeatures(
        datetime_columns=["l_shipdate"],
        log1p_columns=["l_quantity"],
        ratio_features={"unit_price": ("l_extendedprice", "l_quantity")},
        power_features={"unit_root": ("unit_price", 0.5)},
        interaction_features={"unit_by_log": ("unit_price", "l_quantity__log1p")},
        drop_original_datetime=True,
    )
    made = build_row_features(lines, spec).drop("l_quantity", "l_extendedprice")
    # Quotients by powers of two end within 8 digits; at 6 they would fall on rounding ties.
    return made.withColumns(
        {
            "unit_price": F.round("unit_price", 8),
            "l_quantity__log1p": F.round("l_quantity__log1p", 6),
            "unit_root": F.round("unit_root", 6),
            "unit_by_log": F.round("unit_by_log", 4),
        }
    )


@query("absolute_value", "select c_custkey, abs(c_acctbal) as size from customer")
def absolute_value(spark, folder):
    return scan(spark, folder, "customer").select("c_custkey", F.abs("c_acctbal").alias("size"))


@query(
    "activations",
    """with z as (select c_custkey, c_acctbal / 3700 as x from customer)
    select c_custkey, round(greatest(x, 0), 6) as relu, round(x / (1 + exp(-x)), 6) as silu,
        round(case when x >= 0 then x else 0.01 * x end, 6) as leaky_relu, round(tanh(x), 6) as tanh,
        round(case when x > 0 then x else exp(x) - 1 end, 6) as elu, round(1 / (1 + exp(-x)), 6) as probability from z""",
)
def activations(spark, folder):
    z = scan(spark, folder, "customer").select("c_custkey", (F.col("c_acctbal") / 3700).alias("x"))
    named = {n: numeric.activation(n, F.col("x")) for n in ("relu", "silu", "leaky_relu", "tanh", "elu")}
    named["probability"] = numeric.class_probabilities(F.col("x"), "binary")
    return rounded(z.select("c_custkey", *[v.alias(n) for n, v in named.items()]))


@query(
    "softmax",
    """with e as (select vec_id, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as place from embeddings)
    select vec_id, place::integer as place, round(exp(x) / sum(exp(x)) over (partition by vec_id), 6) as p from e""",
)
def softmax(spark, folder):
    logits = F.transform("embedding", lambda x: x.cast("double"))
    p = numeric.class_probabilities(logits, "multiclass")
    return rounded(scan(spark, folder, "embeddings").select("vec_id", F.posexplode(p).alias("place", "p")))
