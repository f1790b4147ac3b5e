"""Fitted preprocessing.  Statistics come from training rows, here the keys not divisible by 5."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.functions.coerce import col
from rowloom.operators import encodings
from rowloom.operators.preprocess import (
    PreprocessSpec,
    fit_preprocessor,
    fit_transform_preprocessor,
    load_preprocessor,
    standardize,
)
from rowloom.plans.catalog.registry import query, rounded, scan
from rowloom.session import scratch_path

TRAIN = "p_partkey % 5 <> 0"


def gappy_parts(spark, folder):
    """Parts with missing sizes and brands, and the key passed through."""
    return scan(spark, folder, "part").withColumns(
        {
            "p_size": F.when(F.col("p_partkey") % 7 != 0, F.col("p_size")),
            "p_brand": F.when(F.col("p_partkey") % 11 != 0, F.col("p_brand")),
        }
    )


GAPPY = """gappy as (select *replace (case when p_partkey % 7 <> 0 then p_size end as p_size,
    case when p_partkey % 11 <> 0 then p_brand end as p_brand) from part)"""


def numbers(**options):
    base = {"numeric_features": ["p_size", "p_retailprice"], "categorical_features": (), "remainder": "passthrough"}
    return PreprocessSpec(**{**base, **options})


def applied(spark, folder, spec):
    parts = gappy_parts(spark, folder)
    return fit_preprocessor(parts.where(TRAIN), spec).transform(parts)


def _impute(name: str, fill: str, **options):
    @query(
        f"impute_{name}",
        f"with {GAPPY} select p_partkey, round(coalesce(p_size, (select {fill}::double from gappy where {TRAIN})), 6) as p_size, "
        f"p_retailprice from gappy",
    )
    def run(spark, folder):
        made = applied(spark, folder, numbers(scale_numeric=False, **options))
        return rounded(made.select("p_partkey", "p_size", "p_retailprice"))

    return run


_impute("mean", "avg(p_size)", numeric_imputer="mean")
_impute("median", "median(p_size)")
_impute("constant", "max(-1)", numeric_imputer="constant", numeric_fill=-1.0)


@query(
    "impute_most_frequent",
    f"""with {GAPPY}, m as (select p_size from gappy where {TRAIN} and p_size is not null group by 1
        order by count(*) desc, 1 limit 1)
    select p_partkey, coalesce(p_size, (select p_size from m))::double as p_size from gappy""",
)
def impute_most_frequent(spark, folder):
    made = applied(spark, folder, numbers(scale_numeric=False, numeric_imputer="most_frequent"))
    return made.select("p_partkey", "p_size")


@query(
    "scale_numeric",
    f"""with {GAPPY}, f as (select p_partkey, coalesce(p_size, (select median(p_size) from gappy where {TRAIN})) as s,
        p_retailprice as p from gappy), t as (select avg(s) as sm, stddev_pop(s) as ss, avg(p) as pm, stddev_pop(p) as ps
        from f where {TRAIN})
    select p_partkey, round((s - sm) / ss, 6) + 0.0 as p_size, round((p - pm) / ps, 6) + 0.0 as p_retailprice from f, t""",
)
def scale_numeric(spark, folder):
    made = rounded(applied(spark, folder, numbers()).select("p_partkey", "p_size", "p_retailprice"))
    return made.withColumns({c: F.col(c) + 0.0 for c in ("p_size", "p_retailprice")})


@query(
    "scale_train_and_validation",
    f"""with t as (select avg(p_retailprice) as m, stddev_pop(p_retailprice) as s from part where {TRAIN})
    select p_partkey, round((p_retailprice - m) / s, 6) + 0.0 as p_retailprice from part, t""",
)
def scale_train_and_validation(spark, folder):
    parts = scan(spark, folder, "part").select("p_partkey", "p_retailprice")
    made = rounded(standardize(parts, ["p_retailprice"], fit_on=parts.where(TRAIN)))
    return made.withColumn("p_retailprice", F.col("p_retailprice") + 0.0)


def categories(**options):
    base = {"numeric_features": (), "categorical_features": ["p_brand"], "remainder": "passthrough"}
    return PreprocessSpec(**{**base, **options})


def set_indicators(df, prefix="p_brand__"):
    """The indicators that are set, as (key, indicator) rows."""
    names = [c for c in df.columns if c.startswith(prefix)]
    cells = F.array(*[F.when(col(c) == 1.0, F.lit(c)) for c in names])
    return df.select("p_partkey", F.explode_outer(F.array_compact(cells)).alias("indicator"), F.lit(len(names)).alias("width"))


CATEGORY_SQL = """with {gappy}, m as (select p_brand from gappy where {train} and p_brand is not null group by 1
        order by count(*) desc, 1 limit 1),
    f as (select p_partkey, coalesce(p_brand, {fill}) as b from gappy),
    c as (select b, count(*) as n from f where {train} group by b),
    k as (select b from c {kept}),
    w as (select (select count(*) from k) + ((select count(*) from c) > (select count(*) from k))::integer as width)
    select p_partkey, case when b in (select b from k) then 'p_brand__' || b
        when b in (select b from c) then 'p_brand__<infrequent>' end as indicator, width::integer as width from f, w"""


def category_sql(kept="", fill="(select p_brand from m)", train=TRAIN):
    return CATEGORY_SQL.format(gappy=GAPPY, train=train, fill=fill, kept=kept)


@query("one_hot", category_sql())
def one_hot(spark, folder):
    return set_indicators(applied(spark, folder, categories()))


@query("one_hot_constant_fill", category_sql(fill="'missing'"))
def one_hot_constant_fill(spark, folder):
    return set_indicators(applied(spark, folder, categories(categorical_imputer="constant")))


@query("one_hot_unknown_ignored", category_sql(train="p_partkey % 5 <> 0 and p_brand <> 'Brand#1'").replace(
    "from f where p_partkey % 5 <> 0 and p_brand <> 'Brand#1'", "from f where p_partkey % 5 <> 0 and b <> 'Brand#1'"
))
def one_hot_unknown_ignored(spark, folder):
    parts = gappy_parts(spark, folder)
    fitted = fit_preprocessor(parts.where(f"{TRAIN} and coalesce(p_brand, '') <> 'Brand#1'"), categories())
    return set_indicators(fitted.transform(parts))


@query(
    "one_hot_min_frequency",
    category_sql("where n >= 60"),
)
def one_hot_min_frequency(spark, folder):
    return set_indicators(applied(spark, folder, categories(min_frequency=60)))


@query("one_hot_max_categories", category_sql("order by n desc, b desc limit 4"))
def one_hot_max_categories(spark, folder):
    return set_indicators(applied(spark, folder, categories(max_categories=5)))


@query(
    "category_index",
    """with c as (select p_name, row_number() over (order by p_name) - 1 as i from (select distinct p_name from part where p_partkey % 5 <> 0))
    select p_partkey, i as p_name__index from part left join c using (p_name)""",
)
def category_index(spark, folder):
    parts = scan(spark, folder, "part").select("p_partkey", "p_name")
    spec = categories(categorical_features=["p_name"], encoding="index")
    return fit_preprocessor(parts.where(TRAIN), spec).transform(parts).select("p_partkey", "p_name__index")


@query(
    "one_hot_many_rare",
    """with c as (select l_partkey::varchar as v, count(*) as n from lineitem group by 1),
        r as (select *, row_number() over (order by n desc, v desc) as place from c)
    select case when place < 3 then v else '<infrequent>' end as category, sum(n)::double as n_rows from r group by 1""",
)
def one_hot_many_rare(spark, folder):
    """Thousands of values, of which two keep a column of their own."""
    lines = scan(spark, folder, "lineitem").select(F.col("l_partkey").cast("string").alias("part"))
    spec = PreprocessSpec(numeric_features=[], categorical_features=["part"], max_categories=3)
    coded = fit_preprocessor(lines, spec).transform(lines)
    sums = [F.struct(F.lit(c.removeprefix("part__")).alias("category"), F.sum(col(c)).alias("n_rows")) for c in coded.columns]
    return coded.agg(F.array(*sums).alias("all")).select(F.inline("all"))


@query(
    "one_hot_sparse",
    """with c as (select p_name, row_number() over (order by p_name) - 1 as i, count(*) over () as size
        from (select distinct p_name from part where p_partkey % 5 <> 0))
    select p_partkey, (select max(size) from c)::integer as size, i::integer as set_index from part left join c using (p_name)""",
)
def one_hot_sparse(spark, folder):
    parts = scan(spark, folder, "part").select("p_partkey", "p_name")
    made = fit_preprocessor(parts.where(TRAIN), categories(categorical_features=["p_name"], encoding="sparse")).transform(parts)
    return made.select("p_partkey", F.col("p_name__onehot.size").alias("size"), F.col("p_name__onehot.index").alias("set_index"))


@query(
    "one_hot_ties",
    """with t as (select p_partkey, 'k' || (p_partkey % 7) as k from part where p_partkey <= 7 * ((select max(p_partkey) from part) // 7)),
        top as (select k from t group by k order by count(*) desc, k desc limit 3),
        i as (select k, row_number() over (order by k) - 1 as i from top)
    select p_partkey, coalesce(i, 3)::integer as dense, coalesce(i, 3)::integer as sparse from t left join i using (k)""",
)
def one_hot_ties(spark, folder):
    """Equal counts under a limit: both encodings keep the same categories."""
    parts = scan(spark, folder, "part").select("p_partkey")
    last = parts.agg(F.max("p_partkey")).first()[0]
    keyed = parts.where(F.col("p_partkey") <= 7 * (last // 7)).withColumn("k", F.concat(F.lit("k"), F.col("p_partkey") % 7))
    options = {"categorical_features": ["k"], "max_categories": 4}
    dense = fit_preprocessor(keyed, categories(**options)).transform(keyed)
    names = [c for c in dense.columns if c.startswith("k__")]
    place = F.array_position(F.array(*[col(c) for c in names]), F.lit(1.0)) - 1
    sparse = fit_preprocessor(keyed, categories(**options, encoding="sparse")).transform(keyed)
    sparse = sparse.select("p_partkey", F.col("k__onehot.index").alias("sparse"))
    return dense.select("p_partkey", place.cast("int").alias("dense")).join(sparse, "p_partkey")


@query(
    "preprocessor_reloaded",
    category_sql("where n >= 60"),
)
def preprocessor_reloaded(spark, folder):
    parts = gappy_parts(spark, folder)
    path = scratch_path(spark, "fitted")
    fit_preprocessor(parts.where(TRAIN), categories(min_frequency=60)).save(spark, path)
    return set_indicators(load_preprocessor(spark, path).transform(parts))


@query(
    "preprocess_table",
    f"""with {GAPPY}, s as (select median(p_size) as fs from gappy where {TRAIN}),
        m as (select p_type as ft from gappy where {TRAIN} group by 1 order by count(*) desc, 1 limit 1),
        f as (select p_partkey, coalesce(p_size, fs) as s, p_retailprice as p, coalesce(p_type, ft) as t from gappy, s, m),
        a as (select avg(s) as sm, stddev_pop(s) as ss, avg(p) as pm, stddev_pop(p) as ps from f where {TRAIN})
    select p_partkey, round((s - sm) / ss, 6) + 0.0 as p_size, round((p - pm) / ps, 6) + 0.0 as p_retailprice,
        (t = 'ECONOMY')::integer::double as economy, (t = 'STANDARD')::integer::double as standard from f, a""",
)
def preprocess_table(spark, folder):
    spec = PreprocessSpec(
        numeric_features=["p_size", "p_retailprice"],
        categorical_features=["p_type"],
        drop_features=["p_name", "p_brand"],
        remainder="passthrough",
    )
    made = rounded(applied(spark, folder, spec))
    return made.select(
        "p_partkey",
        (F.col("p_size") + 0.0).alias("p_size"),
        (F.col("p_retailprice") + 0.0).alias("p_retailprice"),
        F.col("p_type__ECONOMY").alias("economy"),
        F.col("p_type__STANDARD").alias("standard"),
    )


@query(
    "fitted_parameters",
    f"""with {GAPPY}, f as (select coalesce(p_size, (select median(p_size) from gappy where {TRAIN})) as s from gappy where {TRAIN})
    select 'p_size' as "column", 'fill' as parameter, round(median(p_size), 6) as number from gappy where {TRAIN}
    union all select 'p_size', 'centre', round(avg(s), 6) from f
    union all select 'p_size', 'scale', round(stddev_pop(s), 6) from f""",
)
def fitted_parameters(spark, folder):
    train = gappy_parts(spark, folder).where(TRAIN)
    _, fitted = fit_transform_preprocessor(train, numbers(numeric_features=["p_size"]))
    return rounded(fitted.parameters(spark).select("column", "parameter", "number"))


@query(
    "frequency_encoding",
    f"""with {GAPPY}, n as (select p_brand, count(*) * 1.0 / (select count(*) from gappy where {TRAIN}) as f from gappy where {TRAIN} group by p_brand)
    select p_partkey, round(coalesce(f, 0), 6) as p_brand__frequency from gappy g left join n on g.p_brand is not distinct from n.p_brand""",
)
def frequency_encoding(spark, folder):
    parts = gappy_parts(spark, folder)
    made = encodings.fit_frequency(parts.where(TRAIN), "p_brand").transform(parts)
    return rounded(made.select("p_partkey", "p_brand__frequency"))


@query(
    "target_encoding",
    f"""with m as (select avg(p_retailprice) as m from part where {TRAIN}),
        n as (select p_name, count(*) as n, sum(p_retailprice) as s from part where {TRAIN} group by p_name)
    select p_partkey, round(coalesce((s + 10 * m) / (n + 10), m), 4) as p_name__target_mean from m, part left join n using (p_name)""",
)
def target_encoding(spark, folder):
    parts = scan(spark, folder, "part").select("p_partkey", "p_name", "p_retailprice")
    made = encodings.fit_target_mean(parts.where(TRAIN), "p_name", "p_retailprice").transform(parts)
    return rounded(made.select("p_partkey", "p_name__target_mean"), 4)


@query(
    "quantile_bins",
    f"""with q as (select quantile_cont(p_retailprice, [0.25, 0.5, 0.75]) as q from part where {TRAIN})
    select p_partkey, ((p_retailprice >= q[1])::integer + (p_retailprice >= q[2])::integer + (p_retailprice >= q[3])::integer) as p_retailprice__bin
    from part, q""",
)
def quantile_bins(spark, folder):
    parts = scan(spark, folder, "part").select("p_partkey", "p_retailprice")
    made = encodings.fit_bins(parts.where(TRAIN), "p_retailprice", 4).transform(parts)
    return made.select("p_partkey", "p_retailprice__bin")
