"""Forecast and classifier evaluation, training histories, baseline models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window, functions as F

from rowloom.functions import metrics
from rowloom.operators import evaluate, models
from rowloom.operators.series_features import SeriesFeatures, build_series_features
from rowloom.operators.splits import batches
from rowloom.operators.windows import first_step, flatten_windows, sliding_windows
from rowloom.plans.catalog.registry import query, rounded, scan
from rowloom.plans.flows import forecast_metrics, forecast_windows, train_forecaster, train_tabular
from rowloom.session import small_table, written

H = 3
NEXT = ", ".join(f"lead(value, {h}) over w as y{h}" for h in range(1, H + 1))
# Windows of 5 rows and 3 steps; the forecast repeats the last value seen.
FORECASTS = f"""f as (select user_id, row_number() over w - 5 as start, value as p, {NEXT} from events
    window w as (partition by user_id order by ts, event_id)), v as (select * from f where start >= 0 and y{H} is not null)"""


def forecasts(spark, folder):
    events = scan(spark, folder, "events").select("event_id", "ts", "user_id", "value")
    made = sliding_windows(
        events, 5, "ts", H, 1, ["value"], "value", "user_id", "event_id", feature_type="double", target_type="double"
    )
    naive = F.transform(F.flatten("y"), lambda _: F.col("X")[4][0])
    return made.withColumn("prediction", naive).withColumn("truth", F.flatten("y"))


def _errors(power: str) -> str:
    return " + ".join(power.format(d=f"(p - y{h})") for h in range(1, H + 1))


@query(
    "forecast_metrics",
    f"""with {FORECASTS} select round(sum({_errors('{d} * {d}')}) / (count(*) * {H}), 5) as mse,
        round(sum({_errors('abs({d})')}) / (count(*) * {H}), 5) as mae,
        round(sqrt(sum({_errors('{d} * {d}')}) / (count(*) * {H})), 5) as rmse from v""",
)
def horizon(spark, folder):
    return rounded(evaluate.horizon_metrics(forecasts(spark, folder), "truth", "prediction"), 5)


@query(
    "forecast_metrics_per_series",
    f"""with {FORECASTS} select user_id, round(sum({_errors('{d} * {d}')}) / (count(*) * {H}), 5) as mse,
        round(sum({_errors('abs({d})')}) / (count(*) * {H}), 5) as mae,
        round(sqrt(sum({_errors('{d} * {d}')}) / (count(*) * {H})), 5) as rmse from v group by user_id""",
)
def horizon_per_series(spark, folder):
    return rounded(evaluate.horizon_metrics(forecasts(spark, folder), "truth", "prediction", ["user_id"]), 5)


@query(
    "forecast_first_step",
    f"with {FORECASTS} select start, y1 as truth, p as forecast from v order by start, truth, forecast limit 10",
)
def forecast_first_step(spark, folder):
    return first_step(forecasts(spark, folder), "prediction", 10)


@query(
    "scalar_metrics",
    """with s as (select value as y, lag(value) over (partition by user_id order by ts, event_id) as p from events qualify p is not null)
    select round(avg((p - y) * (p - y)), 5) as mse, round(avg(abs(p - y)), 5) as mae, round(sqrt(avg((p - y) * (p - y))), 5) as rmse,
        round(avg(abs((p - y) / nullif(y, 0))), 5) as mape, round(avg((p = y)::integer), 5) as accuracy from s""",
)
def scalar_metrics(spark, folder):
    return rounded(evaluate.score(naive(spark, folder), "y", "p", ["mse", "mae", "rmse", "mape", "accuracy"]), 5)


def naive(spark, folder):
    shifted = with_previous(scan(spark, folder, "events"), value="p")
    return shifted.select("event_id", "ts", F.col("value").alias("y"), "p").where("p is not null")


def with_previous(events, **names):
    """Columns of the user's previous event, by the plan that divides a long series."""
    spec = SeriesFeatures(
        "ts", "user_id", lag_features={new: (source, 1) for source, new in names.items()}, tie_breakers=["event_id"]
    )
    return build_series_features(events.select("event_id", "ts", "user_id", "value"), spec)


@query(
    "binary_log_loss",
    "with z as (select toxic as y, (doc_id % 7 - 3) * 0.8::double as z from labels) "
    "select round(avg(greatest(z, 0) - z * y + ln(1 + exp(-abs(z)))), 6) as log_loss from z",
)
def binary_log_loss(spark, folder):
    logit = (F.col("doc_id") % 7 - 3) * F.lit(0.8)
    return rounded(scan(spark, folder, "labels").agg(metrics.binary_log_loss(F.col("toxic"), logit).alias("log_loss")))


@query(
    "cross_entropy",
    """with x as (select vec_id, label, unnest(embedding)::double as x, generate_subscripts(embedding, 1) - 1 as i from embeddings),
        e as (select vec_id, label, k, sum(x * ((i * 7 + k * 3) % 11 - 5) / 10.0::double) as z from x, range(0, 10) r(k) group by all),
        s as (select vec_id, ln(sum(exp(z))) - max(case when k = label then z end) as loss from e group by vec_id)
    select round(avg(loss), 6) as cross_entropy from s""",
)
def cross_entropy(spark, folder):
    """All values of a row go through a layer with ten outputs."""
    weight = np.array([[((i * 7 + k * 3) % 11 - 5) / 10 for i in range(64)] for k in range(10)])
    rows = scan(spark, folder, "embeddings").select("vec_id", "label", F.col("embedding").alias("features"))
    logits = models.score_network(rows, [models.Layer(weight, np.zeros(10))])
    return rounded(logits.agg(metrics.cross_entropy(F.col("label"), F.col("logits")).alias("cross_entropy")))


BATCHED = """b as (select y, p, (row_number() over (order by ts, event_id) - 1) // 100 as batch from (select ts, event_id, value as y,
    lag(value) over (partition by user_id order by ts, event_id) as p from events) where p is not null)"""


@query(
    "batch_weighted_metrics",
    f"""with {BATCHED}, m as (select count(*) as n, sqrt(avg((p - y) * (p - y))) as rmse, avg(abs(p - y)) as mae from b group by batch)
    select round(sum(rmse * n) / sum(n), 5) as rmse, round(sum(mae * n) / sum(n), 5) as mae from m""",
)
def batch_weighted(spark, folder):
    numbered = batches(naive(spark, folder), 100, "ts", "event_id")
    return rounded(evaluate.batch_weighted(numbered, "y", "p", ["rmse", "mae"]), 5)


@query(
    "custom_batch_metric",
    f"""with {BATCHED}, m as (select count(*) as n, max(abs(p - y)) as worst from b group by batch)
    select round(sum(worst * n) / sum(n), 5) as worst from m""",
)
def custom_metric(spark, folder):
    numbered = batches(naive(spark, folder), 100, "ts", "event_id")
    worst = lambda y, p: (p - y).abs().max()
    return rounded(evaluate.batch_weighted_custom(numbered, "y", "p", worst, "worst"), 5)


# Every user is a run; even and odd events are its training and validation losses.
HISTORY = """h as (select 'run-' || user_id as run_id, case when event_id % 2 = 0 then 'train' else 'val' end as phase,
    row_number() over (partition by user_id, event_id % 2 order by ts, event_id) as epoch, value from events)"""


def history(spark, folder):
    phase = F.when(F.col("event_id") % 2 == 0, "train").otherwise("val")
    order = Window.partitionBy("user_id", phase).orderBy("ts", "event_id")
    return scan(spark, folder, "events").select(
        F.concat(F.lit("run-"), "user_id").alias("run_id"),
        phase.alias("phase"),
        F.row_number().over(order).alias("epoch"),
        F.lit("loss").alias("metric"),
        "value",
    )


@query(
    "epoch_summary",
    f"""with {HISTORY} select run_id, epoch::integer as epoch, max(case when phase = 'train' then value end) as train_loss,
        max(case when phase = 'val' then value end) as val_loss from h group by run_id, epoch""",
)
def epoch_summary(spark, folder):
    return evaluate.epoch_summary(history(spark, folder), ["train_loss", "val_loss"])


@query(
    "last_epoch_metrics",
    f"""with {HISTORY} select run_id, phase || '_loss' as metric, max(epoch)::integer as epoch, arg_max(value, epoch) as value
        from h group by run_id, phase""",
)
def last_epoch(spark, folder):
    named = history(spark, folder).withColumn("metric", F.concat_ws("_", "phase", "metric"))
    return evaluate.last_epoch(named)


def _stopping_sql(better: str, patience: int) -> str:
    return f"""with recursive {HISTORY}, r(run_id, epoch, best, bad, stop) as (
        select run_id, epoch, value, 0, null::bigint from h where phase = 'val' and epoch = 1 union all
        select r.run_id, h.epoch, case when {better} then h.value else r.best end,
            case when {better} then 0 else r.bad + 1 end,
            case when not ({better}) and r.bad + 1 >= {patience} then h.epoch end
        from r join h on h.run_id = r.run_id and h.epoch = r.epoch + 1 and h.phase = 'val' where r.stop is null)
    select run_id, arg_max(best, epoch) as best_score, arg_max(bad, epoch)::integer as bad_epochs,
        max(stop)::integer as stop_epoch, max(stop) is not null as stopped from r group by run_id"""


def monitored(spark, folder):
    return history(spark, folder).withColumn("metric", F.concat_ws("_", "phase", "metric"))


@query("early_stopping_min", _stopping_sql("r.best - h.value > 0.05", 4))
def early_stopping_min(spark, folder):
    return evaluate.early_stopping(monitored(spark, folder), "val_loss", "min", 4, 0.05)


@query("early_stopping_max", _stopping_sql("h.value - r.best > 2.0", 6))
def early_stopping_max(spark, folder):
    return evaluate.early_stopping(monitored(spark, folder), "val_loss", "max", 6, 2.0)


# Losses that fall with noise, so that most runs have far more records than a segment holds.
FALLING = "h as (select run_id, phase, epoch, value - 40e0 * epoch as value from h0)"


@query(
    "early_stopping_pointers",
    _stopping_sql("r.best - h.value > 55e0", 4).replace(HISTORY, HISTORY.replace("h as (", "h0 as (", 1) + ", " + FALLING),
)
def early_stopping_pointers(spark, folder):
    falling = monitored(spark, folder).withColumn("value", F.col("value") - 40.0 * F.col("epoch"))
    return evaluate.early_stopping(falling, "val_loss", "min", 4, 55.0, strategy="segments", segment_rows=5)


@query(
    "non_finite_losses",
    "select count(*) filter (event_id % 10 in (0, 1)) as n_non_finite from events",
)
def non_finite(spark, folder):
    odd = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).when(F.col("event_id") % 10 == 1, F.lit(float("-inf")))
    return evaluate.non_finite_count(scan(spark, folder, "events").withColumn("loss", odd.otherwise(F.col("value"))), "loss")


@query(
    "linear_baseline",
    """with s as (select value as x, lead(value) over w as y, row_number() over w as k, ts, event_id from events
            window w as (partition by user_id order by ts, event_id)),
        f as (select regr_slope(y, x) as b, regr_intercept(y, x) as a from s where y is not null)
    select event_id, round(a + b * x, 5) as prediction from s, f where y is not null""",
)
def linear_baseline(spark, folder):
    events = scan(spark, folder, "events").select("event_id", "ts", "user_id", "value")
    pairs = with_previous(events, value="x", event_id="from_id").where("from_id is not null")
    pairs = pairs.select(F.col("from_id").alias("event_id"), F.array("x").alias("features"), F.col("value").alias("target"))
    scored = models.fit_linear(pairs).predict(pairs)
    return rounded(scored.select("event_id", F.col("prediction")[0].alias("prediction")), 5)


def _solved(name: str, inputs: int, horizon: int, decay: float) -> str:
    """From {name}(z: inputs, then steps; learns): means, and {name}_w with a weight list per input.

    Normal equations by elimination; with decay added no pivot is zero.
    """
    width = inputs + horizon
    return f"""{name}_c as (
            select i, j, covar_pop(z[i], z[j]) + case when i = j then {decay} else 0 end as c
            from {name}, range(1, {inputs + 1}) a(i), range(1, {width + 1}) b(j) where learns group by i, j),
        {name}_m as (select list(c order by i) as m from (select i, list(c order by j) as c from {name}_c group by i)),
        {name}_e as (
            select 1 as k, m from {name}_m
            union all select k + 1, list_transform(m, lambda r, i: case when i = k then list_transform(r, lambda v: v / m[k][k])
                else list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) end) from {name}_e where k <= {inputs}),
        {name}_w as (select list_transform(m, lambda r: r[{inputs + 1}:]) as w from {name}_e where k = {inputs + 1}),
        {name}_b as (select list(mean order by i) as means from (
            select i, avg(z[i]) as mean from {name}, range(1, {width + 1}) a(i) where learns group by i))"""


def _step(inputs: int, h: int) -> str:
    terms = " + ".join(f"w[{k}][{h}] * (z[{k}] - means[{k}])" for k in range(1, inputs + 1))
    return f"means[{inputs + h}] + {terms} - z[{inputs + h}]"


@query(
    "forecast_flow",
    f"""with recursive s as (select *, case when row_number() over (order by ts, event_id) > (select count(*) - greatest(1,
            round_even(count(*) * 0.2::double, 0)) from events) then 'validation' else 'train' end as split from events),
        t as (select split = 'train' as learns, list(value::float::double) over (partition by split, user_id
            order by ts, event_id rows between current row and 9 following) as z from s),
        f as (select * from t where len(z) = 10), {_solved("f", 8, 2, 1e-4)},
        e as (select unnest([{_step(8, 1)}, {_step(8, 2)}]) as gap from f, f_w, f_b where not learns)
    select round(avg(gap * gap), 5) as mse, round(avg(abs(gap)), 5) as mae, round(sqrt(avg(gap * gap)), 5) as rmse from e""",
)
def forecast_flow(spark, folder):
    made = forecast_windows(
        scan(spark, folder, "events"), "ts", "value", 8, 2, 1, ["value"], "user_id", 0.2, ["event_id"]
    )
    return rounded(forecast_metrics(train_forecaster(made, 2, weight_decay=1e-4)), 5)


@query(
    "linear_horizon_weights",
    f"""with recursive s as (select list(value::double) over (partition by user_id order by ts, event_id
            rows between current row and 5 following) as z, true as learns from events),
        f as (select * from s where len(z) = 6), {_solved("f", 3, 3, 0.5)}
    select h as step, i as input, round(w[i][h], 6) + 0.0 as weight from f_w, range(1, 4) a(i), range(1, 4) b(h)""",
)
def linear_horizon_weights(spark, folder):
    """Three steps from three values: the weights of all steps, from one pass."""
    events = scan(spark, folder, "events")
    made = sliding_windows(events, 3, "ts", 3, 1, ["value"], "value", "user_id", "event_id", feature_type="double", target_type="double")
    model = models.fit_linear(flatten_windows(made), "X", "y", 3, weight_decay=0.5)
    rows = [(h + 1, i + 1, w) for h, weights in enumerate(model.coefficients) for i, w in enumerate(weights)]
    found = small_table(spark, rows, "step bigint, input bigint, weight double")
    return rounded(found).withColumn("weight", F.col("weight") + 0.0)


@query(
    "classifier_learns",
    """select concat('part ', o_orderkey % 3) as target, concat('part ', o_orderkey % 3) as found, count(*) as n
    from orders where o_orderkey % 5 = 0 group by all""",
)
def classifier_learns(spark, folder):
    """Counts per true and found label of held-out rows; the classes lie apart, so a model that learns has no other pair."""
    part = F.col("o_orderkey") % 3
    data = scan(spark, folder, "orders").select(
        "o_orderkey",
        F.array(
            (part == 0).cast("double") + F.col("o_totalprice") / 5e6,
            (part == 1).cast("double") * 2 - F.col("o_custkey") / 1e6,
            F.col("o_totalprice") / 1e6,
        ).alias("features"),
        F.concat(F.lit("part "), part).alias("target"),
    )
    labels = models.class_labels(data, "target", 3)
    train = data.where("o_orderkey % 5 <> 0").withColumn("target", models.label_index(F.col("target"), labels))
    scored = models.classify(models.fit_classifier(train, 3, 3, [6], max_iter=60), data.where("o_orderkey % 5 = 0"))
    found = models.index_label(F.col("prediction"), labels)
    return scored.groupBy("target", found.alias("found")).agg(F.count("*").alias("n"))


def small_network(inputs: int = 64, hidden: int = 4, outputs: int = 2):
    """Fixed small weights, so that SQL can follow the same arithmetic."""
    w1 = [[((i * 7 + j * 3) % 11 - 5) / 10 for i in range(inputs)] for j in range(hidden)]
    w2 = [[((i * 5 + j * 2) % 7 - 3) / 4 for i in range(hidden)] for j in range(outputs)]
    b1, b2 = [0.1 * j - 0.2 for j in range(hidden)], [0.05, -0.05]
    return w1, b1, w2, b2


def _network_sql() -> str:
    w1, b1, w2, b2 = small_network()
    dot = lambda w, b: f"list_dot_product(embedding::double[], {w}::double[]) + {b}"
    hidden = ", ".join(f"greatest({dot(w, b)}, 0) as h{j}" for j, (w, b) in enumerate(zip(w1, b1)))
    outs = [" + ".join([f"{v} * h{i}" for i, v in enumerate(w)] + [str(b)]) for w, b in zip(w2, b2)]
    return f"""with h as (select vec_id, {hidden} from embeddings)
        select vec_id, round({outs[0]}, 5) + 0.0 as logit_0, round({outs[1]}, 5) + 0.0 as logit_1 from h"""


@query("network_scoring", _network_sql())
def network_scoring(spark, folder):
    w1, b1, w2, b2 = (np.array(v) for v in small_network())
    layers = [models.Layer(w1, b1, "relu"), models.Layer(w2, b2)]
    scored = models.score_network(scan(spark, folder, "embeddings").select("vec_id", "embedding"), layers, "embedding")
    made = rounded(scored.select("vec_id", *[F.col("logits")[k].alias(f"logit_{k}") for k in range(2)]), 5)
    return made.withColumns({f"logit_{k}": F.col(f"logit_{k}") + 0.0 for k in range(2)})


@query(
    "classifier_baseline",
    "select 'class ' || label as target, count(*) as n_held, count(*) as n_labelled from embeddings where vec_id % 5 = 0 group by label",
)
def classifier_baseline(spark, folder):
    """Rows per class that were not learned from, all with one of the labels; what was found is in ``classifier_confusion``."""
    scored, labels = held_out_classes(spark, folder)
    return scored.groupBy("target").agg(F.count("*").alias("n_held"), F.count_if(F.col("found").isin(labels)).alias("n_labelled"))


@query("classifier_confusion")
def classifier_confusion(spark, folder):
    """Held-out rows per true and predicted label, and the accuracy over all of them."""
    scored, _ = held_out_classes(spark, folder)
    counts = scored.groupBy("target", "found").agg(F.count("*").alias("n"))
    right = scored.agg(F.avg((F.col("target") == F.col("found")).cast("int")).alias("accuracy"))
    return counts.crossJoin(F.broadcast(right))


def held_out_classes(spark, folder):
    """Text labels and the label found for them, of rows that were not learned from; and all labels."""
    data = scan(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").alias("features"), F.concat(F.lit("class "), F.col("label")).alias("target")
    )
    labels = models.class_labels(data, "target", 20)
    train, held = data.where("vec_id % 5 <> 0"), data.where("vec_id % 5 = 0")
    indexed = train.withColumn("target", models.label_index(F.col("target"), labels))
    scored = models.classify(models.fit_classifier(indexed, 64, len(labels), [16], max_iter=40), held)
    return written(scored.select("vec_id", "target", models.index_label(F.col("prediction"), labels).alias("found")), "classified"), labels


@query(
    "tabular_flow_planted",
    "select ceil(count(*) * 0.2::double)::bigint as n_held, 0.0::double as mse, 0.0::double as mae from lineitem",
)
def tabular_flow_planted(spark, folder):
    """The whole flow on a target that two columns make up: a model that learns leaves nothing over."""
    lines = scan(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), "l_quantity", "l_discount"
    )
    planted = (F.col("l_quantity") * 3 - F.col("l_discount") * 2 + 0.125).cast("double")
    trained = train_tabular(lines.withColumn("y", planted), "y", "id")
    gap = F.col("target") - F.col("prediction")
    found = trained.predictions.agg(F.count("*").alias("n_held"), F.avg(gap * gap).alias("mse"), F.avg(F.abs(gap)).alias("mae"))
    return rounded(found, 4)


@query("tabular_flow")
def tabular_flow(spark, folder):
    trained = train_tabular(scan(spark, folder, "lineitem"), "l_extendedprice")
    return evaluate.score(trained.predictions, "target", "prediction", ["mse", "mae", "rmse"])


@query(
    "flattened_windows",
    """with r as (select user_id, value, row_number() over (partition by user_id order by ts, event_id) - 1 as i,
            count(*) over (partition by user_id) as n from events)
    select user_id, (n - 8) // 4 + 1 as n_windows, 5 as width, 3 as horizon from r where i = 0 and n >= 8""",
)
def flattened_windows(spark, folder):
    events = scan(spark, folder, "events").select("event_id", "ts", "user_id", "value")
    made = sliding_windows(events, 5, "ts", H, 4, ["value"], "value", "user_id", "event_id")
    flat = flatten_windows(made)
    return flat.groupBy("user_id").agg(
        F.count("*").alias("n_windows"), F.max(F.size("X")).alias("width"), F.max(F.size("y")).alias("horizon")
    )
