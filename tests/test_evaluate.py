import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowloom.errors import ModelError, TrainingError
from rowloom.functions import metrics
from rowloom.operators import evaluate, models, stopping


def runs(spark, values, metric="val_loss"):
    return spark.createDataFrame(
        [("r", i, metric, v) for i, v in enumerate(values)], "run_id string, epoch int, metric string, value double"
    )


@pytest.mark.parametrize(
    "values, mode, patience, min_delta, best, bad, stop",
    [
        ([1.0, 0.95, 0.96, 0.97, 0.98], "min", 2, 0.1, 1.0, 2, 2),
        ([0.5, 0.55, 0.56, 0.56, 0.55], "max", 2, 0.05, 0.55, 2, 3),
        ([1.0, 1.05, 1.04, 0.85, 0.9, 0.95, 0.96], "min", 2, 0.1, 1.0, 2, 2),
        ([1.0, 0.9, 0.8], "min", 2, 0.0, 0.8, 0, None),
        ([1.0, 1.0, 0.5, 0.6], "MIN", 3, 0.0, 0.5, 1, None),
        ([math.nan, 1.0, 0.5], "min", 5, 0.0, math.nan, 2, None),
        ([1.0, math.nan, 0.5, math.nan], "min", 2, 0.0, 0.5, 1, None),
        ([1.0], "min", 1, 0.0, 1.0, 0, None),
    ],
)
def test_early_stopping(spark, values, mode, patience, min_delta, best, bad, stop):
    row = evaluate.early_stopping(runs(spark, values), "val_loss", mode, patience, min_delta).first()
    assert row["best_score"] == pytest.approx(best, nan_ok=True)
    assert (row["bad_epochs"], row["stop_epoch"], row["stopped"]) == (bad, stop, stop is not None)


@pytest.mark.parametrize("plan", [{"strategy": "plain"}, {"strategy": "segments", "segment_rows": 30}])
def test_early_stopping_equals_a_plain_replay(spark, plan):
    rng = np.random.default_rng(1)
    values = {f"r{k}": rng.normal(size=40).round(2).tolist() for k in range(20)}
    rows = [(k, i, "val_loss", v) for k, vs in values.items() for i, v in enumerate(vs)]
    history = spark.createDataFrame(rows, "run_id string, epoch int, metric string, value double")
    for r in evaluate.early_stopping(history, "val_loss", "max", 7, 0.3, **plan).collect():
        best, bad, stop = None, 0, None
        for i, v in enumerate(values[r["run_id"]]):
            if best is None or v - best > 0.3:
                best, bad = v, 0
            else:
                bad += 1
                if bad >= 7:
                    stop = i
                    break
        assert (r["best_score"], r["bad_epochs"], r["stop_epoch"]) == (best, bad, stop)


def test_stopping_errors(spark):
    with pytest.raises(TrainingError) as error:
        evaluate.early_stopping(runs(spark, [1.0]), mode="best")
    assert error.value.code == "early_stopping_bad_mode"
    with pytest.raises(TrainingError) as error:
        evaluate.require_metric(runs(spark, [1.0], "loss"), "val_loss")
    assert error.value.code == "early_stopping_missing_metric"


def test_weighted_batches_differ_from_global_rmse(spark):
    rows = [(0, 0.0, 1.0), (0, 0.0, 1.0), (1, 0.0, 4.0)]
    df = spark.createDataFrame(rows, "batch int, y double, p double")
    assert evaluate.batch_weighted(df, "y", "p", ["rmse"]).first()["rmse"] == pytest.approx(2.0)
    assert evaluate.score(df, "y", "p", ["rmse"]).first()["rmse"] == pytest.approx(math.sqrt(6))
    top = evaluate.batch_weighted_custom(df, "y", "p", lambda y, p: (p - y).max(), "top").first()["top"]
    assert top == pytest.approx(2.0)
    with pytest.raises(PySparkException, match="metric_computation_error"):
        evaluate.batch_weighted_custom(df, "y", "p", lambda y, p: 1 / 0, "top").collect()
    with pytest.raises(TrainingError) as error:
        evaluate.require_samples(df.limit(0))
    assert error.value.code == "no_samples_seen"
    with pytest.raises(TrainingError) as error:
        evaluate.score(df, "y", "p", ["r2"])
    assert error.value.code == "metric_computation_error"


def test_losses(spark):
    df = spark.createDataFrame([(1, 800.0, [1.0, 3.0]), (0, -800.0, [2.0, 1.0])], "y int, z double, l array<double>")
    row = df.agg(
        metrics.binary_log_loss(F.col("y"), F.col("z")).alias("b"), metrics.cross_entropy(F.col("y"), F.col("l")).alias("c")
    ).first()
    assert row["b"] == 0.0
    assert row["c"] == pytest.approx((math.log1p(math.exp(-2)) + math.log1p(math.exp(-1))) / 2)
    odd = spark.createDataFrame([(1.0,), (math.nan,), (-math.inf,)], "x double")
    assert evaluate.non_finite_count(odd, "x").first()[0] == 2
    with pytest.raises(TrainingError) as error:
        evaluate.refuse_non_finite(odd, "x")
    assert error.value.code == "non_finite_loss"


def test_linear_model_recovers_the_line(spark):
    xs = np.linspace(-1, 1, 64)
    df = spark.createDataFrame([([float(x)], float(3 * x - 2)) for x in xs], "features array<double>, target double")
    model = models.fit_linear(df)
    assert model.coefficients[0][0] == pytest.approx(3.0) and model.intercepts[0] == pytest.approx(-2.0)
    scored = model.predict(df).withColumn("p", F.col("prediction")[0])
    assert evaluate.score(scored, "target", "p", ["mse"]).first()["mse"] < 1e-12


def test_all_steps_from_one_pass(spark):
    """Against numpy on columns of very different size, one constant and one the sum of two others."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5)) * [1, 1e4, 1e-3, 0, 1] + [0, 1e6, 5, 7, 0]
    x[:, 4] = x[:, 0] * 2
    y = x[:, [0, 1, 2]] @ rng.normal(size=(3, 4)) + rng.normal(size=(300, 4)) * 0.01 + 3
    df = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in zip(x, y)], "features array<double>, target array<double>")
    df = df.repartition(5)
    model = models.fit_linear(df, horizon=4)
    xc = x - x.mean(axis=0)
    scored = model.predict(df).select("features", "prediction").collect()
    ols = np.linalg.lstsq(np.hstack([xc[:, :3] / xc[:, :3].std(axis=0)]), y - y.mean(axis=0), rcond=None)[0]
    fitted = (xc[:, :3] / xc[:, :3].std(axis=0)) @ ols + y.mean(axis=0)
    expected = {tuple(a): b for a, b in zip(x, fitted)}
    for r in scored:
        assert r.prediction == pytest.approx(list(expected[tuple(r.features)]), rel=1e-6, abs=1e-6)
    assert all(w[3] == 0.0 for w in model.coefficients)

    decay = 0.3
    model = models.fit_linear(df, horizon=4, weight_decay=decay)
    ridge = np.linalg.solve(xc.T @ xc / 300 + decay * np.eye(5), xc.T @ (y - y.mean(axis=0)) / 300)
    assert np.array(model.coefficients).T == pytest.approx(ridge, rel=1e-5, abs=1e-9)


@pytest.mark.parametrize("row, code", [([1.0], "linear_bad_input_shape"), ([1.0, None], "linear_bad_input_shape"), ([1.0, math.nan], "linear_not_finite")])
def test_linear_rows_must_be_whole(spark, row, code):
    df = spark.createDataFrame([([1.0, 2.0], 1.0), (row, 2.0)], "features array<double>, target double")
    with pytest.raises(Exception) as error:
        models.fit_linear(df)
    assert code in str(error.value) or getattr(error.value, "code", None) == code
    with pytest.raises(ModelError):
        models.fit_linear(df.limit(0))


def test_network_layers(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(7, 3))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "i int, features array<double>")
    w, b = rng.normal(size=(4, 3)), rng.normal(size=4)
    gain, shift = rng.normal(size=4), rng.normal(size=4)
    mean, var = rng.normal(size=4), rng.uniform(1, 2, size=4)
    h = x @ w.T + b
    expected = {
        "batch": (h - mean) / np.sqrt(var + 1e-5) * gain + shift,
        "layer": (h - h.mean(1, keepdims=True)) / np.sqrt(h.var(1, keepdims=True) + 1e-5) * gain + shift,
        None: h,
    }
    for norm, want in expected.items():
        layer = models.Layer(w, b, None, norm, mean, var, gain, shift)
        got = models.score_network(df, [layer]).orderBy("i").collect()
        assert np.allclose([r["logits"] for r in got], want)
    gelu = models.forward([models.Layer(np.eye(1), np.zeros(1), "gelu")], np.array([[1.0], [-1.0]]))
    assert gelu[:, 0] == pytest.approx([0.8413447, -0.1586553], abs=1e-6)
    with pytest.raises(PySparkException, match="tabular_mlp_bad_input_shape"):
        models.score_network(df.withColumn("features", F.slice("features", 1, 2)), [models.Layer(w, b)]).collect()
    with pytest.raises(ModelError) as error:
        models.score_network(df, [models.Layer(w, b, "step")])
    assert error.value.code == "tabular_mlp_bad_activation"
    best = models.score_network(df, [models.Layer(w, b)]).orderBy("i").select(models.predicted_class(F.col("logits")))
    assert [r[0] for r in best.collect()] == h.argmax(1).tolist()


def test_class_labels(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "y string")
    labels = models.class_labels(df, "y", 3)
    assert labels == ["a", "b", "c"]
    index = models.label_index(F.col("y"), labels)
    rows = df.select("y", index.alias("i"), models.index_label(index, labels).alias("back")).collect()
    assert [(r.y, r.i, r.back) for r in rows] == [("b", 1, "b"), ("a", 0, "a"), (None, None, None), ("c", 2, "c"), ("a", 0, "a")]
    with pytest.raises(ModelError) as error:
        models.class_labels(df, "y", 2)
    assert error.value.code == "tabular_mlp_bad_num_classes"
    with pytest.raises(ModelError):
        models.fit_classifier(df, 1, 1)
    x = np.linspace(-8, 8, 4001)
    assert np.abs(models._erf(x) - [math.erf(v) for v in x]).max() < 4e-15


def test_early_stopping_gathers_no_run(spark):
    """Every epoch of a steadily falling loss is a record."""
    falling = spark.range(20000).selectExpr("'r' as run_id", "cast(id as int) as epoch", "'val_loss' as metric", "-cast(id as double) as value")
    odd = spark.createDataFrame(
        [("nulls", 0, "val_loss", None), ("nulls", 1, "val_loss", 2.0), ("nulls", 2, "val_loss", 1.0), (None, 0, "val_loss", 1.0)],
        "run_id string, epoch int, metric string, value double",
    )
    made = evaluate.early_stopping(falling.union(odd), patience=3)
    assert "collect_list" not in made._jdf.queryExecution().executedPlan().toString()
    rows = {r.run_id: tuple(r)[1:] for r in made.collect()}
    assert rows == {"r": (-19999.0, 0, None, False), "nulls": (None, 2, None, False), None: (1.0, 0, None, False)}


def replay(values, patience, min_delta):
    """best score, bad epochs and stop epoch of one run, epoch by epoch."""
    best, bad = values[0], 0
    for epoch, v in enumerate(values[1:], 1):
        best, bad = (v, 0) if best - v > min_delta else (best, bad + 1)
        if bad >= patience:
            return best, bad, epoch
    return best, bad, None


@pytest.mark.parametrize("patience, min_delta", [(3, 0.0), (7, 0.1), (40, 1.0), (400, 3.0), (5, math.inf)])
def test_long_runs_follow_pointers(spark, patience, min_delta):
    """Runs of many records, cut into segments of 50 places: as the replay says."""
    draw = np.random.default_rng(11)
    fall = lambda n, noise: (np.linspace(30, 0, n) + noise * draw.normal(size=n)).tolist()
    values = {"smooth": fall(900, 0.0), "noisy": fall(700, 0.05), "wild": fall(600, 2.0), "one": [4.0], "flat": [2.0] * 90}
    values["tenths"] = [100 - k / 10 for k in range(800)]
    values["ends"] = [math.inf, 5.0, 4.0, -math.inf, -math.inf, 3.0]
    values[None] = [math.nan, *fall(80, 0.0)]
    rows = [(k, i, "val_loss", v) for k, vs in values.items() for i, v in enumerate(vs)]
    history = spark.createDataFrame(rows, "run_id string, epoch int, metric string, value double")
    made = evaluate.early_stopping(history, "val_loss", "min", patience, min_delta, strategy="segments", segment_rows=50)
    assert made.count() == len(values)
    for r in made.collect():
        best, bad, stop = replay(values[r["run_id"]], patience, min_delta)
        assert r["best_score"] == pytest.approx(best, nan_ok=True, rel=0, abs=0), r
        assert (r["bad_epochs"], r["stopped"]) == (bad, stop is not None), r
        assert r["stop_epoch"] == stop


def test_blocks_of_pointers_are_followed_many_at_once(spark):
    """No call of Python per block; blocks that reach over Arrow batches; runs of strings, NULL and structs."""
    draw = np.random.default_rng(2)
    rows, ends = [], {}
    for run in ["a", "b", None]:
        places = sorted({1, *draw.integers(1, 300, 120).tolist()})
        to = {i: places[min(k + int(draw.integers(0, 3)), len(places) - 1)] for k, i in enumerate(places)}
        for i in places:
            j = i
            while to[j] != j and j // 40 == i // 40:
                j = to[j]
            rows.append((run, i, to[i]))
            ends[run, i] = j
    pointers = spark.createDataFrame(rows, "run_id string, i long, to long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        left = stopping._leave_blocks(pointers, 40)
        assert "FlatMapGroups" not in left._jdf.queryExecution().executedPlan().toString()
        assert {(r.run_id, r.i): r.to for r in left.collect()} == ends
        nested = stopping._leave_blocks(pointers.withColumn("run_id", F.struct("run_id")), 40)
        assert {(r.run_id.run_id, r.i): r.to for r in nested.collect()} == ends
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_improving_bound_is_exact():
    draw = np.random.default_rng(5)
    best = np.concatenate([draw.normal(size=500) * 10.0 ** draw.integers(-300, 300, 500), [0.0, -0.0, 5e-324, math.inf, -math.inf, math.nan]])
    for delta in (0.0, 1e-300, 0.1, 1e10):
        bound = stopping.improving_bound(best, delta)
        for b, x in zip(best.tolist(), bound.tolist()):
            if math.isnan(x):
                assert not b - -math.inf > delta
            else:
                assert b - x > delta and not b - math.nextafter(x, math.inf) > delta


def test_held_out_classes_are_counted(spark, tmp_path):
    import collections

    from rowloom.plans.catalog import evaluation
    from rowloom.plans.catalog.registry import QUERIES

    draw = np.random.default_rng(3)
    labels = [int(k) for k in draw.choice(3, 600, p=[0.5, 0.3, 0.2])]
    centres = draw.normal(size=(3, 64))
    rows = [(i, (centres[k] + draw.normal(size=64)).tolist(), k) for i, k in enumerate(labels)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    scored, _ = evaluation.held_out_classes(spark, str(tmp_path))
    each = {r.vec_id: (r.target, r.found) for r in scored.collect()}
    assert {i: t for i, (t, _) in each.items()} == {i: f"class {k}" for i, k in enumerate(labels) if i % 5 == 0}
    found = QUERIES["classifier_confusion"](spark, str(tmp_path)).collect()
    assert {(r.target, r.found): r.n for r in found} == collections.Counter(each.values())
    right = sum(t == f for t, f in each.values()) / len(each)
    assert all(abs(r.accuracy - right) < 1e-12 for r in found)
    majority = max(collections.Counter(t for t, _ in each.values()).values()) / len(each)
    assert right > majority + 0.3


def test_executors_need_no_copy_of_the_package(tmp_path):
    """Run from a folder that does not hold the package: functions must travel with the job."""
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parent.parent
    script = f"""
import sys
sys.path.insert(0, {str(root)!r})
import numpy as np
from rowloom.operators import evaluate, models
from rowloom.session import local_session
spark = local_session(2)
df = spark.createDataFrame([([1.0, 2.0], 0, 1.0, 2.0)], "features array<double>, batch int, y double, p double")
layers = [models.Layer(np.ones((1, 2)), np.zeros(1), "gelu")]
assert abs(models.score_network(df, layers).first()["logits"][0] - 2.99595) < 1e-4
assert evaluate.batch_weighted_custom(df, "y", "p", lambda a, b: (b - a).sum(), "m").first()["m"] == 1.0
print("travelled")
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "travelled" in done.stdout, done.stderr[-2000:]


def test_unbounded_batches_and_names_are_refused(spark, monkeypatch):
    df = spark.range(30).selectExpr("id div 20 as batch", "double(id) as y", "id + 1D as p")
    gap = lambda y, p: float((p - y).mean())
    assert evaluate.batch_weighted_custom(df, "y", "p", gap, "gap").first()["gap"] == 1.0
    monkeypatch.setattr(evaluate, "MAX_BATCH_ROWS", 19)
    with pytest.raises(TrainingError) as error:
        evaluate.batch_weighted_custom(df, "y", "p", gap, "gap")
    assert error.value.code == "metric_batch_too_large"
    history = spark.createDataFrame([("r", "train", 1, "loss", 0.5), ("r", "val", 1, "loss", 0.7)], "run_id string, phase string, epoch int, metric string, value double")
    assert evaluate.epoch_summary(history).columns == ["run_id", "epoch", "train_loss", "val_loss"]
    monkeypatch.setattr(evaluate, "MAX_NAMES", 1)
    with pytest.raises(TrainingError) as error:
        evaluate.epoch_summary(history)
    assert error.value.code == "too_many_metrics"


def test_next_improvements_come_from_one_pass(spark, monkeypatch):
    """A patience within a segment needs no order of values: no bounds, no questions among the records."""
    from rowloom.operators import stopping

    monkeypatch.setattr(stopping, "_pointers", None)
    draw = np.random.default_rng(5)
    values = {f"r{k}": (np.linspace(20, 0, 300) + 0.03 * draw.normal(size=300)).tolist() for k in range(4)}
    values[None] = [math.nan, 3.0, 2.0, 1.9, 1.8]
    records = [(run, i, v) for run, vs in values.items() for i, v in enumerate(vs, 1) if i == 1 or not v >= np.fmin.reduce(vs[: i - 1])]
    frame = spark.createDataFrame(records, "run_id string, i int, v double")
    for patience, min_delta, segment_rows in [(4, 0.15, 5), (9, 0.5, 9), (1, 0.0, 200), (6, 0.0, 16)]:
        got = {r.run_id: (r.best, r["at"]) for r in stopping.last_improvement(frame, patience, min_delta, segment_rows).collect()}
        for run in values:
            kept = [(i, v) for r, i, v in records if r == run]
            at, best = kept[0]
            for i, v in kept[1:]:
                if i - at > patience:
                    break
                if best - v > min_delta:
                    at, best = i, v
            assert got[run] == (pytest.approx(best, nan_ok=True, rel=0, abs=0), at), (run, patience)
