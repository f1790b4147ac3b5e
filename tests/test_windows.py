import pytest
from pyspark.sql import functions as F

from rowloom.errors import DataError
from rowloom.operators import windows
from rowloom.plans.flows import forecast_windows

PLANS = [{"strategy": "plain"}, {"strategy": "segments", "segment_rows": 3}, {"strategy": "segments", "segment_rows": 7}]


def cut(df, w, h, step=1, **options):
    return windows.sliding_windows(df, w, "timestamp", h, step, ["feat1", "feat2"], "target", **options)


def expected_count(total, w, h, step):
    return len(range(0, total - w - h + 1, step)) if total >= w + h else 0


@pytest.mark.parametrize("plan", PLANS)
def test_first_window(hourly, plan):
    first = cut(hourly, 3, 2, **plan).orderBy("start").first()
    assert first["start"] == 0
    assert first["X"] == [[0.0, 0.0], [1.0, 2.0], [2.0, 4.0]]
    assert first["y"] == [[0.0], [1.0]]


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("w, h, step", [(3, 2, 1), (3, 1, 2), (4, 1, 2), (2, 2, 5), (1, 1, 20), (12, 5, 1), (11, 1, 1)])
def test_counts_follow_the_formula(hourly, plan, w, h, step):
    made = cut(hourly, w, h, step, **plan)
    n = expected_count(12, w, h, step)
    assert made.count() == n
    meta = windows.window_metadata(hourly, w, ["feat1", "feat2"], "target", None, h, step).first()
    assert (meta["num_samples"], meta["num_features"], meta["num_targets"], meta["total_length"]) == (n, 2, 1, 12)


@pytest.mark.parametrize("step", [1, 4])
def test_windows_of_skewed_series(skewed, step):
    outs = []
    for plan in ({"strategy": "plain"}, {"strategy": "segments", "segment_rows": 60}):
        made = windows.sliding_windows(skewed, 6, "t", 2, step, ["v"], "v", "series", "event_id", **plan)
        outs.append(made.select("series", "start", F.to_json("X").alias("x"), F.to_json("y").alias("y")))
    assert outs[0].count() > 0
    assert outs[0].exceptAll(outs[1]).count() == 0 and outs[1].exceptAll(outs[0]).count() == 0


def test_missing_rows_are_dropped_first(hourly):
    gappy = hourly.withColumn("feat1", F.when(F.hour("timestamp") != 4, F.col("feat1")))
    assert cut(gappy, 3, 2).count() == expected_count(11, 3, 2, 1)
    assert cut(gappy, 3, 2, dropna=False).count() == 8


def test_integer_targets_stay_integers(hourly):
    made = windows.sliding_windows(
        hourly.withColumn("c", F.hour("timestamp")), 3, "timestamp", 1, 1, ["feat1"], "c", feature_type="double"
    )
    assert dict(made.dtypes) == {"start": "bigint", "X": "array<array<double>>", "y": "array<array<bigint>>"}
    assert "y" not in windows.sliding_windows(hourly, 3, "timestamp").columns


def test_error_codes(hourly):
    cases = [
        (dict(input_window=0), "ts_invalid_input_window"),
        (dict(prediction_horizon=0), "ts_invalid_prediction_horizon"),
        (dict(step_size=0), "ts_invalid_step_size"),
        (dict(order_by="absent"), "ts_sort_by_missing"),
        (dict(value_columns=["absent"]), "ts_value_columns_missing"),
        (dict(target_column="absent"), "ts_target_missing"),
        (dict(series="absent"), "ts_missing_group_column"),
        (dict(input_window=12, on_short="error"), "ts_series_too_short"),
    ]
    for options, code in cases:
        with pytest.raises(DataError) as error:
            windows.sliding_windows(hourly, **{"input_window": 3, "order_by": "timestamp", **options})
        assert error.value.code == code
    with pytest.raises(DataError) as error:
        windows.sliding_windows(hourly.select("timestamp", "target"), 3, "timestamp", target_column="target")
    assert error.value.code == "ts_no_value_columns"


def test_design_and_short_series(hourly):
    rows = windows.window_design(hourly, 5, 2, n_features=2).orderBy("candidate").collect()
    assert [(r["input_window"], r["prediction_horizon"], r["n_sequences"]) for r in rows] == [(5, 2, 6), (10, 2, 1), (5, 4, 4)]
    assert rows[0]["x_shape"] == [5, 2] and rows[0]["y_shape"] == [2, 1]
    none = windows.window_design(hourly, 12, 1).where("candidate = 0").first()
    assert none["n_sequences"] == 0 and none["x_shape"] is None
    two = hourly.withColumn("s", F.when(F.hour("timestamp") < 3, "short").otherwise("long"))
    assert [r["s"] for r in windows.short_series(two, "s", 4, 1).collect()] == ["short"]
    assert windows.window_choice(5, 2) == {"input_window": 5, "prediction_horizon": 2, "step_size": 1}


def test_windows_stay_within_their_split(hourly):
    made = forecast_windows(hourly, "timestamp", "target", 2, 1, 1, ["feat1"], None, 0.34, feature_type="double")
    seen = {(r["split"], r["start"]): [x[0] for x in r["X"]] for r in made.collect()}
    assert seen[("validation", 0)] == [8.0, 9.0]
    assert sorted(k for k in seen) == [("train", i) for i in range(6)] + [("validation", 0), ("validation", 1)]


def test_stepped_windows_need_one_shuffle(skewed):
    from conftest import plan_of

    made = windows.sliding_windows(skewed, 6, "t", 2, 4, ["v"], "v", "series", "event_id", strategy="plain")
    assert plan_of(made).count("Exchange") == 1
