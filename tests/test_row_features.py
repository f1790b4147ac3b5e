import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import column
from rowloom.errors import DataError, ModelError
from rowloom.functions import numeric
from rowloom.functions.coerce import number, strict_moment
from rowloom.operators import tables
from rowloom.operators.row_features import (
    RowFeatures,
    add_shifted_log1p,
    build_row_features,
    coercion_report,
    parse_date_columns,
)


def test_calendar_of_text_with_gaps(spark):
    texts = ["2020-01-01", "bad", None, "2020-02-29 13:00:00", "2021-01-03"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    out = build_row_features(df, RowFeatures(["t"], drop_original_datetime=True))
    assert "t" not in out.columns
    assert column(out, "t__weekofyear", "i") == [1, None, None, 9, 53]
    assert column(out, "t__is_weekend", "i") == [0, 0, 0, 1, 1]
    assert column(out, "t__is_month_end", "i") == [0, 0, 0, 1, 0]
    assert column(out, "t__is_month_start", "i") == [1, 0, 0, 0, 0]
    assert column(out, "t__hour", "i") == [0, None, None, 13, 0]


def test_integer_times_are_refused(spark):
    with pytest.raises(DataError) as error:
        build_row_features(spark.range(3), RowFeatures(["id"]))
    assert error.value.code == "feature_datetime_conversion_error"


def test_ratio_power_interaction(spark):
    df = spark.createDataFrame([(0, "1", "2"), (1, "1", "0"), (2, "x", "2"), (3, None, "1")], "i int, n string, d string")
    spec = RowFeatures(ratio_features={"r": ("n", "d")}, interaction_features={"p": ("n", "d"), "rr": ("r", "r")})
    out = build_row_features(df, spec)
    assert column(out, "r", "i") == [0.5, None, None, None]
    assert column(out, "p", "i") == [2.0, 0.0, None, None]
    assert column(out, "rr", "i") == [0.25, None, None, None]
    roots = build_row_features(
        spark.createDataFrame([(-8.0,), (0.0,), (4.0,)], "x double"), RowFeatures(power_features={"y": ("x", 0.5)})
    )
    assert column(roots, "y", "x") == [None, 0.0, 2.0]


def test_log1p_checks(spark):
    good = spark.createDataFrame([("0",), (None,), ("1",)], "x string")
    out = build_row_features(good, RowFeatures(log1p_columns=["x"]))
    assert [None if v is None else round(v, 6) for v in column(out, "x__log1p", "x")] == [None, 0.0, 0.693147]
    for bad, code in (("-1", "feature_log1p_negative_values"), ("a", "feature_log1p_non_numeric")):
        df = spark.createDataFrame([("0",), (bad,)], "x string")
        with pytest.raises(DataError) as error:
            build_row_features(df, RowFeatures(log1p_columns=["x"]))
        assert error.value.code == code
        with pytest.raises(PySparkException, match=code):
            build_row_features(df, RowFeatures(log1p_columns=["x"]), validate="lazy").collect()


@pytest.mark.parametrize(
    "spec, code",
    [
        (RowFeatures(["absent"]), "feature_missing_datetime_columns"),
        (RowFeatures(log1p_columns=["absent"]), "feature_missing_log1p_columns"),
        (RowFeatures(ratio_features={"r": ("id", "absent")}), "feature_missing_ratio_columns"),
        (RowFeatures(power_features={"r": ("absent", 2)}), "feature_missing_power_source"),
        (RowFeatures(interaction_features={"r": ("absent", "id")}), "feature_missing_interaction_columns"),
    ],
)
def test_missing_columns(spark, spec, code):
    with pytest.raises(DataError) as error:
        build_row_features(spark.range(2), spec)
    assert error.value.code == code


def test_later_feature_reads_overwritten_column(spark):
    df = spark.createDataFrame([(2.0, 4.0)], "a double, b double")
    spec = RowFeatures(ratio_features={"b": ("a", "b")}, power_features={"c": ("b", 2)})
    assert build_row_features(df, spec).first().asDict() == {"a": 2.0, "b": 0.5, "c": 0.25}


def test_number_parsing(spark):
    texts = [" 1 ", "1e3", "1d", "2.5f", "nan", "inf", "", "1_0", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = column(df.select("i", number(df, "x").alias("n")), "n", "i")
    assert got == [1.0, 1000.0, None, None, None, math.inf, None, None, None]
    report = coercion_report(df, numbers=["x"]).first()
    assert report["n_invalid"] == 5


def test_strict_time_fails(spark):
    df = spark.createDataFrame([("2020-01-01",), ("bad",)], "t string")
    with pytest.raises(PySparkException):
        df.select(strict_moment(df, "t")).collect()


def test_detected_dates(spark):
    df = spark.createDataFrame([("2020-01-01", "x"), (None, "2020-01-02")], "a string, b string")
    assert dict(parse_date_columns(df).dtypes) == {"a": "timestamp_ntz", "b": "string"}
    assert dict(parse_date_columns(df, max_cols=0).dtypes) == {"a": "string", "b": "string"}


def test_shifted_log1p(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,)], "x double")
    got = column(add_shifted_log1p(df, ["x"]), "x_log1p", "x")
    assert got == pytest.approx([math.log1p(1e-6), math.log1p(3 + 1e-6)])


def test_matrix_contract(spark):
    df = spark.createDataFrame([(1.0, 0.5, 0.0), (2.0, 1.5, 1.0), (3.0, 2.5, 0.0)], "feat1 double, feat2 double, target double")
    rows = tables.assemble(df, "target").orderBy("features").collect()
    assert [r["features"] for r in rows] == [[1.0, 0.5], [2.0, 1.5], [3.0, 2.5]]
    meta = tables.matrix_metadata(df, ["feat1", "feat2"], "target").first()
    assert (meta["num_samples"], meta["num_features"], meta["feature_names"], meta["target_name"]) == (
        3, 2, ["feat1", "feat2"], "target",
    )
    for kwargs, code in (
        ({"target_column": "absent"}, "tabular_target_missing"),
        ({"target_column": ["a", "b"]}, "tabular_targets_multi_column"),
        ({"drop_columns": ["feat1", "feat2", "target"]}, "tabular_no_features_after_drop"),
        ({"feature_columns": ["absent"]}, "tabular_feature_names_mismatch"),
    ):
        with pytest.raises(DataError) as error:
            tables.assemble(df, **kwargs)
        assert error.value.code == code
    with pytest.raises(DataError) as error:
        tables.assemble(df.limit(0), "target", refuse_empty=True)
    assert error.value.code == "tabular_df_empty"


def test_roles(spark):
    df = spark.createDataFrame([(1, "a", True, 2.0)], "i int, s string, b boolean, x double")
    assert tables.infer_roles(df) == (["i", "x"], ["s", "b"])
    assert tables.infer_roles(df, numeric=["i"], categorical=["i", "s"], drop=["s"]) == (["i"], [])
    for kwargs, code in (
        ({"numeric": ["absent"]}, "missing_numeric_features"),
        ({"categorical": ["absent"]}, "missing_categorical_features"),
        ({"drop": ["i", "s", "b", "x"]}, "no_features_after_inference"),
    ):
        with pytest.raises(DataError) as error:
            tables.infer_roles(df, **kwargs)
        assert error.value.code == code
    with pytest.raises(DataError) as error:
        tables.select_numeric(df.select("s"))
    assert error.value.code == "no_numeric_features"
    for args, code in ((("absent",), "missing_target_column"), (("x", "absent"), "missing_id_column")):
        with pytest.raises(DataError) as error:
            tables.features_and_target(df, *args)
        assert error.value.code == code
    assert {r["column"]: r["present"] for r in tables.audit_columns(df, ["i", "z"]).collect()} == {"i": True, "z": False}


def test_dropped_rows_are_counted_on_the_way(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "i int, x double")
    kept, seen = tables.drop_missing(df, ["x"], "dropped")
    assert [r["i"] for r in kept.collect()] == [1]
    assert seen.get["dropped"] == 2
    same, counted = tables.with_row_count(df, "rows")
    same.collect()
    assert counted.get["rows"] == 3


def test_problem_types(spark):
    df = spark.range(100).selectExpr("id % 20 as few", "id % 21 as many", "id * 0.5 as x", "string(id) as s", "id > 3 as b")
    kind = lambda c, **k: tuple(tables.infer_problem(df, c, **k).first())
    assert kind("few") == ("classification", 20)
    assert kind("many") == ("regression", None)
    assert kind("x") == ("regression", None)
    assert kind("s") == ("classification", 100)
    assert kind("b") == ("classification", 2)
    assert kind("many", requested="classification", num_classes=7) == ("classification", 7)


def test_concatenation_of_nothing(spark):
    assert tables.concatenate([], spark).count() == 0


def test_activations(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (3.0,)], "x double")
    at = lambda name: column(df.withColumn("y", numeric.activation(name, F.col("x"))), "y", "x")
    assert at("relu") == [0.0, 0.0, 3.0]
    assert at("leaky_relu") == [-0.02, 0.0, 3.0]
    assert at("elu") == pytest.approx([math.expm1(-2), 0.0, 3.0])
    assert at("swish") == pytest.approx([-2 / (1 + math.exp(2)), 0.0, 3 / (1 + math.exp(-3))])
    for call, code in (
        (lambda: numeric.activation("step", F.col("x")), "tabular_mlp_bad_activation"),
        (lambda: numeric.class_probabilities(F.col("x"), "regression"), "tabular_mlp_predict_proba_on_regression"),
    ):
        with pytest.raises(ModelError) as error:
            call()
        assert error.value.code == code
