import dataclasses

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import column
from rowloom.errors import DataError
from rowloom.operators.preprocess import (
    INFREQUENT,
    PreprocessSpec,
    build_preprocessor,
    fit_preprocessor,
    fit_transform_preprocessor,
    load_preprocessor,
    standardize,
)


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame([(i, c) for i, c in enumerate(["a", "a", "a", "b", "b", "c", None])], "i int, c string")


@pytest.fixture(scope="module")
def test(spark):
    return spark.createDataFrame([(0, "a"), (1, "d"), (2, None), (3, "c")], "i int, c string")


def labels(**options):
    return PreprocessSpec(numeric_features=(), categorical_features=["c"], remainder="passthrough", **options)


def indicators(df):
    names = [c for c in df.columns if c.startswith("c__")]
    rows = df.orderBy("i").collect()
    return names, [[int(r[n]) for n in names] for r in rows]


def test_one_hot_and_unknown(train, test):
    fitted = fit_preprocessor(train, labels())
    assert fitted.categorical[0].fill == "a"
    assert indicators(fitted.transform(test)) == (
        ["c__a", "c__b", "c__c"], [[1, 0, 0], [0, 0, 0], [1, 0, 0], [0, 0, 1]],
    )
    strict = fit_preprocessor(train, labels(handle_unknown="error"))
    with pytest.raises(DataError) as error:
        strict.transform(test)
    assert error.value.code == "unknown_category"
    with pytest.raises(PySparkException, match="unknown_category"):
        strict.transform(test, validate="lazy").collect()
    assert strict.transform(train).count() == 7


def test_rare_categories_share_an_indicator(train, test):
    names, rows = indicators(fit_preprocessor(train, labels(min_frequency=2)).transform(test))
    assert names == ["c__a", "c__b", f"c__{INFREQUENT}"]
    assert rows == [[1, 0, 0], [0, 0, 0], [1, 0, 0], [0, 0, 1]]
    names, rows = indicators(fit_preprocessor(train, labels(max_categories=2)).transform(test))
    assert names == ["c__a", f"c__{INFREQUENT}"] and rows[3] == [0, 1]
    names, _ = indicators(fit_preprocessor(train, labels(max_categories=3)).transform(test))
    assert names == ["c__a", "c__b", "c__c"]
    names, _ = indicators(fit_preprocessor(train, labels(categorical_imputer="constant")).transform(test))
    assert names == ["c__a", "c__b", "c__c", "c__missing"]


@pytest.mark.parametrize("options, expected", [
    ({}, [0, 0, 0, 1, 1, 2, 0]),
    ({"min_frequency": 2}, [0, 0, 0, 1, 1, 2, 0]),
    ({"max_categories": 2}, [0, 0, 0, 1, 1, 1, 0]),
])
def test_index_encoding(train, test, options, expected):
    fitted = fit_preprocessor(train, labels(encoding="index", **options))
    assert column(fitted.transform(train), "c__index", "i") == expected
    assert column(fitted.transform(test), "c__index", "i")[:3] == [0, None, 0]
    assert set(fitted.transform(test).columns) == {"i", "c__index"}


@pytest.mark.parametrize("limit", [1, 2, 3, 4, None])
def test_dense_and_sparse_keep_the_same_categories(spark, limit):
    """Equal counts: b and c stay at a limit of three, whatever the encoding."""
    df = spark.createDataFrame(list(enumerate(["a", "a", "b", "b", "c", "c", "d"])), "i int, c string")
    dense = fit_preprocessor(df, labels(max_categories=limit))
    sparse = fit_preprocessor(df, labels(max_categories=limit, encoding="sparse"))
    names, rows = indicators(dense.transform(df))
    got = [(r["c__onehot"]["size"], r["c__onehot"]["index"]) for r in sparse.transform(df).orderBy("i").collect()]
    assert got == [(len(names), r.index(1)) for r in rows]
    if limit == 3:
        assert names[:2] == ["c__b", "c__c"]


@pytest.mark.parametrize("encoding", ["dense", "sparse", "index"])
def test_unknown_values_stop_every_encoding(train, test, encoding):
    strict = fit_preprocessor(train, labels(handle_unknown="error", encoding=encoding))
    with pytest.raises(DataError) as error:
        strict.transform(test)
    assert error.value.code == "unknown_category"
    with pytest.raises(PySparkException, match="unknown_category"):
        strict.transform(test, validate="lazy").collect()
    assert strict.transform(train, validate="lazy").count() == 7


@pytest.mark.parametrize("encoding", ["dense", "sparse"])
def test_saved_and_loaded(spark, train, test, tmp_path, encoding):
    spec = PreprocessSpec(["i"], ["c"], encoding=encoding, min_frequency=2)
    fitted = fit_preprocessor(train, spec)
    fitted.save(spark, str(tmp_path / "fitted"))
    loaded = load_preprocessor(spark, str(tmp_path / "fitted"))
    assert str(loaded.spec).replace("(", "[").replace(")", "]") == str(spec).replace("(", "[").replace(")", "]") and loaded.used == fitted.used and loaded.numeric == fitted.numeric
    assert loaded.transform(test).collect() == fitted.transform(test).collect()



def test_numeric_imputation_and_scaling(spark):
    df = spark.createDataFrame([(1, 1.0, 5), (2, None, 5), (3, 4.0, 5), (4, 4.0, 5)], "i int, x double, k int")
    fill = lambda **o: fit_preprocessor(df, PreprocessSpec(["x"], (), **o)).numeric[0].fill
    assert fill(numeric_imputer="mean") == 3.0
    assert fill() == 4.0
    assert fill(numeric_imputer="most_frequent") == 4.0
    assert fill(numeric_imputer="constant") == 0.0
    scaled, fitted = fit_transform_preprocessor(df, PreprocessSpec(["x", "k"], ()))
    row = scaled.agg(F.avg("x").alias("m"), F.var_pop("x").alias("v"), F.max(F.abs("k")).alias("k")).first()
    assert row["m"] == pytest.approx(0.0) and row["v"] == pytest.approx(1.0) and row["k"] == 0.0
    assert fitted.parameters(spark).where("parameter = 'scale'").count() == 2
    empty = df.withColumn("x", F.lit(None).cast("double"))
    assert fit_preprocessor(empty, PreprocessSpec(["x", "k"], ())).transform(df).columns == ["k"]


def test_most_frequent_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([(3.0, "b"), (1.0, "a"), (None, None)], "x double, c string")
    fitted = fit_preprocessor(df, PreprocessSpec(numeric_imputer="most_frequent"))
    assert fitted.numeric[0].fill == 1.0 and fitted.categorical[0].fill == "a"


def test_statistics_come_from_training_rows(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 2.0), (0, 100.0)], "train int, x double")
    out = standardize(df, ["x"], fit_on=df.where("train = 1"))
    assert column(out, "x", "x") == [-1.0, 1.0, 99.0]


def test_contracts(train, test):
    with pytest.raises(DataError) as error:
        fit_preprocessor(train, labels()).transform(test.drop("c"))
    assert error.value.code == "missing_columns_for_preprocessor"
    with pytest.raises(DataError) as error:
        build_preprocessor(train, PreprocessSpec(drop_features=["i", "c"]))
    assert error.value.code == "no_features_after_inference"
    assert build_preprocessor(train).used == ("i", "c")


@pytest.mark.parametrize("limits", [{"max_categories": 4}, {"min_frequency": 30}, {"max_categories": 1}, {"max_categories": 5, "min_frequency": 4}])
def test_tables_of_rare_values_give_the_listed_result(spark, monkeypatch, tmp_path, limits):
    import rowloom.operators.preprocess as module

    df = spark.range(400).selectExpr("id", "case when id % 19 = 0 then null else concat('v', cast(sqrt(id) as int)) end as c")
    new = df.withColumn("c", F.when(F.col("id") % 7 == 0, F.lit("never seen")).otherwise(F.col("c")))
    spec = PreprocessSpec(numeric_features=[], categorical_features=["c"], remainder="passthrough", **limits)
    listed = fit_preprocessor(df, spec)
    monkeypatch.setattr(module, "MAX_LISTED", -1)
    joined = fit_preprocessor(df, spec)
    monkeypatch.setattr(module, "MAX_DENSE", 10)
    counted = fit_preprocessor(df, spec)
    counted.save(spark, str(tmp_path / "saved"))
    loaded = module.load_preprocessor(spark, str(tmp_path / "saved"))
    wanted = sorted(map(tuple, listed.transform(new).collect()))
    for other in (joined, counted, loaded):
        assert other.categorical[0].rare_table and not other.categorical[0].infrequent
        made = other.transform(new)
        assert made.columns == listed.transform(new).columns and sorted(map(tuple, made.collect())) == wanted
    strict = dataclasses.replace(counted, spec=dataclasses.replace(spec, handle_unknown="error"))
    assert strict.transform(df).count() == 400
    with pytest.raises(DataError) as error:
        strict.transform(new)
    assert error.value.code == "unknown_category"
    with pytest.raises(Exception, match="unknown_category"):
        strict.transform(new, "lazy").collect()


def test_plan_does_not_grow_with_rare_values(spark):
    sizes = []
    for n in (3_000, 60_000):
        df = spark.range(n).selectExpr("concat('value ', id) as c")
        fitted = fit_preprocessor(df, PreprocessSpec(numeric_features=[], categorical_features=["c"], max_categories=3))
        assert len(fitted.categorical[0].categories) == 2 and not fitted.categorical[0].infrequent
        made = fitted.transform(df)
        assert made.agg(F.sum(f"`c__{'<infrequent>'}`")).first()[0] == n - 2
        sizes.append(len(made._jdf.queryExecution().analyzed().toString()))
    assert max(sizes) < 3_000 and abs(sizes[0] - sizes[1]) < 200
    with pytest.raises(DataError) as error:
        fit_preprocessor(df, PreprocessSpec(numeric_features=[], categorical_features=["c"]))
    assert error.value.code == "too_many_categories"
