import pathlib

import pytest

import __spark_entry__ as contract

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "series_features",
    "series_features_divided",
    "sliding_windows_stepped",
    "row_features",
    "numeric_summary",
    "one_hot_max_categories",
    "stratified_split",
    "chronological_split",
    "early_stopping_min",
    "scan_feather",
    "stream_preprocessing",
]


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 1000 and "mean_7" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    for file in pathlib.Path(FOLDER).glob("*.parquet"):
        duck.execute(f"create view {file.stem} as select * from read_parquet('{file}')")
    df = contract.queries()[name](spark, FOLDER)
    found = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    mine = sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))
    assert mine == sorted(map(repr, found.fetchall()))
