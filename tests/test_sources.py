import datetime as dt

import pandas as pd
import pyarrow as pa
import pytest
from py4j.protocol import Py4JJavaError
from pyarrow import feather
from pyspark.errors import PySparkException

from rowloom import session
from rowloom.errors import DataError
from rowloom.operators import tables
from rowloom.session import scratch_dir, written
from rowloom.sources import documents, files, sinks, sql


def codes(call):
    with pytest.raises(DataError) as error:
        call()
    return error.value.code


def test_formats(spark, tmp_path):
    assert [files.infer_format(p) for p in ("a/b.PARQUET", "x.pq", "x.ft", "x.feather", "x.tsv", "x")] == [
        "parquet", "csv", "csv", "feather", "csv", "csv",
    ]
    assert files.infer_format("s3a://b/orders.parquet/") == "parquet"
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\n2,y\n")
    df = files.load_table(spark, str(path), required_columns=["a"])
    assert dict(df.dtypes) == {"a": "int", "b": "string"} and df.count() == 2
    assert files.load_table(spark, str(path), format="CSV", schema="a bigint, b string").schema["a"].dataType.typeName() == "long"
    assert files.load_table(spark, str(path), options={"sep": ";"}).columns == ["a,b"]
    assert codes(lambda: files.load_table(spark, str(path), format="orc")) == "data_unsupported_format"
    assert codes(lambda: files.load_table(spark, str(tmp_path / "absent.csv"))) == "data_file_not_found"
    assert codes(lambda: files.load_table(spark, str(tmp_path / "absent.feather"))) == "data_file_not_found"
    assert codes(lambda: files.load_table(spark, str(path), format="parquet").count()) == "data_load_error"
    with pytest.raises(DataError) as error:
        files.load_table(spark, str(path), required_columns=["a", "z"])
    assert error.value.code == "data_missing_columns"
    assert error.value.context == {"missing": ["z"], "available": ["a", "b"]}


def test_zones(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "t.csv").write_text("a\n1\n")
    zones = {"raw": str(tmp_path / "raw"), "processed": "s3a://bucket/p/"}
    assert files.load_zone(spark, zones, "raw", "t.csv").count() == 1
    assert files.zone_path(zones, "processed", "x.parquet") == "s3a://bucket/p/x.parquet"
    assert files.zone_path(zones, "raw", "/abs/x.csv") == "/abs/x.csv"
    assert codes(lambda: files.load_zone(spark, zones, "gold", "t.csv")) == "data_unknown_zone"


@pytest.mark.parametrize("version", [1, 2])
def test_feather(spark, tmp_path, version):
    table = pa.table({"a": pa.array([1, 2, 3], pa.int64()), "b": ["x", None, "z"]})
    feather.write_feather(table, tmp_path / "t.feather", version=version)
    df = files.load_table(spark, str(tmp_path / "t.feather"))
    assert dict(df.dtypes) == {"a": "bigint", "b": "string"}
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, "x"), (2, None), (3, "z")]


def test_feather_batches_are_spread(spark, tmp_path):
    frame = pd.DataFrame({"i": range(1000), "t": pd.Timestamp("2024-01-01"), "c": pd.Categorical(["u", "v"] * 500)})
    feather.write_feather(frame, tmp_path / "big.feather", chunksize=10)
    df = files.load_table(spark, str(tmp_path / "big.feather"))
    assert df.selectExpr("count(distinct i) as n", "count(*) as m", "min(t) as t", "max(c) as c").first() == (
        1000, 1000, dt.datetime(2024, 1, 1), "v",
    )
    assert files.load_table(spark, str(tmp_path / "big.feather"), schema="i bigint").agg({"i": "sum"}).first()[0] == 499500


def test_sql(spark):
    sql.register(spark, numbers=spark.range(10))
    assert sql.query(spark, "select id from numbers where id >= :low", {"low": 7}).count() == 3
    assert sql.table(spark, "numbers", columns=["id"], limit=4).count() == 4
    assert sql.table(spark, "numbers", limit=-1).count() == 10
    assert codes(lambda: sql.query(spark, "select nothing from nowhere")) == "sql_query_error"
    assert codes(lambda: sql.table(spark, "numbers", columns=["absent"])) == "sql_query_error"


def test_jdbc_options():
    whole = sql.jdbc_options("jdbc:x", "t", schema="s", fetch_rows=500, user="u")
    assert whole == {"url": "jdbc:x", "dbtable": "s.t", "fetchsize": "500", "user": "u"}
    assert sql.jdbc_options("jdbc:x", sql="select 1")["query"] == "select 1"
    cut = sql.jdbc_options("jdbc:x", sql="select * from t", divided=sql.Partitioned("id", 0, 100, 8))
    assert cut["dbtable"] == "(select * from t) q"
    assert (cut["partitionColumn"], cut["lowerBound"], cut["upperBound"], cut["numPartitions"]) == ("id", "0", "100", "8")
    assert codes(lambda: sql.jdbc_options("jdbc:x")) == "sql_load_error"


def test_written_rows_are_counted(spark, tmp_path):
    path = str(tmp_path / "out")
    assert sql.write_rows(spark.range(5), path) == 5
    assert sql.write_rows(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 8
    assert sql.write_rows(spark.range(0), path, mode="overwrite") == 0


def test_documents(spark, tmp_path):
    path = tmp_path / "docs.json"
    path.write_text(
        '{"_id": 1, "status": "active", "n": 5, "tags": {"k": "a"}}\n{"_id": 2, "status": "active"}\n'
        '{"_id": 3, "status": "old", "n": 1, "tags": {"k": "b"}}\n{"_id": 4, "n": 9}\n'
    )
    docs = documents.read_collection(spark, str(path))
    ids = lambda **k: [r["_id"] for r in documents.find(docs, drop_id=False, **k).collect()]
    assert sorted(ids(query={"status": "active"})) == [1, 2]
    assert sorted(ids(query={"n": {"$gte": 1, "$lt": 9}})) == [1, 3]
    assert sorted(ids(query={"status": {"$ne": "active"}})) == [3, 4]
    assert sorted(ids(query={"n": {"$exists": False}})) == [2]
    assert sorted(ids(query={"status": None})) == [4]
    assert sorted(ids(query={"$or": [{"tags.k": "b"}, {"$and": [{"n": 9}, {"status": {"$nin": ["old"]}}]}]})) == [3, 4]
    assert sorted(ids(query={"absent": {"$gt": 1}})) == []
    assert ids(sort=[("n", 1)]) == [2, 3, 1, 4]
    assert ids(sort=[("n", -1)], limit=2) == [4, 1]
    assert sorted(ids(limit=0)) == [1, 2, 3, 4]
    assert documents.find(docs).columns == ["n", "status", "tags"]
    assert documents.find(docs, projection={"n": 1}, drop_id=False).columns == ["_id", "n"]
    assert documents.find(docs, projection={"_id": 0, "tags": 0}, drop_id=False).columns == ["n", "status"]
    assert documents.find(docs, {"status": "none"}).count() == 0
    assert documents.count_documents(docs, {"status": "active"}).first()["count"] == 2
    for bad in ({"n": {"$mod": [2, 0]}}, {"$nor": []}, {"$or": []}):
        assert codes(lambda: documents.find(docs, bad)) == "mongo_load_error"
    assert codes(lambda: documents.find(docs, projection={"n": 1, "tags": 0})) == "mongo_load_error"
    assert codes(lambda: documents.find(docs, sort=[("n", 2)])) == "mongo_load_error"


def test_run_log(spark, tmp_path):
    params, metrics = str(tmp_path / "params"), str(tmp_path / "metrics")
    nested = {"env": "dev", "training": {"epochs": 10, "layers": [1, 2], "opt": {"lr": 0.1}}, "off": None}
    sinks.log_params(spark, params, "r1", nested, prefix="cfg.", flat=True)
    got = {r["key"]: r["value"] for r in spark.read.parquet(params).collect()}
    assert got == {
        "cfg.env": "dev", "cfg.training.epochs": "10", "cfg.training.layers": "[1, 2]", "cfg.training.opt.lr": "0.1",
        "cfg.off": None,
    }
    sinks.log_metrics(spark, metrics, "r1", {"loss": 1}, step=0)
    sinks.log_metrics(spark, metrics, "r1", {"loss": 0.5}, step=1)
    sinks.log_metrics(spark, metrics, "r1", {})
    assert [(r["step"], r["value"]) for r in spark.read.parquet(metrics).orderBy("step").collect()] == [(0, 1.0), (1, 0.5)]


def test_nested_columns(spark):
    df = spark.sql("select struct(1 as x, struct(2 as z) as y) as a, array(3) as b")
    flat = tables.flatten_columns(df, prefix="p_")
    assert flat.columns == ["p_a.x", "p_a.y.z", "p_b"] and tuple(flat.first()) == (1, 2, [3])


def test_written_table_keeps_rows_and_types(spark):
    df = spark.sql("select 1 as a, timestamp_ntz'2020-01-01' as t, array(1.5D) as x")
    again = written(df, "test")
    assert again.dtypes == df.dtypes and again.collect() == df.collect()
    assert again.inputFiles()[0].removeprefix("file://").startswith(scratch_dir(spark).removeprefix("file:"))


def test_released_tables_are_gone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_dir", lambda _: str(tmp_path))
    table = written(spark.range(3), "test")
    assert table.count() == 3 and list(tmp_path.glob("rowloom/*/test-*"))
    assert session.release(spark) and not list(tmp_path.glob("rowloom/*"))


def test_csv_schema_is_matched_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("price,id,note\n1.5,7,x\n2.5,8,y\n")
    df = files.load_table(spark, str(path), schema="id int, price double")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(7, 1.5), (8, 2.5)]
    assert codes(lambda: files.load_table(spark, str(path), schema="id int, cost double")) == "data_missing_columns"
    assert codes(lambda: files.load_table(spark, str(path), schema="id int", required_columns=["cost"])) == "data_missing_columns"


def test_bad_rows_are_never_silent(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,price\n1,2.0\n2,abc\n3,4.0,9\n4,5.0\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED_RECORD"):
        files.load_table(spark, str(path), schema="id int, price double").collect()
    kept = files.load_table(spark, str(path), schema="id int, price double", bad_rows="keep")
    assert tuple(files.row_quality(kept).first()) == (2, 2)
    assert sorted(r.id for r in kept.collect() if r[files.BAD_ROW] is None) == [1, 4]
    lines = tmp_path / "d.json"
    lines.write_text('{"a": 1}\nnot json\n')
    with pytest.raises((PySparkException, Py4JJavaError), match="MALFORMED_RECORD"):
        documents.read_collection(spark, str(lines), "a int").collect()
    assert documents.read_collection(spark, str(lines), "a int, _corrupt_record string", "PERMISSIVE").where("a is null").count() == 1


def test_embedded_documents(spark):
    df = spark.createDataFrame([(1, (2, "u")), (2, (3, None)), (3, None)], "_id int, meta struct<n:int,role:string>")
    find = lambda q=None, p=None, **o: [r.asDict(True) for r in documents.find(df, q, p, **o).collect()]
    assert find(p={"meta.role": 1}) == [{"meta": {"role": "u"}}, {"meta": {"role": None}}, {"meta": None}]
    assert find(p={"meta.role": 0}, drop_id=False)[0] == {"_id": 1, "meta": {"n": 2}}
    assert find({"meta": {"n": 2, "role": "u"}}) == [{"meta": {"n": 2, "role": "u"}}]
    assert find({"meta": {"n": 3}}) == [{"meta": {"n": 3, "role": None}}]
    assert find({"meta": {"n": 2}}) == [] and find({"meta": {"x": 2}}) == []
    with pytest.raises(DataError):
        documents.find(df, {"_id": {"n": 2}})


def test_metrics_of_many_steps_in_one_file(spark, tmp_path):
    path = str(tmp_path / "runs")
    sinks.log_steps(spark, path, "r", {i: {"loss": 1.0 / (i + 1)} for i in range(20)})
    assert spark.read.parquet(path).count() == 20 and len(list((tmp_path / "runs").glob("part-*"))) == 1
    assert sinks.flatten({"a": {"b": 1, 2: {}}, "c": None}) == {"a.b": 1, "c": None}


def test_written_tables_can_be_forgotten(spark):
    import pathlib

    from rowloom import session

    table = session.written(spark.range(5), "five")
    place = pathlib.Path(table.inputFiles()[0].removeprefix("file:")).parent
    assert table.count() == 5 and place.exists()
    session.forget(table, shuffles=True)
    assert not place.exists()
    with pytest.raises(DataError) as error:
        session.forget(table)
    assert error.value.code == "forget_unknown_table"
