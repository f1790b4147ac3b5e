"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rowloom.operators import tables
from rowloom.operators.row_features import parse_date_columns
from rowloom.plans.catalog.registry import query, rounded, scan
from rowloom.session import scratch_path, written
from rowloom.sources import documents, files, ledger, sinks, sql


def as_feather(df: DataFrame, path: str) -> int:
    """Arrow IPC files of a frame, one per partition, for the scan to read; returns the rows.

    A file is named by its partition, so a task that runs again replaces its own file.
    """
    import pyarrow as pa

    hadoop = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    path = hadoop.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()

    def save(parts):
        from pyarrow import fs
        from pyspark import TaskContext

        address = path[len("file:") :] if path.startswith("file:/") and not path.startswith("file://") else path
        system, inside = fs.FileSystem.from_uri(address) if "://" in address else (fs.LocalFileSystem(), address)
        system.create_dir(inside, recursive=True)
        writer, rows = None, 0
        for part in parts:
            if writer is None:
                sink = system.open_output_stream(f"{inside}/part-{TaskContext.get().partitionId():05d}.feather")
                writer = pa.ipc.new_file(sink, part.schema)
            writer.write_batch(part)
            rows += part.num_rows
        if writer is not None:
            writer.close()
            sink.close()
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64())})

    return df.mapInArrow(save, "rows bigint").agg(F.sum("rows")).first()[0]


def conversation_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations as JSON lines with an ``_id``; ``note`` is absent in most documents."""
    path = scratch_path(spark, "conversations")
    turns = scan(spark, folder, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("_id"),
        "conv_id",
        "turn",
        F.struct("role", F.length("text").alias("chars")).alias("meta"),
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("t"), F.col("turn"))).alias("note"),
    )
    turns.write.json(path)
    schema = "_id bigint, conv_id bigint, turn bigint, meta struct<role: string, chars: bigint>, note string"
    return documents.read_collection(spark, path, schema)


@query("scan_parquet", "select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders")
def scan_parquet(spark, folder):
    table = files.load_table(spark, f"{folder}/orders.parquet", required_columns=["o_orderkey", "o_totalprice"])
    return table.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query("scan_csv", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def scan_csv(spark, folder):
    path = scratch_path(spark, "customer-csv")
    sinks.write_csv(scan(spark, folder, "customer"), path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return files.load_table(spark, path, "CSV", schema=schema)


@query("scan_csv_inferred", "select s_suppkey::integer as s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def scan_csv_inferred(spark, folder):
    path = scratch_path(spark, "supplier-csv")
    scan(spark, folder, "supplier").write.option("header", True).option("sep", "|").csv(path)
    return files.load_table(spark, path, options={"sep": "|"})


@query("scan_feather", "select p_partkey, p_name, p_brand, p_size, p_retailprice from part")
def scan_feather(spark, folder):
    path = scratch_path(spark, "part-feather")
    as_feather(scan(spark, folder, "part").repartition(4), path)
    return files.load_table(spark, path, "feather").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")


@query("scan_zone", "select s_suppkey, s_acctbal from supplier")
def scan_zone(spark, folder):
    return files.load_zone(spark, {"raw": folder}, "raw", "supplier.parquet").select("s_suppkey", "s_acctbal")


@query(
    "sql_query",
    "select r_name, count(*) as n_customers, round(avg(c_acctbal), 6) as mean_balance from customer "
    "join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name",
)
def sql_query(spark, folder):
    sql.register(spark, **{t: scan(spark, folder, t) for t in ("customer", "nation", "region")})
    return sql.query(
        spark,
        "select r_name, count(*) as n_customers, round(avg(c_acctbal), 6) as mean_balance from customer "
        "join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name",
    )


@query(
    "sql_named_parameters",
    "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice >= 250000",
)
def sql_named_parameters(spark, folder):
    sql.register(spark, orders=scan(spark, folder, "orders"))
    return sql.query(
        spark,
        "select o_orderkey, o_totalprice from orders where o_orderstatus = :status and o_totalprice >= :least",
        {"status": "F", "least": 250000.0},
    )


@query("sql_table_columns", "select n_name, n_regionkey from nation")
def sql_table_columns(spark, folder):
    sql.register(spark, nation=scan(spark, folder, "nation"))
    return sql.table(spark, "nation", columns=["n_name", "n_regionkey"], limit=0)


@query(
    "write_with_row_count",
    "select count(*) as rows_written, count(*) as rows_found from orders where o_orderpriority = '1-URGENT'",
)
def write_with_row_count(spark, folder):
    path = scratch_path(spark, "urgent-orders")
    n = sql.write_rows(scan(spark, folder, "orders").where("o_orderpriority = '1-URGENT'"), path)
    return spark.read.parquet(path).agg(F.lit(n).cast("bigint").alias("rows_written"), F.count("*").alias("rows_found"))


@query(
    "documents_find",
    "select conv_id, turn from conversations where role = 'user' and turn >= 1 order by conv_id desc, turn",
)
def documents_find(spark, folder):
    docs = conversation_documents(spark, folder)
    return documents.find(
        docs, {"meta.role": "user", "turn": {"$gte": 1}}, {"_id": 0, "conv_id": 1, "turn": 1}, [("conv_id", -1), ("turn", 1)]
    )


@query(
    "documents_find_any",
    "select conv_id, turn, case when turn % 3 = 0 then 't' || turn end as note from conversations "
    "where turn in (1, 2) or turn % 3 = 0",
)
def documents_find_any(spark, folder):
    docs = conversation_documents(spark, folder)
    wanted = {"$or": [{"turn": {"$in": [1, 2]}}, {"note": {"$exists": True}}]}
    return documents.find(docs, wanted, projection={"meta": 0})


@query(
    "documents_top",
    "select conv_id, turn from conversations order by length(text) desc, conv_id, turn limit 10",
)
def documents_top(spark, folder):
    docs = conversation_documents(spark, folder)
    return documents.find(
        docs, {}, {"conv_id": 1, "turn": 1}, [("meta.chars", -1), ("conv_id", 1), ("turn", 1)], limit=10
    )


@query(
    "documents_nested_projection",
    "select conv_id, turn, role from conversations where role = 'assistant' and turn = 1",
)
def documents_nested_projection(spark, folder):
    """Dotted projection, and equality with an embedded document."""
    docs = conversation_documents(spark, folder)
    found = documents.find(docs, {"meta.role": "assistant", "turn": 1}, {"conv_id": 1, "turn": 1, "meta.role": 1})
    return found.select("conv_id", "turn", F.col("meta.role").alias("role"))


@query(
    "scan_csv_bad_rows_counted",
    "select count(*) filter (o_orderkey % 50 <> 0) as good_rows, count(*) filter (o_orderkey % 50 = 0) as bad_rows from orders",
)
def scan_csv_bad_rows_counted(spark, folder):
    path = scratch_path(spark, "bad-orders")
    price = F.when(F.col("o_orderkey") % 50 == 0, F.lit("unknown")).otherwise(F.col("o_totalprice").cast("string"))
    orders = scan(spark, folder, "orders").select("o_orderkey", price.alias("o_totalprice"))
    orders.write.option("header", True).csv(path)
    kept = files.load_table(spark, path, "csv", schema="o_orderkey bigint, o_totalprice double", bad_rows="keep")
    return files.row_quality(kept)


@query("documents_count", "select count(*) as count from conversations where role <> 'user' or turn = 0")
def documents_count(spark, folder):
    docs = conversation_documents(spark, folder)
    return documents.count_documents(docs, {"$or": [{"meta.role": {"$ne": "user"}}, {"turn": 0}]})


@query(
    "documents_json_properties",
    "select event_id, event_type, (props::json->>'k')::integer as k from events "
    "where (props::json->>'k')::integer > 50 and event_type <> 'view'",
)
def documents_json_properties(spark, folder):
    docs = scan(spark, folder, "events").withColumn("props", F.from_json("props", "k int"))
    found = documents.find(docs, {"props.k": {"$gt": 50}, "event_type": {"$nin": ["view"]}})
    return found.select("event_id", "event_type", F.col("props.k").alias("k"))


@query(
    "flatten_nested_columns",
    'select event_id, user_id as "who.user_id", event_type as "what.event_type", '
    '(props::json->>\'k\')::integer as "what.props.k" from events',
)
def flatten_nested_columns(spark, folder):
    events = scan(spark, folder, "events").select(
        "event_id",
        F.struct("user_id").alias("who"),
        F.struct("event_type", F.from_json("props", "k int").alias("props")).alias("what"),
    )
    return tables.flatten_columns(events)


@query(
    "history_csv_sink",
    "select user_id, epoch::integer as epoch, value from (select user_id, value, "
    "row_number() over (partition by user_id order by ts, event_id) as epoch from events)",
)
def history_csv_sink(spark, folder):
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    history = scan(spark, folder, "events").select("user_id", F.row_number().over(order).alias("epoch"), "value")
    path = scratch_path(spark, "history-csv")
    sinks.write_csv(history, path)
    return files.load_table(spark, path, schema="user_id bigint, epoch int, value double")


RUN_LOG = (
    "select 'run-' || user_id as run_id, day::integer as step, metric, round(value, 6) as value from ("
    "select user_id, day(ts) as day, 'loss' as metric, avg(value) as value from events group by all union all "
    "select user_id, day(ts) as day, 'samples' as metric, count(*)::double as value from events group by all)"
)


def daily_metrics(spark, folder):
    daily = scan(spark, folder, "events").groupBy(
        F.concat(F.lit("run-"), "user_id").alias("run_id"), F.dayofmonth("ts").alias("step")
    )
    measured = daily.agg(F.avg("value").alias("loss"), F.count("*").cast("double").alias("samples"))
    return measured.unpivot(["run_id", "step"], ["loss", "samples"], "metric", "value")


@query("run_metrics_log", RUN_LOG)
def run_metrics_log(spark, folder):
    path = scratch_path(spark, "run-log")
    sinks.log_history(daily_metrics(spark, folder), path)
    return rounded(spark.read.parquet(path))


@query("run_log_compacted", RUN_LOG)
def run_log_compacted(spark, folder):
    """Logged in eight commits, with a compaction at every third small part."""
    path = scratch_path(spark, "run-ledger")
    measured = written(daily_metrics(spark, folder), "daily-metrics")
    for eighth in range(8):
        sinks.log_committed(measured.where(F.col("step") % 8 == eighth), path, ["run_id", "metric", "step"], 3)
    return rounded(ledger.read(spark, path))


@query(
    "detected_roles",
    "select * from (values ('numeric', 'event_id'), ('numeric', 'user_id'), ('numeric', 'value'), "
    "('categorical', 'event_type'), ('categorical', 'props'), ('datetime', 'ts'), ('derived', 'ts_year')) t(role, \"column\") "
    "where (select count(*) from events) > 0",
)
def detected_roles(spark, folder):
    events = scan(spark, folder, "events").withColumns({"ts": F.col("ts").cast("string"), "ts_year": F.year("ts")})
    found = tables.roles_table(parse_date_columns(events))
    path = scratch_path(spark, "roles")
    sinks.write_json(found, path)
    return spark.read.schema("role string, column string").json(path)
