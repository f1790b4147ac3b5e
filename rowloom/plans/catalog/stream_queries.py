"""Row features and fitted preprocessing on file streams."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rowloom.operators.preprocess import fit_preprocessor
from rowloom.operators.row_features import RowFeatures
from rowloom.plans.catalog.preprocessing import TRAIN, categories, gappy_parts, set_indicators
from rowloom.plans.catalog.preprocessing import category_sql
from rowloom.plans.catalog.registry import query, rounded, scan
from rowloom.plans.catalog.row_queries import CALENDAR_SQL
from rowloom.session import scratch_path
from rowloom.sources import ledger
from rowloom.sources.sql import write_rows
from rowloom.streaming import features as streaming


def stream_of(spark, folder, table):
    """A table as a stream, whether it is one file or a folder of part files.

    A single file is only found by a pattern; this one matches no other name.
    """
    schema = scan(spark, folder, table).schema
    return streaming.read_stream(spark, f"{folder}/{table}.parque[t]", schema)


def drained(spark, stream, label):
    """Run a stream over what is there and return what it wrote."""
    path = scratch_path(spark, label)
    streaming.append_to(stream, path, scratch_path(spark, f"{label}-progress")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query(
    "stream_row_features",
    f"""select event_id, round(ln(1 + value), 6) as value__log1p, {CALENDAR_SQL.format(t='ts', c='ts')} from events""",
)
def stream_row_features(spark, folder):
    stream = stream_of(spark, folder, "events").select("event_id", "ts", "value")
    spec = RowFeatures(["ts"], ["value"], drop_original_datetime=True)
    return rounded(drained(spark, streaming.stream_row_features(stream, spec), "stream-features").drop("value"))


@query("stream_preprocessing", category_sql())
def stream_preprocessing(spark, folder):
    parts = gappy_parts(spark, folder)
    fitted = fit_preprocessor(parts.where(TRAIN), categories())
    stream = stream_of(spark, folder, "part").withColumn(
        "p_brand", F.when(F.col("p_partkey") % 11 != 0, F.col("p_brand"))
    )
    return set_indicators(drained(spark, streaming.stream_preprocess(stream, fitted), "stream-preprocess"))


@query(
    "chunked_ingestion",
    "select count(*) as n_rows, round(sum(o_totalprice), 2) as total from orders",
)
def chunked_ingestion(spark, folder):
    pieces = scratch_path(spark, "order-pieces")
    scan(spark, folder, "orders").repartition(4).write.parquet(pieces)
    stream = streaming.read_stream(spark, pieces, spark.read.parquet(pieces).schema, files_per_trigger=1)
    target = scratch_path(spark, "ingested")
    # One folder per batch: a batch that is tried again replaces what it wrote.
    keep = lambda chunk, batch: write_rows(chunk, f"{target}/batch={batch}", mode="overwrite")
    streaming.each_chunk(stream, keep, scratch_path(spark, "ingest-progress")).awaitTermination()
    return rounded(spark.read.parquet(target).agg(F.count("*").alias("n_rows"), F.sum("o_totalprice").alias("total")), 2)


@query("ingestion_replayed", "select o_orderkey, o_orderstatus, o_totalprice from orders")
def ingestion_replayed(spark, folder):
    """The second batch dies when its files are written; the stream is started again, then all is sent twice."""
    pieces, path, progress = (scratch_path(spark, label) for label in ("order-pieces", "order-ledger", "ledger-progress"))
    scan(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").repartition(4).write.parquet(pieces)
    stream = lambda: streaming.read_stream(spark, pieces, spark.read.parquet(pieces).schema, files_per_trigger=1)

    def dies(chunk, batch):
        if batch == 1:
            chunk.limit(10).write.parquet(f"{path}/data/half-written")
            raise RuntimeError("killed half-way")
        ledger.append(chunk, path, "orders", batch)

    try:
        streaming.each_chunk(stream(), dies, progress).awaitTermination()
    except StreamingQueryException:
        streaming.ingest(stream(), path, progress, "orders").awaitTermination()
    again = scratch_path(spark, "ledger-progress")  # a lost checkpoint: batches 0 to 3 come once more
    streaming.ingest(stream(), path, again, "orders").awaitTermination()
    ledger.compact(spark, path, ["o_orderkey"])
    return ledger.read(spark, path)
