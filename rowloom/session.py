"""Session helpers: the shared scratch folder and tables written to it.

Operators that read an intermediate result more than once, or that need row
positions to stay fixed when an executor is lost, write it as a Parquet table in
the folder named by ``spark.checkpoint.dir``.  A written table cuts lineage, is
columnar (later passes read only the columns they use) and survives executor loss.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rowloom.errors import DataError

_local_dirs: dict[str, str] = {}
# Path of each table as written, while the frame is alive.
_written_to: dict[int, tuple[weakref.ref, str]] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rowloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few literal rows as a local relation: known to the planner, no Python stage."""
    fields = T._parse_datatype_string(schema)
    cells = list(zip(*rows)) if rows else [[] for _ in fields]
    arrow = to_arrow_schema(fields)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(cells, arrow)], schema=arrow), fields)


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary folder only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    already_set = spark.sparkContext.getCheckpointDir()
    if already_set:
        return already_set.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise DataError(
            "set spark.checkpoint.dir to a folder every executor can reach", "scratch_dir_unset"
        )
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="rowloom-")
    return _local_dirs[app]


def _app_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/rowloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_app_folder(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> bool:
    """Delete the tables this application wrote to the scratch folder.

    Frames returned by operators may still read them: call this when their results are
    written.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_app_folder(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and return a scan of that table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _written_to[id(table)] = (weakref.ref(table, lambda _, key=id(table): _written_to.pop(key, None)), path)
    return table


def forget(*tables: DataFrame, shuffles: bool = False) -> None:
    """Delete tables that :func:`written` returned, when all that reads them is written itself.

    With ``shuffles`` the driver also collects garbage, upon which Spark drops the shuffle
    files of finished steps that nothing refers to any more; both pile up over a long job.
    """
    for table in tables:
        path = _written_to.pop(id(table), None)
        if path is None:
            raise DataError("only a table just as it was written can be deleted", "forget_unknown_table")
        spark = table.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path[1])
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    if shuffles and tables:
        free_shuffles(tables[0])


def free_shuffles(df: DataFrame) -> None:
    """Have Spark drop the shuffle files of steps that are written; it does so when the driver collects garbage."""
    df.sparkSession._jvm.System.gc()
