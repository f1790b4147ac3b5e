import datetime as dt
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from rowloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def hourly(spark):
    """Twelve hourly rows: feat1 = i, feat2 = 2i, target = i mod 3."""
    start = dt.datetime(2020, 1, 1)
    rows = [(start + dt.timedelta(hours=i), float(i), 2.0 * i, float(i % 3)) for i in range(12)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, feat1 double, feat2 double, target double")


@pytest.fixture(scope="session")
def skewed(spark):
    """3,000 events of which series 0 holds two thirds."""
    return spark.range(3000).selectExpr(
        "id as event_id",
        "case when id % 3 < 2 then 0 else id % 30 end as series",
        "timestamp_seconds(1700000000 + (id * 7919) % 3001) as t",
        "cast((id * 37) % 101 as double) as v",
    )


def column(df, name, by):
    return [r[name] for r in df.orderBy(by).select(name).collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
