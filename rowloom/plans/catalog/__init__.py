"""All registered queries, by area."""

from rowloom.plans.catalog import (  # noqa: F401
    evaluation,
    preprocessing,
    profiling,
    row_queries,
    series_queries,
    source_queries,
    split_queries,
    stream_queries,
    window_queries,
)
from rowloom.plans.catalog.registry import ORACLES, QUERIES  # noqa: F401
