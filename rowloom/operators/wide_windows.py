"""Rolling aggregates whose cost does not depend on the width of the window.

A series is cut into blocks as long as the window.  Any window is then the tail of one
block and the head of the next, so three passes over sorted rows are enough, whatever the
width: running aggregates from each block's start, running aggregates back from its end,
and the latter as they stood ``rows - 1`` rows ago.  Extremes are the lesser or greater of
the two.  Sums are added, never subtracted, so a large value that has left the window
leaves no error behind.  Deviations merge as (count, mean, squares around the mean).

All passes share the partitioning of the series; only rows within a task are sorted anew.
Features of one width are computed together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: From this width on, windows are composed.  Below it Spark's sliding frame is as quick.
WIDE_ROWS = 64

_HEAD, _TAIL = "h", "t"


def _running(value: Column, agg: str) -> dict[str, Column]:
    """Aggregates that compose, by suffix.  Squares around the mean are n times the variance."""
    made = {"n": F.count(value)}
    if agg in ("min", "max"):
        made[agg] = (F.min if agg == "min" else F.max)(value)
    elif agg in ("sum", "mean"):
        made["sum"] = F.sum(value)
    else:
        made |= {"avg": F.avg(value), "var": F.var_pop(value)}
    return made


def _composed(agg: str, head: Mapping[str, Column], tail: Mapping[str, Column]) -> tuple[Column, Column]:
    """Value and count of a window from its two parts; a part without values is null."""
    none = F.lit(0)
    n = head["n"] + F.coalesce(tail["n"], none)
    if agg == "min":
        return F.least(head["min"], tail["min"]), n
    if agg == "max":
        return F.greatest(head["max"], tail["max"]), n
    if agg in ("sum", "mean"):
        both = F.coalesce(head["sum"] + tail["sum"], head["sum"], tail["sum"])
        return (both if agg == "sum" else both / F.nullif(n, none)), n
    a, b = head["n"].cast("double"), F.coalesce(tail["n"], none).cast("double")
    zero = F.lit(0.0)
    squares = F.coalesce(head["var"] * a, zero) + F.coalesce(tail["var"] * b, zero)
    apart = F.coalesce(head["avg"] - tail["avg"], zero)
    squares += apart * apart * a * b / F.nullif(a + b, zero)
    return F.when(n > 1, F.sqrt(squares / (a + b - 1))), n


def wide_rolling(
    df: DataFrame, features: Mapping[str, tuple[Column, int, str]], series: Sequence[Column], order: Sequence[Column]
) -> tuple[DataFrame, dict[str, tuple[Column, Column]], list[str]]:
    """``df`` with helper columns; value and count over each feature's window; the helpers' names.

    ``features`` maps a name to (value, rows, aggregate); none may read another.
    """
    widths = sorted({rows for _, rows, _ in features.values()})
    place, helpers = "__wide_row", ["__wide_row"]
    df = df.withColumn(place, F.row_number().over(Window.partitionBy(*series).orderBy(*order)) - 1)
    results: dict[str, tuple[Column, Column]] = {}
    for rows in widths:
        block = f"__wide_block_{rows}"
        parts: dict[str, tuple[str, dict[str, Column]]] = {}
        for i, (name, (value, width, agg)) in enumerate(features.items()):
            if width == rows:
                parts[name] = (f"__wide_{rows}_{i}", _running(value, agg))
        df = df.withColumn(block, F.expr(f"{place} div {rows}"))
        inside = Window.partitionBy(*series, block)
        head = inside.orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
        tail = inside.orderBy(F.col(place).desc()).rowsBetween(Window.unboundedPreceding, 0)
        columns = [(f"{label}{_HEAD}{k}", f"{label}{_TAIL}{k}", c) for label, made in parts.values() for k, c in made.items()]
        df = df.withColumns({t: c.over(tail) for _, t, c in columns})
        df = df.withColumns({h: c.over(head) for h, _, c in columns})
        # The tail of the block before, where the window reaches into it.
        again = Window.partitionBy(*series).orderBy(place)
        reaches = F.col(place) % rows != rows - 1
        earlier = lambda t: F.when(reaches, F.lag(t, rows - 1).over(again))
        df = df.withColumns({t: earlier(t) for _, t, _ in columns})
        helpers += [block, *(h for h, _, _ in columns), *(t for _, t, _ in columns)]
        for name, (label, made) in parts.items():
            pick = lambda side: {k: F.col(f"{label}{side}{k}") for k in made}
            results[name] = _composed(features[name][2], pick(_HEAD), pick(_TAIL))
    return df, results, helpers
