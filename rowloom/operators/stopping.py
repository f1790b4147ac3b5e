"""Early stopping over runs of any length: every record points at its next improvement.

Within a run records fall strictly, so the records that beat record ``i`` by more than
``min_delta`` are those from some place on, and only places up to ``patience`` after ``i`` count:
blocks of places with a copied look-ahead of that many places find it by bisection.

A patience longer than a segment would make the look-ahead too long.  Then the first record that
beats ``i`` is the first one at or below a bound that depends on ``i`` alone; in ascending
order of values that is the smallest place passed so far: a running minimum, divided like any
other.

Pointers are then followed by doubling, first within blocks of places and then between
blocks, so that the number of joins grows with the logarithm of the number of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from rowloom.operators.ordering import dense_index
from rowloom.session import forget, written

_SIGN = np.int64(-(2**63))


def _as_order(x: np.ndarray) -> np.ndarray:
    """Doubles as integers in the same order."""
    bits = x.view(np.int64)
    return np.where(bits < 0, _SIGN - bits, bits)


def _as_double(order: np.ndarray) -> np.ndarray:
    return np.where(order < 0, _SIGN - order, order).view(np.float64)


def improving_bound(best: np.ndarray, min_delta: float) -> np.ndarray:
    """Largest double that beats ``best`` by more than ``min_delta`` in double arithmetic; NaN if none does.

    Rounding makes ``best - min_delta`` wrong by a few units in the last place, so the bound
    is found by bisection over all doubles.
    """
    best = np.asarray(best, np.float64)
    with np.errstate(all="ignore"):
        beats = lambda order: best - _as_double(order) > min_delta
        low = np.full(len(best), _as_order(np.array([-np.inf]))[0])
        high = np.full(len(best), _as_order(np.array([np.inf]))[0])
        possible = beats(low)
        for _ in range(64):
            middle = (low >> 1) + (high >> 1) + (low & high & 1)
            good = beats(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle)
        return np.where(possible, _as_double(low), np.nan)


def _bounded(records: DataFrame, min_delta: float) -> DataFrame:
    schema = T.StructType([*records.schema.fields, T.StructField("bound", T.DoubleType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = batch.column("v").to_numpy(zero_copy_only=False).astype(np.float64)  # NULL as NaN
            bound = pa.array(improving_bound(best, min_delta), pa.float64(), from_pandas=True)
            yield pa.RecordBatch.from_arrays([*batch.columns, bound], names=[*batch.schema.names, "bound"])

    return records.mapInArrow(add, schema)


def _pointers(records: DataFrame, patience: int, min_delta: float, segment_rows: int) -> DataFrame:
    """``(run_id, i, to)``: the next improvement, or ``i`` itself where none comes in time."""
    bounded = _bounded(records, min_delta)
    known = F.col("v").isNotNull() & ~F.isnan("v")
    marks = records.where(known).select("run_id", "i", F.col("v").alias("x"), F.lit(False).alias("asks")).unionByName(
        bounded.select("run_id", "i", F.col("bound").alias("x"), F.lit(True).alias("asks"))
    )
    # A question without a bound (NULL) stands before every record and finds none.
    order = [F.col("run_id"), F.col("x").isNotNull(), F.col("x"), F.col("asks")]
    pieces = dense_index(marks, order, "__pos").withColumns(
        {"__segment": F.expr(f"__pos div {segment_rows}"), "place": F.when(~F.col("asks"), F.col("i"))}
    )
    totals = pieces.groupBy("run_id", "__segment").agg(F.min("place").alias("lowest"))
    before = Window.partitionBy("run_id").orderBy("__segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col("run_id").alias("__run"), F.col("__segment").alias("__at"), F.min("lowest").over(before).alias("floor")
    )
    so_far = Window.partitionBy("run_id", "__segment").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    same = (F.col("__segment") == F.col("__at")) & F.col("run_id").eqNullSafe(F.col("__run"))
    found = pieces.join(carried, same).withColumn("next", F.least(F.min("place").over(so_far), "floor"))
    in_time = (F.col("next") > F.col("i")) & (F.col("next") - F.col("i") <= patience)
    return found.where("asks").select("run_id", "i", F.when(in_time, F.col("next")).otherwise(F.col("i")).alias("to"))


def _leave_blocks(pointers: DataFrame, segment_rows: int) -> DataFrame:
    """Every pointer followed until it leaves its block of places, or ends."""
    names = ["run_id", "i", "to"]

    def follow(rows: pa.Table, first: np.ndarray) -> pa.Table:
        i, to = (rows.column(c).to_numpy().astype(np.int64) for c in ("i", "to"))
        block = np.cumsum(first) * segment_rows
        place = block + i % segment_rows
        aim = block + to % segment_rows
        there = np.minimum(np.searchsorted(place, aim), len(i) - 1)
        inside = (to // segment_rows == i // segment_rows) & (place[there] == aim)
        step = _followed(np.where(inside, there, np.arange(len(i))))
        reached = pa.array(to[step], rows.schema.field("to").type)
        return rows.select(names).set_column(names.index("to"), "to", reached)

    blocks = pointers.select(*names, F.expr(f"i div {segment_rows}").alias("block"))
    return _by_block(blocks, follow, pointers.select(*names).schema)


# Places of a block for each place of the look-ahead that is copied from the next one.
_LOOK_AHEAD_SHARE = 8


def _near_pointers(records: DataFrame, patience: int, min_delta: float, segment_rows: int) -> DataFrame:
    """``(run_id, i, to)``: next improvements within ``patience`` places, followed until they leave their block, or end."""
    length = max(segment_rows, _LOOK_AHEAD_SHARE * patience)
    span = length + 2 * patience + 1
    place_type = records.schema["i"].dataType
    schema = T.StructType([records.schema["run_id"], T.StructField("i", place_type), T.StructField("to", place_type)])

    def follow(rows: pa.Table, first: np.ndarray) -> pa.Table:
        i, block = (rows.column(c).to_numpy().astype(np.int64) for c in ("i", "block"))
        v = rows.column("v").to_numpy().astype(np.float64)  # NULL as NaN
        at, inside = np.arange(len(i)), i - block * length
        place = np.cumsum(first) * span + inside
        end = np.searchsorted(place, place + patience, side="right")
        low, high = at + 1, end.copy()
        with np.errstate(all="ignore"):
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                beats = v[open_] - v[middle] > min_delta
                high[open_] = np.where(beats, middle, high[open_])
                low[open_] = np.where(beats, low[open_], middle + 1)
        # ``high`` fell from ``end`` only where a record beats this one.
        following = np.where(high < end, high, at)
        home = inside < length
        step = _followed(np.where(home[following], following, at))
        reached = pa.array(i[following[step]], rows.schema.field("i").type)
        return rows.select(["run_id", "i"]).append_column("to", reached).filter(pa.array(home))

    home = F.expr(f"i div {length}")
    copied = F.when((F.col("i") % length < patience) & (home > 0), home - 1)
    blocks = records.withColumn("block", F.explode(F.array_compact(F.array(home, copied))))
    return _by_block(blocks, follow, schema)


def _followed(step: np.ndarray) -> np.ndarray:
    """Each row's last row, by doubling."""
    while not np.array_equal(further := step[step], step):
        step = further
    return step


def _by_block(blocks: DataFrame, follow: Callable[[pa.Table, np.ndarray], pa.Table], schema: T.StructType) -> DataFrame:
    """``follow`` over tables of whole blocks in order of places, many at once; it is told the first row of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            first = _block_starts(rows)
            cut = int(np.flatnonzero(first)[-1])
            rest = rows.slice(cut)  # one block: the next batch may go on with it
            if cut:
                yield from follow(rows.slice(0, cut), first[:cut]).to_batches()
        if rest is not None:
            yield from follow(rest, _block_starts(rest)).to_batches()

    return blocks.repartition("run_id", "block").sortWithinPartitions("run_id", "block", "i").mapInArrow(run, schema)


def _block_starts(rows: pa.Table) -> np.ndarray:
    """Which rows differ from the one before in run or block?  Runs of any type, NULL being one."""
    first = np.ones(len(rows), bool)
    if len(rows) > 1:
        run, block = rows.column("run_id").combine_chunks(), rows.column("block").to_numpy()
        if pa.types.is_nested(run.type):
            cells = run.to_pylist()
            other = np.array([a != b for a, b in zip(cells[1:], cells)])
        else:
            code = run.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
            other = code[1:] != code[:-1]
        first[1:] = other | (block[1:] != block[:-1])
    return first


def last_improvement(records: DataFrame, patience: int, min_delta: float, segment_rows: int) -> DataFrame:
    """``(run_id, best, at)``: value and place of the improvement at which each run ends or is stopped.

    ``records`` are rows ``(run_id, i, v)``: place 1 of every run, and later places whose
    value lies below all earlier ones.  A block has ``segment_rows`` places, or a few times
    ``patience`` where that is more; with a longer patience it never has more than ``segment_rows``.
    """
    records = written(records.select("run_id", "i", "v"), "records")
    # A negative min_delta asks no more of a record than to be one.
    min_delta = max(min_delta, 0.0)
    if patience <= segment_rows:
        left = _near_pointers(records, patience, min_delta, segment_rows)
    else:
        left = _leave_blocks(_pointers(records, patience, min_delta, segment_rows), segment_rows)
    blocks = written(left, "record-pointers")
    # Only first places and places pointed at are on a way; they are what is left to be joined.
    wanted = blocks.select("run_id", F.col("to").alias("i")).unionByName(blocks.where("i = 1").select("run_id", "i"))
    wanted = wanted.distinct().select(F.col("run_id").alias("__run"), F.col("i").alias("__i"))
    here = F.col("run_id").eqNullSafe(F.col("__run")) & (F.col("i") == F.col("__i"))
    nodes = written(blocks.join(wanted, here, "left_semi"), "record-nodes")
    forget(blocks)
    while True:
        ahead = nodes.select(F.col("run_id").alias("__run"), F.col("i").alias("__i"), F.col("to").alias("__to"))
        meets = F.col("run_id").eqNullSafe(F.col("__run")) & (F.col("to") == F.col("__i"))
        moved = (F.col("__to") != F.col("to")).alias("moved")
        stepped = written(nodes.join(ahead, meets).select("run_id", "i", F.col("__to").alias("to"), moved), "record-nodes")
        forget(nodes)
        nodes = stepped
        if nodes.where("moved").isEmpty():
            break
    ends = nodes.where("i = 1").select(F.col("run_id").alias("__run"), F.col("to").alias("__i"))
    return records.join(ends, here).select("run_id", F.col("v").alias("best"), F.col("i").alias("at"))
