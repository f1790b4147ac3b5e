"""Train/validation splits and batch numbers that any partitioning reproduces.

A split needs one thing from the order: the key at which it is cut.

Hash splits find it by radix selection.  Each round counts, per class, the rows by the
next ``RADIX_BITS`` bits of their hash, and keeps the range the cut lies in; counts are
combined before the shuffle, so no row and no key is moved.  When the ranges hold few rows,
their hashes are counted one by one.  Rows are then labelled by one comparison where they
lie.  Only copies that straddle the cut are numbered.

Ordered splits index the key columns (a narrow shuffle) and look the cut key up.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.errors import DataError, require_columns
from rowloom.functions.coerce import col
from rowloom.operators.ordering import as_list, ascending, dense_index, tie_columns
from rowloom.session import small_table, written

TRAIN, VALIDATION = "train", "validation"
# Cuts of up to this many groups are broadcast; more are joined by shuffle.  A group is
# known by a 64-bit id there, so that is at most 2 MB.
BROADCAST_GROUPS = 50_000
#: Bits of the hash per round, and rows of a range that are counted hash by hash.
RADIX_BITS = 12
CHOICE_ROWS = 10_000


def _fraction(value: float) -> None:
    if not 0.0 < value < 1.0:
        raise DataError(f"validation fraction must lie in (0, 1), not {value}", "split_bad_fraction")


def _hash_keys(df: DataFrame, key: str | Sequence[str] | None, seed: int) -> list[Column]:
    names = as_list(key) or tie_columns(df, [], None)
    require_columns(df.columns, names, "split_missing_key", "split key")
    return [F.xxhash64(F.lit(seed), *[col(n) for n in names]), *[col(n) for n in names]]


def _ranked_key(keys: Sequence[Column]) -> Column:
    """The key as one comparable value, missing parts last."""
    return F.struct(*[part for k in keys for part in (k.isNull(), k)])


def random_split(
    df: DataFrame, fraction: float = 0.2, seed: int = 42, key: str | Sequence[str] | None = None
) -> DataFrame:
    """Add ``split``: exactly ``ceil(n * fraction)`` rows are validation, chosen by a seeded hash.

    ``key`` names columns that identify a row; the default is all of them.
    """
    _fraction(fraction)
    return _hash_label(df, [], _hash_keys(df, key, seed), fraction)


def stratified_split(
    df: DataFrame,
    stratify: str | Sequence[str],
    fraction: float = 0.2,
    seed: int = 42,
    key: str | Sequence[str] | None = None,
) -> DataFrame:
    """As :func:`random_split` within each class; quotas by largest remainder, total ``ceil(n * fraction)``."""
    _fraction(fraction)
    classes = as_list(stratify)
    require_columns(df.columns, classes, "missing_target_column", "stratified split")
    return _hash_label(df, classes, _hash_keys(df, key, seed), fraction)


def chronological_split(
    df: DataFrame,
    time_column: str,
    fraction: float = 0.2,
    tie_breakers: str | Sequence[str] | None = None,
    rounding: str = "half_even",
) -> DataFrame:
    """Add ``split``: the last rows in time are validation.

    ``half_even``: ``max(1, round(n * f))`` validation rows.  ``floor``: ``int((1 - f) * n)``
    training rows.
    """
    _fraction(fraction)
    if rounding == "half_even":
        quota = lambda n, sizes: F.greatest(F.lit(1.0), F.bround(n * F.lit(fraction)))
    elif rounding == "floor":
        quota = lambda n, sizes: n - F.floor(F.lit(1.0 - fraction) * n)
    else:
        raise ValueError(f"rounding must be half_even or floor, not {rounding!r}")
    return _label(df, [], _time_keys(df, time_column, [], tie_breakers), quota, tail=True)


def series_tail_split(
    df: DataFrame,
    series: str | Sequence[str],
    time_column: str,
    fraction: float = 0.2,
    tie_breakers: str | Sequence[str] | None = None,
) -> DataFrame:
    """Add ``split``: of every series the first ``int((1 - f) * n)`` rows train, the rest validate."""
    _fraction(fraction)
    names = as_list(series)
    require_columns(df.columns, names, "ts_missing_group_column", "series split")
    quota = lambda n, sizes: n - F.floor(F.lit(1.0 - fraction) * n)
    return _label(df, names, _time_keys(df, time_column, names, tie_breakers), quota, tail=True)


def _time_keys(df: DataFrame, time_column: str, names: Sequence[str], tie_breakers) -> list[Column]:
    require_columns(df.columns, [time_column], "ts_missing_datetime_column", "chronological split")
    ties = tie_columns(df, [time_column, *names], tie_breakers)
    return [col(time_column), *[col(c) for c in ties]]


def _check_sizes(cuts: DataFrame) -> int:
    """Refuse a split without rows or without training rows; the number of groups."""
    seen = cuts.agg(F.count("*").alias("groups"), F.sum("n").alias("rows"), F.sum("n_val").alias("held")).first()
    if not seen["rows"]:
        raise DataError("nothing to split", "split_empty_table")
    if seen["held"] >= seen["rows"]:
        raise DataError(f"{seen['held']} validation rows of {seen['rows']} leave none for training", "split_empty_train")
    return seen["groups"]


def _class_id(classes: Sequence[Column], seed: int) -> Column:
    """64 bits for the values of the class columns; missing values count by place."""
    if not classes:
        return F.lit(0).cast("bigint")
    return F.xxhash64(F.lit(seed), *[part for c in classes for part in (c.isNull(), c)])


def _kept(df: DataFrame, label: str, few: bool) -> DataFrame:
    """A table of a row or so per class: rows in the plan if there are few classes, else written."""
    if not few:
        return written(df, label)
    return small_table(df.sparkSession, [tuple(r) for r in df.collect()], df.schema.simpleString()[len("struct<") : -1])


def _quotas(df: DataFrame, classes: Sequence[str], fraction: float) -> tuple[DataFrame, int]:
    """id, n, n_val per class, and the seed with which no two classes share an id."""
    names = [f"__g{i}" for i in range(len(classes))]
    sizes = df.groupBy(*[col(c).alias(n) for c, n in zip(classes, names)]).agg(F.count("*").alias("n"))
    if classes:
        counted = written(_class_quotas(sizes, names, fraction), "class-quotas")
    else:
        counted = _kept(sizes.where("n > 0").withColumn("n_val", F.ceil(F.col("n") * F.lit(fraction))), "rows", True)
    seed = 0
    while True:
        ids = counted.select(_class_id([F.col(n) for n in names], seed).alias("id"), "n", F.col("n_val").cast("bigint").alias("n_val"))
        if not classes or ids.groupBy("id").count().where("count > 1").isEmpty():
            return ids, seed
        seed += 1


def _hash_label(df: DataFrame, classes: Sequence[str], keys: Sequence[Column], fraction: float) -> DataFrame:
    """Add ``split``: per class the rows of the smallest hashes validate."""
    quotas, seed = _quotas(df, classes, fraction)
    few = _check_sizes(quotas) <= BROADCAST_GROUPS
    quotas = _kept(quotas, "split-quotas", few)
    per_class = lambda table: F.broadcast(table) if few else table
    hashed = df.select(_class_id([col(c) for c in classes], seed).alias("id"), keys[0].alias("h"))

    low, high = F.lit(-(1 << 63)), F.lit((1 << 63) - 1)
    # wanted: how many rows of the range validate; size: how many it has.
    ranges = quotas.where("n_val > 0").select("id", low.alias("low"), high.alias("high"), F.col("n_val").alias("wanted"), F.col("n").alias("size"))
    shift, settled = 64, []
    while True:
        settled.append(ranges.where(F.col("size") <= CHOICE_ROWS))
        ranges = ranges.where(F.col("size") > CHOICE_ROWS)
        if shift <= RADIX_BITS or ranges.isEmpty():
            settled.append(ranges)
            break
        shift -= RADIX_BITS
        open_ = hashed.join(per_class(ranges.select("id", "low", "high")), "id").where("h between low and high")
        counts = open_.groupBy("id", F.shiftright("h", shift).alias("bucket")).agg(F.count("*").alias("rows"))
        upto = F.sum("rows").over(Window.partitionBy("id").orderBy("bucket"))  # at most 2^RADIX_BITS per class
        summed = counts.withColumn("upto", upto).join(ranges.select("id", "wanted"), "id")
        start = F.shiftleft("bucket", shift)
        ranges = _kept(
            summed.where("upto >= wanted and upto - rows < wanted").select(
                "id",
                start.alias("low"),
                (start + F.lit((1 << shift) - 1)).alias("high"),
                (F.col("wanted") - F.col("upto") + F.col("rows")).alias("wanted"),
                F.col("rows").alias("size"),
            ),
            "split-ranges",
            few,
        )
    last = settled[0]
    for more in settled[1:]:
        last = last.unionByName(more)
    last = _kept(last, "split-last-ranges", few)
    choice = hashed.join(per_class(last.select("id", "low", "high")), "id").where("h between low and high")
    counts = choice.groupBy("id", "h").agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("id").orderBy("h"))
    summed = counts.withColumn("upto", upto).join(last.select("id", "wanted"), "id")
    cuts = summed.where("upto >= wanted and upto - rows < wanted")
    cuts = cuts.select("id", F.col("h").alias("cut"), (F.col("upto") > F.col("wanted")).alias("straddles"))
    cuts = _kept(cuts, "split-cuts", few)
    if not cuts.where("straddles").isEmpty():
        return _label(df, classes, keys, None if classes else lambda n, sizes: F.ceil(n * F.lit(fraction)), tail=False, fraction=fraction)

    kept = [col(c) for c in df.columns]
    if classes:
        placed = df.withColumn("__id", _class_id([col(c) for c in classes], seed))
        found = cuts.select(F.col("id").alias("__id"), F.col("cut").alias("__cut"))
        placed = placed.join(per_class(found), "__id", "left")
    else:
        placed = df.withColumn("__cut", F.lit(cuts.first()["cut"]))
    held = F.coalesce(keys[0] <= F.col("__cut"), F.lit(False))
    return placed.select(*kept, F.when(held, F.lit(VALIDATION)).otherwise(F.lit(TRAIN)).alias("split"))


def _label(
    df: DataFrame,
    group: Sequence[str],
    keys: Sequence[Column],
    quota: Callable[[Column, DataFrame], Column] | None,
    tail: bool,
    fraction: float = 0.0,
) -> DataFrame:
    group_names = [f"__g{i}" for i in range(len(group))]
    key_names = [f"__k{i}" for i in range(len(keys))]
    narrow = df.select(
        *[col(g).alias(n) for g, n in zip(group, group_names)], *[k.alias(n) for k, n in zip(keys, key_names)]
    )
    indexed = dense_index(narrow, [F.col(n) for n in (*group_names, *key_names)], "__pos")
    sizes = indexed.groupBy(*group_names).agg(F.count("*").alias("n"), F.min("__pos").alias("lo"))
    counted = (
        _class_quotas(sizes, group_names, fraction)
        if quota is None
        else sizes.withColumn("n_val", quota(F.col("n"), sizes).cast("bigint"))
    )
    counted = counted.withColumn(
        "__cut", F.col("lo") + (F.col("n") - F.col("n_val") if tail else F.col("n_val"))
    )
    cuts = written(counted.select(*group_names, "lo", "n", "n_val", "__cut"), "cut-positions")
    few = _check_sizes(cuts) <= BROADCAST_GROUPS

    # The cut is the first row of the second part.  If the row before it has the same
    # key, comparing keys cannot separate the two and the rows themselves are numbered.
    probes = cuts.withColumn("__pos", F.explode(F.array(F.col("__cut") - 1, F.col("__cut"))))
    keyed = indexed.select("__pos", _ranked_key([F.col(n) for n in key_names]).alias("__key"))
    at = keyed.join(F.broadcast(probes) if few else probes, "__pos")
    found = at.groupBy(*group_names, "__cut").agg(
        F.max(F.when((F.col("__pos") < F.col("__cut")) & (F.col("__pos") >= F.col("lo")), F.col("__key"))).alias("__last"),
        F.max(
            F.when((F.col("__pos") == F.col("__cut")) & (F.col("__cut") < F.col("lo") + F.col("n")), F.col("__key"))
        ).alias("__first"),
    )
    found = written(found, "cut-keys")
    tied = found.where(F.col("__last") == F.col("__first")).limit(1).count()

    second, first = (VALIDATION, TRAIN) if tail else (TRAIN, VALIDATION)
    if tied:
        whole = dense_index(df, [*[col(g) for g in group], *keys], "__pos")
        placed = _with_group(whole, cuts.select(*group_names, "__cut"), group, group_names, few)
        beyond = F.col("__pos") >= F.col("__cut")
    else:
        chosen = found.select(*group_names, F.col("__first").alias("__cut"))
        placed = _with_group(df, chosen, group, group_names, few)
        beyond = F.coalesce(_ranked_key(keys) >= F.col("__cut"), F.lit(False))
    return placed.select(
        *[col(c) for c in df.columns], F.when(beyond, F.lit(second)).otherwise(F.lit(first)).alias("split")
    )


def _with_group(
    df: DataFrame, per_group: DataFrame, group: Sequence[str], group_names: Sequence[str], few: bool
) -> DataFrame:
    if not group:
        return df.withColumn("__cut", per_group.select("__cut").scalar())
    same = None
    for name, key in zip(group, group_names):
        match = col(name).eqNullSafe(F.col(key))
        same = match if same is None else same & match
    return df.join(F.broadcast(per_group) if few else per_group, same, "left")


def _class_quotas(sizes: DataFrame, group_names: Sequence[str], fraction: float) -> DataFrame:
    """Whole parts of ``n_c * n_val / n``, then one more for the largest remainders."""
    sizes = written(sizes, "class-sizes")
    seen = sizes.agg(F.count("*").alias("classes"), F.sum("n").alias("rows")).first()
    total, wanted = F.lit(seen["rows"]), F.ceil(F.lit(seen["rows"]) * F.lit(fraction))
    exact = F.col("n") * wanted / total
    shared = sizes.withColumns({"whole": F.floor(exact), "rest": exact - F.floor(exact)})
    order = [-F.col("rest"), *[F.col(g) for g in group_names]]
    if seen["classes"] <= BROADCAST_GROUPS:
        ranked = shared.withColumn("place", F.row_number().over(Window.orderBy(*ascending(order))) - 1)
    else:
        ranked = dense_index(shared, order, "place")
    missing = wanted - shared.agg(F.sum("whole")).scalar()
    one_more = F.when(F.col("place") < missing, 1).otherwise(0)
    return ranked.withColumn("n_val", F.col("whole") + one_more).drop("whole", "rest", "place")


def batches(
    df: DataFrame, batch_size: int, order_by: str | Sequence[str], tie_breakers: str | Sequence[str] | None = None
) -> DataFrame:
    """Add ``row_index`` and ``batch``: consecutive rows in order, the last batch partial."""
    order = as_list(order_by)
    require_columns(df.columns, order, "batch_missing_order", "batches")
    return _numbered(df, batch_size, [col(c) for c in [*order, *tie_columns(df, order, tie_breakers)]])


def shuffled_batches(
    df: DataFrame, batch_size: int, seed: int = 42, key: str | Sequence[str] | None = None
) -> DataFrame:
    """As :func:`batches`, in an order drawn by a seeded hash of the row key."""
    return _numbered(df, batch_size, _hash_keys(df, key, seed))


def _numbered(df: DataFrame, batch_size: int, keys: Sequence[Column]) -> DataFrame:
    if batch_size <= 0:
        raise DataError(f"batch size must be positive, not {batch_size}", "batch_bad_size")
    return dense_index(df, keys).withColumn("batch", F.expr(f"row_index div {int(batch_size)}"))
