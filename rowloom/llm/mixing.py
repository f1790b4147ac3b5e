"""Mixing sources to target token numbers by entropy balancing.

Copies of a document are 0, 1 or 2.  Of all ways to draw copies, the one closest to
drawing each of two copies with even odds (in relative entropy) that still meets a
source's token target tilts the odds exponentially: the expected copies of a document of
x mean sizes are 2 / (1 + exp(-lambda x)).  The dual in lambda is convex; damped Newton
steps solve it for all sources at once, each step one aggregation over the counts per
(source, size) and one written row per source.

Rounding.  Each document has a fixed number u in [0, 1) from its id.  Documents above
the mean size take floor(rate + u) copies.  The others take the copies whose place
k - rate - u lies under one cut per source, which is chosen from summed bins so that the
source comes within about half a document of its target.  The cut depends on sums only,
so reruns agree and a hot source is never sorted in one task.

Documents are read once, to (id, source, size); later steps read that table.  Sources
meet documents in an equi-join on the source, which adaptive execution broadcasts when it is
small and splits when a source is hot.

Defined cases: null text has size 0 and is never taken; a null source is a source of its
own, last in order; repeated rows count as often as they come and share u; a source
without words has target 0; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.llm.common import text_of, words_of
from rowloom.operators.ordering import dense_index
from rowloom.session import written

MAX_COPIES = 2
_HIGH_BITS = 15  # bins per round, twice: places are resolved to 2^-27
_STEPS = 80


def source_key(source: Column) -> Column:
    """Equal for equal sources, null included."""
    return F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source.cast("string")))


def sized(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Written table of doc_id, source, key and size in words."""
    rows = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        source_key(F.col(f"`{source}`")).alias("key"),
        F.size(words_of(text_of(text))).cast("long").alias("size"),
    )
    return written(rows, "mix-sizes")


def token_targets(sources: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5) -> DataFrame:
    """``sources`` (source, key, source_size) with a target per source.

    Sources in order share ``share`` of all words by weight; a target stops at
    MAX_COPIES times its source, and the excess is shared again among the others.
    """
    ranked = dense_index(sources, [F.col("source")], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = written(ranked.withColumn("weight", weight).withColumn("most", MAX_COPIES * F.col("source_size")), "mix-sources")
    level, full = 0.0, -1
    while True:
        over = F.col("most") <= level * F.col("weight")
        total, filled, rest, n = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(over.cast("long")), F.lit(0)),
        ).first()
        if n == full or not rest:
            break
        full, level = n, (share * total - filled) / rest
    return ranked.withColumn("target", F.least(F.col("most").cast("double"), level * F.col("weight")))


def tilted_rates(sizes: DataFrame, targets: DataFrame, tolerance: float = 1e-10) -> DataFrame:
    """``targets`` with mean_size and lambda, null where every document is taken as often as allowed or never."""
    counts = written(sizes.where("size > 0").groupBy("key", "size").agg(F.count("*").alias("n")), "mix-counts")
    mean = counts.groupBy("key").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean_size"))
    state = targets.join(mean, "key", "left")
    open_ = (F.col("target") > 0) & (F.col("target") < F.col("most"))
    ratio = F.col("target") / F.col("most")
    state = state.select(
        *targets.columns,
        "mean_size",
        F.when(open_, F.log(ratio / (1 - ratio))).alias("lam"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
    )
    state = written(state, "mix-dual")
    own = state.columns
    for _ in range(_STEPS):
        x = F.col("size") / F.col("mean_size")
        odds = 1 / (1 + F.exp(-F.col("lam") * x))
        sums = (
            counts.join(state.where("lam is not null").select("key", "lam", "mean_size"), "key")
            .groupBy("key")
            .agg(
                F.sum(MAX_COPIES * F.col("n") * F.col("size") * odds).alias("taken"),
                F.sum(MAX_COPIES * F.col("n") * F.col("size") * x * odds * (1 - odds)).alias("slope"),
            )
        )
        off = F.col("taken") - F.col("target")
        met = F.abs(off) <= tolerance * F.col("target")
        low = F.when(off < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(off >= 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - off / F.col("slope")
        inside = (F.col("slope") > 0) & ((newton > low) | low.isNull()) & ((newton < high) | high.isNull())
        step = F.least(F.greatest(newton, F.col("lam") - 8), F.col("lam") + 8)
        # Outside the bracket: halve it; with an open side, double away from zero.
        halved = F.coalesce((low + high) / 2, 2 * F.col("lam") + F.when(off < 0, 1.0).otherwise(-1.0))
        moved = state.join(sums, "key", "left").select(
            *[c for c in own if c not in ("lam", "low", "high")],
            F.when(met | off.isNull(), F.col("lam")).when(inside, step).otherwise(halved).alias("lam"),
            low.alias("low"),
            high.alias("high"),
            (~met).alias("going"),
        )
        state = written(moved, "mix-dual")
        if state.where("going").isEmpty():
            break
    return state.withColumn("lam", F.round("lam", 9)).drop("low", "high", "going")


def _rate() -> Column:
    tilted = MAX_COPIES / (1 + F.exp(-F.col("lam") * F.col("size") / F.col("mean_size")))
    return F.when(F.col("lam").isNotNull(), tilted).when(F.col("target") > 0, float(MAX_COPIES)).otherwise(0.0)


def _u() -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit("mix"), "doc_id"), 34) / F.lit(float(1 << 30))


def _place(k: int) -> Column:
    """Where copy k of a document lies, as a whole number of 2^-27 from -3 on."""
    return F.floor((k - _rate() - _u() + 3) * float(1 << 27)).cast("long")


def _small() -> Column:
    return F.col("lam").isNotNull() & (F.col("size") <= F.col("mean_size"))


def copies() -> Column:
    """Copies of a row that has doc_id, size and its source's lam, mean_size, target and cut."""
    under = sum((F.coalesce(_place(k) <= F.col("cut"), F.lit(False)).cast("int") for k in range(1, MAX_COPIES + 1)), F.lit(0))
    return F.when(F.col("size") == 0, 0).when(_small(), under).otherwise(F.floor(_rate() + _u()).cast("int"))


def rounding_cuts(sizes: DataFrame, dual: DataFrame) -> DataFrame:
    """``dual`` with the cut of each source's small documents."""
    rows = sizes.where("size > 0").join(dual.where("lam is not null"), "key")
    large = rows.where(~_small()).groupBy("key").agg(F.sum(F.col("size") * F.floor(_rate() + _u())).alias("large"))
    need = written(
        dual.where("lam is not null").join(large, "key", "left").select("key", (F.col("target") - F.coalesce("large", F.lit(0))).alias("need")),
        "mix-need",
    )
    items = rows.where(_small()).select("key", "size", F.explode(F.array(*[_place(k) for k in range(1, MAX_COPIES + 1)])).alias("q"))
    by = Window.partitionBy("key").orderBy("bin")

    def bins(of: DataFrame, bin_: Column, before: Column) -> DataFrame:
        sums = of.groupBy("key", bin_.alias("bin")).agg(F.sum("size").alias("words"), F.first("need").alias("need"), F.first(before).alias("before"))
        return sums.withColumn("after", F.col("before") + F.sum("words").over(by)).withColumn("before", F.col("after") - F.col("words"))

    high = bins(items.join(need, "key"), F.shiftright("q", _HIGH_BITS), F.lit(0))
    # The first bin that reaches the need; a source that cannot reach it takes all.
    at = high.where("after >= need").groupBy("key").agg(F.min(F.struct("bin", "before", "need")).alias("at"))
    at = written(at.select("key", F.col("at.bin").alias("high"), F.col("at.before").alias("base"), "at.need"), "mix-bins")
    fine = items.join(at, "key").where(F.shiftright("q", _HIGH_BITS) == F.col("high"))
    low = bins(fine, F.col("q"), F.col("base"))
    # The end of the bin nearest to the need; its start is the end of the one before.
    nearest = low.groupBy("key").agg(
        F.min(
            F.least(
                F.struct(F.abs(F.col("after") - F.col("need")).alias("off"), F.col("bin").alias("cut")),
                F.struct(F.abs(F.col("before") - F.col("need")).alias("off"), (F.col("bin") - 1).alias("cut")),
            )
        ).alias("best")
    )
    every = F.lit(6 << 27).cast("long")
    return dual.join(nearest.select("key", F.col("best.cut").alias("cut")), "key", "left").withColumn("cut", F.coalesce("cut", every))


def fit_mix(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5) -> DataFrame:
    """One row per source: key, source_size, target, mean_size, lam, cut."""
    sources = sizes.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    dual = tilted_rates(sizes, token_targets(sources, weights, share))
    return written(rounding_cuts(sizes, dual), "mix")


def mix(df: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, **columns: str) -> DataFrame:
    """One row per row: doc_id, source, size, source_size, target, rate, copies, taken."""
    sizes = sized(df, **columns)
    rows = sizes.join(fit_mix(sizes, weights, share).drop("source"), "key")
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", _rate().alias("rate"), copies().alias("copies")
    ).withColumn("taken", F.col("copies") * F.col("size"))


def repeat_rows(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it, with their own columns."""
    plan = fit_mix(sized(df, doc_id, text, source)).select("key", "target", "mean_size", "lam", "cut")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    rows = df.select(
        row,
        F.col(f"`{doc_id}`").alias("doc_id"),
        source_key(F.col(f"`{source}`")).alias("key"),
        F.size(words_of(text_of(text))).cast("long").alias("size"),
    ).join(plan, "key")
    taken = rows.select("__row", F.explode(F.array_repeat(F.lit(1), copies())).alias("__copy"))
    return taken.select(*[F.col("__row")[c].alias(c) for c in df.columns])
