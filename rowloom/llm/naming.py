"""Exact duplicates by deterministic block naming, DataFrame operations only.

A normalised text is cut into blocks of ``BLOCK`` bytes.  The distinct blocks are sorted
and numbered: equal blocks get one integer name, different blocks different names.
Then adjacent pairs of names are named in the same way, level by level, until every
document has one name.  Two documents have the same (blocks, name) exactly when their
texts are equal: names come from comparing contents, never from a hash alone.

How it scales.  The contents are shuffled once, combined before the shuffle, so a text
that a third of the rows hold is sent once per task.  Rows look their names up by a
128-bit digest of the block; the table of names shows whether two different blocks share
a digest, and if so the digest is drawn anew with another seed.  Level by level only
integers move, and only for documents that still have more than one name.  Hot names are
joined by shuffle joins, which adaptive execution splits.  Each level is a written
table, so a lost executor costs a re-read, and numbering is never repeated with another
outcome.

Defined cases: null text counts as empty; null ids are allowed and come last among
equals; repeated rows are rows of one group, of which one stays; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.llm.common import BLANK, text_of
from rowloom.session import written

BLOCK = 4096


def without_blanks(text: Column) -> Column:
    return F.regexp_replace(text, BLANK, "")


def digest(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed + k), block).alias(f"h{k}") for k in (0, 1)]


def blocks_of(text: Column, size: int) -> Column:
    """Byte blocks of a text in order; one empty block for an empty text."""
    raw = text.cast("binary")
    last = F.greatest(F.octet_length(text) - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last, F.lit(size)), lambda i: F.substring(raw, i + 1, F.lit(size)))


def numbered(distinct: DataFrame, *key: str) -> DataFrame:
    """``distinct`` with a name: partition above, place in the partition's order below."""
    return distinct.sortWithinPartitions(*key).withColumn("name", F.monotonically_increasing_id())


def identities(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    normalise: Callable[[Column], Column] = without_blanks,
    size: int = BLOCK,
    digest: Callable[[Column, int], list[Column]] = digest,
) -> DataFrame:
    """One row per row of ``df``: row, doc_id, n_points, text_sha256, n_blocks, name."""
    whole = normalise(text_of(text))
    cut = df.select(whole.alias("t")).select(F.explode(blocks_of(F.col("t"), size)).alias("block"))
    seed = 0
    while True:
        names = numbered(cut.groupBy("block").agg(F.count("*").alias("n_equal")), "block")
        names = written(names.select(*digest(F.col("block"), seed), "name"), "block-names")
        if names.groupBy("h0", "h1").count().where("count > 1").isEmpty():
            break
        seed += 1
    rows = written(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{doc_id}`").alias("doc_id"),
            F.length(text_of(text)).cast("long").alias("n_points"),
            whole.alias("t"),
        ).select(
            "row",
            "doc_id",
            "n_points",
            F.sha2(F.col("t"), 256).alias("text_sha256"),
            F.transform(blocks_of(F.col("t"), size), lambda b: F.struct(*digest(b, seed))).alias("blocks"),
        ),
        "block-rows",
    )
    spots = rows.select("row", F.size("blocks").alias("n_blocks"), F.posexplode("blocks").alias("at", "h"))
    level = written(
        spots.select("row", "n_blocks", "at", "h.h0", "h.h1").join(names, ["h0", "h1"]).select("row", "n_blocks", "at", "name"),
        "block-level",
    )
    done = level.where("n_blocks = 1").select("row", "n_blocks", "name")
    longest, left = rows.agg(F.max(F.size("blocks"))).first()[0] or 1, 1
    level = level.where("n_blocks > 1")
    while left < longest:
        pairs = level.groupBy("row", "n_blocks", F.shiftright("at", 1).alias("pair")).agg(
            F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        pairs = written(pairs, "block-pairs")
        names = written(numbered(pairs.groupBy("a", "b").agg(F.count("*").alias("n_equal")), "a", "b"), "pair-names")
        level = written(
            pairs.join(names, ["a", "b"]).select("row", "n_blocks", F.col("pair").alias("at"), "name"), "block-level"
        )
        left *= 2
        # A document of n blocks is down to one name when 2^level reaches n.
        done = done.union(level.where(F.col("n_blocks") <= left).select("row", "n_blocks", "name"))
        level = level.where(F.col("n_blocks") > left)
    return rows.drop("blocks").join(done, "row")


def exact_duplicates(df: DataFrame, **how) -> DataFrame:
    """One row per row: doc_id, keep_id, group_size, kept, text_sha256, n_points.

    Of equal texts the row with the most code points stays, then the smallest id, then
    (for repeated rows) the first.
    """
    named = written(identities(df, **how), "identities")
    best = F.struct(
        -F.col("n_points"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row")
    )
    groups = named.groupBy("n_blocks", "name").agg(F.count("*").alias("group_size"), F.min(best).alias("best"))
    # Written, so that the join below is one of two plain shuffles, which can be split at a hot name.
    joined = named.join(written(groups, "identity-groups"), ["n_blocks", "name"])
    return joined.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        "n_points",
    )


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with their own columns.

    A row that stays is found again by id, text digest and length; rows alike in all
    three are repeated rows, of which the smallest in column order stays.
    """
    def key(i: Column, sha: Column, n: Column) -> Column:
        return F.concat_ws(":", sha, n.cast("string"), i.cast("string"))  # a null id adds nothing

    own = key(F.col(f"`{doc_id}`"), F.sha2(without_blanks(text_of(text)), 256), F.length(text_of(text)))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    stay = exact_duplicates(df, doc_id=doc_id, text=text).where("kept")
    stay = stay.select(key(F.col("doc_id"), F.col("text_sha256"), F.col("n_points")).alias("__key"))
    found = df.select(row, own.alias("__key")).join(stay, "__key", "left_semi")
    one = Window.partitionBy("__key").orderBy(F.xxhash64("__row"))
    return (
        found.withColumn("__place", F.row_number().over(one))
        .where("__place = 1")
        .select(*[F.col("__row")[c].alias(c) for c in df.columns])
    )
