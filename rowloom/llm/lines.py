"""Line dedup by an exact set-similarity join, DataFrame operations only.

A line (a piece between line feeds, lower-cased) is the set of its ``WORDS``-word
shingles, or of its whole word sequence if it is shorter.  Two lines are similar at a
Jaccard similarity of ``PERCENT`` per cent.  A line goes when an earlier line, by document id and
place, is similar to it; blank lines stay.

1. Words are counted into 2^16 hashed slots (one array of counts, whatever the corpus).  A
   token is as rare as its last word: log of the slot's count, then hash.  The count sits
   in the top bits of the token, so sorting tokens sorts by rarity.
2. Each line keeps its size, a 128-bit digest of its set and its prefix.  Equal sets are
   one class, of which all but the first line go.
3. Prefix tokens that two classes share are postings; a class must share as many of them
   as its size demands.  Only lines of such classes are read again, past a bitmap of their keys that
   keeps most others out of the shuffle; each gives its tokens and 128 bits of their parity.
4. Per (token, size band) every class is compared with the earliest one: linear in the
   group, and most later matches go.  Classes that are left are compared with all earlier
   ones that share as many postings as the sizes demand.  Length, position and parity filters
   run inside these joins; the pairs they leave get an exact intersection.

Hot tokens come last in the order and are combined before the shuffle; hot lines are one
class; joins are equi-joins, which adaptive execution splits at a hot key.

Defined cases: null and empty texts have one blank line; null ids come last in order;
repeated rows are documents of their own, later than their first; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.llm.common import text_of
from rowloom.session import forget, free_shuffles, written

WORDS = 5
PERCENT = 80
SLOTS = 1 << 16
_HASH_BITS = 56
FILTER_BITS = 1 << 23


def _folded(line: Column) -> Column:
    """A line with single spaces between words; other white space is rare."""
    odd = line.startswith(" ") | line.endswith(" ")
    for blank in ("  ", "\t", "\x0b", "\x0c", "\r"):  # much faster than one pattern
        odd |= line.contains(blank)
    return F.when(odd, F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line)


def _slot(h: Column) -> Column:
    return h.bitwiseAND(SLOTS - 1).cast("int")


def slot_counts(df: DataFrame, text: str) -> list[int]:
    """How often words of each slot occur; a word beside odd white space counts together with it, as counts only order tokens."""
    words = F.split(F.replace(F.lower(text_of(text)), F.lit("\n"), F.lit(" ")), " ")
    words = df.select(F.explode(words).alias("w"))
    counts = [0] * SLOTS
    for r in words.groupBy(_slot(F.xxhash64("w")).alias("slot")).count().collect():  # at most SLOTS rows
        counts[r.slot] = r["count"]
    return counts


def _rarity_class(count: float) -> int:
    return min(126, math.floor(3 * math.log2(1 + count)))


def rarity_table(counts: list[int]) -> Column:
    """Array literal: per slot the rarity class, which goes into the top bits of a token."""
    return F.split(F.lit(",".join(str(_rarity_class(c)) for c in counts)), ",").cast("array<tinyint>")


def with_tokens(rows: DataFrame, table: Column, width: int) -> DataFrame:
    """``line`` replaced by ``tokens``: its distinct tokens, rarest first.

    A token is the class of a shingle's last word, then the shingle's hash.  Functions over
    arrays share no work within one expression, so each step is a column that the next ones
    read.  No array may hold nulls as far as Spark can tell: only then are its numbers sorted
    without being boxed.
    """

    def token(last: Column, hashed: Column) -> Column:
        rarity = F.coalesce(F.get(table, _slot(last)), F.lit(0).cast("tinyint")).cast("bigint")
        return F.shiftleft(rarity, _HASH_BITS).bitwiseOR(F.shiftrightunsigned(hashed, 64 - _HASH_BITS))

    rows = rows.withColumn("line", _folded(F.col("line")))
    rows = rows.withColumn("words", F.split("line", " "))
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    hashes, count = F.col("hashes"), F.when(F.col("line") == "", 0).otherwise(F.size("hashes"))
    before = lambda i: [F.get(hashes, i + k) for k in range(width - 1)]
    ends = F.slice(hashes, width, F.greatest(F.size(hashes) - (width - 1), F.lit(0)))
    shingles = F.transform(ends, lambda h, i: token(h, F.xxhash64(*before(i), h)))
    # The last word of a line that is shorter than a shingle stands for the whole of it.
    whole = F.array(token(F.element_at(hashes, -1), F.xxhash64(count, "line")))
    short = F.when(count > 0, whole).otherwise(F.slice(whole, 1, 0))
    rows = rows.withColumn("tokens", F.when(count < width, short).otherwise(shingles)).drop("hashes", "line")
    return rows.withColumn("tokens", F.sort_array(F.array_distinct("tokens")))


def prefix_length(n: Column, percent: int) -> Column:
    return F.least(n, n - F.ceil(percent * n / 100) + 1 + F.floor(n / 40)).cast("int")


def need(n: Column, percent: int) -> Column:
    """Postings that a line of n tokens shares, at least, with a line similar to it."""
    return 1 + F.floor(F.floor(percent * n / 100) / 40)


def pair_need(a: Column, b: Column) -> Column:
    """Postings that two similar lines of a and b tokens share, at least."""
    return 1 + F.floor(F.least(a, b) / 40)


def text_lines(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    docs = df.select(
        F.monotonically_increasing_id().alias("row"),  # per document: numbered before lines are made
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{doc_id}`"), text_of(text)).alias("key"),
        F.lower(text_of(text)).alias("whole"),
    )
    return docs.select("row", "doc_id", "key", F.posexplode(F.split("whole", "\n")).alias("at", "line"))


_CLASS = ["n", "h", "h2"]
_NAME = ["row", "at"]  # of the first line of a class
_BITS = ["bits", "more"]


def _digested(lines: DataFrame, table: Column, width: int) -> DataFrame:
    rows = with_tokens(lines, table, width)
    return rows.withColumns({"n": F.size("tokens"), "h": F.xxhash64("tokens"), "h2": F.xxhash64(F.lit(7), "tokens")})


def _enough(inter: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * inter >= percent * (a + b - inter)


def _fits(percent: int) -> Column:
    """Length, position and parity filters for x = (n, pos, bits) and its earlier candidate (n0, pos0, bits0)."""
    n, n0 = F.col("n"), F.col("n0")
    reach = F.least("pos", "pos0") + 1 + F.least(n - F.col("pos"), n0 - F.col("pos0")) - 1
    # Bits differ at most as often as the sets do.
    apart = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(c + "0"))) for c in _BITS)
    sizes = 100 * F.least(n, n0) >= percent * F.greatest(n, n0)
    return sizes & _enough(reach, n, n0, percent) & _enough((n + n0 - apart) / 2, n, n0, percent)


def _parity(word: int) -> Column:
    """64 bits: the parity of the tokens per bit, of those tokens that belong to the word."""
    return F.expr(f"aggregate(tokens, 0L, (a, x) -> if((x & 64) = {64 * word}, a ^ shiftleft(1L, cast(x & 63 as int)), a))")


def _bands(low: Column, high: Column, ratio: float) -> Column:
    """The size bands from one size to another; a band's sizes differ by the ratio at most."""
    band = lambda n: F.floor(F.log(n) / math.log(ratio)).cast("int")
    return F.sequence(band(low), band(high))


def perhaps_wanted(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """``lines`` without those that a bitmap of ``FILTER_BITS`` hashed keys rules out: most others need not be shuffled."""
    word = F.shiftright(F.pmod("lk", F.lit(FILTER_BITS)), 6).alias("word")
    bit = F.expr("shiftleft(1L, cast(lk & 63 as int))")
    bitmap = keys.groupBy(word).agg(F.bit_or(bit).alias("bits"))  # at most FILTER_BITS / 64 rows, whatever the corpus
    found = lines.withColumn("word", word).join(F.broadcast(bitmap), "word")
    return found.where(F.col("bits").bitwiseAND(bit) != 0).drop("word", "bits")


def mark_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Written row, doc_id, key, at, removed: one row per line."""
    counts = slot_counts(df, text)
    table = rarity_table(counts)
    hot_class = _rarity_class(4 * sum(counts) / SLOTS + 4096) << _HASH_BITS
    lines = _digested(text_lines(df, doc_id, text).withColumn("lk", F.xxhash64("line")), table, width)
    lines = lines.withColumn("prefix", F.slice("tokens", 1, F.greatest(prefix_length(F.col("n"), percent), F.lit(0))))
    lines = written(lines.select("row", "doc_id", "key", "at", "lk", *_CLASS, "prefix"), "lines")

    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "at", "lk")
    classes = written(lines.where("n > 0").groupBy(*_CLASS).agg(F.min(first).alias("first")), "line-classes")
    free_shuffles(classes)

    # Half the digest travels with the postings; classes that share it meet again below and are told apart there.
    postings = lines.where("n > 0").select(F.posexplode("prefix").alias("pos", "token"), "n", "h")
    by = Window.partitionBy("token").orderBy("h")
    other = lambda f: f("h").over(by).isNotNull() & (f("h").over(by) != F.col("h"))
    cold = postings.where(F.col("token") < hot_class).withColumn("shared", other(F.lag) | other(F.lead)).where("shared").drop("shared")
    with_copies = written(cold.union(postings.where(F.col("token") >= hot_class)).distinct(), "line-shared")
    # From here on lines are only told which go: the wide table is read no more.
    slim = written(lines.drop("prefix", "lk"), "line-places")
    forget(lines, shuffles=True)

    enough = with_copies.groupBy("n", "h").agg(F.count("*").alias("shared")).where(F.col("shared") >= need(F.col("n"), percent))
    wanted = written(classes.join(enough.drop("shared"), ["n", "h"], "left_semi").select(*_CLASS, "first", "first.lk"), "line-wanted")
    again = text_lines(df, doc_id, text).select("line", F.xxhash64("line").alias("lk"))
    found = perhaps_wanted(again, wanted).join(wanted.withColumnsRenamed({c: c + "0" for c in _CLASS}).hint("shuffle_hash"), "lk").distinct()
    made = _digested(found, table, width).withColumns({c: _parity(i) for i, c in enumerate(_BITS)})
    made = written(made.select(*_CLASS, *[c + "0" for c in _CLASS], "first.no_id", "first.doc_id", "first.row", "first.at", *_BITS, "tokens"), "line-sets")
    forget(wanted, shuffles=True)
    # Another line may have the key of a wanted one.  Compared once written: before, Spark would make the tokens anew for this filter.
    sets = made.where(" and ".join(f"{c} = {c}0" for c in _CLASS))

    place = F.struct("no_id", "doc_id", *_NAME).alias("first")
    named = sets.select("n", "h", place, *_BITS)
    shared = written(with_copies.join(named, ["n", "h"]).select("token", "pos", "n", "first", *_BITS), "line-postings")
    forget(with_copies, shuffles=True)

    def candidates(later: DataFrame, earlier: DataFrame, ratio: float) -> DataFrame:
        """Classes with earlier ones of the same token and near sizes that the filters leave, and how many tokens they meet at."""
        least = percent / 100 - 0.01
        later = later.withColumn("band", F.element_at(_bands(F.col("n"), F.col("n"), ratio), 1))
        zero = [F.col(c).alias(c + "0") for c in ("n", "pos", "first", *_BITS)]
        near = earlier.select("token", *zero, F.explode(_bands(least * F.col("n"), F.col("n") / least, ratio)).alias("band"))
        pairs = later.join(near, ["token", "band"]).where((F.col("first0") < F.col("first")) & _fits(percent))
        names = [F.col(f"first{o}.{c}").alias(c + o) for o in ("", "0") for c in _NAME]
        return pairs.groupBy(*names, "n", "n0").agg(F.count("*").alias("met"))

    def matched(pairs: DataFrame) -> DataFrame:
        """Written names of the classes of candidate pairs that an earlier class is similar to."""
        pairs = written(pairs.drop("met"), "line-pairs")
        free_shuffles(pairs)
        later = sets.select(*_NAME, "tokens")
        both = pairs.join(later, _NAME).join(later.toDF(*[c + "0" for c in later.columns]), [c + "0" for c in _NAME])
        same = _enough(F.size(F.array_intersect("tokens", "tokens0")), F.col("n"), F.col("n0"), percent)
        gone = written(both.where(same).select(*_NAME).distinct(), "line-gone")
        forget(pairs, shuffles=True)
        return gone

    narrow = 1 / (percent / 100 - 0.01)
    band = F.element_at(_bands(F.col("n"), F.col("n"), narrow), 1).alias("band")
    leaders = shared.groupBy("token", band).agg(F.min(F.struct("first", "n", "pos", *_BITS)).alias("p")).select("token", "p.*")
    gone = matched(candidates(shared, leaders, narrow))
    left = shared.withColumns({c: F.col("first")[c] for c in _NAME}).join(gone, _NAME, "left_anti").select(*shared.columns)
    # Wide bands: an earlier class is sent to fewer of them.
    pairs = candidates(left, shared, 2.0).where(F.col("met") >= pair_need(F.col("n"), F.col("n0")))
    later_gone = matched(pairs)
    forget(shared, made, shuffles=True)

    gone = gone.union(later_gone).withColumn("gone", F.lit(True)).withColumnsRenamed({c: c + "0" for c in _NAME})
    verdict = classes.select(*_CLASS, F.col("first.row").alias("row0"), F.col("first.at").alias("at0"))
    marked = slim.join(verdict.join(gone, ["row0", "at0"], "left"), _CLASS, "left")
    removed = F.col("row0").isNotNull() & ((F.col("row") != F.col("row0")) | (F.col("at") != F.col("at0")) | F.col("gone").isNotNull())
    return written(marked.select("row", "doc_id", "key", "at", removed.alias("removed")), "line-marks")


def removals(marked: DataFrame) -> DataFrame:
    """row, doc_id, key, n_lines, n_removed, removed (line numbers in order): one row per document."""
    gone = F.array_sort(F.collect_list(F.when(F.col("removed"), F.col("at"))))
    return marked.groupBy("row", "doc_id", "key").agg(
        F.count("*").alias("n_lines"), F.sum(F.col("removed").cast("long")).alias("n_removed"), gone.alias("removed")
    )


def dedup_lines(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """doc_id and text without the lines that go; one row per document."""
    gone = removals(mark_lines(df, doc_id, text, **how))
    # Repeated rows have one key: the k-th of them takes the k-th list.
    gone = gone.withColumn("k", F.row_number().over(Window.partitionBy("key").orderBy("row"))).select("key", "k", "removed")
    docs = df.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("text"), F.xxhash64(F.col(f"`{doc_id}`"), text_of(text)).alias("key"))
    docs = docs.withColumn("k", F.row_number().over(Window.partitionBy("key").orderBy("doc_id")))
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("removed", i))
    return docs.join(gone, ["key", "k"]).select("doc_id", F.array_join(kept, "\n").alias("text"))
