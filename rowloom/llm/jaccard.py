"""Jaccard join on word shingles: size-banded tiles with hashed bitmap signatures.

Nodes are the distinct shingle sets, named by (size, 64-bit digest); copies share a node.

1. Every task counts shingles into 2^16 hashed slots; the summed table orders shingles by
   rarity, so passages that many documents share come last.
2. A set of n shingles sends its rarest ones as postings.  Sets that link share at least
   ``need(n)`` of them, so a set with fewer shared postings can link with nothing.
3. Texts of the sets that are left are fetched once, past a bitmap of their keys that keeps most others out of the shuffle; each gives a parity bitmap of at least two bits per shingle
   and its sorted shingles.
4. In ``TURNS`` rounds, every set meets the leaders drawn by hash from its (shingle, size
   band) and the bands beside it, with ``LEADERS`` draws: linear in the group.  The one with the
   nearest bitmap is compared exactly.  What links becomes components, and the next round
   looks only at shingles whose sets lie in more than one component.
5. Pairs that share a token of at most ``FEW`` sets are made at once, and each is compared by bit count.
   Bands of other tokens that are still open are cut into tiles of at most about ``TILE`` sets a side, and
   sets of different components are compared tile by tile.  A tile where more pairs pass
   the bit count than it has rows gives a spanning forest of them, nearest first, so a tile
   never gives more rows than it gets.  What links is merged; only tokens of such tiles are
   looked at once more, for all pairs that still lie in different components.

Comparing means: the bit count of the xor of two bitmaps bounds the overlap from above;
pairs that pass get an exact intersection of sorted arrays.  Step 5 looks at every pair
that the rounds left open, so the components are those of the full link graph, without the
pairs inside a component being made.  A hot shingle is spread over tasks by the size of
its bands, groups of copies are one node, and tables read twice are written.

Shingles are 64-bit hashes: two different shingles of one pair of documents fall together
with a probability of about 10^-13.

Defined cases: null text and text without a word have an empty set and link with nothing;
fewer than ``WORDS`` words make one shingle; repeated rows and rows with a null id are
rows of their own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from rowloom.llm.common import text_of
from rowloom.llm.graph import components
from rowloom.session import forget, free_shuffles, written

WORDS = 4
PERCENT = 85
SLOTS = 1 << 16
BITS = 1024
TILE = 256
LEADERS = 4
TURNS = 3
FILTER_BITS = 1 << 24
FEW = 8
_PAIRS = 100_000  # pairs that a task looks at in one go
_PAIR_BYTES = 16_000_000
_K1, _K2, _K3 = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _K2
    h = (h ^ (h >> np.uint64(27))) * _K3
    return h ^ (h >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    n = len(found)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    width = min(words, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = _mixed(out * _K1 + h[k : n - width + 1 + k])
    return np.unique(out)


def set_digest(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def bitmap(s: np.ndarray) -> bytes:
    """Parity of the shingles per bit; at least two bits per shingle, in a power of two."""
    width = BITS
    while width < 2 * len(s):
        width *= 2
    at = ((s >> np.uint64(20)) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=width) & 1).astype(np.uint8)).tobytes()


def folded(cells: Sequence[bytes], width: int) -> np.ndarray:
    """Bitmaps as 64-bit words of one width in bytes: wider ones are folded, which keeps parity."""
    out = np.empty((len(cells), width // 8), np.uint64)
    sizes = np.array([len(c) for c in cells])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        stacked = np.frombuffer(b"".join([cells[i] for i in at]), np.uint64).reshape(len(at), size // width, width // 8)
        out[at] = np.bitwise_xor.reduce(stacked, axis=1)
    return out


def links(inter: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * inter >= percent * (a + b - inter)


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - (percent * n + 99) // 100 + 1 + n // 20)


def need(n: Column, percent: int) -> Column:
    """Postings that a set of n shingles shares, at least, with any set it links with."""
    return 1 + F.floor(F.floor(percent * n / 100) / 20)


def row_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(f"`{doc_id}`"), text_of(text))


def profile(df: DataFrame, doc_id: str, text: str, words: int) -> tuple[DataFrame, np.ndarray]:
    """Written rows (doc_id, key, n, d), and the number of sets per slot."""
    source = df.select(F.col(f"`{doc_id}`").alias("doc_id"), row_key(doc_id, text).alias("key"), text_of(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, id_type = np.zeros(SLOTS, np.int64), None
        names = ["doc_id", "key", "n", "d", "slots"]
        for batch in batches:
            n, d = [], []
            id_type = batch.column(0).type
            for t in batch.column(2):
                s = shingles(t.as_py(), words)
                n.append(len(s))
                d.append(set_digest(s))
                slots += np.bincount((s >> np.uint64(48)).astype(np.int64), minlength=SLOTS)
            out = [batch.column(0), batch.column(1), pa.array(n, pa.int32()), pa.array(d, pa.int64()), pa.nulls(len(n), pa.binary())]
            yield pa.RecordBatch.from_arrays(out, names=names)
        if id_type is not None:
            at = np.flatnonzero(slots)
            packed = np.concatenate((at, slots[at])).tobytes()
            out = [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.array([-1], pa.int32()), pa.nulls(1, pa.int64()), pa.array([packed])]
            yield pa.RecordBatch.from_arrays(out, names=names)

    both = written(source.mapInArrow(run, f"doc_id {kind}, key long, n int, d long, slots binary"), "shingle-sets")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                at, counts = np.frombuffer(cell.as_py(), np.int64).reshape(2, -1)
                total[at] += counts
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "sets"])

    counts = np.zeros(SLOTS, np.int64)
    sums = both.where("n < 0").select("slots").mapInArrow(unpack, "slot long, sets long").groupBy("slot").agg(F.sum("sets").alias("sets"))
    for r in sums.collect():  # at most SLOTS rows
        counts[r.slot] = r.sets
    return both.where("n >= 0").drop("slots"), counts


def postings(df: DataFrame, text: str, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """token, hot, n, d: the rarest shingles of each set, once per task."""
    rarity = np.floor(4 * np.log2(1 + counts)).astype(np.uint64) << np.uint64(56)
    hot_slot = counts > 4 * counts.mean() + 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            tokens, hot, n, d = [], [], [], []

            def out():
                lengths = [len(t) for t in tokens]
                cells = [
                    pa.array(np.concatenate(tokens).view(np.int64)),
                    pa.array(np.concatenate(hot)),
                    pa.array(np.repeat(np.array(n, np.int32), lengths)),
                    pa.array(np.repeat(np.array(d, np.int64), lengths)),
                ]
                return pa.RecordBatch.from_arrays(cells, names=["token", "hot", "n", "d"])

            waiting = 0
            for t in batch.column(0):
                s = shingles(t.as_py(), words)
                key = (len(s), set_digest(s))
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                size = prefix_length(len(s), percent)
                slot = (s >> np.uint64(48)).astype(np.int64)
                order = rarity[slot] | (s >> np.uint64(8))
                first = np.argpartition(order, size - 1)[:size]
                tokens.append(order[first])
                hot.append(hot_slot[slot[first]])
                n.append(key[0])
                d.append(key[1])
                waiting += size
                if waiting > 100_000:
                    yield out()
                    tokens, hot, n, d, waiting = [], [], [], [], 0
            if tokens:
                yield out()

    return df.select(text_of(text).alias("text")).mapInArrow(run, "token long, hot boolean, n int, d long")


def shared_postings(all_postings: DataFrame, percent: int) -> DataFrame:
    """Written token, band, n, d of the sets that share enough postings to link."""
    # Cold and hot ones come from one pass over the texts: a hot token counts as shared, each of its sets is a key.
    apart = F.when(F.col("hot"), F.xxhash64("n", "d"))
    by = Window.partitionBy("token", "apart").orderBy("n", "d")

    def other(f) -> Column:
        return f("d").over(by).isNotNull() & ((f("d").over(by) != F.col("d")) | (f("n").over(by) != F.col("n")))

    marked = all_postings.withColumn("apart", apart).withColumn("shared", F.col("hot") | other(F.lag) | other(F.lead))
    # Distinct by a key that has the window's in it: no second shuffle.
    shared = marked.where("shared").select("token", "apart", "n", "d").distinct().drop("apart")
    shared = written(shared, "shared-postings")
    enough = shared.groupBy("n", "d").agg(F.count("*").alias("shared")).where(F.col("shared") >= need(F.col("n"), percent))
    band = F.floor(F.log("n") / math.log(1 / (percent / 100 - 0.01))).cast("int").alias("band")
    enough_ = written(shared.join(enough, ["n", "d"], "left_semi").select("token", band, "n", "d"), "postings")
    forget(shared, shuffles=True)
    return enough_


def perhaps_wanted(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``texts`` without those that a bitmap of ``FILTER_BITS`` hashed keys rules out: most others need not be shuffled."""
    slot = F.pmod("key", F.lit(FILTER_BITS))
    words = keys.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(key, {FILTER_BITS}) & 63 as int))")).alias("bits"))
    found = words.toArrow()  # at most FILTER_BITS / 64 rows, whatever the corpus
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.mod(batch.column(0).to_numpy(), FILTER_BITS)
            yield batch.filter(pa.array((bits[slots >> 6] >> (slots & 63)) & 1 == 1))

    return texts.mapInArrow(run, "key long, text string")


def set_table(df: DataFrame, rows: DataFrame, wanted: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """Written n, d, bits, items of the wanted sets, made from one text each."""
    first = rows.join(wanted, ["n", "d"], "left_semi").groupBy("n", "d").agg(F.min("key").alias("key"))
    first = written(first, "set-keys")
    texts = df.select(row_key(doc_id, text).alias("key"), text_of(text).alias("text"))
    found = perhaps_wanted(texts, first).join(first.hint("shuffle_hash"), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                piece = batch.slice(at, 200).to_pydict()
                out = []
                for t, n, d in zip(piece["text"], piece["n"], piece["d"]):
                    s = shingles(t, words)
                    if (n, d) not in seen and (len(s), set_digest(s)) == (n, d):
                        seen.add((n, d))
                        out.append((n, d, bitmap(s), s.tobytes()))
                cells = list(zip(*out)) or [[], [], [], []]
                types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=["n", "d", "bits", "items"])

    sets = found.select("text", "n", "d").mapInArrow(run, "n int, d long, bits binary, items binary")
    made = written(sets.withColumn("id", F.monotonically_increasing_id()), "sets")
    forget(first, shuffles=True)
    return made


def _distance(bits: np.ndarray, bits2: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bits ^ bits2).sum(axis=-1, dtype=np.int64)


def _bound_passes(n: np.ndarray, n2: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """Can the overlap, at most half of what the bit count leaves, reach the threshold?"""
    most = (n + n2 - apart) // 2
    return 100 * most >= percent * (n + n2 - most)


def _with_sets(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """``pairs`` of id, id2 with columns of both sets, those of the second one with a 2 behind."""
    right = sets.select(F.col("id").alias("id2"), *[F.col(c).alias(c + "2") for c in columns])
    return pairs.join(sets.select("id", *columns), "id").join(right, "id2").select("id", "id2", *columns, *[c + "2" for c in columns])


def exact(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sorted arrays intersect enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                piece = batch.slice(at, 200)
                keep = []
                for a, b in zip(piece.column(2), piece.column(3)):
                    x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                    keep.append(links(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent))
                yield piece.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return _with_sets(pairs, sets, "items").mapInArrow(run, "id long, id2 long")


def passing(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """id, id2, apart: the pairs that the bit counts leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                n, n2 = (b.column(i).to_numpy().astype(np.int64) for i in (2, 4))
                x, y = b.column(3).to_pylist(), b.column(5).to_pylist()
                widths, apart = np.array([min(len(p), len(q)) for p, q in zip(x, y)]), np.zeros(len(x), np.int64)
                for width in np.unique(widths):
                    at = np.flatnonzero(widths == width)
                    apart[at] = _distance(folded([x[i] for i in at], width), folded([y[i] for i in at], width))
                keep = pa.array(_bound_passes(n, n2, apart, percent))
                found = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(apart)], names=["id", "id2", "apart"])
                yield found.filter(keep)

    return _with_sets(pairs, sets, "n", "bits").mapInArrow(run, "id long, id2 long, apart long")


def closest(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """For each id the id2 whose bitmap is nearest, of those that the bit counts leave."""
    best = passing(pairs, sets, percent).groupBy("id").agg(F.min(F.struct("apart", "id2")).alias("best"))
    return best.select("id", F.col("best.id2").alias("id2"))


def _rooted(shared: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``shared`` with the component of each set, without tokens of one component only."""
    if roots is None:
        return shared.withColumn("root", F.col("id"))
    known = shared.join(roots.withColumnRenamed("v", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    known = written(known, "rooted-postings")
    mixed = known.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("token")
    open_ = written(known.join(mixed, "token", "left_semi"), "open-postings")
    forget(known, shuffles=True)
    return open_


def leaders_of(open_: DataFrame, turn: int) -> DataFrame:
    """Written token, band, n2, id2, root2: the leader of each (token, band), for that band and those beside it.

    A leader is the set of least hash; tokens draw with one of ``LEADERS`` hashes, new in
    every turn, so a set with many shared tokens meets that many leaders of its group.
    """
    draw = F.xxhash64(F.lit(turn), F.pmod("token", F.lit(LEADERS)), "id")
    first = open_.groupBy("token", "band").agg(F.min(F.struct(draw.alias("draw"), "n", "id", "root")).alias("p"))
    first = first.select(
        "token",
        F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"),
        F.col("p.n").alias("n2"),
        F.col("p.id").alias("id2"),
        F.col("p.root").alias("root2"),
    )
    return written(first, "leaders")


def leader_pairs(open_: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """Every set with the leaders of its (token, band) and of the bands beside it, unless linked already."""
    pairs = open_.join(leaders, ["token", "band"]).where("root <> root2").where(_sizes_fit(percent))
    return pairs.select("id", "id2").distinct()


def _sizes_fit(percent: int) -> Column:
    return 100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")


def few_pairs(open_: DataFrame, percent: int) -> DataFrame:
    """id, id2 of different components that share one of these tokens, each of which has at most ``FEW`` sets."""
    other = open_.select("token", F.col("n").alias("n2"), F.col("id").alias("id2"), F.col("root").alias("root2"))
    met = open_.join(other, "token").where("id < id2 and root <> root2").where(_sizes_fit(percent))
    return met.select("id", "id2").distinct()


def _forest(i: np.ndarray, j: np.ndarray, weight: np.ndarray, nodes: int) -> np.ndarray:
    """Places of the pairs that make a spanning forest of least weight: fewer than there are nodes."""
    label, taken, left = np.arange(nodes), [], np.lexsort((j, i, weight))
    while len(left):
        a, b = label[i[left]], label[j[left]]
        left, a, b = left[a != b], a[a != b], b[a != b]
        # The first pair, in one order for all, of each tree.
        trees, first = np.unique(np.column_stack((a, b)).ravel(), return_index=True)
        first //= 2
        taken.append(left[np.unique(first)])
        to = np.arange(nodes)
        to[trees] = np.where(a[first] == trees, b[first], a[first])
        # Two trees that chose the same pair point at each other: the smaller one is the root.
        both = (to[to] == np.arange(nodes)) & (np.arange(nodes) < to)
        to[both] = np.flatnonzero(both)
        while not np.array_equal(to[to], to):
            to = to[to]
        label = to[label]
    return np.concatenate(taken) if taken else left


def _pairs_of_tiles(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of the same tile, many tiles at once, about ``_PAIRS`` pairs or one tile at a time."""
    sizes = ends - starts
    many = sizes >= 2
    starts, ends, sizes = starts[many], ends[many], sizes[many]
    part = np.cumsum(sizes * (sizes - 1) // 2) // _PAIRS
    for k in np.unique(part):
        at = part == k
        before = np.cumsum(sizes[at]) - sizes[at]
        rows = np.repeat(starts[at] - before, sizes[at]) + np.arange(sizes[at].sum())
        later = np.repeat(ends[at], sizes[at]) - rows - 1
        i = np.repeat(rows, later)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)


def _apart(bits: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bit counts of the xor of pairs of cells, the wider one folded."""
    size = np.fromiter(map(len, bits), np.int64, len(bits))
    width, apart = np.minimum(size[i], size[j]), np.zeros(len(i), np.int64)
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        used, place = np.unique(np.concatenate((i[at], j[at])), return_inverse=True)
        cells, x, y = folded(bits[used], int(w)), place[: len(at)], place[len(at) :]
        step = max(1, _PAIR_BYTES // int(w))
        for lo in range(0, len(at), step):
            apart[at[lo : lo + step]] = _distance(cells[x[lo : lo + step]], cells[y[lo : lo + step]])
    return apart


def tile_pairs(open_: DataFrame, sets: DataFrame, percent: int, tile: int = TILE, whole: bool = True) -> DataFrame:
    """id, id2, token: pairs of different components that share a token and pass the bit count.

    Unless ``whole``, a tile with more such pairs than rows gives those of a spanning
    forest, nearest first, and a row with its token in place of the others: no tile gives
    more rows than it gets.
    """
    rows = open_
    cuts = rows.groupBy("token", "band").agg(F.ceil(F.count("*") / tile).cast("int").alias("cuts"))
    cuts = written(cuts, "tile-cuts")
    for name, shift in (("cuts", 0), ("below", 1), ("above", -1)):
        rows = rows.join(cuts.select("token", (F.col("band") + shift).alias("band"), F.col("cuts").alias(name)), ["token", "band"], "left")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("cuts")).cast("int"))

    def spread(other: Column, lower: Column, band2: int, left: bool) -> Column:
        """Tiles against parts lower .. other - 1 of a band; empty where there are none."""
        part = F.when(other > lower, F.sequence(lower, other - 1)).otherwise(F.array().cast("array<int>"))
        mine, theirs = F.col("band"), F.col("band") + band2
        return F.transform(
            part,
            lambda k: F.struct(
                (mine if left else theirs).alias("b1"),
                (F.col("salt") if left else k).alias("s1"),
                (theirs if left else mine).alias("b2"),
                (k if left else F.col("salt")).alias("s2"),
                F.lit(left).alias("left"),
            ),
        )

    none = F.lit(0)
    tiles = F.concat(
        spread(F.col("cuts"), F.col("salt"), 0, True),
        spread(F.coalesce("above", none), none, 1, True),
        spread(F.col("salt"), none, 0, False),
        spread(F.coalesce("below", none), none, -1, False),
    )
    rows = rows.join(sets.select("id", "bits"), "id")
    rows = rows.select("token", F.explode(tiles).alias("t"), "n", "id", "root", "bits")
    rows = rows.select("token", "t.*", "n", "id", "root", "bits")
    key = ["token", "b1", "s1", "b2", "s2"]
    ordered = rows.repartition(*key).sortWithinPartitions(*key)

    def compare(t: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        """id, id2, token, is it a token's mark?"""
        n, alone = t["n"], (t["b1"] == t["b2"]) & (t["s1"] == t["s2"])
        for i, j in _pairs_of_tiles(starts, ends):
            ok = (t["root"][i] != t["root"][j]) & (alone[i] | (t["left"][i] != t["left"][j]))
            ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            i, j = i[ok], j[ok]
            apart = _apart(t["bits"], i, j)
            ok = _bound_passes(n[i], n[j], apart, percent)
            i, j, apart = i[ok], j[ok], apart[ok]
            dense = np.empty(0, np.int64)
            if not whole and len(i):
                of = np.searchsorted(starts, i, "right") - 1
                full = np.bincount(of, minlength=len(starts)) > ends - starts
                dense, some = starts[full], np.flatnonzero(full[of])
                if len(some):
                    used, place = np.unique(np.concatenate((i[some], j[some])), return_inverse=True)
                    x, y = place[: len(some)], place[len(some) :]
                    keep = ~full[of]
                    keep[some[_forest(x, y, apart[some] / (n[i[some]] + n[j[some]]), len(used))]] = True
                    i, j = i[keep], j[keep]
            ids, marks = (t["id"][i], t["id"][j]), np.zeros(len(dense), np.int64)
            yield np.array([np.minimum(*ids), np.maximum(*ids), np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)])
            yield np.array([marks, marks, t["token"][dense], marks + 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[str, np.ndarray] | None = None

        def arrays(b: pa.RecordBatch) -> dict[str, np.ndarray]:
            t = {c: b.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(b.schema.names) if c != "bits"}
            bits = np.empty(b.num_rows, object)
            bits[:] = b.column(b.schema.names.index("bits")).to_pylist()
            return t | {"n": t["n"].astype(np.int64), "bits": bits}

        def result(found: Iterator[np.ndarray]) -> pa.RecordBatch:
            f = np.concatenate([np.empty((4, 0), np.int64), *found], axis=1)
            f = np.unique(f, axis=1)  # a pair meets once per token that both have
            cells = [pa.array(f[0]), pa.array(f[1]), pa.array(f[2], mask=f[3] == 0)]
            return pa.RecordBatch.from_arrays(cells, names=["id", "id2", "token"])

        for b in batches:
            if not b.num_rows:
                continue
            t = arrays(b)
            if rest is not None:
                t = {k: np.concatenate((rest[k], t[k])) for k in t}
            change = np.zeros(len(t["n"]), bool)
            change[0] = True
            for k in key:
                change[1:] |= t[k][1:] != t[k][:-1]
            starts = np.flatnonzero(change)
            rest = {k: v[starts[-1] :] for k, v in t.items()}  # one tile, bounded by its two sides
            yield result(compare(t, starts[:-1], starts[1:]))
        if rest is not None:
            yield result(compare(rest, np.array([0]), np.array([len(rest["n"])])))

    return ordered.mapInArrow(run, "id long, id2 long, token long")


def similar_sets(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, tile: int = TILE
) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, n, d), and n, d, root of the linked sets."""
    rows, counts = profile(df, doc_id, text, words)
    shared = shared_postings(postings(df, text, counts, words, percent), percent)
    sets = set_table(df, rows, shared.select("n", "d").distinct(), doc_id, text, words)
    by_digest = shared
    shared = written(by_digest.join(sets.select("n", "d", "id"), ["n", "d"]).select("token", "band", "n", "id"), "set-postings")
    forget(by_digest, shuffles=True)
    edges = F.col("id").alias("u"), F.col("id2").alias("v")
    found, roots = None, None
    for turn in range(TURNS):
        open_ = _rooted(shared, roots)
        leaders = leaders_of(open_, turn)
        nearest = written(closest(leader_pairs(open_, leaders, percent), sets, percent), "nearest")
        forget(leaders, *([] if roots is None else [open_]), shuffles=True)
        near = written(exact(nearest, sets, percent), "links")
        forget(nearest, shuffles=True)
        found = near if found is None else found.union(near)
        roots = components(found.select(*edges))
    both = _rooted(shared, roots)
    crowded = written(both.groupBy("token").count().where(F.col("count") > FEW).select("token"), "crowded-tokens")
    few = written(passing(few_pairs(both.join(crowded, "token", "left_anti"), percent), sets, percent).select("id", "id2"), "few-pairs")
    open_ = written(both.join(crowded, "token", "left_semi"), "crowded-postings")
    forget(both, crowded, shuffles=True)
    for whole in (False, True):
        met = written(tile_pairs(open_, sets, percent, tile, whole), "tile-pairs")
        free_shuffles(met)
        pairs = met.where("token is null").select("id", "id2")
        pairs = (pairs if whole else pairs.union(few)).distinct()
        near = written(exact(pairs, sets, percent), "links")
        found = found.union(near)
        if not near.isEmpty():
            roots = components(found.select(*edges))
        dense = met.where("token is not null").select("token").distinct()
        if whole or dense.isEmpty():
            break
        left = written(open_.drop("root").join(dense, "token", "left_semi"), "dense-postings")
        forget(open_, met, shuffles=True)
        open_ = _rooted(left, roots)
        forget(left)
    ids = written(sets.select("n", "d", F.col("id").alias("v")), "set-ids")
    forget(shared, open_, sets, met, few, shuffles=True)
    roots = roots.union(roots.select(F.col("root").alias("v"), "root").distinct())
    return rows, roots.join(ids, "v").select("n", "d", "root")


def components_of(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per row: doc_id, key, n_shingles, component_id."""
    rows, roots = similar_sets(df, doc_id, text, **how)
    group = F.when(F.col("root").isNull(), F.struct("n", "d")).otherwise(F.struct(F.lit(-1).alias("n"), F.col("root").alias("d")))
    rows = written(rows.join(roots, ["n", "d"], "left").withColumn("root", group), "rooted")
    least = written(rows.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least")), "least-ids")
    joined = rows.join(least, "root", "left")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "key", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), "root")


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``df`` with one row of each component left, the one of the least id."""
    found = components_of(df, doc_id, text, **how)
    first = found.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
    stay = first.select(F.col("first.key").alias("__key"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")
    keyed = df.select(row, row_key(doc_id, text).alias("__key"), text_of(text).rlike(r"[^\x20\x09-\x0D]").alias("__words"))
    one = Window.partitionBy("__key").orderBy(F.xxhash64("__row"))
    kept = keyed.where("__words").join(stay, "__key", "left_semi").withColumn("__place", F.row_number().over(one)).where("__place = 1")
    kept = kept.select("__row").union(keyed.where("not __words").select("__row"))
    return kept.select(*[F.col("__row")[c].alias(c) for c in df.columns])
