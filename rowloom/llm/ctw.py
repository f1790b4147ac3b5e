"""Language-model scores by context-tree weighting over bytes.

Every byte is eight binary decisions, each under the ``DEPTH`` bytes before it.  For each
depth and decision a Krichevsky-Trofimov estimate is kept, and the estimates of all
depths are mixed with the weights of the context tree: a node's weighted probability is
half its own estimate and half the product over its children.  A text is scored with the
tree of the training texts as it stands: along the path of contexts, the probability is
w * estimate + (1 - w) * (probability one depth further), with w from the same recursion.
Before a text stands the byte 255, which UTF-8 never uses, and after it, as end of text.

Nothing that grows with the corpus is held in one place:

1. Each scan task packs its texts into chunks of at most ``CHUNK`` bytes, written
   compressed, each with its distinct words and byte contexts and how often training
   texts have them.
2. Words are summed by word, contexts by context, and each chunk gets back the totals of
   its own words as packed arrays.
3. Contexts that end in the same two bytes form one subtree, of at most 256^3 leaves
   whatever the corpus, and are worked out together: bottom-up for the weights, top-down for the probabilities.
   Depths 0 and 1 are tables of at most 256 x 255 nodes.
4. Each chunk is unpacked and scored with its own words and contexts.

Words are met by 64-bit hash: the chance that a given unknown word meets a known one is
vocabulary / 2^64.

Defined cases: a null text is empty: one end token, an end-of-text byte; rows with a null id are
training rows when crc32 of the empty text says so; repeated rows count as often as they
come; without training texts every decision has probability 1/2; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from rowloom.llm.common import text_of
from rowloom.session import written

DEPTH = 4
DEEP = range(2, DEPTH + 1)
CHUNK = 32 << 20
_FLUSH = 2 << 20  # keys that wait before they are summed
TEXTS, WORDS, CONTEXTS, TOTALS = range(4)
_SCHEMA = "chunk long, kind int, key long, n long, payload binary"
_NAMES = ["chunk", "kind", "key", "n", "payload"]
_LN2, _LN10 = np.log(2.0), np.log(10.0)


def word_hashes(raw: bytes) -> np.ndarray:
    found = raw.split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)).view(np.int64)


def contexts(raw: bytes) -> np.ndarray:
    """One key per byte and for the end: four bytes before it, oldest first, and itself."""
    x = np.frombuffer(b"\xff" * DEPTH + raw + b"\xff", np.uint8).astype(np.int64)
    out = np.zeros(len(raw) + 1, np.int64)
    for k in range(DEPTH + 1):
        out = (out << 8) | x[k : len(raw) + 1 + k]
    return out


def lowered(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only


class Counts:
    """Distinct keys with sums, compacted as they come."""

    def __init__(self):
        self.keys, self.sums, self.waiting = [], [], 0

    def add(self, keys: np.ndarray, n: int) -> None:
        self.keys.append(keys)
        self.sums.append(np.full(len(keys), n, np.int64))
        self.waiting += len(keys)
        if self.waiting > _FLUSH:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        keys, sums = summed(np.concatenate(self.keys or [np.empty(0, np.int64)]), np.concatenate(self.sums or [np.empty(0, np.int64)]))
        self.keys, self.sums, self.waiting = [keys], [sums], 0
        return keys, sums


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first)


def _rows(chunk: int, kind: int, keys=None, n=None, payload: bytes | None = None) -> pa.RecordBatch:
    size = 1 if keys is None else len(keys)
    cells = [
        pa.array(np.full(size, chunk, np.int64)),
        pa.array(np.full(size, kind, np.int32)),
        pa.nulls(size, pa.int64()) if keys is None else pa.array(keys),
        pa.nulls(size, pa.int64()) if n is None else pa.array(n),
        pa.nulls(size, pa.binary()) if payload is None else pa.array([payload], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(cells, names=_NAMES)


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def chunks(source: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """Written table of packed texts, and per chunk the words and contexts with training counts.

    ``source`` has doc_id, held_out, text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        words, ctx, size, trained = Counts(), Counts(), 0, 0

        def close():
            for kind, counts in ((WORDS, words), (CONTEXTS, ctx)):
                keys, n = counts.total()
                for at in range(0, len(keys), 100_000):
                    yield _rows(chunk, kind, keys[at : at + 100_000], n[at : at + 100_000])
            yield _rows(chunk, TOTALS, np.array([0]), np.array([trained]))

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                for held, t in zip(piece.column(1).to_pylist(), piece.column(2)):
                    raw = lowered(t.as_py())
                    size += len(raw)
                    trained += not held
                    words.add(word_hashes(raw), int(not held))
                    ctx.add(contexts(raw), int(not held))
                yield _rows(chunk, TEXTS, payload=_packed(piece))
                if size >= chunk_bytes:
                    yield from close()
                    chunk, words, ctx, size, trained = chunk + 1, Counts(), Counts(), 0, 0
        yield from close()

    return written(source.mapInArrow(run, _SCHEMA), "chunks")


def word_totals(table: DataFrame) -> DataFrame:
    """Written packed arrays (word, training count) per chunk, and the number of known words.

    A word has at most one row per chunk, so no word is hot.
    """
    rows = table.where(F.col("kind") == WORDS).select("chunk", "key", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
        if not parts:
            return
        chunk, key, n = (np.concatenate(c) for c in zip(*parts))
        known, which = np.unique(key, return_inverse=True)
        total = np.bincount(which, weights=n).astype(np.int64)
        yield _rows(-1, TOTALS, np.array([1]), np.array([int((total > 0).sum())]))
        order = np.argsort(chunk, kind="stable")
        chunk, pairs = chunk[order], np.stack((key, total[which]), axis=1)[order]
        for c, cut in zip(*_cuts(chunk)):
            yield _rows(int(c), WORDS, payload=pairs[cut].tobytes())

    return written(rows.repartition("key").mapInArrow(run, _SCHEMA), "word-totals")


def _cuts(ordered: np.ndarray) -> tuple[np.ndarray, list[slice]]:
    """Values of a sorted array and their places."""
    values, first = np.unique(ordered, return_index=True)
    ends = np.append(first[1:], len(ordered))
    return values, [slice(a, b) for a, b in zip(first, ends)]


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural logarithm of the gamma function for x > 0: Stirling's series, eight up."""
    rise = np.ones_like(x)
    for k in range(8):
        rise = rise * (x + k)
    y = x + 8
    r = 1 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(rise)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability of a sequence with these counts."""
    zeros, ones = zeros.astype(float), ones.astype(float)
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


def weigh(zeros, ones, below) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of nodes whose children's logs sum to ``below``, and the own share w."""
    own = log_estimate(zeros, ones)
    weighted = np.logaddexp(own, below) - _LN2
    return weighted, np.exp(own - _LN2 - weighted)


class Subtree:
    """Nodes of depth 2 and more of the contexts that end in the same two bytes."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        bits = np.arange(8)
        symbol = keys & 255
        self.bit = (symbol[:, None] >> (7 - bits)) & 1
        node = (1 << bits) | (symbol[:, None] >> (8 - bits))
        ids = {d: (((keys >> 8) & ((1 << (8 * d)) - 1))[:, None] << 8 | node).ravel() for d in DEEP}
        weight = np.repeat(n, 8).astype(float)
        one = self.bit.ravel()
        self.of, self.zeros, self.ones, self.share, self.first = {}, {}, {}, {}, {}
        for d in DEEP:
            names, first, self.of[d] = np.unique(ids[d], return_index=True, return_inverse=True)
            self.first[d] = first
            self.zeros[d] = np.bincount(self.of[d], weights=weight * (1 - one), minlength=len(names))
            self.ones[d] = np.bincount(self.of[d], weights=weight * one, minlength=len(names))
            if d == 2:
                self.node = names & 255
        weighted = log_estimate(self.zeros[DEPTH], self.ones[DEPTH])
        for d in DEEP[-2::-1]:
            parents = self.of[d][self.first[d + 1]]
            below = np.bincount(parents, weights=weighted, minlength=len(self.zeros[d]))
            weighted, self.share[d] = weigh(self.zeros[d], self.ones[d], below)
        self.weighted = weighted

    def estimate(self, d: int) -> np.ndarray:
        """Probability of each decision's bit at depth d alone."""
        z, o = self.zeros[d][self.of[d]], self.ones[d][self.of[d]]
        return (np.where(self.bit.ravel() == 1, o, z) + 0.5) / (z + o + 1)

    def mixed(self) -> np.ndarray:
        """Probability of each decision's bit from depth 2 on."""
        p = self.estimate(DEPTH)
        for d in DEEP[-2::-1]:
            w = self.share[d][self.of[d]]
            p = w * self.estimate(d) + (1 - w) * p
        return p.reshape(-1, 8)


def context_scores(table: DataFrame) -> DataFrame:
    """key, log10 probability of the last byte of each context that any text has."""
    counts = table.where(F.col("kind") == CONTEXTS).groupBy("key").agg(F.sum("n").alias("n"))
    counts = written(counts.withColumn("last", F.shiftright("key", 8).bitwiseAND(0xFFFF).cast("int")), "contexts")

    def upward(t: pa.Table) -> pa.Table:
        s = Subtree(t.column("key").to_numpy(), t.column("n").to_numpy())
        last = np.full(len(s.node), t.column("last")[0].as_py() & 255, np.int32)
        cells = [pa.array(last), pa.array(s.node.astype(np.int32)), pa.array(s.weighted), pa.array(s.zeros[2]), pa.array(s.ones[2])]
        return pa.Table.from_arrays(cells, names=["last", "node", "weighted", "zeros", "ones"])

    ends = counts.groupBy("last").applyInArrow(upward, "last int, node int, weighted double, zeros double, ones double")
    ends = ends.groupBy("last", "node").agg(*[F.sum(c).alias(c) for c in ("weighted", "zeros", "ones")])
    zeros, ones, below = np.zeros((256, 256)), np.zeros((256, 256)), np.zeros((256, 256))
    for r in ends.collect():  # at most 256 x 255 rows
        zeros[r.last, r.node], ones[r.last, r.node], below[r.last, r.node] = r.zeros, r.ones, r.weighted
    weighted, share1 = weigh(zeros, ones, below)
    _, share0 = weigh(zeros.sum(0), ones.sum(0), weighted.sum(0))
    # Per node and bit: own part of depths 0 and 1, and what is left for depth 2 on.
    total = lambda z, o: np.stack(((z + 0.5) / (z + o + 1), (o + 0.5) / (z + o + 1)))
    top = share0 * total(zeros.sum(0), ones.sum(0))
    own = top[:, None, :] + (1 - share0) * share1 * total(zeros, ones)
    rest = (1 - share0) * (1 - share1)

    def downward(t: pa.Table) -> pa.Table:
        keys = t.column("key").to_numpy()
        s = Subtree(keys, t.column("n").to_numpy())
        last = t.column("last")[0].as_py() & 255
        bits, symbol = np.arange(8), keys & 255
        node = (1 << bits) | (symbol[:, None] >> (8 - bits))
        p = own[s.bit, last, node] + rest[last, node] * s.mixed()
        return pa.Table.from_arrays([pa.array(keys), pa.array(np.log10(p).sum(1))], names=["key", "score"])

    return counts.groupBy("last").applyInArrow(downward, "key long, score double")


def context_totals(table: DataFrame) -> DataFrame:
    """Packed arrays (context, score) per chunk."""
    rows = table.where(F.col("kind") == CONTEXTS).select("key", "chunk").join(context_scores(table), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                chunk, key, score = (c.to_numpy() for c in b.columns)
                order = np.argsort(chunk, kind="stable")
                pairs = np.stack((key, score.view(np.int64)), axis=1)[order]
                for c, cut in zip(*_cuts(chunk[order])):
                    yield _rows(int(c), CONTEXTS, payload=pairs[cut].tobytes())

    return rows.select("chunk", "key", "score").mapInArrow(run, _SCHEMA)


def score_documents(df: DataFrame, held_out: Column, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte."""
    source = df.select(F.col(f"`{doc_id}`").alias("doc_id"), held_out.alias("held_out"), text_of(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    table = chunks(source, chunk_bytes)
    words = word_totals(table)
    sums = table.where(F.col("kind").isin(WORDS, TOTALS)).groupBy("kind").agg(F.sum("n").alias("n")).collect()
    sums = {r.kind: r.n for r in sums}
    ends = sums.get(TOTALS) or 0
    known = words.where(F.col("kind") == TOTALS).agg(F.sum("n")).first()[0] or 0
    tokens, vocabulary = (sums.get(WORDS) or 0) + ends, known + (ends > 0)
    whole = float(np.log10(tokens + 0.5 * (vocabulary + 1)))

    def run(t: pa.Table) -> pa.Table:
        kinds, payloads = t.column("kind").to_numpy(), t.column("payload")

        def pairs(of: int) -> tuple[np.ndarray, np.ndarray]:
            parts = [np.frombuffer(payloads[int(i)].as_py(), np.int64).reshape(-1, 2) for i in np.flatnonzero(kinds == of)]
            all_pairs = np.concatenate(parts) if parts else np.empty((0, 2), np.int64)
            all_pairs = all_pairs[np.argsort(all_pairs[:, 0])]
            return np.ascontiguousarray(all_pairs[:, 0]), np.ascontiguousarray(all_pairs[:, 1])

        word_keys, word_n = pairs(WORDS)
        word_score = np.log10(word_n + 0.5) - whole
        ctx_keys, ctx_score = pairs(CONTEXTS)
        ctx_score = ctx_score.view(np.float64)
        end_score = float(np.log10(ends + 0.5)) - whole
        out = []
        for i in np.flatnonzero(kinds == TEXTS):
            piece = pa.ipc.open_stream(payloads[int(i)].as_py()).read_all()
            found = []
            for t in piece.column("text"):
                raw = lowered(t.as_py())
                at = np.searchsorted(word_keys, word_hashes(raw))
                spots = np.searchsorted(ctx_keys, np.sort(contexts(raw)))
                score = float(ctx_score[spots].sum())
                found.append((
                    len(at) + 1, int((word_n[at] > 0).sum()) + (ends > 0), float(word_score[at].sum()) + end_score,
                    score, len(raw), -score * _LN10 / _LN2 / max(len(raw), 1),
                ))
            n, n_known, base, score, size, bits = (list(c) for c in zip(*found))
            cells = [
                piece.column("doc_id").combine_chunks(), piece.column("held_out").combine_chunks(), pa.array(n, pa.int64()), pa.array(n_known, pa.int64()),
                pa.array([tokens] * len(n), pa.int64()), pa.array(base), pa.array(score), pa.array(size, pa.int64()), pa.array(bits),
            ]
            out.append(pa.Table.from_arrays(cells, names=names))
        return pa.concat_tables(out) if out else empty

    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    names = [f.split()[0] for f in schema.split(", ")]
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    empty = to_arrow_schema(_parse_datatype_string(schema)).empty_table()
    parts = table.where(F.col("kind") == TEXTS).union(words.where(F.col("kind") == WORDS)).union(context_totals(table))
    return parts.select("chunk", "kind", "payload").groupBy("chunk").applyInArrow(run, schema)
