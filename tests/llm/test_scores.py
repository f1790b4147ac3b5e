"""Context-tree scores against a plain recursion, and the word base against its formula."""

import collections
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rowloom.llm import ctw
from rowloom.llm.common import held_out


def brute(rows, fold=1):
    """(doc_id, n_tokens, n_known, train_tokens, base, score) by direct recursion on dictionaries."""
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == fold for d, _ in rows]
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", t) + [None] for t in lower]
    c = collections.Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    total, distinct = sum(c.values()), len(c)

    def symbols(t):
        x = b"\xff" * 4 + t.encode() + b"\xff"
        for i in range(4, len(x)):
            for k in range(8):
                yield x[i - 4 : i], (1 << k) | (x[i] >> (8 - k)), (x[i] >> (7 - k)) & 1

    count = collections.defaultdict(lambda: [0, 0])
    for t, h in zip(lower, held):
        if not h:
            for ctx, node, bit in symbols(t):
                for d in range(5):
                    count[ctx[4 - d :], node][bit] += 1
    below = collections.defaultdict(float)
    share = {}

    def log_pe(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    for d in (4, 3, 2, 1, 0):
        for (ctx, node), (a, b) in list(count.items()):
            if len(ctx) == d:
                own = log_pe(a, b)
                if d == 4:
                    pw = own
                else:
                    s = below[ctx, node]
                    m = max(own, s)
                    pw = m + math.log((math.exp(own - m) + math.exp(s - m)) / 2)
                    share[ctx, node] = math.exp(own - math.log(2) - pw)
                if d:
                    below[ctx[1:], node] += pw

    def log_p(t):
        out = 0.0
        for ctx, node, bit in symbols(t):
            p = None
            for d in (4, 3, 2, 1, 0):
                ab = count[ctx[4 - d :], node] if (ctx[4 - d :], node) in count else [0, 0]
                kt = (ab[bit] + 0.5) / (sum(ab) + 1)
                w = share.get((ctx[4 - d :], node), 0.5)
                p = kt if p is None else w * kt + (1 - w) * p
            out += math.log10(p)
        return out

    return [
        (d, len(ws), sum(c[w] > 0 for w in ws), total, sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in ws), log_p(t))
        for (d, _), ws, t in zip(rows, tokens, lower)
    ]


@pytest.mark.parametrize("chunk_bytes", [3000, 32 << 20])
def test_scores_against_recursion(spark, chunk_bytes):
    rows = [(r.doc_id, r.text[:400]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    rows += [(1000, None), (1001, ""), (None, "Ab É\U0001f600\tq"), (1002, "same same"), (1002, "same same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("chunk", F.lit(1)).withColumn("kind", F.lit(2))
    found = ctw.score_documents(df, held_out(F.col("doc_id"), 1), chunk_bytes=chunk_bytes).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    mine = sorted([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found], key=key)
    want = sorted(brute(rows), key=key)
    assert [m[:4] for m in mine] == [w[:4] for w in want]
    for m, w in zip(mine, want):
        assert m[4] == pytest.approx(w[4], rel=1e-9)
        assert m[5] == pytest.approx(w[5], rel=1e-7)


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert ctw.score_documents(df.limit(0), F.lit(False)).isEmpty()
    one = ctw.score_documents(df, F.lit(True)).first()
    assert one.score == pytest.approx(4 * 8 * math.log10(0.5)) and one.n_known == 0


def test_model_beats_the_base_on_held_out_text(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = ctw.score_documents(df, held_out(F.col("doc_id"), 1)).where("held_out")
    base, score = held.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base
