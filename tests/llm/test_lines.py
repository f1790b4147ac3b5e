"""Line removal against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rowloom.llm import lines


def brute(rows, width=5, percent=80):
    """{(place of the row, line)} that go; rows are in order."""
    sets, gone, seen = [], set(), []
    for r, (_, text) in enumerate(rows):
        for at, line in enumerate((text or "").lower().split("\n")):
            w = re.findall(r"[^\x20\x09-\x0D]+", line)
            s = frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()
            if not s:
                continue
            if any(100 * len(s & o) >= percent * len(s | o) for o in seen):
                gone.add((r, at))
            seen.append(s)
    return gone


def mine(rows, found):
    """The same form; rows with equal ids are told apart by place."""
    out, used = {}, {}
    for r in sorted(found, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.row)):
        out.setdefault(r.doc_id, []).append(list(r.removed))
    got = set()
    for place, (d, _) in enumerate(rows):
        k = used.get(d, 0)
        used[d] = k + 1
        got |= {(place, at) for at in out[d][k]}
    return got


def tables(monkeypatch):
    """Rows per label of the tables that an operator writes from here on."""
    found, write = {}, lines.written

    def kept(df, label):
        table = write(df, label)
        found.setdefault(label, []).append(table.count())
        return table

    monkeypatch.setattr(lines, "written", kept)
    return found


@pytest.fixture(scope="module")
def made():
    draw = random.Random(11)
    base = [f"w{i}" for i in range(70)]
    rows, long = [], list(base)
    for i in range(50):
        long[draw.randrange(70)] = f"e{i}"
        own = " ".join(f"o{i}x{k}" for k in range(draw.randrange(1, 40)))
        rows.append((i, "\n".join([" ".join(long), "All rights reserved.", own, "", " ".join(base[:40] + [f"t{i}"] * (i % 5))])))
    rows += [(60 + i, " ".join(base[i : i + 45]) + "\n\n \t") for i in range(10)]
    rows += [(80, "a  b\tc d e f"), (81, "A b c d e f"), (82, None), (83, ""), (84, "x\nx"), (84, "x\nx"), (None, "x"), (None, "new line here")]
    return rows


def test_odd_and_near_lines(spark, made):
    df = spark.createDataFrame(made, "doc_id long, text string").coalesce(1).withColumn("n", F.lit(1)).withColumn("line", F.lit("x"))
    found = lines.removals(lines.mark_lines(df)).collect()
    assert mine(made, found) == brute(made)
    assert {r.doc_id: r.n_lines for r in found}[82] == 1
    assert lines.removals(lines.mark_lines(df.limit(0))).isEmpty()


def test_text_is_rebuilt(spark, made):
    df = spark.createDataFrame(made, "doc_id long, text string").coalesce(1)
    gone = brute(made)
    want = sorted(
        (d or -1, "\n".join(x for at, x in enumerate((t or "").split("\n")) if (p, at) not in gone)) for p, (d, t) in enumerate(made)
    )
    assert sorted((r.doc_id or -1, r.text) for r in lines.dedup_lines(df).collect()) == want


def test_small_table_against_all_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 3000")
    rows = sorted((r.doc_id, r.text) for r in df.collect())
    assert mine(rows, lines.removals(lines.mark_lines(df)).collect()) == brute(rows)


def test_lines_with_a_common_passage_give_few_pairs(spark, monkeypatch):
    """Unlike lines that share their rarest words are told apart before their sets are fetched."""
    draw = random.Random(5)
    rare = [f"passage{k}" for k in range(9)]
    rows = []
    for i in range(120):
        own = [draw.choice("abcdefgh") + draw.choice("xyz") for _ in range(30)]
        rows.append((i, " ".join(own[:15] + rare + own[15:])))
    rows.append((120, rows[0][1] + " end"))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = tables(monkeypatch)
    assert mine(rows, lines.removals(lines.mark_lines(df)).collect()) == brute(rows) == {(120, 0)}
    assert sum(found["line-pairs"]) <= 10  # of 7260; the place of a passage in the order says nothing


def test_most_lines_stay_out_of_the_shuffle(spark):
    df = spark.range(20_000).select(F.xxhash64("id").alias("lk"), F.lit("x").alias("line"))
    keys = df.limit(500)
    left = lines.perhaps_wanted(df, keys)
    assert left.join(keys, "lk", "left_semi").count() == 500
    assert left.count() < 600


def test_filters_keep_every_similar_pair(spark):
    """Sets of every size against all pairs: similar ones pass, and meet at as many prefix tokens as is asked for."""
    draw = random.Random(8)
    rows = []
    for i in range(260):
        n = draw.choice([1, 2, 5, 12, 39, 40, 41, 80, 160, 400])
        a = [draw.getrandbits(63) - 2**62 for _ in range(n + 100)]
        swapped = draw.randrange(0, max(1, n // 7) + 1)
        b = a[swapped : n + draw.randrange(0, swapped + 1)]
        rows.append((i, sorted(a[:n]), sorted(b) or [0]))
    df = spark.createDataFrame(rows, "i int, a array<long>, b array<long>")

    def side(name, o):
        rows = df.select("i", F.col(name).alias("tokens"))
        rows = rows.withColumns({c: lines._parity(k) for k, c in enumerate(lines._BITS)} | {"n": F.size("tokens")})
        rows = rows.withColumn("prefix", F.slice("tokens", 1, lines.prefix_length(F.col("n"), lines.PERCENT)))
        rows = rows.select("i", F.posexplode("prefix").alias("pos", "token"), "n", *lines._BITS)
        return rows.withColumnsRenamed({c: c + o for c in ("pos", "n", *lines._BITS)})

    both = side("a", "").join(side("b", "0"), ["i", "token"]).where(lines._fits(lines.PERCENT))
    met = {r.i: r["count"] for r in both.groupBy("i", "n", "n0").count().where(F.col("count") >= lines.pair_need(F.col("n"), F.col("n0"))).collect()}
    similar = {i for i, a, b in rows if 100 * len({*a} & {*b}) >= lines.PERCENT * len({*a} | {*b})}
    assert similar <= met.keys() and 50 < len(similar) < 260
