"""Shingle components against all pairs; language identification against labels."""

import random
import re

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from rowloom.llm import jaccard, langid
from rowloom.llm.common import held_out

FOLDER = "/root/testdata/sf0.001"


def brute_components(rows, k=4, percent=85):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i] = parent[parent[i]]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted((d or -1, len(sets[i]), (least.get(find(i)) if sets[i] else d) or -1) for i, (d, _) in enumerate(rows))


def mine(df, **how):
    return sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in jaccard.components_of(df, **how).collect())


def test_small_table_against_all_pairs(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert mine(df) == brute_components(rows)


@pytest.mark.parametrize("tile", [2, 256])
def test_chains_hot_passages_and_odd_rows(spark, tile):
    draw = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (None, "one two"), (7, "a b c d"), (7, "a b c d")]
    text = list(base)
    for i in range(60):  # a chain: neighbours link, ends do not
        text[draw.randrange(120)] = f"n{i}"
        rows.append((100 + i, " ".join(text)))
    for i in range(40):  # one passage in documents that are otherwise their own
        rows.append((300 + i, " ".join(base[:60] + [f"o{i}x{k}" for k in range(draw.choice([3, 5, 8, 12]))])))
    rows += [(500 + i, " ".join(base[i : i + 90])) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("n", F.lit(1)).withColumn("root", F.lit(2))
    assert mine(df, tile=tile) == brute_components(rows)
    kept = jaccard.keep_one(df, tile=tile)
    assert kept.columns == df.columns
    groups = {c for d, n, c in brute_components(rows) if n}
    assert kept.count() == len(groups) + 3
    assert mine(df.limit(0)) == [] and jaccard.keep_one(df.limit(0)).isEmpty()


def test_forest_joins_what_pairs_join_and_takes_the_nearest():
    draw = np.random.default_rng(5)
    for nodes, pairs in [(2, 1), (12, 9), (40, 300), (200, 150)]:
        i, j = draw.integers(0, nodes, (2, pairs))
        i, j = i[i != j], j[i != j]
        weight = draw.integers(0, 4, len(i)) / 4

        def trees(places):
            label = list(range(nodes))
            for a, b in zip(i[places], j[places]):
                x, y = label[a], label[b]
                label = [x if v == y else v for v in label]
            return len(set(label)), [[label[k] == label[0] for k in range(nodes)]]

        taken = jaccard._forest(i, j, weight, nodes)
        assert trees(taken) == trees(np.arange(len(i)))
        assert len(taken) == nodes - trees(taken)[0]
        for a in range(nodes):
            mine_ = (i == a) | (j == a)
            if mine_.any():
                assert weight[mine_].min() in weight[taken][(i[taken] == a) | (j[taken] == a)]


def test_tiles_give_no_more_rows_than_they_get(spark, monkeypatch):
    """Copies around the threshold: the pairs that pass the bit count grow with the square of the group."""
    draw, base = random.Random(9), [f"w{i}" for i in range(200)]
    texts = []
    for d in range(150):
        text = list(base)
        for k in draw.sample(range(200), draw.choice([2, 4, 6])):
            text[k] = f"n{d}x{k}"
        texts.append(" ".join(text))
    found = [jaccard.shingles(t) for t in texts]
    rows = [(i, len(s), jaccard.set_digest(s), bytearray(jaccard.bitmap(s)), bytearray(s.tobytes())) for i, s in enumerate(found)]
    sets = spark.createDataFrame(rows, "id long, n int, d long, bits binary, items binary")
    open_ = sets.selectExpr("7L as token", "30 as band", "n", "id", "id as root")

    def trees(pairs):
        label = list(range(150))
        for a, b in pairs:
            x, y = label[a], label[b]
            label = [x if v == y else v for v in label]
        return sorted(label.index(v) for v in label)

    def linked(found):
        return sorted((r.id, r.id2) for r in jaccard.exact(found.select("id", "id2"), sets, 85).collect())

    every = jaccard.tile_pairs(open_, sets, 85)
    brute = [
        (i, j) for j in range(150) for i in range(j) if jaccard.links(len(np.intersect1d(found[i], found[j])), len(found[i]), len(found[j]))
    ]
    assert len(brute) > 150 and linked(every) == sorted(brute)
    few = jaccard.tile_pairs(open_, sets, 85, whole=False)
    assert few.where("token is null").count() < 150
    assert [r.token for r in few.where("token is not null").collect()] == [7]  # to be looked at once more
    first = linked(few.where("token is null"))
    roots = spark.createDataFrame(list(enumerate(trees(first))), "id long, root long")
    again = jaccard.tile_pairs(open_.drop("root").join(roots, "id"), sets, 85)
    assert again.count() < every.count() and trees(first + linked(again)) == trees(brute)


def test_texts_are_cut_once_for_hot_and_cold_postings(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"a b c d e f g h{i % 4}") for i in range(9)], "doc_id long, text string")
    counts = np.zeros(jaccard.SLOTS, np.int64)
    hot = jaccard.shingles("a b c d")
    plans, keep = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda frame, label: plans.append(plan_of(frame)) or keep(frame, label))
    for heat in (0, 100_000):
        counts[(hot >> np.uint64(48)).astype(np.int64)] = heat
        shared = jaccard.shared_postings(jaccard.postings(df, "text", counts, 4, 10), 10)
        held = {(r.token, r.n, r.d) for r in shared.collect()}
        assert shared.count() == len(held) == 4 * 4  # shingles that all four texts have
    assert plans[0].count("MapInArrow") == 1


def test_language_accuracy_and_odd_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame(
        [(-1, None, "en", "s", 0), (-2, "", None, None, 0), (-3, "123 !?", "fr", "s", 0), (-4, "the \U0001d400 of", None, "s", 0)], df.schema
    )
    found = langid.identify(df.union(odd).withColumn("draw", F.lit(1)), held_out(F.col("doc_id"), 0), max_sample=800)
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == 1004
    for i in (-1, -2, -3):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert rows[-4].lang_pred in {"en", "fr", "de", "es"}
    truth = [(r.doc_id, r.lang) for r in df.collect() if rows[r.doc_id].held_out]
    right = sum(rows[d].lang_pred == lang for d, lang in truth)
    assert right >= 0.97 * len(truth)
    scores = [rows[d].score for d, _ in truth]
    assert abs(sum(scores) / len(scores) - right / len(truth)) < 0.05
    assert langid.identify(df.limit(0), held_out(F.col("doc_id"), 0)).isEmpty()
    unlabelled = df.limit(3).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled, F.lit(False)).collect()} == {"und"}


def test_texts_that_are_not_wanted_stay_where_they_are(spark):
    """The bitmap of keys loses no wanted text, whatever its key's sign, and rules out nearly all others."""
    texts = spark.range(20000).select(F.xxhash64("id").alias("key"), F.col("id").cast("string").alias("text"))
    wanted = texts.where("cast(text as int) % 7 = 0").select("key")
    found = jaccard.perhaps_wanted(texts, wanted)
    assert found.join(wanted, "key").count() == wanted.count()
    assert found.count() < 1.05 * wanted.count()


def test_pairs_of_small_groups_carry_no_bitmaps(spark):
    rows = [(7, 0, 10, 1, 1), (7, 0, 10, 2, 2), (7, 0, 11, 3, 2), (8, 0, 10, 1, 1), (8, 0, 10, 2, 2), (9, 0, 10, 1, 1), (9, 9, 40, 4, 4)]
    open_ = spark.createDataFrame(rows, "token long, band int, n int, id long, root long")
    assert sorted(map(tuple, jaccard.few_pairs(open_, 85).collect())) == [(1, 2), (1, 3)]


def test_groups_just_below_and_above_few(spark, monkeypatch):
    """Groups on both sides of the limit give the same components, and only larger ones reach the tiles."""
    draw, rows = random.Random(8), []
    for group, size in enumerate([2, 5, jaccard.FEW, jaccard.FEW + 1, 3 * jaccard.FEW]):
        base = [f"g{group}w{k}" for k in range(60)]
        for _ in range(size):
            copy = list(base)
            for at in draw.sample(range(60), draw.randrange(0, 4)):
                copy[at] = f"x{draw.randrange(10**9)}"
            rows.append((len(rows), " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen, tiles = [], jaccard.tile_pairs
    monkeypatch.setattr(jaccard, "tile_pairs", lambda open_, *a: seen.append(open_) or tiles(open_, *a))
    monkeypatch.setattr(jaccard, "TURNS", 1)
    least = lambda: sorted((r.doc_id, r.component_id) for r in jaccard.components_of(df).collect())
    mixed = least()
    monkeypatch.setattr(jaccard, "FEW", 0)
    assert least() == mixed
    assert len(seen) >= 2
