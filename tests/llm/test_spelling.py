"""Spelling variants against all pairs."""

import collections
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rowloom.llm import queries, spelling
from rowloom.session import _app_folder

FOLDER = "/root/testdata/sf0.001"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counted(rows):
    words = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def all_pairs(words):
    found = {w: [] for w in words}
    holes = collections.defaultdict(set)
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            holes[key].add(w)
    for group in holes.values():
        for a in group:
            found[a] += [b for b in group if near(a, b)]
    return {w: sorted(set(x)) for w, x in found.items()}


def plain(words):
    links = all_pairs(words)
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n, form[w], root, len(links[w]), words[form[w]] if form[w] else None))
    return out


def rows_of(df):
    return {(r.word, r.n, r.form, r.root, r.n_near, r.form_n) for r in df.collect()}


def test_whole_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    expected = plain(counted(texts))
    assert any(x[2] for x in expected)
    assert rows_of(queries.QUERIES["op12_spelling_variants"](spark, FOLDER)) == expected


ODD = [
    (1, None),
    (2, ""),
    (3, "ABCDEFG abcdefg Àbcdefg àbcdefg ×bcdefg abcdefgh"),
    (3, "ABCDEFG abcdefg Àbcdefg àbcdefg ×bcdefg abcdefgh"),
    (None, "aaaaaaa aaaaaaaa aaaaaaa aaaaaaaa abaaaaa aabaaaa abaaaaa aabaaaa"),
    (4, "1234567 abcĀdefghij " + "longword" * 700 + " " + "longword" * 700),
    (5, ("longword" * 700 + "x ") * 2 + ("longword" * 699 + "longwird ") * 30),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string").select("*", *[F.lit(0).alias(c) for c in ("id", "word", "n", "node", "run")])
    expected = plain(counted(ODD))
    words = spelling.count_words(df)
    assert {(r.word, r.n) for r in words.collect()} == set(counted(ODD).items())
    assert rows_of(spelling.variants(words)) == expected
    assert spelling.variants(spelling.count_words(df.limit(0))).isEmpty()


@pytest.mark.parametrize("seed", [1])
def test_dense_neighbourhoods(spark, seed):
    """Few letters, so that nearly every edit is another word."""
    draw = random.Random(seed)
    words = {"".join(draw.choice("aab") for _ in range(draw.randint(1, 12))): draw.choice([1, 2, 30, 500]) for _ in range(700)}
    words["x"] = words["xy"] = 3
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows_of(spelling.variants(df)) == plain(words)


def test_chain_of_forms(spark):
    words = {"chainaa": 10**6, "chainab": 10**4, "chainbb": 10**2, "chaibbb": 3}
    got = {r.word: (r.form, r.root) for r in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got["chaibbb"] == ("chainbb", "chainaa") and got["chainaa"] == (None, "chainaa")


def test_states_of_earlier_levels_are_deleted(spark):
    words = spark.createDataFrame([(i, w, 9 - i) for i, w in enumerate(["letters", "lettera", "lettersx", "fetters", "another"])], "id long, word string, n long")
    before = set(os.listdir(_app_folder(spark))) if os.path.isdir(_app_folder(spark)) else set()
    pairs = sorted(tuple(r) for r in spelling.near_pairs(words).collect())
    assert pairs == [(0, 1), (0, 2), (0, 3)]
    left = [name.rsplit("-", 1)[0] for name in set(os.listdir(_app_folder(spark))) - before]
    assert left.count("trie-states") == 1 and "trie-steps" not in left and "trie-edges" not in left
