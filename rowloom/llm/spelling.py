"""Spelling variants: words one edit apart, found by a relational frontier over a trie.

Words are the paths of a trie, held as a distributed edge table (node, label, child).  A
state is (word, position, node, edits).  Without an edit a word's state at a position is
the node of its own prefix, so the frontier starts with the states after one edit: at
each position the word either drops a letter (same node) or takes a sibling edge (another
letter).  Level by level the states then join the edge table on (node, label), where the
label is what the word goes on with; a state with nothing left in a terminal node has
found a neighbour.

Two things keep the frontier small.  Near the root a node has dozens of children, so
edits are only tried in the second half of a word, in the trie of the words and in the
trie of the reversed words; any pair one edit apart is met in one of them.  And the edge
that leaves a node carries as many letters as the lowest set bit of what is left of its
word: level k moves all states whose rest has bit k, so a word of a million letters takes
twenty levels, and there is one edge per letter.

Nodes are 64-bit hashes of prefixes (a polynomial over letters, computed for whole Arrow
batches).  Prefixes that share a hash merge their nodes, which can only add candidates;
every candidate pair is compared as text, so the result is exact.

How it scales.  The text is read once; words are counted with map-side combination, so a
frequent word is sent once per task.  Everything after that follows the vocabulary.  A
node has at most as many children as there are letters, a word at most as many
neighbours as letters times length: no key is hot.  Words, edges and each level's states
are written tables; of the states only those that found a neighbour outlive their level.

Defined cases: null text has no words, a null id is the empty text in the hash; repeated
rows count each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from rowloom.llm.common import ascii_lower, crc32_of, portions, text_of
from rowloom.session import free_shuffles, forget, written

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT, MORE = 7, 2, 10
_DELETE_EACH = 31
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def runs_of(text: Column, least: int) -> Column:
    """Maximal runs of letters that have at least ``least``, A-Z in lower case."""
    runs = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    # Lower case is the same for plain letters, and quicker.
    return F.transform(runs, lambda r: F.when(F.octet_length(r) == F.length(r), F.lower(r)).otherwise(ascii_lower(r)))


def blurred(doc_id: Column, run: Column, each: int = _DELETE_EACH) -> Column:
    """The run without one letter where ``each`` divides crc32(``doc_id:run``)."""
    h = crc32_of(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    return F.when(h % each == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def count_words(df: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS, copies: int = LEAST_COUNT) -> DataFrame:
    """word, n: the runs of all texts, some with a letter less."""
    runs = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.explode(runs_of(text_of(text), least)).alias("run"))
    words = runs.select(blurred(F.col("doc_id"), F.col("run")).alias("word")).where(F.length("word") >= least)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= copies)


class _Paths:
    """Prefix hashes of some words, read forwards or backwards."""

    def __init__(self, words: list[str], backwards: bool):
        self.size = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.size) - self.size
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
        total = len(points)
        if backwards:
            behind = np.repeat(2 * self.start + self.size - 1, self.size)
            points = points[behind - np.arange(total)]
        self.points = points.astype(np.int64)
        with np.errstate(over="ignore"):
            mixed = (points * np.uint64(2) + np.uint64(1 + backwards)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
            mixed ^= mixed >> np.uint64(29)
            power = np.ones(total + 1, np.uint64)
            shrunk = np.ones(total + 1, np.uint64)
            power[1:], shrunk[1:] = _BASE, _BASE_INVERSE
            self.power = np.cumprod(power, dtype=np.uint64)
            self.sum = np.concatenate([[np.uint64(0)], np.cumsum(mixed * np.cumprod(shrunk, dtype=np.uint64)[:-1], dtype=np.uint64)])

    def hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            value = (self.sum[end] - self.sum[begin]) * self.power[np.maximum(end - 1, 0)]
        return value.view(np.int64)

    def late(self) -> tuple[np.ndarray, np.ndarray]:
        """Word and place of each letter in the second half."""
        half = self.size // 2
        word = np.repeat(np.arange(len(self.size)), self.size - half)
        first = np.repeat(np.cumsum(self.size - half) - (self.size - half), self.size - half)
        return word, np.arange(len(word)) - first + half[word]


def _by_word(words: DataFrame, schema: str, make) -> DataFrame:
    """``make(paths, ids)`` for bounded portions of the words, forwards and backwards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, pc.utf8_length(batch.column(1)).to_pylist(), 20_000, 200_000):
                texts, ids = part.column(1).to_pylist(), part.column(0).to_numpy()
                for backwards in (False, True):
                    yield make(_Paths(texts, backwards), ids)

    return words.select("id", "word").mapInArrow(run, schema)


def _edges(paths: _Paths, ids: np.ndarray) -> pa.RecordBatch:
    word, place = paths.late()
    start, left = paths.start[word], paths.size[word] - place
    stride = left & -left
    at = start + place
    out = [stride, paths.hash(start, at), paths.hash(at, at + stride), paths.hash(start, at + stride)]
    return pa.RecordBatch.from_arrays([pa.array(v) for v in out], names=["stride", "node", "label", "child"])


def _steps(paths: _Paths, ids: np.ndarray) -> pa.RecordBatch:
    word, place = paths.late()
    start, end = paths.start[word], (paths.start + paths.size)[word]
    at = start + place
    rest = end - at - 1
    # What follows, cut from its lowest bit upwards.
    count = np.zeros(len(rest), np.int64)
    for k in range(int(rest.max(initial=0)).bit_length()):
        count += rest >> k & 1
    bounds = np.concatenate([[0], np.cumsum(count)])
    labels, used, from_ = np.zeros(bounds[-1], np.int64), bounds[:-1].copy(), at + 1
    for k in range(int(rest.max(initial=0)).bit_length()):
        rows = np.flatnonzero(rest >> k & 1)
        labels[used[rows]] = paths.hash(from_[rows], from_[rows] + (1 << k))
        used[rows] += 1
        from_[rows] += 1 << k
    follows = np.where(rest > 0, paths.points[np.minimum(at + 1, len(paths.points) - 1)] if len(paths.points) else 0, -1)
    out = [pa.array(ids[word]), pa.array(paths.hash(start, at)), pa.array(paths.points[at]), pa.array(paths.hash(start, at + 1))]
    out += [pa.array(rest), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(labels)), pa.array(follows != paths.points[at])]
    return pa.RecordBatch.from_arrays(out, names=["id", "node", "letter", "child", "rest", "labels", "drops"])


def _ends(paths: _Paths, ids: np.ndarray) -> pa.RecordBatch:
    out = [ids, paths.hash(paths.start, paths.start + paths.size)]
    return pa.RecordBatch.from_arrays([pa.array(v) for v in out], names=["other", "node"])


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b: ids of words (id, word; written, words distinct) one edit apart, each pair once."""
    edges = written(_by_word(words, "stride long, node long, label long, child long", _edges).distinct(), "trie-edges")
    steps = written(
        _by_word(words, "id long, node long, letter long, child long, rest long, labels array<long>, drops boolean", _steps),
        "trie-steps",
    )
    free_shuffles(steps)
    state = ("id", "node", "rest", "labels")
    # A letter less; of equal letters in a row only the last is dropped.
    dropped = steps.where("drops").select(*state)
    # Another letter; the smaller one is enough, as the other word has the greater.
    branches = steps.select("node", F.col("letter").alias("taken"), F.col("child").alias("to")).distinct()
    turned = steps.join(branches, "node").where("taken < letter").select("id", F.col("to").alias("node"), "rest", "labels")
    states, done, level = written(dropped.unionByName(turned), "trie-states"), [], 0
    forget(steps, shuffles=True)
    while True:
        bit = 1 << level
        done.append(written(states.where("rest = 0").select("id", "node"), "trie-done"))
        moving = states.where(F.col("rest").bitwiseAND(F.lit(bit)) != 0).withColumn("label", F.col("labels")[0])
        moved = moving.join(edges.where(F.col("stride") == bit).select("node", "label", "child"), ["node", "label"]).select(
            "id", F.col("child").alias("node"), (F.col("rest") - bit).alias("rest"), F.expr("slice(labels, 2, size(labels))").alias("labels")
        )
        waiting = states.where((F.col("rest") > 0) & (F.col("rest").bitwiseAND(F.lit(bit)) == 0))
        before, states = states, written(moved.unionByName(waiting), "trie-states")
        forget(before, shuffles=True)
        level += 1
        if states.where("rest > 0").isEmpty():
            done.append(states.select("id", "node"))
            break
    forget(edges)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    ends = _by_word(words, "other long, node long", _ends)
    pairs = found.join(ends, "node").where("id <> other")
    pairs = pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    left = words.select(F.col("id").alias("a"), F.col("word").alias("word_a"))
    right = words.select(F.col("id").alias("b"), F.col("word").alias("word_b"))
    exact = F.levenshtein("word_a", "word_b", 1) == 1
    return pairs.join(left, "a").join(right, "b").where(exact).select("a", "b")


def variants(words: DataFrame, more: int = MORE) -> DataFrame:
    """``words`` (word, n; distinct) with form, root, n_near and form_n.

    A word's form is its most frequent near word (ties: the first in code-point order), if
    that is ``more`` times as frequent; the root is where forms lead.
    """
    words = written(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")
    pairs = written(near_pairs(words), "spelling-pairs")
    both = pairs.select("a", "b").union(pairs.select("b", "a")).toDF("id", "near")
    facts = words.select(F.col("id").alias("near"), F.struct((-F.col("n")).alias("less"), "word", F.col("id").alias("at")).alias("fact"))
    best = both.join(facts, "near").groupBy("id").agg(F.count("*").alias("n_near"), F.min("fact").alias("best"))
    told = written(words.join(best, "id", "left"), "spelling-told")
    forms = told.where(-F.col("best.less") >= more * F.col("n")).select("id", F.col("best.at").alias("root"), F.col("best.word").alias("root_word"))
    forms = written(forms, "spelling-forms")
    roots = forms
    while True:
        further = roots.select(F.col("id").alias("root"), F.col("root").alias("next"), F.col("root_word").alias("next_word"))
        jumped = roots.join(further, "root", "left")
        roots = written(
            jumped.select(
                "id",
                F.coalesce("next", "root").alias("root"),
                F.coalesce("next_word", "root_word").alias("root_word"),
                F.col("next").isNotNull().alias("jumped"),
            ),
            "spelling-roots",
        )
        if roots.where("jumped").isEmpty():
            break
        roots = roots.drop("jumped")
    named = forms.select("id", F.col("root_word").alias("form")).join(roots.select("id", "root_word"), "id")
    return told.join(named, "id", "left").select(
        "word",
        "n",
        "form",
        F.coalesce("root_word", "word").alias("root"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("form").isNotNull(), -F.col("best.less")).alias("form_n"),
    )
