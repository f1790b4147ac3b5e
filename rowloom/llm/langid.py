"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams (1 to ``ORDER``) of the lower-cased text, with
everything but letters folded to spaces.  Document frequencies are counted over all
training documents, each task adding up its own and sending one short row per used feature.  Weights
are learned by follow-the-regularised-leader with elastic-net penalties on a bounded
sample (``MAX_SAMPLE`` documents, as evenly over languages as they allow, whole texts) in
one task; a fifth of the sample is set aside, on which a temperature is fitted.
Prediction is one projection over every whole text.

Only text and label of training rows are learned from; a prediction uses text only.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is
every text when there is nothing to learn from; rows without a label are not learned
from; repeated rows get equal results; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rowloom.llm.common import text_of
from rowloom.session import written

ORDER = 3
BITS = 16
MAX_SAMPLE = 6000
UNKNOWN = "und"
_KEY = np.uint64(0x9E3779B97F4A7C15)


class Features:
    """Hashed n-gram counts of a text, or None when it has no letter."""

    def __init__(self):
        self.letter = np.array([chr(i).isalpha() for i in range(0x10000)])

    def counts(self, text: str | None) -> np.ndarray | None:
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        low = points < 0x10000
        letters = np.where(low, self.letter[np.where(low, points, 0)], False)
        if not low.all():
            for i in np.flatnonzero(~low):
                letters[i] = chr(points[i]).isalpha()
        if not letters.any():
            return None
        folded = np.where(letters, points, 32).astype(np.uint64)
        # One space for a run of them, and one at either end.
        folded = np.concatenate(([np.uint64(32)], folded, [np.uint64(32)]))
        space = folded == 32
        folded = folded[~(space & np.concatenate(([False], space[:-1])))]
        total = np.zeros(1 << BITS, np.int64)
        value = np.zeros(len(folded), np.uint64)
        for n in range(1, ORDER + 1):
            if len(folded) < n:
                break
            value = (value[: len(folded) - n + 1] + folded[n - 1 :]) * _KEY
            total += np.bincount((value ^ (value >> np.uint64(29))) * _KEY >> np.uint64(64 - BITS), minlength=1 << BITS)
        return total


def weighted(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and unit-length TF-IDF values of the features in use."""
    at = np.flatnonzero(counts)
    x = counts[at] * idf[at]
    return at, x / max(np.sqrt((x * x).sum()), 1e-12)


def learn_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    classes: int,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 0.002,
    l2: float = 0.0005,
    epochs: int = 6,
) -> np.ndarray:
    """Weights [class, feature + 1]; the last place is the bias."""
    z, n = np.zeros((classes, (1 << BITS) + 1)), np.zeros((classes, (1 << BITS) + 1))

    def weights(at):
        zs = z[:, at]
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[:, at])) / alpha + l2))

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(rows)):
            at, x, label = rows[i]
            at, x = np.append(at, 1 << BITS), np.append(x, 1.0)
            w = weights(at)
            p = softmax(w @ x)
            p[label] -= 1
            g = p[:, None] * x
            ns = n[:, at]
            z[:, at] += g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[:, at] = ns + g * g
    return weights(np.arange((1 << BITS) + 1))


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""

    def loss(t):
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    a, b, r = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def document_frequencies(train: DataFrame) -> np.ndarray:
    """[feature] numbers of training documents, and their total in the last place."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, df, n = Features(), np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                counts = features.counts(t.as_py())
                if counts is not None:
                    df += counts > 0
                    n += 1
        at = np.append(np.flatnonzero(df), 1 << BITS)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(df, n)[at])], names=["feature", "df"])

    sums = train.select("text").mapInArrow(count, "feature long, df long").groupBy("feature").agg(F.sum("df").alias("df"))
    out = np.zeros((1 << BITS) + 1, np.int64)
    for r in sums.collect():  # at most 2^BITS + 1 rows
        out[r.feature] = r.df
    return out


def learn(train: DataFrame, max_sample: int = MAX_SAMPLE) -> dict | None:
    """Languages, weights with idf folded in, and temperature, from rows of text and lang."""
    train = train.where("lang is not null and text is not null")
    per = {r.lang: r["count"] for r in train.groupBy("lang").count().collect()}
    if not per:
        return None
    languages = sorted(per)
    quota = max(1, max_sample // len(languages))
    df = document_frequencies(train)
    idf = np.log((1.0 + df[-1]) / (1.0 + df[:-1])) + 1.0
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id", "text"), 24) / F.lit(float(1 << 40))
    share = F.element_at(F.create_map(*[F.lit(v) for lang in languages for v in (lang, min(1.0, quota / per[lang]))]), F.col("lang"))
    sample = train.withColumn("draw", draw).where(F.col("draw") < share)
    classes = {lang: i for i, lang in enumerate(languages)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            out = []
            for draw, lang, text in zip(*(batch.column(i) for i in range(3))):
                counts = features.counts(text.as_py())
                if counts is not None:
                    at, x = weighted(counts, idf)
                    out.append((draw.as_py(), classes[lang.as_py()], at.astype(np.int32).tobytes(), x.astype(np.float32).tobytes()))
            cells = list(zip(*out)) or [[], [], [], []]
            types = [pa.float64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=["draw", "label", "at", "x"])

    sample = sample.select("draw", "lang", "text").mapInArrow(vectors, "draw double, label int, at binary, x binary")
    sample = written(sample, "language-sample").orderBy("draw").limit(max_sample)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for draw, label, at, x in zip(*(batch.column(i).to_pylist() for i in range(4))):
                rows.append((draw, np.frombuffer(at, np.int32), np.frombuffer(x, np.float32).astype(float), label))
        rows = [r[1:] for r in sorted(rows, key=lambda r: (r[0], r[3]))]
        aside = rows[::5] if len(rows) >= 50 else rows
        w = learn_ftrl([r for i, r in enumerate(rows) if i % 5] if len(rows) >= 50 else rows, len(languages))
        logits = np.array([w[:, at] @ x + w[:, -1] for at, x, _ in aside]).reshape(len(aside), len(languages))
        t = fit_temperature(logits, np.array([r[2] for r in aside], int)) if aside else 1.0
        w = np.vstack([w, np.full(w.shape[1], t)])
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in w], pa.binary())], names=["w"])

    # The sample is bounded by max_sample rows of at most 2^BITS features each.
    fitted = np.array([np.frombuffer(r.w) for r in sample.coalesce(1).mapInArrow(fit, "w binary").collect()])
    return {"languages": languages, "idf": idf, "weights": fitted[:-1], "temperature": float(fitted[-1, 0])}


def predict(df: DataFrame, model: dict | None) -> DataFrame:
    """``df`` of doc_id, held_out, text with lang_pred and score instead of the text."""
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                names, scores = [], []
                for t in piece.column(2):
                    counts = features.counts(t.as_py()) if model else None
                    if counts is None:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    places, x = weighted(counts, model["idf"])
                    w = model["weights"]
                    p = softmax((w[:, places] @ x + w[:, -1]) / model["temperature"])
                    names.append(model["languages"][int(p.argmax())])
                    scores.append(float(p.max()))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return df.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(df: DataFrame, held_out: Column, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from rows where ``held_out`` is false."""
    rows = df.select("doc_id", held_out.alias("held_out"), text_of("text").alias("text"), F.col("lang").cast("string").alias("lang"))
    return predict(rows, learn(rows.where(~F.col("held_out")), max_sample))
