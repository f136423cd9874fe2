"""Toxicity grades by cumulative-link ordinal regression on sparse word features.

One weight per word is shared by all thresholds between neighbouring grades, so
P(grade <= k) = sigmoid(threshold_k - weights . words).  Labels only say toxic
or not; within toxic documents the grade follows how often words occur that
toxic documents have far more often than others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showlake.llm.common import in_arrow, texts
from showlake.llm.language_id import held_out

#: Labelled documents to learn from, and documents in which a word must occur to be a feature.
TRAIN_ROWS, LEAST_DOCUMENTS = 12_000, 4
#: Standard errors by which a feature's share must differ between toxic and other documents, and those of a marked word.
SELECT, MARKED = 3.0, 8.0
#: Occurrences of marked words from which on a toxic document has grade 2 and 3.
GRADES = (2, 4)
PENALTY, STEPS, RATE = 1e-4, 400, 0.1
#: Chance of any toxic grade from which on a document counts as toxic.
TOXIC = 0.5
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


@dataclass
class Grader:
    """Words, their weights and the ordered thresholds."""

    words: list[str]
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, scores: np.ndarray) -> np.ndarray:
        """The chance of each grade, one row per score."""
        below = 1 / (1 + np.exp(np.clip(scores[:, None] - self.thresholds[None, :], -60, 60)))
        edges = np.hstack([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))])
        return np.maximum(np.diff(edges, axis=1), 0.0)


def fit(at: np.ndarray, word: np.ndarray, value: np.ndarray, grades: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of least penalised loss, by Adam; entry i says that row ``at[i]`` has ``value[i]`` of ``word[i]``."""
    top = int(grades.max())
    n = len(grades)
    shares = np.array([(grades <= k).mean() for k in range(top)]).clip(1e-3, 1 - 1e-3)
    first = np.log(shares / (1 - shares))
    # thresholds are the first one and logarithms of the gaps, which keeps them in order
    p = np.concatenate([np.zeros(n_words), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -60, 60)))
    for step in range(1, STEPS + 1):
        w, gaps = p[:n_words], np.exp(p[n_words + 1 :])
        cuts = p[n_words] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(at, value * w[word], n)
        upper = np.where(grades < top, sigmoid(cuts[np.minimum(grades, top - 1)] - score), 1.0)
        lower = np.where(grades > 0, sigmoid(cuts[np.maximum(grades - 1, 0)] - score), 0.0)
        chance = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_score = (du - dl) / n
        by_cut = np.zeros(top)
        np.add.at(by_cut, np.minimum(grades, top - 1), np.where(grades < top, -du, 0.0) / n)
        np.add.at(by_cut, np.maximum(grades - 1, 0), np.where(grades > 0, dl, 0.0) / n)
        later = np.cumsum(by_cut[::-1])[::-1]
        g = np.concatenate([np.bincount(word, value * by_score[at], n_words) + PENALTY * w, later[:1], later[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:n_words], p[n_words] + np.concatenate([[0.0], np.cumsum(np.exp(p[n_words + 1 :]))])


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Grader | None:
    """Learn from about ``rows`` labelled documents that are not held out, chosen by a hash of the doc_id; None without both classes.

    The sample bounds what is broadcast and what reaches the driver: its
    labels, the words that tell the classes apart, and their counts by
    document.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).filter(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    total = known.count()
    if not total:
        return None
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(1_000_000 * rows / total))
    sample = texts(documents).join(F.broadcast(chosen), "doc_id").select("toxic", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for toxic, text in zip(batch["toxic"], batch["text"], strict=True):
                words = sorted(set(words_of(text)))
                yield pd.DataFrame({"toxic": toxic, "word": ["", *words]})  # the empty word counts documents

    seen = in_arrow(sample, count, "toxic int, word string", pandas=True).groupBy("word").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("toxic")
    )
    table = seen.filter((F.col("n") >= LEAST_DOCUMENTS) | (F.col("word") == "")).toPandas()
    whole = table[table["word"] == ""]
    if not len(whole) or not 0 < int(whole["toxic"].iloc[0]) < int(whole["n"].iloc[0]):
        return None
    n, positive = int(whole["n"].iloc[0]), int(whole["toxic"].iloc[0])
    table = table[table["word"] != ""].sort_values("word")
    a, b = table["toxic"] / positive, (table["n"] - table["toxic"]) / (n - positive)
    share = table["n"] / n
    z = (a - b) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / positive + 1 / (n - positive)))
    words = table["word"][np.abs(z) >= SELECT].tolist()
    marked = set(table["word"][z >= MARKED])
    place = {w: i for i, w in enumerate(words)}

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for toxic, text in zip(batch["toxic"], batch["text"], strict=True):
                found = words_of(text)
                at, counts = np.unique([place[w] for w in found if w in place], return_counts=True)
                hits = sum(w in marked for w in found)
                grade = 1 + sum(hits >= g for g in GRADES) if toxic else 0
                out.append((grade, at.astype(int).tolist(), np.log1p(counts).tolist()))
            yield pd.DataFrame(out, columns=["grade", "words", "counts"])

    rows_ = in_arrow(sample, features, "grade int, words array<int>, counts array<double>", pandas=True).toPandas()
    at = np.repeat(np.arange(len(rows_)), rows_["words"].map(len))
    word = np.concatenate([[], *rows_["words"]]).astype(int)
    value = np.concatenate([[], *rows_["counts"]]).astype(float)
    weights, thresholds = fit(at, word, value, rows_["grade"].to_numpy(int), len(words))
    return Grader(words, weights, thresholds)


def grade(documents: DataFrame, grader: Grader | None) -> DataFrame:
    """``doc_id, severity, grade, p_toxic, toxic`` of every whole text, one row per row.

    ``severity`` is the expected grade, ``grade`` the likeliest (the lower on
    ties).  A null text counts as empty; without a grader all are null.
    Columns beyond doc_id and text are ignored.
    """
    schema = "doc_id long, severity double, grade int, p_toxic double, toxic boolean"
    if grader is None:
        none = [F.lit(None).cast(t).alias(n) for n, t in (x.split() for x in schema.split(", ")[1:])]
        return texts(documents).select("doc_id", *none)
    shared = documents.sparkSession.sparkContext.broadcast((grader.words, grader.weights, grader.thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Grader(*shared.value)
        place = {w: i for i, w in enumerate(own.words)}
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(1)):
                found = [place[w] for w in words_of(text.as_py()) if w in place]
                if found:
                    at, counts = np.unique(found, return_counts=True)
                    scores[i] = own.weights[at] @ np.log1p(counts)
            chances = own.chances(scores)
            severity = np.round(chances @ np.arange(chances.shape[1]), 6)
            p = np.round(1 - chances[:, 0], 6)
            columns = [severity, chances.argmax(axis=1).astype(np.int32), p, p >= TOXIC]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns)], ["doc_id", "severity", "grade", "p_toxic", "toxic"]
            )

    return in_arrow(texts(documents), run, schema)
