"""Operator 8: graded quality by ordinal cumulative-link regression.

A text is a bag of hashed features (words, word endings, shapes, repeats);
one weight vector is shared by all grades and ordered thresholds cut the score:
P(grade > k) = sigmoid(score - threshold k). Fitted by full gradients on a
bounded sample of graded rows; gives the expected grade and the probability of
the best grades.

Null or empty text: no feature, the score is 0 and the thresholds decide.
Without graded rows, or with one grade only, that grade (or 0) is expected.
Repeated rows are each answered.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folia.llm.common import Cache, slices, text_buffers
from folia.llm.samples import sample

#: Graded rows taken of each grade, feature buckets, steps and step size, and the weight of the penalty.
MOST_ROWS, BUCKETS, STEPS, RATE, PENALTY = 2500, 1 << 16, 150, 0.5, 1e-5
CACHE_WORDS = 300_000
SLICE_BYTES = 8 << 20


def shape(word: str) -> str:
    """Letters, digits and signs in runs: 'Ab1!!' is 'Xx9!'."""
    out = ""
    for c in word:
        k = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if not out.endswith(k):
            out += k
    return out


def features_of(word: bytes, known: Cache) -> tuple[int, ...]:
    if (found := known.get(word)) is None:
        text = word.decode()
        found = tuple(zlib.crc32(f.encode()) % BUCKETS for f in (f"w {text.lower()}", f"e {text[-2:].lower()}", f"s {shape(text)}"))
        if len(word) <= 64:  # long strings rarely come again
            known[word] = found
    return found


REPEAT = zlib.crc32(b"repeat") % BUCKETS


def bag(text: bytes, known: Cache) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features and their shares of the text's words, as square roots."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    known.room(len(words) if len(known) + len(words) > known.most else 0)
    flat = [f for w in words for f in features_of(w, known)]
    flat += [REPEAT] * sum(a == b for a, b in zip(words, words[1:]))
    at, n = np.unique(np.array(flat, np.int64), return_counts=True)
    return at, np.sqrt(n / len(words))


class Ordinal:
    def __init__(self, grades: list[int], weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = grades, weights, thresholds

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > grades[k]) for each but the last grade."""
        return 1 / (1 + np.exp(-(scores[:, None] - self.thresholds[None, :])))

    def expected(self, scores: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.tails(scores) @ np.diff(self.grades)


def fitted(rows: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, importance: np.ndarray, grades: list[int]) -> Ordinal:
    """Adaptive full-gradient steps on the penalised likelihood; thresholds stay ordered as a first one and positive gaps."""
    at = np.concatenate([a for a, _ in rows])
    value = np.concatenate([v for _, v in rows])
    row = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
    level = np.searchsorted(grades, grade)
    weights, squares = np.zeros(BUCKETS), np.full(BUCKETS, 1e-8)
    cuts = np.arange(len(grades) - 1, dtype=float) - (len(grades) - 2) / 2
    share = importance / importance.sum()
    for _ in range(STEPS):
        scores = np.bincount(row, value * weights[at], minlength=len(rows))
        over = np.hstack([np.ones((len(rows), 1)), 1 / (1 + np.exp(-(scores[:, None] - cuts))), np.zeros((len(rows), 1))])
        high, low = over[np.arange(len(rows)), level], over[np.arange(len(rows)), level + 1]
        p = np.maximum(high - low, 1e-9)
        dh, dl = high * (1 - high) / p * share, low * (1 - low) / p * share
        slope = np.bincount(at, value * (dh - dl)[row], minlength=BUCKETS) - PENALTY * weights
        squares += slope * slope
        weights += RATE * slope / np.sqrt(squares)
        move = np.array([dl[level == k].sum() - dh[level == k + 1].sum() for k in range(len(cuts))])
        cuts = np.maximum.accumulate(cuts + RATE * move + np.arange(len(cuts)) * 1e-9)
    return Ordinal(grades, weights, cuts)


def fit(docs: DataFrame, labels: DataFrame, label_column: str = "quality", id_column: str = "doc_id", text_column: str = "text", most: int = MOST_ROWS) -> Ordinal:
    """Learns from at most `most` rows of each grade; rows stand for their grade's share."""
    rows, totals = sample(docs, labels, label_column, most, id_column, text_column)
    grades = sorted(totals)
    if len(grades) < 2:
        return Ordinal(grades or [0], np.zeros(BUCKETS), np.zeros(0))

    def bags(batches):
        known = Cache(CACHE_WORDS)
        for batch in batches:
            found = [bag(t.as_py().encode(), known) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([a.astype(np.int32) for a, _ in found], pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32()))], names=["id", "grade", "at", "value"])

    kind = rows.schema[id_column].dataType.simpleString()
    got = rows.select(id_column, "text", "label").mapInArrow(bags, f"id {kind}, grade int, at array<int>, value array<float>").toArrow().sort_by("id")
    grade = got.column("grade").to_numpy()
    taken = {g: max(1, int((grade == g).sum())) for g in grades}
    importance = np.array([(totals[g] / taken[g]) ** 0.5 for g in grade.tolist()])
    bags_ = [(np.array(a.as_py(), np.int64), np.array(v.as_py())) for a, v in zip(got.column("at"), got.column("value"), strict=True)]
    return fitted(bags_, grade, importance, grades)


def score(docs: DataFrame, model: Ordinal, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """score, expected_grade, tail_probability (of the best grade), predicted (the likeliest side of the middle threshold) and kept."""
    docs = docs.select(id_column, text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights

    def run(batches):
        own, known = sent.value, Cache(CACHE_WORDS)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            scores = []
            for i, j in slices(offsets, SLICE_BYTES):
                for k in range(i, j):
                    at, value = bag(data[offsets[k] : offsets[k + 1]].tobytes(), known)
                    scores.append(float(own.weights[at] @ value))
            scores = np.array(scores, float)
            tails = own.tails(scores) if len(own.thresholds) else np.full((len(scores), 1), 1.0)
            expected = own.expected(scores) if len(own.thresholds) else np.full(len(scores), float(own.grades[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array(expected), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= 0.5)], names=[id_column, "score", "expected_grade", "tail_probability", "kept"])

    return docs.mapInArrow(run, f"`{id_column}` {kind}, score double, expected_grade double, tail_probability double, kept boolean")
