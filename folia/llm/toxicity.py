"""Operator 3: toxicity from the nearest labelled examples.

Terms are the words of a text and their beginnings of four and five letters.
Every term of a bounded sample of labelled rows has a weight: its inverse
document frequency times how much more its document counts differ between the
labels than chance explains, and a small part of that for all other terms. The
sample's unit vectors form an inverted index; a term's postings are cut into
blocks of examples, each with its largest weight. A text's nearest examples by
exact cosine come from the blocks whose upper bounds reach the k-th found and
the least cosine that counts; other blocks are skipped.

Votes are weighted by cosine and by how many labelled rows an example stands
for, with the prior as one more vote of weight DOUBT. Platt scaling on the examples'
own votes, each without itself, turns vote shares into probabilities. The
neighbours are the evidence.

A text without a neighbour (null and empty ones too) gets the calibrated
prior. Ties in cosine go to the smaller example number. Repeated rows are each
answered; a labelled id with several texts is learnt by the smallest. Without
labelled rows every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folia.llm.common import Cache, slices, text_buffers
from folia.llm.samples import sample

#: Labelled rows taken of each label value, neighbours asked, examples a block, weight of the prior's vote, and least cosine of a neighbour.
MOST_EXAMPLES, NEIGHBOURS, BLOCK, DOUBT, LEAST_COSINE = 1500, 16, 256, 0.25, 0.3
#: Chi-square that chance explains in so many terms, and the share of its inverse document frequency that a term keeps whatever its chi-square.
CHANCE, REST = 15.0, 0.1
#: Blocks that are looked at before the others' bounds are held against the k-th cosine.
FIRST_BLOCKS = 2
#: A term that more than one in OFTEN examples has is scored from a matrix instead of its postings.
OFTEN = 3
WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
CACHE_WORDS = 400_000
SLICE_BYTES = 4 << 20


def terms_of(word: bytes) -> list[bytes]:
    """A word and its beginnings; beginnings are marked."""
    text = word.decode(errors="ignore")
    return [word, *(b"^" + text[:k].encode() for k in (4, 5) if len(text) > k)]


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case (letters beyond ASCII as they are written)."""
    return WORD.findall(text.lower())


def spans(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places starts[r] .. starts[r + 1] - 1 of every row r one after the other, and how many each has."""
    n = starts[rows + 1] - starts[rows]
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) + np.repeat(starts[rows] - ends + n, n), n


class Index:
    """The block-max inverted index of the examples, from each one's distinct terms and counts."""

    def __init__(self, examples: list[tuple[list[bytes], np.ndarray]], labels: np.ndarray, votes: np.ndarray, ids: list, prior: float):
        self.labels, self.votes, self.ids, self.prior, self.scale = labels.astype(float), votes, ids, prior, (1.0, 0.0)
        self.number: dict[bytes, int] = {}
        term = np.array([self.number.setdefault(t, len(self.number)) for terms, _ in examples for t in terms], np.int64)
        count = np.concatenate([np.zeros(0), *(c for _, c in examples)])
        row = np.repeat(np.arange(len(examples)), [len(terms) for terms, _ in examples])
        self.weight = self.weights(np.bincount(term[self.labels[row] > 0], minlength=len(self.number)), np.bincount(term, minlength=len(self.number)))
        value = (1 + np.log(count)) * self.weight[term]
        norm = np.sqrt(np.bincount(row, value * value, minlength=len(examples)))
        value = value / np.maximum(norm, 1e-300)[row]
        order = np.lexsort((row, term))
        self.example, self.value, term = row[order], value[order], term[order]
        self.blocks = -(-len(examples) // BLOCK)
        # terms that a large part of the examples has: their weights once more, as a matrix for each block
        often = np.flatnonzero(np.bincount(term, minlength=len(self.number)) * OFTEN > len(examples))
        self.column = np.full(len(self.number), -1)
        self.column[often] = np.arange(len(often))
        self.matrix = np.zeros((self.blocks, len(often), BLOCK))
        dense = self.column[term] >= 0
        self.matrix[self.example[dense] // BLOCK, self.column[term[dense]], self.example[dense] % BLOCK] = self.value[dense]
        block = self.example // BLOCK
        entry = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])])) if len(term) else np.zeros(0, np.int64)
        self.block, self.postings = block[entry], np.append(entry, len(term))
        self.most = np.maximum.reduceat(self.value, entry) if len(entry) else np.zeros(0)
        self.entries = np.searchsorted(term[entry], np.arange(len(self.number) + 1))

    def weights(self, toxic: np.ndarray, either: np.ndarray) -> np.ndarray:
        n1, n = float(self.labels.sum()), len(self.labels)
        expected = either * n1 / max(n, 1)
        spread = expected * max(n - n1, 0.0) / max(n, 1) * (n - either + 1) / max(n, 1)
        chi2 = (toxic - expected) ** 2 / np.maximum(spread, 1e-9)
        return np.log((1 + n) / (1 + either)) * (REST + np.maximum(0.0, chi2 - CHANCE) / CHANCE)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Terms and unit weights of a text."""
        terms = np.fromiter(counts.keys(), np.int64, len(counts))
        value = (1 + np.log(np.fromiter(counts.values(), float, len(counts)))) * self.weight[terms]
        return terms, value / (np.sqrt(value @ value) or 1.0)

    def nearest(self, counts: dict[int, int], k: int = NEIGHBOURS, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k most similar examples from LEAST_COSINE on and their cosines, exactly; the example `but` isn't asked."""
        terms, query = self.vector(counts)
        column = self.column[terms]
        dense = np.zeros(self.matrix.shape[1])
        dense[column[column >= 0]] = query[column >= 0]
        entry, n = spans(self.entries, terms)
        block, query, rare = self.block[entry], np.repeat(query, n), np.repeat(column < 0, n)
        bounds = np.bincount(block, query * self.most[entry], minlength=self.blocks) + 1e-9
        order = np.argsort(-bounds, kind="stable")
        found, cosines = np.zeros(0, np.int64), np.zeros(0)
        floor, done = LEAST_COSINE, np.zeros(self.blocks, bool)
        for some in (order[:FIRST_BLOCKS], order[FIRST_BLOCKS:]):
            todo = np.zeros(self.blocks, bool)
            todo[some] = bounds[some] >= floor
            if not todo.any():
                break
            own = todo[block] & rare
            place, m = spans(self.postings, entry[own])
            scores = np.bincount(self.example[place], np.repeat(query[own], m) * self.value[place], minlength=self.blocks * BLOCK).astype(float, copy=False)
            for b in np.flatnonzero(todo).tolist():
                scores[b * BLOCK : (b + 1) * BLOCK] += dense @ self.matrix[b]
            if but >= 0:
                scores[but] = 0.0
            hit = np.flatnonzero(scores >= LEAST_COSINE)
            found, cosines = np.concatenate([found, hit]), np.concatenate([cosines, scores[hit]])
            best = np.lexsort((found, -np.round(cosines, 12)))[:k]
            found, cosines = found[best], cosines[best]
            if len(found) == k:
                floor = max(floor, cosines[-1])
        return found, cosines

    def share(self, counts: dict[int, int], but: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """The share of toxic votes, the neighbours and their cosines."""
        found, cosines = self.nearest(counts, but=but) if counts else (np.zeros(0, np.int64), np.zeros(0))
        votes = cosines * self.votes[found]
        return float((votes @ self.labels[found] + DOUBT * self.prior) / (votes.sum() + DOUBT)), found, cosines

    def calibrated(self, share):
        a, b = self.scale
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(a * np.log(share / (1 - share)) + b)))

    def calibrate(self, examples: list[dict[int, int]]) -> None:
        """Platt scaling by Newton steps on the examples' vote shares, each without itself; targets are smoothed, and the slope is never below 0."""
        share = np.clip([self.share(counts, but=i)[0] for i, counts in enumerate(examples)], 1e-6, 1 - 1e-6)
        x = np.column_stack([np.log(share / (1 - share)), np.ones(len(share))])
        n1 = self.votes @ self.labels
        target = np.where(self.labels > 0, (n1 + 1) / (n1 + 2), 1 / (self.votes.sum() - n1 + 2))
        at = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-(x @ at)))
            slope = x.T @ (self.votes * (target - p)) - 1e-3 * (at - [1.0, 0.0])
            curve = (x * (self.votes * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            step = np.clip(np.linalg.solve(curve, slope), -1, 1)
            at = at + step
            if np.abs(step).max() < 1e-8:
                break
        self.scale = (max(0.0, float(at[0])), float(at[1]))

    def score(self, counts: dict[int, int]) -> tuple[float, np.ndarray, np.ndarray]:
        share, found, cosines = self.share(counts)
        return float(self.calibrated(share)), found, cosines


def counted(text: bytes) -> Counter:
    """How often each term occurs in a text."""
    terms: Counter = Counter()
    for word, n in Counter(words_of(text)).items():
        for t in terms_of(word):
            terms[t] += n
    return terms


def index_of(texts: list[bytes], labels: list[int], ids: list, totals: tuple[int, int]) -> Index:
    """The calibrated index of labelled texts; totals are the labelled rows with and without the label in all."""
    # alike examples share blocks: by label, then by their most frequent words
    order = sorted(range(len(texts)), key=lambda i: (labels[i], [w for w, _ in Counter(words_of(texts[i])).most_common(6)], str(ids[i])))
    counts = [counted(texts[i]) for i in order]
    label = np.array([labels[i] for i in order])
    taken = (max(1, int((label > 0).sum())), max(1, int((label == 0).sum())))
    votes = np.where(label > 0, totals[0] / taken[0], totals[1] / taken[1])
    own = Index([(list(c), np.array(list(c.values()), float)) for c in counts], label, votes / max(votes.min(initial=1e300), 1e-9), [ids[i] for i in order], totals[0] / max(1, sum(totals)))
    own.calibrate([{own.number[t]: n for t, n in c.items()} for c in counts])
    return own


def fit(docs: DataFrame, labels: DataFrame, label_column: str = "toxic", id_column: str = "doc_id", text_column: str = "text", most: int = MOST_EXAMPLES) -> Index | None:
    """Learns from at most `most` labelled rows of each label value; labels other than 0 count as toxic."""
    rows, totals = sample(docs, labels, label_column, most, id_column, text_column)
    if not totals:
        return None
    got = rows.select(id_column, "text", "label").toArrow()  # at most `most` rows for each label value
    ids, texts, label = (got.column(k).to_pylist() for k in range(3))
    toxic = sum(n for value, n in totals.items() if value)
    return index_of([t.encode() for t in texts], [int(v != 0) for v in label], ids, (toxic, sum(totals.values()) - toxic))


def score(docs: DataFrame, index: Index | None, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.7) -> DataFrame:
    """score, predicted, and the evidence: the neighbours' ids and cosines."""
    docs = docs.select(id_column, text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(index)  # bounded: the terms of at most MOST_EXAMPLES rows of each label

    def run(batches):
        own = sent.value
        known = Cache(CACHE_WORDS)
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            scores, ids, cosines = [], [], []
            for i, j in slices(offsets, SLICE_BYTES):
                for row in range(i, j):
                    value, found, near = 0.0, (), np.zeros(0)
                    if own is not None:
                        counts: dict[int, int] = {}
                        for word, n in Counter(words_of(data[offsets[row] : offsets[row + 1]].tobytes())).items():
                            if (mine := known.get(word)) is None:
                                known.room(1)
                                mine = known[word] = tuple(own.number[t] for t in terms_of(word) if t in own.number)
                            for t in mine:
                                counts[t] = counts.get(t, 0) + n
                        value, found, near = own.score(counts)
                    scores.append(value)
                    ids.append([own.ids[k] for k in found])
                    cosines.append(near.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(ids, pa.list_(batch.schema.field(0).type)), pa.array(cosines, pa.list_(pa.float64()))], names=[id_column, "score", "predicted", "neighbours", "cosines"])

    return docs.mapInArrow(run, f"`{id_column}` {kind}, score double, predicted int, neighbours array<{kind}>, cosines array<double>")
