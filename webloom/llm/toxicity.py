"""Toxicity severity by cumulative-link ordinal regression over sparse text features.

P(grade > k | x) = sigmoid(w.x - b_k) with one weight vector w for all thresholds b_1 <= b_2 <= ...; the
expected severity is the sum of these probabilities. Features are the distinct words of a text (maximal runs of
ASCII letters, digits and non-ASCII characters, A-Z lower-cased) and their stems (the first ``STEM`` bytes of a longer
word, which inflected forms share), by 64-bit hash. The vocabulary holds the features whose document
frequencies differ significantly between grade 0 and the rest in the training sample.

Training uses at most ``max_rows`` labelled documents, those with the smallest hash of their id (a documented
bound: the sample's words are the only thing collected). ``labels`` may carry grades; if it only carries 0/1, the
positive documents are graded 1 or 2 by whether their share of marker words (words that are significantly more
frequent among them) is above the median. Scoring covers every document and whole texts: one pass of array code per
slice of documents, the weights being a few thousand numbers.

Defined cases: null and empty text have no features. Scores are per input row, so null or repeated doc_ids
and repeated rows stay one output row each. Label rows without doc_id or label are ignored, conflicting labels of
one doc_id count as the largest. Without labelled rows, or with a single grade, there is nothing to learn: every
document gets severity 0 or that grade. Extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm import textarrays as ta

MAX_ROWS = 16_000
MIN_DOCS = 3
STEM = 5
MIN_Z = 2.5
STEPS = 300
#: P(grade > 0) from which a document is called toxic; toxic documents are rare, so the even odds of 0.5 miss many.
THRESHOLD = 0.3

SEPARATOR = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def occurrences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the words and stems of each text."""
    data, offsets = ta.text_bytes(column)
    starts, ends, first = ta.word_spans(data, offsets, SEPARATOR)
    rows = np.repeat(np.arange(len(column)), np.diff(first))
    long = ends - starts > STEM
    stems = ta.mix(ta.word_hashes(data, starts[long], starts[long] + STEM, lower=True))
    return np.concatenate([rows, rows[long]]), np.concatenate([ta.word_hashes(data, starts, ends, lower=True), stems])


def feature_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct features of each text."""
    rows, hashes = occurrences(column)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


@dataclass
class Model:
    """Weights by feature hash (sorted) and the ordered thresholds."""

    words: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def scores(self, column: pa.Array) -> np.ndarray:
        """w.x for each text."""
        if not len(self.words):
            return np.zeros(len(column))
        rows, hashes = occurrences(column)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        hit = np.flatnonzero(self.words[at] == hashes)
        pairs = np.unique(rows[hit] * len(self.words) + at[hit])  # a feature counts once in a text
        return np.bincount(pairs // len(self.words), self.weights[pairs % len(self.words)], minlength=len(column))

    def above(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for every text and threshold."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - scores[:, None], -50, 50)))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = MAX_ROWS):
    """(labels array, doc index array, word hash array) of the bounded training sample."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull())
              .groupBy("doc_id").agg(F.max(label_col).cast("int").alias("grade"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in ta.slices(batch.column("text")):
                rows, hashes = feature_hashes(batch.column("text")[first:last])
                ends = np.searchsorted(rows, np.arange(last - first + 1)).astype(np.int32)
                words = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[first:last], batch.column("grade")[first:last], words],
                    names=["doc_id", "grade", "words"])

    both = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "grade", "text")
    schema = f"doc_id {both.schema['doc_id'].dataType.simpleString()}, grade int, words array<bigint>"
    table = both.mapInArrow(run, schema).toArrow().sort_by("doc_id")
    words = table["words"].combine_chunks()
    sizes = np.asarray(words.value_lengths())
    return (np.asarray(table["grade"]), np.repeat(np.arange(len(table)), sizes),
            np.asarray(words.flatten()).view(np.uint64))


def significant(word: np.ndarray, row: np.ndarray, positive: np.ndarray, n_words: int) -> np.ndarray:
    """z of the difference between a word's document frequencies among positive and other documents."""
    n1, n0 = positive.sum(), (~positive).sum()
    d1 = np.bincount(word, positive[row], n_words)
    d0 = np.bincount(word, ~positive[row], n_words)
    if not n1 or not n0:
        return np.zeros(n_words)
    share = (d1 + d0 + 1) / (n1 + n0 + 2)
    return (d1 / n1 - d0 / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    grade, row, hashes = training_rows(docs, labels, label_col, max_rows)
    return fit_rows(grade, row, hashes)


def fit_rows(grade: np.ndarray, row: np.ndarray, hashes: np.ndarray, l2: float = 1e-4, steps: int = STEPS) -> Model:
    """Maximum likelihood by Adam over all training rows; thresholds kept in order by positive gaps."""
    none = np.empty(0, np.uint64), np.empty(0)
    if not len(grade) or grade.min() == grade.max():
        top = int(grade.max()) if len(grade) else 0
        return Model(*none, np.array([-50.0] * top + [50.0]))
    words, word = np.unique(hashes, return_inverse=True)
    z = significant(word, row, grade > 0, len(words))
    grade = severity(grade, row, word, z)
    use = (np.abs(z) >= MIN_Z) & (np.bincount(word, minlength=len(words)) >= MIN_DOCS)
    new_id = np.cumsum(use) - 1
    keep = use[word]
    row, word, words = row[keep], new_id[word[keep]], words[use]
    top = int(grade.max())
    reached = np.array([(grade > k).mean() for k in range(top)]).clip(1e-6, 1 - 1e-6)
    start = -np.log(reached / (1 - reached))
    gaps = np.maximum(np.diff(start), 1e-3)
    params = np.concatenate([np.zeros(len(words)), start[:1], np.log(gaps)])
    m, v, n = np.zeros_like(params), np.zeros_like(params), len(grade)
    for step in range(1, steps + 1):
        w, cuts = params[:len(words)], np.cumsum(np.concatenate([params[len(words):len(words) + 1], np.exp(params[len(words) + 1:])]))
        score = np.bincount(row, w[word], n)
        above = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -50, 50)))
        edge = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
        upper, lower = edge[np.arange(n), grade], edge[np.arange(n), grade + 1]
        # d log(upper - lower) / d score and / d each threshold
        slope = edge * (1 - edge)
        p = np.maximum(upper - lower, 1e-12)
        up, low = slope[np.arange(n), grade] / p, slope[np.arange(n), grade + 1] / p
        g_score = low - up
        g_cuts = np.array([up[grade == k + 1].sum() - low[grade == k].sum() for k in range(top)]) / n
        after = np.cumsum(g_cuts[::-1])[::-1]
        g = np.concatenate([
            np.bincount(word, g_score[row], len(words)) / n + l2 * w,
            after[:1], after[1:] * np.exp(params[len(words) + 1:])])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    cuts = np.cumsum(np.concatenate([params[len(words):len(words) + 1], np.exp(params[len(words) + 1:])]))
    return Model(words, params[:len(words)], cuts)


def severity(grade: np.ndarray, row: np.ndarray, word: np.ndarray, z: np.ndarray) -> np.ndarray:
    """0/1 labels as grades 0, 1, 2 by the share of marker words; labels with more grades stay."""
    if grade.max() > 1:
        return grade
    share = np.bincount(row, z[word] >= MIN_Z, len(grade)) / np.maximum(np.bincount(row, minlength=len(grade)), 1)
    return grade + ((grade > 0) & (share > np.median(share[grade > 0])))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, expected_severity, severity, toxic) of every row; severity is the likeliest grade, toxic is grade > 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in ta.slices(batch.column("text")):
                above = model.above(model.scores(batch.column("text")[first:last]))
                edge = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[first:last], pa.array(above.sum(axis=1)),
                    pa.array((edge[:, :-1] - edge[:, 1:]).argmax(axis=1).astype(np.int32)),
                    pa.array(above[:, 0] >= THRESHOLD)], names=["doc_id", "expected_severity", "severity", "toxic"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, expected_severity double, severity int, toxic boolean")
