"""Toxicity severity by cumulative-link ordinal regression on sparse word features.

A document's features are which of the chosen words it holds. One weight vector is shared
by all ordered thresholds: P(grade <= k) = sigmoid(threshold_k - w.x). The expected severity
is the sum of P(grade >= k). The model is fitted on a bounded sample of labelled rows
(SAMPLE rows, those with the smallest hash of doc_id); every document is scored.

Grades: 0 for rows that are not labelled toxic. Toxic rows are graded 1 to GRADES - 1 by how
many words they hold that set the toxic rows of the sample apart, at the quantiles of that
count; equal counts get equal grades. A ``severity`` column in the labels is taken as it is.

Defined cases: null text has no words and gets the score of an empty document; labels that
are null or of unknown documents are ignored; without labelled toxic rows every severity is
0; repeated documents are scored one by one; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillforge.llm.words import PLAIN, slices, words_of

SAMPLE = 8_000
GRADES = 4
#: Words that are features: those whose presence differs most between toxic and other rows.
FEATURES = 512
LEAST_ROWS = 4
#: The 5 % point of chi-square with one degree of freedom.
LEAST_CHI = 3.84
ROUNDS, STEP, RIDGE = 400, 0.1, 1e-4
THRESHOLD = 0.5


def _held(batches):
    """Distinct word hashes of every row."""
    for batch in batches:
        text = batch.column("text")
        for lo, hi in slices(text):
            words = words_of(text.slice(lo, hi - lo), PLAIN)
            own = [np.unique(words.hashes[a:b]).view(np.int64) for a, b in zip(words.first[:-1], words.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.list_(pa.int64())), batch.column("toxic").slice(lo, hi - lo), batch.column("severity").slice(lo, hi - lo)],
                names=["words", "toxic", "severity"],
            )


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Chosen words (sorted hashes), their weights and the ordered thresholds."""

    def __init__(self, words: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.words, self.weights, self.thresholds = words, weights, thresholds

    def at_least(self, total: np.ndarray) -> np.ndarray:
        """P(grade >= k), a column for each k from 1."""
        return _sigmoid(total[:, None] - self.thresholds) if len(self.thresholds) else np.zeros((len(total), 1))

    def totals(self, hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        if not len(self.words):
            return np.zeros(n)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        met = self.words[at] == hashes
        once = np.unique(rows[met] * len(self.words) + at[met])
        return np.bincount(once // len(self.words), self.weights[once % len(self.words)], minlength=n)


def _choose(flat: np.ndarray, row: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Sorted hashes of the words with the largest chi-square between the classes."""
    words, at = np.unique(flat, return_inverse=True)
    held = np.bincount(at, minlength=len(words)).astype(float)
    in_toxic = np.bincount(at, toxic[row], minlength=len(words))
    share = toxic.mean()
    chi = (in_toxic - held * share) ** 2 / np.maximum(held * share * (1 - share), 1e-9)
    chi[held < LEAST_ROWS] = 0
    order = np.lexsort((words, -chi))[:FEATURES]
    return np.sort(words[order[chi[order] > LEAST_CHI]])


def _grades(count: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    cuts = np.quantile(count[toxic == 1], np.arange(1, GRADES - 1) / (GRADES - 1))
    return np.where(toxic == 1, 1 + (count[:, None] > cuts).sum(axis=1), 0)


def train(words: list[np.ndarray], toxic: np.ndarray, severity: np.ndarray | None = None) -> Model:
    """Full-batch gradient descent with momentum on the likelihood of the grades."""
    none = np.zeros(0)
    if not len(words) or not toxic.any():
        return Model(np.zeros(0, np.uint64), none, none)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    flat = np.concatenate(words).view(np.uint64)
    chosen = _choose(flat, row, toxic)
    at = np.searchsorted(chosen, flat) if len(chosen) else np.zeros(len(flat), np.int64)
    at[at == len(chosen)] = 0
    met = chosen[at] == flat if len(chosen) else np.zeros(len(flat), bool)
    row, at = row[met], at[met]
    n, width = len(words), len(chosen)
    if severity is None:
        held = np.bincount(at, minlength=width)
        leaning = np.bincount(at, toxic[row], minlength=width) > held * toxic.mean()
        severity = _grades(np.bincount(row, leaning[at], minlength=n), toxic)
    levels = np.unique(severity)[1:]
    over = (severity[:, None] >= levels).astype(float)
    weights = np.zeros(width)
    thresholds = -np.log(np.clip(over.mean(axis=0), 1e-6, 1 - 1e-6) / np.clip(1 - over.mean(axis=0), 1e-6, 1))
    moment = [np.zeros(width), np.zeros(width), np.zeros(len(levels)), np.zeros(len(levels))]
    upper = np.concatenate([[0], np.arange(1, len(levels) + 1)])[np.searchsorted(levels, severity, side="right")]
    for t in range(1, ROUNDS + 1):
        total = np.bincount(row, weights[at], minlength=n)
        edge = np.concatenate([np.full((n, 1), 1.0), _sigmoid(total[:, None] - thresholds), np.zeros((n, 1))], axis=1)
        slope = edge * (1 - edge)
        rows = np.arange(n)
        chance = np.maximum(edge[rows, upper] - edge[rows, upper + 1], 1e-9)
        by_total = (slope[rows, upper] - slope[rows, upper + 1]) / chance
        by_threshold = np.zeros((n, len(levels) + 2))
        by_threshold[rows, upper] -= slope[rows, upper] / chance
        by_threshold[rows, upper + 1] += slope[rows, upper + 1] / chance
        grads = (
            np.bincount(at, by_total[row], minlength=width) / n - RIDGE * weights,
            by_threshold[:, 1:-1].sum(axis=0) / n,
        )
        for k, (value, grad) in enumerate(zip((weights, thresholds), grads)):
            moment[2 * k] = 0.9 * moment[2 * k] + 0.1 * grad
            moment[2 * k + 1] = 0.99 * moment[2 * k + 1] + 0.01 * grad**2
            value += STEP * (moment[2 * k] / (1 - 0.9**t)) / (np.sqrt(moment[2 * k + 1] / (1 - 0.99**t)) + 1e-6)
        thresholds[:] = np.maximum.accumulate(thresholds + np.arange(len(levels)) * 1e-6)
    return Model(chosen, weights, thresholds)


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    graded = dict(labels.dtypes).get("severity") in ("tinyint", "smallint", "int", "bigint")
    marks = labels.filter("toxic is not null").select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"), (F.col("severity").cast("int") if graded else F.lit(None).cast("int")).alias("severity")
    )
    # The sample is drawn from the labels alone, so that the texts of other rows stay where they are.
    known = documents.select("doc_id").filter("doc_id is not null")
    drawn = marks.join(known, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id", "toxic", "severity").limit(sample)
    texts = documents.select("doc_id", "text").join(drawn, "doc_id").select("text", "toxic", "severity")
    got = texts.mapInArrow(_held, "words array<bigint>, toxic int, severity int").toArrow()
    words = [np.array(w, np.int64) for w in got.column("words").to_pylist()]
    toxic = np.array(got.column("toxic").to_pylist(), float)
    given = got.column("severity").to_pylist()
    return train(words, toxic, np.array(given) if graded and None not in given else None)


def severity(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, expected_severity, severity`` (most likely grade), ``toxic``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            for lo, hi in slices(text):
                words = words_of(text.slice(lo, hi - lo), PLAIN)
                chance = shared.value.at_least(shared.value.totals(words.hashes, words.rows, hi - lo))
                full = np.concatenate([np.ones((hi - lo, 1)), chance, np.zeros((hi - lo, 1))], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo).cast(pa.int64()),
                        pa.array(chance.sum(axis=1)),
                        pa.array((full[:, :-1] - full[:, 1:]).argmax(axis=1), pa.int32()),
                        pa.array(chance[:, 0] >= THRESHOLD),
                    ],
                    names=["doc_id", "expected_severity", "severity", "toxic"],
                )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, expected_severity double, severity int, toxic boolean")


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return severity(documents, fit(documents, labels))
