"""Quality classifier: random Fourier features of document statistics, ridge, isotonic.

Statistics of the whole text (shares of character kinds, word lengths, repetition) are
standardised and mapped by cosines of random directions, which approximates a Gaussian
kernel. Every partition sums its part of the normal equations, one sum a fold; the driver
solves systems of fixed size. The calibration is fitted on out-of-fold predictions, first
summed into a fixed number of bins, by pooling adjacent violators. Only the text is an
input of a score.

Defined cases: null text is empty and is scored from its (zero) statistics; labels that are
null or of unknown documents are ignored; several labels of a document are several rows;
repeated documents are scored one by one; without any label to learn from every score is 1,
since nothing speaks against a document; held_out is false without a doc_id; extra columns
are ignored or passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillforge.llm.store import keep
from tillforge.llm.words import SPACED, slices, text_bytes, words_of

FEATURES = 256
RIDGE = 1e-3
#: The kernel's width in standard deviations of the statistics.
WIDTH = 4.0
BINS = 2048
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2

KINDS = {
    "lower": range(ord("a"), ord("z") + 1),
    "upper": range(ord("A"), ord("Z") + 1),
    "digit": range(ord("0"), ord("9") + 1),
    "blank": [0x20],
    "line": [0x0A],
    "stop": [ord(c) for c in ".,;:?!"],
    "sign": [*range(0x21, 0x2C), ord("-"), ord("/"), *range(0x3C, 0x3F), *range(0x40, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)],
    "control": [*range(0x0A), *range(0x0B, 0x20), 0x7F],
    "wide": range(0x80, 0x100),
}
STATISTICS = [*KINDS, "length", "words", "word_mean", "word_spread", "distinct", "top", "line_words", "repeated_lines", "long_words"]
COLUMN = "statistics"


def statistics(text: pa.Array) -> np.ndarray:
    """A line of statistics per row; all are shares, logarithms or bounded means."""
    data, borders = text_bytes(text)
    raw = np.frombuffer(data, np.uint8)
    n = len(borders) - 1
    size = np.diff(borders)
    out = np.zeros((n, len(STATISTICS)))
    kind_of = np.full(256, len(KINDS), np.int64)
    for k, codes in enumerate(KINDS.values()):
        kind_of[list(codes)] = k
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * (len(KINDS) + 1) + kind_of[raw], minlength=n * (len(KINDS) + 1)).reshape(n, -1)
    out[:, : len(KINDS)] = kinds[:, : len(KINDS)] / np.maximum(size, 1)[:, None]
    words = words_of(text, SPACED)
    counts = words.counts
    filled = np.maximum(counts, 1)
    of_row = words.rows
    length_sum = np.bincount(of_row, words.lengths, minlength=n)
    square_sum = np.bincount(of_row, words.lengths.astype(float) ** 2, minlength=n)
    mean = length_sum / filled
    at = len(KINDS)
    out[:, at] = np.log1p(size)
    out[:, at + 1] = np.log1p(counts)
    out[:, at + 2] = np.log1p(mean)
    out[:, at + 3] = np.log1p(np.sqrt(np.maximum(square_sum / filled - mean**2, 0)))
    whole = bytes(data)
    for r in range(n):
        own = words.hashes[words.first[r] : words.first[r + 1]]
        if len(own):
            _, times = np.unique(own, return_counts=True)
            out[r, at + 4] = len(times) / len(own)
            out[r, at + 5] = times.max() / len(own)
        lines = whole[borders[r] : borders[r + 1]].split(b"\n")
        out[r, at + 6] = np.log1p(len(own) / len(lines))
        out[r, at + 7] = 1 - len(set(lines)) / len(lines)
    out[:, at + 8] = np.bincount(of_row, words.lengths > 20, minlength=n) / filled
    return out


def with_statistics(documents: DataFrame) -> DataFrame:
    """``doc_id`` and its statistics; written by callers that need them more than once."""

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            rows = [statistics(text.slice(lo, hi - lo)) for lo, hi in slices(text)]
            flat = np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), lists], names=["doc_id", COLUMN])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id bigint, {COLUMN} array<double>")


def directions(inputs: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed random directions and phases."""
    rng = np.random.default_rng(7)
    return rng.standard_normal((inputs, FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES)


def fourier(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Cosine features with a leading constant."""
    ways, phases = directions(rows.shape[1])
    waves = np.sqrt(2 / FEATURES) * np.cos(np.clip((rows - mean) / scale, -8, 8) @ ways + phases)
    return np.concatenate([np.ones((len(rows), 1)), waves], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64).reshape(len(column), len(STATISTICS))


def pool_adjacent_violators(at: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the best non-decreasing fit to the bins' means."""
    blocks: list[list[float]] = []
    for x, t, w in zip(at, total, weight):
        blocks.append([x * w, t, w, x, x])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [*(a + b for a, b in zip(blocks[-1][:3], last[:3])), blocks[-1][3], last[4]]
    xs, ys = [], []
    for _, t, w, low, high in blocks:
        for x in sorted({low, high}):
            xs.append(x)
            ys.append(t / w)
    return np.array(xs), np.array(ys)


def fold(doc_id) -> F.Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


class Model:
    """Everything a score needs; of fixed size."""

    def __init__(self, mean, scale, weights, knots):
        self.mean, self.scale, self.weights, self.knots = mean, scale, weights, knots

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(rows))
        raw = fourier(rows, self.mean, self.scale) @ self.weights
        return np.clip(np.interp(raw, *self.knots), 0, 1)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Learns from ``labels(doc_id, quality)`` of the folds that are not held out."""
    spark = stats.sparkSession
    marked = labels.filter("quality is not null").select("doc_id", F.col("quality").cast("double").alias("y"))
    marked = marked.withColumn("fold", fold(F.col("doc_id")).cast("int")).filter(F.col("fold") != HELD_OUT)
    rows = keep(stats.filter("doc_id is not null").join(marked, "doc_id").select("fold", "y", COLUMN), "quality-rows")

    moments = [F.avg(F.col(COLUMN)[k]) for k in range(len(STATISTICS))] + [F.stddev_pop(F.col(COLUMN)[k]) for k in range(len(STATISTICS))]
    got = rows.agg(*moments).first()
    if got[0] is None:
        return Model(None, None, None, None)
    mean = np.array(got[: len(STATISTICS)])
    scale = np.maximum(np.array(got[len(STATISTICS) :]), 1e-6)
    width = FEATURES + 1

    def partial_sums(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            waves = fourier(_matrix(batch.column(COLUMN)), mean, scale)
            y, folds = batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            for f in np.unique(folds).tolist():
                own = waves[folds == f]
                part = np.concatenate([own.T @ own, (own.T @ y[folds == f])[:, None]], axis=1)
                sums[f] = sums.get(f, 0) + part
        for f, part in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * width, pa.int32()), pa.array(range(width), pa.int32()), pa.array(part.tolist(), pa.list_(pa.float64()))],
                names=["fold", "i", "line"],
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(width + 1)
        for line in table.column("line").to_pylist():
            total += line
        return pa.table({"fold": table.column("fold")[:1], "i": table.column("i")[:1], "line": pa.array([total.tolist()])})

    schema = "fold int, i int, line array<double>"
    summed = rows.mapInArrow(partial_sums, schema).groupBy("fold", "i").applyInArrow(add, schema)
    equations: dict[int, np.ndarray] = {}
    for r in summed.toLocalIterator():  # FOLDS * width rows of fixed width
        equations.setdefault(r.fold, np.zeros((width, width + 1)))[r.i] = r.line

    def solve(folds) -> np.ndarray:
        both = sum((equations[f] for f in folds), np.zeros((width, width + 1)))
        ridge = RIDGE * max(both[0, 0], 1) * np.eye(width) / FEATURES
        ridge[0, 0] = 1e-9
        return np.linalg.solve(both[:, :width] + ridge, both[:, width])

    final = solve(equations)
    without = {f: solve([g for g in equations if g != f]) if len(equations) > 1 else final for f in equations}

    def out_of_fold(batches):
        for batch in batches:
            waves, folds = fourier(_matrix(batch.column(COLUMN)), mean, scale), batch.column("fold").to_numpy()
            raw = np.zeros(len(folds))
            for f in np.unique(folds).tolist():
                raw[folds == f] = waves[folds == f] @ without[f]
            bins = np.clip(np.round((raw + 0.5) / 2 * BINS), 0, BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("y")], names=["bin", "y"])

    bins = rows.mapInArrow(out_of_fold, "bin int, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n"))
    got = sorted((r.bin, r.y, r.n) for r in bins.collect())  # at most BINS + 1 rows
    at, total, weight = (np.array(v, float) for v in zip(*got))
    return Model(mean, scale, final, pool_adjacent_violators(at / BINS * 2 - 0.5, total, weight))


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of rows with statistics."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            got = shared.value.score(_matrix(batch.column(COLUMN)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got)], names=["doc_id", "score"])

    held_out = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False))
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return stats.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted")
    )


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    stats = keep(with_statistics(documents), "quality-statistics")
    return score(stats, fit(stats, labels))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """All columns of the documents that are predicted to be good; each row by its own text."""
    stats = keep(with_statistics(documents), "quality-statistics")
    shared = documents.sparkSession.sparkContext.broadcast(fit(stats, labels))

    def run(batches):
        for batch in batches:
            text = batch.column("text")
            good = [shared.value.score(statistics(text.slice(lo, hi - lo))) >= THRESHOLD for lo, hi in slices(text)]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return documents.mapInArrow(run, documents.schema)
