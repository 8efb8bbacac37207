"""Hard negatives by Kronecker-packed products.

Components become whole numbers, ``floor(256 * x)``. For many candidates at once, one
component of each is made non-negative by a bias and put into a field of one wide integer,
wide enough for a whole inner product. An anchor multiplies each of these integers once by
its own biased component and adds them up: every field of the sum is then one candidate's
biased score, and the biases are taken off again. All of it is whole-number arithmetic, so
scores and ties are exact, whatever the size of the components.

Anchors go through in blocks of about ``ANCHORS``, sent to all tasks. Every block scans the
rows twice: once against rows of the same label for the positives, once against the others
for the negatives in the window under each positive. A task holds the best few rows per
anchor; the few best of all tasks are then ranked by Spark. No row is shuffled, and a third
of all rows under one label is no hot key.

Defined cases: rows with a null id, label or vector, or a null or non-finite component take
no part; rows equal in id, label and vector count once; rows of one id with other vectors
are rows of their own, but never a positive or negative of an anchor of that id; vectors of
other widths are continued by zeros; an anchor without another row of its label, or without
rows in the window, gives no rows; scores beyond a long count as the nearest long; no
vectors, no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillforge.llm.store import keep
from tillforge.session import work_dir

SCALE = 256
#: Anchors that the driver holds and sends at once.
ANCHORS = 4096
POSITIVES, NEGATIVES = 5, 3
#: A negative scores 50 to 95 hundredths of the positive.
LEAST, MOST = 50, 95
#: Candidates in one wide integer.
FIELDS = 2048
LONG = (1 << 63) - 1
_EXACT = 2.0**53


def quantised(vectors: list[np.ndarray]) -> np.ndarray:
    """``floor(256 * x)`` of every component, as int64 or, beyond it, as Python integers."""
    width = max((len(v) for v in vectors), default=0)
    flat = np.zeros((len(vectors), width))
    for row, v in zip(flat, vectors):
        row[: len(v)] = v
    if not flat.size or np.abs(flat).max() < _EXACT / SCALE:
        return np.floor(flat * SCALE).astype(np.int64)
    # From 2 ** 53 on a double is whole.
    whole = [[int(x) * SCALE if abs(x) >= _EXACT else math.floor(x * SCALE) for x in row] for row in flat.tolist()]
    return np.array(whole, object).reshape(flat.shape)


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) if rows.shape[1] < width else rows


class Anchors:
    """Biased anchor components as Python integers."""

    def __init__(self, rows: np.ndarray):
        self.width = rows.shape[1]
        self.bias = max(0, -int(rows.min())) if rows.size else 0
        self.rows = [[int(x) + self.bias for x in row] for row in rows.tolist()]
        self.sums = [sum(row) for row in self.rows]
        self.most = max((max(row, default=0) for row in self.rows), default=0)


class Packed:
    """One wide integer per component, with a field for every candidate."""

    def __init__(self, rows: np.ndarray, anchors: Anchors):
        width = max(rows.shape[1], anchors.width)
        rows = widened(rows, width)
        self.anchors, self.bias = anchors, max(0, -int(rows.min())) if rows.size else 0
        biased = rows + self.bias
        most = width * max(1, int(biased.max()) if rows.size else 0) * max(1, anchors.most, anchors.bias)
        self.bytes = 4 if most < 1 << 32 else 8 if most < 1 << 63 else (most.bit_length() + 7) // 8
        self.count, self.width = len(rows), width
        self.sums = biased.sum(axis=1) if rows.size else np.zeros(len(rows), np.int64)
        if self.bytes <= 8:
            fields = biased.T.astype(f"<u{self.bytes}")
            self.wide = [int.from_bytes(np.ascontiguousarray(f).tobytes(), "little") for f in fields]
        else:
            self.wide = [int.from_bytes(b"".join(int(x).to_bytes(self.bytes, "little") for x in f), "little") for f in biased.T]

    def scores(self, anchor: int) -> np.ndarray:
        """Exact inner products of one anchor with all candidates."""
        own = self.anchors.rows[anchor]
        # An anchor that is narrower goes on with zeros, biased like all its components.
        own = own + [self.anchors.bias] * (self.width - len(own))
        total = sum(map(mul, own, self.wide)).to_bytes(self.bytes * self.count, "little")
        off = self.bias * sum(own) - self.width * self.anchors.bias * self.bias
        if self.bytes <= 8:
            return np.frombuffer(total, f"<u{self.bytes}").astype(np.int64) - self.anchors.bias * self.sums - off
        fields = [int.from_bytes(total[i : i + self.bytes], "little") for i in range(0, len(total), self.bytes)]
        exact = [f - self.anchors.bias * int(s) - off for f, s in zip(fields, self.sums)]
        return np.array([max(-LONG, min(LONG, x)) for x in exact], np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


class _Best:
    """The best rows seen so far, per key."""

    def __init__(self, k: int):
        self.k, self.held = k, {}

    def least(self, key) -> int:
        """Rows below this score cannot enter any more."""
        got = self.held.get(key)
        return int(got[0][-1]) if got is not None and len(got[0]) == self.k else -LONG

    def add(self, key, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            old = self.held.get(key)
            if old is not None:
                scores, ids = np.concatenate([old[0], scores]), np.concatenate([old[1], ids])
            self.held[key] = _first(scores, ids, self.k)

    def batch(self, names: list[str]) -> pa.RecordBatch:
        keys = [key for key, (s, _) in self.held.items() for _ in s]
        columns = [pa.array([key[i] for key in keys], pa.int32()) for i in range(len(names) - 2)]
        joined = [np.concatenate([v[i] for v in self.held.values()]) if self.held else np.zeros(0, np.int64) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*columns, *map(pa.array, joined)], names=names)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1]) if len(column) else []


def _batches(batches):
    """Ids, labels and whole-number rows, at most ``FIELDS`` at once."""
    for whole in batches:
        for at in range(0, whole.num_rows, FIELDS):
            batch = whole.slice(at, FIELDS)
            yield (
                batch.column("vec_id").to_numpy(zero_copy_only=False),
                batch.column("label").to_numpy(zero_copy_only=False),
                quantised(_vectors(batch.column("embedding"))),
            )


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the distinct rows that take part."""
    given = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = given.filter("vec_id is not null and label is not null and embedding is not null")
    return fine.filter(~F.exists("embedding", bad)).distinct()


def _positives(rows: DataFrame, sent) -> DataFrame:
    def run(batches):
        ids, labels, anchors = sent.value
        best = _Best(POSITIVES)
        for vec_ids, own, numbers in _batches(batches):
            for label in np.intersect1d(own, labels):
                mine = own == label
                packed, candidates = Packed(numbers[mine], anchors), vec_ids[mine]
                for a in np.flatnonzero(labels == label):
                    scores = packed.scores(a)
                    some = (candidates != ids[a]) & (scores >= best.least((a,)))
                    best.add((a,), scores[some], candidates[some])
        yield best.batch(["anchor", "score", "vec_id"])

    return rows.mapInArrow(run, "anchor int, score bigint, vec_id bigint")


def _negatives(rows: DataFrame, sent, windows) -> DataFrame:
    def run(batches):
        ids, labels, anchors = sent.value
        best = _Best(NEGATIVES)
        for vec_ids, own, numbers in _batches(batches):
            packed = Packed(numbers, anchors)
            for a, spans in windows.value.items():
                scores = packed.scores(a)
                floor = min(max(low, best.least((a, i))) for i, low, _ in spans)
                some = (scores >= floor) & (scores <= max(high for _, _, high in spans))
                some = np.flatnonzero(some & (own != labels[a]) & (vec_ids != ids[a]))
                if not len(some):
                    continue
                scores, candidates = scores[some], vec_ids[some]
                for i, low, high in spans:
                    inside = (scores >= max(low, best.least((a, i)))) & (scores <= high)
                    best.add((a, i), scores[inside], candidates[inside])
        yield best.batch(["anchor", "positive", "score", "vec_id"])

    return rows.mapInArrow(run, "anchor int, positive int, score bigint, vec_id bigint")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


MINED = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def hard_negatives(vectors: DataFrame, is_anchor, anchors_at_once: int = ANCHORS) -> DataFrame:
    """The hard negatives of each anchor and positive; ``is_anchor`` is a condition on rows."""
    spark = vectors.sparkSession
    rows = keep(usable(vectors), "negatives-rows")
    anchors = rows.filter(is_anchor)
    blocks = max(1, -(-anchors.count() // anchors_at_once))
    place = F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(blocks))
    path = work_dir(spark, "negatives-mined")
    spark.createDataFrame([], MINED).write.parquet(f"{path}/block=-1")
    for block in range(blocks):
        held = anchors.filter(place == block).orderBy("vec_id", "label", "embedding").toPandas()
        if not len(held):
            continue
        ids, labels = held["vec_id"].to_numpy(), held["label"].to_numpy()
        numbers = quantised([np.asarray(v, np.float64) for v in held["embedding"]])
        sent = spark.sparkContext.broadcast((ids, labels, Anchors(numbers)))
        positives = _ranked(_positives(rows, sent), ["anchor"], POSITIVES).collect()
        windows: dict[int, list] = {}
        for i, p in enumerate(positives):
            # Whole bounds of 50 * positive <= 100 * negative <= 95 * positive.
            low, high = -(-LEAST * p.score // 100), MOST * p.score // 100
            if low <= high:
                windows.setdefault(p.anchor, []).append((i, low, high))
        found = _negatives(rows, sent, spark.sparkContext.broadcast(windows))
        known = spark.createDataFrame(
            [(i, int(ids[p.anchor]), p.vec_id, p.score) for i, p in enumerate(positives)],
            "positive int, anchor_id bigint, positive_id bigint, positive_score bigint",
        )
        # At most POSITIVES rows an anchor of this block.
        mined = _ranked(found, ["positive"], NEGATIVES).join(F.broadcast(known), "positive")
        mined.select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        ).write.parquet(f"{path}/block={block}")
        sent.unpersist()
    return spark.read.schema(f"{MINED}, block int").parquet(path).drop("block")


def is_anchor_of_query():
    return F.col("vec_id") % 50 == 0


def relabelled(vectors: DataFrame) -> DataFrame:
    """Where the id is divisible by 7, the label moves on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.withColumn("label", moved)


ORACLE = """
WITH rows_ AS (
    SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label, embedding
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
whole AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM rows_),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.q, c.q)::BIGINT AS score
    FROM whole a, whole c WHERE a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
    (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
    s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3"""
