"""Approximate nearest neighbours: a forest of random-projection trees, exact reranking.

Trees are grown on a bounded sample: a node is split by the hyperplane between two of its
points. Every vector is then indexed: it falls into one leaf of each tree. A query walks
all trees at once through one priority queue of nodes, ordered by the smallest margin to a
hyperplane on the way, until the leaves it has opened hold enough sample points. Its
candidates are all indexed vectors of these leaves, ranked by their exact distance.

Of equal vectors only the first ``k + 1`` ids can be among the ``k`` nearest of any query
(ties go to the smaller id), so further copies are set aside before the index: no leaf
grows with them, and results are the same.

Defined cases: vectors that are null, empty, zero, of another width than most of the table, or hold null
or non-finite components take no part, as queries or candidates; so do rows without an id;
repeated rows of one id and vector count once; fewer candidates than ``k``: all that were
found; no vectors, no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillforge.llm.store import keep
from tillforge.session import work_dir

TREES = 24
#: Vectors that the trees are grown on; all vectors are indexed.
SAMPLE = 20_000
LEAF = 24
#: Share of the sample that the opened leaves hold together, over all trees. Vectors without
#: clusters, as those of the query, need this much for a recall of 0.9.
OPENED = 0.5
#: The opened leaves hold this many vectors of the sample at least, over all trees.
LEAST = 4000
#: Queries that the driver holds and sends at once, and vectors met with them at once.
QUERIES, ROWS = 1024, 2048


class Tree:
    """Nodes in arrays: ``left`` of a leaf is -1."""

    def __init__(self, points: np.ndarray, rng):
        self.normal, self.offset, self.left, self.right, self.held = [], [], [], [], []
        self._grow(points, rng)
        self.normal = np.array(self.normal)
        self.offset, self.left, self.right, self.held = (np.array(v) for v in (self.offset, self.left, self.right, self.held))

    def _grow(self, points, rng) -> int:
        todo, at = [(points, None, None)], 0
        while todo:
            own, parent, side = todo.pop()
            at = len(self.left)
            if parent is not None:
                (self.left if side == 0 else self.right)[parent] = at
            normal, offset = np.zeros(points.shape[1]), 0.0
            under = None
            if len(own) > LEAF:
                for _ in range(3):
                    a, b = own[rng.choice(len(own), 2, replace=False)]
                    normal = a - b
                    offset = float(normal @ (a + b)) / 2
                    under = own @ normal < offset
                    if 0 < under.sum() < len(own):
                        break
                    under = None
            self.normal.append(normal if under is not None else np.zeros(points.shape[1]))
            self.offset.append(offset)
            self.left.append(-1)
            self.right.append(-1)
            self.held.append(len(own))
            if under is not None:
                todo += [(own[under], at, 0), (own[~under], at, 1)]
        return at

    def leaves(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        at = np.zeros(len(rows), np.int64)
        going = np.arange(len(rows)) if self.left[0] >= 0 else np.zeros(0, np.int64)
        while len(going):
            node = at[going]
            under = (rows[going] * self.normal[node]).sum(axis=1) < self.offset[node]
            at[going] = np.where(under, self.left[node], self.right[node])
            going = going[self.left[at[going]] >= 0]
        return at


class Forest:
    def __init__(self, sample: np.ndarray, trees: int = TREES):
        rng = np.random.default_rng(11)
        self.trees = [Tree(sample, rng) for _ in range(trees)]
        self.size = len(sample)

    def open_leaves(self, query: np.ndarray, share: float = OPENED) -> list[tuple[int, int]]:
        """``(tree, leaf)`` in the order of the shared queue."""
        margins = [(t.normal @ query - t.offset) / np.maximum(np.linalg.norm(t.normal, axis=1), 1e-300) for t in self.trees]
        queue = [(0.0, k, 0) for k in range(len(self.trees))]
        opened, held, wanted = [], 0, max(LEAST, share * self.size)
        while queue and held < wanted:
            far, k, node = heapq.heappop(queue)
            tree = self.trees[k]
            if tree.left[node] < 0:
                opened.append((k, node))
                held += int(tree.held[node])
                continue
            margin = float(margins[k][node])
            near, other = (tree.left[node], tree.right[node]) if margin < 0 else (tree.right[node], tree.left[node])
            heapq.heappush(queue, (far, k, int(near)))
            heapq.heappush(queue, (max(far, abs(margin)), k, int(other)))
        return opened


def _rows(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def width_of(vectors: DataFrame) -> int:
    """The width most vectors have, of equally frequent ones the smaller; 0 without vectors."""
    sizes = vectors.filter("vec_id is not null and size(embedding) > 0").groupBy(F.size("embedding").alias("width")).count()
    row = sizes.orderBy(F.desc("count"), "width").first()
    return row.width if row else 0


def usable(vectors: DataFrame, width: int | None = None) -> DataFrame:
    """``vec_id, embedding`` in double precision; only rows that take part."""
    given = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = given.filter("vec_id is not null and embedding is not null and size(embedding) > 0").filter(
        ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0)
    )
    return fine.filter(F.size("embedding") == (width_of(fine) if width is None else width))


class _Nearest:
    """The ``k`` nearest seen so far, per query."""

    def __init__(self, k: int, queries: int):
        self.k = k
        self.gaps, self.ids = [np.zeros(0)] * queries, [np.zeros(0, np.int64)] * queries

    def add(self, query: int, gaps: np.ndarray, ids: np.ndarray) -> None:
        held = self.gaps[query]
        if len(held) == self.k:
            near = gaps <= held[-1]
            gaps, ids = gaps[near], ids[near]
        if not len(gaps):
            return
        gaps, ids = np.concatenate([held, gaps]), np.concatenate([self.ids[query], ids])
        order = np.lexsort((ids, gaps))
        # A vector may stand under one id several times; it counts once.
        order = order[np.sort(np.unique(ids[order], return_index=True)[1])][: self.k]
        self.gaps[query], self.ids[query] = gaps[order], ids[order]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, opened: float = OPENED) -> DataFrame:
    """``query_id, rank, vec_id, score`` for each of the ``queries`` rows.

    Queries go through in blocks of about ``QUERIES``: the driver walks the forest for a
    block and sends the opened leaves to all tasks, which scan the index. A vector that
    shares a leaf with a query in several trees is measured once. A task returns ``k`` rows a
    query, no pairs and no vectors are shuffled.
    """
    spark = vectors.sparkSession
    rows = keep(usable(vectors).dropDuplicates(["vec_id", "embedding"]), "ann-rows")
    first = rows.first()
    path, found = work_dir(spark, "ann-found"), "query_id bigint, vec_id bigint, score double"
    spark.createDataFrame([], found).write.parquet(f"{path}/block=-1")
    if first is not None:
        same = Window.partitionBy("embedding").orderBy("vec_id")
        few = rows.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= k + 1).drop("copy")
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
        forest = Forest(np.stack(sample["embedding"].to_numpy()))
        index = keep(_index(few, spark.sparkContext.broadcast(forest)), "ann-index")
        asked = usable(queries, len(first.embedding)).dropDuplicates(["vec_id", "embedding"])
        blocks = max(1, -(-asked.count() // QUERIES))
        for block in range(blocks):
            held = asked.filter(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)) == block).toPandas()
            if len(held):
                points = np.stack(held["embedding"].to_numpy())
                leaves = [np.zeros((len(t.left), len(points)), bool) for t in forest.trees]
                for q, point in enumerate(points):
                    for tree, leaf in forest.open_leaves(point, opened):
                        leaves[tree][leaf, q] = True
                leaves = [np.packbits(open_, axis=1) for open_ in leaves]
                sent = spark.sparkContext.broadcast((held["vec_id"].to_numpy(), points, leaves))
                _measured(index, sent, k).write.parquet(f"{path}/block={block}")
                sent.unpersist()
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    scored = spark.read.schema(f"{found}, block int").parquet(path).drop("block")
    some = scored.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return some.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _index(rows: DataFrame, forest) -> DataFrame:
    """Every vector with its leaf in each tree."""

    def run(batches):
        for batch in batches:
            points = _rows(batch.column("embedding"))
            leaves = np.stack([t.leaves(points) for t in forest.value.trees], axis=1).astype(np.int32)
            column = pa.ListArray.from_arrays(np.arange(0, leaves.size + 1, leaves.shape[1], dtype=np.int32), leaves.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=["vec_id", "embedding", "leaves"])

    return rows.select("vec_id", "embedding").mapInArrow(run, "vec_id bigint, embedding array<double>, leaves array<int>")


def _measured(index: DataFrame, sent, k: int) -> DataFrame:
    def run(batches):
        queries, points, opened = sent.value
        best = _Nearest(k, len(queries))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids, own = batch.column("vec_id").to_numpy(), _rows(batch.column("embedding"))
                leaves = _rows(batch.column("leaves")).astype(np.int64)
                met = np.zeros((len(ids), opened[0].shape[1]), np.uint8)
                for tree, open_ in enumerate(opened):
                    met |= open_[leaves[:, tree]]
                met = np.unpackbits(met, axis=1, count=len(queries)).astype(bool)
                met &= ids[:, None] != queries[None, :]
                for q in np.flatnonzero(met.any(axis=0)):
                    near = np.flatnonzero(met[:, q])
                    gap = points[q] - own[near]
                    best.add(q, np.sqrt((gap * gap).sum(axis=1)), ids[near])
        counts = [len(i) for i in best.ids]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(queries, counts)), pa.array(np.concatenate(best.ids)), pa.array(np.concatenate(best.gaps))],
            names=["query_id", "vec_id", "score"],
        )

    return index.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
