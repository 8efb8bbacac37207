"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every window of benchmark words is a pattern. Windows of one length form a group with a
block shift table (how far the search may jump when a two-word block ends here), buckets
by the hash of the closing block, and the words themselves for the direct comparison.
Documents are searched where they lie: patterns are sent to the tasks in blocks of
bounded size, one pass a block, and no row is shuffled.

Defined cases: null texts have no words; an item of fewer words than a window is one
window, one without words none; items under one id are one item; an item without an id
marks words but is neither counted nor listed; repeated documents are judged one by one;
no benchmark, no hits. Extra columns of either table are ignored or passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillforge.llm.words import PLAIN, Words, slices, words_of

WINDOW = 10
#: Benchmark text that one pass searches for; more is searched in further passes.
BLOCK_BYTES = 8 << 20
LANE = 512
TABLE_BITS = 18


@dataclass
class Group:
    """Patterns of one length, ordered by their closing block."""

    length: int
    block: int
    shift: np.ndarray
    closing: np.ndarray
    words: np.ndarray
    pattern: np.ndarray


@dataclass
class Patterns:
    vocabulary: np.ndarray
    texts: list[bytes]
    items: list[list[str]]
    groups: list[Group]


def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return ((left * 0x9E3779B1 + right * 0x85EBCA6B) >> 7) & ((1 << TABLE_BITS) - 1)


def _closing(ids: np.ndarray, at: np.ndarray, block: int) -> np.ndarray:
    return ids[at] if block == 1 else (ids[at - 1] << 32) | ids[at]


def build(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Patterns:
    """Search tables for the windows of ``(item_id, text)`` rows."""
    found = words_of(pa.array([t for _, t in items], pa.large_string()), PLAIN)
    owners: dict[tuple[bytes, ...], set[str]] = {}
    for row, (item, _) in enumerate(items):
        words = [found.word(i) for i in range(found.first[row], found.first[row + 1])]
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            owner = owners.setdefault(tuple(words[at : at + size]), set())
            if item is not None:
                owner.add(item)
    windows = list(owners)
    flat = words_of(pa.array([b" ".join(w).decode() for w in windows], pa.large_string()), PLAIN)
    vocabulary = np.unique(flat.hashes)
    ids = np.searchsorted(vocabulary, flat.hashes).astype(np.int64) + 1
    groups = []
    for size in sorted({len(w) for w in windows}):
        members = np.array([i for i, w in enumerate(windows) if len(w) == size])
        matrix = ids[flat.first[members][:, None] + np.arange(size)]
        block = min(2, size)
        shift = np.full(1 << TABLE_BITS, size - block + 1, np.int64)
        for end in range(block - 1, size):
            left = matrix[:, end - 1] if block == 2 else np.zeros(len(matrix), np.int64)
            np.minimum.at(shift, _slot(left, matrix[:, end]), size - 1 - end)
        closing = _closing(matrix.ravel(), np.arange(1, len(matrix) + 1) * size - 1, block)
        order = np.argsort(closing, kind="stable")
        groups.append(Group(size, block, shift, closing[order], matrix[order], members[order]))
    return Patterns(vocabulary, [b" ".join(w) for w in windows], [sorted(owners[w]) for w in windows], groups)


def _search(ids: np.ndarray, group: Group) -> tuple[np.ndarray, np.ndarray]:
    """Last positions and pattern numbers of all occurrences in ``ids`` (0: foreign word).

    The text is cut into lanes of end positions that are searched abreast; each jumps by
    its own shift."""
    size = group.length
    cursor = np.arange(size - 1, len(ids), LANE)
    stop = np.minimum(cursor + LANE, len(ids))
    closed = []
    while len(cursor):
        left = ids[cursor - 1] if group.block == 2 else np.zeros(len(cursor), np.int64)
        jump = group.shift[_slot(left, ids[cursor])]
        closed.append(cursor[jump == 0])
        cursor = cursor + np.maximum(jump, 1)
        going = cursor < stop
        cursor, stop = cursor[going], stop[going]
    at = np.concatenate(closed) if closed else np.zeros(0, np.int64)
    key = _closing(ids, at, group.block)
    low, high = np.searchsorted(group.closing, key), np.searchsorted(group.closing, key, side="right")
    ends, patterns = [], []
    step = 0
    while True:
        open_ = low + step < high
        if not open_.any():
            break
        at, low, high = at[open_], low[open_], high[open_]
        same = (ids[at[:, None] + np.arange(1 - size, 1)] == group.words[low + step]).all(axis=1)
        ends.append(at[same])
        patterns.append(group.pattern[(low + step)[same]])
        step += 1
    none = np.zeros(0, np.int64)
    return np.concatenate(ends) if ends else none, np.concatenate(patterns) if patterns else none


def search(words: Words, patterns: Patterns) -> tuple[np.ndarray, list[set[str]]]:
    """For each word whether it is hit, for each row the items with occurring windows."""
    n, rows = len(words.hashes), len(words.first) - 1
    hit, items = np.zeros(n, bool), [set() for _ in range(rows)]
    if not n or not len(patterns.vocabulary):
        return hit, items
    place = np.searchsorted(patterns.vocabulary, words.hashes)
    place[place == len(patterns.vocabulary)] = 0
    known = np.where(patterns.vocabulary[place] == words.hashes, place + 1, 0)
    row_of = words.rows
    ids = np.zeros(n + rows, np.int64)  # a foreign word between rows: no occurrence spans two
    ids[np.arange(n) + row_of] = known
    for group in patterns.groups:
        ends, found = _search(ids, group)
        if not len(ends):
            continue
        row = np.searchsorted(words.first + np.arange(rows + 1), ends, side="right") - 1
        last = ends - row
        for end, pattern, r in zip(last.tolist(), found.tolist(), row.tolist()):
            start = end - group.length + 1
            if b" ".join(words.word(i) for i in range(start, end + 1)) == patterns.texts[pattern]:
                hit[start : end + 1] = True
                items[r].update(patterns.items[pattern])
    return hit, items


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The benchmark's rows in blocks of bounded size; the driver holds one at a time."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).distinct()
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r.i, r.t) for r in part.collect()]


CARRIED = "hit_words array<int>, hit_items array<string>"


def _pass(patterns, with_earlier: bool):
    def run(batches):
        for batch in batches:
            text = batch.column("text")
            hits, items = [], []
            for lo, hi in slices(text):
                words = words_of(text.slice(lo, hi - lo), PLAIN)
                hit, found = search(words, patterns.value)
                hits += [np.flatnonzero(hit[a:b]).astype(np.int32) for a, b in zip(words.first[:-1], words.first[1:])]
                items += found
            if with_earlier:
                before = zip(batch.column("hit_words").to_pylist(), batch.column("hit_items").to_pylist())
                hits, items = zip(
                    *((np.union1d(h, w).astype(np.int32), i | set(x)) for h, i, (w, x) in zip(hits, items, before))
                )
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in batch.schema.names if c not in ("hit_words", "hit_items")),
                    pa.array(list(hits), pa.list_(pa.int32())),
                    pa.array([sorted(i) for i in items], pa.list_(pa.string())),
                ],
                names=[*(c for c in batch.schema.names if c not in ("hit_words", "hit_items")), "hit_words", "hit_items"],
            )

    return run


def find_occurrences(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``doc_id, text, hit_words`` (word numbers), ``hit_items`` (ids as sorted strings)."""
    spark, found = documents.sparkSession, documents.select("doc_id", "text")
    for k, rows in enumerate(_blocks(benchmark, block_bytes)):
        patterns = spark.sparkContext.broadcast(build(rows, window))
        schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in documents.select("doc_id", "text").schema), CARRIED])
        found = found.mapInArrow(_pass(patterns, k > 0), schema)
    return found


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, **sizes) -> DataFrame:
    """One row per document with its counts of words, hit words and items."""
    digest = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, items string"

    def summarise(batches):
        for batch in batches:
            text = batch.column("text")
            counts = [words_of(text.slice(lo, hi - lo), PLAIN).counts for lo, hi in slices(text)]
            hits = [len(w) for w in batch.column("hit_words").to_pylist()]
            found = batch.column("hit_items").to_pylist()
            items = [",".join(i) for i in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                    pa.array(hits, pa.int64()),
                    pa.array([len(i) for i in found], pa.int64()),
                    pa.array([hashlib.sha256(i.encode()).hexdigest() for i in items], pa.string()),
                    pa.array([h > 0 for h in hits], pa.bool_()),
                    pa.array(items, pa.string()),
                ],
                names=[c.split()[0] for c in digest.split(", ")],
            )

    return find_occurrences(documents, benchmark, window, **sizes).mapInArrow(summarise, digest)


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of the documents without a hit; rows are filtered where they lie."""
    spark, out = documents.sparkSession, documents
    for rows in _blocks(benchmark, BLOCK_BYTES):
        patterns = spark.sparkContext.broadcast(build(rows, window))

        def clean(batches, patterns=patterns):
            for batch in batches:
                text, bare = batch.column("text"), []
                for lo, hi in slices(text):
                    words = words_of(text.slice(lo, hi - lo), PLAIN)
                    hit, _ = search(words, patterns.value)
                    seen = np.concatenate([[0], np.cumsum(hit)])
                    bare.append(seen[words.first[1:]] == seen[words.first[:-1]])
                if bare:
                    yield batch.filter(pa.array(np.concatenate(bare)))

        out = out.mapInArrow(clean, out.schema)
    return out
