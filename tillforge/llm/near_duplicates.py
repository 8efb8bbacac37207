"""Near-duplicate documents by MinHash with odd sketches.

Per document: distinct five-word shingles, MinHash samples of them, banded bucket keys,
and an odd sketch: every sample flips one bit of a parity bitmap, so that the population
count of the XOR of two bitmaps estimates how many samples differ. Documents of one shingle
set are one node. In every bucket each node meets the smallest one; pairs whose sketches
allow the similarity are confirmed on the full sets. Buckets that still hold several
components are then compared in full, in blocks: by sketches, and where these allow a link
on the full sets. Components are a distributed union-find.

Defined cases: null and empty texts have no shingles, are linked with nothing and are their
own component; fewer than five words are one shingle; rows under one doc_id are one node
whose links are those of all its texts, and each row is returned; a row without a doc_id is
linked with nothing, has a null component and is kept; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillforge.llm.components import components
from tillforge.llm.store import keep
from tillforge.llm.words import SPACED, mix, slices, words_of

SHINGLE = 5
#: A link needs PERCENT_INTERSECTION * |A and B| >= PERCENT_UNION * |A or B|.
PERCENT_INTERSECTION, PERCENT_UNION = 100, 75
#: A pair of exactly 0.75 shares no band with probability (1 - 0.75 ** 4) ** 28 = 2.4e-5.
BANDS, BAND_ROWS = 28, 4
SAMPLES = BANDS * BAND_ROWS
SKETCH_WORDS = 8
SKETCH_BITS = 64 * SKETCH_WORDS
#: Five and a half deviations of the share of equal samples below the threshold, and the
#: sketch's own: true links fall below it with a chance under 1e-7.
LEAST_ESTIMATE = 0.45
BLOCK = 256
COLUMNS = 1 << 13
CHUNK = 1 << 16

_seeds = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
XOR, FACTOR = (_seeds[:SAMPLES] >> np.uint64(32)).astype(np.uint32), (_seeds[SAMPLES:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
WORD_FACTOR = mix(np.arange(101, 101 + SHINGLE, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ascending within a row, and the n + 1 borders."""
    words = words_of(text, SPACED)
    hashes, first, counts = words.hashes, words.first, words.counts
    whole = np.zeros(max(0, len(hashes) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        whole += hashes[k : len(hashes) - SHINGLE + 1 + k] * WORD_FACTOR[k] if len(whole) else 0
    whole = mix(whole)
    sets, borders = [], np.zeros(len(counts) + 1, np.int64)
    for row, (at, n) in enumerate(zip(first[:-1].tolist(), counts.tolist())):
        if n >= SHINGLE:
            sets.append(np.unique(whole[at : at + n - SHINGLE + 1]))
        elif n:
            sets.append(mix((hashes[at : at + n] * WORD_FACTOR[:n]).sum(keepdims=True) + np.uint64(n)))
        borders[row + 1] = borders[row] + (len(sets[-1]) if n else 0)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), borders


def minhash(shingles: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Samples of the rows that have shingles: one line a sample."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    filled = borders[:-1][np.diff(borders) > 0]
    out = np.empty((SAMPLES, len(filled)), np.uint32)
    at = 0
    while at < len(filled):
        to = max(at + 1, int(np.searchsorted(filled, filled[at] + CHUNK)))
        end = filled[to] if to < len(filled) else len(short)
        part, rel = short[filled[at] : end], filled[at:to] - filled[at]
        for k in range(SAMPLES):
            out[k, at:to] = np.minimum.reduceat((part ^ XOR[k]) * FACTOR[k], rel)
        at = to
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps, a line of 64-bit words a document."""
    which = np.arange(SAMPLES, dtype=np.uint64)[:, None] << np.uint64(32)
    bit = (mix(samples.astype(np.uint64) | which) & np.uint64(SKETCH_BITS - 1)).astype(np.int64)
    n = samples.shape[1]
    flips = np.bincount((bit + np.arange(n) * SKETCH_BITS).ravel(), minlength=n * SKETCH_BITS) & 1
    return np.packbits(flips.astype(np.uint8).reshape(n, SKETCH_BITS), axis=1).view(np.uint64)


def estimate(differing_bits):
    """Similarity from the population count of an XOR; column or number."""
    left = 1 - 2 * differing_bits / SKETCH_BITS
    if isinstance(differing_bits, (int, float)):
        return 1 + SKETCH_BITS * math.log(left) / (4 * SAMPLES) if left > 0 else 0.0
    return F.when(left > 0, 1 + SKETCH_BITS * F.log(left) / (4 * SAMPLES)).otherwise(0.0)


#: The largest number of differing bits that LEAST_ESTIMATE allows.
MOST_BITS = max(b for b in range(SKETCH_BITS // 2) if estimate(b) >= LEAST_ESTIMATE)

SKETCHED = "doc_id bigint, n_shingles bigint, set_1 bigint, set_2 bigint, buckets array<bigint>, sketch array<bigint>"


def _sketch(batches):
    for batch in batches:
        ids, texts = batch.column("doc_id").cast(pa.int64()), batch.column("text")
        for lo, hi in slices(texts):
            shingles, borders = shingle_sets(texts.slice(lo, hi - lo))
            sizes = np.diff(borders)
            filled = sizes > 0
            samples = minhash(shingles, borders)
            marks = [np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)]
            if filled.any():
                at = borders[:-1][filled]
                marks[0][filled] = np.add.reduceat(mix(shingles), at).view(np.int64)
                marks[1][filled] = np.add.reduceat(mix(shingles * np.uint64(0xD6E8FEB86659FD93)), at).view(np.int64)
            keys = np.zeros((BANDS, samples.shape[1]), np.uint64)
            for k in range(BAND_ROWS):
                keys = mix(keys + samples[k::BAND_ROWS][:BANDS] + np.uint64(1))
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64)[:, None]).T.copy().view(np.int64)
            bitmaps = odd_sketch(samples).view(np.int64)
            n = hi - lo
            borders_of = lambda width: pa.array(np.concatenate([[0], np.cumsum(np.where(filled, width, 0))]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(lo, n),
                    pa.array(sizes, pa.int64()),
                    pa.array(marks[0]),
                    pa.array(marks[1]),
                    pa.ListArray.from_arrays(borders_of(BANDS), pa.array(keys.ravel())),
                    pa.ListArray.from_arrays(borders_of(SKETCH_WORDS), pa.array(bitmaps.ravel())),
                ],
                names=[c.split()[0] for c in SKETCHED.split(", ")],
            )


def sketches(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text").mapInArrow(_sketch, SKETCHED)


def _confirm(batches):
    """Keeps the pairs whose full sets are similar enough."""
    for batch in batches:
        linked = []
        for a, b in zip(batch.column("text_a"), batch.column("text_b")):
            shingles, borders = shingle_sets(pa.array([a.as_py(), b.as_py()], pa.large_string()))
            sizes = np.diff(borders)
            both = len(np.intersect1d(shingles[: borders[1]], shingles[borders[1] :], assume_unique=True))
            linked.append(both > 0 and PERCENT_INTERSECTION * both >= PERCENT_UNION * (int(sizes.sum()) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _texts(documents: DataFrame, repeated: DataFrame) -> DataFrame:
    """The different texts of every id. Only ids with several rows, ``repeated``, are looked
    at for it; the texts of all others stay where they are."""
    given = documents.select("doc_id", "text").filter("doc_id is not null and text is not null")
    once = given.join(repeated, "doc_id", "left_anti")
    return once.unionByName(given.join(repeated, "doc_id", "left_semi").distinct())


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts, not sets, are moved: they are smaller."""
    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm, "a bigint, b bigint").distinct()


def _shared_counts(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the rows' shingle sets, and of the intersection of every two of them."""
    shingles, borders = shingle_sets(text)
    row = np.repeat(np.arange(len(text)), np.diff(borders))
    values, at = np.unique(shingles, return_inverse=True)
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    shared = np.zeros((len(text), len(text)), np.float64)
    for start in range(0, len(values), COLUMNS):
        lo, hi = np.searchsorted(at, [start, start + COLUMNS])
        held = np.zeros((len(text), min(COLUMNS, len(values) - start)), np.float32)
        held[row[lo:hi], at[lo:hi] - start] = 1
        shared += held @ held.T
    return np.diff(borders), shared


def _links_in_block(table: pa.Table) -> pa.Table:
    node, root, own = (table.column(c).to_numpy() for c in ("node", "root", "own"))
    bits = np.array(table.column("sketch").to_pylist(), np.int64).view(np.uint64)
    keys = np.array(table.column("buckets").to_pylist(), np.int64)
    i, j, band = (table.column(c)[0].as_py() for c in ("i", "j", "band"))
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if not len(left) or not len(right):
        return none
    open_ = root[left][:, None] != root[right]
    for k, x in enumerate(left):
        open_[k] &= np.bitwise_count(bits[x] ^ bits[right]).sum(axis=1) <= MOST_BITS
        if band:  # pairs that share an earlier band are compared there
            open_[k] &= ~(keys[x, :band] == keys[right, :band]).any(axis=1)
    if not open_.any():
        return none
    left, right = left[open_.any(axis=1)], right[open_.any(axis=0)]
    used = np.unique(np.concatenate([left, right]))
    sizes, shared = _shared_counts(table.column("text").combine_chunks().take(pa.array(used)))
    x, y = np.searchsorted(used, left)[:, None], np.searchsorted(used, right)
    both = shared[x, y]
    linked = (both > 0) & (PERCENT_INTERSECTION * both >= PERCENT_UNION * (sizes[x] + sizes[y] - both))
    k, m = np.nonzero(linked & (root[left][:, None] != root[right]))
    return pa.table({"a": node[left[k]], "b": node[right[m]]})


def _links_across(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between components that share a bucket, confirmed on the full sets.

    A bucket is cut into blocks of some BLOCK members and every pair of blocks is compared
    in a group of its own, so that no task holds a whole bucket; a group gives links, not
    pairs to look at."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.join(texts.withColumnRenamed("doc_id", "node"), "node").withColumn("own", F.pmod(F.xxhash64("node"), blocks.cast("bigint")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "bucket", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "root", "sketch", "buckets", "text"
    )
    return dealt.groupBy("bucket", "i", "j").applyInArrow(_links_in_block, "a bigint, b bigint").distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per document."""
    sketched = keep(sketches(documents), "near-sketches")
    sets = sketched.filter("n_shingles > 0 and doc_id is not null")
    smallest = keep(sets.groupBy("set_1", "set_2").agg(F.min("doc_id").alias("node")), "near-sets")
    nodes = (
        sets.join(smallest, ["set_1", "set_2"])
        .filter("doc_id = node")
        .dropDuplicates(["node", "set_1", "set_2"])
        .select("node", "buckets", "sketch")
    )
    nodes = keep(nodes, "near-nodes")
    repeated = keep(sketched.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "near-repeated")
    texts = _texts(documents, repeated)
    # An id with two texts stands in the buckets of both; it is one member of each.
    banded = nodes.select("node", F.posexplode("buckets").alias("band", "bucket")).distinct()
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("hub")).filter("n > 1")
    members = keep(banded.join(shared, "bucket"), "near-members")
    near = F.aggregate(
        F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")), F.lit(0), lambda s, x: s + x
    )
    hubs = members.filter("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    hubs = (
        hubs.join(nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a")
        .join(nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "b")
        .filter(estimate(near) >= LEAST_ESTIMATE)
        .select("a", "b")
        .distinct()
    )
    links = keep(_confirmed(keep(hubs, "near-pairs"), texts), "near-links")
    roots = components(links, "near-roots")
    rooted = nodes.join(roots, "node", "left").select("node", "sketch", "buckets", F.coalesce("root", "node").alias("root"))
    placed = members.select("bucket", "band", "node", "n").join(rooted.select("node", "root"), "node")
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("bucket")
    open_ = placed.join(mixed, "bucket").select("bucket", "band", "node", "n").join(rooted, "node")
    found = keep(_links_across(open_, texts), "near-found")
    roots = components(links.unionByName(found), "near-components")
    return (
        sketched.select("doc_id", "n_shingles", "set_1", "set_2")
        .join(smallest, ["set_1", "set_2"], "left")
        .withColumn("node", F.when(F.col("n_shingles") > 0, F.col("node")).otherwise(F.col("doc_id")))
        .join(roots, "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "node")).alias("component_id"),
            F.coalesce(F.col("doc_id") == F.coalesce("root", "node"), F.lit(True)).alias("kept"),
        )
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """All columns of the documents that stay: the smallest doc_id of each component (rows
    that repeat it are the same document and stay with it) and rows without a doc_id."""
    out = near_duplicates(documents).filter("not kept").select("doc_id").distinct()
    return documents.join(out, "doc_id", "left_anti")
