"""Fuzzy line deduplication by MinHash over character shingles, in DataFrame functions only.

A line is lower-cased and trimmed; equal lines become one row by a hash aggregate, partial
before the shuffle, so that a line with a third of all occurrences is one row a task. The
distinct five-character shingles of each give SAMPLES minima (the shingle hash XORed with a
seed each). Bands of minima are buckets; eight bits of most minima are packed into a sketch.
In every bucket all lines meet one hub, the line that occurs most: of near copies that is
mostly the text they were made from. Pairs whose sketches allow a link are decided by the
exact Jaccard similarity of the shingle sets. Buckets that then still hold several
components are compared in full, in blocks, but for pairs that cannot be linked: the bits in
which parity bitmaps of the shingle sets differ bound the difference of the sets from below,
and so do the exact distances to the common hub. Union-find over the links; the earliest
line of each component is kept.

Defined cases: lines end at a line feed; blank lines are never compared and stay; a line
shorter than a shingle is its own only shingle; null texts have no lines; rows under one
doc_id are one document, a position in it is kept in all of its rows; lines of rows
without a doc_id are not compared and stay; extra columns are ignored or passed through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillforge.llm.components import components
from tillforge.llm.store import Scratch, keep

#: One changed inner character costs five shingles: from 39 characters on 0.75 is still reached.
SHINGLE = 5
PERCENT_INTERSECTION, PERCENT_UNION = 100, 75
#: Minima stand in a square of SIDE rows. A band is a line of this plane (two of them share at
#: most one minimum) or a parabola. Were the minima independent, a pair of exactly 0.75 would
#: share no band with probability 1.09 %, one of 0.85 with 0.02 % (simulated).
SIDE = 5
SAMPLES = SIDE * SIDE
BANDS = [
    *([x * SIDE + (bend * x * x + slope * x + start) % SIDE for x in range(SIDE)] for bend, slope in [*((0, m) for m in range(SIDE)), (1, 0)] for start in range(SIDE)),
    *([x * SIDE + y for y in range(SIDE)] for x in range(SIDE)),
]
#: Bands that are shuffled at a time.
AT_ONCE = 5
#: Minima in one number of a sketch, a byte each.
PACKED = 8
SKETCH = [f"s{i}" for i in range(SAMPLES // PACKED)]
SKETCHED = PACKED * len(SKETCH)
MINIMA = [f"m{k}" for k in range(SAMPLES)]
#: Pairs with fewer equal bytes go no further: of pairs at the threshold 0.01 %, were the
#: minima independent.
LEAST_EQUAL = 10
#: Words of a parity bitmap, 64 bits each.
ODD = [f"o{w}" for w in range(16)]
#: Positions that one row of the shingle scan covers.
STEP = 16
BLOCK = 512
PLACE = "decimal(31,0)"


def _normal(line: Column) -> Column:
    return F.lower(F.trim(line))


def _wide(line: Column) -> Column:
    """Four bytes a character: a position is found without walking the text."""
    return F.encode(line, "UTF-32")


def _shingle_at(wide, position) -> Column:
    return F.xxhash64(F.substring(wide, position * 4 + 1, F.lit(4 * SHINGLE)))


def _last(length) -> Column:
    return F.greatest(length - SHINGLE, F.lit(0))


def place(doc_id, line_no) -> Column:
    """One number for (doc_id, line_no), in their order."""
    return (doc_id.cast("decimal(20,0)") * F.lit(4294967296).cast("decimal(10,0)") + line_no).cast(PLACE)


def lines_of(documents: DataFrame) -> DataFrame:
    """``doc_id, line_no`` (from 0) and the normal form of each line."""
    return documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "line_no", _normal(F.col("line")).alias("line")
    )


def _seed(k: int) -> int:
    value = ((k + 1) * 0x9E3779B97F4A7C15) & (2**64 - 1)
    value = ((value ^ (value >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    return (value ^ (value >> 27)) - 2**63


def distinct_lines(documents: DataFrame) -> DataFrame:
    """Each normal line once: ``node`` (a number of its own), earliest ``place``, ``n``, ``line``."""
    lines = lines_of(documents).filter("doc_id is not null and line <> ''")
    once = lines.select("line", place(F.col("doc_id"), F.col("line_no")).alias("place")).groupBy("line")
    once = once.agg(F.min("place").alias("place"), F.count("*").alias("n"))
    return once.select(F.monotonically_increasing_id().alias("node"), "place", "n", "line")


def signatures(distinct: DataFrame) -> DataFrame:
    """``node``, ``n`` and its minima, of the upper halves of the hashes. A line is made wide
    once; the rows that scan it share it and copy no text."""
    wide = distinct.select("node", "n", _last(F.length("line")).alias("last"), _wide(F.col("line")).alias("wide"))
    at = wide.select("node", "n", "wide", "last", F.explode(F.sequence(F.lit(0), F.col("last"), F.lit(STEP))).alias("at"))
    hashes = (_shingle_at(F.col("wide"), F.least(F.col("at") + k, F.col("last"))) for k in range(STEP))
    hashed = at.select("node", "n", *(F.shiftright(h, 32).cast("int").alias(f"h{k}") for k, h in enumerate(hashes)))
    minima = [
        F.min(F.least(*(F.col(f"h{i}").bitwiseXOR(F.lit(_seed(k) >> 32)) for i in range(STEP)))).alias(m) for k, m in enumerate(MINIMA)
    ]
    return hashed.groupBy("node", "n").agg(*minima)


def _sketch() -> list[Column]:
    def packed(first: int) -> Column:
        word = F.lit(0).cast("bigint")
        for i in range(PACKED):
            word = word.bitwiseOR(F.shiftleft(F.col(f"m{first + i}").cast("bigint").bitwiseAND(F.lit(255)), 8 * i))
        return word

    return [packed(i * PACKED).alias(name) for i, name in enumerate(SKETCH)]


def _alike(left: str, right: str) -> Column:
    """Whether two sketches share LEAST_EQUAL bytes; equal minima have equal bytes."""
    different = F.lit(0)
    for name in SKETCH:
        bits = F.col(left + name).bitwiseXOR(F.col(right + name))
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift)).bitwiseAND(F.lit(mask))
        different = different + F.bit_count(bits)
    return different <= SKETCHED - LEAST_EQUAL


def shingles(line: str) -> Column:
    """Shingle hashes of a normal line, repeats included. The text is bound to a variable: as
    a column it would be computed or copied anew for every shingle."""

    def of(text):
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (4 * SHINGLE - 1), F.lit(1)), F.lit(4))
        return F.transform(starts, lambda i: F.xxhash64(F.substring(text, i, F.lit(4 * SHINGLE))))

    return F.get(F.transform(F.array(_wide(F.col(line))), of), F.lit(0))


def _measured(pairs: DataFrame, distinct: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs ``a, b`` of nodes with the sizes of their shingle sets: what they ``shared``,
    and the ``sum`` of both."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = scratch.keep(distinct.select("node", "line").join(ends, "node"), "lines-texts")
    both = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("line").alias("line_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("line").alias("line_b")), "b")
        .select("a", "b", "line_a", "line_b")
    )
    # Shingling costs far more than the bytes of a pair suggest, by which joins size their tasks.
    both = both.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    # Rows of a generator: each list is made once, and the set functions are compiled for longs.
    hashes = F.array(F.struct(shingles("line_a").alias("x"), shingles("line_b").alias("y")))
    x, y = F.col("h.x"), F.col("h.y")
    sizes = both.select("a", "b", F.explode(hashes).alias("h"))
    return sizes.select("a", "b", F.size(F.array_intersect(x, y)).alias("shared"), (F.size(F.array_distinct(x)) + F.size(F.array_distinct(y))).alias("sum"))


def _similar() -> Column:
    """|x and y| / |x or y| reaches the threshold, with the union as |x| + |y| - |x and y|."""
    return (PERCENT_INTERSECTION + PERCENT_UNION) * F.col("shared") >= PERCENT_UNION * F.col("sum")


def _sided(members: DataFrame, side: str, keys: list[str]) -> DataFrame:
    return members.select(*keys, *(F.col(c).alias(side + c) for c in members.columns if c not in keys))


def _members(signed: DataFrame, scratch: Scratch) -> DataFrame:
    """``bucket, node, size, hub`` of the buckets with several lines, some bands each. Rows are
    sorted by bucket once, counted, and those of single lines are gone before a hub is sought."""
    parts, bucket = [], Window.partitionBy("bucket")
    for first in range(0, len(BANDS), AT_ONCE):
        buckets = [F.xxhash64(F.lit(first + b), *(MINIMA[k] for k in band)) for b, band in enumerate(BANDS[first : first + AT_ONCE])]
        banded = signed.select(F.explode(F.array(*buckets)).alias("bucket"), "node", "n")
        shared = banded.withColumn("size", F.count("*").over(bucket)).filter("size > 1")
        hubs = shared.withColumn("hub", F.min_by("node", -F.col("n")).over(bucket))
        parts.append(scratch.keep(hubs.select("bucket", "node", "size", "hub"), "lines-members"))
    return reduce(DataFrame.unionByName, parts)


def _hub_pairs(members: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of the hub of a bucket and another line of it whose sketches allow a link."""
    pairs = members.filter("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    ends = [_sided(signed.select("node", *_sketch()), side, []).withColumnRenamed(f"{side}node", end) for side, end in (("l_", "a"), ("r_", "b"))]
    return pairs.distinct().join(ends[0], "a").join(ends[1], "b").filter(_alike("l_", "r_")).select("a", "b")


def _far(left: Column, right: Column) -> Column:
    """Whether similarities to one hub exclude a link: Jaccard distances are a metric. Nothing
    is excluded where one was not measured."""
    return F.coalesce(F.abs(left - right) > 1 - PERCENT_UNION / PERCENT_INTERSECTION + 1e-9, F.lit(False))


def _odd_sketches(lines: DataFrame) -> DataFrame:
    """``node``, how many different shingles its line has, and their parity bitmap: every one
    flips a bit, so that two bitmaps differ in no more bits than the sets in shingles."""
    # By node, and into as many tasks as may be: a line costs far more than its bytes suggest.
    dealt = lines.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), "node")
    each = dealt.select("node", F.explode(F.array_distinct(shingles("line"))).alias("h"))
    each = each.select("node", F.expr("shiftrightunsigned(h, 60)").alias("word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    words = [F.bit_xor(F.when(F.col("word") == w, F.col("bit")).otherwise(F.lit(0).cast("bigint"))).alias(o) for w, o in enumerate(ODD)]
    return each.groupBy("node").agg(F.count("*").alias("different"), *words)


def _within_reach() -> Column:
    """False only where a link is impossible: linked sets differ in at most a share of both
    sizes together, and by no less than their bitmaps or their sizes do."""
    bits = reduce(Column.__add__, (F.bit_count(F.col("l_" + o).bitwiseXOR(F.col("r_" + o))) for o in ODD))
    apart = F.greatest(bits.cast("bigint"), F.abs(F.col("l_different") - F.col("r_different")))
    both = F.col("l_different") + F.col("r_different")
    return (PERCENT_INTERSECTION + PERCENT_UNION) * apart <= (PERCENT_INTERSECTION - PERCENT_UNION) * both


def _open_pairs(members: DataFrame, distinct: DataFrame, roots: DataFrame, near: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs of different components in one bucket that may be linked. A bucket is dealt out
    in blocks; every pair of blocks is one join key, and only what passes the condition
    inside the join becomes a row. A bucket of two has no pair but that of its hub."""
    placed = members.filter("size > 2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = scratch.keep(placed, "lines-placed")
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("bucket")
    seen = near.select(F.col("a").alias("hub"), F.col("b").alias("node"), "similarity")
    open_ = placed.join(mixed, "bucket").join(seen, ["hub", "node"], "left")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = open_.withColumn("similarity", F.when(F.col("hub") == F.col("node"), 1.0).otherwise(F.col("similarity")))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), blocks.cast("bigint")).cast("int"))
    dealt = scratch.keep(dealt.select("bucket", "size", "own", "node", "root", "similarity"), "lines-open")
    lines = distinct.select("node", "line").join(dealt.select("node").distinct(), "node")
    dealt = dealt.join(scratch.keep(_odd_sketches(lines), "lines-odd"), "node")
    own = ["own", "node", "root", "similarity", "different", *ODD]
    whole = dealt.filter(F.col("size") <= BLOCK).select("bucket", *own[1:])
    cut = dealt.filter(F.col("size") > BLOCK).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    cut = cut.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *own)
    found = []
    for keys, left, right, once in (
        (["bucket"], whole, whole, F.col("l_node") < F.col("r_node")),
        (["bucket", "i", "j"], cut.filter("own = i").drop("own"), cut.filter("own = j").drop("own"), (F.col("i") < F.col("j")) | (F.col("l_node") < F.col("r_node"))),
    ):
        both = _sided(left, "l_", keys).join(_sided(right, "r_", keys), keys)
        both = both.filter(once & (F.col("l_root") != F.col("r_root")) & ~_far(F.col("l_similarity"), F.col("r_similarity")) & _within_reach())
        found.append(both.select(F.least("l_node", "r_node").alias("a"), F.greatest("l_node", "r_node").alias("b")))
    return found[0].unionByName(found[1]).distinct()


def _components(distinct: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, root`` of the lines that are linked with another one."""
    signed = scratch.keep(signatures(distinct), "lines-signed")
    members = _members(signed, scratch)
    pairs = scratch.keep(_hub_pairs(members, signed), "lines-pairs")
    near = scratch.keep(_measured(pairs, distinct, scratch).withColumn("similarity", F.col("shared") / (F.col("sum") - F.col("shared"))), "lines-near")
    roots = components(near.filter(_similar()).select("a", "b"), "lines-roots")
    rest = _open_pairs(members, distinct, roots, near, scratch).join(_undirected(near), ["a", "b"], "left_anti")
    found = scratch.keep(_measured(scratch.keep(rest, "lines-rest"), distinct, scratch).filter(_similar()).select("a", "b"), "lines-found")
    linked = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return roots if found.isEmpty() else components(linked.unionByName(found), "lines-components")


def _undirected(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def line_components(documents: DataFrame) -> DataFrame:
    """``mark, root``: the earliest place in the component of each line that occurs more than
    once or is linked with another one."""
    with Scratch() as scratch:
        distinct = scratch.keep(distinct_lines(documents), "lines-distinct")
        roots = _components(distinct, scratch)
        first = roots.join(distinct.select("node", "place"), "node").groupBy("root").agg(F.min("place").alias("first"))
        named = roots.join(first, "root").select("node", "first")
        repeated = distinct.join(named, "node", "left").filter("n > 1 or first is not null")
        return keep(repeated.select(F.unhex(F.md5("line")).alias("mark"), F.coalesce("first", "place").alias("root")), "lines-judged")


def judged_lines(documents: DataFrame) -> DataFrame:
    """A row per line: ``doc_id, line_no``, the document and number of the line that is kept
    for its component, and whether it is the kept one."""
    roots = line_components(documents)
    lines = lines_of(documents).select("doc_id", "line_no", F.when(F.col("line") != "", F.unhex(F.md5("line"))).alias("mark"))
    own = place(F.col("doc_id"), F.col("line_no"))
    met = lines.join(roots, "mark", "left").select("doc_id", "line_no", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("root")), own).alias("root"))
    keeper = F.floor(F.col("root") / F.lit(4294967296).cast("decimal(10,0)")).cast("bigint")
    return met.select(
        "doc_id",
        F.col("line_no").cast("bigint").alias("line_no"),
        keeper.alias("kept_doc_id"),
        F.coalesce((F.col("root") - place(keeper, F.lit(0))).cast("bigint"), F.col("line_no").cast("bigint")).alias("kept_line_no"),
        F.coalesce(own == F.col("root"), F.lit(True)).alias("kept"),
    )


def remove_repeated_lines(documents: DataFrame) -> DataFrame:
    """The documents with repeated lines taken out of ``text`` and ``n_chars`` set anew."""
    out = judged_lines(documents).filter("not kept").groupBy("doc_id").agg(F.collect_set("line_no").alias("__out"))
    left = documents.join(out.withColumnRenamed("doc_id", "__doc"), F.col("doc_id") == F.col("__doc"), "left")
    lines = F.split("text", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0).cast("bigint"), F.size(lines).cast("bigint") - 1), F.col("__out"))
    # The lines are bound to a variable, so that the text is split once.
    both = F.array(F.struct(lines.alias("lines"), stay.alias("stay")))
    joined = F.transform(both, lambda b: F.array_join(F.transform(b["stay"], lambda i: F.get(b["lines"], i.cast("int"))), "\n"))
    text = F.when(F.col("__out").isNull(), F.col("text")).otherwise(F.get(joined, F.lit(0)))
    left = left.withColumn("text", text)
    if "n_chars" in documents.columns:
        left = left.withColumn("n_chars", F.when(F.col("__out").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint")))
    return left.select(*documents.columns)
