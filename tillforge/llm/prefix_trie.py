"""Prefix trie of conversations by fixed-length block hashing.

Every turn is digested, and the first ``d`` turns of a conversation have a 128-bit key: the
exclusive or of two hashes per (position, digest). Turns are cut into blocks of ``BLOCK``.
Conversations are first grouped by block: those whose turns before a block have one key are
siblings in it. Siblings that all end the block with one key have the same turns there, and
the nodes inside are read from one of them. Only where keys differ, or one conversation ends
earlier, are turns compared, and there nodes are groups of equal keys.

What a subtree sums up is a sum over its members. The path of a conversation starts with
turns shared with a smaller conversation; ``shared`` are their code points. A node of depth
``d`` with ``before`` code points in front saves the sum of ``shared - before`` over its
members but the smallest. A childless node belongs to its smallest member. So nodes need two
aggregates over blocks and the turns of divergent ones, no walk over levels.

No key is one task: positions come from a range partitioning and one count per partition
and conversation, prefixes from spans of ``SPAN`` turns and one running value per span, ends
from sorted runs of ids that are put together before one task digests them (SHA-256 is
sequential; a task gets one row per ``RUN`` ids). The driver sees one row.

Defined cases: a null conv_id takes no part; null role or text is empty; a null turn comes
first; rows of one turn are ordered by role and text, repeated rows are turns of their own;
no conversations, no rows, not even a root; extra columns are ignored. Texts are digested by
MD5 and keys are compared as 128 bits: two different beginnings are one node with a chance
of about n * n / 2 ** 129 for n nodes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillforge.llm.store import keep

BLOCK = 4
#: Turns in one span of running prefixes; a multiple of BLOCK.
SPAN = 1024
#: Ids that are put together before their digest.
RUN = 4096
#: A rebuilt conversation starts with fewer turns than this of its family's first one.
HEADS, FAMILY = 6, 100
KEY = ["depth", "key_1", "key_2"]


def positions(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, piece, at, digest, chars`` in order, and per conversation and piece
    (the part of it in one partition) the smallest ``at`` and the number of turns before."""
    order = ["conv_id", "turn", "role", "text"]
    given = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id is not null")
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    turns = keep(
        given.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.spark_partition_id().alias("piece"),
            F.monotonically_increasing_id().alias("at"),
            digest.alias("digest"),
            F.char_length("text").cast("bigint").alias("chars"),
        ),
        "trie-turns",
    )
    pieces = turns.groupBy("conv_id", "piece").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    return turns, keep(pieces.withColumn("ahead", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "trie-pieces")


def _shift(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``conv_id, depth, digest, chars, turns`` of the rebuilt conversations, and all
    conversations ``conv_id, turns`` (their number of rebuilt turns)."""
    turns, pieces = positions(conversations)
    placed = turns.join(pieces, ["conv_id", "piece"]).withColumn("pos", F.col("ahead") + F.col("at") - F.col("first") + 1)
    heads = (
        placed.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS))
        .groupBy(F.col("conv_id").alias("family"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "chars"))).alias("head"))
    )
    convs = pieces.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn("shift", _shift(F.col("conv_id")))
    convs = convs.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "family", "left")
    head = F.filter(F.coalesce("head", F.array().cast("array<struct<pos:bigint,digest:binary,chars:bigint>>")), lambda t: t.pos <= F.col("shift"))
    convs = convs.withColumn("head", head).withColumn("held", F.size("head").cast("bigint"))
    convs = keep(
        convs.withColumn("turns", F.col("held") + F.greatest(F.col("n") - F.col("shift"), F.lit(0))).drop("n", "family"),
        "trie-conversations",
    )
    moved = pieces.join(convs.select("conv_id", "shift", "held", "turns"), "conv_id")
    own = (
        turns.join(moved, ["conv_id", "piece"])
        .withColumn("pos", F.col("ahead") + F.col("at") - F.col("first") + 1)
        .filter(F.col("pos") > F.col("shift"))
        .select("conv_id", (F.col("pos") - F.col("shift") + F.col("held")).alias("depth"), "digest", "chars", "turns")
    )
    taken = convs.select("conv_id", "turns", F.explode("head").alias("t")).select("conv_id", F.col("t.pos").alias("depth"), "t.digest", "t.chars", "turns")
    return own.unionByName(taken), convs.select("conv_id", "turns")


def blocks(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: keys before and at its end, and its turns with
    their keys, code points and code points in front."""
    spans = ["conv_id", "span"]
    number = F.col("depth") - 1
    hashed = turns.select(
        "conv_id", "depth", "chars", "turns",
        F.floor(number / SPAN).cast("bigint").alias("span"),
        F.floor(number / BLOCK).cast("bigint").alias("block"),
        *(F.xxhash64(F.lit(seed), "depth", "digest").alias(f"h{seed}") for seed in (1, 2)),
    )
    totals = hashed.groupBy(*spans).agg(*(F.expr(f"bit_xor(h{s})").alias(f"x{s}") for s in (1, 2)), F.sum("chars").alias("c"))
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(
        *spans,
        *(F.expr(f"bit_xor(x{s})").over(earlier).alias(f"x{s}") for s in (1, 2)),
        F.sum("c").over(earlier).alias("c"),
    ).filter("span > 0")
    so_far = Window.partitionBy(*spans).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select(
        "*",
        *(F.expr(f"bit_xor(h{s})").over(so_far).alias(f"r{s}") for s in (1, 2)),
        F.sum("chars").over(so_far).alias("rc"),
    ).join(ahead, spans, "left")
    key = [F.col(f"r{s}").bitwiseXOR(F.coalesce(f"x{s}", F.lit(0))) for s in (1, 2)]
    keyed = running.select(
        *spans, "block", "depth", "turns", "chars",
        *(k.alias(f"key_{s}") for s, k in zip((1, 2), key)),
        *(k.bitwiseXOR(F.col(f"h{s}")).alias(f"up_{s}") for s, k in zip((1, 2), key)),
        (F.col("rc") + F.coalesce("c", F.lit(0)) - F.col("chars")).alias("before"),
    )
    turn = F.struct("depth", "key_1", "key_2", "up_1", "up_2", "chars", "before")
    grouped = keyed.groupBy(*spans, "block").agg(F.array_sort(F.collect_list(turn)).alias("turn"), F.max("turns").alias("turns"))
    first, last = F.col("turn")[0], F.element_at("turn", -1)
    return grouped.select(
        "conv_id", "block", "turn", "turns",
        *(first[f"up_{s}"].alias(f"start_{s}") for s in (1, 2)),
        *(last[f"key_{s}"].alias(f"end_{s}") for s in (1, 2)),
        last["depth"].alias("last"),
    )


SIBLINGS = ["block", "start_1", "start_2"]


def _siblings(cut: DataFrame) -> DataFrame:
    """Per group of siblings its size, smallest member and whether it diverges."""
    ends = [f(f"end_{s}").alias(f"{f.__name__}_{s}") for f in (F.min, F.max) for s in (1, 2)]
    groups = cut.groupBy(*SIBLINGS).agg(*ends, F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    apart = (F.col("min_1") != F.col("max_1")) | (F.col("min_2") != F.col("max_2"))
    return groups.select(*SIBLINGS, "n_convs", "conv_id", apart.alias("apart"))


def _divergent_turns(cut: DataFrame, groups: DataFrame) -> DataFrame:
    """The turns of all blocks whose siblings diverge. All conversations are siblings in the
    first block, so that group is not looked up by key."""
    apart = groups.filter("apart")
    at_root = bool(apart.filter("block = 0").head(1))
    chosen = cut.filter("block > 0").join(apart.filter("block > 0").select(*SIBLINGS), SIBLINGS, "left_semi")
    if at_root:
        chosen = chosen.unionByName(cut.filter("block = 0"))
    return chosen.select("conv_id", F.explode("turn").alias("t"), *(c for c in ("shared", "leaf") if c in cut.columns)).select(
        "conv_id", "t.*", *(c for c in ("shared", "leaf") if c in cut.columns)
    )


def _sums():
    """What is summed over members, without their smallest."""
    return (
        (F.sum("shared") - F.min_by("shared", "conv_id")).alias("shared"),
        F.sum("leaf").alias("n_leaves"),
    )


ENDS = "depth bigint, key_1 bigint, key_2 bigint, first bigint, ids string"


def _ends(ends: DataFrame) -> DataFrame:
    """``depth, key_1, key_2, ends_sha256`` of nodes that are the end of a conversation."""

    def put_together(batches):
        names = [c.split()[0] for c in ENDS.split(", ")]
        open_, out = None, []

        def row():
            return (*open_[0], open_[1][0], ",".join(map(str, open_[1])))

        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is None or open_[0] != key or len(open_[1]) == RUN:
                    if open_ is not None:
                        out.append(row())
                    open_ = (key, [])
                open_[1].append(conv)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=kinds)
                out = []
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row()))], schema=kinds)

    kinds = pa.schema([*((n, pa.int64()) for n in (*KEY, "first")), ("ids", pa.string())])

    def digest(batches):
        names = [*KEY, "ends_sha256"]
        shape = pa.schema([*((n, pa.int64()) for n in KEY), ("ends_sha256", pa.string())])
        key, sha = None, None
        for batch in batches:
            out = []
            for *own, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if own == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = own, hashlib.sha256()
                sha.update(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=shape)
        if key is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, sha.hexdigest())))], schema=shape)

    order = [*KEY, "conv_id"]
    runs = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(put_together, ENDS)
    ordered = runs.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return ordered.mapInArrow(digest, "depth bigint, key_1 bigint, key_2 bigint, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """All nodes of the trie. ``turns``: ``conv_id, depth, digest, chars, turns`` with depths
    from 1 without gaps; ``convs``: every conversation with its number of ``turns``."""
    spark = turns.sparkSession
    cut = keep(blocks(turns), "trie-blocks")
    groups = keep(_siblings(cut), "trie-siblings")
    # Where siblings keep together, the turns of their smallest one are all nodes.
    alike = cut.join(groups.filter("not apart").drop("apart"), [*SIBLINGS, "conv_id"])
    straight = alike.select(*SIBLINGS, "n_convs", "conv_id", F.explode("turn").alias("t")).select(
        *SIBLINGS, "n_convs", "conv_id", "t.*"
    )
    compared = _divergent_turns(cut, groups).groupBy(*KEY, "up_1", "up_2", "chars", "before").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    nodes = keep(straight.unionByName(compared, allowMissingColumns=True), "trie-nodes")
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("up_1").alias("key_1"), F.col("up_2").alias("key_2")).agg(
        F.count("*").alias("n_children")
    )
    nodes = keep(nodes.join(children, KEY, "left").fillna(0, ["n_children"]), "trie-children")

    # Second aggregate: what each member shares, and whether a childless node is its own.
    own = nodes.groupBy("conv_id").agg(
        F.min("before").alias("shared"), F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf")
    )
    whole = cut.groupBy("conv_id").agg(F.max(F.element_at("turn", -1)["before"] + F.element_at("turn", -1)["chars"]).alias("all_chars"))
    members = keep(
        whole.join(own, "conv_id", "left").select(
            "conv_id", F.coalesce("shared", "all_chars").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf")
        ),
        "trie-members",
    )
    valued = cut.join(members, "conv_id")
    by_group = valued.groupBy(*SIBLINGS).agg(*_sums())
    by_key = _divergent_turns(valued, groups).groupBy(*KEY).agg(*_sums())
    summed = (
        nodes.filter("block is not null").join(by_group, SIBLINGS)
        .unionByName(nodes.filter("block is null").join(by_key, KEY))
        .drop(*SIBLINGS)
    )
    ended = cut.filter("last = turns").select("conv_id", F.col("last").alias("depth"), F.col("end_1").alias("key_1"), F.col("end_2").alias("key_2"))
    nowhere = convs.filter("turns = 0").select("conv_id", *(F.lit(0).cast("bigint").alias(k) for k in KEY))
    ends = keep(_ends(ended.unionByName(nowhere)), "trie-ends")

    total = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")).first()
    if not total.n:
        return spark.createDataFrame([], TRIE)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("key_1").alias("up_1"), F.col("key_2").alias("up_2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    # Nodes of the first depth all have one parent, which is known: they do not look it up.
    low = summed.filter("depth > 1").join(parents, ["depth", "up_1", "up_2"])
    high = summed.filter("depth = 1").withColumn("parent_conv_id", F.lit(total.conv_id))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    below = (
        low.unionByName(high).join(ends, KEY, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            (F.col("shared") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
            F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        )
    )
    sums = members.agg(F.coalesce(F.sum("shared"), F.lit(0)).alias("shared"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("leaves")).first()
    at_root = ends.filter("depth = 0").first()
    root = spark.createDataFrame(
        [(
            total.conv_id, 0, None, total.n, nodes.filter("depth = 1").count(), max(1, sums.leaves), sums.shared,
            at_root.ends_sha256 if at_root else hashlib.sha256().hexdigest(),
        )],
        TRIE,
    )
    return root.unionByName(below)


TRIE = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuilt(conversations))


ORACLE = f"""
WITH own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, xor(4294967295, list_reduce(
        list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
        lambda crc, code: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, code)),
        4294967295::BIGINT)) % {HEADS} AS h
    FROM (SELECT DISTINCT conv_id FROM own)),
taken AS (
    SELECT c.conv_id, o.pos AS depth, o.role, o.text
    FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % {FAMILY} AND o.pos <= c.h),
held AS (SELECT c.conv_id, c.h, count(t.depth) AS g FROM convs c LEFT JOIN taken t USING (conv_id) GROUP BY ALL),
turns AS (
    SELECT * FROM taken
    UNION ALL
    SELECT o.conv_id, o.pos - c.h + c.g, o.role, o.text FROM own o JOIN held c USING (conv_id) WHERE o.pos > c.h),
paths AS (
    SELECT conv_id, depth, length(text) AS chars,
        string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
    FROM turns
    UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (
    SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM paths GROUP BY path, depth),
kids AS (SELECT left(path, (32 * (depth - 1))::BIGINT) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
weighed AS (
    SELECT n.*, coalesce(k.n, 0) AS n_children, (n.n_convs - 1) * n.chars AS saved
    FROM nodes n LEFT JOIN kids k USING (path)),
sums AS (
    SELECT left(path, (32 * up)::BIGINT) AS path, count_if(n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM weighed) GROUP BY 1),
ends AS (
    SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
    FROM (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves::BIGINT AS n_leaves,
    s.saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM weighed w JOIN sums s USING (path) LEFT JOIN ends e USING (path)
LEFT JOIN nodes p ON w.depth > 0 AND p.path = left(w.path, (32 * (w.depth - 1))::BIGINT)"""
