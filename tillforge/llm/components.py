"""Connected components by distributed union-find (alternating large and small stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillforge.llm.store import keep


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of them; a > b on entry."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, label: str) -> DataFrame:
    """``(a, b)`` links to ``(node, root)``; the root is the smallest node of its component and
    is itself a row. Links with a null end and self links are ignored; no links, no rows.

    A hub's neighbours meet only in joins that adaptive execution can split and in
    minima that are aggregated before the shuffle. The driver sees two numbers a round."""
    links = keep(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    mark = None
    while True:
        row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == (row.n, row.h):
            break
        mark = (row.n, row.h)
        if not row.n:
            break
        links = keep(_small(_large(links).filter("a <> b").distinct()).filter("a <> b").distinct(), label)
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
