"""Keys seen by earlier batches, in buckets that are opened only where a bitmap says so.

Batches are numbered from 0 without gaps. The keys of a batch lie in a folder of their own.
When ``GENERATION`` batches are complete they are put together once: their keys into hash
buckets, and per bucket a few bitmaps of the hashes it holds. A batch reads the folders of
its own generation, which are a bounded number, the bitmaps of closed generations, and of
their keys only the buckets in which one of its hashes is set. What it opens depends on its
repeats, not on how many batches there were. All paths are computed, none listed.

Everything a batch writes lies under its number and is overwritten, so a batch that is run
again after a failure leaves one copy, and it never reads its own keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillforge.session import COMPACT, write_through

GENERATION = 16
BUCKETS = 64
#: Bitmaps of 32,768 bits in one bucket.
BLOCKS = 16
BITS = 32768


@dataclass
class KeyStore:
    """``keys`` name the key columns of ``schema``; its other columns go with a key."""

    path: str
    schema: StructType
    keys: list[str]
    generation: int = GENERATION
    buckets: int = BUCKETS
    opened: list[str] = field(default_factory=list)

    def _place(self) -> Column:
        """Where the hash of a key is set, over all bitmaps of a generation."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets * BLOCKS * BITS))

    def _batch(self, number: int) -> str:
        return f"{self.path}/open/batch={number}"

    def _closed(self, generation: int) -> str:
        return f"{self.path}/closed/generation={generation}"

    def add(self, rows: DataFrame, number: int) -> None:
        """Store the keys of a batch; the last batch of a generation closes it."""
        spark = rows.sparkSession
        rows.select(*self.schema.names).distinct().write.mode("overwrite").options(**COMPACT).parquet(self._batch(number))
        if (number + 1) % self.generation == 0:
            self._close(spark, number // self.generation)

    def _close(self, spark: SparkSession, generation: int) -> None:
        first = generation * self.generation
        paths = [self._batch(n) for n in range(first, first + self.generation)]
        held = spark.read.schema(self.schema).parquet(*paths).distinct().withColumn("_place", self._place())
        bucket = F.floor(F.col("_place") / (BLOCKS * BITS)).cast("int")
        (
            held.withColumn("bucket", bucket).drop("_place")
            .hint("rebalance", "bucket")
            .write.mode("overwrite").options(**COMPACT).partitionBy("bucket").parquet(f"{self._closed(generation)}/keys")
        )
        (
            held.groupBy(F.bitmap_bucket_number(F.col("_place") + 1).alias("number"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_place") + 1)).alias("bitmap"))
            .coalesce(1)
            .write.mode("overwrite").parquet(f"{self._closed(generation)}/bitmaps")
        )

    def buckets_to_open(self, rows: DataFrame, number: int) -> list[str]:
        """Folders of closed generations that can hold a key of ``rows``."""
        spark, found = rows.sparkSession, []
        generations = range(number // self.generation)
        if not generations:
            return found
        maps = spark.read.schema("number bigint, bitmap binary, generation int").option(
            "basePath", f"{self.path}/closed"
        ).parquet(*[f"{self._closed(g)}/bitmaps" for g in generations])
        place = rows.select(self._place().alias("_place")).distinct()
        asked = place.select(
            F.bitmap_bucket_number(F.col("_place") + 1).alias("number"), F.bitmap_bit_position(F.col("_place") + 1).alias("bit")
        )
        byte = F.expr("cast(conv(hex(substring(bitmap, cast(bit div 8 as int) + 1, 1)), 16, 10) as int)")
        is_set = F.shiftright(byte, 0).bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0
        hits = asked.join(maps, "number").filter(is_set)
        bucket = F.floor((F.col("number") - 1) / BLOCKS).cast("int").alias("bucket")
        # At most one row per bucket of a generation.
        for row in hits.select("generation", bucket).distinct().orderBy("generation", "bucket").collect():
            found.append(f"{self._closed(row.generation)}/keys/bucket={row.bucket}")
        return found

    def earlier(self, rows: DataFrame, number: int) -> DataFrame:
        """Stored rows of smaller batch numbers that can equal keys of ``rows``: all keys of
        ``rows`` that were stored are among them."""
        spark = rows.sparkSession
        first = number // self.generation * self.generation
        self.opened = self.buckets_to_open(rows, number)
        paths = [self._batch(n) for n in range(first, number)] + self.opened
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def seen(self, rows: DataFrame, number: int) -> DataFrame:
        """The distinct keys of ``rows`` that an earlier batch stored; null keys are equal."""
        asked = rows.select(*self.keys).distinct()
        held = self.earlier(asked, number).select(*(F.col(k).alias(f"_held_{k}") for k in self.keys)).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in self.keys]
        # Written, so that few repeats are known to be few and are broadcast by size.
        return write_through(asked.join(held, same, "left_semi"), "seen")
