"""Keys of earlier batches: which are found, and what is opened for it."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillforge import constants as C
from tillforge.operators.key_store import KeyStore
from tillforge.plans import catalog
from tillforge.streaming import ingest

SCHEMA = StructType([StructField("a", StringType()), StructField("b", StringType())])


def batch(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def test_keys_of_all_generations_are_found(spark, tmp_path):
    store = KeyStore(str(tmp_path), SCHEMA, ["a", "b"], generation=2)
    for n in range(5):
        rows = batch(spark, (f"a{n}", "x"), (None, str(n)), (f"a{n}", "x"))
        assert store.seen(rows, n).count() == 0
        store.add(rows, n)
    asked = batch(spark, ("a0", "x"), ("a1", "y"), (None, "3"), ("a4", "x"), ("a4", "x"), (None, None))
    assert {tuple(r) for r in store.seen(asked, 5).collect()} == {("a0", "x"), (None, "3"), ("a4", "x")}


def test_a_batch_run_again_finds_what_it_found_first(spark, tmp_path):
    store = KeyStore(str(tmp_path), SCHEMA, ["a", "b"], generation=2)
    for n in range(4):
        store.add(batch(spark, (f"a{n}", "x"), ("same", "x")), n)
    for _ in range(2):
        rows = batch(spark, ("a3", "x"), ("same", "x"), ("a1", "x"))
        assert {r.a for r in store.seen(rows, 3).collect()} == {"same", "a1"}
        store.add(batch(spark, ("a3", "x"), ("same", "x")), 3)
    held = spark.read.schema(SCHEMA).parquet(*[str(p) for p in (tmp_path / "closed").glob("generation=*/keys/bucket=*")])
    assert Counter(r.a for r in held.collect()) == Counter({"same": 2, "a0": 1, "a1": 1, "a2": 1, "a3": 1})


def test_what_a_batch_opens_does_not_grow_with_the_batches_before_it(spark, tmp_path):
    store = KeyStore(str(tmp_path), SCHEMA, ["a", "b"], generation=2)
    opened = []
    for n in range(9):
        rows = spark.range(n * 50, n * 50 + 50).select(F.concat(F.lit("k"), "id").alias("a"), F.lit("x").alias("b"))
        # One repeat of the first batch in every later one.
        rows = rows.unionByName(batch(spark, ("k7", "x")))
        assert store.seen(rows, n).count() == (1 if n else 0)
        store.add(rows, n)
        opened.append(len(store.opened))
    # The key stands in one bucket of each closed generation; no other bucket is opened.
    assert opened == [0, 0, 1, 1, 2, 2, 3, 3, 4]
    fresh = spark.range(10**6, 10**6 + 50).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    assert store.buckets_to_open(fresh, 9) == []


@pytest.mark.parametrize("arrivals", [1, 12])
def test_stream_equals_batch_however_many_lots_arrive(spark, base, tmp_path, arrivals):
    path, schema, files = catalog._landed_parquet(spark, base, arrivals)
    paths = [str(tmp_path / p) for p in ("clean", "bad", "checkpoint")]
    stream = ingest.feed_stream(spark, path, schema, files)
    ingest.validate_stream(stream, catalog.FEED_ORDER, "2026-12-01 00:00:00", *paths, generation=3).awaitTermination()
    batch = catalog.flagged(spark, base)
    got = Counter(tuple(r) for r in spark.read.parquet(f"{paths[0]}/rows").select(*C.FEED_COLUMNS).collect())
    assert got == Counter(tuple(r) for r in batch.filter("not failed").select(*C.FEED_COLUMNS).collect())
    assert spark.read.parquet(paths[1]).count() == batch.filter("failed").count()
