"""Type-1 dimensions: delta against the snapshot, and the next snapshot."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillforge.operators.keys import assign_keys, highest_key


def latest_per_key(df: DataFrame, nk: str, version: list[str]) -> DataFrame:
    """One row per natural key: the one with the highest version.

    An aggregate, not a window: partial maxima are taken before the shuffle, so many
    copies of one key never meet as rows. ``version`` decides; the remaining columns
    settle ties.
    """
    rest = [c for c in df.columns if c != nk and c not in version]
    return df.groupBy(nk).agg(F.max(F.struct(*version, *rest)).alias("_latest")).select(
        *[F.col(c) if c == nk else F.col(f"_latest.{c}").alias(c) for c in df.columns]
    )


def _differs(tracked: list[str], left: DataFrame, right: DataFrame) -> Column:
    return reduce(or_, [~left[c].eqNullSafe(right[f"_old_{c}"]) for c in tracked])


def _old(existing: DataFrame, nk: str, tracked: list[str]) -> DataFrame:
    return existing.select(
        F.col(nk).alias("_old_nk"), *[F.col(c).alias(f"_old_{c}") for c in tracked]
    )


def scd1_delta(incoming: DataFrame, existing: DataFrame, nk: str, tracked: list[str]) -> DataFrame:
    """Incoming members with ``change``: INSERT, UPDATE or UNCHANGED.

    A member is new when its key is not there, whatever its attributes hold, and
    changed when any tracked attribute differs with NULL equal to NULL.
    """
    old = _old(existing, nk, tracked)
    joined = incoming.join(old, incoming[nk] == old["_old_nk"], "left")
    change = (
        F.when(F.col("_old_nk").isNull(), "INSERT")
        .when(_differs(tracked, incoming, old), "UPDATE")
        .otherwise("UNCHANGED")
    )
    return joined.withColumn("change", change).select(*incoming.columns, "change")


def scd1_metrics(delta: DataFrame) -> DataFrame:
    def rows(change: str) -> Column:
        return F.count_if(F.col("change") == change)

    return delta.agg(
        F.count(F.lit(1)).alias("rows_compared"),
        rows("INSERT").alias("rows_inserted"),
        rows("UPDATE").alias("rows_changed"),
        rows("UNCHANGED").alias("rows_unchanged"),
    )


def scd1_apply(
    incoming: DataFrame, existing: DataFrame, nk: str, sk: str, tracked: list[str], now: str
) -> DataFrame:
    """The next snapshot: old members overwritten where changed, new ones added with keys.

    The caller writes it to a new path and switches over; files of the old snapshot are
    never rewritten in place.
    """
    stamp = F.lit(now).cast("timestamp_ntz")
    fresh = incoming.select(F.col(nk).alias("_nk"), *[F.col(c).alias(f"_new_{c}") for c in tracked])
    joined = existing.join(fresh, existing[nk] == fresh["_nk"], "left")
    seen = F.col("_nk").isNotNull()
    changed = seen & reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in tracked])
    kept = joined.select(
        sk,
        nk,
        *[F.when(seen, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in tracked],
        "created_at",
        F.when(changed, stamp).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    new = incoming.select(nk, *tracked).join(existing.select(nk), nk, "left_anti")
    keyed = assign_keys(new, nk, sk, highest_key(existing, sk)).select(
        sk, nk, *tracked, stamp.alias("created_at"), stamp.alias("updated_at")
    )
    return kept.unionByName(keyed)


def insert_if_absent(seed: DataFrame, existing: DataFrame, nk: str) -> DataFrame:
    """Seed members whose key is not there yet."""
    return seed.join(existing.select(nk), nk, "left_anti")
