"""Natural key to surrogate key: lookups, unknown members, key assignment, calendar."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillforge import constants as C
from tillforge.functions.text import timestamp_of
from tillforge.session import write_through

LOOKUPS = ["store", "product", "employee", "customer"]


def date_key(time: Column) -> Column:
    """``yyyyMMdd`` as a number; 19700101 where there is no time."""
    number = F.year(time) * 10000 + F.month(time) * 100 + F.day(time)
    return F.coalesce(number, F.lit(C.UNKNOWN_DATE_KEY))


def look_up(feed: DataFrame, dim: DataFrame, entity: str) -> DataFrame:
    """Add ``<entity>_found``, the surrogate key or NULL, by a left join on the natural key.

    The planner broadcasts the two-column dimension when its size allows and joins by
    key otherwise. NULL keys match nothing, so in that case they are spread over many
    values instead of meeting in one task.
    """
    nk, sk = f"{entity}_id", f"{entity}_sk"
    pairs = dim.select(F.col(nk).alias("_nk"), F.col(sk).alias(f"{entity}_found"))
    if entity != "customer":
        return feed.join(pairs, feed[nk] == pairs["_nk"], "left").drop("_nk")
    # A number of its own, so that the keys it is made of need not go through the shuffle.
    lane = F.pmod(F.xxhash64("transaction_id", "product_id"), F.lit(512)).cast("int")
    spread = feed.withColumn("_lane", F.when(F.col(nk).isNull(), lane))
    key = F.coalesce(spread[nk], F.concat(F.lit("\x00"), spread["_lane"].cast("string")))
    return spread.join(pairs, key == pairs["_nk"], "left").drop("_nk", "_lane")


def resolve_keys(feed: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Add the five surrogate keys; unknown members get -1, no customer stays NULL.

    Every join with a large dimension shuffles ``feed``: what can be made of its columns is
    better added behind this."""
    for entity in LOOKUPS:
        feed = look_up(feed, dims[entity], entity)
    unknown = F.lit(C.UNKNOWN_KEY).cast("bigint")
    keys = {f"{e}_sk": F.coalesce(F.col(f"{e}_found"), unknown) for e in LOOKUPS}
    keys["customer_sk"] = F.when(F.col("customer_id").isNotNull(), keys["customer_sk"])
    keys["date_sk"] = date_key(timestamp_of(feed, "transaction_time"))
    return feed.withColumns(keys).drop(*[f"{e}_found" for e in LOOKUPS])


def lookup_failures(resolved: DataFrame) -> DataFrame:
    """Hits, misses and failures per dimension; a customer miss is no failure."""
    known_date = F.col("date_sk") != C.UNKNOWN_DATE_KEY
    hit = {e: F.count_if(F.col(f"{e}_sk") != C.UNKNOWN_KEY) for e in LOOKUPS}
    miss = {e: F.count_if(F.col(f"{e}_sk") == C.UNKNOWN_KEY) for e in LOOKUPS}
    counts = resolved.agg(
        *[hit[e].alias(f"{e}_hit") for e in LOOKUPS],
        *[miss[e].alias(f"{e}_miss") for e in LOOKUPS],
        F.count_if(known_date).alias("date_hit"),
        F.count_if(~known_date).alias("date_miss"),
    )
    none = F.lit(0).cast("bigint")
    rows = [
        F.struct(
            F.lit(e).alias("dimension"),
            F.col(f"{e}_hit").alias("hits"),
            (none if e == "date" else F.col(f"{e}_miss")).alias("misses"),
            (none if e == "customer" else F.col(f"{e}_miss")).alias("failures"),
        )
        for e in [*LOOKUPS, "date"]
    ]
    return counts.select(F.inline(F.array(*rows)))


def unknown_keys(feed: DataFrame, dim: DataFrame, entity: str) -> DataFrame:
    """Natural keys of the feed the dimension lacks, with their number of rows.

    Rows are counted per key before the anti join, so only distinct keys are joined.
    """
    nk = f"{entity}_id"
    used = feed.filter(F.col(nk).isNotNull()).groupBy(nk).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(dim.select(nk), nk, "left_anti")


def auto_create(feed: DataFrame, dim: DataFrame, entity: str) -> DataFrame:
    """New members for unknown natural keys, keyed after the existing ones."""
    nk, sk = f"{entity}_id", f"{entity}_sk"
    return assign_keys(unknown_keys(feed, dim, entity).select(nk), nk, sk, highest_key(dim, sk))


def reject_unknown(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with all required members, rows for the quarantine with the members missing)."""
    required = ["store", "product", "employee"]
    missing = F.concat_ws(
        ",", *[F.when(F.col(f"{e}_sk") == C.UNKNOWN_KEY, F.lit(f"{e}_id")) for e in required]
    )
    marked = resolved.withColumn("unknown_members", missing)
    good = marked.filter(F.col("unknown_members") == "").drop("unknown_members")
    bad = marked.filter(F.col("unknown_members") != "").withColumn("error_codes", F.lit(C.FK_NOT_FOUND))
    return good, bad


def highest_key(dim: DataFrame, sk: str) -> int:
    """Largest surrogate key in use: one number."""
    return dim.agg(F.coalesce(F.max(sk), F.lit(0))).first()[0]


def assign_keys(members: DataFrame, nk: str, sk: str, start: int) -> DataFrame:
    """Number distinct members 1, 2, 3 … after ``start`` in natural key order.

    Members are range-partitioned and sorted; each takes its position inside its
    partition plus the sizes of the partitions before it. The positions are written
    first, so that both passes see one partitioning. Only one count per partition
    reaches the driver, and the offsets broadcast back have that same bound.
    """
    spark = members.sparkSession
    placed = (
        members.repartitionByRange(F.col(nk))
        .sortWithinPartitions(nk)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = write_through(placed, "key-positions").withColumns(
        {"_part": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND(F.lit(2**33 - 1))}
    )
    sizes = sorted(tuple(r) for r in placed.groupBy("_part").agg(F.count(F.lit(1))).collect())
    before = [start, *accumulate((size for _, size in sizes), initial=start)][1:]
    offsets = spark.createDataFrame(
        [(part, offset) for (part, _), offset in zip(sizes, before)], "_part bigint, _offset bigint"
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(sk, F.col("_offset") + F.col("_row") + 1)
        .drop("_part", "_row", "_at", "_offset")
    )


def calendar(span: DataFrame, fiscal_start_month: int = 1) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` with the calendar attributes.

    A fiscal year is named after the calendar year it ends in when it starts after January.
    """
    days = span.select(F.explode(F.sequence("first_day", "last_day")).alias("calendar_date"))
    d = F.col("calendar_date")
    fiscal = F.year(d) + F.when((F.month(d) >= fiscal_start_month) & F.lit(fiscal_start_month > 1), 1).otherwise(0)
    return days.select(
        date_key(d).alias("date_sk"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.day(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        fiscal.alias("fiscal_year"),
    )
