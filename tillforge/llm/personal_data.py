"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base matches of four fixed kinds are the seeds. Words beside an identifier are lexical
patterns. Patterns and instances form a graph that is scored in rounds: a pattern is as
sure as the share of its kind among its known identifiers, an instance as sure as its
patterns together. Sure patterns with enough different known instances turn unseen
identifiers (whole tokens that are no plain words) into further spans; base spans always stay.

Positions come from marking matches: a text split at the marks has matches at odd places.

Defined cases: null text is empty; repeated documents get the same spans each; a null doc_id
stays null; a document's marks are its text's digest and id, so that spans find all its
rows; documents without matches have empty lists and the digest of the empty text; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillforge.llm.store import keep

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Possessive quantifiers and looks behind keep long texts
# linear and match the same as the plain forms.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Whole tokens up to their last letter or digit, plain words apart; a label before : or = is not part.
TOKEN = r"[^\s\p{Z},;|<>{}\x22]"
IDENTIFIER = (
    r"(?<![\p{L}\p{N}])(?!\p{L}++[:=]" + TOKEN + r")(?=\p{L}*+(?:\p{N}|(?![\p{L}\p{N}])" + TOKEN + TOKEN + r"*[\p{L}\p{N}]))"
    r"[\p{L}\p{N}](?:" + TOKEN + r"*[\p{L}\p{N}])?"
)
ROUNDS = 3
LEAST_SUPPORT = 3
SURE_PATTERN = 0.8
#: Unseen identifiers do not count against a pattern, but a word beside which fewer are of its
#: kind stands beside everything ("the", "of") and tells nothing.
LEAST_SHARE = 0.25
SURE_INSTANCE = 0.9
#: Characters beside an identifier in which its neighbour words are looked for.
REACH = 48
MARK = "\u0001"
SPAN = "struct<start:int,rank:int,kind:string,stop:int>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(c, i):
        twice = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _could_hold(kind: str, text: Column) -> Column:
    """A cheap look that spares most texts the pattern."""
    return {"email": text.contains("@"), "phone": text.contains("+"), "identifier": F.lit(True)}.get(kind, text.rlike("[0-9]"))


def _parts(text: Column, kind: str, pattern: str) -> Column:
    """The text in pieces; the odd ones (from 0) are the matches."""
    marked = F.regexp_replace(text, pattern, f"{MARK}$0{MARK}")
    return F.when(_could_hold(kind, text), F.split(marked, MARK, -1)).otherwise(F.array(F.lit("")))


FOUND = "array<struct<start:int,value:string,before:string,after:string>>"


def _located(parts: Column) -> Column:
    """``start, value, before, after`` of every match, in one walk over the pieces."""
    empty = F.array(F.lit(""))
    earlier = F.concat(empty, F.transform(parts, lambda p: F.substring(p, -REACH, REACH)))
    later = F.concat(F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.substring(p, 1, REACH)), empty)
    beside = F.zip_with(earlier, later, lambda b, a: F.struct(b.alias("before"), a.alias("after")))
    pieces = F.zip_with(
        parts, F.slice(beside, 1, F.size(parts)), lambda p, n: F.struct(p.alias("value"), n["before"].alias("before"), n["after"].alias("after"))
    )

    def walk(done, piece):
        match = F.struct(done["at"].alias("start"), piece["value"].alias("value"), piece["before"].alias("before"), piece["after"].alias("after"))
        return F.struct(
            (done["at"] + F.length(piece["value"])).alias("at"),
            (~done["match"]).alias("match"),
            F.when(done["match"], F.concat(done["found"], F.array(match))).otherwise(done["found"]).alias("found"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("match"), F.array().cast(FOUND).alias("found"))
    return F.aggregate(pieces, start, walk, lambda done: done["found"])


def _span(kind: str, rank: int):
    def make(found):
        stop = found["start"] + F.length(found["value"])
        return F.struct(
            found["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), stop.alias("stop"),
            *(found[c].alias(c) for c in ("value", "before", "after")),
        )

    return make


def _only_valid(kind: str) -> Column:
    return F.filter(kind, lambda found: _valid(kind, found["value"]))


def _looked_through(documents: DataFrame) -> DataFrame:
    """``doc_id, mark, seeds`` (base matches in order) and ``unseen`` (other identifiers)."""
    text = F.translate(F.coalesce("text", F.lit("")), MARK, "\u0002")
    mark = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), mark.alias("mark"), text.alias("text"))
    patterns = {**PATTERNS, "identifier": IDENTIFIER}
    rows = rows.select("doc_id", "mark", *(_parts(F.col("text"), k, p).alias(k) for k, p in patterns.items()))
    rows = rows.select("doc_id", "mark", *(_located(F.col(k)).alias(k) for k in patterns))
    seeds = [F.transform(_only_valid(kind), _span(kind, rank)) for rank, kind in enumerate(KINDS)]
    return rows.select(
        "doc_id", "mark", F.array_sort(F.concat(*seeds)).alias("seeds"), F.col("identifier").alias("unseen")
    )


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _neighbours(before: Column, after: Column) -> Column:
    left = F.regexp_extract(F.lower(F.substring(before, -REACH, REACH)), r"(\p{L}+)[^\p{L}]*$", 1)
    right = F.regexp_extract(F.lower(F.substring(after, 1, REACH)), r"^[^\p{L}]*(\p{L}+)", 1)
    return F.filter(F.array(F.concat(F.lit("< "), left), F.concat(F.lit("> "), right)), lambda c: F.length(c) > 2)


def _occurrences(looked: DataFrame) -> DataFrame:
    """``doc_id, mark, start, stop, value, kind`` (null: unknown), ``contexts``: base matches,
    and identifiers that overlap none."""
    seeds = looked.select("doc_id", "mark", F.inline("seeds")).drop("rank")
    unseen = looked.select("doc_id", "mark", "seeds", F.inline("unseen")).withColumn("stop", F.col("start") + F.length("value"))
    apart = ~F.exists("seeds", lambda s: (s["start"] < F.col("stop")) & (s["stop"] > F.col("start")))
    unseen = unseen.filter(apart).drop("seeds").withColumn("kind", F.lit(None).cast("string"))
    return seeds.unionByName(unseen).withColumn("contexts", _neighbours(F.col("before"), F.col("after"))).drop("before", "after")


def discovered(occurrences: DataFrame) -> DataFrame:
    """``value, kind`` of unseen identifiers that sure patterns vouch for.

    Counts are summed per task before any shuffle, so a word beside a third of all
    identifiers is a row a task."""
    beside = occurrences.select("value", "kind", F.explode("contexts").alias("context"))
    counts = keep(beside.groupBy("context", "value", "kind").agg(F.count("*").alias("n")), "pii-graph")
    seen = counts.groupBy("context").agg(F.sum("n").alias("all"))
    known = counts.filter("kind is not null").select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    unknown = counts.filter("kind is null").select("context", "value", "n")
    found = None
    for _ in range(ROUNDS):
        vouched = counts.select("context", "value", "n").join(known, "value")
        own = keep(
            vouched.groupBy("context", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("sure"), F.count_distinct("value").alias("support")),
            "pii-patterns",
        )
        patterns = (
            own.join(own.groupBy("context").agg(F.sum("sure").alias("known")), "context")
            .join(seen, "context")
            .withColumn("confidence", F.col("sure") / F.col("known"))
            .filter((F.col("support") >= LEAST_SUPPORT) & (F.col("confidence") >= SURE_PATTERN) & (F.col("sure") >= LEAST_SHARE * F.col("all")))
        )
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        scored = unknown.join(patterns.select("context", "kind", "confidence"), "context").groupBy("value", "kind").agg((1 - doubt).alias("score"))
        found = keep(scored.filter(F.col("score") >= SURE_INSTANCE), "pii-found")
        known = known.filter("score = 1.0").unionByName(found)
    best = found.groupBy("value").agg(F.max(F.struct("score", "kind")).alias("best"))
    return best.select("value", F.col("best.kind").alias("kind"))


def personal_data(documents: DataFrame) -> DataFrame:
    """A row per document: counts and digest of the base spans, and all spans."""
    looked = keep(_looked_through(documents), "pii-looked")
    occurrences = keep(_occurrences(looked).distinct(), "pii-occurrences")
    spots = occurrences.filter("kind is null").drop("kind", "contexts").join(discovered(occurrences), "value")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    more = spots.groupBy(F.col("doc_id").alias("d"), F.col("mark").alias("m")).agg(
        F.collect_list(F.struct("start", rank.alias("rank"), "kind", "stop")).alias("more")
    )
    bare = F.transform("seeds", lambda s: F.struct(*(s[c].alias(c) for c in ("start", "rank", "kind", "stop"))))
    base = looked.select("doc_id", "mark", bare.alias("base"))
    joined = base.join(more, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left")
    every = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(f"array<{SPAN}>"))))
    counts = [F.size(F.filter("base", _is(kind))).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return joined.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(every).alias("spans"))


def _is(kind: str):
    return lambda span: span["kind"] == kind
