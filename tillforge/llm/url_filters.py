"""URL filters: pattern rules, looked up by their rarest literal token.

Two kinds of rules. A host rule (``example.com/en/``) fits its host and all subdomains where
the path starts with the rule's; a rule without ``/`` fits every path. A pattern rule is
searched in the whole URL: ``*`` is any text, ``^`` a separator or the end, ``|`` at either
end an anchor, all else literal, ASCII letters without case.

Every rule is compiled to a regular expression and to the literal tokens (runs of ASCII
letters and digits) that each URL it fits must hold whole. Spark counts how many URLs of the
table hold each of these tokens, and a rule is filed under its rarest one. The tokens of a
URL fetch candidate rules, and only those are run. A rule without a whole token is run on
every URL.

The host rule with the longest text wins, of equally long ones that with the longer host,
then ``block``. Where no host rule fits, the longest pattern rule that fits gives the
verdict, of equally long ones ``block``; where none fits, ``default``.

Rules are collected to the driver and sent out in blocks of at most about ``BLOCK_RULES``,
one block after the other; between blocks the best rule so far is written. No page is
shuffled: a third of all pages on one host is no hot key.

Defined cases: a null URL or one without ``://`` has an empty host and path, no host rule
fits it, and pattern rules see its text (null: empty); a null page_id is returned like any;
repeated rows are each judged; repeated rules count once; a null or empty rule, or one with
another verdict than allow and block, is ignored; no rules: all get ``default``; no pages,
no rows; extra columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillforge.llm.store import keep

BLOCK_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = str.maketrans(UPPER, LOWER)
_TOKEN = re.compile("[a-z0-9]+")
#: A character that ends a word in a URL.
SEPARATOR = r"(?:[^A-Za-z0-9_.%\-]|\Z)"
RULES = "rule string, is_host boolean, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case and path; both empty where there is no ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(_LOWER), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]


def tokens_of(url: str) -> set[str]:
    return set(_TOKEN.findall(url.translate(_LOWER)))


def _whole_tokens(literal: str, open_start: bool, open_end: bool) -> list[str]:
    """Tokens of a literal; one at an open border may go on in the URL and is none."""
    text = literal.translate(_LOWER)
    return [
        m[0]
        for m in _TOKEN.finditer(text)
        if not (open_start and m.start() == 0) and not (open_end and m.end() == len(text))
    ]


def compile_host(rule: str) -> tuple[str, list[str]]:
    """Expression for host and path put together, and the tokens it needs."""
    host, slash, path = rule.partition("/")
    host, path = host.translate(_LOWER), slash + path
    ending = re.escape(path) if path else r"(?:/|\Z)"
    tokens = _whole_tokens(host, False, False) + _whole_tokens(path, False, True)
    return rf"\A(?:[^/]*\.)?{re.escape(host)}{ending}", tokens


def compile_pattern(rule: str) -> tuple[str, list[str]]:
    """Expression to search in a whole URL, and the tokens it needs."""
    body = rule.removeprefix("|")
    at_start, at_end = body != rule, body.endswith("|")
    body = body.removesuffix("|")
    pieces, tokens = body.split("*"), []
    for i, piece in enumerate(pieces):
        parts = piece.split("^")
        for k, part in enumerate(parts):
            closed_start = k > 0 or (i == 0 and at_start)
            closed_end = k < len(parts) - 1 or (i == len(pieces) - 1 and at_end)
            tokens += _whole_tokens(part, not closed_start, not closed_end)
    wild = [SEPARATOR.join(map(re.escape, p.split("^"))) for p in pieces]
    # A piece found as early as possible leaves the most room: no need to go back into it.
    inner = "".join(f"(?>.*?{w})" for w in wild[1 : -1 if at_end else None])
    last = f".*{wild[-1]}" if at_end and len(wild) > 1 else ""
    return (r"\A" if at_start else "") + wild[0] + inner + last + (r"\Z" if at_end else ""), tokens


COMPILED = f"{RULES}, expression string, tokens array<string>"


def compiled(rules: DataFrame) -> DataFrame:
    """Distinct usable rules with their expressions and tokens."""

    def run(batches):
        for batch in batches:
            made = [
                (compile_host if h else compile_pattern)(r)
                for r, h in zip(batch.column("rule").to_pylist(), batch.column("is_host").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([e for e, _ in made], pa.string()), pa.array([t for _, t in made], pa.list_(pa.string()))],
                names=["rule", "is_host", "verdict", "expression", "tokens"],
            )

    given = rules.select("rule", F.coalesce("is_host", F.lit(True)).alias("is_host"), "verdict")
    fine = given.filter(F.col("verdict").isin("allow", "block") & (F.length("rule") > 0)).distinct()
    return fine.mapInArrow(run, COMPILED)


def filed(rules: DataFrame, pages: DataFrame) -> DataFrame:
    """Compiled rules with ``home``, the token of theirs that the fewest URLs hold; null: none."""
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    held = pages.select(
        F.explode(F.array_distinct(F.split(F.translate("url", UPPER, LOWER), "[^a-z0-9]+"))).alias("token")
    )
    # Counted before the join, so that a token of most URLs is one partial row per task.
    counts = held.groupBy("token").agg(F.count("*").alias("urls")).join(wanted, "token", "left_semi")
    options = rules.select("rule", "is_host", F.explode("tokens").alias("token")).join(counts, "token", "left")
    order = F.struct(F.coalesce("urls", F.lit(0)), -F.length("token"), "token")
    homes = options.groupBy("rule", "is_host").agg(F.min(order)["token"].alias("home"))
    return rules.join(homes, ["rule", "is_host"], "left")


class Index:
    """Rules of one block by home token."""

    def __init__(self, rows):
        self.by_token, self.anywhere = {}, []
        for r in rows:
            host = r.rule.partition("/")[0] if r.is_host else ""
            rank = (r.is_host, len(r.rule), len(host), r.verdict == "block", r.rule)
            entry = (rank, r.expression)
            (self.by_token.setdefault(r.home, []) if r.home else self.anywhere).append(entry)

    def candidates(self, tokens: set[str]) -> list:
        found = list(self.anywhere)
        for token in tokens:
            found += self.by_token.get(token, ())
        return found

    def best(self, url: str, place: str, runs: dict):
        """Rank of the best rule that fits, or None; candidates in falling rank."""
        for rank, expression in sorted(self.candidates(tokens_of(url)), reverse=True):
            run = runs.get((rank[0], expression))
            if run is None:
                flags = re.DOTALL if rank[0] else re.DOTALL | re.IGNORECASE | re.ASCII
                run = runs[(rank[0], expression)] = re.compile(expression, flags)
            if run.search(place if rank[0] else url):
                return rank
        return None


RANK = ("best_is_host boolean", "best_size bigint", "best_host_size bigint", "best_blocks boolean", "best_rule string")
JUDGED = ", ".join(("page_id bigint", "url string", "host string", "path string", *RANK))


def _judge(pages: DataFrame, index, first: bool) -> DataFrame:
    names = [c.split()[0] for c in JUDGED.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 3, pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]

    def run(batches):
        runs: dict = {}
        for batch in batches:
            rows = []
            for page, url, *earlier in zip(*(c.to_pylist() for c in batch.columns)):
                host, path = split_url(url)
                rank = index.value.best(url or "", host + path, runs)
                if not first and earlier[2] is not None and (rank is None or rank < tuple(earlier[2:])):
                    rank = tuple(earlier[2:])
                rows.append((page, url, host, path, *(rank or (None,) * 5)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names
            )

    return pages.mapInArrow(run, JUDGED)


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", block_rules: int = BLOCK_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` for every row of ``pages``; ``rule`` is
    the host rule that decided, ``pattern`` the pattern rule. ``rules``: ``rule, is_host, verdict``."""
    spark = pages.sparkSession
    judged = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    known = keep(filed(compiled(rules), judged), "url-rules")
    blocks = max(1, -(-known.count() // block_rules))
    place = F.pmod(F.xxhash64("rule", "is_host", "verdict"), F.lit(blocks))
    for block in range(blocks):
        index = spark.sparkContext.broadcast(Index(known.filter(place == block).collect()))
        judged = _judge(judged, index, block == 0)
        if block < blocks - 1:
            judged = keep(judged, "url-judged")
    verdict = F.when(F.col("best_blocks"), "block").when(~F.col("best_blocks"), "allow").otherwise(default)
    return judged.select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best_is_host"), F.col("best_rule")).alias("rule"),
        verdict.alias("verdict"),
        F.when(~F.col("best_is_host"), F.col("best_rule")).alias("pattern"),
    )


#: Host rules of the query, longest text wins.
HOST_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Pattern rules of the query: pages of lists, sessions, accounts and files that are no text.
PATTERN_RULES = tuple(
    (p, "block")
    for p in (
        *(f"^{name}=" for name in ("page", "sessionid", "phpsessid", "jsessionid", "sid")),
        *(f"/{name}^" for name in ("login", "signin", "signup", "register", "cart", "checkout")),
        *(f".{name}|" for name in ("jpg", "jpeg", "png", "gif", "css", "js", "zip", "exe", "pdf", "mp4")),
    )
)


def standard_rules(spark) -> DataFrame:
    return spark.createDataFrame(
        [(r, True, v) for r, v in HOST_RULES] + [(r, False, v) for r, v in PATTERN_RULES], RULES
    )


def _twin() -> str:
    lower = f"translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
    fits = " ".join(
        f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '/{p}') THEN '{h}/{p}'"
        for h, p in sorted((r.split("/", 1) for r, _ in HOST_RULES), key=lambda hp: -len("/".join(hp)))
    )
    allowed = ", ".join(f"'{r}'" for r, v in HOST_RULES if v == "allow")
    separator = "(?:[^a-z0-9_.%-]|$)"
    searched = []
    for p, _ in sorted(PATTERN_RULES, key=lambda pv: (-len(pv[0]), pv[0])):
        core = re.escape(p.strip("^|"))
        expression = (separator if p.startswith("^") else "") + core + (separator if p.endswith("^") else "$" if p.endswith("|") else "")
        searched.append((p, f"regexp_matches(translate(u, '{UPPER}', '{LOWER}'), '(?s){expression}')"))
    # Of equally long rules the greatest text wins, as in the ranks of Index.
    searched.sort(key=lambda s: (len(s[0]), s[0]), reverse=True)
    patterns = " ".join(f"WHEN {test} THEN '{p}'" for p, test in searched)
    return f"""
WITH urls AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
parts AS (SELECT *, {lower} AS host, regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM urls),
ruled AS (SELECT *, CASE {fits} END AS rule FROM parts),
searched AS (SELECT *, CASE WHEN rule IS NULL THEN CASE {patterns} END END AS pattern FROM ruled)
SELECT page_id, host, path, rule,
    CASE WHEN rule IS NOT NULL THEN CASE WHEN rule IN ({allowed}) THEN 'allow' ELSE 'block' END
         WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
    pattern
FROM searched"""


ORACLE = _twin()
