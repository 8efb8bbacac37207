"""Prefix trie, URL filters and hard negatives against plain forms."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tillforge.llm import hard_negatives, prefix_trie, queries, url_filters


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def same_as_sql(spark, base, name, table):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{base}/{table}.parquet'")
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    order = [names.index(n) for n in sorted(names)]
    want = Counter(tuple(r[i] for i in order) for r in result.fetchall())
    got = queries.QUERIES[name](spark, base)
    assert sorted(got.columns) == sorted(names) and rows(got) == want and want


@pytest.mark.parametrize(
    "name, table",
    [("op11_prefix_trie", "conversations"), ("op12_url_filters", "pages"), ("op13_hard_negatives", "embeddings")],
)
def test_queries_equal_their_twins(spark, base, name, table):
    same_as_sql(spark, base, name, table)


# prefix trie

TURNS = "conv_id bigint, turn int, role string, text string, depth string, block string"


def plain_trie(given):
    own = defaultdict(list)
    for conv, turn, role, text in given:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[tuple(made[c][:d])].append(c)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, own_ in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += (len(own_) - 1) * len(path[-1][1]) if path else 0
    out = Counter()
    for path, own_ in members.items():
        ends = ",".join(str(c) for c in own_ if len(made[c]) == len(path))
        parent = members[path[:-1]][0] if path else None
        row = dict(
            conv_id=own_[0], depth=len(path), parent_conv_id=parent, n_convs=len(own_), n_children=children[path],
            n_leaves=leaves[path], saved_tokens=saved[path], ends_sha256=hashlib.sha256(ends.encode()).hexdigest(),
        )
        out[tuple(row[k] for k in sorted(row))] += 1
    return out


def trie_of(spark, given):
    return prefix_trie.conversation_trie(spark.createDataFrame([(*g, "x", "y") for g in given], TURNS))


AWKWARD_TURNS = [
    (0, None, "user", "first"), (0, 0, None, None), (0, 1, "a", "B😀"), (0, 1, "a", "A"), (0, 1, "a", "A"), (0, 2, "u", "x" * 50000),
    (1, 0, "user", "own"), (2, 0, "user", "own"), (2, 1, "", ""), (7, 3, "user\n", "q"), (99, 0, "user", "1:"), (99, 1, "1:user", ""),
    (150, 0, "user", "no family"), (151, 0, "user", "no family"), (None, 0, "user", "nobody"), (13, 0, "user", "one turn only"),
]


def test_trie_of_awkward_conversations(spark):
    assert rows(trie_of(spark, AWKWARD_TURNS)) == plain_trie(AWKWARD_TURNS)


def test_trie_without_conversations(spark):
    assert trie_of(spark, []).count() == 0
    assert trie_of(spark, [(None, 1, "user", "nobody")]).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_tries_that_diverge_inside_and_between_blocks(spark, seed):
    rng = random.Random(seed)
    given = [
        (c, t, rng.choice(["u", "a"]), rng.choice(["p", "p", "p", "qq"]) if t < 9 else "same")
        for c in rng.sample(range(300), 120)
        for t in range(rng.choice([0, 1, 2, 4, 5, 8, 9, 12, 13]))
    ]
    assert rows(trie_of(spark, given)) == plain_trie(given)


def test_long_conversations_of_several_spans_that_differ_at_the_end(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPAN", 16)
    long = 2 * prefix_trie.SPAN + 3
    given = [(c, t, "u", f"t{t % 7}" if t < long - 2 or c == 0 else f"c{c}") for c in (0, 1, 4) for t in range(long)]
    given += [(5, t, "u", f"t{t % 7}") for t in range(long)]
    got = trie_of(spark, given)
    want = plain_trie(given)
    assert rows(got) == want


def test_many_ends_in_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 7)
    given = [(c, 0, "u", "hello") for c in range(100, 160)] + [(c, 0, "u", "other") for c in range(160, 170)]
    assert rows(trie_of(spark, given)) == plain_trie(given)


# URL filters

URLS = [
    None, "", "no scheme", "://", "http://", "http://COM/", "http://com", "http://a.com", "http://a.com/", "x://y://example.com/en/",
    "https://Example.COM/en/1", "https://example.com/EN/1", "https://www.example.com/en/1", "https://x.www.example.com/en/",
    "https://wwwexample.com/en/", "https://notexample.com/en/", "https://example.com?x=/en/", "https://example.com#/en/",
    "https://example.net/es/", "https://example.net/es", "http://net/fr/x?page=2", "http://example.org/a?page=2", "http://example.org/a?Page=2&x",
    "http://example.org/a?mypage=2", "http://example.org/page=", "http://example.org/login", "http://example.org/login/x", "http://example.org/logins",
    "http://example.org/x.PDF", "http://example.org/x.pdf?y", "http://é.example.com/en/ü", "http://user@example.com/en/", "http://example.com:80/en/",
    "http://example.org/" + "a/" * 40000 + "login", "HTTP://M.example.com/en//x y\n",
]
PAGES = "page_id bigint, url string, host string, verdict string, token string"


def plain_verdict(url, hosts, fits, default="allow"):
    """``fits``: pattern rules as (rule, verdict, predicate)."""
    _, mark, rest = (url or "").partition("://")
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host) if mark else ""
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))] if mark else ""
    found = []
    for rule, verdict in hosts:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and (not slash or path.startswith("/" + p)):
            found.append((len(rule), len(h), verdict == "block", rule, verdict))
    if found:
        best = max(found)
        return host, path, best[3], best[4], None
    found = [(len(r), v == "block", r, v) for r, v, fit in fits if fit(url or "")]
    if found:
        return host, path, None, max(found)[3], max(found)[2]
    return host, path, None, default, None


def pages_of(spark, urls):
    return spark.createDataFrame([(i if i % 9 else None, u, "h", "v", "t") for i, u in enumerate(urls)], PAGES)


def test_urls_against_the_plain_form(spark):
    end = lambda text, word: any(text.lower()[i + len(word) :][:1] in ("", *":/?#&= \n") for i in range(len(text)) if text.lower().startswith(word, i))
    names = ("page", "sessionid", "phpsessid", "jsessionid", "sid")
    fits = []
    for rule, verdict in url_filters.PATTERN_RULES:
        word = rule.strip("^|")
        if rule.startswith("^"):
            assert word.rstrip("=") in names
            fit = lambda u, w=word: any(s + w in u.lower() for s in ":/?#&= \n")
        elif rule.endswith("^"):
            fit = lambda u, w=word: end(u, w)
        else:
            fit = lambda u, w=word: u.lower().endswith(w)
        fits.append((rule, verdict, fit))
    want = Counter((i if i % 9 else None, *plain_verdict(u, url_filters.HOST_RULES, fits)) for i, u in enumerate(URLS))
    got = url_filters.filter_urls(pages_of(spark, URLS), url_filters.standard_rules(spark))
    assert Counter(tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict", "pattern").collect()) == want


def test_blocks_of_rules_decide_alike(spark):
    rules = url_filters.standard_rules(spark)
    rules = rules.union(rules).union(spark.createDataFrame([("", True, "block"), (None, True, "allow"), ("com/", True, "maybe"), ("org", True, "block"), ("org", True, "allow")], url_filters.RULES))
    one = rows(url_filters.filter_urls(pages_of(spark, URLS), rules))
    assert rows(url_filters.filter_urls(pages_of(spark, URLS), rules, block_rules=3)) == one


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], url_filters.RULES)
    got = url_filters.filter_urls(pages_of(spark, URLS), none, default="block")
    assert got.filter("verdict = 'block' and rule is null and pattern is null").count() == len(URLS)
    assert url_filters.filter_urls(pages_of(spark, []), url_filters.standard_rules(spark)).count() == 0


def test_rules_are_filed_under_their_rarest_whole_token(spark):
    pages = pages_of(spark, ["http://a.example.com/en/x", "http://b.example.com/en/rare", "http://c.example.org/en/rare"])
    rules = spark.createDataFrame(
        [("example.com/en/", True, "block"), ("/rare^", False, "block"), ("*rare*", False, "allow"), ("|http:*en/rare|", False, "allow")], url_filters.RULES
    )
    homes = {r.rule: r.home for r in url_filters.filed(url_filters.compiled(rules), pages).collect()}
    assert homes == {"example.com/en/": "com", "/rare^": "rare", "*rare*": None, "|http:*en/rare|": "rare"}


def test_only_candidates_are_run():
    class Row:
        def __init__(self, rule, home):
            self.rule, self.home, self.is_host, self.verdict = rule, home, True, "block"
            self.expression = url_filters.compile_host(rule)[0]

    index = url_filters.Index([Row(f"site{i}.com/", f"site{i}") for i in range(1000)])
    assert [e for (*_, rule), e in index.candidates(url_filters.tokens_of("http://x.site7.com/a"))] == [url_filters.compile_host("site7.com/")[0]]


@pytest.mark.parametrize(
    "pattern, url, fits",
    [
        ("a*b*c", "xa1b2c3", True), ("a*b*c", "cba", False), ("|http:*x|", "http://xx", True), ("|http:*x|", "http://xy", False),
        ("*^end|", "a/end", True), ("a*a*a*a*a|", "a" * 3000 + "b", False), ("x.y", "xzy", False), ("||a", "|a", True),
    ],
)
def test_patterns(pattern, url, fits):
    import re

    expression, _ = url_filters.compile_pattern(pattern)
    assert bool(re.search(expression, url, re.DOTALL | re.IGNORECASE | re.ASCII)) is fits


# hard negatives

VECTORS = "vec_id bigint, embedding array<double>, label int, score string, rank string"


def whole(x):
    return math.floor(256 * x) if abs(x) < 2.0**53 else int(x) * 256


def plain_negatives(given, anchor):
    seen, usable = set(), []
    for vec_id, vector, label in given:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if (vec_id, label, tuple(vector)) not in seen:
            seen.add((vec_id, label, tuple(vector)))
            usable.append((vec_id, label, [whole(x) for x in vector]))
    out = Counter()
    clip = lambda s: max(-hard_negatives.LONG, min(hard_negatives.LONG, s))
    for a, label, numbers in usable:
        if not anchor(a):
            continue
        scored = sorted((-clip(sum(map(int.__mul__, numbers, c))), i, own) for i, own, c in usable if i != a)
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            for rank, (n, negative, _) in enumerate(fit, 1):
                out[(a, positive, rank, negative, -p, -n)] += 1
    return out


def mined(spark, given, **kw):
    df = spark.createDataFrame([(*g, "x", "y") for g in given], VECTORS)
    got = hard_negatives.hard_negatives(df, hard_negatives.is_anchor_of_query(), **kw)
    return Counter(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def some_vectors(seed, n, width, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, width))
    return [
        (i * 10, (scale * (centres[i % 4] * 0.6 + rng.normal(size=width) * 0.6 + 0.5)).round(2).tolist(), int(rng.integers(3)))
        for i in range(n)
    ]


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e17])
def test_negatives_of_any_size_of_component(spark, scale):
    given = some_vectors(5, 60, 6, scale)
    want = plain_negatives(given, lambda i: i % 50 == 0)
    # Scores of the largest are beyond a long, so that no window holds them.
    assert mined(spark, given) == want and bool(want) == (scale < 1e9)


def test_negatives_of_awkward_vectors(spark):
    given = some_vectors(6, 40, 4)
    given += given[:11] + [(i + 1, v, lab) for i, v, lab in given[:12]]
    given += [(50, [1.0, None, 0.0, 0.0], 1), (None, [1.0] * 4, 1), (100, None, 1), (150, [1.0] * 4, None), (200, [float("nan")] * 4, 1),
              (250, [float("inf")] * 4, 2), (300, [], 1), (350, [0.0] * 4, 1), (400, [1.0], 2), (450, [1.0] * 6, 0), (50, [9.0] * 4, 1)]
    wide = [(i, None if v is None else v + [0.0] * (6 - len(v)) if v and None not in v else v, lab) for i, v, lab in given]
    wide = [(i, [0.0] * 6 if v == [] else v, lab) for i, v, lab in wide]
    want = plain_negatives(wide, lambda i: i % 50 == 0)
    assert mined(spark, given) == want and want
    assert mined(spark, given, anchors_at_once=3) == want


def test_scores_beyond_a_long_count_as_the_nearest(spark):
    given = [(0, [1e30], 1), (1, [1e30], 1), (2, [2.0], 2), (3, [1e-3], 2), (50, [4.0], 1)]
    assert mined(spark, given) == plain_negatives(given, lambda i: i % 50 == 0)


def test_no_vectors(spark):
    assert mined(spark, []) == Counter()
    assert mined(spark, [(0, [1.0], 1)]) == Counter()


@pytest.mark.parametrize("fields", [1, 3, 64])
def test_wide_integers_unpack_to_exact_products(fields):
    rng = np.random.default_rng(1)
    for low, high in ((-300, 300), (5, 9), (-9, -5), (-(1 << 20), 1 << 27), (-(1 << 30), 1 << 30), (0, 1)):
        left, right = rng.integers(low, high, (4, 7)), rng.integers(low, high, (fields, 7))
        packed = hard_negatives.Packed(right, hard_negatives.Anchors(left))
        assert [packed.scores(i).tolist() for i in range(4)] == (left @ right.T).tolist()
