"""Every operator against plain forms, on awkward small tables and on the smallest given ones."""

import random
import re
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillforge.llm import (
    chat,
    components,
    decontamination,
    licences,
    line_dedup,
    near_duplicates,
    neighbours,
    packing,
    personal_data,
    quality,
    queries,
    toxicity,
)

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, hit_items string, node bigint"
PROSE = " ".join(f"word{i} Größe{i % 7} x" for i in range(40))
EDITED = PROSE.replace("word20", "other20")


def doc(doc_id, text, source="s"):
    return (doc_id, text, "en", source, None if text is None else len(text), "extra", -5)


AWKWARD = [
    doc(5, PROSE),
    doc(3, PROSE),
    doc(4, EDITED),
    doc(9, PROSE.upper()),
    doc(9, PROSE.upper()),
    doc(1, None, None),
    doc(2, ""),
    doc(7, " \n\t "),
    doc(8, "one two"),
    doc(10, "ONE\ntwo"),
    doc(11, "a b c d e f g h i j k l m n o p " * 4000),
    doc(None, PROSE),
    doc(12, "mail a.b@c.de, _x@y.zz 1.2.3.4.5 999.1.1.1 4111 1111 1111 1111 +1 (743) 555-3824 \u0001 +12 3456789"),
    doc(13, "ü@ü.de 😀 me@host.example.com😀 10.0.0.255 00001.2.3.4 4111-1111-1111-1112 " + "1" * 5000 + " " + "a" * 20000),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def given(spark, base, name):
    return spark.read.parquet(f"{base}/{name}.parquet")


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# benchmark decontamination

ITEMS = [(1, "word1 größe1 X!"), (10, " ".join(PROSE.split()[30:50])), (2, ""), (3, None), (None, "one TWO"), (11, "zwei drei"), (1, "h i j k")]
CONTAMINATION = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_contamination_of_awkward_documents(spark, documents, block_bytes):
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id bigint, text string, doc_id string")
    got = decontamination.contamination(documents, items, block_bytes=block_bytes)
    assert rows(got, *CONTAMINATION) == Counter(brute.contamination([r[:2] for r in AWKWARD], ITEMS))


def test_contamination_of_the_given_table(spark, base):
    docs, items = given(spark, base, "documents"), given(spark, base, "benchmark")
    want = brute.contamination(texts(docs), [(r.item_id, r.text) for r in items.collect()])
    assert rows(queries.op1_decontamination(spark, base), *CONTAMINATION) == Counter(want) and any(w[2] for w in want)


def test_item_ids_may_hold_commas_or_nothing(spark):
    docs = spark.createDataFrame([(1, "red fish blue fish"), (2, "red fish")], "doc_id bigint, text string")
    items = spark.createDataFrame([("a,b", "red fish"), ("", "blue fish"), ("", "blue fish")], "item_id string, text string")
    got = {r.doc_id: (r.n_items, r.items_sha256) for r in decontamination.contamination(docs, items).collect()}
    assert got == {1: (2, brute.sha(",a,b")), 2: (1, brute.sha("a,b"))}
    alone = decontamination.contamination(docs, items.filter("item_id = ''")).filter("doc_id = 1").first()
    assert (alone.n_items, alone.items_sha256) == (1, brute.sha(""))


def test_nothing_to_search_or_search_for(spark, documents, none):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.contamination(none, empty).count() == 0
    assert decontamination.contamination(documents, empty).filter("contaminated").count() == 0
    assert decontamination.remove_contaminated(documents, empty).count() == len(AWKWARD)


def test_shift_tables_find_what_plain_search_finds():
    rng = random.Random(1)
    items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))) for i in range(12)]
    docs = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 3000)))) for i in range(30)]
    patterns = decontamination.build(items)
    words = decontamination.words_of(pa.array([t for _, t in docs]), decontamination.PLAIN)
    hit, found = decontamination.search(words, patterns)
    want = brute.contamination(docs, items)
    assert [int(hit[a:b].sum()) for a, b in zip(words.first[:-1], words.first[1:])] == [w[2] for w in want]
    assert [len(f) for f in found] == [w[3] for w in want]


# toxicity


def test_toxicity_orders_grades_and_leaves_clean_documents(spark, none):
    rng = random.Random(2)
    make = lambda bad: " ".join([*(rng.choice("red blue green sun sea hill") for _ in range(40)), *rng.choices(["vile", "nasty"], k=bad)])
    bad = [rng.choice([0, 0, 0, 1, 4, 9]) for _ in range(240)]
    docs = spark.createDataFrame([(i, make(b)) for i, b in enumerate(bad)] + [(None, None), (900, "")], "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, int(b > 0), "x") for i, b in enumerate(bad) if i % 2] + [(None, 1, "x"), (7, None, "x")], "doc_id bigint, toxic int, text string")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, marks).collect()}
    assert all(got[i].toxic == (b > 0) for i, b in enumerate(bad)) and not got[900].toxic and not got[None].toxic
    assert toxicity.toxicity(none, marks).count() == 0
    assert toxicity.toxicity(docs, marks.filter("toxic = 0")).agg(F.max("expected_severity")).first()[0] == 0


def test_toxicity_finds_most_labelled_rows(spark):
    base = "/root/testdata/sf0.01"
    marks = given(spark, base, "labels").filter("toxic is not null")
    got = queries.op2_toxicity(spark, base).join(marks.select("doc_id", F.col("toxic").alias("label")), "doc_id")
    assert got.filter("label = 0 and toxic").count() == 0
    assert got.filter("label = 1 and toxic").count() >= 0.85 * got.filter("label = 1").count()


# lines


def line_rows(docs):
    """Plain form: keeper of every line, by all pairs of distinct lines."""
    size = line_dedup.SHINGLE
    places, occurrences = {}, []
    for doc_id, text in docs:
        for no, line in enumerate((text or "").split("\n") if text is not None else []):
            norm = line.strip(" ").lower()
            occurrences.append((doc_id, no, norm))
            if norm and doc_id is not None:
                places[norm] = min(places.get(norm, (doc_id, no)), (doc_id, no))
    sets = {p: {n[i : i + size] for i in range(max(1, len(n) - size + 1))} for n, p in places.items()}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = brute.smallest_reachable(sets, links)
    return Counter((d, n, *(root[places[t]] if t and d is not None else (d, n)), not t or d is None or root[places[t]] == (d, n)) for d, n, t in occurrences)


def lines_fixture():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    base = [" ".join(word() for _ in range(14)) for _ in range(30)]
    near = [b.replace(b.split()[7], "CHANGED") for b in base]
    docs = [(i, "\n".join(rng.sample([*base, *near, "", "  ", "tiny", "ß"], 9))) for i in range(40)]
    return [*docs, (50, None), (51, ""), (None, base[0]), (60, docs[3][1]), (60, docs[3][1]), (61, base[2] * 60)]


LINES = ("doc_id", "line_no", "kept_doc_id", "kept_line_no", "kept")


def test_lines_against_all_pairs(spark, none):
    docs = lines_fixture()
    got = rows(line_dedup.judged_lines(spark.createDataFrame(docs, "doc_id bigint, text string")), *LINES)
    assert got == line_rows(docs)
    assert line_dedup.judged_lines(none).count() == 0


def test_edited_short_lines_against_all_pairs(spark):
    """The plain form here has a shingle length of its own."""
    rng = random.Random(11)
    lines = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n)) for n in range(20, 61) for _ in range(3)]
    lines = ["<" + x[1:-1] + ">" for x in lines]
    edited = [x[: len(x) // 2] + "7" + x[len(x) // 2 + 1 :] for x in lines]
    sets = [[{x[i : i + 5] for i in range(len(x) - 4)} for x in (a, b)] for a, b in zip(lines, edited)]
    alike = [100 * len(a & b) >= 75 * len(a | b) for a, b in sets]
    assert all(y for x, y in zip(lines, alike) if len(x) >= 39)
    docs = [(0, "\n".join(lines)), (1, "\n".join(edited))]
    got = line_dedup.judged_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).filter("not kept").collect()
    linked = {r.line_no for r in got}
    assert all(r.doc_id == 1 and (r.kept_doc_id, r.kept_line_no) == (0, r.line_no) and alike[r.line_no] for r in got)
    assert len(linked) >= 0.95 * sum(alike)


def test_near_copies_of_a_frequent_line_are_compared_with_it_only(spark, monkeypatch):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(40)]
    copies = [" ".join([*words[:k % 40], f"new{k:03}", *words[k % 40 + 1 :]]) for k in range(60)]
    docs = [(i, " ".join(words)) for i in range(5)] + [(10 + i, c) for i, c in enumerate(copies)]
    compared, keep = [], line_dedup.Scratch.keep

    def counted(self, df, label):
        copy = keep(self, df, label)
        compared.append(copy.count() if label in ("lines-pairs", "lines-rest") else 0)
        return copy

    monkeypatch.setattr(line_dedup.Scratch, "keep", counted)
    got = line_dedup.judged_lines(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert {(r.kept_doc_id, r.kept_line_no) for r in got.collect()} == {(0, 0)}
    assert sum(compared) <= 3 * len(copies)


def test_half_copies_of_a_frequent_line_are_not_compared_with_each_other(spark, monkeypatch):
    """All share buckets, and none is linked with the frequent line: only bitmaps tell them
    apart. Two are copies of one another, which the comparison of the bucket has to find."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    words = [word() for _ in range(60)]
    copies = [" ".join(word() if i in out else w for i, w in enumerate(words)) for out in (rng.sample(range(60), 7) for _ in range(40))]
    copies.append(copies[7][:100] + "#" + copies[7][101:])
    docs = [(i, " ".join(words)) for i in range(5)] + [(10 + i, c) for i, c in enumerate(copies)]
    compared, keep = [], line_dedup.Scratch.keep

    def counted(self, df, label):
        copy = keep(self, df, label)
        compared.append(copy.count() if label == "lines-rest" else 0)
        return copy

    monkeypatch.setattr(line_dedup.Scratch, "keep", counted)
    got = rows(line_dedup.judged_lines(spark.createDataFrame(docs, "doc_id bigint, text string")), *LINES)
    assert got == line_rows(docs)
    assert (50, 0, 17, 0, False) in got
    assert sum(compared) <= len(copies) // 4


def test_minima_are_those_of_all_shingles_and_lines_are_not_cut_before_the_scan(spark):
    """Lengths around a scanned row, characters of one to four bytes."""
    rng = random.Random(15)
    texts = ["".join(rng.choice("abcde \u00e9\u4e2d\U0001f600") for _ in range(n)) for n in [1, 4, 5, 6, 19, 20, 21, 36, 37, 68, 69, 700]]
    lines = spark.createDataFrame([(i, 1, x) for i, x in enumerate(texts)], "node bigint, n bigint, line string")
    signed = line_dedup.signatures(lines)
    each = lines.select("node", F.explode(line_dedup.shingles("line")).alias("h"))
    plain = each.groupBy("node").agg(*(F.shiftright(F.min(F.col("h").bitwiseXOR(F.lit(line_dedup._seed(k)))), 32).cast("int").alias(m) for k, m in enumerate(line_dedup.MINIMA)))
    assert rows(signed, "node", *line_dedup.MINIMA) == rows(plain, "node", *line_dedup.MINIMA)
    assert "transform(" not in signed._jdf.queryExecution().optimizedPlan().toString()


def test_parity_bitmaps_exclude_no_link(spark):
    """Lengths from one shingle on, up to where a bitmap of this size is full, repeats included."""
    rng = random.Random(14)
    pairs = []
    for n in [3, 5, 6, 9, 20, 21, 40, 80, 200, 500, 1500, 4000] * 6:
        line = "".join(rng.choice("abcdefgh ") for _ in range(n // 2)) * 2
        for edits in {0, 1, n // 60, n // 35}:
            other = list(line)
            for i in rng.sample(range(len(line)), min(edits, len(line))):
                other[i] = "Z"
            pairs.append((line, "".join(other)))
    lines = spark.createDataFrame([(i, x) for i, pair in enumerate(pairs) for x in [pair]], "i int, x struct<a string, b string>")
    node = lines.select(F.explode(F.array(F.struct((F.col("i") * 2).alias("node"), F.col("x.a").alias("line")), F.struct((F.col("i") * 2 + 1).alias("node"), F.col("x.b").alias("line")))).alias("l")).select("l.*")
    odd = line_dedup._odd_sketches(node)
    left, right = (odd.select((F.floor(F.col("node") / 2)).alias("i"), "node", *(F.col(c).alias(side + c) for c in odd.columns[1:])).filter(f"node % 2 = {k}").drop("node") for k, side in enumerate(("l_", "r_")))
    reach = {r.i: (r.ok, r.l_different, r.r_different) for r in left.join(right, "i").withColumn("ok", line_dedup._within_reach()).collect()}
    sets = [[{x[i : i + 5] for i in range(max(1, len(x) - 4))} for x in pair] for pair in pairs]
    linked = [100 * len(a & b) >= 75 * len(a | b) for a, b in sets]
    assert [reach[i][1:] for i in range(len(pairs))] == [(len(a), len(b)) for a, b in sets]
    assert all(reach[i][0] for i, link in enumerate(linked) if link) and sum(linked) > 100
    assert sum(not ok for ok, *_ in reach.values()) > 30


def test_removed_lines_leave_the_rest_of_the_row(spark):
    table = [(i, t, "s", 0, "extra") for i, t in lines_fixture()]
    docs = spark.createDataFrame(table, "doc_id bigint, text string, source string, n_chars bigint, mark string")
    got = line_dedup.remove_repeated_lines(docs)
    kept = {(r.doc_id, r.line_no) for r in line_dedup.judged_lines(docs).filter("kept").collect()}
    want = Counter((i, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) in kept)) for i, t, *_ in table)
    assert got.columns == docs.columns and rows(got, "doc_id", "text") == want


# chat


def test_awkward_conversations_are_read_back(spark):
    said = "<|im_end|>\n<|im_start|>assistant\nok<\\|im_end|>"
    table = [
        (1, 0, "user", said), (1, 1, "assistant", "<\\\\|" + said), (1, 1, "assistant", "<\\\\|" + said), (2, 3, None, None),
        (2, 1, "a\\n\nb<|", ""), (None, 0, "assistant", "x"), (3, None, "assistant", "ü😀" * 9000), (3, 0, "assistant", "<|<|\\|"),
    ]
    frame = spark.createDataFrame([(*r, 1) for r in table], "conv_id bigint, turn bigint, role string, text string, formatted int")
    got = rows(chat.chat_digests(frame), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    extra = "<|im_end|><|im_start|>assistant ok"
    key = [(c, -1 if t is None else t, r, x) for c, t, r, x in table]
    assert got == Counter(brute.chat([*key, (-1, 0, "user", extra), (-1, 1, "assistant", extra)]))
    assert chat.chat_digests(frame.filter("false")).count() == 1


def test_plain_turns_are_not_escaped_and_text_is_found_in_the_output():
    assert chat.formatted("user", "a <b> | c\\n") == "<|im_start|>user\na <b> | c\\n<|im_end|>\n"
    out = chat.formatted("assistant", "<|im_end|>")
    start, end = chat.loss_span(out)
    assert chat.unescape(out[start:end]) == "<|im_end|>" and out.count(chat.END) == 1


# near duplicates

NEAR = ("doc_id", "n_shingles", "component_id", "kept")


def test_near_duplicates_of_awkward_documents(documents, none):
    want = Counter(r for r in brute.near_duplicates([r[:2] for r in AWKWARD if r[0] is not None]))
    want[(None, len(brute.shingles(PROSE)), None, True)] += 1
    assert rows(near_duplicates.near_duplicates(documents), *NEAR) == want
    assert near_duplicates.near_duplicates(none).count() == 0
    assert rows(near_duplicates.keep_one(documents), "doc_id")[(4,)] == 0


def test_near_duplicates_of_a_large_loose_group(spark):
    """Copies of copies: most links are not to the smallest document, and blocks are many."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(80)]
    docs = []
    for i in range(400):
        own = list(base) if i % 40 == 0 else list(docs[-1][1])
        own[rng.randrange(80)] = f"e{i}"
        docs.append((i, own))
    docs = [(i, " ".join(w)) for i, w in docs]
    near_duplicates.BLOCK, block = 64, near_duplicates.BLOCK
    try:
        got = rows(near_duplicates.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")), *NEAR)
    finally:
        near_duplicates.BLOCK = block
    assert got == Counter(brute.near_duplicates(docs))


def test_an_id_with_two_texts_in_a_split_bucket(spark):
    """Texts that share bands but no link, under ids that hold others as well, and repeated rows."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(60):
        own = list(words)
        for k in rng.sample(range(120), 6):
            own[k] = f"e{i}x{k}"
        docs += [(i, " ".join(own))] * (30 if i in (0, 7) else 1)
        if i % 3 == 0:
            docs.append((i, " ".join(f"z{i}y{k}" for k in range(50))))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = Counter(brute.near_duplicates(docs))
    assert rows(near_duplicates.near_duplicates(frame), *NEAR) == want


def test_near_duplicates_of_the_given_table(spark, base):
    assert rows(queries.op5_near_duplicates(spark, base), *NEAR) == Counter(brute.near_duplicates(texts(given(spark, base, "documents"))))


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(3)
    for share in (0.75, 0.9, 1.0):
        common, own = rng.integers(0, 2**63, int(2000 * share)), rng.integers(0, 2**63, 2 * int(2000 * (1 - share)))
        sets = [np.unique(np.concatenate([common, own[k::2]]).astype(np.uint64)) for k in (0, 1)]
        truth = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        bits = near_duplicates.odd_sketch(near_duplicates.minhash(np.concatenate(sets), np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])])))
        assert abs(near_duplicates.estimate(int(np.bitwise_count(bits[0] ^ bits[1]).sum())) - truth) < 0.2


def test_components_of_a_chain_a_star_and_nothing(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (None, 3)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.root for r in components.components(frame, "test").collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100)}
    assert components.components(frame.filter("false"), "test").count() == 0


# personal data

PERSONAL = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def test_personal_data_of_awkward_documents(documents, none):
    got = personal_data.personal_data(documents)
    assert rows(got, *PERSONAL) == Counter((d, *brute.personal_data(t)[0]) for d, t, *_ in AWKWARD)
    assert {(r.doc_id, r.spans) for r in got.collect()} >= {(d, brute.personal_data(t)[1]) for d, t, *_ in AWKWARD if d == 1}
    assert personal_data.personal_data(none).count() == 0


def test_contexts_disclose_unseen_identifiers(spark):
    seeds = [(i, f"please reach server 10.0.0.{i} now") for i in range(1, 40)]
    unseen = [(100, "please reach server host-7788-a now"), (101, "a price of 12345678 was paid")]
    got = {r.doc_id: r.spans for r in personal_data.personal_data(spark.createDataFrame([*seeds, *unseen], "doc_id bigint, text string")).collect()}
    assert got[1] == "ip:20:28" and got[100].startswith("ip:") and got[101] == ""


def test_contexts_with_many_unseen_identifiers(spark):
    """Of the numbers after 'call' and of the hosts after 'server' 30 % and half are unseen."""
    docs = [(i, f"call +1 743 555 {3000 + i} today") for i in range(35)] + [(100 + i, f"call 555-{4000 + i} today") for i in range(15)]
    docs += [(200 + i, f"reach server 10.0.0.{i} now") for i in range(20)] + [(300 + i, f"reach server node{i}-7788 now") for i in range(20)]
    docs += [(400 + i, f"the 10.0.1.{i} the") for i in range(3)] + [(500 + i, f"the 2024-{1000 + i} the") for i in range(30)]
    got = {r.doc_id: r.spans for r in personal_data.personal_data(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert all(got[100 + i] == "phone:5:13" for i in range(15))
    assert all(got[300 + i] == f"ip:13:{22 + len(str(i))}" for i in range(20))
    assert all(got[500 + i] == "" for i in range(30))


def test_unseen_identifiers_are_whole_tokens(spark):
    docs = [(i, f"please reach server 10.0.0.{i} now") for i in range(1, 40)]
    docs += [(i, f"please write mail x{i}@a.example now") for i in range(50, 90)]
    ends = {
        100: ("please reach server ", "host-7788-a", ", now", "ip"),
        101: ("please reach server ", "AB-12345", " now", "ip"),
        102: ("please reach server:", "n7", " now", "ip"),
        103: ("please write mail ", "jane@localhost", ". now", "email"),
        104: ("please write mail <", "jane.doe", "> now", "email"),
        105: ("please write mail ", "jürgen@büro", " now", "email"),
    }
    docs += [(i, before + value + after) for i, (before, value, after, _) in ends.items()] + [(110, "please write mail, now")]
    got = {r.doc_id: r.spans for r in personal_data.personal_data(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert {i: got[i] for i in ends} == {i: f"{k}:{len(b)}:{len(b) + len(v)}" for i, (b, v, _, k) in ends.items()}
    assert got[110] == ""


def test_personal_data_of_the_given_table(spark, base):
    want = Counter((d, *brute.personal_data(t)[0]) for d, t in texts(given(spark, base, "documents")))
    assert rows(queries.op6_personal_data(spark, base), *PERSONAL) == want


# quality


def test_quality_on_held_out_labels(spark):
    got = queries.op7_quality(spark, "/root/testdata/sf0.01").join(given(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    held = got.filter("held_out")
    assert held.filter("predicted = quality").count() >= 0.97 * held.count() > 50
    assert held.filter("score < 0 or score > 1 or score is null").count() == 0


def test_quality_of_awkward_tables(spark, documents, none):
    marks = spark.createDataFrame([(5, 1, "x"), (7, 0, "x"), (8, None, "x"), (None, 1, "x"), (77, 1, "x")], "doc_id bigint, quality int, text string")
    got = quality.quality_scores(documents, marks)
    assert got.count() == len(AWKWARD) and got.filter("score between 0 and 1").count() == len(AWKWARD)
    assert quality.quality_scores(none, marks).count() == 0
    assert quality.quality_scores(documents, marks.filter("false")).filter("score = 1.0").count() == len(AWKWARD)
    assert quality.keep_good(documents, marks.filter("false")).columns == documents.columns


def test_isotonic_fit_does_not_fall():
    at, y = np.arange(6.0), np.array([0, 2, 1, 1, 3, 2.0])
    xs, ys = quality.pool_adjacent_violators(at, y, np.ones(6))
    assert (np.diff(ys) >= 0).all() and xs[0] == 0 and np.isclose(np.interp(2.0, xs, ys), 4 / 3)


# neighbours


def exact(vectors, asked, k=10):
    fine = {i: np.array(v, float) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 4}
    out = []
    for q in asked:
        if q in fine:
            near = sorted((float(np.sqrt(((fine[q] - v) ** 2).sum())), i) for i, v in fine.items() if i != q)[:k]
            out += [(q, r + 1, i, round(s, 9)) for r, (s, i) in enumerate(near)]
    return Counter(out)


def test_neighbours_of_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, rng.standard_normal(4).tolist()) for i in range(60)]
    vectors += [(200 + i, vectors[5][1]) for i in range(40)] + [(400, None), (401, [0.0] * 4), (402, [1.0, None, 1.0, 1.0]), (403, [float("nan")] * 4)]
    vectors += [(404, [1.0]), (None, [1.0] * 4), (500, vectors[0][1]), (500, vectors[0][1])]
    frame = spark.createDataFrame([(*v, 0.0) for v in vectors], "vec_id bigint, embedding array<double>, score double")
    got = neighbours.nearest(frame, frame.filter("vec_id % 100 = 0"))
    want = exact(dict(vectors).items(), [0, 200, 400, 500])
    assert Counter((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got.collect()) == want
    assert neighbours.nearest(frame.filter("false"), frame.filter("false")).count() == 0


def test_queries_take_the_width_of_the_table(spark):
    """Most queries have another width than most vectors: they take no part."""
    vectors = [(i, [float(i), 1.0]) for i in range(1, 30)] + [(100 * i, [float(i)]) for i in range(1, 9)] + [(900, [2.2, 1.0])]
    frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(frame, frame.filter("vec_id % 100 = 0"), k=2)
    assert [(r.query_id, r.vec_id) for r in got.orderBy("query_id", "rank").collect()] == [(900, 2), (900, 3)]


def test_blocks_of_queries_find_alike(spark, monkeypatch):
    rng = np.random.default_rng(4)
    frame = spark.createDataFrame([(i, rng.standard_normal(6).tolist()) for i in range(300)], "vec_id bigint, embedding array<double>")
    asked = frame.filter("vec_id % 20 = 0")
    one = rows(neighbours.nearest(frame, asked), "query_id", "rank", "vec_id", "score")
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    monkeypatch.setattr(neighbours, "ROWS", 37)
    assert rows(neighbours.nearest(frame, asked), "query_id", "rank", "vec_id", "score") == one and len(one) == 150


def test_neighbours_recall(spark):
    base = "/root/testdata/sf0.1"
    found = queries.op8_neighbours(spark, base).groupBy("query_id").agg(F.collect_set("vec_id").alias("ids")).collect()
    table = given(spark, base, "embeddings").collect()
    ids, points = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    shares = []
    for r in found:
        far = np.sqrt(((points - points[ids == r.query_id]) ** 2).sum(axis=1))
        far[ids == r.query_id] = np.inf
        shares.append(len(set(ids[np.argsort(far)[:10]].tolist()) & set(r.ids)) / 10)
    assert np.mean(shares) >= 0.9


@pytest.mark.parametrize(
    "line", ["Copyright Jane Doe", "Copyright [year] [fullname]", "(c) 2020 X", "Copyright The Foo Authors. All rights reserved.",
             "// Copyright (c) 2001-2024 X, Y", "Copyright (c) 2020 X\nAll rights reserved."]
)
def test_copyright_lines_do_not_hide_a_licence(spark, line):
    body = re.sub(r"(?i)\A.*?copyright[^\n]*\n", "", licences.KNOWN["MIT"], count=1, flags=re.S) if "opyright (c)" in licences.KNOWN["MIT"][:200] else licences.KNOWN["MIT"]
    frame = spark.createDataFrame([(1, f"{line}\n\n{body}"), (2, f"{line} {body}"), (3, line)], "doc_id bigint, text string")
    got = {r.doc_id: r.licence_id for r in licences.scan(frame, licences.known_digests(spark)).collect()}
    assert got[1] == "MIT" and got[3] is None


def test_a_severity_that_is_no_number_is_left_alone(spark):
    docs = spark.createDataFrame([(i, "vile nasty" if i % 2 else "blue sea") for i in range(60)], "doc_id bigint, text string")
    marks = spark.createDataFrame([(i, i % 2, "high") for i in range(60)], "doc_id bigint, toxic int, severity string")
    assert toxicity.toxicity(docs, marks).filter("toxic").count() == 30


# packing


@pytest.fixture(scope="module")
def encode():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_of_awkward_documents(spark, none, encode):
    odd = "It's IT'S 'sS á é,  x y \x1cz <|endoftext|><|ENDOFTEXT|> don't!! abc''d Å Å ﬁ 漢字 \u0000 z‍"
    table = [(d, t) for d, t, *_ in {r[0]: r for r in AWKWARD}.values()] + [(20, odd), (21, "x " * 2047), (22, "x " * 4095)]
    got = packing.pack(spark.createDataFrame([(*r, 0) for r in table], "doc_id bigint, text string, length int"), queries.tokenizer_path())
    brute.check_packing(table, [r.asDict() for r in got.collect()], encode)
    assert packing.pack(none, queries.tokenizer_path()).count() == 0


def test_packing_of_the_given_table(spark, base, encode):
    pieces = [r.asDict() for r in queries.op9_packing(spark, base).collect()]
    padding = brute.check_packing(texts(given(spark, base, "documents")), pieces, encode)
    assert padding < 0.1 * sum(p["length"] for p in pieces)


@pytest.mark.parametrize("tokens", [1, 15, 16, 2047, 2048, 2049, 9999])
def test_pieces_cover_a_document(tokens):
    assert sum(packing.pieces(tokens)) == tokens


# licences


def test_licences_in_other_dress(spark, none):
    mit = licences.KNOWN["MIT"]
    dressed = mit.upper().replace("\n", "\n * ").replace("COPYRIGHT (C) <YEAR> <COPYRIGHT HOLDERS>", "Copyright (c) 2020 A. Person").replace("LICENSE", "Licence")
    table = [(1, mit), (2, dressed), (3, mit + " more"), (4, None), (5, ""), (6, "Copyright (c) 2020 X"), (7, "released under the mit LICENCE"), (1, mit), (None, mit)]
    frame = spark.createDataFrame([(*r, "x") for r in table], "doc_id bigint, text string, digest string")
    got = licences.scan(frame, licences.known_digests(spark))
    want = Counter({(1, "MIT"): 2, (2, "MIT"): 1, (3, None): 1, (4, None): 1, (5, None): 1, (6, None): 1, (7, "MIT-notice"): 1, (None, "MIT"): 1})
    assert rows(got, "doc_id", "licence_id") == want
    assert licences.scan(none, licences.known_digests(spark)).count() == 0


def test_full_licence_texts(spark):
    """Texts as their files give them, and in the forms projects use."""
    stored = {f.name.removesuffix(".txt"): f.read_text() for f in licences.files("tillforge.llm").joinpath("licence_texts").iterdir()}
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0"} <= set(stored)
    bsd = stored["BSD-3-Clause"].split("\n", 1)[1].replace("Copyright (c) <year> <owner>", "Copyright (c) 2011, A. Person\nAll rights reserved.")
    gpl = stored["GPL-3.0"].split("How to Apply")[0].rstrip()
    mit = licences.KNOWN["MIT"].split("\n", 1)[1]
    cases = [*((k.split("@")[0], t) for k, t in stored.items()), ("BSD-3-Clause", bsd), ("GPL-3.0", gpl), ("MIT", mit), (None, gpl[:9000])]
    frame = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id bigint, text string")
    got = {r.doc_id: r.licence_id for r in licences.scan(frame, licences.known_digests(spark)).collect()}
    assert got == {i: k for i, (k, _) in enumerate(cases)}
