"""Operators on single texts: licenses, templates, quality, pages, encoding, lists."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regraft.llm.bpe import bpe_decode, bpe_digests, bpe_encode, lowered
from regraft.llm.decontaminate import _plain_words, _typed_words, benchmark_items, benchmark_windows, contamination, decontaminated, window_anchors, with_anchors
from regraft.llm.html import Page, decode, extract, features, fit_pages, main_text
from regraft.llm.licenses import TEMPLATES, WORDS, align, license_scan, longest_increasing
from regraft.llm.quality import SLOTS, accepted, descend, indicators, quality
from regraft.llm.queries import VOCABULARIES
from regraft.llm.urls import judge, validity

VOCABULARY = f"{VOCABULARIES}/word_bpe_49k.json"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


ODD = [
    None, "", " \n\t", "It's I'LL we've ΑΣ ΣΑΣ. İstanbul ﬁ ½ ٣ 日本語 é <|endoftext|>a <|startoftext|> x",
    "a\u0085b c \x1c\x1d d_e __ '' 's'S '", "ẞ ŉ ǅ ​﻿ 👍🏽 \x00\x01", "a" * 3000, "word " * 3000, "ΑΣ Σ' ΑΣΒ",
]


def test_encoding_of_odd_texts(documents, tokenizer):
    rows = {r.doc_id: r for r in bpe_decode(bpe_encode(documents(*ODD), VOCABULARY), VOCABULARY).collect()}
    for i, text in enumerate(ODD):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(rows[i].ids), "<u4").tolist() == ids
        assert rows[i].decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_encoding_of_the_table(corpus, tokenizer):
    table, rows = corpus
    got = {r.doc_id: r.n_tokens for r in bpe_digests(table, VOCABULARY).collect()}
    assert got == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in rows}
    assert lowered("ΑΣ") == "ασ" and bpe_digests(table.where("false"), VOCABULARY).count() == 0


def test_licenses_are_found(corpus, documents):
    table, rows = corpus
    got = {(r.doc_id, r.license) for r in license_scan(table).collect() if r.coverage == 1}
    lines = {n: TEMPLATES[n] for n in ("Apache-2.0", "MIT", "GPL-3.0", "CC-BY-NC-4.0")}
    assert {(i, n) for i, t in rows for n, line in lines.items() if line in t} <= got
    notice = TEMPLATES["GPL-3.0"]
    odd = [None, "", f"{notice}. x {notice.upper()}", notice.replace("General", "Common"), "licensed public license " * 50, "word " * 20_000 + notice]
    found = [(r.doc_id, r.license, round(r.coverage, 2)) for r in license_scan(documents(*odd)).collect()]
    assert sorted(f for f in found if f[1] == "GPL-3.0") == [(2, "GPL-3.0", 1.0), (2, "GPL-3.0", 1.0), (3, "GPL-3.0", 0.92), (5, "GPL-3.0", 1.0)]


def test_alignment_is_increasing_and_equal():
    draw = random.Random(1)
    for _ in range(200):
        text, template = ([draw.choice("abcdefgh") for _ in range(draw.randint(0, 20))] for _ in range(2))
        pairs = align(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
    assert [v for v in (3, 1, 2, 5, 4) if v in {(3, 1, 2, 5, 4)[i] for i in longest_increasing([3, 1, 2, 5, 4])}] in ([1, 2, 5], [1, 2, 4])
    assert WORDS.findall("v2.0-x") == ["v2", "0", "x"]


def test_leaks_are_found(spark, corpus, folder):
    table, rows = corpus
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    whole = {(i, k) for i, t in rows for k, x in items.items() if " ".join(x.split()) in " ".join(t.split())}
    got = {(r.doc_id, r.item_id) for r in contamination(table, benchmark).collect()}
    assert whole <= got
    kept = {r.doc_id for r in decontaminated(table, benchmark).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _ in got}


def test_templates_with_other_values(spark, documents):
    items = [
        (1, "If Anna buys 5 apples for 3 dollars each then how much does Anna pay in total today?"),
        (2, "too short"), (3, None), (4, "alpha beta gamma delta epsilon zeta"),
    ]
    benchmark = spark.createDataFrame([(*i, "z") for i in items], "item_id int, text string, doc_id string")
    texts = [
        None, "", "so if Bertha buys 12 apples for 7 euros each then how much does Bertha pay in total today?",
        "If Anna buys 5 apples for 3 dollars each, then how much does Anna pay in total today", "If Anna buys pears " * 40,
        "x alpha beta gamma delta epsilon zeta y", "too short",
    ]
    got = sorted((r.doc_id, r.item_id, r.kind) for r in contamination(documents(*texts), benchmark).collect())
    assert got == [(2, 1, "reparameterised"), (3, 1, "exact"), (5, 4, "exact")]
    assert contamination(documents(*texts), benchmark.where("false")).count() == 0
    assert contamination(documents("x").where("false"), benchmark).count() == 0


def test_values_must_map_one_to_one(spark, documents):
    text = "first take 3 of the red balls and later take 3 of the blue ones back"
    benchmark = spark.createDataFrame([(1, text)], "item_id int, text string")
    texts = [text.replace("3", "8"), text.replace("3", "8", 1).replace("take 3 of the blue", "take 9 of the blue")]
    rows = contamination(documents(*texts), benchmark, 0.9).collect()
    assert [(r.doc_id, r.kind) for r in rows] == [(0, "reparameterised")]


def test_values_may_coincide(spark, documents):
    items = [
        (1, "If Anna buys 5 apples for 3 dollars each then how much does Anna pay in total today?"),
        (2, "walk 3 km to the old mill and then another 5 miles along the river bank until dusk"),
        (3, "first add 4 to the sum and write it down then take 6 off and after a long and quiet pause of the whole class add 4 to the sum"),
    ]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    texts = [
        items[0][1].replace("5", "4").replace("3", "4"), items[1][1].replace("3", "2").replace("5 miles", "5 km"),
        items[2][1].replace("6", "7").replace("class add 4", "class add 9"),
    ]
    got = sorted((r.doc_id, r.item_id, r.kind) for r in contamination(documents(*texts), benchmark).collect())
    assert got == [(0, 1, "reparameterised"), (1, 2, "reparameterised"), (2, 3, "reparameterised")]


def test_windows_of_placeholders_are_found_word_for_word(spark, documents):
    items = [
        (1, "What is 15% of 80?"), (2, "4 8 15 16 23 42 108 7 9 11"), (3, "a Short History Of Nearly Everything In Seven Parts And More"),
        (4, "sum 3 and 4 and 5, then 6 and 7: 8 9 10 11 12 13 14 15 16"),
    ]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    texts = [
        "now, what is 15% of 80? easy", "x 4 8 15 16 23 42 108 7 9 11 y", "the book a Short History Of Nearly Everything In Seven Parts And More", items[3][1],
        "now what is 16% of 80", "x 5 9 16 17 24 43 109 8 10 12 y",
    ]
    got = sorted((r.doc_id, r.item_id, r.kind) for r in contamination(documents(*texts), benchmark).collect())
    assert got == [(0, 1, "exact"), (1, 2, "exact"), (2, 3, "exact"), (3, 4, "exact")]


def test_names_that_begin_sentences_and_other_letter_case(spark, documents):
    item = "Tom has 5 apples in a basket. Tom buys 3 more at the market. Tom then eats 2 of them. How many are left?"
    lower = "when we met in paris last spring john told mary about the old house"
    benchmark = spark.createDataFrame([(1, item), (2, "When we met in Paris last spring John told Mary about the old house")], "item_id int, text string")
    ann = item.replace("Tom", "Ann")
    texts = [ann, f"An example. {ann}", item.lower(), lower, lower.upper(), item.replace("5", "6").lower(), ann.replace("Ann buys", "Bea buys").replace("Ann then", "Eve then")]
    got = sorted((r.doc_id, r.item_id, r.kind) for r in contamination(documents(*texts), benchmark, 0.9).collect())
    assert got == [(0, 1, "reparameterised"), (1, 1, "reparameterised"), (2, 1, "exact"), (3, 2, "exact"), (4, 2, "exact"), (5, 1, "reparameterised")]


def test_only_texts_with_an_anchor_are_typed(spark, documents):
    """What holds a window holds its anchor, other values, single words and stray characters included; the rest goes no further."""
    items = [(1, "add 3 red 4 blue and 5 green apples"), (2, "alpha beta gamma delta epsilon zeta eta theta iota"), (3, "hm yes"), (4, "Why?")]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    known = benchmark_items(benchmark, 1)
    anchors = window_anchors(benchmark_windows(known, [1, 2, 8]), known)
    assert {r.size for r in anchors.collect()} == {1, 2, 4}
    texts = [
        "so add 7 red 9 blue and 8 green apples", "ALPHA, beta g\u0001amma\tdelta epsilon ... zeta eta theta!", "oh: hm ... yes", "(why)",
        "alpha beta, then gamma", "red 4 and blue", "yes, hm", None, "",
    ]
    table = documents(*texts).where("text IS NOT NULL").selectExpr("doc_id AS doc", "doc_id AS mark", "text")
    assert sorted(r.doc for r in with_anchors(table, anchors).collect()) == [0, 1, 2, 3]
    assert with_anchors(table, anchors.where("false")).count() == 0
    got = sorted((r.doc_id, r.item_id) for r in contamination(documents(*texts), benchmark, shortest=1).collect())
    assert got == [(0, 1), (1, 2), (2, 3), (3, 4)]


def items_by_hand(spark, rows, items):
    """Coverage and kind of every item in every text, all diagonals tried."""
    frame = spark.createDataFrame([(str(k), t) for k, t in [*enumerate(rows), *(("i", t) for t in items)] if t is not None], "k string, text string")
    split = {r.text: (r.typed, r.plain) for r in frame.select("text", _typed_words(frame.text).alias("typed"), _plain_words(frame.text).alias("plain")).collect()}
    out = {}
    for (k, text), (m, item) in itertools.product(enumerate(rows), enumerate(items)):
        theirs, their_plain = split[item]
        n = min(8, len(theirs))
        if text is None or n < 5:
            continue
        ours, our_plain = split[text]
        first, literal = {}, {}
        for a in range(len(theirs) - n + 1):
            first.setdefault(tuple(their_plain[a : a + n]), a)
            literal[a] = sum(w[0] != "\x01" for w in theirs[a : a + n]) >= 5
        windows, met = list(first.values()), {}
        for d in range(-len(theirs), len(ours)):
            inside = [a for a in range(len(theirs) - n + 1) if 0 <= a + d <= len(ours) - n]
            if not any(their_plain[a : a + n] == our_plain[a + d : a + d + n] or literal[a] and theirs[a : a + n] == ours[a + d : a + d + n] for a in inside):
                continue
            both = [(a, a + d) for a in range(len(theirs)) if 0 <= a + d < len(ours)]
            slot = {a: theirs[a][0] == "\x01" and theirs[a] == ours[b] for a, b in both}
            to = Counter((theirs[a], their_plain[a], our_plain[b]) for a, b in both if slot[a])
            of = Counter((theirs[a], their_plain[a]) for a, _ in both if slot[a])
            same = {a: their_plain[a] == our_plain[b] for a, b in both}
            agrees = {a: same[a] or slot[a] and 2 * to[theirs[a], their_plain[a], our_plain[b]] > of[theirs[a], their_plain[a]] for a, b in both}
            for a in set(inside) & set(windows):
                changed = not all(same[x] for x in range(a, a + n))
                if all(agrees[x] for x in range(a, a + n)) and (literal[a] or not changed):
                    met[a] = min(changed, met.get(a, True))
        if met:
            best = max([(len(met) / len(windows), len(met), len(windows))] + [
                (sum(literal[a] for a in met) / c, sum(literal[a] for a in met), c) for c in [sum(literal[a] for a in windows)] if c])
            if best[0] >= 0.5:
                out[k, m] = (best[1], best[2], "reparameterised" if any(met.values()) else "exact")
    return out


def test_contamination_by_hand(spark, documents):
    draw = random.Random(7)
    words = "the river ran past 3 old mills where Anna sold 12 kg of flour and Tom paid 5 dollars for bread while rain fell on Sunday over seven hills".split()
    items = [" ".join(draw.choices(words, k=n)) for n in (5, 7, 8, 12, 20, 40)] + ["Anna sold 12 kg of flour and Tom paid 5 dollars for bread"]
    texts = [None, "", "3 4 5"]
    for item in items * 3:
        text = "".join(str(draw.randrange(2, 30)) if w.isdigit() and draw.random() < 0.6 else draw.choice(["Eve", "Bob"]) if w in ("Anna", "Tom") and draw.random() < 0.5 else w for w in re.split("( )", item))
        cut = draw.randrange(0, 3)
        texts.append(" ".join(draw.choices(words, k=6)) + " " + text[cut:] + " " + " ".join(draw.choices(words, k=4)))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    got = {(r.doc_id, r.item_id): (r.n_windows, r.item_windows, r.kind) for r in contamination(documents(*texts), benchmark).collect()}
    assert got == items_by_hand(spark, texts, items) and {k for *_, k in got.values()} == {"exact", "reparameterised"}


def test_contaminated_rows_go_by_their_own_text(spark, documents):
    item = "alpha beta gamma delta epsilon zeta eta theta iota"
    benchmark = spark.createDataFrame([(1, item), (2, "two words")], "item_id int, text string")
    table = documents((None, f"x {item}"), (None, "clean"), (7, item), (7, "clean too"), (7, item), (8, "here two, words"), (9, None))
    got = [(r.doc_id, r.item_id) for r in contamination(table, benchmark).collect()]
    assert sorted(got, key=str) == [(7, 1), (None, 1)]
    kept = decontaminated(table, benchmark)
    assert kept.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(7, "clean too"), (8, "here two, words"), (9, None), (None, "clean")]
    short = sorted(((r.doc_id, r.item_id) for r in contamination(table, benchmark, shortest=1).collect()), key=str)
    assert short == [(7, 1), (8, 2), (None, 1)]


def test_quality_on_held_out_rows(spark, folder):
    place = folder.replace("0.001", "0.01")
    table, labels = (spark.read.parquet(f"{place}/{n}.parquet") for n in ("documents", "labels"))
    scored = quality(table, labels)
    joined = scored.where("held_out").join(labels, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in joined)
    assert len(joined) > 40 and right >= 0.93 * len(joined)
    assert scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0 and scored.count() == table.count()


def test_quality_without_classes(spark, documents):
    table = documents(None, "", "a b", "a b", "long " * 5000)
    labels = spark.createDataFrame([(2, 1), (3, None), (99, 0)], "doc_id long, quality int")
    assert [r.score > 0.5 for r in quality(table, labels).collect()] == [True] * 5
    assert [r.score for r in quality(table, labels.where("false")).collect()] == [0.5] * 5
    assert accepted(table, labels).columns == table.columns
    assert quality(table.where("false"), labels).count() == 0
    unnamed = quality(documents((None, "a b"), (None, None)), labels).collect()
    assert [(r.held_out, r.predicted in (0, 1)) for r in unnamed] == [(False, True)] * 2


def test_descent_separates():
    rows = [np.array([1, 5], np.uint16), np.array([2, 5], np.uint16)] * 10
    values = [np.array([1.0, 1.0])] * 20
    weights = descend(rows, values, np.array([1.0, -1.0] * 10), np.ones(20))
    assert weights[1] > 0 > weights[2] and len(weights) == SLOTS + 1
    assert len(indicators("")) == 0 and indicators("aa aa").dtype == np.uint16


PAGE = (
    '<html><head><title>T</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href="/a">Menu</a></li></ul></nav>'
    '<article><h1>Head &amp; line</h1><p><b>First,   text\n of the page.<br><p>Second text.</p></article><footer>&copy; foot</footer></body></html>'
)


def test_pages(spark, folder):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", PAGE[: PAGE.index("</article>")]), (1, "u", PAGE)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in main_text(pages).collect())
    want = "Head & line\nFirst, text of the page.\nSecond text."
    assert got == [(1, want, len(want)), (1, want, len(want)), (2, "", 0), (3, "", 0), (4, want, len(want))]
    assert main_text(pages.where("false")).count() == 0
    table = spark.read.parquet(f"{folder}/pages.parquet")
    texts = {r.page_id: r.text for r in main_text(table).collect()}
    for r in table.collect():
        inside = Page(r.html.split("<article>")[1].split("</article>")[0])
        assert texts[r.page_id] == inside.text([True] * len(inside.nodes))


def test_decoding_is_consistent():
    draw = random.Random(3)
    for source in (PAGE, "<div><p>a</p><div><p>b<span>c</div></div>" * 5):
        page = Page(source)
        for _ in range(30):
            kept = decode(page, [draw.uniform(-6, 6) for _ in page.nodes])
            for i, n in enumerate(page.nodes):
                chain = []
                while i >= 0:
                    chain.append(kept[i])
                    i = page.nodes[i].parent
                assert not any(a and not b and any(chain[k + 2 :]) for k, (a, b) in enumerate(zip(chain, chain[1:])))


def test_odd_pages():
    trees = fit_pages([PAGE] * 8)
    odd = ["<", "<p", "<p>x<p>y</b></p>z<!-- <p>no", "<b>" * 3000 + "x", '<a href="x>y">t</a>', "<div>" * 2000 + "deep" + "</div>" * 2000]
    assert all(isinstance(t, str) for t in extract(odd, trees)) and features(Page("")).shape[0] == 1


def test_paths_keep_their_letter_case(spark):
    day = F.timestamp_add("DAY", F.col("n"), F.lit("2024-01-01").cast("timestamp"))
    entries = spark.createDataFrame(
        [("a", "Example.COM/Casino/", "add", 0), ("a", "example.com/casino", "add", 0), ("a", "example.com/casino", "remove", 5)],
        "list string, pattern string, action string, n int",
    ).withColumn("dated", day)
    captures = spark.createDataFrame(
        [(1, "http://EXAMPLE.com/Casino/a", 9), (2, "http://example.com/casino/a", 9), (3, "http://example.com/casino", 3), (4, "http://example.com/CASINO", 3)],
        "page_id long, url string, n int",
    ).withColumn("fetched", day)
    got = sorted((r.page_id, r.blocked, r.pattern) for r in judge(captures, entries).collect())
    assert got == [(1, True, "example.com/Casino"), (2, False, None), (3, True, "example.com/casino"), (4, False, None)]


def test_lists_at_fetch_time(spark):
    day = F.timestamp_add("DAY", F.col("n"), F.lit("2024-01-01").cast("timestamp"))
    entries = spark.createDataFrame(
        [
            ("a", "Example.com", "add", 10), ("a", "example.com", "add", 20), ("a", "example.com", "remove", 30), ("a", "example.com", "add", 40),
            ("b", "www.example.com/x/", "add", 0), ("b", "tie.org", "add", 5), ("b", "tie.org", "remove", 5), (None, "n.org", "add", 1), ("c", "q.org", "drop", 1),
        ],
        "list string, pattern string, action string, n int",
    ).withColumn("dated", day)
    assert sorted((r.pattern, r.until is None) for r in validity(entries).collect()) == [
        ("example.com", False), ("example.com", True), ("tie.org", True), ("www.example.com/x", True),
    ]
    captures = spark.createDataFrame(
        [
            (1, "http://example.com/", 9), (2, "http://example.com/", 10), (3, "https://u@sub.EXAMPLE.com:80/a?b", 29), (4, "http://example.com", 30),
            (5, "http://example.com", 400), (6, "http://www.example.com/x/y", 35), (7, "http://www.example.com/xy", 35), (8, None, 50),
            (9, "http://tie.org/", None), (10, "http://tie.org/", 6), (11, "notexample.com", 12), (12, "http://notexample.com", 12), (2, "http://example.com/", 10),
        ],
        "page_id long, url string, n int",
    ).withColumn("fetched", day)
    got = sorted((r.page_id, r.blocked, r.n_entries) for r in judge(captures, entries).collect())
    assert got == [
        (1, False, 0), (2, True, 1), (2, True, 1), (3, True, 1), (4, False, 0), (5, True, 1), (6, True, 1), (7, False, 0),
        (8, False, 0), (9, False, 0), (10, True, 1), (11, False, 0), (12, False, 0),
    ]
    assert judge(captures, entries.where("false")).where("blocked").count() == 0
    assert judge(captures.where("false"), entries).count() == 0
    assert math.isfinite(got[0][2])
