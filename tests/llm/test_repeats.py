"""Repeated phrases and repeated bytes against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from regraft.llm import phrases, suffix_dedup
from regraft.llm.ngram_join import WordHashes
from regraft.llm.phrases import passage_windows, phrase_digests, recurring_places, remove_phrases
from regraft.llm.seeds import dealt, group_of, merged, ragged, recurring_seeds, restored, seeds, squeezed, texts_with_items
from regraft.llm.suffix import common_prefixes, joined, repeat_classes, suffix_array
from regraft.llm.suffix_dedup import remove_repeats, repeat_digests, without_repeats


def covered(count, starts, length):
    marks = np.zeros(count + 1, int)
    for s in starts:
        marks[s] += 1
        marks[s + length] -= 1
    return np.cumsum(marks)[:count] > 0


def phrases_by_hand(rows, length):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    times = Counter(tuple(w[k : k + length]) for _, w in words for k in range(len(w) - length + 1))
    out = []
    for i, w in words:
        starts = [k for k in range(len(w) - length + 1) if times[tuple(w[k : k + length])] > 1]
        gone = covered(len(w), starts, length)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def bytes_by_hand(rows, length):
    data = sorted(((i, (t or "").encode()) for i, t in rows), key=lambda r: r[0])
    first = {}
    for i, d in data:
        for k in range(len(d) - length + 1):
            first[d[k : k + length]] = min(i, first.get(d[k : k + length], i))
    out = []
    for i, d in data:
        gone = covered(len(d), [k for k in range(len(d) - length + 1) if first[d[k : k + length]] < i], length)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((i, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def odd_texts():
    draw = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    passage = " ".join(draw.choices(words, k=60))
    other = " ".join(draw.choices(words, k=45))
    return [
        None, "", " \n", "kurz", passage, passage, f"ä {passage} b", f"{other}\t{passage}", f"{passage} {passage}",
        "a " * 400, "a " * 90, "x\0y" * 60, "x\0y" * 40, "ß" * 70, "ö" + "ß" * 40,
        " ".join(draw.choices(words, k=4000)) + " " + other, f"{passage[:150]} tail", f"head {passage[-180:]}",
    ]


def test_phrases_of_the_table(spark, corpus):
    table, rows = corpus
    assert sorted(map(tuple, phrase_digests(table).collect())) == phrases_by_hand(rows, 35)


def test_phrases_of_odd_texts(documents):
    texts = odd_texts()
    got = sorted(map(tuple, phrase_digests(documents(*texts)).collect()))
    assert got == phrases_by_hand(list(enumerate(texts)), 35)


def test_words_decide_where_hashes_collide(monkeypatch):
    passage = [b"p%d" % k for k in range(9)]
    contexts = [[b"a%d" % k for k in range(20)], [b"x", *passage, b"y"], [*passage, *(b"b%d" % k for k in range(8))], [b"c%d" % k for k in range(6)]]
    weights = np.array([1, 1, 1, 2])
    monkeypatch.setattr(phrases, "sequences", lambda words, n: np.zeros(max(len(words) - n + 1, 0), np.uint64))
    got = recurring_places(contexts, weights, 5, WordHashes())
    gone = [covered(len(c), at, 5).tolist() for c, at in zip(contexts, got)]
    assert gone == [[False] * 20, [False] + [True] * 9 + [False], [True] * 9 + [False] * 8, [True] * 6]


def test_windows_of_a_shard_are_hashed_at_once(monkeypatch):
    """One call for all contexts, and none of its windows reaches over the end of one."""
    draw, length, calls, own = random.Random(8), 4, [], phrases.sequences
    monkeypatch.setattr(phrases, "sequences", lambda words, n: calls.append(n) or own(words, n))
    for trial in range(40):
        calls.clear()
        contexts = [[b"%d" % draw.randrange(3) for _ in range(draw.randint(1, 9))] for _ in range(draw.randint(1, 8))]
        weights = np.array([draw.randint(1, 2) for _ in contexts])
        times = Counter()
        for words, weight in zip(contexts, weights.tolist()):
            for k in range(len(words) - length + 1):
                times[tuple(words[k : k + length])] += weight
        want = [covered(len(w), [k for k in range(len(w) - length + 1) if times[tuple(w[k : k + length])] > 1], length).tolist() for w in contexts]
        got = recurring_places(contexts, weights, length, WordHashes())
        assert [covered(len(w), at, length).tolist() for w, at in zip(contexts, got)] == want
        assert len(calls) == any(len(w) >= length for w in contexts)


def test_phrases_keep_the_text(documents):
    twice = " ".join(f"w{k}" for k in range(40))
    got = {r.doc_id: r.kept for r in remove_phrases(documents(f"one {twice}", f"{twice} two", "three")).collect()}
    assert got == {0: "one", 1: "two", 2: "three"}


def test_repeated_rows_of_one_id(documents):
    twice = " ".join(f"w{k}" for k in range(40))
    assert [r.n_removed for r in phrase_digests(documents((7, twice), (7, twice))).collect()] == [40, 40]
    assert [r.n_removed for r in repeat_digests(documents((7, twice), (7, twice))).collect()] == [0, 0]


def test_null_ids_among_repeated_texts(documents):
    texts = odd_texts()
    ids = [-1 if i in (4, 7, 15) else i for i in range(len(texts))]  # by hand, -1 stands for null and comes first
    table = documents(*((None if i < 0 else i, t) for i, t in zip(ids, texts))).coalesce(1)

    def got(frame):
        return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in frame.collect())

    assert got(phrase_digests(table)) == phrases_by_hand(list(zip(ids, texts)), 35)
    assert got(repeat_digests(table)) == bytes_by_hand(list(zip(ids, texts)), 50)


def test_a_null_id_is_before_the_least_and_is_no_other(documents):
    text = "some words that are longer than fifty bytes, all of them the same"
    table = documents((5, text), (-(1 << 63), text), (None, text), (None, f"{text}!"))
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed) for r in repeat_digests(table).collect())
    assert got == [(False, 0, 0), (False, 0, 0), (True, -(1 << 63), len(text)), (True, 5, len(text))]


def test_pipeline_form_with_null_ids(documents):
    passage = "p" * 60
    table = documents((3, f"a{passage}b"), (None, passage), (None, f"{passage}c"), (4, passage), (None, "clean"), (3, "other"))
    got = [(r.doc_id, r.text) for r in without_repeats(table, 51).collect()]
    want = [(3, "ab"), (3, "other"), (None, "clean"), (None, passage), (None, f"{passage}c")]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_bytes_of_the_table(spark, corpus):
    table, rows = corpus
    assert sorted(map(tuple, repeat_digests(table).collect())) == bytes_by_hand(rows, 50)


def test_bytes_of_odd_texts(documents):
    texts = odd_texts()
    got = sorted(map(tuple, repeat_digests(documents(*texts)).collect()))
    assert got == bytes_by_hand(list(enumerate(texts)), 50)


def test_pipeline_form_keeps_columns_and_whole_characters(documents):
    passage = "ß" * 60
    table = documents(passage, f"a{passage}b", passage, "clean")
    got = {r.doc_id: r for r in without_repeats(table, 51).collect()}
    assert table.columns == list(got[0].asDict()) and set(got) == {0, 1, 3}
    assert (got[1].text, got[1].n_chars, got[0].text) == ("ab", 2, passage)


def test_empty_tables(documents):
    none = documents("x").where("false")
    assert phrase_digests(none).count() == 0 and remove_repeats(none).count() == 0


def test_suffix_array_and_prefixes():
    draw = random.Random(2)
    for trial in range(120):
        pieces = [bytes(draw.choices(b"ab\0\xff", k=draw.randint(0, 25))) for _ in range(draw.randint(1, 5))]
        pieces += pieces if trial % 3 == 0 else []
        symbols, ends = joined(pieces)
        count = int(ends[-1]) + 1
        order = suffix_array(symbols, count)
        starts = np.concatenate([[0], ends[:-1] + 1])
        suffixes = [list(pieces[k][i - starts[k] :]) for i in range(count) for k in [int(np.searchsorted(ends, i))]]
        key = lambda i: ([x + 1 for x in suffixes[i]] + [0], int(np.searchsorted(ends, i)))
        assert sorted(range(count), key=key) == order.tolist()
        prefixes = common_prefixes(symbols, order, ends)
        for k in range(1, count):
            a, b = suffixes[order[k]], suffixes[order[k - 1]]
            same = next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefixes[k] == same


def test_classes_are_equal_strings():
    pieces = [b"abcdefgh", b"xxabcdexx", b"abc"]
    place, classes, owner = repeat_classes(pieces, 5)
    text = b"\0".join(pieces)
    strings = {}
    for p, c in zip(place.tolist(), classes.tolist()):
        strings.setdefault(c, set()).add(text[p : p + 5])
    assert all(len(s) == 1 for s in strings.values()) and len(strings) == len({text[p : p + 5] for p in place.tolist()})


def test_equal_windows_have_equal_seeds():
    draw = np.random.default_rng(1)
    hashes = draw.integers(0, 50, 400).astype(np.uint64) << np.uint64(40)
    starts, ends, at = seeds(hashes, 12)
    seed = {w: int(a) - w for s, e, a in zip(starts, ends, at) for w in range(s, e)}
    assert sorted(seed) == list(range(len(hashes) - 11))
    by_content = {}
    for w, offset in seed.items():
        assert by_content.setdefault(tuple(hashes[w : w + 12].tolist()), offset) == offset
    assert all(len(x) == 0 for x in seeds(hashes[:5], 12))


def test_ranges_and_windows():
    a, b = merged(np.array([0, 2, 9]), np.array([5, 3, 12]))
    assert (a.tolist(), b.tolist()) == ([0, 9], [5, 12])
    words = [b"%d" % i for i in range(12)]
    recurs = np.array([True] * 7 + [False, True])
    assert passage_windows(words, recurs, 4) == [tuple(words[k : k + 4]) for k in (0, 4, 6, 8)]


@pytest.mark.parametrize("keys", ["own", "all alike", "few"])
def test_merged_strings_are_equal_by_bytes(monkeypatch, keys):
    """Colliding keys neither remove a string nor hide one."""
    own_keys = suffix_dedup.string_keys
    if keys != "own":
        most = np.uint64(1 if keys == "all alike" else 3)
        monkeypatch.setattr(suffix_dedup, "string_keys", lambda data, length: (own_keys(data, length) % most) << np.uint64(60))
    draw, length = random.Random(5), 17
    for trial in range(30):
        passages = [bytes(draw.choices(b"ab\0", k=draw.randint(17, 40))) for _ in range(4)]
        regions = [b"".join(draw.choices(passages, k=draw.randint(1, 3))) for _ in range(12)]
        ranks = np.array([draw.randint(0, 6) for _ in regions])
        sizes = np.array([len(r) for r in regions])
        counts = sizes - length + 1
        place = ragged(np.cumsum(sizes) - sizes, counts)
        least: dict[bytes, int] = {}
        strings = [(r[i : i + length], int(k)) for r, k in zip(regions, ranks) for i in range(len(r) - length + 1)]
        for string, rank in strings:
            least[string] = min(rank, least.get(string, rank))
        later = suffix_dedup.later_strings(b"".join(regions), place, np.repeat(ranks, counts), length)
        assert later.tolist() == [rank > least[string] for string, rank in strings]


def test_items_find_their_texts_in_any_batches():
    """Packed rows of a group, split over several, come back by row key, whatever the batches."""
    draw = np.random.default_rng(3)
    docs, marks = draw.integers(-5, 40, 300), draw.integers(0, 2, 300)
    counts = draw.integers(0, 4, 300)
    items = draw.integers(0, 1 << 40, counts.sum()).astype(np.uint64)
    wanted: dict[tuple[int, int], list[int]] = {}
    for doc, mark, own in zip(docs.tolist(), marks.tolist(), np.split(items, np.cumsum(counts)[:-1])):
        wanted.setdefault((doc, mark), []).extend(own.tolist())
    packed = [row for half in (slice(0, 150), slice(150, 300)) for b in dealt(docs[half], marks[half], counts[half], np.split(items, [counts[:150].sum()])[half.start > 0], 7) for row in b.to_pylist()]
    every = [(doc, mark) for doc in range(-6, 41) for mark in (0, 1)]
    groups = group_of(*(np.array(c, np.int64) for c in zip(*every)), 7)
    texts = [{"group": int(g), "doc_id": d, "mark": m, "text": f"{d} {m}"} for g, (d, m) in zip(groups, every)]
    rows = sorted(packed + texts, key=lambda r: (r["group"], "text" in r))
    fields = [("group", pa.int32()), *((c, pa.binary()) for c in ("docs", "marks", "counts", "items")), ("doc_id", pa.int64()), ("mark", pa.int64()), ("text", pa.string())]
    for size in (1, 5, 1000):
        batches = pa.Table.from_pylist(rows, pa.schema(fields)).to_batches(size)
        got = {(d, m): (t, i.tolist()) for d, m, t, i in texts_with_items(iter(batches))}
        assert got == {(d, m): (f"{d} {m}", wanted.get((d, m), [])) for d, m in every}


def test_recurring_seeds_go_back_in_few_bytes(spark):
    """However many buckets the seeds of a text are dealt over."""
    rows = [(k * 1_000_003, -k * 0x9E3779B97F4A7C1 % (1 << 62), str(k % 1500)) for k in range(3000)]
    given = spark.createDataFrame(rows, "doc_id LONG, mark LONG, text STRING").coalesce(1)
    found = recurring_seeds(given, lambda text: np.random.default_rng(int(text)).integers(0, 1 << 63, 40).astype(np.uint64), 12).collect()
    counts = sum(int(restored(r["counts"], np.int64).sum()) for r in found)
    assert counts == 3000 * 40
    assert sum(len(r[c]) for r in found for c in ("docs", "marks", "counts", "items")) < 14 * counts


@pytest.mark.parametrize("kind", [np.int64, np.uint32])
def test_squeezed_comes_back(kind):
    draw = np.random.default_rng(4)
    for count in (0, 1, 1000):
        values = draw.integers(0, 1 << 31, (count, 4)).astype(kind)
        assert (restored(squeezed(values), kind, 4) == values).all() and restored(squeezed(values), kind, 4).shape == values.shape
        assert (restored(squeezed(values[:, 1]), kind) == values[:, 1]).all()
