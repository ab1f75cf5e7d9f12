"""Joins on pairs against brute force."""

import math

import numpy as np
import pytest

from regraft.llm.components import connected_components
from regraft.llm.neardup_vectors import BLOCK, bits_of, near_duplicates
from regraft.llm.ngram_join import fragment_length, frequency_classes, jaccard_classes, linked_pairs, overlaps


def labels(count, edges):
    parent = list(range(count))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return [top(x) for x in range(count)]


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def jaccard_by_hand(rows, size, percent):
    rows = sorted(rows, key=lambda r: r[0])
    sets = [shingles(t, size) for _, t in rows]
    edges = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and percent * max(len(a), len(b)) <= 100 * min(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    edges.append((i, j))
    label = labels(len(rows), edges)
    links = [0] * len(rows)
    for i, j in edges:
        links[i] += 1
        links[j] += 1
    return [(rows[k][0], len(sets[k]), links[k], rows[label[k]][0]) for k in range(len(rows))]


def test_jaccard_of_the_table(corpus):
    table, rows = corpus
    assert sorted(map(tuple, jaccard_classes(table).collect())) == jaccard_by_hand(rows, 4, 85)


def test_frequent_ngrams_have_slots(spark):
    words = " ".join(f"w{k}" for k in range(300_000))
    texts = spark.createDataFrame([(f"{words} end{i}",) for i in range(9)], "text STRING").coalesce(1)
    assert (frequency_classes(texts, 4) > 0).sum() > 290_000


def test_linked_pairs_over_blocks():
    rng = np.random.default_rng(7)
    sizes = np.sort(rng.integers(20, 60, 700))
    sets = [np.sort(rng.choice(70, n, replace=False)).astype(np.uint64) for n in sizes]
    whole = np.arange(700)
    for first, second in ((whole, whole), (whole[:300], whole[300:])):
        i, j = linked_pairs(sets, sizes, first, second, 60)
        common = overlaps([sets[k] for k in first], [sets[k] for k in second])
        taken = 100 * common >= 60 * (sizes[first][:, None] + sizes[second] - common)
        a, b = np.nonzero(np.triu(taken, 1) if first is second else taken)
        assert len(a) and set(zip(i, j)) == set(zip(first[a], second[b])) and len(i) == len(a)


def test_jaccard_of_odd_texts(documents):
    base = [f"w{k}" for k in range(100)]
    near = [" ".join(base[:i] + ["new"] + base[i + 1 :]) for i in range(0, 100, 7)]
    texts = [None, "", " ", "a b", "A B", "b a", "a b c d", "x " * 50, "x " * 70, " ".join(base), *near, " ".join(base[:90]), "É é É é", "é é É é"]
    got = sorted(map(tuple, jaccard_classes(documents(*texts)).collect()))
    assert got == jaccard_by_hand(list(enumerate(texts)), 4, 85)


def test_jaccard_of_a_large_group(documents):
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(base[:20] + [f"own{i}"] + base[20:]) for i in range(300)] + [" ".join(base)] * 3
    got = jaccard_classes(documents(*texts)).collect()
    assert sorted(map(tuple, got)) == jaccard_by_hand(list(enumerate(texts)), 4, 85)


def test_jaccard_of_five_words_and_no_rows(documents):
    texts = ["a b c d e f g h i j", "a b c d e f g h i j", "a b c d e f g h i k", "a b c d e f g h i j k"]
    assert sorted(map(tuple, jaccard_classes(documents(*texts), 5, 80).collect())) == jaccard_by_hand(list(enumerate(texts)), 5, 80)
    assert jaccard_classes(documents("x").where("false")).count() == 0


def test_jaccard_with_null_ids(documents):
    base = [f"w{k}" for k in range(100)]
    near = [" ".join(base[:i] + ["new"] + base[i + 1 :]) for i in (0, 50, 99)]
    alone = [" ".join(f"v{k}" for k in range(40)), " ".join(f"v{k}" for k in range(41))]
    rows = [(None, " ".join(base)), (None, near[0]), (7, near[1]), (7, near[1]), (3, near[2]), (None, alone[0]), (None, alone[1]), (None, None), (9, "other")]
    got = sorted(map(tuple, jaccard_classes(documents(*rows)).collect()), key=str)
    by_place = jaccard_by_hand([(i, t) for i, (_, t) in enumerate(rows)], 4, 85)
    classes = {}
    for (i, _), (_, _, _, c) in zip(rows, by_place):
        classes.setdefault(c, []).append(i)
    least = {c: min((i for i in ids if i is not None), default=None) for c, ids in classes.items()}
    assert got == sorted(((i, n, links, least[c]) for (i, _), (_, n, links, c) in zip(rows, by_place)), key=str)
    assert {r[3] for r in got if r[0] == 7} == {3}


def test_fragments():
    assert [fragment_length(n, 85) for n in (1, 4, 20, 100)] == [1, 1, 4, 16]
    draw = np.random.default_rng(0)
    sets = [np.unique(draw.integers(0, 9000, n).astype(np.uint64)) for n in (10, 4000, 5000, 1)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    apart = ~np.eye(4, dtype=bool)
    assert overlaps(sets, None)[apart].tolist() == np.array(want)[apart].tolist()
    assert overlaps(sets[:1], sets[1:]).tolist() == [want[0][1:]]


def test_components(spark):
    draw = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 120, (90, 2))] + [(k, k + 1) for k in range(200, 260)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = labels(300, edges)
    assert got == {x: label[x] for e in edges for x in e if e[0] != e[1] or x in got}


def vectors_by_hand(rows, least):
    usable = {}
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            usable[i] = np.array(v, float) / np.abs(v).max()
            usable[i] /= np.linalg.norm(usable[i])
    ids = sorted(i for i, _ in rows)
    place = {i: k for k, i in enumerate(ids)}
    edges = [
        (place[i], place[j])
        for i in usable for j in usable
        if i < j and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= least
    ]
    label, links = labels(len(ids), edges), [0] * len(ids)
    for i, j in edges:
        links[i] += 1
        links[j] += 1
    return [(i, links[k], ids[label[k]], label[k] == k) for i, k in place.items()]


def test_vectors_recall(spark, folder):
    table = spark.read.parquet(f"{folder.replace('0.001', '0.01')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got, want = sorted(map(tuple, near_duplicates(table).collect())), vectors_by_hand(rows, 0.95)
    found, there = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found >= 0.9 * there and all(g[1] <= w[1] for g, w in zip(got, want))


def test_odd_vectors(spark):
    rows = [
        (0, None), (1, []), (2, [0.0] * 16), (3, [1.0] * 15 + [None]), (4, [1.0] * 15 + [float("nan")]),
        (5, [1.0] * 16), (6, [2.0] * 16), (7, [1.0] * 15 + [1.1]), (8, [-1.0] * 16), (9, [1.0] * 3), (10, [3.0] * 3), (11, [1e300] * 16),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, code string")
    assert sorted(map(tuple, near_duplicates(table).collect())) == vectors_by_hand(rows, 0.95)
    assert near_duplicates(table.where("false")).count() == 0


def test_vectors_without_and_with_repeated_ids(spark):
    rows = [(None, [1.0] * 16), (None, None), (1, [1.0] * 16), (1, [1.0] * 16), (2, [2.0] * 16)]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True), (None, 0, None, True)]


@pytest.mark.parametrize("copies", [BLOCK + 100])
def test_a_large_group_of_vectors_in_blocks(spark, copies):
    draw = np.random.default_rng(5)
    centre = draw.normal(size=32)
    rows = [(i, (centre + 0.02 * draw.normal(size=32)).tolist()) for i in range(copies)]
    rows += [(copies + i, draw.normal(size=32).tolist()) for i in range(100)]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got)) == vectors_by_hand(rows, 0.95)


def test_bits():
    assert [bits_of(d) for d in (3, 16, 40, 64, 768)] == [3, 16, 32, 64, 64]
