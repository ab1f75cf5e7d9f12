"""Periodic runs against a comparison of all lags."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from regraft.llm.runs import find_runs, levels, periodic_runs, run_digests, with_planted_runs


def runs_by_hand(words, shortest=24, times=3):
    n, found = len(words), {}
    for lag in range(1, n // times + 1):
        i = lag
        while i < n:
            if words[i] != words[i - lag]:
                i += 1
                continue
            begin = i
            while i < n and words[i] == words[i - lag]:
                i += 1
            start, length = begin - lag, i - begin + lag
            if length >= max(shortest, times * lag):
                found.setdefault((start, length), lag)  # smaller lags came first
    return sorted((s, m, p) for (s, m), p in found.items())


def planted_by_hand(doc_id, words):
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digests_by_hand(doc_id, text):
    words = planted_by_hand(doc_id, (text or "").encode().split())
    runs = runs_by_hand(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    lines = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    return (
        doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
    )


def rows(frame):
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


def test_lags_are_all_on_one_level():
    for shortest, times in ((24, 3), (3, 3), (1, 3), (100, 3), (10, 5), (7, 4)):
        end_before = 1
        for low, end, context in levels(shortest, times, 5000):
            assert low == end_before and end > low
            end_before = end
            assert all(max(shortest - q, (times - 1) * q) >= context for q in range(low, end))
        assert end_before * times > 5000 or context >= 5000


@pytest.mark.parametrize("seed", range(300))
def test_against_all_lags(seed):
    draw = random.Random(seed)
    letters = draw.choice([1, 2, 2, 3, 5, 30])
    words = []
    while len(words) < draw.choice([5, 30, 90, 200, 500]):
        part = draw.choices(range(letters), k=draw.randint(1, 40))
        kind = draw.random()
        if kind < 0.6:
            part = part * draw.randint(1, 6)
            words += part[: len(part) - draw.randint(0, min(6, len(part) - 1))]
        elif kind < 0.8 and words:
            words += words[-draw.randint(1, len(words)) :]
        else:
            words += part
    words = words[:900]
    shortest, times = draw.choice([(24, 3), (24, 3), (3, 3), (1, 3), (9, 3), (10, 4), (40, 3)])
    assert find_runs(np.array(words, np.int64), shortest, times) == runs_by_hand(words, shortest, times)


def test_fibonacci_words_and_blocks():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    block = ([0] * 60 + [1]) * 4
    nested = (([0] * 5 + [1]) * 5 + [2]) * 5
    for words in (b, block, nested, nested * 3 + [7], [0] * 24, [0] * 23, [0, 1] * 12, [3] + [0] * 30 + [3]):
        for shortest in (24, 6):
            assert find_runs(np.array(words), shortest) == runs_by_hand(words, shortest)


def test_time_does_not_grow_with_repetition():
    for words in ([0] * 400_000, ([0] * 60_000 + [1]) * 6, list(range(1000)) * 300):
        began = time.perf_counter()
        assert find_runs(np.array(words))
        assert time.perf_counter() - began < 30


def test_digests(documents):
    draw = random.Random(3)
    letters = [f"w{k}" for k in range(400)]
    prose = [" ".join(draw.choices(letters, k=draw.randint(1, 120))) for _ in range(150)]
    odd = [
        None, "", " \t\n", "one", "ä " * 30, "a " * 23, "a " * 24, "x y z " * 9, "the same line again\n" * 12,
        "a b " * 20 + "c d e " * 10, f"{'p q r s ' * 8}t {'p q r s ' * 8}", "\x1c\x1d a\x00b " * 12, "A a " * 12 + "A a",
    ]
    given = list(enumerate(prose + odd)) + [(None, "a " * 40), (None, None), (7, "u v w " * 9), (7, "u v w " * 9)]
    found = rows(run_digests(with_planted_runs(documents(*given))))
    assert found == sorted((digests_by_hand(i, t) for i, t in given), key=str)
    assert sum(r[1] > 0 for r in found) > 15


def test_whole_outputs_and_empty_table(documents):
    row = periodic_runs(documents((1, "s " + "a b c " * 9 + "e"))).first()
    assert [tuple(r) for r in row.runs] == [(1, 27, 3)] and row.collapsed == "s a b c e" and row.n_words == 29
    assert run_digests(with_planted_runs(documents((1, "a")).limit(0))).collect() == []
    with pytest.raises(ValueError):
        find_runs(np.arange(50), 10, 2)


def test_the_table(corpus):
    table, texts = corpus
    found = {r[0]: r for r in rows(run_digests(with_planted_runs(table)))}
    assert len(found) == len(texts)
    compared = [(i, t) for i, t in texts if len(t.split()) < 1200]
    assert len(compared) > len(texts) / 2
    assert [found[i] for i, _ in compared] == [digests_by_hand(i, t) for i, t in compared]
