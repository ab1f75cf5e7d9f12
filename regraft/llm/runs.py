"""Periodic runs of words: an online dynamic program over sparse diagonals.

A word is compared with its earlier occurrences: each that lies ``lag`` words back
lengthens the match on the diagonal of that lag, or begins one. A diagonal that
isn't lengthened by the next word ends there, and a match long enough for its lag
is emitted at once as a run: ``match + lag`` words with that period.

A frequent word has too many earlier occurrences to look at, so a word counts
together with the words before it. A run with period ``q`` of at least three
periods matches over ``2 q`` words or more, hence lags from ``a`` to below
``1.5 a`` only need occurrences of the word with the ``2 a - 1`` words before it.
Two such occurrences less than ``2 a - q`` apart would give the run a smaller
period, so the run's own lag is that of the nearest or second nearest occurrence:
no more are looked at, whatever the text. A text takes time in proportion to its
length times the logarithm of it, and texts in which no such group of words recurs
are passed over by a hash of each group, which misses none.

Defined results: null and empty texts have no words and no run; the words of
repeated rows and null ids are looked at row by row; an empty table gives no rows;
further columns are ignored. A text is handled as a whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, slices, texts

#: Bytes of text handled together; a longer text stands alone.
SLICE = 4 << 20

Run = tuple[int, int, int]


def levels(shortest: int, times: int, count: int) -> Iterator[tuple[int, int, int]]:
    """Least lag, end of lags, and the number of words that must recur for these lags."""
    context = min(max(shortest - lag, (times - 1) * lag, 1) for lag in range(1, max(shortest, 1) + 1))
    least, low = max(context // 2, 1), 1
    while low * times <= count and context < count:
        end = (3 * least + 1) // 2
        yield low, end, context
        low = least = end
        context = 2 * least


def combined(names: np.ndarray, shift: int) -> np.ndarray:
    """Names of groups from those of two parts that end ``shift`` words apart; -1 where a group occurs once only."""
    out = np.full(len(names), -1, np.int64)
    at = np.flatnonzero((names[shift:] >= 0) & (names[: len(names) - shift] >= 0)) + shift
    if len(at):
        pairs = names[at - shift] * (int(names.max()) + 1) + names[at]
        _, inverse, times = np.unique(pairs, return_inverse=True, return_counts=True)
        out[at] = np.where(times[inverse] > 1, inverse, -1)
    return out


def occurrences(names: np.ndarray, low: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Places, and the lags from ``low`` to below ``end`` of their nearest and second nearest earlier occurrence."""
    at = np.flatnonzero(names >= 0)
    order = at[np.argsort(names[at], kind="stable")]
    places, lags = [], []
    for back in (1, 2):
        same = names[order[back:]] == names[order[:-back]]
        lag = (order[back:] - order[:-back])
        fits = same & (lag >= low) & (lag < end)
        places.append(order[back:][fits])
        lags.append(lag[fits])
    return np.concatenate(places), np.concatenate(lags)


def diagonals(places: list[int], lags: list[int], begun: list[int], shortest: int, times: int) -> Iterator[Run]:
    """Start, length and lag of each match that is long enough, when its diagonal ends.

    ``places`` ascend; ``begun`` is the length that a match has when its diagonal begins.
    """
    active: dict[int, int] = {}
    following: dict[int, int] = {}
    now = -1

    def ended(before: int) -> Iterator[Run]:
        for lag, match in active.items():
            if match + lag >= max(shortest, times * lag):
                yield before - match - lag, match + lag, lag

    for place, lag, match in zip(places, lags, begun):
        if place != now:
            yield from ended(now)  # not lengthened by the word there
            active, following = following, {}
            if place != now + 1:
                yield from ended(now + 1)
                active = {}
            now = place
        following[lag] = active.pop(lag, match - 1) + 1
    yield from ended(now)
    active = following
    yield from ended(now + 1)


def divisors(period: int) -> Iterator[int]:
    """``period`` over each of its prime factors."""
    rest, factor = period, 2
    while factor * factor <= rest:
        if rest % factor == 0:
            yield period // factor
            while rest % factor == 0:
                rest //= factor
        factor += 1
    if rest > 1:
        yield period // rest


def is_run(words: np.ndarray, start: int, length: int, period: int) -> bool:
    """Whether a stretch with this period can't be lengthened and has no smaller one."""
    end = start + length
    if start and words[start - 1] == words[start - 1 + period] or end < len(words) and words[end] == words[end - period]:
        return False
    one = words[start : start + period]
    return not any(np.array_equal(one, words[start + p : start + p + period]) for p in divisors(period))


def find_runs(words: np.ndarray, shortest: int = 24, times: int = 3) -> list[Run]:
    """Start, length and period of all runs of a sequence of numbers, by start, then period."""
    if times < 3:
        raise ValueError("a run has three periods at least")
    names = np.unique(words, return_inverse=True)[1].astype(np.int64)
    width, found = 1, []
    for low, end, context in levels(shortest, times, len(words)):
        while 2 * width <= context:
            names, width = combined(names, width), 2 * width
        groups = combined(names, context - width) if context > width else names
        if not (groups >= 0).any():
            break
        places, lags = occurrences(groups, low, end)
        found.append((places, lags, np.full(len(places), context)))
    if not found:
        return []
    places, lags, begun = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(places, kind="stable")
    emitted = diagonals(places[order].tolist(), lags[order].tolist(), begun[order].tolist(), shortest, times)
    return sorted((s, n, p) for s, n, p in emitted if is_run(words, s, n, p))


def recurring(words: np.ndarray, text: np.ndarray, count: int, context: int) -> np.ndarray:
    """Which texts hold a group of ``context`` words twice, by hash; others may be among them. ``text`` numbers each word's text."""
    hashes = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    hashes ^= hashes >> np.uint64(29)
    width = 1
    while 2 * width <= context:
        hashes = mixed(hashes[:-width], hashes[width:]) if len(hashes) > width else hashes[:0]
        width *= 2
    if context > width:
        hashes = mixed(hashes[: -(context - width)], hashes[context - width :]) if len(hashes) > context - width else hashes[:0]
    first = text[: len(hashes)]
    inside = first == text[context - 1 : context - 1 + len(hashes)]
    keys, owner = mixed(hashes[inside], first[inside].astype(np.uint64)), first[inside]
    order = np.argsort(keys)
    again = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(count, bool)
    out[owner[order[1:][again]]] = True
    return out


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a * np.uint64(0xD6E8FEB86659FD93) + b
    out ^= out >> np.uint64(32)
    return out * np.uint64(0xFF51AFD7ED558CCD)


def without_repeats(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]


def periodic_runs(documents: DataFrame, shortest: int = 24, times: int = 3) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document.

    ``runs`` are ``(start, length, period)`` in words, by start, then period: the
    stretches of ``shortest`` words or more that repeat ``times`` times or more
    (three at least) with their smallest period and can't be lengthened. ``collapsed``
    is the text without what runs repeat, words joined by one blank.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    context = next(levels(shortest, times, 1 << 62))[2]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            if not whole.num_rows:
                continue
            for begin, end in slices(whole, "text", SLICE):
                batch = whole.slice(begin, end - begin)
                words = [t.split() for t in batch.column("text").cast(pa.binary()).to_pylist()]
                sizes = np.array([len(w) for w in words])
                numbers = np.asarray(pa.array([w for own in words for w in own], pa.binary()).dictionary_encode().indices).astype(np.int64)
                some = recurring(numbers, np.repeat(np.arange(len(words)), sizes), len(words), context)
                starts = np.cumsum(sizes) - sizes
                runs: list[list[Run]] = [[] for _ in words]
                for i in np.flatnonzero(some & (sizes >= shortest)).tolist():
                    runs[i] = find_runs(numbers[starts[i] : starts[i] + sizes[i]], shortest, times)
                kept = [without_repeats(w, r) if r else w for w, r in zip(words, runs)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()),
                        pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], pa.list_(run)),
                        pa.array([b" ".join(k) for k in kept], pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return texts(documents).mapInArrow(work, schema)


def strongest(runs: Column) -> Column:
    """Of runs in order, the first with the greatest length over period, compared exactly."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    return F.reduce(runs, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def run_digests(documents: DataFrame, shortest: int = 24, times: int = 3) -> DataFrame:
    """``doc_id``, the number of runs, the strongest one, and digests of all runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    best = periodic_runs(documents, shortest, times).withColumn("best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: each document whose id's CRC ends in 0 repeats some of its words up to its end."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    digits = F.expr("crc DIV 10")

    def repeating(words: Column) -> Column:
        n = F.size(words)
        begin = digits % n
        period = 1 + F.floor((n - begin) / (3 + digits % 8))
        later = F.transform(F.sequence(F.lit(0).cast("long"), n - begin - 1), lambda i: F.get(words, (begin + i % period).cast("int")))
        return F.when(n > 0, F.concat_ws(" ", F.slice(words, F.lit(1), begin.cast("int")), later)).otherwise(F.lit(""))

    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    # the list is made once, as the only element of an array
    repeated = F.get(F.transform(F.array(words), repeating), F.lit(0))
    return texts(documents).withColumn("crc", crc).select("doc_id", F.when(F.expr("crc % 10 = 0"), repeated).otherwise(F.col("text")).alias("text"))
