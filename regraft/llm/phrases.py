"""Repeated phrases: recurring passages are proposed, compiled into automata, and confirmed and located by them.

Seeds tell which regions of a text can hold a recurring window. Regions go, by
seed hash, to shards that hold all regions of a seed, copies within a task as
one. A shard proposes windows that may recur by their hashes, joins those that
follow each other to passages, compiles windows that cover the passages into an
Aho-Corasick automaton over words, and streams its regions through it. Hits are
counted by window, and only a window met twice or more is removed, so words
decide and not hashes. A region without a proposed window has none that recurs
and isn't streamed.

Defined results: null, empty and blank texts have no words; texts shorter than a
window keep all words; a window that recurs within one text counts; rows that
repeat recur; a null ``doc_id`` is one like others; an empty table gives no rows; further columns are ignored. Words
are what ``[^\\x20\\x09-\\x0D]+`` matches, unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bucket_bits, given_id, in_arrow, runs_of, split_seed, spread, stage
from .ngram_join import WordHashes, sequences
from .seeds import MIX, PACKED, dealt_spans, group_count, keyed, merged, open_or_settled, ragged, recurring, recurring_seeds, seeds, spans_of, texts_with_items, with_seeds, with_spans

GRAM = 8
#: Each hash range of the seeds is confirmed in so many parts, as a power of two.
MERGE_BITS = 2
#: Regions whose passages make one automaton; those of a seed stay together.
SHARD = 2_000
#: Characters that stand for a digit of a word's number in an automaton.
ALPHABET = 256
#: Characters of regions that a task looks for copies in at a time.
HELD = 1 << 24
#: Ranges of confirmed passages that a task packs together.
HELD_ROWS = 200_000


def _candidates(contexts: list[list[bytes]], weights: np.ndarray, length: int, hashes: WordHashes) -> list[np.ndarray]:
    """For each context which windows may recur: equal windows have equal hashes, so none is missed.

    The contexts are hashed as one text; windows that reach from one into the next don't count.
    """
    sizes = np.array([len(words) for words in contexts])
    counts = np.maximum(sizes - length + 1, 0)
    recurs = np.zeros(counts.sum(), bool)
    if len(recurs):
        keys = sequences(hashes.of([w for words in contexts for w in words]), length)[ragged(np.cumsum(sizes) - sizes, counts)]
        _, index = np.unique(keys, return_inverse=True)
        recurs = np.bincount(index, np.repeat(weights, counts))[index] > 1
    return np.split(recurs, np.cumsum(counts)[:-1])


def passage_windows(words: list[bytes], recurs: np.ndarray, length: int) -> list[tuple[bytes, ...]]:
    """Windows that together cover the passages of a context, if those recur: end to end, and the last of each."""
    starts = np.flatnonzero(recurs)
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) != 1)
    firsts, lasts = starts[np.append(0, breaks + 1)].tolist(), starts[np.append(breaks, len(starts) - 1)].tolist()
    return [tuple(words[k : k + length]) for a, b in zip(firsts, lasts) for k in [*range(a, b, length), b]]


def word_codes(windows: set[tuple[bytes, ...]]) -> tuple[dict[bytes, str], str]:
    """Each word as a few characters, those of each place from an alphabet of their own; the code of other words.

    Nodes of the automaton then have at most ``ALPHABET`` children, and a match
    can't begin within a word.
    """
    words = sorted({w for window in windows for w in window})
    digits = 1
    while ALPHABET**digits < len(words):
        digits += 1
    codes = {}
    for number, word in enumerate(words):
        code = []
        for place in range(digits):
            number, digit = divmod(number, ALPHABET)
            code.append(chr(256 + ALPHABET * place + digit))
        codes[word] = "".join(code)
    return codes, "\x01" * digits


def locate(contexts: list[list[bytes]], windows: set[tuple[bytes, ...]], length: int) -> tuple[list[tuple[bytes, ...]], list[list[tuple[int, int]]]]:
    """The windows in order, and for each context where which of them begins: one automaton over words, all contexts streamed through it."""
    codes, other = word_codes(windows)
    ordered = list(windows)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, window in enumerate(ordered):
        automaton.add_word("".join([codes[w] for w in window]), number)
    automaton.make_automaton()
    size = len(other)
    return ordered, [
        [((last + 1) // size - length, number) for last, number in automaton.iter("".join([codes.get(w, other) for w in words]))]
        for words in contexts
    ]


def recurring_places(contexts: list[list[bytes]], weights: np.ndarray, length: int, hashes: WordHashes) -> list[list[int]]:
    """For each context starts of windows that together cover all its recurring ones.

    Hashes propose windows, the automaton decides: one that it meets only once,
    copies counted by weight, stays. Where a proposed window of a passage is such
    a one, all candidates of the passage's context are compiled in its place.
    """
    candidates = _candidates(contexts, weights, length, hashes)
    some = [i for i, recurs in enumerate(candidates) if recurs.any()]
    places: list[list[int]] = [[] for _ in contexts]
    if not some:
        return places
    own, times = [contexts[i] for i in some], weights[some]
    compiled = [passage_windows(contexts[i], candidates[i], length) for i in some]

    def met() -> tuple[np.ndarray, list, dict]:
        ordered, hits = locate(own, {w for windows in compiled for w in windows}, length)
        counts = np.zeros(len(ordered), np.int64)
        for found, weight in zip(hits, times.tolist()):
            for _, number in found:
                counts[number] += weight
        return counts, hits, {w: n for n, w in enumerate(ordered)}

    counts, hits, numbers = met()
    if (counts < 2).any():
        for k, i in enumerate(some):
            if any(counts[numbers[w]] < 2 for w in compiled[k]):
                compiled[k] = [tuple(contexts[i][at : at + length]) for at in np.flatnonzero(candidates[i]).tolist()]
        counts, hits, _ = met()
    for i, found in zip(some, hits):
        places[i] = [at for at, number in found if counts[number] > 1]
    return places


def recurring_spans(given: DataFrame, length: int) -> DataFrame:
    """Packed rows of the word ranges covered by windows of ``length`` words that recur."""
    bits, groups = bucket_bits(given), group_count(given)
    width = length - GRAM + 1

    def grams(words: np.ndarray) -> np.ndarray:
        return sequences(words, GRAM) if len(words) >= GRAM else np.zeros(0, np.uint64)

    hashes = WordHashes()

    def seeds_of(text: str) -> np.ndarray:
        values = grams(hashes.of(text.encode().split()))
        return values[seeds(values, width)[2]]

    def regions(batches) -> Iterator[pa.RecordBatch]:
        own_hashes = WordHashes()
        sent: dict[bytes, list] = {}
        size = 0
        for doc, mark, text, found in texts_with_items(batches):
            if not len(found):
                continue
            words = text.encode().split()
            values = grams(own_hashes.of(words))
            starts, ends, at = seeds(values, width)
            for k in np.flatnonzero(recurring(values[at], found, bits)).tolist():
                a, b = int(starts[k]), int(ends[k]) - 1 + length
                sent.setdefault(b" ".join(words[a:b]), []).append((int(values[at[k]]), doc, mark, a, b))
            size += len(text)
            if size > HELD:
                yield from _packed(sent, bits + MERGE_BITS, groups)
                sent, size = {}, 0
        yield from _packed(sent, bits + MERGE_BITS, groups)

    found = recurring_seeds(given, seeds_of, bits)
    schema = f"bucket int, texts binary, weights binary, owners binary, {PACKED}"
    both = stage(in_arrow(with_seeds(given, found), regions, schema), "regions")

    def confirm(batches) -> Iterator[pa.RecordBatch]:
        own_hashes, rows = WordHashes(), []
        for group in runs_of(batches, ["bucket"]):
            texts: list[bytes] = []
            for row in group.column("texts").to_pylist():
                texts += row.split(b"\n")
            weights = np.concatenate([np.frombuffer(w, np.int64) for w in group.column("weights").to_pylist()])
            owners = np.concatenate([np.frombuffer(o, np.int64).reshape(-1, 4) for o in group.column("owners").to_pylist()])
            order = np.argsort(owners[:, 3], kind="stable")
            seed = owners[order, 3]
            # regions of one seed together, about SHARD at a time
            begins = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
            cuts = [*begins[np.unique(np.searchsorted(begins, np.arange(0, len(order), SHARD)).clip(max=len(begins) - 1))].tolist(), len(order)]
            for a, b in zip(cuts, cuts[1:]):
                own = order[a:b].tolist()
                alike: dict[bytes, list[int]] = {}  # equal regions of several tasks as one
                for i in own:
                    alike.setdefault(texts[i], []).append(i)
                contexts = [text.split(b" ") for text in alike]
                times = np.array([weights[i].sum() for i in alike.values()])
                for places, hits in zip(alike.values(), recurring_places(contexts, times, length, own_hashes)):
                    for i in places if hits else ():
                        if weights[i] == 1:  # the copies of a task's own are settled there
                            doc, mark, offset, _ = owners[i].tolist()
                            rows.append((doc, mark, spans_of(np.array(hits, np.int64) + offset, length)))
            if len(rows) > HELD_ROWS:
                yield from dealt_spans(rows, groups)
                rows = []
        yield from dealt_spans(rows, groups)

    open_rows = both.where("bucket IS NOT NULL").select("bucket", "texts", "weights", "owners")
    confirmed = in_arrow(spread(open_rows, "bucket").sortWithinPartitions("bucket"), confirm, PACKED)
    return both.where("bucket IS NULL").select(*confirmed.columns).union(confirmed)


def _packed(sent: dict[bytes, list], bits: int, groups: int) -> Iterator[pa.RecordBatch]:
    settled: dict[tuple, list[tuple[int, int]]] = {}
    for places in sent.values():
        if len(places) > 1:
            for _, doc, mark, a, b in places:
                settled.setdefault((doc, mark), []).append((a, b))
    spans = []
    for (doc, mark), ranges in settled.items():
        pairs = np.array(sorted(ranges), np.int64)
        spans.append((doc, mark, np.stack(merged(pairs[:, 0], pairs[:, 1]), 1)))
    rows = []
    items = list(sent.items())
    if items:
        values = np.array([p[0][0] for _, p in items], np.uint64)
        bucket, _ = split_seed(values * MIX, bits)  # seeds are minima and crowd at 0
        order, signed = np.argsort(bucket, kind="stable"), values.view(np.int64)
        cuts = [0, *(np.flatnonzero(bucket[order][1:] != bucket[order][:-1]) + 1).tolist(), len(order)]
        for a, b in zip(cuts, cuts[1:]):
            own = [items[i] for i in order[a:b].tolist()]
            rows.append((
                int(bucket[order[a]]), b"\n".join(t for t, _ in own),
                np.array([len(p) for _, p in own], np.int64).tobytes(),
                np.array([(p[0][1], p[0][2], p[0][3], v) for (_, p), v in zip(own, signed[order[a:b]])], np.int64).tobytes(),
            ))
    yield from open_or_settled(["bucket", "texts", "weights", "owners"], rows, dealt_spans(spans, groups))


def kept_words(text: str, ranges: np.ndarray) -> tuple[int, list[bytes]]:
    words = text.encode().split()
    edges = [0, *ranges.ravel().tolist(), len(words)]
    return len(words), [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]


def remove_phrases(documents: DataFrame, length: int = 35) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words of every document that no recurring window covers."""
    return _finished(documents, length, False)


def phrase_digests(documents: DataFrame, length: int = 35) -> DataFrame:
    """As :func:`remove_phrases`, with ``kept_sha256`` in place of the text."""
    return _finished(documents, length, True)


def _finished(documents: DataFrame, length: int, digest: bool) -> DataFrame:
    given = keyed(documents)

    def finish(text: str, ranges: np.ndarray) -> tuple:
        count, kept = kept_words(text, ranges)
        joined = b" ".join(kept)
        return count, count - len(kept), hashlib.sha256(joined).hexdigest() if digest else joined.decode()

    name = "kept_sha256" if digest else "kept"
    fields = [pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), pa.field(name, pa.string())]
    cut = with_spans(given, recurring_spans(given, length), finish, fields, f"n_words long, n_removed long, {name} string")
    return cut.select(given_id("doc_id", "mark").alias("doc_id"), *(f.name for f in fields))
