"""Substrings that occur in an earlier document: suffix arrays of shards, whose strings are merged by their bytes.

Seeds tell which regions of a text can hold a string of another text. Each task
lines up such regions into shards of up to 0.6 MB, orders their suffixes, and
finds the classes of equal strings by their common prefixes: what has an earlier
document in its shard is settled. What the earliest document of a shard has goes
on, by seed hash, to where the shards are merged: there sorted keys bring strings
of all shards together, and those of equal bytes are one. A class goes on from one
document of a shard, so copies are combined before the shuffle.

Defined results: null and empty texts have no bytes; texts shorter than the
string length keep all; rows that repeat a ``doc_id`` don't count as earlier for
each other, those without one (null) neither; a null ``doc_id`` comes before all; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucket_bits, given_id, in_arrow, runs_of, split_seed, spread, stage, with_key, without_rows
from .ngram_join import mixed
from .seeds import (
    MIX, PACKED, dealt_spans, dealt_together, group_count, keyed, merged, open_or_settled, ragged, recurring, recurring_seeds, restored, seeds, spans_of,
    squeezed, texts_with_items, with_seeds, with_spans,
)
from .suffix import repeat_classes

GRAM = 16
#: Each hash range of the seeds goes to the merge in so many parts, as a power of two; a task sends a row for each.
MERGE_BITS = 1
#: Each of these is merged in so many parts, one after the other.
PART_BITS = 3
#: What goes on to be merged: windows of shards, by bucket of their seed; a window's place is its row key, offset, size and part.
OPEN = ["bucket", "data", "places"]
#: Bytes of regions whose windows a task packs together.
SENT = 1 << 23
#: Texts whose settled ranges are packed together.
HELD = 20_000
_M = np.uint64(0xC2B2AE3D27D4EB4F)
#: Regions of a shard; a longer one is cut, with an overlap of a string.
SHARD = 600_000


def _eights(data: bytes) -> np.ndarray:
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, 0, (1,))


def gram_hashes(data: bytes) -> np.ndarray:
    if len(data) < GRAM:
        return np.zeros(0, np.uint64)
    eights = _eights(data)
    return mixed(mixed(eights[:-8]) * _M + eights[8:])


def string_keys(data: bytes, length: int) -> np.ndarray:
    """A 64-bit key of each string of ``length`` bytes in ``data``, from keys of half of it."""
    key, size = mixed(_eights(data)), 8
    while size * 2 <= length:
        key, size = mixed(key[:-size] * _M + key[size:]), size * 2
    count, rest = len(data) - length + 1, length - size
    return mixed(key[:count] * _M + key[rest : rest + count]) if rest else key


def equal_strings(data: bytes, place: np.ndarray, other: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings at ``place`` and ``other`` have equal bytes; if not all are, some equal ones may count as not.

    Where both follow the pair before by one byte, only the last byte is compared.
    """
    fresh = np.ones(len(place), bool)
    fresh[1:] = (place[1:] != place[:-1] + 1) | (other[1:] != other[:-1] + 1)
    symbols, eights = np.frombuffer(data, np.uint8), _eights(data)
    same = symbols[place + length - 1] == symbols[other + length - 1]
    first = np.flatnonzero(fresh)
    a, b = place[first], other[first]
    for at in [*range(0, length - 7, 8), length - 8]:
        same[first] &= eights[a + at] == eights[b + at]
    wrong = np.cumsum(~same)
    before = np.concatenate([[0], wrong])[first]
    return wrong == np.repeat(before, np.diff(first, append=len(place)))


def later_strings(data: bytes, place: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings at ``place`` have equal bytes at a place of smaller ``rank``.

    Keys bring strings that may be equal together, their bytes are compared with
    those of the first; classes in which some differ are made anew by the bytes.
    """
    count = len(place)
    if not count:
        return np.zeros(0, bool)
    low = np.uint64(max(1, count.bit_length()))
    packed = np.sort((string_keys(data, length)[place] >> low << low) | np.arange(count, dtype=np.uint64))
    order = (packed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    packed >>= low
    heads = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    del packed
    sizes = np.diff(heads, append=count)
    later = np.zeros(count, bool)
    earliest = np.minimum.reduceat(rank[order], heads)
    later[order] = rank[order] > np.repeat(earliest, sizes)
    first = np.empty(count, np.int64)
    first[order] = np.repeat(order[heads], sizes)
    some = np.flatnonzero(first != np.arange(count))
    unequal = some[~equal_strings(data, place[some], place[first[some]], length)] if len(some) else some
    if len(unequal):
        again = np.flatnonzero(np.isin(first, first[unequal]))
        strings = [data[p : p + length] for p in place[again].tolist()]
        least: dict[bytes, int] = {}
        for string, own in zip(strings, rank[again].tolist()):
            least[string] = min(own, least.get(string, own))
        later[again] = [own > least[string] for string, own in zip(strings, rank[again].tolist())]
    return later


def id_order(docs: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Ranks of the ids of row keys, equal for equal ids; a null comes before all."""
    return (2 * np.unique(docs, return_inverse=True)[1] + (marks & 1)).astype(np.int32)


def _shards(regions: Iterator[tuple]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for region in regions:
        if held and size + len(region[3]) + 1 > SHARD:
            yield held
            held, size = [], 0
        held.append(region)
        size += len(region[3]) + 1
    if held:
        yield held


def settled_shard(shard: list[tuple], length: int) -> tuple[list[tuple], list[tuple]]:
    """Ranges that an earlier document of the shard has, and the first occurrences that go on."""
    docs = id_order(*(np.array([r[k] for r in shard], np.int64) for k in (0, 1)))
    place, classes, owner = repeat_classes([r[3] for r in shard], length)
    spans: list[tuple] = []
    sent: list[tuple] = []
    if not len(place):
        return spans, sent
    first = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
    earliest = np.minimum.reduceat(docs[owner], first)
    later = docs[owner] > np.repeat(earliest, np.diff(np.append(first, len(place))))
    total = sum(len(r[3]) + 1 for r in shard)
    settled, open_ = np.zeros(total + 1, bool), np.zeros(total + 1, np.int32)
    settled[place[later]] = True
    open_[place[~later] + 1] = 1
    opened = np.cumsum(open_)
    base = 0
    for doc, mark, offset, data, starts, ends, value in shard:
        done = np.flatnonzero(settled[base : base + len(data)])
        if len(done):
            spans.append((doc, mark, spans_of(done + offset, length)))
        go = np.flatnonzero(opened[base + ends] > opened[base + starts])
        if len(go):
            sent.append((doc, mark, offset, data, starts[go], ends[go], value[go]))
        base += len(data) + 1
    return spans, sent


def earlier_spans(given: DataFrame, length: int) -> DataFrame:
    """Packed rows of the byte ranges covered by strings that start in an earlier document."""
    bits, groups = bucket_bits(given), group_count(given)
    width = length - GRAM + 1

    def seeds_of(text: str) -> np.ndarray:
        hashes = gram_hashes(text.encode())
        return np.unique(hashes[seeds(hashes, width)[2]])

    def regions(batches) -> Iterator[tuple]:
        """``(doc, mark, offset, bytes, starts, ends, seed hashes)`` of merged candidate windows."""
        for doc, mark, text, found in texts_with_items(batches):
            if not len(found):
                continue
            data = text.encode()
            hashes = gram_hashes(data)
            starts, ends, at = seeds(hashes, width)
            own = recurring(hashes[at], found, bits)
            starts, ends, value = starts[own], ends[own], hashes[at[own]]
            for a, b in zip(*(x.tolist() for x in merged(starts, ends - 1 + length))):
                while a + length <= b:
                    stop = min(b, a + SHARD - 1)
                    i, j = np.searchsorted(ends, a, "right"), np.searchsorted(starts, stop - length, "right")
                    yield (
                        doc, mark, a, data[a:stop], np.maximum(starts[i:j], a) - a,
                        np.minimum(ends[i:j], stop - length + 1) - a, value[i:j],
                    )
                    a = stop - length + 1

    def settle(batches) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        sent: list[tuple] = []
        size = 0
        for shard in _shards(regions(batches)):
            spans, more = settled_shard(shard, length)
            held += spans
            sent += more
            size += sum(len(s[3]) for s in more)
            if size > SENT:
                yield from open_or_settled(OPEN, _packed(sent, length, bits + MERGE_BITS), iter(()))
                sent, size = [], 0
            if len(held) > HELD:
                yield from open_or_settled(OPEN, [], dealt_spans(held, groups))
                held = []
        yield from open_or_settled(OPEN, _packed(sent, length, bits + MERGE_BITS), dealt_spans(held, groups))

    found = recurring_seeds(given, seeds_of, bits)
    both = in_arrow(with_seeds(given, found), settle, f"bucket int, data binary, places binary, {PACKED}")

    def later_ranges(batches) -> Iterator[tuple]:
        for group in runs_of(batches, ["bucket"]):
            places = np.concatenate([restored(r, np.int64, 5) for r in group.column("places").to_pylist()])
            data = np.frombuffer(b"".join([zstandard.decompress(r) for r in group.column("data").to_pylist()]), np.uint8)
            del group
            begins = np.cumsum(places[:, 3]) - places[:, 3]
            order = np.argsort(places[:, 4], kind="stable")
            cuts = np.flatnonzero(np.diff(places[order, 4])) + 1
            for own in np.split(order, cuts):
                yield from later_of(places[own], data[ragged(begins[own], places[own, 3])].tobytes())

    def later_of(places: np.ndarray, data: bytes) -> Iterator[tuple]:
        if len(places):
            docs, offsets, sizes = places[:, :2], places[:, 2], places[:, 3]
            counts = sizes - length + 1
            ends = np.cumsum(counts)
            later = later_strings(
                data, ragged(np.cumsum(sizes) - sizes, counts), np.repeat(id_order(docs[:, 0], docs[:, 1]), counts), length
            )
            found = np.flatnonzero(later)
            if not len(found):
                return
            which = np.searchsorted(ends, found, "right")
            place = found - (ends - counts)[which] + offsets[which]
            heads = np.flatnonzero(np.concatenate([[True], (np.diff(found) != 1) | (which[1:] != which[:-1])]))
            spans = np.stack([place[heads], place[np.append(heads[1:], len(found)) - 1] + length], 1)
            who = docs[which[heads]]
            yield who[:, 0], who[:, 1], np.full(len(who), 2), spans.ravel()

    def merge(batches) -> Iterator[pa.RecordBatch]:
        settled: list[pa.RecordBatch] = []

        def unsettled() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = np.asarray(batch.column("bucket")) >= 0
                if not own.all():
                    settled.append(batch.filter(pa.array(~own)).select(["group", "docs", "marks", "counts", "items"]))
                yield batch.filter(pa.array(own))

        for made in dealt_together(later_ranges(unsettled()), groups):
            yield from settled
            settled.clear()
            yield made
        yield from settled

    # what is settled goes along, so that nothing is written between shards and merge
    both = both.withColumn("bucket", F.expr("coalesce(bucket, -1 - group)"))
    return in_arrow(spread(both, "bucket", times=4).sortWithinPartitions("bucket"), merge, PACKED)


def _packed(sent: list[tuple], length: int, bits: int) -> list[tuple]:
    """Rows of ``OPEN``: the bytes of windows that go on, by bucket of their seed."""
    if not sent:
        return []
    rows = []
    counts = [len(s[4]) for s in sent]
    docs = np.repeat(np.array([(s[0], s[1]) for s in sent], np.int64), counts, axis=0)
    text = np.frombuffer(b"".join(s[3] for s in sent), np.uint8)
    base = np.repeat(np.cumsum([0] + [len(s[3]) for s in sent[:-1]]), counts)
    starts, ends, value = (np.concatenate([s[k] for s in sent]) for k in (4, 5, 6))
    offsets = np.repeat([s[2] for s in sent], counts) + starts
    sizes = ends - 1 + length - starts
    fine, _ = split_seed(value * MIX, bits + PART_BITS)
    bucket = fine >> PART_BITS
    places = np.column_stack([docs, offsets, sizes, fine & (1 << PART_BITS) - 1]).astype(np.int64)
    press = zstandard.ZstdCompressor(level=3)
    order = np.argsort(fine, kind="stable")
    cuts = [0, *(np.flatnonzero(bucket[order][1:] != bucket[order][:-1]) + 1).tolist(), len(order)]
    for a, b in zip(cuts, cuts[1:]):
        own = order[a:b]
        rows.append((
            int(bucket[own[0]]), press.compress(text[ragged(base[own] + starts[own], sizes[own])].tobytes()), squeezed(places[own]),
        ))
    return rows


def remove_repeats(documents: DataFrame, length: int = 50) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary): every document without what an earlier one has."""
    return _finished(documents, length, False)


def repeat_digests(documents: DataFrame, length: int = 50) -> DataFrame:
    """As :func:`remove_repeats`, with ``kept_sha256`` in place of the bytes."""
    return _finished(documents, length, True)


def kept_bytes(data: bytes, ranges: np.ndarray) -> bytes:
    edges = [0, *ranges.ravel().tolist(), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def whole_characters(data: bytes, ranges: np.ndarray) -> np.ndarray:
    """Ranges drawn in to whole UTF-8 characters; those left empty go."""
    out = []
    for a, b in ranges.tolist():
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return np.array(out, np.int64).reshape(-1, 2)


def without_repeats(documents: DataFrame, length: int) -> DataFrame:
    """The documents with whole characters removed that an earlier document's strings cover.

    All columns stay; ``n_chars`` follows the text; a document of which nothing
    is left goes. Rows are told apart by their key, so a ``doc_id`` may repeat or be null.
    """
    given = keyed(documents)

    def finish(text: str, ranges: np.ndarray) -> tuple:
        data = text.encode()
        return (kept_bytes(data, whole_characters(data, ranges)).decode() if len(ranges) else None,)

    cut = with_spans(given, earlier_spans(given, length), finish, [pa.field("kept", pa.string())], "kept string").where("kept IS NOT NULL")
    cut = stage(cut.dropDuplicates(["doc_id", "mark"]), "repeats")
    kept = cut.where("kept != ''").select(F.col("doc_id").alias("_key_id"), F.col("mark").alias("_key_mark"), F.col("kept").alias("_kept"))
    changed = with_key(documents).drop("text", "n_chars").hint("merge").join(kept, ["_key_id", "_key_mark"])
    text = {"text": F.col("_kept"), "n_chars": F.length("_kept").cast("long")}
    return without_rows(documents, cut).union(
        changed.select(*(text[c].alias(c) if c in text else c for c in documents.columns))
    )


def _finished(documents: DataFrame, length: int, digest: bool) -> DataFrame:
    given = keyed(documents)

    def finish(text: str, ranges: np.ndarray) -> tuple:
        data = text.encode()
        kept = kept_bytes(data, ranges)
        return len(data), len(data) - len(kept), len(ranges), hashlib.sha256(kept).hexdigest() if digest else kept

    name, kind, sql = ("kept_sha256", pa.string(), "string") if digest else ("kept", pa.binary(), "binary")
    fields = [pa.field(n, pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")] + [pa.field(name, kind)]
    schema = f"n_bytes long, n_removed long, n_spans long, {name} {sql}"
    cut = with_spans(given, earlier_spans(given, length), finish, fields, schema)
    return cut.select(given_id("doc_id", "mark").alias("doc_id"), *(f.name for f in fields))
