"""Where texts may hold a passage of another: content-chosen seeds, exchanged in packed form.

Of each window of a text the k-gram with the least hash is its seed. Equal
windows have equal seeds, so a window can only recur if its seed does. Seeds are
exchanged by hash range as packed arrays, and each text gets those of its own
back that were seen more than once. That is a filter without misses, whatever
the data; what passes is confirmed afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ID_BITS, id_places, in_arrow, marked_ids, row_key, rows_of, runs_of, spread, stage, texts
from .ngram_join import mixed

#: Rows of a batch that share one packed exchange.
PACKED_ROWS = 60_000
#: Items that a task packs together; of more it makes several sets of rows.
ITEMS = 1 << 21
PACKED = "group int, docs binary, marks binary, counts binary, items binary"
MIX = np.uint64(0x9E3779B97F4A7C15)
_PRESS, _UNPRESS = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pressed(data: bytes) -> bytes:
    return _PRESS.compress(data) if data else data


def unpressed(data: bytes) -> bytes:
    return _UNPRESS.decompress(data) if data else data


def squeezed(values: np.ndarray) -> bytes:
    """Rows of integers, compressed by the places of their bytes: first all lowest bytes, last all highest."""
    return pressed(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b"")


def restored(data: bytes, kind, columns: int = 1) -> np.ndarray:
    """What :func:`squeezed` was given."""
    size = np.dtype(kind).itemsize * columns
    rows = np.ascontiguousarray(np.frombuffer(unpressed(data), np.uint8).reshape(size, -1).T).view(kind)
    return rows.ravel() if columns == 1 else rows


def keyed(documents: DataFrame) -> DataFrame:
    """``doc_id, mark, text``, none null: the row's key, see :func:`row_key`."""
    doc, mark = row_key()
    return texts(documents).select(doc.alias("doc_id"), mark.alias("mark"), "text")


def seeds(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each run of ``width``-wide windows with one seed: first start, end of starts, place of the seed."""
    count = len(hashes) - width + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    least = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:count], least[width - reach : width - reach + count])
    starts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    return starts, np.append(starts[1:], count), (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)


def seed_keys(values: np.ndarray, bits: int) -> np.ndarray:
    """Bucket (upper ``bits``) and 32 bits more; mixed first, as seeds are minima and crowd at 0."""
    return (values * MIX) >> np.uint64(32 - bits)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def group_count(frame: DataFrame) -> int:
    """Row keys are dealt out over as many groups as there are shuffle partitions; what goes back to a group's texts is packed."""
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_hashes(docs: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """32 bits for each row key: rows that share them share their recurring seeds, which only propose."""
    return (mixed(docs.view(np.uint64) ^ mixed(marks.view(np.uint64)) * MIX) >> np.uint64(32)).astype(np.int64)


def group_of(docs: np.ndarray, marks: np.ndarray, groups: int) -> np.ndarray:
    return ((key_hashes(docs, marks) >> 1) % groups).astype(np.int32)


def dealt(docs: np.ndarray, marks: np.ndarray, counts: np.ndarray, items: np.ndarray, groups: int) -> Iterator[pa.RecordBatch]:
    """One row for each group of row keys: the keys, how many 64-bit items each has, and the items, all :func:`squeezed`.

    ``items`` of a key stand together; a key may come more than once.
    """
    if not len(docs):
        return
    group = group_of(docs, marks, groups)
    order = np.argsort(group, kind="stable")
    sizes = counts[order]
    items = items[ragged((np.cumsum(counts) - counts)[order], sizes)]
    group, docs, marks = group[order], docs[order], marks[order]
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    cuts = [*heads.tolist(), len(group)]
    ends = np.concatenate([[0], np.cumsum(sizes)])[cuts].tolist()
    parts = [[squeezed(c[a:b]) for a, b in zip(cuts, cuts[1:])] for c in (docs, marks, sizes.astype(np.int64))]
    parts.append([squeezed(items[a:b]) for a, b in zip(ends, ends[1:])])
    yield pa.RecordBatch.from_arrays(
        [pa.array(group[heads], pa.int32()), *(pa.array(p, pa.binary()) for p in parts)], ["group", "docs", "marks", "counts", "items"]
    )


def dealt_together(made: Iterator[tuple], groups: int) -> Iterator[pa.RecordBatch]:
    """``(docs, marks, counts, items)`` of a task's buckets as :func:`dealt`, about ``ITEMS`` at a time."""
    held, size = [], 0
    for part in made:
        held.append(part)
        size += len(part[3])
        if size > ITEMS:
            yield from dealt(*(np.concatenate(c) for c in zip(*held)), groups)
            held, size = [], 0
    if held:
        yield from dealt(*(np.concatenate(c) for c in zip(*held)), groups)


def dealt_spans(spans: list[tuple[int, int, np.ndarray]], groups: int) -> Iterator[pa.RecordBatch]:
    """``(doc, mark, ranges)`` as :func:`dealt`."""
    if spans:
        docs, marks = (np.array([s[k] for s in spans], np.int64) for k in (0, 1))
        counts = np.array([s[2].size for s in spans], np.int64)
        yield from dealt(docs, marks, counts, np.concatenate([s[2].ravel() for s in spans]), groups)


def open_or_settled(names: list[str], rows: list[tuple], spans: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a bucket that go on (its number, then binary columns), and packed rows of what is settled, in one schema."""
    packed = ["group", "docs", "marks", "counts", "items"]
    types = [pa.int32(), *[pa.binary()] * (len(names) - 1)]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, t) for c, t in zip(zip(*rows), types)), *(pa.nulls(len(rows), t) for t in [pa.int32(), *[pa.binary()] * 4])], names + packed
        )
    for batch in spans:
        yield pa.RecordBatch.from_arrays([*(pa.nulls(batch.num_rows, t) for t in types), *batch.columns], names + packed)


def packed_bits(packed: DataFrame) -> bytes:
    """As :func:`common.id_bits`, of the keys of packed rows."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(ID_BITS, bool)
        for batch in batches:
            for docs in batch.column("docs").to_pylist():
                flags[id_places(restored(docs, np.int64))] = True
        parts = np.packbits(flags, bitorder="little").reshape(-1, 4096)
        some = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([parts[k].tobytes() for k in some.tolist()], pa.binary())], ["part", "bits"]
        )

    marked = bytearray(ID_BITS // 8)
    rows = in_arrow(packed.select("docs"), mark, "part int, bits binary").groupBy("part").agg(F.bitmap_or_agg("bits").alias("bits"))
    for part, bits in rows.collect():  # 256 at most
        marked[part * 4096 : (part + 1) * 4096] = bytes(bits)
    return bytes(marked)


def recurring_seeds(given: DataFrame, seeds_of: Callable[[str], np.ndarray], bits: int) -> DataFrame:
    """Packed rows (:func:`dealt`) of those seeds of each text that were given more than once, as :func:`seed_keys`.

    ``seeds_of`` gives the seeds of a text that count, with repeats if they do.
    In place of the row key the rows have its hash (:func:`key_hashes`) and 0.
    """
    groups = group_count(given)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, PACKED_ROWS):
                batch = whole.slice(begin, PACKED_ROWS)
                each = [seeds_of(t) for (t,) in rows_of(batch, "text")]
                owners = key_hashes(*(np.asarray(batch.column(c)) for c in ("doc_id", "mark"))).astype(np.uint32)
                by = np.argsort(owners, kind="stable")
                each = [each[i] for i in by.tolist()]
                keys = seed_keys(np.concatenate(each), bits)
                who = np.repeat(owners[by], [len(e) for e in each])
                bucket, rest = (keys >> np.uint64(32)).astype(np.uint16), keys.astype(np.uint32)
                order = np.argsort(bucket, kind="stable")
                bucket, rest, who = bucket[order], rest[order], who[order]
                cuts = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else [], len(bucket)).astype(int)
                if len(cuts) > 1:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(bucket[cuts[:-1]].astype(np.int32)),
                            pa.array([rest[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                            pa.array([squeezed(np.diff(who[a:b], prepend=np.uint32(0))) for a, b in zip(cuts, cuts[1:])], pa.binary()),
                        ],
                        ["bucket", "rest", "who"],
                    )

    def recur(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for group in runs_of(batches, ["bucket"]):
            number = np.uint64(group.column("bucket")[0].as_py() << 32)
            parts = [np.frombuffer(r, np.uint32) for r in group.column("rest").to_pylist()]
            every = np.concatenate(parts)
            packed = np.sort((every.astype(np.uint64) << np.uint64(32)) | np.arange(len(every), dtype=np.uint64))
            value = packed >> np.uint64(32)
            equal = np.concatenate([[False], value[1:] == value[:-1]])
            equal[:-1] |= equal[1:]
            recurs = np.zeros(len(every), bool)
            recurs[(packed[equal] & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
            at = 0
            sent: list[tuple] = []
            for part, who in zip(parts, group.column("who").to_pylist()):
                mine = recurs[at : at + len(part)]
                at += len(part)
                owner = np.cumsum(restored(who, np.uint32), dtype=np.int64)[mine]
                if len(owner):
                    begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                    sent.append((owner[begins], np.diff(begins, append=len(owner))))
            if sent:
                owners, counts = (np.concatenate(c) for c in zip(*sent))
                yield owners, np.zeros_like(owners), counts, every[recurs] | number

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from dealt_together(recur(batches), groups)

    packed = in_arrow(given, pack, "bucket int, rest binary, who binary")
    return in_arrow(spread(packed, "bucket").sortWithinPartitions("bucket"), again, PACKED)


def _chosen(given: DataFrame, bits, groups: int, hashed: bool = False) -> DataFrame:
    """``group, key, doc_id, mark, text`` (compressed) of the texts whose ids are marked, or if ``hashed`` whose keys' hashes are.

    ``key`` and 0 stand for the row key in packed rows; null, it stands there itself.
    """

    def candidates(batches):
        for batch in batches:
            keys = [np.asarray(batch.column(c)) for c in ("doc_id", "mark")]
            if hashed:
                keys = [key_hashes(*keys), np.zeros(batch.num_rows, np.int64)]
            some = marked_ids(bits.value, pa.array(keys[0]))
            batch, keys = batch.filter(pa.array(some)), [k[some] for k in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group_of(*keys, groups)), pa.array(keys[0]) if hashed else pa.nulls(batch.num_rows, pa.int64()),
                    batch.column("doc_id"), batch.column("mark"), pa.array([pressed(t.encode()) for (t,) in rows_of(batch, "text")], pa.binary()),
                ],
                ["group", "key", "doc_id", "mark", "text"],
            )

    return in_arrow(given, candidates, "group int, key long, doc_id long, mark long, text binary")


def _together(chosen: DataFrame, packed: DataFrame) -> DataFrame:
    """Packed rows and texts by group, the packed rows of a group first."""
    both = packed.unionByName(chosen, allowMissingColumns=True)
    return both.repartitionById(group_count(both), F.col("group")).sortWithinPartitions(F.col("group"), F.col("docs").isNull())


def texts_with_items(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, str, np.ndarray]]:
    """``(doc, mark, text, items)`` of what :func:`_together` brings; without items an empty array."""
    held, number, none = [], None, np.zeros(0, np.uint64)
    found: dict[tuple[int, int], np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        group, is_text = np.asarray(batch.column("group")), np.asarray(batch.column("docs").is_null())
        cuts = [0, *(np.flatnonzero((group[1:] != group[:-1]) | (is_text[1:] != is_text[:-1])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if group[a] != number:
                held, number, found = [], group[a], None
            part = batch.slice(a, b - a)
            if not is_text[a]:
                held += part.select(["docs", "marks", "counts", "items"]).to_pylist()
                continue
            if found is None:
                found, held = _by_key(held), []
            hashed = "key" in part.schema.names and part.column("key")[0].is_valid
            for doc, mark, text, *key in rows_of(part, "doc_id", "mark", "text", *["key"] * hashed):
                text = text if isinstance(text, str) else unpressed(text).decode()
                yield doc, mark, text, found.get((key[0], 0) if hashed else (doc, mark), none)


def _by_key(packed: list[dict]) -> dict[tuple[int, int], np.ndarray]:
    if not packed:
        return {}
    docs, marks, counts = (np.concatenate([restored(p[c], np.int64) for p in packed]) for c in ("docs", "marks", "counts"))
    items = np.concatenate([restored(p["items"], np.uint64) for p in packed])
    order = np.lexsort((marks, docs))
    sizes = counts[order]
    items = items[ragged((np.cumsum(counts) - counts)[order], sizes)]
    docs, marks = docs[order], marks[order]
    heads = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (marks[1:] != marks[:-1])]))
    cuts = np.concatenate([[0], np.cumsum(sizes)])[[*heads.tolist(), len(docs)]].tolist()
    return {k: items[a:b] for k, a, b in zip(zip(docs[heads].tolist(), marks[heads].tolist()), cuts, cuts[1:])}


def with_seeds(given: DataFrame, found: DataFrame) -> DataFrame:
    """The texts that may have recurring seeds and these, for :func:`texts_with_items`."""
    found = stage(found, "seeds")
    bits = given.sparkSession.sparkContext.broadcast(packed_bits(found))
    return _together(_chosen(given, bits, group_count(given), hashed=True), found)


def recurring(values: np.ndarray, found: np.ndarray, bits: int) -> np.ndarray:
    """Which of a text's seeds are among those given back."""
    if not len(found):
        return np.zeros(len(values), bool)
    known = np.sort(found)
    own = seed_keys(values, bits)
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    return known[at] == own


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges, those that touch as one; ``starts`` ascending."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    first = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[first], np.append(reach[:-1][first[1:]], reach[-1])


def spans_of(starts: np.ndarray, length: int) -> np.ndarray:
    """Ranges (n, 2) covered by windows of ``length`` at ascending ``starts``."""
    return np.stack(merged(starts, starts + length), 1).astype(np.int64)


def covered(items: np.ndarray) -> np.ndarray:
    """Disjoint ranges (n, 2), ascending, from the items of a text."""
    pairs = items.view(np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    return np.stack(merged(pairs[:, 0], pairs[:, 1]), 1)


def with_spans(given: DataFrame, spans: DataFrame, finish: Callable[[str, np.ndarray], tuple], fields: list[pa.Field], schema: str) -> DataFrame:
    """``doc_id, mark`` and ``finish(text, ranges)`` of every text, those without a span where they are read.

    ``spans`` has packed rows (:func:`dealt`) of ranges.
    """
    gathered = stage(spans, "spans")
    bits = given.sparkSession.sparkContext.broadcast(packed_bits(gathered))
    none = np.zeros((0, 2), np.int64)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), *(f.type for f in fields)]
        columns = zip(*rows) if rows else [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "mark", *(f.name for f in fields)])

    def alone(batches):
        for batch in batches:
            rest = batch.filter(pa.array(~marked_ids(bits.value, batch.column("doc_id"))))
            yield made([(d, m, *finish(t, none)) for d, m, t in rows_of(rest, "doc_id", "mark", "text")])

    def cut(batches):
        rows, size = [], 0
        for doc, mark, text, items in texts_with_items(batches):
            rows.append((doc, mark, *finish(text, covered(items) if len(items) else none)))
            size += len(text)
            if len(rows) >= 1000 or size > 1 << 24:
                yield made(rows)
                rows, size = [], 0
        yield made(rows)

    schema = f"doc_id long, mark long, {schema}"
    together = _together(_chosen(given, bits, group_count(given)), gathered)
    return in_arrow(given, alone, schema).union(in_arrow(together, cut, schema))
