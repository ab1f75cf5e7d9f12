"""N-gram Jaccard join by vertical partitioning.

All n-grams stand in one global order, rare ones first, then by hash. The first
fragment of a document, as long as two documents above the threshold must share
one n-gram of it, is joined, and its overlaps are counted per pair: where they
and the rest can't reach the threshold the pair is out, the others tie documents
into candidate groups. The sets of the candidates then meet block
against block; the order is cut into fragments, the overlaps of each fragment
are counted separately and summed per pair, and the sum decides exactly.

Documents with equal sets are one entry. N-grams are 64-bit hashes, sets are
told apart by 64 bits of a digest; at 10^10 n-grams a chance collision is to be
expected about once and changes one overlap by one.

Defined results: null, empty and blank texts have no n-gram, component
themselves and no link; fewer words than an n-gram make one n-gram of all of
them; rows that repeat a ``doc_id`` with different texts are separate members of
its class; rows without a ``doc_id`` (null) are members like others, and the
component is null only if none of its rows has an id; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucket_bits, id_bits, in_arrow, marked_ids, row_key, rows_of, runs_of, split_seed, spread, stage, texts
from .components import connected_components, smallest_labels

#: Frequency classes of n-grams are kept for so many slots of hashes (16 MB, whatever the input).
SLOT_BITS = 24
#: Sets that are compared at once, and the least that one side of a comparison holds.
BLOCK = 256
#: Sets and, on average, n-grams that one side holds at most where a group has many blocks.
MOST_SETS, MOST_NGRAMS = 2048, 1 << 21
#: Blocks of a group whose sides need not hold more than ``BLOCK``; each set is sent once for each block.
BLOCKS = 16
#: Documents of an n-gram that are tried pair by pair.
SHORT = 32
#: N-grams in a fragment of a comparison.
FRAGMENT = 2048

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    """64-bit hashes of words, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _M1
    return values ^ (values >> np.uint64(29))


def sequences(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words."""
    total = mixed(words[: len(words) - size + 1])
    for i in range(1, size):
        total = mixed(total * _M2 + words[i : len(words) - size + 1 + i])
    return total


def ngrams(text: str, size: int, hashes: WordHashes) -> np.ndarray:
    """Distinct n-grams, ascending by hash."""
    words = hashes.of(text.encode().lower().split())
    if not len(words):
        return words
    if len(words) < size:
        return sequences(words, len(words)) + np.uint64(len(words))
    found = np.sort(sequences(words, size))
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def frequency_classes(documents: DataFrame, size: int) -> np.ndarray:
    """For each slot the binary logarithm of its most frequent n-gram's count, over all documents.

    N-grams are counted by hash range as packed arrays. The slots are filled with
    the most frequent, down to the class at which half of them is taken. A rare
    n-gram that shares a slot only stands later in the order; a frequent one
    without a slot makes long lists, which tie documents of no likeness together.
    """
    bits = bucket_bits(documents)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = {}
            for (text,) in rows_of(batch, "text"):
                tokens = ngrams(text, size, hashes)
                sets[hashlib.blake2b(tokens.tobytes(), digest_size=8).digest()] = tokens
            if not sets:
                continue
            every = np.concatenate(list(sets.values()))
            del sets
            every.sort()
            bucket, rest = split_seed(every, bits)
            del every
            cuts = np.append(np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else [], len(bucket)).astype(int)
            if len(cuts) > 1:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[cuts[:-1]].astype(np.int32)),
                        pa.array([rest[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    ["bucket", "rest"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs_of(batches, ["bucket"]):
            every = np.sort(np.concatenate([np.frombuffer(r, np.uint32) for r in group.column("rest").to_pylist()]))
            starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            counts = np.diff(np.append(starts, len(every)))
            often = counts >= 8
            value = every[starts[often]].astype(np.uint64) | np.uint64(group.column("bucket")[0].as_py() << 32)
            place = (value >> np.uint64(32 + bits - SLOT_BITS)).astype(np.int32)
            kind = np.log2(counts[often]).astype(np.int8)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(kind)], ["slot", "kind"])

    packed = spread(in_arrow(documents, pack, "bucket int, rest binary"), "bucket").sortWithinPartitions("bucket")
    slots = stage(in_arrow(packed, count, "slot int, kind tinyint").groupBy("slot").agg(F.max("kind").alias("kind")), "slots")
    taken, least = 0, 64
    for kind, n in sorted(((r.kind, r.n) for r in slots.groupBy("kind").agg(F.count("*").alias("n")).collect()), reverse=True):
        taken += n
        if taken > 1 << SLOT_BITS - 1:
            break
        least = kind
    classes = np.zeros(1 << SLOT_BITS, np.uint8)
    found = slots.where(F.col("kind") >= least).toArrow()  # half of the slots at most
    if found.num_rows:
        classes[np.asarray(found.column("slot"))] = np.asarray(found.column("kind")).astype(np.uint8)
    return classes


def fragment_length(count: np.ndarray | int, percent: int) -> np.ndarray | int:
    """One n-gram more than may be missing from a partner."""
    return count + (-percent * count // 100) + 1


def first_fragment(tokens: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The first n-grams of the global order."""
    length = fragment_length(len(tokens), percent)
    own = classes[slot(tokens)]
    rare = tokens[own == 0]
    if len(rare) >= length:
        return rare[:length]
    return tokens[np.argsort(own, kind="stable")[:length]]


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Overlap of every pair, the sum over fragments of the order."""
    both = left if right is None else left + right
    every = np.concatenate(both)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    starts = np.concatenate([[True], every[1:] != every[:-1]])
    index = np.cumsum(starts) - 1
    shared = np.bincount(index) > 1
    keep = shared[index]
    index, owner = (np.cumsum(shared) - 1)[index[keep]], owner[keep]
    count = int(shared.sum())
    total = np.zeros((len(left), len(left if right is None else right)), np.int64)
    for begin in range(0, count, FRAGMENT):
        a, b = np.searchsorted(index, [begin, begin + FRAGMENT])
        fragment = np.zeros((len(both), min(FRAGMENT, count - begin)), np.float32)
        fragment[owner[a:b], index[a:b] - begin] = 1
        one = fragment[: len(left)]
        total += (one @ (one if right is None else fragment[len(left) :]).T).astype(np.int64)
    return total


def candidate_edges(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """``a, b, shared, least``: n-grams that first fragments share, and how many the pair has to share there.

    Rows come by token and size. Within a token every pair of up to ``SHORT``
    documents whose sizes allow the threshold is counted. Longer lists chain
    documents of neighbouring sizes, cut only where sizes are too far apart for
    any pair. A pair's overlap is what the fragments share and at most what the
    longer rest holds, which gives ``least``.
    """
    kept = np.zeros((0, 3), np.int64)  # the last token's rows so far; of a long list the last row, for the rest
    long_list = False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("token", "n_shingles", "mark")], 1)
        same = len(kept) > 0 and rows[0, 0] == kept[0, 0]
        if len(kept) and not same:
            yield from _edges_of(kept, long_list, percent)
            kept, long_list = kept[:0], False
        rows = np.concatenate([kept, rows])
        others = np.flatnonzero(rows[:, 0] != rows[-1, 0])
        last = int(others[-1]) + 1 if len(others) else 0
        if last:
            yield from _edges_of(rows[:last], False, percent, long_list)
            long_list = False
        kept = rows[last:]
        if len(kept) > SHORT:
            yield from _edges_of(kept, True, percent)
            kept, long_list = kept[-1:], True
    if len(kept):
        yield from _edges_of(kept, long_list, percent)


def _edges_of(rows: np.ndarray, long_list: bool, percent: int, first_long: bool = False) -> Iterator[pa.RecordBatch]:
    token, size, mark = rows.T
    rest = size - fragment_length(size, percent)
    starts = np.concatenate([[True], token[1:] != token[:-1]])
    run = np.cumsum(starts) - 1
    length = np.bincount(run)
    chained = (length > SHORT) | long_list
    chained[0] |= first_long
    chained = chained[run]
    found = []
    for step in range(1, SHORT):
        if step >= len(rows):
            break
        together = token[step:] == token[:-step]
        if not together.any():
            break
        i = np.flatnonzero(together & (~chained[step:] | (step == 1)))
        j = i + step
        near = (100 * size[i] >= percent * size[j]) & (mark[i] != mark[j])
        i, j = i[near], j[near]
        least = -(-percent * (size[i] + size[j]) // (100 + percent)) - np.maximum(rest[i], rest[j])
        found.append(np.stack([np.minimum(mark[i], mark[j]), np.maximum(mark[i], mark[j]), np.where(chained[i], 0, least)], 1))
    if found and len(every := np.concatenate(found)):
        pairs, shared = np.unique(every, axis=0, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(pairs[:, k]) for k in range(2)), pa.array(shared.astype(np.int64)), pa.array(pairs[:, 2])],
            ["a", "b", "shared", "least"],
        )


def linked_pairs(sets: list[np.ndarray], size: np.ndarray, first: np.ndarray, second: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``first`` and ``second`` (or within ``first``, if they are the same) above the threshold, ``BLOCK`` by ``BLOCK``."""
    within = first is second
    found = [np.zeros((2, 0), np.int64)]
    for a in range(0, len(first), BLOCK):
        one = first[a : a + BLOCK]
        for b in range(a if within else 0, len(second), BLOCK):
            two = second[b : b + BLOCK]
            if 100 * min(size[one].max(), size[two].max()) < percent * max(size[one].min(), size[two].min()):
                continue
            same = within and a == b
            common = overlaps([sets[k] for k in one], None if same else [sets[k] for k in two])
            taken = 100 * common >= percent * (size[one][:, None] + size[two][None, :] - common)
            i, j = np.nonzero(np.triu(taken, 1) if same else taken)
            found.append(np.stack([one[i], two[j]]))
    return tuple(np.concatenate(found, axis=1))


_KEYS = ["grp", "low", "high"]


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """``a, b, n``: with ``b`` an edge of a forest that connects the linked; without, ``n`` links of ``a``."""
    for group in runs_of(batches, _KEYS):
        # rows that repeat as a whole send their set again
        once = np.unique(np.asarray(group.column("id")), return_index=True)[1]
        if len(once) < group.num_rows:
            group = group.take(pa.array(np.sort(once)))
        if group.num_rows < 2:
            continue
        low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
        ids, copies, block = (np.asarray(group.column(c)) for c in ("id", "copies", "block"))
        sets = [np.frombuffer(t, np.uint64) for t in group.column("tokens").to_pylist()]
        size = np.array([len(s) for s in sets])
        first = np.flatnonzero(block == low)
        second = first if low == high else np.flatnonzero(block == high)
        if not len(first) or not len(second):
            continue
        i, j = linked_pairs(sets, size, first, second, percent)
        if not len(i):
            continue
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        label = smallest_labels(len(ids), i, j)
        tied, some = np.flatnonzero(label != np.arange(len(ids))), np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[tied], ids[some]])),
                pa.array([*ids[label[tied]].tolist(), *[None] * len(some)], pa.int64()),
                pa.array(np.concatenate([np.zeros(len(tied)), links[some]]).astype(np.int64)),
            ],
            ["a", "b", "n"],
        )


def jaccard_classes(documents: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, n_links, component_id`` for every document."""
    return jaccard_rows(documents, size, percent).drop("key_id", "key_mark")


def jaccard_rows(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """As :func:`jaccard_classes`, with ``key_id, key_mark`` of every row (``row_key``)."""
    key, key_mark = row_key()
    given = texts(documents).select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key_id"), key_mark.alias("key_mark"), "text")
    context = documents.sparkSession.sparkContext
    classes = context.broadcast(frequency_classes(given.select("text"), size))

    def describe(batches):
        hashes = WordHashes()
        for batch in batches:
            sizes, marks, fragments, seen = [], [], [], set()
            for (text,) in rows_of(batch, "text"):
                tokens = ngrams(text, size, hashes)
                mark = int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)
                sizes.append(len(tokens))
                marks.append(mark if len(tokens) else None)
                again = mark in seen or not len(tokens)
                fragments.append(None if again else first_fragment(tokens, classes.value, percent).view(np.int64))
                seen.add(mark)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "key_id", "key_mark")), pa.array(sizes, pa.int64()), pa.array(marks, pa.int64()),
                    pa.array(fragments, pa.list_(pa.int64())),
                ],
                ["doc_id", "key_id", "key_mark", "n_shingles", "mark", "fragment"],
            )

    schema = "doc_id long, key_id long, key_mark long, n_shingles long, mark long, fragment array<long>"
    described = stage(in_arrow(given, describe, schema), "described")
    sets = stage(
        described.where("mark IS NOT NULL").groupBy("mark", "n_shingles").agg(
            F.min("doc_id").alias("id"), F.min(F.struct("key_id", "key_mark")).alias("sender"), F.count("*").alias("copies")
        ), "sets"
    )
    postings = described.where("fragment IS NOT NULL").select("mark", "n_shingles", F.explode("fragment").alias("token"))
    order = ["token", "n_shingles", "mark"]
    counted = in_arrow(
        spread(postings, "token").sortWithinPartitions(*order), lambda b: candidate_edges(b, percent), "a long, b long, shared long, least long"
    )
    near = counted.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("least").alias("least")).where("shared >= least")
    groups = connected_components(near)

    # sets go by their mark, which is never null; one row sends the n-grams of each
    members = groups.select(F.col("node").alias("mark"), F.col("component").alias("grp")).join(sets, "mark").select(
        "mark", "grp", "n_shingles", "copies", "sender.key_id", "sender.key_mark"
    )
    in_group = Window.partitionBy("grp").orderBy("n_shingles", "mark")
    whole = Window.partitionBy("grp")
    side = F.greatest(F.lit(BLOCK), F.least(F.lit(MOST_SETS), F.ceil(F.count("*").over(whole) / BLOCKS), F.floor(MOST_NGRAMS / F.avg("n_shingles").over(whole))))
    members = stage(members.withColumn("block", F.floor((F.row_number().over(in_group) - 1) / side).cast("int")), "members")
    blocks = members.groupBy("grp", "block").agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
    one, two = blocks.alias("one"), blocks.alias("two")
    pairs = one.join(two, F.col("one.grp") == F.col("two.grp")).where(
        f"one.block <= two.block AND 100 * one.most >= {percent} * two.least"
    ).select("one.grp", F.col("one.block").alias("low"), F.col("two.block").alias("high"))
    sides = pairs.withColumn("block", F.explode(F.array_distinct(F.array("low", "high"))))

    bits = context.broadcast(id_bits(members, "key_id"))

    def tokens_of(batches):
        hashes = WordHashes()
        for batch in batches:
            chosen = batch.filter(pa.array(marked_ids(bits.value, batch.column("key_id"))))
            if chosen.num_rows:
                sets = [ngrams(t, size, hashes).tobytes() for (t,) in rows_of(chosen, "text")]
                yield pa.RecordBatch.from_arrays(
                    [chosen.column("key_id"), chosen.column("key_mark"), pa.array(sets, pa.binary())], ["key_id", "key_mark", "tokens"]
                )

    full = in_arrow(given, tokens_of, "key_id long, key_mark long, tokens binary")
    placed = members.select("key_id", "key_mark", F.col("mark").alias("id"), "copies", "grp", "block").join(sides, ["grp", "block"])
    met = full.join(placed, ["key_id", "key_mark"]).select(*_KEYS, "block", "id", "copies", "tokens")
    links = stage(
        in_arrow(spread(met, *_KEYS).sortWithinPartitions(*_KEYS), lambda b: _linked(b, percent), "a long, b long, n long"), "links"
    )
    linked = connected_components(links.where("b IS NOT NULL")).select(F.col("node").alias("mark"), "component")
    named = linked.join(sets, "mark").groupBy("component").agg(F.min("id").alias("component_id"))
    component = linked.join(named, "component").select("mark", "component_id")
    degree = links.where("b IS NULL").groupBy(F.col("a").alias("mark")).agg(F.sum("n").alias("links"))
    class_of = sets.join(degree, "mark", "left").join(component, "mark", "left").select(
        "mark", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    return described.select("doc_id", "key_id", "key_mark", "n_shingles", "mark").join(class_of, "mark", "left").select(
        "doc_id", "key_id", "key_mark", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
