"""Packing of token sequences: shortest pack first over the histogram of lengths.

A document becomes its ids and an end id. Whole sequences are cut off its front
as they are; what remains is shorter than a sequence and counts in a histogram
of lengths. Lengths are placed longest first, each into the open pack that holds
least, as counts of packing patterns: a pattern stands for many sequences that
hold remainders of the same lengths. When all lengths are placed, as few of the
emptiest packs as will do are dissolved, and their ids fill the room in the
others; what is left over ends in powers of two. So no sequence needs padding,
and only documents in the emptiest packs are cut further.

The patterns are joined back to the documents by rank: a slot of a pattern holds
a range of ranks among the remainders of one length, sequence by sequence. A
document's rank is its place within its task (fixed once written) after those of
the tasks before.

What comes to the driver is one count for each length below the size. The number
of patterns depends on these lengths, not on the number of documents.

Defined results: a null or empty text is the end id alone; rows that repeat, and
null ids, are packed each for itself; an empty table gives no pieces; further
columns are ignored. Which of several equally long remainders goes where follows
the order in which the rows are read.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_symbols
from .common import rows_of, stage, texts

#: Fixed value: how byte-level files of this kind cut text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A blank between other white space, or at the end after it, belongs to a piece with what is around it.
ODD_BLANK = re.compile(r"\s \s|\s $").search
#: Below this, libraries agree on what is a letter or a number, whatever their Unicode version.
SETTLED = "Ͱ"
#: Words whose ids a Python worker keeps, and the longest word that is kept.
KEPT_WORDS, KEPT_LENGTH = 500_000, 64


class Kept(dict):
    """Packed ids of words after a blank; begun anew when it is full."""

    def __init__(self, encode: Callable[[str], bytes]):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(" " + word)
        if len(word) <= KEPT_LENGTH:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = ids
        return ids


class ByteEncoder:
    """Ids as the file's own library gives them; words are cut at blanks, encoded once and kept.

    A piece never reaches over a blank except at its front, so words that follow
    one are encoded apart from each other.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        vocabulary = model["vocab"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        greatest = max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])], default=0)
        self.kind, self.code = ("<u2", "H") if greatest < 1 << 16 else ("<u4", "I")
        plain = (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
        self.by_word = plain and not spec.get("normalizer") and not model.get("dropout") and not model.get("continuing_subword_prefix")
        if self.by_word:
            number = {s: b for b, s in enumerate(byte_symbols())}
            ranks = {bytes(map(number.__getitem__, s)): i for s, i in vocabulary.items() if all(c in number for c in s)}
            self.ordinary = tiktoken.Encoding("words", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.kept = Kept(self.word)

    def bytes_of(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def slow(self, text: str) -> bytes:
        return self.bytes_of(self.library.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        return self.bytes_of(self.ordinary(word)) if word.isascii() or max(word) < SETTLED else self.slow(word)

    def encode(self, text: str) -> bytes:
        if not self.by_word or ODD_BLANK(text) or any(s in text for s in self.special):
            return self.slow(text)
        first, *rest = text.split(" ")
        return self.word(first) + b"".join(map(self.kept.__getitem__, rest))


@lru_cache(2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


@dataclass
class Pattern:
    """``count`` sequences; slot ``(length, rank)`` holds in the k-th of them the ``rank + k``-th remainder of that length."""

    count: int
    slots: list[tuple[int, int]]

    def cut(self, count: int) -> tuple[Pattern, Pattern]:
        """The first ``count`` sequences and the others."""
        return Pattern(count, self.slots), Pattern(self.count - count, [(length, rank + count) for length, rank in self.slots])


class OpenPacks:
    """Patterns by the room that is left in them."""

    def __init__(self, size: int):
        self.by_room: list[list[Pattern]] = [[] for _ in range(size + 1)]

    def put(self, room: int, pattern: Pattern) -> None:
        if pattern.count:
            self.by_room[room].append(pattern)

    def take(self, room: int, count: int) -> Pattern:
        """A pattern with that room, at most ``count`` of its sequences; the others stay."""
        pattern = self.by_room[room].pop()
        if pattern.count > count:
            pattern, rest = pattern.cut(count)
            self.put(room, rest)
        return pattern


def shortest_pack_first(histogram: dict[int, int], size: int) -> OpenPacks:
    """Places each length, longest first, into the packs that hold least; room 0 has the full ones."""
    packs = OpenPacks(size)
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        for room in range(size - length, length - 1, -1):  # no open pack holds less than this length
            while left and packs.by_room[room]:
                pattern = packs.take(room, left)
                packs.put(room - length, Pattern(pattern.count, [*pattern.slots, (length, rank)]))
                rank, left = rank + pattern.count, left - pattern.count
        # new packs, each filled with this length before the next is opened
        fit = size // length
        for count, slots in ((left // fit, fit), (1, left % fit)):
            if count and slots:
                packs.put(size - slots * length, Pattern(count, [(length, rank + s * count) for s in range(slots)]))
                rank += count * slots
    return packs


def dissolved(packs: OpenPacks, size: int) -> tuple[list[tuple[int, Pattern]], list[tuple[int, Pattern]], int]:
    """The packs that stay and the emptiest, which fill the room in them: as few as hold that many ids; and the ids left over."""
    room_left = sum(room * p.count for room, own in enumerate(packs.by_room) for p in own)
    given, ids = [], 0
    for room in range(size - 1, 0, -1):
        while room_left > ids and packs.by_room[room]:
            # each sequence taken away brings its ids and leaves no room to fill: together a whole size
            pattern = packs.take(room, -(-(room_left - ids) // size))
            room_left, ids = room_left - room * pattern.count, ids + (size - room) * pattern.count
            given.append((room, pattern))
    return [(room, p) for room, own in enumerate(packs.by_room) for p in own], given, ids - room_left


#: Ranks of one length stay below this.
RANKS = 1 << 48


class Places:
    """Where the remainder of a length and rank lies.

    Remainders in packs that stay lie there whole. Those of dissolved packs
    follow one another as a stream of ids, and so does the room to fill; where
    both meet, a piece lies. Ids left over end in sequences of powers of two.
    """

    def __init__(self, histogram: dict[int, int], size: int):
        stay, given, left_over = dissolved(shortest_pack_first(histogram, size), size)
        slots: list[tuple[int, ...]] = []  # key, rank, first sequence, offset, place in the stream, step there
        room: list[tuple[int, ...]] = []  # room, sequences, first sequence, offset
        sequence, at = 0, 0
        for free, p in stay:
            offset = 0
            for length, rank in p.slots:
                slots.append((length * RANKS + rank, rank, sequence, offset, 0, 0))
                offset += length
            if free:
                room.append((free, p.count, sequence, offset))
            sequence += p.count
        for free, p in given:
            begin = at
            for length, rank in p.slots:
                slots.append((length * RANKS + rank, rank, 0, 0, begin, size - free))
                begin += length
            at += (size - free) * p.count
        for power in (1 << b for b in range(left_over.bit_length() - 1, -1, -1) if left_over >> b & 1):
            room.append((power, 1, sequence, 0))
            sequence += 1
        self.sequences = sequence
        self.slots = np.array(sorted(slots), np.int64).reshape(-1, 6)
        self.room = np.array(room, np.int64).reshape(-1, 4)
        ends, numbers = np.cumsum(self.room[:, 0] * self.room[:, 1]), np.cumsum(self.room[:, 1])
        self.stream = np.concatenate([[0], ends])[:-1]
        self.number = np.concatenate([[0], numbers])[:-1]

    def gap(self, at: np.ndarray) -> np.ndarray:
        """Number of the gap that a place of the stream lies in."""
        entry = np.searchsorted(self.stream, at, side="right") - 1
        return self.number[entry] + (at - self.stream[entry]) // self.room[entry, 0]

    def pieces(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Row, start, length, sequence and offset of the pieces of remainders, by row and start."""
        row = np.flatnonzero(length > 0)
        length, rank = length[row], rank[row]
        slot = self.slots[np.searchsorted(self.slots[:, 0], length * RANKS + rank, side="right") - 1]
        ahead = rank - slot[:, 1]
        whole = slot[:, 5] == 0
        zero = np.zeros(int(whole.sum()), np.int64)
        lying = (row[whole], zero, length[whole], slot[whole, 2] + ahead[whole], slot[whole, 3])
        if whole.all():
            return lying
        row, length = row[~whole], length[~whole]
        begin = slot[~whole, 4] + ahead[~whole] * slot[~whole, 5]
        first = self.gap(begin)
        each = self.gap(begin + length - 1) - first + 1
        which = np.repeat(np.arange(len(row)), each)
        number = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each)
        entry = np.searchsorted(self.number, number, side="right") - 1
        free, ahead = self.room[entry, 0], number - self.number[entry]
        gap = self.stream[entry] + ahead * free
        a = np.maximum(begin[which], gap)
        z = np.minimum((begin + length)[which], gap + free)
        cut = (row[which], a - begin[which], z - a, self.room[entry, 2] + ahead, self.room[entry, 3] + a - gap)
        both = [np.concatenate(x) for x in zip(lying, cut)]
        order = np.lexsort((both[1], both[0]))
        return tuple(x[order] for x in both)


def numbered_ids(documents: DataFrame, path: str, size: int, end: int) -> DataFrame:
    """``doc_id, ids, n, task, rest, rank, whole``: ids packed, with the row's rank among its task's remainders of that length.

    ``whole`` counts the task's whole sequences before the row.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = encoder(path), TaskContext.get().partitionId()
        last = np.array([end], coder.kind).tobytes()
        ranks, whole = np.zeros(size, np.int64), 0
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                ids = [coder.encode(text) + last for (text,) in rows_of(part, "text")]
                counts = [len(i) // len(last) for i in ids]
                rest = [n % size for n in counts]
                rank, before = [], []
                for n, r in zip(counts, rest):
                    rank.append(int(ranks[r]))
                    before.append(whole)
                    ranks[r] += 1
                    whole += n // size
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()), pa.array(ids, pa.binary()), pa.array(counts, pa.int64()),
                        pa.array([task] * len(ids), pa.int32()), pa.array(rest, pa.int32()),
                        pa.array(rank, pa.int64()), pa.array(before, pa.int64()),
                    ],
                    ["doc_id", "ids", "n", "task", "rest", "rank", "whole"],
                )

    return texts(documents).mapInArrow(encode, "doc_id long, ids binary, n long, task int, rest int, rank long, whole long")


def packed(documents: DataFrame, path: str, size: int = 1024, end: int = 0) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: one row for each piece.

    ``ids`` are little-endian unsigned 32-bit integers. Sequences are full, or a
    power of two long in the last few.
    """
    spark = documents.sparkSession
    coded = stage(numbered_ids(documents, path, size, end), "ids")
    before = lambda *by: Window.partitionBy(*by).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = stage(
        coded.groupBy("task", "rest").agg(F.count("*").alias("n"), F.sum(F.expr(f"n DIV {size}")).alias("whole")), "lengths"
    )
    ranked = counts.select("task", "rest", F.coalesce(F.sum("n").over(before("rest")), F.lit(0)).alias("ranks_before"))
    # one row for each task that read the documents
    tasks = counts.groupBy("task").agg(F.sum("whole").alias("whole"))
    wholes = tasks.select("task", F.coalesce(F.sum("whole").over(before(F.lit(0))), F.lit(0)).alias("wholes_before"))
    histogram = {r.rest: r.n for r in counts.where("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    all_whole = counts.agg(F.sum("whole")).first()[0] or 0
    places = spark.sparkContext.broadcast(Places(histogram, size))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, where = np.dtype(encoder(path).kind), places.value
        for every in batches:
            for begin in range(0, every.num_rows, 512):
                batch = every.slice(begin, 512)
                column = lambda c: np.asarray(batch.column(c)).astype(np.int64)
                n, rest = column("n"), column("rest")
                full = n // size
                row = np.repeat(np.arange(len(n)), full)
                k = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
                uncut = (row, k * size, np.full(len(row), size), (column("whole") + column("wholes_before"))[row] + k, np.zeros(len(row), np.int64))
                of, begins, sizes, sequences, offsets = where.pieces(rest, column("rank") + column("ranks_before"))
                remainder = (of, full[of] * size + begins, sizes, all_whole + sequences, offsets)
                row, start, length, sequence, offset = (np.concatenate(x) for x in zip(uncut, remainder))
                values = np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind).astype("<u4")
                first = (np.cumsum(n) - n)[row] + start
                data = [values[a : a + m].tobytes() for a, m in zip(first.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(data, pa.binary()),
                        pa.array(n[row]), pa.array(sequence), pa.array(offset),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    bases = stage(ranked.join(wholes, "task"), "ranks")
    joined = coded.join(bases.hint("shuffle_hash"), ["task", "rest"])
    return joined.mapInArrow(
        place, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )


def packing_digests(documents: DataFrame, path: str, size: int = 1024, end: int = 0) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of the ids."""
    return packed(documents, path, size, end).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
