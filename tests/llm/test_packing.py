"""Packs: every id once, no padding, patterns joined back by rank."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from regraft.llm.packing import Places, encoder, packed, packing_digests, shortest_pack_first

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


def check_pieces(rows, given, size):
    """``rows``: (doc_id, start, length, crc, tokens, sequence, offset); ``given``: id to the texts that have it."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, tokens, sequence, offset in rows:
        assert length > 0
        sequences[sequence].append((offset, length))
        pieces[doc].append((start, length, crc, tokens))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == size or at < size and at & (at - 1) == 0
    assert sum(1 for own in sequences.values() if sum(n for _, n in own) < size) <= size.bit_length()
    for doc, texts in given.items():
        left = pieces.pop(doc)
        for ids in map(ids_of, texts):
            at = 0
            while at < len(ids):
                data = np.array(ids, "<u4")
                fits = [p for p in left if p[0] == at and p[3] == len(ids) and zlib.crc32(data[at : at + p[1]].tobytes()) == p[2]]
                assert fits, (doc, at)
                left.remove(fits[0])
                at += fits[0][1]
            assert at == len(ids)
        assert not left
    assert not pieces
    return len(sequences)


def tuples(frame):
    return [tuple(r) for r in frame.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset").collect()]


ODD_TEXTS = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a   b ", "a\n b", "a\n  b", "a \n b\n", "a\n \nb", "it's we'll 'S", "x  y", "x  y ",
    "x\x1c y\x1d\x1ez", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "漢字 かな 12½ ٣٤ 😀👍🏽 é é", "  a b  ", "0" * 300, "ab" * 4000, "w " * 3000, "\t\tx\r\n\r\n y",
]


def test_ids_are_those_of_the_library(corpus):
    coder = encoder(PATH)
    for text in [*(t or "" for t in ODD_TEXTS), *(t for _, t in corpus[1])]:
        assert np.frombuffer(coder.encode(text), coder.kind).tolist() == ids_of(text)[:-1], text[:80]


@pytest.mark.parametrize("seed", range(80))
def test_each_id_lies_in_one_place(seed):
    draw = random.Random(seed)
    size = draw.choice([2, 3, 8, 16, 100])
    kinds = draw.randint(0, min(size - 1, 40))
    histogram = {n: draw.choice([1, 2, 7, 60]) for n in draw.sample(range(1, size), kinds)}
    places = Places(histogram, size)
    held = defaultdict(list)
    for n, count in histogram.items():
        row, start, length, sequence, offset = (x.tolist() for x in places.pieces(np.full(count, n), np.arange(count)))
        at = [0] * count
        for r, a, m, s, o in zip(row, start, length, sequence, offset):
            assert a == at[r] and m > 0
            at[r] += m
            held[s].append((o, m))
        assert at == [n] * count
    shorter = 0
    for own in held.values():
        at = 0
        for o, m in sorted(own):
            assert o == at
            at += m
        shorter += at < size
        assert at == size or at & (at - 1) == 0
    assert sorted(held) == list(range(places.sequences))
    assert shorter <= size.bit_length()


def test_patterns_do_not_grow_with_the_counts():
    draw = random.Random(1)
    shares = {n: draw.randrange(1, 50) for n in range(1, 1024)}
    shares[700] = 30_000
    few, many = (Places({n: c * k for n, c in shares.items()}, 1024) for k in (1, 10**7))
    assert len(many.slots) < 2 * len(few.slots) < 40_000
    assert len(many.room) < 5_000
    assert 0 <= many.sequences - sum(n * c for n, c in shares.items()) * 10**7 // 1024 <= 10
    found = many.pieces(np.array([700, 700, 3, 0]), np.array([0, 3 * 10**11 - 1, 5, 0]))
    assert set(found[0].tolist()) == {0, 1, 2} and found[2].sum() == 700 + 700 + 3


def test_shortest_pack_comes_first():
    packs = shortest_pack_first({7: 1, 5: 1, 2: 1}, 10)
    # 5 opens a pack, 2 goes to it as it holds less than the one with 7
    assert [[s[0] for s in p.slots] for p in packs.by_room[3]] == [[7], [5, 2]]
    alike = shortest_pack_first({3: 7}, 10)
    assert [(p.count, len(p.slots)) for p in alike.by_room[1]] == [(2, 3)]


def test_pieces_of_odd_texts(documents):
    given = dict(enumerate([[t] for t in ODD_TEXTS]))
    for size in (16, 1024):
        check_pieces(tuples(packing_digests(documents(*ODD_TEXTS).repartition(3), PATH, size)), given, size)


def test_repeated_rows_and_null_ids(documents):
    rows = [(1, "one two"), (1, "one two"), (1, "other"), (None, "one two"), (None, None), (2, "x " * 900)]
    given = {1: ["one two", "one two", "other"], None: ["one two", None], 2: ["x " * 900]}
    check_pieces(tuples(packing_digests(documents(*rows), PATH, 64)), given, 64)


def test_many_of_one_length(documents):
    rows = [(i, "a b c" if i % 3 else "d e") for i in range(2000)]
    found = tuples(packing_digests(documents(*rows).repartition(7), PATH, 64))
    assert check_pieces(found, {i: [t] for i, t in rows}, 64) <= -(-sum(len(ids_of(t)) for _, t in rows) // 64) + 6


def test_empty_table_and_whole_sequences(spark, documents):
    assert packed(documents((1, "x")).limit(0), PATH).collect() == []
    whole = [(i, "a" + " a" * 30) for i in range(5)]  # 31 ids and the end
    check_pieces(tuples(packing_digests(documents(*whole), PATH, 16)), {i: [t] for i, t in whole}, 16)


def test_the_table(corpus):
    table, rows = corpus
    count = check_pieces(tuples(packing_digests(table, PATH)), {i: [t] for i, t in rows}, 1024)
    tokens = sum(len(ids_of(t)) for _, t in rows)
    assert count <= tokens // 1024 + 11
