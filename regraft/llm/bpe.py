"""BPE encoding and decoding: merges from a heap over a doubly linked list of symbols.

Follows a vocabulary file of the ``tokenizers`` format with word ends: text is
cut at special tokens, normalised (NFC, white space to one blank, lower case),
split by the file's pattern, mapped to byte symbols, and merged word by word.

Defined results: null and empty texts have no ids and decode to an empty text;
pieces that the pattern leaves out (white space) are dropped as in the file's
own behaviour; repeated rows are encoded alike; further columns are ignored.
A symbol that is not in the vocabulary is dropped, as there is no unknown token.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import per_batch, texts

#: ``str.split`` takes these for white space, the pattern doesn't.
SEPARATORS = regex.compile("[\x1c-\x1f]").search
#: Words whose ids a Python worker keeps; the least used go first.
KEPT_WORDS = 200_000


def byte_symbols() -> list[str]:
    """A printable character for each byte: itself where printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    symbols, further = [], 256
    for b in range(256):
        symbols.append(chr(b if b in plain else further))
        further += b not in plain
    return symbols


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.packed = {s: i.to_bytes(4, "little") for s, i in self.vocabulary.items()}
        self.end = model["end_of_word_suffix"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.vocabulary | self.special).items()}
        splitter = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(splitter).findall
        self.symbols = byte_symbols()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")").split
        self.word_ids = lru_cache(KEPT_WORDS)(self.encode_word)
        self.run_ids = lru_cache(KEPT_WORDS)(self.encode_run)

    def merge(self, word: str) -> list[str]:
        """Applies the merges in order of rank, leftmost first.

        ``before`` and ``after`` link the symbols; a merge empties the right
        one. An entry of the heap is stale if its pair isn't there any more.
        """
        symbols = [self.symbols[b] for b in word.encode()]
        symbols[-1] += self.end
        count, rank_of = len(symbols), self.ranks.get
        before, after = list(range(-1, count - 1)), list(range(1, count + 1))
        heap = [
            (rank, i, pair)
            for i, pair in enumerate(zip(symbols, symbols[1:]))
            if (rank := rank_of(pair)) is not None
        ]
        heapq.heapify(heap)
        while heap:
            _, left, (first, second) = heapq.heappop(heap)
            right = after[left]
            if symbols[left] != first or right >= count or symbols[right] != second:
                continue
            symbols[left], symbols[right] = first + second, ""
            following = after[left] = after[right]
            if following < count:
                before[following] = left
                pair = symbols[left], symbols[following]
                if (rank := rank_of(pair)) is not None:
                    heapq.heappush(heap, (rank, left, pair))
            preceding = before[left]
            if preceding >= 0:
                pair = symbols[preceding], symbols[left]
                if (rank := rank_of(pair)) is not None:
                    heapq.heappush(heap, (rank, preceding, pair))
        return [s for s in symbols if s]

    def encode_word(self, word: str) -> bytes:
        """Little-endian ids of one word."""
        packed = self.packed
        return b"".join([packed[s] for s in self.merge(word) if s in packed])

    def encode_run(self, run: str) -> bytes:
        """Little-endian ids of text without white space; pieces never reach over white space."""
        return b"".join(map(self.word_ids, self.pieces(run)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out = []
        for i, part in enumerate(self.cut(text)):
            if i % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            elif part:
                plain = lowered(unicodedata.normalize("NFC", part))
                runs = self.pieces(plain) if SEPARATORS(plain) else plain.split()
                out.extend(map(self.run_ids, runs))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The vocabulary strings one after the other, with a blank between, as there is no decoder in the file."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def lowered(text: str) -> str:
    """Lower case character by character: a capital sigma is always the same small one."""
    return text.lower() if "Σ" not in text else "σ".join(p.lower() for p in text.split("Σ"))


@lru_cache(2)
def loaded(path: str) -> WordBpe:
    return WordBpe(path)


def bpe_encode(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` (binary, 4 bytes each) for every document."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = loaded(path)
        ids = [bpe.encode(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return per_batch(texts(documents), work, "doc_id long, ids binary")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded`` from the rows of :func:`bpe_encode`; null ids are empty."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = loaded(path)
        decoded = [bpe.decode(i or b"") for i in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("ids"), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"]
        )

    return per_batch(encoded.select("doc_id", "ids"), work, "doc_id long, ids binary, decoded string")


def bpe_digests(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded, decoded and hashed where the text is read."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = loaded(path)
        counts, of_ids, of_text = [], [], []
        for text in batch.column("text").to_pylist():
            ids = bpe.encode(text)
            counts.append(len(ids) // 4)
            of_ids.append(hashlib.sha256(ids).hexdigest())
            of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return per_batch(texts(documents), work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def bpe_documents(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids, decoded_sha256`` of every document, for training."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = loaded(path)
        ids = [bpe.encode(t or "") for t in batch.column("text").to_pylist()]
        lengths = [len(i) // 4 for i in ids]
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        values = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
        digests = [hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in ids]
        kept = [batch.column(c) for c in ("doc_id", "lang", "source")]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(digests)],
            ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"],
        )

    schema = "doc_id long, lang string, source string, n_tokens long, ids array<int>, decoded_sha256 string"
    return per_batch(documents.select("doc_id", "text", "lang", "source"), work, schema)
