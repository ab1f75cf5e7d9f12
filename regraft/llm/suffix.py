"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

#: Positions of one array: an index, a rank and the next rank fit into one 63-bit key.
MOST = (1 << 21) - 1
_BITS = np.uint64(21)
_LOW = np.uint64(MOST)


def joined(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols (byte + 1, a 0 after each piece, some padding) and the place of each piece's 0."""
    ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
    data = np.frombuffer(b"\0".join(pieces) + b"\0" * 9, np.uint8).astype(np.uint16) + np.uint16(1)
    data[ends] = 0
    data[ends[-1] :] = 0
    return data, ends


def suffix_array(symbols: np.ndarray, count: int) -> np.ndarray:
    """Order of the suffixes of ``symbols[:count]``; a 0 ends a suffix, and zeros order by place."""
    first = symbols[:count].astype(np.uint64)
    key = first
    open_ = first > 0  # no 0 so far
    for i in range(1, 4):
        following = np.where(open_, symbols[i : count + i], 0).astype(np.uint64)
        open_ &= following > 0
        key = (key << np.uint64(9)) | following
    packed = np.sort((key << _BITS) | np.arange(count, dtype=np.uint64))
    order = (packed & _LOW).astype(np.int64)
    key = packed >> _BITS
    starts = np.ones(count, bool)
    starts[1:] = (key[1:] != key[:-1]) | ~open_[order[1:]]
    slots = np.arange(count)
    group = np.maximum.accumulate(np.where(starts, slots, 0))
    rank = np.empty(count, np.uint64)
    rank[order] = group
    alone = starts & np.append(starts[1:], True)
    unsorted = np.flatnonzero(~alone)
    depth = 4
    while len(unsorted):
        place = order[unsorted]
        own = rank[place]
        packed = np.sort((own << np.uint64(42)) | (rank[place + depth] << _BITS) | place.astype(np.uint64))
        place = (packed & _LOW).astype(np.int64)
        order[unsorted] = place
        key = packed >> _BITS
        starts = np.ones(len(place), bool)
        starts[1:] = key[1:] != key[:-1]
        rank[place] = unsorted[np.maximum.accumulate(np.where(starts, np.arange(len(place)), 0))]
        unsorted = unsorted[~(starts & np.append(starts[1:], True))]
        depth *= 2
    return order


def common_prefixes(symbols: np.ndarray, order: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in ``order``.

    A common prefix loses one symbol from one place to the next in text order;
    only where the symbols in front differ is it counted anew.
    """
    count = len(order)
    before = np.empty(count, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = order[0]
    place = np.arange(count)
    fresh = np.ones(count, bool)
    fresh[1:] = (symbols[: count - 1] != symbols[before[1:] - 1]) | (symbols[: count - 1] == 0) | (before[1:] == 0)
    fresh[order[0]] = True
    a = np.flatnonzero(fresh)
    b = before[a]
    end_of = np.repeat(ends.astype(np.int32), np.diff(ends, prepend=-1))
    most = np.minimum(end_of[a] - a, end_of[b] - b)
    most[b == a] = 0
    words = np.ndarray((len(symbols) - 3,), "<u8", symbols.data, 0, (2,))
    length = np.zeros(len(a), np.int64)
    active = np.flatnonzero(most > 0)
    while len(active):
        at = length[active]
        differ = words[a[active] + at] ^ words[b[active] + at]
        same = np.where(differ == 0, 4, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) // 16)
        length[active] = at + same
        active = active[(same == 4) & (at + 4 < most[active])]
    values = np.full(count, -(1 << 40))
    values[a] = np.minimum(length, most) + a
    return (np.maximum.accumulate(values) - place)[order]


def repeat_classes(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of ``length``-byte strings in the joined pieces, their class (equal strings) and their piece."""
    symbols, ends = joined(pieces)
    count = int(ends[-1]) + 1
    order = suffix_array(symbols, count)
    prefixes = common_prefixes(symbols, order, ends)
    owner = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=-1))[order]
    whole = ends[owner] - order >= length
    classes = np.cumsum(prefixes < length)
    return order[whole], classes[whole], owner[whole]
