"""Words of many texts at a time, found on the bytes of their UTF-8."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from skyloom.llm.shingles import mix

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words: letters and everything beyond ASCII, or those and digits.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
LETTERS_AND_DIGITS = LETTERS.copy()
LETTERS_AND_DIGITS[48:58] = True

_BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_STEP = np.uint64(0x9FB21C651E98DF25)


@dataclass
class Words:
    """64-bit hashes of lower-cased words, the text of each, and where it stands in the bytes."""

    hashes: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def find_words(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray) -> Words:
    """The runs of ``solid`` bytes in consecutive texts, A-Z in lower case."""
    inside = solid[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[1:] = True, ~inside
    edge[offsets] = True  # a text begins
    first = inside & edge[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.empty(0, np.int64)
        return Words(np.empty(0, np.uint64), none, none, none)
    letters = LOWER[data[inside]]
    begin = np.flatnonzero(first[inside])
    sizes = np.diff(np.append(begin, len(letters)))
    place = np.arange(len(letters)) - np.repeat(begin, sizes)
    powers = np.multiply.accumulate(np.full(int(sizes.max()) + 1, _STEP))
    hashes = np.add.reduceat(_BYTE_HASH[letters] * powers[place], begin)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return Words(mix(hashes + sizes.astype(np.uint64)), owner, starts, starts + sizes)


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The lower-cased text of the given stretches."""
    sizes = ends - starts
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    places = np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(bounds), pa.py_buffer(LOWER[data[places]])
    )
