"""Word shingles of texts and their fast similarity sketches, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from skyloom.llm.common import SPACES

#: Texts are worked on together up to about so many bytes.
BLOCK_BYTES = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in SPACES]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def text_blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes in UTF-8 and offsets of consecutive texts; null texts are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        own = offsets[first : last + 1]
        yield first, data[own[0] : own[-1]], own - own[0]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of consecutive texts, and the text of each word."""
    solid = ~_SPACE[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[1:] = True, ~solid
    edge[offsets] = True  # a text begins
    first = solid & edge[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    letters = _LOWER[data[solid]]
    begin = np.flatnonzero(first[solid])
    sizes = np.diff(np.append(begin, len(letters)))
    place = np.arange(len(letters)) - np.repeat(begin, sizes)
    powers = np.multiply.accumulate(np.full(int(sizes.max()) + 1, _STEP))
    hashes = np.add.reduceat(_BYTE_HASH[letters] * powers[place], begin)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return mix(hashes + sizes.astype(np.uint64)), owner


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, words: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """The texts' shingle sets: hashes in ascending order within a text, and where each starts.

    A text with fewer than ``words`` words has all of them as its one shingle; without words, none.
    """
    count = len(offsets) - 1
    hashes, owner = word_hashes(data, offsets)
    per_text = np.bincount(owner, minlength=count)
    rolled = hashes.copy()
    for k in range(1, words):
        rolled[: len(hashes) - k] = mix(rolled[: len(hashes) - k] * _STEP + hashes[k:])
    begins = np.cumsum(per_text) - per_text
    inside = np.arange(len(hashes)) - begins[owner] <= per_text[owner] - words
    found, texts = rolled[inside], owner[inside]
    short = np.flatnonzero((per_text > 0) & (per_text < words))
    if len(short):
        whole = []
        for text in short:
            own = hashes[begins[text] : begins[text] + per_text[text]]
            total = own[:1]
            for k in range(1, len(own)):
                total = mix(total * _STEP + own[k])
            whole.append(mix(total + np.uint64(len(own)))[0])
        found = np.concatenate([found, np.array(whole, np.uint64)])
        texts = np.concatenate([texts, short])
    order = np.lexsort((found, texts))
    found, texts = found[order], texts[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (texts[1:] != texts[:-1])
    found, texts = found[new], texts[new]
    return found, np.searchsorted(texts, np.arange(count + 1))


def sketches(sets: np.ndarray, starts: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Fast similarity sketches: ``size`` coordinates for each set, a row of zeros for empty sets.

    In round ``i`` every element is thrown into a bin and offers a value that grows with the round;
    a bin keeps the smallest. After ``size`` rounds of random bins, ``size`` more fill one given
    bin each, so every coordinate of a set with elements is filled. Only sets with empty bins go
    through a further round; large sets need one or two.
    """
    count = len(starts) - 1
    values = np.full((count, size), np.iinfo(np.uint64).max, np.uint64)
    flat = values.reshape(-1)
    owner = np.repeat(np.arange(count), np.diff(starts))
    open_sets = np.diff(starts) > 0
    elements = sets
    for i in range(2 * size):
        if not len(elements):
            break
        drawn = mix(elements + np.uint64((i + 1 + 1000 * seed) * 0x9E3779B97F4A7C15 % 2**64))
        bins = (drawn >> np.uint64(48)) * np.uint64(size) >> np.uint64(16) if i < size else i - size
        offered = (drawn & np.uint64(2**48 - 1)) | np.uint64(i << 48)
        np.minimum.at(flat, (owner * size + bins).astype(np.int64), offered)
        if i < 8 or i % 8 == 0 or i >= size:
            open_now = open_sets & (values.max(axis=1) >= np.uint64((i + 1) << 48))
            if not open_now.all():
                keep = open_now[owner]
                elements, owner = elements[keep], owner[keep]
            open_sets = open_now
    values[np.diff(starts) == 0] = 0
    return values


def band_keys(values: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of consecutive coordinates."""
    rows = values.shape[1] // bands
    parts = values[:, : bands * rows].reshape(len(values), bands, rows)
    keys = np.broadcast_to(
        np.arange(1, bands + 1, dtype=np.uint64) * _STEP, parts.shape[:2]
    ).copy()
    for k in range(rows):
        keys = mix(keys + parts[:, :, k])
    return keys


def digests(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """128 bits that tell sets apart, as two numbers a set."""
    count = len(starts) - 1
    sums = np.zeros((count, 2), np.uint64)
    filled = np.diff(starts) > 0
    for k, salt in enumerate((0x2545F4914F6CDD1D, 0x632BE59BD9B4E019)):
        if len(sets):
            total = np.add.reduceat(mix(sets ^ np.uint64(salt)), starts[:-1][filled])
            sums[filled, k] = total
    return sums
