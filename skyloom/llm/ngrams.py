"""Hashed n-gram counts of many texts at a time, and their weights."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

from skyloom.llm.shingles import text_blocks

#: Count matrices have at most so many rows.
BLOCK_TEXTS = 128

#: Bytes as letters: A-Z in lower case, all other ASCII as space, the rest as it is.
LETTERS = np.arange(256, dtype=np.uint8)
LETTERS[:128] = 32
LETTERS[97:123] = np.arange(97, 123)
LETTERS[65:91] = np.arange(97, 123)

#: Bytes as shapes: small letters (and all above ASCII) alike, capitals alike, digits alike.
SHAPES = np.arange(256, dtype=np.uint8)
SHAPES[97:123] = SHAPES[128:] = 97
SHAPES[65:91] = 65
SHAPES[48:58] = 48


def small_blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As ``text_blocks``, in blocks of at most ``BLOCK_TEXTS`` texts."""
    for first, data, offsets in text_blocks(texts):
        for begin in range(0, len(offsets) - 1, BLOCK_TEXTS):
            own = offsets[begin : begin + BLOCK_TEXTS + 1]
            yield first + begin, data[own[0] : own[-1]], own - own[0]


def ngram_counts(
    data: np.ndarray, offsets: np.ndarray, orders: Sequence[int], buckets: int
) -> np.ndarray:
    """How often each bucket is hit by the n-grams of each text (one row a text).

    ``buckets`` is a power of two; n-grams do not cross from one text to the next.
    """
    count, sizes = len(offsets) - 1, np.diff(offsets)
    flat = np.zeros(count * buckets, np.int64)
    base = np.repeat(np.arange(count, dtype=np.int64) * buckets, sizes)
    shift = np.uint32(32 - buckets.bit_length() + 1)
    code = np.zeros(len(data), np.uint32)
    for n in range(1, max(orders) + 1):
        code = code[: len(data) - n + 1] * np.uint32(0x01000193)
        code += data[n - 1 :]
        if n in orders and len(code):
            hit = base[: len(code)] + ((code + np.uint32(n)) * np.uint32(0x9E3779B1) >> shift)
            flat += np.bincount(hit, minlength=len(flat))
            # Take back what begins in one text and ends in another.
            over = (offsets[1:, None] - np.arange(1, n)).reshape(-1)
            over = np.unique(over[(over >= 0) & (over < len(code))])
            np.subtract.at(flat, hit[over], 1)
    return flat.reshape(count, buckets)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """The rows at length one; rows of zeros stay."""
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of dampened counts times ``idf``, at length one."""
    return unit_rows(np.log1p(counts, dtype=np.float32) * idf)


def inverse_frequencies(texts_with: np.ndarray, texts: int) -> np.ndarray:
    """Smoothed inverse document frequencies."""
    return np.log((1 + texts) / (1 + texts_with)).astype(np.float32) + np.float32(1)
