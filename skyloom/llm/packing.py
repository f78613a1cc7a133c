"""Packing of tokenized documents into windows, in order, by dynamic programming.

The documents of a partition form one stream of ids. It may be cut at document ends, at sentence
ends and, where neither comes for a while, at fixed distances. ``best_cuts`` chooses the cuts that
minimise padding plus penalties for cutting through a document. The cost of a window that ends at
``p`` and starts at ``s`` is ``cost(s) + s + window - p``, so the best start is the smallest
``cost(s) + s`` among the places at most a window away, which a monotone queue hands out in
constant time. Windows whose length is a power of two are not padded; their starts are looked up.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

#: Fixed value: how the byte-level vocabulary splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Costs in ids of padding: a cut at a sentence end, a cut inside a sentence, a further window.
SENTENCE_CUT, HARD_CUT, ONE_MORE_WINDOW = 2.0, 24.0, 1.0
#: Without a sentence end for so many ids, the stream may be cut anyway.
HARD_EVERY = 64
#: A stream is cut whenever so many ids have gathered.
CHUNK = 1 << 17
#: Long texts are tokenized in segments of about so many characters, cut where no merge crosses.
SEGMENT = 1 << 20


class ByteBpe:
    """Ids of a byte-level BPE vocabulary file, equal to those of its own library."""

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = sorted(set(range(256)) - set(shown))
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t["content"]: t["id"] for t in stored["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in token): i
            for token, i in stored["model"]["vocab"].items()
            if token not in special
        }
        self.special = tuple(special)
        self.encoding = tiktoken.Encoding(
            "byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        self.ends_sentence = np.zeros(max([*ranks.values(), *special.values()]) + 1, bool)
        for token, i in ranks.items():
            ends = token.rstrip()[-1:] in (b".", b"!", b"?") or b"\n" in token
            self.ends_sentence[i] = ends

    def encode(self, text: str) -> np.ndarray:
        parts = [self._part(part) for part in segments(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def _part(self, text: str) -> np.ndarray:
        allowed = "all" if any(s in text for s in self.special) else set()
        try:
            return self.encoding.encode_to_numpy(
                text, allowed_special=allowed, disallowed_special=()
            )
        except ValueError:  # a run of white space too long for its pattern search
            from tokenizers import Tokenizer

            ids = Tokenizer.from_file(self.path).encode(text, add_special_tokens=False).ids
            return np.array(ids, np.uint32)


def segments(text: str) -> list[str]:
    """The text in parts of some million characters, cut before a space between other characters."""
    parts, start = [], 0
    while len(text) - start > 2 * SEGMENT:
        at = start + SEGMENT
        while 0 < (at := text.find(" ", at)) < len(text) - 1:
            if not text[at - 1].isspace() and not text[at + 1].isspace():
                break
            at += 1
        if not 0 < at < len(text) - 1:
            break
        parts.append(text[start:at])
        start = at
    return [*parts, text[start:]]


@lru_cache(2)
def byte_bpe(path: str) -> ByteBpe:
    """One vocabulary per worker process."""
    return ByteBpe(path)


def best_cuts(places: list[int], penalties: list[float], window: int) -> list[int]:
    """The cuts of least cost among ascending places, the last of which is the end.

    ``penalties`` has the cost of a cut at each place; neighbours are at most a window apart.
    """
    powers = [1 << k for k in range(6, 31) if 1 << k < window]
    position = [0, *places]
    cost, back, at = [0.0] * len(position), [0] * len(position), {0: 0}
    queue, keys = deque([0]), deque([0.0])
    for j in range(1, len(position)):
        p = position[j]
        while position[queue[0]] < p - window:
            queue.popleft()
            keys.popleft()
        i, best = queue[0], keys[0] + window - p
        for size in powers:
            k = at.get(p - size)
            if k is not None and cost[k] < best:
                i, best = k, cost[k]
        best += penalties[j - 1] + ONE_MORE_WINDOW
        cost[j], back[j], at[p] = best, i, j
        key = best + p
        while keys and keys[-1] >= key:
            keys.pop()
            queue.pop()
        keys.append(key)
        queue.append(j)
    cuts, j = [], len(position) - 1
    while j:
        cuts.append(position[j])
        j = back[j]
    return cuts[::-1]


class Stream:
    """The ids of a partition's documents, cut into windows as they come."""

    def __init__(self, window: int, ends_sentence: np.ndarray):
        self.window, self.ends_sentence = window, ends_sentence
        self.docs: list[tuple] = []  # id, ids still to place, start of these, number in all
        self.gathered, self.sequence = 0, 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[tuple]:
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.gathered += len(ids)
        if self.gathered >= CHUNK:
            yield from self.cut(last=False)

    def cut(self, last: bool) -> Iterator[tuple]:
        """Places what has gathered; all but the last window unless the stream ends here."""
        if not self.docs:
            return
        sizes = np.array([len(ids) for _, ids, _, _ in self.docs])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        stream = np.concatenate([ids for _, ids, _, _ in self.docs])
        inner = np.flatnonzero(self.ends_sentence[stream]) + 1
        kind = np.zeros(len(stream) + 1, np.int8)  # 1 sentence end, 2 hard, 3 document end
        kind[inner] = 1
        kind[ends[sizes > 1] - 1] = 0  # no cut that leaves a document's end id alone
        kind[ends] = 3
        soft = np.concatenate([[0], np.flatnonzero(kind)])
        for gap in np.flatnonzero(np.diff(soft) > HARD_EVERY):
            kind[soft[gap] + HARD_EVERY : soft[gap + 1] : HARD_EVERY] = 2
        places = np.flatnonzero(kind)
        penalty = np.array([0.0, SENTENCE_CUT, HARD_CUT, 0.0])[kind[places]]
        cuts = best_cuts(places.tolist(), penalty.tolist(), self.window)
        placed = cuts if last else cuts[:-1]
        limit = placed[-1] if placed else 0
        starts = np.array([0, *placed[:-1]])
        marks = np.unique(np.concatenate([starts, begins]))
        marks = np.append(marks[marks < limit], limit)
        owner = np.searchsorted(begins, marks[:-1], side="right") - 1
        window = np.searchsorted(starts, marks[:-1], side="right") - 1
        for a, b, d, w in zip(
            marks[:-1].tolist(), marks[1:].tolist(), owner.tolist(), window.tolist()
        ):
            doc_id, ids, skipped, total = self.docs[d]
            begin = int(begins[d])
            yield (
                doc_id,
                skipped + a - begin,
                b - a,
                stream[a:b].tobytes(),
                total,
                self.sequence + w,
                a - int(starts[w]),
            )
        self.sequence += len(placed)
        rest = []
        for (doc_id, ids, skipped, total), begin, end in zip(self.docs, begins, ends):
            if end > limit:
                done = max(limit - int(begin), 0)
                rest.append((doc_id, ids[done:], skipped + done, total))
        self.docs, self.gathered = rest, int(ends[-1]) - limit


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """The pieces of the documents and their places in sequences of at most ``window`` ids.

    ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: ``ids`` holds the piece's ids
    as little-endian unsigned 32-bit numbers, ``doc_tokens`` counts all ids of the document with
    its ``end_id``. Every input partition is packed on its own, in its order, without a shuffle;
    ``sequence_id`` carries the partition in its upper half, so a task that runs again gives the
    same rows. A partition ends with one sequence that may be short. Cuts are the best ones of each
    stretch of ``CHUNK`` ids of a partition's stream; no id is lost where stretches meet.

    Null and empty texts are an ``end_id`` alone. Every row counts as a document, also when its
    ``doc_id`` is null or repeated. Long texts are cut like all others. Other columns are left
    out. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_path)
        stream = Stream(window, bpe.ends_sentence)
        number = TaskContext.get().partitionId() << 32

        def batch(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces))
            columns[5] = [number + s for s in columns[5]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

        for part in batches:
            pieces = []
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"]):
                ids = bpe.encode(text.as_py() or "")
                pieces += stream.add(doc_id, np.append(ids, np.uint32(end_id)))
            if pieces:
                yield batch(pieces)
        if pieces := list(stream.cut(last=True)):
            yield batch(pieces)

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    arrow = pa.schema(
        [
            ("doc_id", to_arrow_type(docs.schema["doc_id"].dataType)),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids", pa.binary()),
            ("doc_tokens", pa.int64()),
            ("sequence_id", pa.int64()),
            ("offset", pa.int64()),
        ]
    )
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {names}")
