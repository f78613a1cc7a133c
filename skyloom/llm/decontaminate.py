"""Benchmark passages in documents, by a generalised suffix automaton.

The words of all test items go into one automaton, whose states stand for the word sequences that
some item holds. A document's words are streamed through it, which tells at each word how long the
longest match is that ends there; matches of a window or more are passages, and the state tells which
items hold it. A sequence of item words can only go on where the pair of neighbouring words stands in
an item, so stretches between pairs that no item has are looked up at once, and only stretches of
the least window's length go through the automaton.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.shingles import text_blocks
from skyloom.llm.tokens import LETTERS_AND_DIGITS, find_words
from skyloom.storage import discard, written

#: Words of an automaton: about 150 MB in a task. More are dealt to several, one pass each.
PART_WORDS = 200_000


class Automaton:
    """The word sequences of items, ``(item, hashes of its words)``; windows have ``window`` words."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        self.window = window
        items = [(item, hashes) for item, hashes in items if len(hashes)]
        every = [hashes for _, hashes in items] or [np.empty(0, np.uint64)]
        self.vocabulary = np.unique(np.concatenate(every))
        self.least = min((min(len(h), window) for _, h in items), default=window)
        self._next: list[dict[int, int]] = [{}]
        self._link, self._length = [-1], [0]
        texts = [(item, self._ids(hashes)) for item, hashes in items]
        width = len(self.vocabulary)
        pairs = [ids[:-1] * width + ids[1:] for _, ids in texts] or [np.empty(0, np.int64)]
        self.pairs = np.unique(np.concatenate(pairs))
        for _, ids in texts:
            last = 0
            for word in ids.tolist():
                last = self._extend(last, word)
        self._mark(texts)

    def _ids(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for those that no item has."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        place = np.searchsorted(self.vocabulary, hashes)
        place[place == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[place] == hashes, place, -1)

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self._length.append(length)
        self._next.append(following)
        self._link.append(link)
        return len(self._link) - 1

    def _split(self, before: int, word: int) -> int:
        """The state for the sequences of ``before`` and ``word`` alone, taken out of a longer one's."""
        whole = self._next[before][word]
        if self._length[whole] == self._length[before] + 1:
            return whole
        part = self._state(self._length[before] + 1, dict(self._next[whole]), self._link[whole])
        self._link[whole] = part
        while before >= 0 and self._next[before].get(word) == whole:
            self._next[before][word] = part
            before = self._link[before]
        return part

    def _extend(self, last: int, word: int) -> int:
        if word in self._next[last]:
            return self._split(last, word)
        new = self._state(self._length[last] + 1, {}, 0)
        while last >= 0 and word not in self._next[last]:
            self._next[last][word] = new
            last = self._link[last]
        if last >= 0:
            self._link[new] = self._split(last, word)
        return new

    def _mark(self, texts: list[tuple[str | None, np.ndarray]]) -> None:
        """Which items hold a state's last ``window`` words, and which shorter items end there."""
        order = np.argsort(self._length, kind="stable").tolist()
        #: The state of a state's last window of words.
        self._last_window = [-1] * len(order)
        for state in order[1:]:
            if self._length[state] >= self.window:
                link = self._link[state]
                shorter = self._length[link] < self.window
                self._last_window[state] = state if shorter else self._last_window[link]
        self._items: dict[int, set[str | None]] = {}
        self._short: dict[int, dict[int, set[str | None]]] = {}
        for item, ids in texts:
            state = 0
            for i, word in enumerate(ids.tolist()):
                state = self._next[state][word]
                if i + 1 >= self.window:
                    self._items.setdefault(self._last_window[state], set()).add(item)
            if len(ids) < self.window:
                self._short.setdefault(state, {}).setdefault(len(ids), set()).add(item)
        #: The nearest state on the way to the root, the state included, where a short item ends.
        self._ending = [-1] * len(order)
        for state in order[1:]:
            own = state in self._short
            self._ending[state] = state if own else self._ending[self._link[state]]

    def stretches(self, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
        """Numbers of the words, and begin and end of the stretches that can hold a window."""
        ids = self._ids(hashes)
        known = ids >= 0
        joined = np.zeros(len(ids) + 1, bool)
        both = np.flatnonzero(known[1:] & known[:-1] & (owner[1:] == owner[:-1])) + 1
        if len(both) and len(self.pairs):
            keys = ids[both - 1] * len(self.vocabulary) + ids[both]
            place = np.searchsorted(self.pairs, keys)
            place[place == len(self.pairs)] = 0
            joined[both[self.pairs[place] == keys]] = True
        begins = np.flatnonzero(known & ~joined[:-1])
        ends = np.flatnonzero(known & ~joined[1:]) + 1
        enough = ends - begins >= self.least
        return ids, begins[enough], ends[enough]

    def stream(self, words: list[int]) -> tuple[list[list[int]], set[str | None]]:
        """Passages ``[begin, end]`` (the end not included) in a stretch, and their items."""
        state = length = 0
        passages: list[list[int]] = []
        items: set[str | None] = set()
        for i, word in enumerate(words):
            following = self._next[state].get(word)
            while following is None and state:
                state = self._link[state]
                length = self._length[state]
                following = self._next[state].get(word)
            if following is None:
                continue
            state, length = following, length + 1
            if length >= self.window:
                begin = i + 1 - length
                if passages and passages[-1][0] == begin:
                    passages[-1][1] = i + 1
                else:
                    passages.append([begin, i + 1])
                items |= self._items[self._last_window[state]]
            ending = self._ending[state]
            while ending >= 0:
                for size, whole in self._short[ending].items():
                    if size <= length:
                        passages.append([i + 1 - size, i + 1])
                        items |= whole
                ending = self._ending[self._link[ending]]
        return passages, items


def joined_passages(passages: list[list[int]]) -> list[list[int]]:
    """Passages in order, those that overlap or touch made one."""
    result: list[list[int]] = []
    for begin, end in sorted(passages):
        if result and begin <= result[-1][1]:
            result[-1][1] = max(result[-1][1], end)
        else:
            result.append([begin, end])
    return result


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    max_words: int = 0,
    max_coverage: float = 0.5,
    part_words: int = PART_WORDS,
) -> DataFrame:
    """``doc_id, text, n_words, n_hit, items, passages, removed``: benchmark passages and the rest.

    Words are runs of letters, digits and all beyond ASCII, A-Z in lower case. ``window`` words of an
    item in a row make a window; an item of fewer words is one as a whole. ``n_hit`` counts the
    document's words inside any window that occurs in it, ``items`` are the ``item_id`` whose windows
    occur, as text, in order, and ``passages`` the stretches of such words (``begin``, ``words``).
    ``text`` comes without passages of more than ``max_words`` words; a document of whose words a
    share above ``max_coverage`` is hit loses its text (``removed``).

    Each row of ``docs`` comes back. Null texts have no words and stay null, items without text or
    words match nothing. Rows with the same ``item_id`` are one item of several texts; items without an
    id hit words, but are not listed. Without items nothing is hit. Other columns are left out. Words
    are told apart by 64-bit hashes.

    Items go to the tasks in automata of at most ``part_words`` words. Up to that size the documents
    are read once and nothing is shuffled; every further automaton is one more pass over them, with
    the passages found so far written in between.
    """
    rows = docs.select(F.col("doc_id"), F.col("text"))
    id_field = rows.schema["doc_id"]
    rows = rows.withColumn("found", F.lit(None).cast("array<int>"))
    rows = rows.withColumn("items", F.lit(None).cast("array<string>"))
    kept, pieces = None, _pieces(items, window, part_words)
    parts = _parts(pieces, part_words)
    context = docs.sparkSession.sparkContext
    between = f"{id_field.name} {id_field.dataType.simpleString()}, text string, "
    for part in range(parts):
        own = pieces.where(F.col("deal") % parts == part).select("item", "hashes").collect()
        own = [(r["item"], np.frombuffer(bytes(r["hashes"]), "<u8")) for r in own]
        automaton = context.broadcast(Automaton(own, window))
        if part + 1 < parts:
            rows = rows.mapInArrow(_marked(automaton), between + "found array<int>, items array<string>")
            rows = written(rows, "passages")
            discard(*([kept] if kept is not None else []))
            kept = rows
    discard(pieces)
    return rows.mapInArrow(
        _cut(automaton, max_words, max_coverage),
        between + "n_words long, n_hit long, items array<string>,"
        " passages array<struct<begin: int, words: int>>, removed boolean",
    )


def _pieces(items: DataFrame, window: int, part_words: int) -> DataFrame:
    """``item, hashes, words, deal``: items' words, long items in pieces that share no window's end."""
    step = max(part_words // 8, window)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_blocks(batch["text"]):
                words = find_words(data, offsets, LETTERS_AND_DIGITS)
                bounds = np.searchsorted(words.owner, np.arange(len(offsets)))
                rows = []
                for i, (begin, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for at in range(begin, max(end - window, begin) + 1, step):
                        own = words.hashes[at : min(at + step + window - 1, end)]
                        rows.append((first + i, own.astype("<u8").tobytes(), len(own)))
                if rows:
                    places, hashes, sizes = zip(*rows)
                    yield pa.record_batch(
                        [batch["item"].take(pa.array(places)), pa.array(hashes, pa.binary()),
                         pa.array(sizes, pa.int64())],
                        ["item", "hashes", "words"],
                    )

    chosen = items.select(F.col("item_id").cast("string").alias("item"), "text")
    found = chosen.mapInArrow(read, "item string, hashes binary, words long").where("words > 0")
    found = found.dropDuplicates(["item", "hashes"])
    deal = F.pmod(F.xxhash64("item", "hashes"), F.lit(1 << 30))
    return written(found.withColumn("deal", deal), "item-words")


def _parts(pieces: DataFrame, part_words: int) -> int:
    """How many automata keep each within ``part_words`` words."""
    total = pieces.agg(F.sum("words")).first()[0] or 0
    parts = max(1, -(-total // part_words))
    while parts > 1:
        load = pieces.groupBy(F.col("deal") % parts).agg(F.sum("words").alias("w"))
        if load.agg(F.max("w")).first()[0] <= part_words:
            break
        parts += -(-parts // 4)
    return parts


def _documents(automaton, batch: pa.RecordBatch) -> Iterator[tuple]:
    """Row, words' begins and ends, joined passages, items and bytes of each document."""
    automaton = automaton.value
    earlier, items = batch["found"], batch["items"]
    for first, data, offsets in text_blocks(batch["text"]):
        words = find_words(data, offsets, LETTERS_AND_DIGITS)
        bounds = np.searchsorted(words.owner, np.arange(len(offsets)))
        ids, begins, ends = automaton.stretches(words.hashes, words.owner)
        per_text: dict[int, tuple[list, set]] = {}
        for begin, end in zip(begins.tolist(), ends.tolist()):
            passages, held = automaton.stream(ids[begin:end].tolist())
            if passages:
                text = int(words.owner[begin])
                shift = begin - int(bounds[text])
                kept = per_text.setdefault(text, ([], set()))
                kept[0].extend([a + shift, b + shift] for a, b in passages)
                kept[1].update(held)
        for text in range(len(offsets) - 1):
            row = first + text
            passages, held = per_text.get(text, ([], set()))
            if earlier[row].is_valid:
                flat = earlier[row].as_py()
                passages = passages + [list(pair) for pair in zip(flat[::2], flat[1::2])]
                held = held | set(items[row].as_py())
            held = sorted(item for item in held if item is not None)
            own = slice(bounds[text], bounds[text + 1])
            places = words.starts[own] - offsets[text], words.ends[own] - offsets[text]
            yield row, places, joined_passages(passages), held, data[offsets[text] : offsets[text + 1]]


def _marked(automaton) -> Callable:
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = list(_documents(automaton, batch))
            found = [[n for pair in passages for n in pair] for _, _, passages, _, _ in done]
            yield pa.record_batch(
                [batch["doc_id"], batch["text"], pa.array(found, pa.list_(pa.int32())),
                 pa.array([held for _, _, _, held, _ in done], pa.list_(pa.string()))],
                ["doc_id", "text", "found", "items"],
            )

    return mark


def _cut(automaton, max_words: int, max_coverage: float) -> Callable:
    passage = pa.list_(pa.struct([("begin", pa.int32()), ("words", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            n_words, n_hit, listed, spans, removed = [], [], [], [], []
            for row, (starts, ends), passages, held, data in _documents(automaton, batch):
                hit = sum(end - begin for begin, end in passages)
                n_words.append(len(starts))
                n_hit.append(hit)
                listed.append(held)
                spans.append([{"begin": b, "words": e - b} for b, e in passages])
                removed.append(hit > max_coverage * len(starts))
                if removed[-1]:
                    texts[row] = ""
                elif passages:
                    at, kept = 0, []
                    for begin, end in passages:
                        if end - begin > max_words:
                            kept.append(data[at : starts[begin]].tobytes())
                            at = ends[end - 1]
                    kept.append(data[at:].tobytes())
                    texts[row] = b"".join(kept).decode()
            yield pa.record_batch(
                [batch["doc_id"], pa.array(texts, pa.string()), pa.array(n_words, pa.int64()),
                 pa.array(n_hit, pa.int64()), pa.array(listed, pa.list_(pa.string())),
                 pa.array(spans, passage), pa.array(removed, pa.bool_())],
                ["doc_id", "text", "n_words", "n_hit", "items", "passages", "removed"],
            )

    return cut
