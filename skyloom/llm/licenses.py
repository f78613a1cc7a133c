"""Licence texts found by patience alignment.

A text can cover enough of a template only if it holds enough of its words, which rules nearly all
out. Of the template's words, so many are taken as anchors, rarest in the text first, that a
covering passage must hold one; each of their places proposes a window. In a window, words that occur
once there and once in the template are matched, the longest increasing subsequence of the matches
is kept, and the gaps between them are aligned the same way. Gaps without such words are aligned by
their common ends and their longest common subsequence, which piles up the places of equal words.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from skyloom.llm.license_texts import TEMPLATES

_WORD = regex.compile(r"[\p{L}\p{N}]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def increasing(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence, of pairs in order of the first number, that grows in the second."""
    tops: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for i, (_, place) in enumerate(pairs):
        pile = bisect_left(tops, place)
        before.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(place)
            ends.append(i)
        else:
            tops[pile], ends[pile] = place, i
    chain, i = [], ends[-1] if ends else -1
    while i >= 0:
        chain.append(pairs[i])
        i = before[i]
    return chain[::-1]


def _common_subsequence(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    tops: list[int] = []
    ends: list[tuple] = []  # place in a, place in b and the pair before, of each pile's last pair
    for i, word in enumerate(a):
        for j in places.get(word, ()):  # falling, so a place of a is used once
            pile = bisect_left(tops, j)
            pair = (i, j, ends[pile - 1] if pile else None)
            if pile == len(tops):
                tops.append(j)
                ends.append(pair)
            else:
                tops[pile], ends[pile] = j, pair
    pairs, pair = [], ends[-1] if ends else None
    while pair:
        pairs.append(pair[:2])
        pair = pair[2]
    return pairs[::-1]


def align(a: Sequence[str], b: Sequence[str]) -> list[tuple[int, int]]:
    """Pairs of places of equal words, growing on both sides, by patience alignment."""
    pairs: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        left, right = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if right[w] == 1}
        unique = [(i, place[a[i]]) for i in range(a0, a1) if left[a[i]] == 1 and a[i] in place]
        if unique:
            chain = increasing(unique)
            pairs += chain
            for (i, j), (p, q) in zip([(a0 - 1, b0 - 1), *chain], [*chain, (a1, b1)]):
                work.append((i + 1, p, j + 1, q))
        else:
            found = _common_subsequence(a[a0:a1], b[b0:b1])
            pairs += [(a0 + i, b0 + j) for i, j in found]
    return sorted(pairs)


class Scanner:
    """The templates, ready to be looked for in texts."""

    def __init__(self, templates: Mapping[str, str], min_coverage: float):
        self.min_coverage = min_coverage
        self.templates = {name: words_of(text) for name, text in sorted(templates.items())}
        self.counts = {name: Counter(words) for name, words in self.templates.items()}
        self.vocabulary = frozenset(w for words in self.templates.values() for w in words)

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """Licence, coverage, first and last character of the passages found, in order."""
        words = words_of(text)
        present = self.vocabulary.intersection(words)
        if not present:
            return []
        able = [
            name
            for name, counts in self.counts.items()
            if sum(n for w, n in counts.items() if w in present) >= self._needed(name)
        ]
        if not able:
            return []
        places: dict[str, list[int]] = {w: [] for w in present}
        for i, word in enumerate(words):
            if word in present:
                places[word].append(i)
        found = [match for name in able for match in self._matches(name, words, places)]
        found.sort(key=lambda m: (-m[1], -m[4], m[2], m[0]))
        chosen: list[tuple[str, float, int, int]] = []
        taken: list[tuple[int, int]] = []  # disjoint, in order
        for match in found:
            at = bisect_left(taken, (match[2], match[3]))
            if at and taken[at - 1][1] >= match[2] or at < len(taken) and taken[at][0] <= match[3]:
                continue
            taken.insert(at, (match[2], match[3]))
            chosen.append(match[:4])
        spans = [m.span() for m in _WORD.finditer(text.lower())]
        shift = _original_places(text)
        return sorted(
            ((n, c, shift(spans[a][0]), shift(spans[b][1])) for n, c, a, b in chosen),
            key=lambda m: m[2:],
        )

    def _needed(self, name: str) -> float:
        return self.min_coverage * len(self.templates[name]) - 1e-9

    def _matches(
        self, name: str, words: list[str], places: dict[str, list[int]]
    ) -> Iterator[tuple[str, float, int, int, int]]:
        """Licence, coverage, first and last word, number of words matched."""
        template, counts = self.templates[name], self.counts[name]
        size, slack = len(template), len(template) // 4 + 2
        spare = size - self._needed(name)
        anchors = []
        for word in sorted(counts, key=lambda w: (len(places.get(w, ())), w)):
            if spare < 0:
                break
            anchors.append(word)
            spare -= counts[word]
        starts: dict[int, int] = {}  # with the last place of a word that proposes it
        for word in anchors:
            shifts = [i for i, w in enumerate(template) if w == word]
            for place in places.get(word, ()):
                for t in shifts:
                    start = max(place - t, 0)
                    starts[start] = max(starts.get(start, 0), place)
        done = tried = -1
        for start, place in sorted(starts.items()):
            start = max(start, done + 1)
            if place <= done or start == tried:
                continue
            tried = start
            begin = max(start - slack, done + 1, 0)
            window = words[begin : start + size + slack]
            pairs = align(template, window)
            if len(pairs) >= self._needed(name):
                first, last = begin + pairs[0][1], begin + pairs[-1][1]
                yield name, len(pairs) / size, first, last, len(pairs)
                done = last


def _original_places(text: str):
    """Places in the lower-cased text as places in the text (lower case can be longer)."""
    if len(text.lower()) == len(text):
        return lambda place: place
    ends, total = [], 0
    for char in text:
        total += len(char.lower())
        ends.append(total)
    return lambda place: bisect_left(ends, place + 1) if place < total else len(text)


def license_passages(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, min_coverage: float = 0.85
) -> DataFrame:
    """``doc_id, license_id, coverage, start_char, end_char, passage`` for every passage found.

    A passage is found if patience alignment matches at least ``min_coverage`` of a template's words
    (letters and digits, in lower case) in it. Of overlapping passages the one with the larger
    coverage stays, then with more words matched, the earlier, the first by name; a template can be found many
    times in a text. Texts are read whole, at any length.

    Null and empty texts have no passages, nor has any text without templates. Rows with a null or
    repeated ``doc_id`` are rows like others. Other columns are left out. An empty table gives none.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, min_coverage)
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch["text"]):
                text = text.as_py() or ""
                for match in scanner.scan(text):
                    rows.append(i)
                    found.append((*match, text[match[2] : match[3]]))
            names, coverage, starts, ends, passages = zip(*found) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(rows, pa.int64())),
                    pa.array(names, pa.string()),
                    pa.array(coverage, pa.float64()),
                    pa.array(starts, pa.int64()),
                    pa.array(ends, pa.int64()),
                    pa.array(passages, pa.string()),
                ],
                ["doc_id", "license_id", "coverage", "start_char", "end_char", "passage"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        scan,
        f"doc_id {kind}, license_id string, coverage double, start_char long, end_char long,"
        " passage string",
    )
