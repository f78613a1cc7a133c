"""SentencePiece BPE encoding by a table of last tokens per prefix, and decoding.

The encoding of every prefix of a word ends in exactly one token. So the table is filled from left
to right: an automaton finds the pieces that end at a place, and the piece that is compatible with
the last token of the prefix before it is the one. The ids are then read off backwards. A pair of
tokens is compatible if encoding their joined text gives the pair again; that is decided by taking
the merges back on both sides of the seam, without encoding anything.

Merges never cross from a visible character to the space mark that follows it (checked when the
vocabulary is read), nor an unknown character, so a text falls into words that are encoded alone
and kept in a table of bounded size.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_BASE = -1


class PieceTable:
    """The merge rules of a BPE model, and encoding and decoding with them."""

    def __init__(self, model_path: str, kept_words: int = 300_000, kept_pairs: int = 500_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.end_id = model.eos_id()
        self.kept_words, self.kept_pairs = kept_words, kept_pairs
        self.byte_ids = [0] * 256
        self.byte_of: dict[int, int] = {}
        self.silent = set()
        score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.texts = [""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value], self.byte_of[i] = i, value
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.silent.add(i)
            else:
                score[piece], self.ids[piece], self.texts[i] = model.get_score(i), i, piece
        if any(MARK in piece.lstrip(MARK) for piece in score):
            raise ValueError("a piece holds a space mark behind another character")
        self.score = score
        self.ordered = {p: -s for p, s in score.items()}  # smaller: merged earlier
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.uneven: set[str] = set()
        self.automaton = ahocorasick.Automaton()
        for piece in score:
            if len(piece) == 1:
                self.halves[piece] = None
            else:
                parts, halves = self._merged(piece)
                if parts != [piece]:
                    continue  # no text is ever encoded with it
                self.halves[piece] = halves
            self.automaton.add_word(piece, (self.ids[piece], len(piece)))
        self.automaton.make_automaton()
        self._find_uneven()
        self.sizes = [len(text) for text in self.texts]
        self.characters = {piece for piece in self.ids if len(piece) == 1}
        self.pairs: dict[int, bool] = {}
        self.end = array("i", [self.end_id]).tobytes()
        self.words: dict[str, tuple[bytes, str]] = {}
        self.older_words: dict[str, tuple[bytes, str]] = {}

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """BPE by its definition, for short texts: the pieces, and the halves of the last merge."""
        parts: list[str | None] = list(text)
        after = [*range(1, len(parts)), -1]
        before = [-1, *range(len(parts) - 1)]
        queue: list[tuple[float, int, str]] = []

        def offer(left: int, right: int) -> None:
            joined = parts[left] + parts[right]
            if joined in self.ordered:
                heapq.heappush(queue, (self.ordered[joined], left, joined))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        halves = None
        while queue:
            _, left, joined = heapq.heappop(queue)
            right = after[left] if parts[left] is not None else -1
            if right < 0 or parts[left] + parts[right] != joined:
                continue
            halves = parts[left], parts[right]
            parts[left], parts[right] = joined, None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
                offer(left, after[right])
            if before[left] >= 0:
                offer(before[left], left)
        return [p for p in parts if p is not None], halves

    def _rank(self, piece: str) -> float:
        return _BASE if self.halves[piece] is None else self.ordered[piece]

    def _find_uneven(self) -> None:
        """Pieces whose merges do not come in the order of their ranks, or share a rank."""
        seen: dict[float, str] = {}
        for piece, halves in self.halves.items():
            if halves is None:
                continue
            rank = self.ordered[piece]
            if rank in seen:
                self.uneven |= {piece, seen[rank]}
            seen[rank] = piece
        for piece in sorted(self.halves, key=len):
            halves = self.halves[piece]
            if halves and any(
                h not in self.halves or h in self.uneven or self._rank(h) >= self._rank(piece)
                for h in halves
            ):
                self.uneven.add(piece)

    def compatible(self, a: str, b: str) -> bool:
        """Whether the joined text of two tokens is encoded as these two."""
        if a in self.uneven or b in self.uneven:
            return self._merged(a + b)[0] == [a, b]
        ordered, halves = self.ordered, self.halves
        until, left_side = float("inf"), True  # the merge that ends what stands at the seam
        while True:
            rank = ordered.get(a + b)
            # Equal ranks are the same piece twice: the one further left is merged first.
            if rank is not None and (rank < until or rank == until and not left_side):
                return False
            rank_a, rank_b = self._rank(a), self._rank(b)
            if rank_a == _BASE and rank_b == _BASE:
                return True
            if rank_a > rank_b:
                until, left_side, a = rank_a, True, halves[a][1]
            else:
                until, left_side, b = rank_b, False, halves[b][0]

    def _known(self, word: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        last, pairs = [-1] * (len(word) + 1), self.pairs
        done = -1  # places up to here have their token
        for end, (piece, size) in self.automaton.iter(word):
            if end == done:
                continue
            if size <= end:
                pair = last[end - size] << 32 | piece
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= self.kept_pairs:
                        pairs.clear()
                    fits = pairs[pair] = self.compatible(
                        self.texts[pair >> 32], self.texts[piece]
                    )
                if not fits:
                    continue
            last[end], done = piece, end
        ids, at, sizes = [], len(word) - 1, self.sizes
        while at >= 0:
            ids.append(last[at])
            at -= sizes[last[at]]
        ids.reverse()
        return ids

    def word_ids(self, word: str) -> list[int]:
        """Ids of a word, space marks included; characters without a piece become bytes."""
        if self.characters.issuperset(word):
            return self._known(word)
        ids: list[int] = []
        start = 0
        for i, char in enumerate(word):
            if char not in self.characters:
                if start < i:
                    ids += self._known(word[start:i])
                ids += [self.byte_ids[b] for b in char.encode()]
                start = i + 1
        return ids + self._known(word[start:]) if start < len(word) else ids

    def _words(self, text: str) -> list[str]:
        """The words of a text with their space marks; no words for an empty text."""
        if not text:
            return []
        text = MARK + text.replace(" ", MARK)
        if MARK + MARK in text or text.endswith(MARK):
            return re.findall(f"{MARK}+[^{MARK}]*", text)
        return [MARK + word for word in text[1:].split(MARK)]

    def encode(self, text: str) -> list[int]:
        """The ids as the library gives them with an end id."""
        return np.frombuffer(self.encode_and_decode(text)[0], np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes in a row are read as UTF-8, the first space mark goes."""
        return self._surface(ids).removeprefix(" ")

    def _surface(self, ids: list[int]) -> str:
        if self.byte_of.keys().isdisjoint(ids) and self.silent.isdisjoint(ids):
            return "".join([self.texts[i] for i in ids]).replace(MARK, " ")
        parts, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                parts.append(raw.decode("utf-8", "replace"))
                raw.clear()
            if i not in self.silent:
                parts.append(self.texts[i])
        if raw:
            parts.append(raw.decode("utf-8", "replace"))
        return "".join(parts).replace(MARK, " ")

    def _kept(self, word: str) -> tuple[bytes, str]:
        """Ids, as bytes of 32-bit integers, and their text, from the table of frequent words."""
        found = self.older_words.get(word)
        if found is None:
            ids = self.word_ids(word)
            found = array("i", ids).tobytes(), self._surface(ids)
        if len(word) <= 64:
            if len(self.words) >= self.kept_words:
                self.older_words = self.words.copy()
                self.words.clear()
            self.words[word] = found
        return found

    def _parts(self, text: str) -> list[str]:
        """Words, parted further at line feeds if these have no piece and so are never merged."""
        if "\n" in self.characters or text.startswith(" ") or "  " in text or MARK in text:
            return self._words(text)
        spaced = MARK + text.replace(" ", " " + MARK).replace("\n", " \n ") if text else ""
        return spaced.split(" ")

    def encode_and_decode(self, text: str) -> tuple[bytes, str]:
        """The ids with an end id, as bytes of 32-bit integers, and the text they stand for.

        A word's ids are decoded when the word is met first. No character's bytes are parted by the
        end of a word, so the words' texts make up the text of all ids.
        """
        get, keep = self.words.get, self._kept
        found = [get(word) or keep(word) for word in self._parts(text) if word]
        ids = b"".join([*(packed for packed, _ in found), self.end])
        return ids, "".join([surface for _, surface in found]).removeprefix(" ")


@lru_cache(2)
def piece_table(model_path: str) -> PieceTable:
    """One table per worker process."""
    return PieceTable(model_path)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, ids, decoded`` of every whole text: the ids with an end id, and the text they give.

    Null and empty texts have the end id alone and decode to an empty text. One row per input row;
    repeated ids, a null id and other columns make no difference. An empty table gives no rows.
    ``model_path`` is opened on the executors, which all need the file there.
    """

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = piece_table(model_path)
        for part in parts:
            found = [table.encode_and_decode(text.as_py() or "") for text in part]
            sizes = [len(ids) // 4 for ids, _ in found]
            numbers = np.frombuffer(b"".join([ids for ids, _ in found]), np.int32)
            offsets = np.cumsum([0, *sizes], dtype=np.int32)
            yield pa.StructArray.from_arrays(
                [
                    pa.ListArray.from_arrays(offsets, pa.array(numbers)),
                    pa.array([text for _, text in found], pa.string()),
                ],
                ["ids", "decoded"],
            )

    return docs.select("doc_id", run("text").alias("_encoded")).select("doc_id", "_encoded.*")
