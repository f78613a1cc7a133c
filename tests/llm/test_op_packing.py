import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from corpus_cases import documents, odd_texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyloom.llm import packing
from skyloom.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check(pieces, texts):
    """Round trip: the pieces of every document put together, and sequences without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    assert set(by_doc) == set(texts)
    for doc_id, own in by_doc.items():
        ids, at = [], 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at
            at += p["length"]
            ids += np.frombuffer(p["ids"], "<u4").tolist()
        assert ids == ids_of(texts[doc_id])
        assert {p["doc_tokens"] for p in own} == {len(ids)}
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    sizes = [sum(length for _, length in own) for own in by_sequence.values()]
    padding = sum(0 if n & (n - 1) == 0 else 1024 - n for n in sizes)
    return padding, sum(sizes)


def test_odd_texts(spark):
    rows = {}
    for i, (_, text) in enumerate(odd_texts()):
        rows[i] = text
    df = packing.pack(documents(spark, list(rows.items())), PATH)
    check(df.collect(), rows)


def test_repeated_and_null_ids(spark):
    found = packing.pack(documents(spark, [(1, "a b"), (1, "a b"), (None, None)]), PATH).collect()
    assert sorted((p["doc_id"] or 0, p["length"]) for p in found) == [(0, 1), (1, 3), (1, 3)]


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_query_round_trip_and_little_padding(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    texts = {r["doc_id"]: r["text"] for r in docs}
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = packing.pack(frame, PATH).collect()
    padding, total = check(pieces, texts)
    assert padding < 0.02 * total
    found = QUERIES["op5_packing"](spark, sf_dir).collect()
    wanted = {(p["doc_id"], p["start"]): zlib.crc32(p["ids"]) for p in pieces}
    assert {(r["doc_id"], r["start"]): r["ids_crc32"] for r in found} == wanted


def test_cuts_are_the_best_ones():
    rng = random.Random(4)
    for _ in range(150):
        places = np.cumsum([rng.randint(1, 90) for _ in range(rng.randint(1, 25))]).tolist()
        penalties = [rng.choice([0.0, 2.0, 24.0]) for _ in places]
        window = rng.choice([90, 100, 128, 200, 256])
        cuts = packing.best_cuts(places, penalties, window)

        def cost(cuts):
            total, last, at = 0.0, 0, dict(zip(places, penalties))
            for cut in cuts:
                size = cut - last
                if size > window:
                    return float("inf")
                free = size < window and size >= 64 and size & (size - 1) == 0
                total += 0 if free else window - size
                total += at[cut] + packing.ONE_MORE_WINDOW
                last = cut
            return total

        best = {0: 0.0}
        for j, p in enumerate(places):
            best[p] = min(
                best[s] + cost_of(p - s, window) + penalties[j] + packing.ONE_MORE_WINDOW
                for s in best
                if p - s <= window
            )
        assert cuts[-1] == places[-1]
        assert abs(cost(cuts) - best[places[-1]]) < 1e-6


def cost_of(size, window):
    return 0 if 64 <= size < window and size & (size - 1) == 0 else window - size


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_those_of_tokenizers(text):
    assert packing.byte_bpe(PATH).encode(text).tolist() == ids_of(text)[:-1]


def test_special_strings_and_long_runs():
    bpe = packing.byte_bpe(PATH)
    for text in ("a<|endoftext|>b", "<|endoftext|>", " " * 1_500_000, "x" * 50_000):
        assert bpe.encode(text).tolist() == ids_of(text)[:-1]


def test_segments_do_not_change_ids(monkeypatch):
    text = " ".join(f"word{i} or  and\n" for i in range(4000))
    whole = packing.byte_bpe(PATH).encode(text).tolist()
    monkeypatch.setattr(packing, "SEGMENT", 100)
    assert len(packing.segments(text)) > 10
    assert packing.byte_bpe(PATH).encode(text).tolist() == whole
