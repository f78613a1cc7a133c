import hashlib

import public_tokenizers
import sentencepiece
from corpus_cases import documents, odd_texts
from hypothesis import given, settings
from hypothesis import strategies as st

from skyloom.llm import pieces
from skyloom.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TABLE = pieces.piece_table(PATH)
BITS = ["a", "the", "ing", " ", "  ", "▁", "\n", "é", "日", "😀", "<s>", "<0x0A>", "\t", "0", "%%%",
        "\x00", "ﬁ", "er", "st", " th", "​"]


def digest(text):
    ids = LIBRARY.encode(text or "", add_eos=True)
    decoded = LIBRARY.decode(ids)
    return (
        len(ids),
        hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(decoded.encode()).hexdigest(),
    )


def same_as_library(text):
    ids = LIBRARY.encode(text, add_eos=True)
    assert TABLE.encode(text) == ids
    assert TABLE.decode(ids) == TABLE.encode_and_decode(text)[1] == LIBRARY.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=25).map("".join))
def test_mixed_bits(text):
    same_as_library(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=50))
def test_any_text(text):
    same_as_library(text)


def test_long_words():
    same_as_library("abracadabra" * 500)
    same_as_library(" " * 1000 + "x")


def test_all_pairs_of_pieces_agree_with_merging():
    names = sorted(TABLE.halves, key=lambda p: TABLE.ids[p])[300:420]
    for a in names:
        for b in names[::7]:
            assert TABLE.compatible(a, b) == (TABLE._merged(a + b)[0] == [a, b])


def test_tables_stay_bounded():
    small = pieces.PieceTable(PATH, kept_words=50, kept_pairs=100)
    for i in range(300):
        text = f"words{i} number{i * 7} of text{i}"
        assert small.encode(text) == LIBRARY.encode(text, add_eos=True)
        assert len(small.words) <= 50 and len(small.pairs) <= 100


def test_odd_texts(spark):
    rows = odd_texts()
    found = pieces.encode(documents(spark, rows), PATH).collect()
    ids = [LIBRARY.encode(t or "", add_eos=True) for _, t in rows]
    wanted = [(i, own, LIBRARY.decode(own)) for (i, _), own in zip(rows, ids)]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))


def test_empty_table(spark):
    assert pieces.encode(documents(spark, []), PATH).count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op9_piece_encoding"](spark, sf_dir).collect()}
    assert found == {r["doc_id"]: digest(r["text"]) for r in docs}
