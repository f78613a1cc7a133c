import random
import re

import pytest
from corpus_cases import documents, odd_texts

from skyloom.llm import decontaminate
from skyloom.llm.queries import ORACLE_SQL, QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def items_table(spark, items):
    return spark.createDataFrame(
        [(i, t, "clash", "clash") for i, t in items],
        "item_id long, text string, words string, deal string",
    )


def brute(rows, items, window=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    result = []
    for doc_id, text in rows:
        words, hit, held = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    held |= found
        result.append((doc_id, len(words), len(hit), sorted(str(i) for i in held if i is not None), sorted(hit)))
    return result


def check(spark, rows, items, window=10, **options):
    done = decontaminate.decontaminate(
        documents(spark, rows), items_table(spark, items), window=window, **options
    ).collect()
    wanted = brute(rows, items, window)
    mine = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"],
             [w for p in r["passages"] for w in range(p["begin"], p["begin"] + p["words"])]) for r in done]
    assert sorted(map(str, mine)) == sorted(map(str, wanted))
    return done


def passages(seed, alphabet=6, items=30, docs=60, window=10):
    """Items and documents over few words, so that windows overlap, repeat and are shared."""
    rng = random.Random(seed)
    letters = [f"W{i}é" for i in range(alphabet)]
    text = lambda n: ", ".join(rng.choices(letters, k=n))
    held = [(i // 2 if i % 5 == 0 else i, text(rng.randrange(1, 40))) for i in range(items)]
    rows = []
    for i in range(docs):
        own = words_of(rng.choice(held)[1])
        at = rng.randrange(len(own))
        rows.append((i, f"{text(rng.randrange(30))}. {' '.join(own[at : at + rng.randrange(1, 30)])} {text(5)}"))
    return rows, held


@pytest.mark.parametrize("seed, alphabet, window", [(0, 2, 10), (1, 3, 4), (2, 8, 3), (3, 40, 10), (4, 1, 5)])
def test_against_brute_force(spark, seed, alphabet, window):
    rows, items = passages(seed, alphabet)
    check(spark, rows, items, window)


@pytest.mark.parametrize("window", [1, 2, 10])
def test_several_automata(spark, window):
    rows, items = passages(7, 4)
    items.append((500, " ".join(words_of(rows[3][1]) * 20)))  # cut into pieces
    check(spark, rows, items, window, part_words=120)


def test_long_items_only(spark):
    rows, items = passages(9, 30)
    items = [(i, f"{t} {t}") for i, t in items if len(words_of(t)) >= 10]
    check(spark, rows, items)


def test_odd_rows_and_items(spark):
    rows = odd_texts()
    items = [(1, None), (2, ""), (3, " ,;"), (4, "ONE"), (None, "a b c d e f g h i j"), (5, "日本語"),
             (6, rows[7][1][5000:6000]), (6, "other words stand here"), (7, "x\x00y")]
    done = {r["doc_id"]: r for r in check(spark, rows, items)}
    assert done[1]["text"] is None and done[2]["text"] == "" and not done[1]["removed"]
    assert done[4]["text"] == "" and done[4]["removed"]


def test_without_items_or_documents(spark):
    check(spark, odd_texts(), [])
    check(spark, odd_texts(), [(1, None)])
    check(spark, [], [(1, "some words")])


def test_cut_texts(spark):
    passage = "This Very Passage, of the BENCHMARK, has eleven words: 7, 8!"
    rows = [(1, f"Before — {passage} and after it, there are twelve more words in here, one two."),
            (2, passage), (3, "nothing of it é"), (4, f"a b c d {passage} e f {passage} g h i j k l m n o p q r")]
    found = decontaminate.decontaminate(documents(spark, rows), items_table(spark, [(1, passage)]))
    found = {r["doc_id"]: r for r in found.collect()}
    assert found[1]["text"] == "Before — ! and after it, there are twelve more words in here, one two."
    assert (found[2]["text"], found[2]["removed"]) == ("", True)
    assert found[3]["text"] == rows[2][1]
    assert found[4]["removed"]
    lenient = decontaminate.decontaminate(
        documents(spark, rows), items_table(spark, [(1, passage)]), max_words=11, max_coverage=1
    )
    assert sorted((r["doc_id"], r["text"]) for r in lenient.collect()) == rows


def test_query_against_sql(spark):
    from check_oracle import difference, duckdb_connection

    sf_dir = "/root/testdata/sf0.001"
    mine = QUERIES["op13_decontamination"](spark, sf_dir).toArrow()
    theirs = duckdb_connection(sf_dir).execute(ORACLE_SQL["op13_decontamination"]).to_arrow_table()
    assert difference(mine, theirs) == ""
