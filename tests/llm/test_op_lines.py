import hashlib

import pytest
from corpus_cases import deduplicated_lines, documents, odd_texts

from skyloom.llm import lines
from skyloom.llm.queries import QUERIES


def check(spark, rows, **options):
    df = lines.dedup_lines(documents(spark, rows), **options)
    found = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()]
    def order(row):
        return row[0] is not None, row[0] or 0, row[1]

    assert sorted(found, key=order) == sorted(deduplicated_lines(rows), key=order)


def test_odd_texts(spark):
    check(spark, odd_texts())
    df = lines.dedup_lines(documents(spark, odd_texts()))
    assert set(df.columns) == set(documents(spark, []).columns)
    assert {r["key"] for r in df.collect()} == {"clash"}


@pytest.mark.parametrize("batches, fanout", [(1, 2), (2, 2), (5, 2), (7, 3)])
def test_batches_and_levels_do_not_matter(spark, batches, fanout):
    rows = []
    for i in range(40):
        own = [f"a line of document number {i} alone", "short"]
        own += [f"line shared by every {k}th document of all" for k in range(2, 14) if i % k == 0]
        rows.append((i, "\n".join(own)))
    check(spark, rows, batches=batches, fanout=fanout)


def test_levels(spark):
    runs = lines.LineRuns(min_docs=3, fanout=2)
    for batch in range(5):
        rows = [(f"key{k}".encode(), 100 - batch) for k in range(batch, 4)]
        runs.add(spark.createDataFrame(rows, "key binary, doc long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    settled = {bytes(r["key"]): r["last_doc"] for r in runs.settled().collect()}
    assert settled == {b"key2": 100, b"key3": 100}


def test_many_rows_of_one_id(spark):
    """A third of the rows without an id, a third with the same one."""
    rows = []
    for i in range(60):
        text = "\n".join([f"a line of row number {i} alone, quite long"] + [
            f"line that is in every {k}th row of the table" for k in range(1, 12) if i % k == 0])
        rows.append((None if i % 3 == 0 else 7 if i % 3 == 1 else i, text))
    check(spark, rows + rows[:9])
    lists = lines.repeated_lines(documents(spark, rows).select("doc_id", "text")).collect()
    assert len(lists) > 30 and max(len(r["keys"]) for r in lists) <= 11


def test_empty_table(spark):
    assert lines.dedup_lines(documents(spark, [])).count() == 0


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: tuple(r) for r in QUERIES["op7_line_dedup"](spark, sf_dir).collect()}
    for doc_id, kept, count, dropped in deduplicated_lines([tuple(r) for r in docs]):
        digest = hashlib.sha256(kept.encode()).hexdigest()
        assert found[doc_id] == (doc_id, count, dropped, digest)
