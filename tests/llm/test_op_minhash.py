import random

import numpy as np
import pyarrow as pa
import pytest
from corpus_cases import documents, edited_copies, near_duplicate_groups, odd_texts, shingle_set

from skyloom.llm import minhash, shingles
from skyloom.llm.common import components
from skyloom.llm.queries import QUERIES


def answers(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def check(spark, rows):
    found = answers(minhash.near_duplicates(documents(spark, rows)))
    wanted = near_duplicate_groups([r[:2] for r in rows if r[0] is not None])
    assert {k: r["component_id"] for k, r in found.items()} == wanted
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.values())


def test_odd_texts(spark):
    rows = odd_texts()
    df = minhash.near_duplicates(documents(spark, rows))
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert df.count() == len(rows)
    sizes = {r["doc_id"]: r["n_shingles"] for r in df.collect() if r["doc_id"] is not None}
    assert sizes == {i: len(shingle_set(t)) for i, t in rows if i is not None}
    nobody = [r for r in df.collect() if r["doc_id"] is None]
    assert [(r["component_id"], r["kept"]) for r in nobody] == [(None, None)] * 2
    check(spark, rows)


def test_families_around_the_threshold(spark):
    texts = edited_copies(60, share=0.1) + edited_copies(60, seed=1, share=0.06)
    texts += [f"unlike {i} " + " ".join(f"u{i}v{j}" for j in range(30)) for i in range(30)]
    random.Random(3).shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    check(spark, list(enumerate(edited_copies(50, words=40, share=0.3))))


def test_large_components_meet_other_blocks_only(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    sizes = {("b", 1): 40, ("b", 50): 3, ("b", 60): 2, ("b", 70): 9, ("d", 1): 6, ("d", 9): 5}
    rows = [(bucket, component) for (bucket, component), n in sizes.items() for _ in range(n)]
    found = minhash._chunks(spark.createDataFrame(rows, "bucket string, component long")).collect()
    # Shared chunks first, then those of each large component.
    assert sorted(map(tuple, found)) == [
        ("b", 1, True, 2, 10, 15), ("b", 50, False, 0, 2, 15), ("b", 60, False, 0, 2, 15),
        ("b", 70, True, 12, 3, 15), ("d", 1, True, 0, 2, 4), ("d", 9, True, 2, 2, 4),
    ]


@pytest.mark.parametrize("block", [2, 3, 8])
def test_strangers_in_the_bucket_of_a_large_group(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    # Groups that share most of their shingles: buckets hold several large components and strangers.
    base = edited_copies(1, words=60)[0].split()
    texts = []
    for group, size in enumerate([30, 20, 1, 1, 2]):
        own = base[:50] + [f"g{group}w{i}" for i in range(15)]
        texts += [" ".join(own + [f"tail{group}x{i}"]) for i in range(size)]
    random.Random(block).shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_an_id_with_several_texts_links_through_any(spark):
    a, b = edited_copies(1)[0], edited_copies(1, seed=9)[0]
    found = answers(minhash.near_duplicates(documents(spark, [(1, a), (5, a), (5, b), (7, b)])))
    assert {k: r["component_id"] for k, r in found.items()} == {1: 1, 5: 1, 7: 1}


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_ids_with_differing_texts_in_divided_buckets(spark, monkeypatch, seed):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rng = random.Random(seed)
    shared = " ".join(f"s{i}" for i in range(200))
    rows = [(i, f"{shared} " + " ".join(f"o{i}x{j}" for j in range(60))) for i in range(5)]
    texts = edited_copies(40, words=40, seed=seed, share=0.3)
    rows += [(i, rng.choice(texts)) for i in range(5)]
    rows += [(10 + i // 2, text) for i, text in enumerate(texts)] + rows[:3]
    rng.shuffle(rows)
    check(spark, rows)


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_sets_equal_brute_force():
    rng = random.Random(2)
    texts = [t for _, t in odd_texts()] + [
        "".join(rng.choice(["ab ", "Ab ", "c\n", "é ", "\x0bq ", " "]) for _ in range(k))
        for k in range(60)
    ]
    sets = []
    for _, data, offsets in shingles.text_blocks(pa.array(texts)):
        found, starts = shingles.shingle_sets(data, offsets)
        sets += [set(found[a:b].tolist()) for a, b in zip(starts[:-1], starts[1:])]
    exact = [shingle_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in exact]
    for i in range(0, len(sets), 5):
        for j in range(len(sets)):
            assert len(sets[i] & sets[j]) == len(exact[i] & exact[j])


@pytest.mark.parametrize("size", [1, 3, 40, 5000])
def test_sketches_fill_and_estimate(size):
    rng = np.random.default_rng(size)
    base = rng.integers(0, 2**63, size=2 * size, dtype=np.uint64)
    first, second = np.sort(base[: int(1.5 * size) or 1]), np.sort(base[size // 2 :])
    both = np.concatenate([first, second])
    values = shingles.sketches(both, np.array([0, len(first), len(both)]), 128)
    assert (values < np.iinfo(np.uint64).max).all()
    common = len(np.intersect1d(first, second))
    similarity = common / (len(first) + len(second) - common)
    assert abs((values[0] == values[1]).mean() - similarity) < 0.2
    alone = shingles.sketches(first, np.array([0, len(first)]), 128)
    assert (alone[0] == values[0]).all()


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(60)]  # a long path
    edges += [(2000, 2001 + i) for i in range(50)] + [(5, 5)]  # a hub, a loop
    from corpus_cases import smallest_reachable

    wanted = smallest_reachable({n for e in edges for n in e if e[0] != e[1]}, edges)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == wanted
    assert len(found) == len(wanted)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = answers(QUERIES["op1_near_dedup"](spark, sf_dir))
    wanted = near_duplicate_groups([tuple(r) for r in docs])
    assert {k: r["component_id"] for k, r in found.items()} == wanted
