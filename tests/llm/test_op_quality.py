import numpy as np
from corpus_cases import documents, held_out, odd_texts

from skyloom.llm import ngrams, quality
from skyloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_accuracy_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    found = {r["doc_id"]: r for r in QUERIES["op2_quality"](spark, SF_DIR).collect()}
    assert len(found) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r["held_out"] == held_out(i) for i, r in found.items())
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in found.values())
    own = [r for r in labels if held_out(r["doc_id"])]
    good = [r for r in own if r["quality"] == 1]
    poor = [r for r in own if r["quality"] == 0]
    assert sum(found[r["doc_id"]]["predicted"] for r in good) >= 0.98 * len(good)
    assert sum(found[r["doc_id"]]["predicted"] for r in poor) <= 0.1 * len(poor)


def sample():
    clean = [(i, f"This is the clean text number {i}, which says something new {i * 7}.") for i in range(40)]
    junk = [(100 + i, "BUY!! NOW!! " * (10 + i)) for i in range(40)]
    return clean, junk


def test_odd_texts(spark):
    clean, junk = sample()
    rows = clean + junk + [(1000 + i, t) for i, (_, t) in enumerate(odd_texts())] + [(None, "x"), (5, "y")]
    labels = [(i, 1, "x") for i, _ in clean] + [(i, 0, "x") for i, _ in junk]
    labels += [(None, 1, None), (3, None, None), (4, 7, None), (5, 1, None)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, score string")
    found = quality.rate(documents(spark, rows), labels).collect()
    assert len(found) == len(rows)
    assert all(0 <= r["score"] <= 1 for r in found)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["predicted"] == 0 for i, _ in junk)
    assert sum(by_id[i]["predicted"] for i, _ in clean) >= 38
    kept = quality.keep_good(documents(spark, rows), labels)
    assert kept.columns == documents(spark, []).columns
    assert kept.count() == sum(r["predicted"] for r in found)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.rate(documents(spark, [(1, "a")]), none).collect()] == [1.0]
    assert quality.rate(documents(spark, []), none).count() == 0
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.rate(documents(spark, []), labels).count() == 0


def test_votes_against_a_loop():
    rng = np.random.default_rng(0)
    vectors = ngrams.unit_rows(rng.standard_normal((200, 10)))
    labels, weights = rng.integers(0, 2, 200), rng.random(200)
    model = quality.Neighbours(None, None, vectors, labels, weights)
    rows = ngrams.unit_rows(rng.standard_normal((20, 10)))
    for row, vote in zip(rows, quality.votes(rows, model)):
        near = sorted(range(200), key=lambda i: -(row @ vectors[i]))[: quality.NEIGHBOURS]
        power = [max(row @ vectors[i], 0) ** quality.SHARPNESS * weights[i] for i in near]
        wanted = sum(p * labels[i] for p, i in zip(power, near)) / sum(power)
        assert abs(vote - wanted) < 1e-9


def test_counts_stay_within_texts():
    data = np.frombuffer(b"abcdxy", np.uint8)
    counts = ngrams.ngram_counts(data, np.array([0, 0, 1, 4, 4, 4, 6]), (1, 2, 3), 256)
    assert counts.sum(axis=1).tolist() == [0, 1, 6, 0, 0, 3]
    alone = ngrams.ngram_counts(data[1:4], np.array([0, 3]), (1, 2, 3), 256)
    assert (counts[2] == alone[0]).all()


def test_repeated_ids_score_alike_for_any_partitioning(spark):
    clean, junk = sample()
    rows = clean + junk + [(i, f"{t} BUY!! now {i}") for i, t in clean[:20]] + [(500, "This is the clean text BUY!!")]
    rows += [(i, text[::-1]) for i, text in junk[:20]]
    labels = spark.createDataFrame(
        [(i, 1) for i, _ in clean] + [(i, 0) for i, _ in junk], "doc_id long, quality int"
    )
    found = []
    for parts in (1, 3, 7):
        done = quality.rate(documents(spark, rows).repartition(parts), labels).collect()
        found.append(sorted((r["doc_id"], round(r["score"], 5)) for r in done))
    assert found[0] == found[1] == found[2]


def test_scores_against_brute_force(spark):
    """The whole score again with dense numpy: n-gram counts, TF-IDF, singular vectors and votes."""
    clean, junk = sample()
    rows = clean + junk + [(200 + i, f"{clean[i][1]} {junk[i][1][: 9 * i]}") for i in range(20)]
    labels = {i: 1 for i, _ in clean} | {i: 0 for i, _ in junk}
    table = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    found = {r["doc_id"]: r["score"] for r in quality.rate(documents(spark, rows), table).collect()}

    def grams(data, sizes, buckets):
        counts = np.zeros(buckets)
        shift = 32 - buckets.bit_length() + 1
        for n in sizes:
            for i in range(len(data) - n + 1):
                code = 0
                for byte in data[i : i + n]:
                    code = (code * 0x01000193 + byte) % 2**32
                counts[(code + n) * 0x9E3779B1 % 2**32 >> shift] += 1
        return counts

    def repeated(text):
        words = text.lower().split()
        again = sum(a == b for a, b in zip(words, words[1:])) / len(words)
        marks = np.zeros(2 * quality.STEPS)
        for k, share in enumerate((again, len(set(words)) / len(words))):
            marks[k * quality.STEPS + min(int(share * quality.STEPS), quality.STEPS - 1)] = 0.5**0.5
        return marks

    def unit(v):
        return v / (np.linalg.norm(v) or 1)

    letters = [grams(ngrams.LETTERS[list(t.encode())].tolist(), (3,), quality.LETTERS) for _, t in rows]
    shapes = [grams(ngrams.SHAPES[list(t.encode())].tolist(), (1, 3), quality.SHAPES) for _, t in rows]
    idf = [np.log((1 + len(rows)) / (1 + sum(c > 0 for c in counts))) + 1 for counts in (letters, shapes)]
    vectors = np.array([
        unit(np.concatenate([
            0.5 * unit(np.log1p(a) * idf[0]), unit(np.log1p(b) * idf[1]), 0.5 * repeated(t)
        ]))
        for a, b, (_, t) in zip(letters, shapes, rows)
    ])
    learn = [k for k, (i, _) in enumerate(rows) if i in labels and not held_out(i)]
    axes = np.linalg.svd(vectors[learn])[2][: quality.LATENT].T
    near = [(unit(vectors[k] @ axes), labels[rows[k][0]]) for k in learn]
    share = [sum(label == c for _, label in near) for c in (0, 1)]
    for (doc_id, _), vector in zip(rows, vectors):
        own = unit(vector @ axes)
        best = sorted(((own @ v, label) for v, label in near), reverse=True)
        # Equal cosines at the edge of the neighbours may go either way.
        edge = best[quality.NEIGHBOURS - 1][0]
        if abs(edge - best[quality.NEIGHBOURS][0]) < 1e-3:
            continue
        weight = [max(c, 0) ** quality.SHARPNESS for c, _ in best[: quality.NEIGHBOURS]]
        good = sum(w for w, (_, label) in zip(weight, best) if label) / sum(weight)
        assert share[0] and abs(found[doc_id] - good) < 0.02
