"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed n-grams of its letters, weighted by TF-IDF, at length one. Document
frequencies are counted over all texts to learn from. Each language gets a few centroids by
spherical k-means: a bounded sample of its texts gives the start, rounds over all of them the means.
A text belongs to the language of the centroid with the largest cosine, and is rejected if it is much
further from that centroid than the texts of its language are, or than their beginnings of its own
length are, or if its runs of letters are much shorter than theirs (hex dumps, whose letters stand
alone between digits). These floors are percentiles over all texts to learn from.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm import ngrams
from skyloom.llm.common import held_out

UNDETERMINED = "und"
#: Buckets of the vectors, and the n-grams (of bytes) that fall into them.
BUCKETS, ORDERS = 4096, (1, 2, 3)
#: Texts sampled from each language for the start of the k-means, centroids of each, rounds over
#: the sample, rounds over all texts.
SAMPLE, CENTROIDS, ROUNDS, WHOLE_ROUNDS = 1000, 4, 12, 2
#: Numbers are added up in these parts, so that their sums are the same in any order.
PARTS = 2**24
#: Rows whose beginnings are held in memory together.
BLOCK_ROWS = 512
#: Percentiles are those of cosines and of logarithms of mean runs in steps of one part of these.
COSINE_STEPS, RUN_STEPS = 10_000, 1_000
#: A text is rejected below these parts of the first percentile of the texts' cosines, mean runs.
REJECT_BELOW, REJECT_RUNS = 0.6, 0.5
#: Short texts have small cosines: the floor is at most this part of the fifth percentile of the
#: cosines of the texts' beginnings of so many letters. Runs count from ``LEAST_LETTERS`` on.
REJECT_SHORT, BEGINNINGS, LEAST_LETTERS = 0.5, (2, 4, 8, 16, 32, 64, 128, 256, 512), 16

_LETTER = regex.compile(r"\p{L}")


@dataclass
class Centroids:
    """Languages in order of name, with their centroids, and what a text needs to be accepted.

    ``floors`` has the least cosine of a language (a row) for texts of less than two letters and of
    at least each number in ``BEGINNINGS``; ``runs`` the least mean run of letters.
    """

    languages: list[str]
    owner: np.ndarray
    vectors: np.ndarray
    floors: np.ndarray
    runs: np.ndarray
    idf: np.ndarray


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _letter_counts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for first, counts, _, _ in _measured(texts):
        yield first, counts


def _measured(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of texts: the first one's number, n-gram counts, bytes of letters, mean run of those."""
    for first, data, offsets in ngrams.small_blocks(texts):
        data = ngrams.LETTERS[data]
        letter = data != 32
        begins = letter.copy()
        begins[1:] &= ~letter[:-1]
        inner = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[inner] = letter[inner]
        letters, runs = (
            np.diff(np.concatenate([[0], np.cumsum(marks)])[offsets]) for marks in (letter, begins)
        )
        counts = ngrams.ngram_counts(data, offsets, ORDERS, BUCKETS)
        yield first, counts, letters, letters / np.maximum(runs, 1)


def _beginning(text: str, letters: int) -> str | None:
    """The text up to so many bytes of letters, None if it has no more than those."""
    head = text[: 16 * letters + 256].encode("utf-8", "replace")
    places = np.flatnonzero(ngrams.LETTERS[np.frombuffer(head, np.uint8)] != 32)
    if len(places) <= letters:
        return None
    return head[: places[letters - 1] + 1].decode("utf-8", "ignore")


def fit(docs: DataFrame) -> Centroids:
    """Learns from ``text`` and ``lang`` of the rows that are not held out.

    Rows with a null language or a text without letters teach nothing. Frequencies, centroids and
    floors come from all other rows; only the start of the k-means is that of about ``SAMPLE`` ids a
    language at most, drawn by a hash, where an id with several rows, like all rows without an id,
    counts by the one whose weights come first.
    The model holds ``CENTROIDS * BUCKETS`` numbers a language.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", "lang").where(~held_out() & F.col("lang").isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        empty = np.zeros(0)
        vectors = np.zeros((0, BUCKETS))
        return Centroids([], empty.astype(int), vectors, empty, empty, np.ones(BUCKETS))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            letters = batch.filter(pa.array([has_letter(t.as_py()) for t in batch["text"]]))
            total[BUCKETS] += letters.num_rows
            for _, found in _letter_counts(letters["text"]):
                total[:BUCKETS] += (found > 0).sum(axis=0)
        yield pa.record_batch([pa.array(range(BUCKETS + 1)), pa.array(total)], ["bucket", "texts"])

    sums = (
        rows.select("text")
        .mapInArrow(frequencies, "bucket long, texts long")
        .groupBy("bucket")
        .agg(F.sum("texts").alias("texts"))
        .collect()
    )
    total = np.zeros(BUCKETS + 1, np.int64)
    for bucket, texts in sums:
        total[bucket] = texts
    idf = ngrams.inverse_frequencies(total[:BUCKETS], int(total[BUCKETS]))

    share = F.create_map(
        *(F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, SAMPLE / n)))
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(2**31))
    sample = rows.where(draw < share[F.col("lang")] * 2**31)
    shared_idf = spark.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = batch.filter(pa.array([has_letter(t.as_py()) for t in batch["text"]]))
            for first, found in _letter_counts(letters["text"]):
                weights = np.log1p(found, dtype=np.float32).astype(np.float16)
                own = letters.slice(first, len(found))
                packed = pa.array([row.tobytes() for row in weights], pa.binary())
                yield pa.record_batch(
                    [own["lang"], own["draw"], packed], ["lang", "draw", "weights"]
                )

    def cluster(table: pa.Table) -> pa.Table:
        table = table.sort_by([("draw", "ascending"), ("weights", "ascending")])
        raw = b"".join(table["weights"].to_pylist())
        weights = np.frombuffer(raw, np.float16).reshape(-1, BUCKETS).astype(np.float32)
        rows = ngrams.unit_rows(weights * shared_idf.value)
        centroids = spherical_means(rows, CENTROIDS, ROUNDS)
        return pa.table(
            {
                "lang": [table["lang"][0].as_py()] * len(centroids),
                "centroid": [c.astype(np.float32).tobytes() for c in centroids],
            }
        )

    found = (
        sample.select("text", "lang", draw.alias("draw"))
        .mapInArrow(vectors, "lang string, draw long, weights binary")
        .groupBy("lang", "draw")  # an id is drawn once, however often it is there
        .agg(F.min("weights").alias("weights"))
        .groupBy("lang")
        .applyInArrow(cluster, "lang string, centroid binary")
        .collect()
    )
    found.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    languages = sorted({r["lang"] for r in found})
    owner = np.array([languages.index(r["lang"]) for r in found], int)
    vectors = np.array([np.frombuffer(r["centroid"], np.float32) for r in found])
    vectors = vectors.reshape(-1, BUCKETS)
    own = rows.select("text", "lang").where(F.col("lang").isin(languages))
    for _ in range(WHOLE_ROUNDS if languages else 0):
        vectors = _means(own, languages, owner, vectors, idf)
    floors, runs = _floors(own, languages, owner, vectors, idf)
    return Centroids(languages, owner, vectors, floors, runs, idf)


def _means(
    rows: DataFrame, languages: list[str], owner: np.ndarray, vectors: np.ndarray, idf: np.ndarray
) -> np.ndarray:
    """The centroids after one round over all texts; the driver gets their sums."""
    shared = rows.sparkSession.sparkContext.broadcast((languages, owner, vectors, idf))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, owner, vectors, idf = shared.value
        number = {lang: k for k, lang in enumerate(languages)}
        sums = np.zeros(vectors.shape, np.int64)
        for batch in batches:
            own = batch.filter(pa.array([has_letter(t.as_py()) for t in batch["text"]]))
            theirs = np.array([number[lang.as_py()] for lang in own["lang"]], int)
            for first, counts in _letter_counts(own["text"]):
                texts = ngrams.tf_idf(counts, idf)
                cosines = texts @ vectors.T
                cosines[owner[None, :] != theirs[first : first + len(counts), None]] = -2
                nearest = cosines.argmax(axis=1)
                texts = np.rint(texts * np.float32(PARTS)).astype(np.int32)
                for k in np.unique(nearest):
                    sums[k] += texts[nearest == k].sum(axis=0, dtype=np.int64)
        centroid, bucket = np.nonzero(sums)
        yield pa.record_batch(
            [pa.array(centroid), pa.array(bucket), pa.array(sums[centroid, bucket])],
            ["centroid", "bucket", "total"],
        )

    found = (
        rows.mapInArrow(add, "centroid long, bucket long, total long")
        .groupBy("centroid", "bucket")
        .agg(F.sum("total").alias("total"))
        .toArrow()
    )
    sums = np.zeros(vectors.shape)
    sums[found["centroid"].to_numpy(), found["bucket"].to_numpy()] = found["total"].to_numpy()
    empty = ~sums.any(axis=1)
    sums[empty] = vectors[empty]
    return ngrams.unit_rows(sums).astype(np.float32)


def _floors(
    rows: DataFrame, languages: list[str], owner: np.ndarray, vectors: np.ndarray, idf: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``floors`` and ``runs`` of the model, from all texts and their beginnings.

    A task counts how often a cosine, or a mean run (size -1), is there, in steps, so what is
    shuffled and what a percentile is taken from do not grow with the texts.
    """
    shared = rows.sparkSession.sparkContext.broadcast((languages, owner, vectors, idf))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, owner, vectors, idf = shared.value
        number = {lang: k for k, lang in enumerate(languages)}
        steps: Counter[tuple[int, int, int]] = Counter()
        for batch in (b.slice(k, BLOCK_ROWS) for b in batches for k in range(0, len(b), BLOCK_ROWS)):
            own = batch.filter(pa.array([has_letter(t.as_py()) for t in batch["text"]]))
            whole = own["text"].to_pylist()
            langs = np.array([number[lang.as_py()] for lang in own["lang"]], int)
            for size in (0, *BEGINNINGS):
                heads = [_beginning(t, size) if size else t for t in whole]
                there = np.array([h is not None for h in heads], bool)
                parts = pa.array([h for h in heads if h is not None], pa.string())
                for first, counts, letters, runs in _measured(parts):
                    theirs = langs[there][first : first + len(counts)]
                    cosines = ngrams.tf_idf(counts, idf) @ vectors.T
                    cosines[owner[None, :] != theirs[:, None]] = -1
                    found = np.rint(cosines.max(axis=1) * COSINE_STEPS).astype(int)
                    steps.update(zip(theirs.tolist(), [size] * len(counts), found.tolist()))
                    if not size:
                        long = letters >= LEAST_LETTERS
                        found = np.rint(np.log(runs[long]) * RUN_STEPS).astype(int)
                        steps.update(zip(theirs[long].tolist(), [-1] * len(found), found.tolist()))
        keys = np.array(list(steps), int).reshape(-1, 3)
        yield pa.record_batch(
            [*(pa.array(column) for column in keys.T), pa.array(list(steps.values()), pa.int64())],
            ["lang", "size", "step", "texts"],
        )

    # The driver gets a row for each language and size.
    found = (
        rows.mapInArrow(measure, "lang long, size long, step long, texts long")
        .groupBy("lang", "size", "step")
        .agg(F.sum("texts").alias("texts"))
        .withColumn(
            "value",
            F.when(F.col("size") < 0, F.exp(F.col("step") / RUN_STEPS)).otherwise(F.col("step") / COSINE_STEPS),
        )
        .groupBy("lang", "size")
        .agg(
            F.percentile("value", 0.01, F.col("texts")).alias("first"),
            F.percentile("value", 0.05, F.col("texts")).alias("fifth"),
        )
    )
    spread = {(languages[r["lang"]], r["size"]): r for r in found.collect()}
    floors = np.zeros((len(languages), len(BEGINNINGS) + 1))
    least = np.zeros(len(languages))
    for k, lang in enumerate(languages):
        top = REJECT_BELOW * spread[lang, 0]["first"]
        short = 0.0
        for n, size in enumerate(BEGINNINGS, 1):
            if (lang, size) in spread:
                short = max(short, REJECT_SHORT * spread[lang, size]["fifth"])
            else:
                short = top  # no text is as long
            floors[k, n] = min(top, short)
        if (lang, -1) in spread:
            least[k] = REJECT_RUNS * spread[lang, -1]["first"]
    return floors, least


def spherical_means(rows: np.ndarray, count: int, rounds: int) -> np.ndarray:
    """At most ``count`` unit centroids; the start spreads over the rows by largest distance."""
    chosen = [0]
    nearest = rows @ rows[0]
    while len(chosen) < min(count, len(rows)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    centroids = rows[chosen]
    for _ in range(rounds):
        owner = (rows @ centroids.T).argmax(axis=1)
        sums = [
            rows[owner == k].sum(axis=0) if (owner == k).any() else centroids[k]
            for k in range(len(centroids))
        ]
        centroids = ngrams.unit_rows(np.array(sums))
    return centroids


def predictions(docs: DataFrame, model: Centroids) -> Column:
    """``lang_pred, score, rejected`` of the column ``text`` as a struct.

    ``score`` is the largest cosine, from 0 to 1; equal cosines go to the first language by name.
    Null texts and texts without a letter are ``und`` with score 0 and rejected, and so is every
    text if there was nothing to learn from. Texts of any length are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double, rejected: boolean>")
    def predict(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for part in parts:
            languages = [UNDETERMINED] * len(part)
            scores, rejected = np.zeros(len(part)), np.ones(len(part), bool)
            lettered = [has_letter(text.as_py()) for text in part]
            for first, counts, letters, runs in _measured(part) if model.languages else ():
                size = np.searchsorted(BEGINNINGS, letters, side="right")
                cosines = ngrams.tf_idf(counts, model.idf) @ model.vectors.T
                best = cosines.argmax(axis=1)
                for i, k in enumerate(best.tolist()):
                    if lettered[first + i]:
                        score = float(min(max(cosines[i, k], 0.0), 1.0))
                        own = model.owner[k]
                        languages[first + i] = model.languages[own]
                        scores[first + i] = score
                        rejected[first + i] = score < model.floors[own, size[i]] or (
                            letters[i] >= LEAST_LETTERS and runs[i] < model.runs[own]
                        )
            yield pa.StructArray.from_arrays(
                [pa.array(languages), pa.array(scores), pa.array(rejected)],
                ["lang_pred", "score", "rejected"],
            )

    return predict("text")


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every document, by a model fitted on it.

    A row's ``lang``, ``source`` and ``doc_id`` take no part in its prediction. Rows with a null or
    repeated ``doc_id`` are rows like others. Other columns are left out. An empty table gives none.
    """
    found = predictions(docs, fit(docs)).alias("found")
    return docs.select("doc_id", held_out().alias("held_out"), found).select(
        "doc_id", "held_out", "found.*"
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns as they are."""
    return docs.where(~predictions(docs, fit(docs))["rejected"])
