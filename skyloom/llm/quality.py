"""Document quality by votes of the nearest labelled documents in a latent-semantic space.

A text is a vector of hashed n-grams of its letters and of its shape (capitals, digits, marks),
weighted by TF-IDF, and of how much its words repeat. Document frequencies are counted over all
documents. A singular value decomposition of a bounded sample of labelled documents gives the latent
space; the sample's vectors in it go to all executors, and every document is compared with all of
them, block by block. Its nearest neighbours vote with their labels, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm import ngrams, shingles
from skyloom.llm.common import held_out

#: Buckets of letter and shape n-grams, and steps of the two shares of repeated words.
LETTERS, SHAPES, STEPS = 1024, 512, 16
COUNTED = LETTERS + SHAPES
WEIGHTS = np.repeat(np.float32([0.5, 1.0, 0.5]), [LETTERS, SHAPES, 2 * STEPS])
#: About so many labelled documents of each class are compared with; latent dimensions.
SAMPLE, LATENT = 3000, 48
#: Neighbours that vote, and the power of the cosine that weights them.
NEIGHBOURS, SHARPNESS = 15, 8
#: Scores from here on are good.
GOOD = 0.7


@dataclass
class Neighbours:
    """Unit vectors of the labelled sample, their labels and weights, and the way into the space."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray


def _counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    letters = ngrams.ngram_counts(ngrams.LETTERS[data], offsets, (3,), LETTERS)
    shapes = ngrams.ngram_counts(ngrams.SHAPES[data], offsets, (1, 3), SHAPES)
    return np.concatenate([letters, shapes], axis=1)


def _repetition(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One mark each for the share of words like the one before, and of different words."""
    count = len(offsets) - 1
    words, owner = shingles.word_hashes(data, offsets)
    total = np.maximum(np.bincount(owner, minlength=count), 1)
    same = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    again = np.bincount(owner[1:][same], minlength=count) / total
    order = np.lexsort((words, owner))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    different = np.bincount(owner[order][new], minlength=count) / total
    marks = np.zeros((count, 2 * STEPS), np.float32)
    for k, share in enumerate((again, different)):
        step = np.minimum((share * STEPS).astype(int), STEPS - 1)
        marks[np.arange(count), k * STEPS + step] = np.sqrt(0.5)
    return marks


def _vectors(texts: pa.Array, idf: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """First row and unit vectors of consecutive texts."""
    for first, data, offsets in ngrams.small_blocks(texts):
        counts = _counts(data, offsets)
        parts = [
            ngrams.tf_idf(counts[:, :LETTERS], idf[:LETTERS]),
            ngrams.tf_idf(counts[:, LETTERS:], idf[LETTERS:]),
            _repetition(data, offsets),
        ]
        yield first, ngrams.unit_rows(np.concatenate(parts, axis=1) * WEIGHTS)


def fit(docs: DataFrame, labels: DataFrame) -> Neighbours | None:
    """Learns from the ``quality`` (0 or 1) of labelled documents that are not held out.

    About ``SAMPLE`` labelled ids of each class are drawn by a hash of the id; votes are weighted
    back to the classes' true shares. Null ids and labels teach nothing; an id with several labels
    has the lowest, one with several texts the one whose vector comes first. None if no document has a label.
    """
    spark = docs.sparkSession
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    counts = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    if not counts:
        return None

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTED + 1, np.int64)
        for batch in batches:
            total[COUNTED] += batch.num_rows
            for _, data, offsets in ngrams.small_blocks(batch["text"]):
                total[:COUNTED] += (_counts(data, offsets) > 0).sum(axis=0)
        yield pa.record_batch([pa.array(range(COUNTED + 1)), pa.array(total)], ["bucket", "texts"])

    sums = (
        docs.select("text")
        .mapInArrow(frequencies, "bucket long, texts long")
        .groupBy("bucket")
        .agg(F.sum("texts").alias("texts"))
        .collect()
    )
    total = np.zeros(COUNTED + 1, np.int64)
    for bucket, texts in sums:
        total[bucket] = texts
    idf = ngrams.inverse_frequencies(total[:COUNTED], int(total[COUNTED]))

    share = F.create_map(
        *(F.lit(v) for label, n in counts.items() for v in (label, min(1.0, SAMPLE / n)))
    )
    draw = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2**31))
    chosen = F.broadcast(known.where(draw < share[F.col("quality")] * 2**31))
    shared_idf = spark.sparkContext.broadcast(idf)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows in _vectors(batch["text"], shared_idf.value):
                own = batch.slice(first, len(rows))
                packed = pa.array([row.astype(np.float16).tobytes() for row in rows], pa.binary())
                yield pa.record_batch(
                    [own["doc_id"], own["quality"], packed], ["doc_id", "quality", "vector"]
                )

    sample = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(chosen.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id")
        .select("doc_id", "quality", "text")
        .mapInArrow(vectors, "doc_id long, quality int, vector binary")
        .groupBy("doc_id", "quality")  # one row of an id, however often it is there
        .agg(F.min("vector").alias("vector"))
        .collect()
    )
    if not sample:
        return None
    sample.sort(key=lambda r: (r["doc_id"], r["quality"], bytes(r["vector"])))
    rows = np.array([np.frombuffer(r["vector"], np.float16) for r in sample]).astype(np.float32)
    labels_of = np.array([r["quality"] for r in sample])
    axes = leading_axes(rows, LATENT)
    drawn = np.bincount(labels_of, minlength=2)
    weights = np.array([counts.get(k, 0) / max(drawn[k], 1) for k in (0, 1)])
    weights = (weights / weights.max())[labels_of]
    return Neighbours(idf, axes, ngrams.unit_rows(rows @ axes), labels_of, weights)


def leading_axes(rows: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """The leading right singular vectors as columns, by subspace iteration."""
    count = min(count, *rows.shape)
    start = np.random.default_rng(0).standard_normal((rows.shape[1], count + 16))
    basis = np.linalg.qr(start.astype(np.float32))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ turn.T)[:, :count]


def votes(rows: np.ndarray, model: Neighbours) -> np.ndarray:
    """The weighted share of good labels among the nearest neighbours of each unit vector."""
    cosines = rows @ model.vectors.T
    near = min(NEIGHBOURS, cosines.shape[1])
    nearest = np.argpartition(-cosines, near - 1, axis=1)[:, :near]
    weight = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0).astype(float)
    weight = weight**SHARPNESS * model.weights[nearest]
    total = weight.sum(axis=1)
    good = (weight * model.labels[nearest]).sum(axis=1)
    overall = (model.weights * model.labels).sum() / model.weights.sum()
    return np.clip(np.where(total > 0, good / np.where(total > 0, total, 1), overall), 0, 1)


def scores(docs: DataFrame, model: Neighbours | None) -> Column:
    """The score of the column ``text``, from 0 to 1.

    Null and empty texts are scored like a text without words. Without a model nothing speaks
    against a document: its score is 1. Texts are read whole.
    """
    if model is None:
        return F.lit(1.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for part in parts:
            found = np.ones(len(part))
            for first, rows in _vectors(part, model.idf):
                latent = ngrams.unit_rows(rows @ model.axes)
                found[first : first + len(rows)] = votes(latent, model)
            yield pa.array(found)

    return score("text")


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Labels, ``lang``, ``source`` and ``doc_id`` take no part in a score. Rows with a null or repeated
    ``doc_id`` are rows like others; what is learned from a repeated id is stated at ``fit``. Other columns are left out. An empty table gives no rows.
    """
    found = docs.select(
        "doc_id", held_out().alias("held_out"), scores(docs, fit(docs, labels)).alias("score")
    )
    return found.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a good score, with their columns as they are."""
    return docs.where(scores(docs, fit(docs, labels)) >= GOOD)
