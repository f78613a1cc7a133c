"""Near-duplicate vectors by randomised-rotation binary codes with stored correction factors.

A unit vector is turned by a random rotation; its code is the signs of the turned numbers, and its
correction factor is how well the code points the vector's way. Code, factor and another turned
vector give an unbiased estimate of their cosine and a bound on its error; only pairs whose estimate
may reach the threshold are worked out in double precision. Equal vectors form a class and one row
stands for each. Candidates share a bucket: some signs under one of several other rotations. The
number of signs grows with the logarithm of the number of classes, so that buckets stay small, and
the number of rotations follows from the recall wanted at the threshold itself; above the threshold
the recall is higher.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import components, sorted_groups
from skyloom.llm.embeddings import usable_vectors
from skyloom.llm.shingles import mix
from skyloom.storage import discard, written

#: A bucket is searched in blocks of about so many classes; classes a bucket has on average.
BLOCK, BUCKET = 1024, 64
#: Steps into which the largest number of a vector and the length of a hyperplane are divided.
STEPS = 1 << 20
#: Up to so many crowded buckets are sent to all executors (12 bytes each).
BROADCAST_BUCKETS = 1_000_000


@lru_cache(8)
def rotation(size: int, number: int) -> np.ndarray:
    """A random rotation, the same on every machine."""
    normal = np.random.default_rng([size, number]).standard_normal((size, size))
    turned, upper = np.linalg.qr(normal)
    return turned * np.sign(np.diag(upper))


@lru_cache(8)
def hyperplanes(size: int, count: int) -> np.ndarray:
    """The first ``count`` columns of as many rotations as it takes."""
    each = [rotation(size, 1 + k) for k in range(-(-count // size))]
    return np.rint(np.concatenate(each, axis=1)[:, :count] * STEPS)


def bucket_keys(vectors: np.ndarray, signs: int, rotations: int) -> np.ndarray:
    """The vectors' bucket keys under the first ``rotations`` rotations.

    Vectors and hyperplanes are rounded to whole numbers, whose products doubles hold exactly. So a
    vector has the same keys in whatever block they are worked out, and they need not travel with it.
    """
    size = vectors.shape[1]
    whole = np.rint(vectors / np.abs(vectors).max(axis=1, keepdims=True) * STEPS)
    above = whole @ hyperplanes(size, signs * rotations) > 0
    bits = above.reshape(len(vectors), rotations, signs) @ (1 << np.arange(signs, dtype=np.int64))
    salt = np.arange(rotations, dtype=np.uint64) + np.uint64(size << 20)
    return mix(bits.astype(np.uint64) ^ mix(salt * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)


def codes_of(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs of the turned unit vectors, packed, and the correction factors."""
    turned = units @ rotation(units.shape[1], 0)
    factors = np.abs(turned).sum(axis=1) / math.sqrt(units.shape[1])
    return np.packbits(turned > 0, axis=1), factors


def estimates(
    codes: np.ndarray, factors: np.ndarray, units: np.ndarray, errors: float = 4.5
) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the cosines of coded vectors with others, and the bounds of their
    errors: so many standard errors."""
    size = units.shape[1]
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1
    turned = (units @ rotation(size, 0)).astype(np.float32)
    scale = (factors * math.sqrt(size)).astype(np.float32)
    spread = np.sqrt(np.maximum(1 - factors**2, 0)) / factors / math.sqrt(max(size - 1, 1))
    return signs @ turned.T / scale[:, None], errors * (spread + 1e-9) + 1e-5


def layout(classes: int, threshold: float, recall: float) -> tuple[int, int]:
    """Signs of a bucket key, and number of rotations that give the recall at the threshold."""
    signs = min(max(math.ceil(math.log2(max(classes, 1) / BUCKET)), 4), 40)
    same = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, math.ceil(math.log(1 - recall) / math.log(1 - same))


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    recall: float = 0.99,
    errors: float = 4.5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: the near-duplicate group of every vector.

    Two vectors of the same length are linked if their cosine in double precision is at least
    ``threshold``; every reported link was worked out. A pair at the threshold is found with
    probability ``recall``, a closer pair more surely, an equal pair always. Of the pairs that share a
    bucket those are worked out whose estimate is at most ``errors`` standard errors below the
    threshold: 4.5 leave out fewer than 4 in a million linked pairs of a bucket, ``math.inf`` none,
    and then each such pair is worked out. ``n_links`` counts the
    other vectors linked directly, ``component_id`` is the smallest id reachable, ``kept`` whether
    that is the vector's own.

    Null, empty and zero vectors and those holding nulls or numbers that are not finite have no
    links. Rows equal in id and vector count as one vector; each row comes back. An id with several
    vectors is linked through any of them. A null id has a null component. Other columns are left
    out. An empty table gives no rows.
    """
    coded = written(_coded(vectors, id_column, vector_column), "vectors")
    members = coded.where("vector IS NOT NULL AND vec_id IS NOT NULL").select("vec_id", "vector")
    classes = written(
        members.distinct()
        .groupBy("vector")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")),
        "vector-classes",
    )
    kind = _number_type(vectors.select(F.col(vector_column).alias("vector")))
    signs, rotations = layout(classes.count(), threshold, recall)
    keyed = written(_keyed(classes, kind, signs, rotations), "vector-keys")
    crowded = keyed.select(F.explode("keys").alias("bucket")).groupBy("bucket").count()
    crowded = written(
        crowded.where(F.col("count") > BLOCK).select(
            "bucket", F.ceil(F.col("count") / BLOCK).cast("int").alias("chunks")
        ),
        "vector-crowded",
    )
    sent = F.broadcast(crowded) if crowded.count() <= BROADCAST_BUCKETS else crowded
    found = written(_search(keyed, sent, kind, threshold, signs, errors), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    owners = coded.join(classes.select("vector", "rep", "weight"), "vector", "left")
    owners = owners.select("vec_id", "rep", "weight")
    edges = found.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(
        owners.where("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    )
    groups = components(edges)
    joined = owners.join(counts, "rep", "left").join(
        groups.withColumnRenamed("node", "vec_id"), "vec_id", "left"
    )
    component = F.coalesce("component", "vec_id")
    links = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))
    joined = joined.select(
        "vec_id",
        links.cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
    joined = written(joined, "near-vectors")
    discard(coded, classes, keyed, crowded, found, groups)
    return joined


def _coded(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, vector`` with the numbers as bytes; null if the row takes no part."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector")
    )
    kind = _number_type(rows)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed: list[bytes | None] = [None] * batch.num_rows
            for rows, found in usable_vectors(batch["vector"]):
                for row, vector in zip(rows.tolist(), found.astype(kind)):
                    if vector.any():
                        packed[row] = vector.tobytes()
            yield pa.record_batch(
                [batch["vec_id"], pa.array(packed, pa.binary())], ["vec_id", "vector"]
            )

    return rows.mapInArrow(read, "vec_id long, vector binary")


def _number_type(rows: DataFrame) -> str:
    element = rows.schema["vector"].dataType.elementType.simpleString()
    return "<f4" if element == "float" else "<f8"


def _unpacked(column: pa.Array, kind: str) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1).astype(float)


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _keyed(classes: DataFrame, kind: str, signs: int, rotations: int) -> DataFrame:
    """The classes with code, correction factor and the bucket keys under every rotation."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lengths = pa.compute.binary_length(batch["vector"])
            for length in lengths.unique().to_pylist():
                own = table.filter(pa.compute.equal(lengths, length)).combine_chunks()
                vectors = _unpacked(own["vector"].combine_chunks(), kind)
                codes, factors = codes_of(_units(vectors))
                keys = bucket_keys(vectors, signs, rotations)
                yield pa.record_batch(
                    [
                        own["rep"].combine_chunks(),
                        own["weight"].combine_chunks(),
                        own["vector"].combine_chunks(),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(factors),
                        pa.ListArray.from_arrays(
                            np.arange(len(vectors) + 1, dtype=np.int32) * rotations,
                            keys.reshape(-1),
                        ),
                    ],
                    ["rep", "weight", "vector", "code", "factor", "keys"],
                )

    return classes.select("rep", "weight", "vector").mapInArrow(
        key,
        "rep long, weight long, vector binary, code binary, factor double, keys array<long>",
    )


def _search(
    keyed: DataFrame, crowded: DataFrame, kind: str, threshold: float, signs: int, errors: float
) -> DataFrame:
    """``rep, links, root`` of the vectors with links in a block: their number, weighted, and the
    smallest id that they lead to there. Crowded buckets are cut into pairs of chunks."""
    rows = keyed.select(
        "rep", "weight", "vector", "code", "factor", F.posexplode("keys").alias("number", "bucket")
    ).join(crowded, "bucket", "left")
    chunks = F.coalesce("chunks", F.lit(1))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("vector"), chunks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    keys = ["bucket", "x", "y"]
    rows = (
        rows.withColumn("x", F.least("chunk", "other"))
        .withColumn("y", F.greatest("chunk", "other"))
        .drop("chunks", "other")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "rep")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in sorted_groups(batches, keys):
            if block.num_rows > 1:
                reps, links, roots = block_links(block, kind, threshold, signs, errors)
                if len(reps):
                    yield pa.record_batch(
                        [pa.array(reps), pa.array(links), pa.array(roots)],
                        ["rep", "links", "root"],
                    )

    return rows.mapInArrow(search, "rep long, links long, root long")


def block_links(
    block: pa.Table, kind: str, threshold: float, signs: int, errors: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, weighted numbers of links and smallest ids reached, of a block's linked vectors. Pairs
    that share the bucket of an earlier rotation are left to that one."""
    reps, weights = block["rep"].to_numpy(), block["weight"].to_numpy()
    chunk = block["chunk"].to_numpy()
    earlier = block["number"][0].as_py()
    vectors = _unpacked(block["vector"].combine_chunks(), kind)
    units = _units(vectors)
    codes = np.frombuffer(b"".join(block["code"].to_pylist()), np.uint8).reshape(len(reps), -1)
    cosines, bounds = estimates(codes, block["factor"].to_numpy(), units, errors)
    able = np.triu(cosines + bounds[:, None] >= threshold, 1)
    if block["x"][0].as_py() != block["y"][0].as_py():
        able &= chunk[:, None] != chunk[None, :]
    first, second = np.nonzero(able)
    linked = np.zeros(len(first), bool)
    for begin in range(0, len(first), 1 << 16):
        i, j = first[begin : begin + (1 << 16)], second[begin : begin + (1 << 16)]
        linked[begin : begin + (1 << 16)] = np.einsum("ij,ij->i", units[i], units[j]) >= threshold
    first, second = first[linked], second[linked]
    if earlier and len(first):
        some, at = np.unique(np.concatenate([first, second]), return_inverse=True)
        keys = bucket_keys(vectors[some], signs, earlier)
        left, right = at[: len(first)], at[len(first) :]
        new = np.ones(len(first), bool)
        for number in range(earlier):
            new &= keys[left, number] != keys[right, number]
        first, second = first[new], second[new]
    links = np.zeros(len(reps), np.int64)
    np.add.at(links, first, weights[second])
    np.add.at(links, second, weights[first])
    root = np.arange(len(reps))  # rows are in order of id
    while True:
        least = np.minimum(root[first], root[second])
        before = root.copy()
        np.minimum.at(root, first, least)
        np.minimum.at(root, second, least)
        root = root[root]
        if (root == before).all():
            break
    some = links > 0
    return reps[some], links[some], reps[root[some]]
