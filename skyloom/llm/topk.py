"""Exact top-k inner products by norm-sorted vectors and pruning on rotated partial sums.

Vectors are laid out in blocks of descending length. They are turned by the right singular vectors
of a bounded sample, which moves most of an inner product into the first numbers; any rotation gives
the same results, this one prunes more. A block is read from its longest vector on: once the product
of the lengths cannot reach a query's k-th best score, the rest of the block cannot either. Before,
the product over the first numbers plus the Cauchy-Schwarz bound on the others rules most vectors
out, stage by stage. What is left is worked out in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.embeddings import usable_vectors
from skyloom.storage import discard, written

#: Vectors in a block, queries in a group, vectors that are looked at together in a task.
BLOCK, GROUP, STEP = 4096, 1024, 512
#: Vectors that the rotation is fitted on, and that give the queries their first k scores.
SAMPLE, FIRST = 4096, 2048
#: Added to scores beyond a long, so that their bytes are in their order.
_ABOVE = 1 << 2200


def top_products(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: float = 256.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest inner products.

    Every number ``x`` counts as ``floor(scale * x)``, worked out as a double; the score is a whole
    number and exact; one beyond a long comes back as the nearest long, but is ranked by what it is.
    Each row of ``queries`` is compared with all rows of ``vectors`` of another
    id and the same length. Equal scores go to the smaller id, ranks start at 1, and all candidates
    come back if there are fewer than ``k``.

    Null and empty vectors, and those with nulls or numbers that are not finite, before or after
    scaling, take no part on either side, nor do rows without an id. Rows equal in id and
    vector count once; an id with several vectors has results for each. Other columns are left out.
    Empty tables give no rows.
    """
    spark = vectors.sparkSession
    own = _whole(vectors, id_column, vector_column, scale)
    own = written(own.distinct(), "products")
    blocks = -(-own.count() // BLOCK)
    if not blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    turn = spark.sparkContext.broadcast(_rotations(own))
    ordered = own.repartitionByRange(blocks, F.desc("length"), "vec_id")
    ordered = written(
        ordered.sortWithinPartitions(F.desc("length"), "vec_id").withColumn(
            "block", F.spark_partition_id()
        ),
        "products-ordered",
    )
    asked = _whole(queries, id_column, vector_column, scale).distinct()
    first = ordered.orderBy(F.desc("length"), "vec_id").limit(FIRST).select("vec_id", "numbers")
    started = spark.sparkContext.broadcast(
        [(r["vec_id"], bytes(r["numbers"])) for r in first.collect()]
    )
    asked = written(_started(asked, started, k), "products-queries")
    groups = max(1, -(-asked.count() // GROUP))
    group = F.pmod(F.xxhash64("vec_id", "numbers"), F.lit(groups)).cast("int")
    bounds = ordered.groupBy("block").agg(F.max("length").alias("longest"))
    bounds = written(bounds, "products-blocks")
    last = bounds.agg(F.max("block")).first()[0]
    reach = F.col("length") * F.col("longest") * (1 + 1e-9) + 1
    pairs = (
        asked.withColumn("group", group)
        .withColumn("query", F.xxhash64("numbers"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(last))))
        .join(bounds, "block")
        .where(reach >= F.col("floor"))
    )
    pairs = written(
        pairs.select("vec_id", "query", "numbers", "floor", "block", "group"), "products-pairs"
    )
    # A block is copied to the groups of which a query can reach it, not to all.
    needed = written(pairs.select("block", "group").distinct(), "products-needed")
    rows = ordered.join(F.broadcast(needed) if last * groups < 1 << 20 else needed, "block")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _block_top(left, right, turn.value, k)

    found = (
        pairs.groupBy("block", "group")
        .cogroup(
            rows.select("vec_id", "numbers", "length", "block", "group").groupBy("block", "group")
        )
        .applyInArrow(search, "query_id long, query long, vec_id long, score long, beyond binary")
    )
    order = [F.desc("score"), F.desc("beyond"), F.col("vec_id")]
    best = Window.partitionBy("query_id", "query").orderBy(*order)
    found = (
        found.withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
    found = written(found, "top-products")
    discard(own, ordered, asked, bounds, pairs, needed)
    return found


def _whole(rows: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """``vec_id, numbers, length``: the whole numbers as bytes of doubles, which hold them exactly."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, found in usable_vectors(batch["vector"]):
                with np.errstate(over="ignore"):
                    whole = np.floor(scale * found) + 0.0  # no negative zeros
                finite = np.isfinite(whole).all(axis=1)
                whole = whole[finite].astype("<f8")
                yield pa.record_batch(
                    [
                        batch["vec_id"].take(pa.array(rows[finite])),
                        pa.array([w.tobytes() for w in whole], pa.binary()),
                        pa.array(lengths(whole)),
                    ],
                    ["vec_id", "numbers", "length"],
                )

    chosen = rows.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector")
    )
    chosen = chosen.where("vec_id IS NOT NULL AND vector IS NOT NULL")
    return chosen.mapInArrow(read, "vec_id long, numbers binary, length double")


def lengths(rows: np.ndarray) -> np.ndarray:
    """Lengths of the rows, also where squares of their numbers are beyond a double."""
    largest = np.abs(rows).max(axis=1, initial=1.0)
    return np.linalg.norm(rows / largest[:, None], axis=1) * largest


def exact_products(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Inner products of whole numbers, row by row."""
    bound = np.abs(left).max(axis=1, initial=0) * np.abs(right).max(axis=1, initial=0)
    small = np.flatnonzero(bound * left.shape[1] < 2.0**62)
    products = np.zeros(len(left), object)
    small_products = (left[small].astype(np.int64) * right[small].astype(np.int64)).sum(axis=1)
    products[small] = small_products.tolist()
    for i in np.setdiff1d(np.arange(len(left)), small).tolist():
        products[i] = sum(int(a) * int(b) for a, b in zip(left[i].tolist(), right[i].tolist()))
    return products.tolist()


def _rotations(own: DataFrame) -> dict[int, np.ndarray]:
    """For each number of dimensions the right singular vectors of a sample drawn by hash."""
    drawn = own.orderBy(F.xxhash64("vec_id", "numbers")).limit(SAMPLE).select("numbers").collect()
    by_size: dict[int, list[np.ndarray]] = {}
    for row in drawn:
        numbers = np.frombuffer(row["numbers"], "<f8")
        by_size.setdefault(len(numbers), []).append(numbers / max(np.abs(numbers).max(), 1.0))
    return {n: np.linalg.svd(np.array(v))[2].T for n, v in by_size.items()}


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<f8").reshape(-1, size)


def _started(asked: DataFrame, started, k: int) -> DataFrame:
    """The queries with the k-th best of their scores among the longest vectors as ``floor``."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size: dict[int, list[tuple[int, bytes]]] = {}
        for vec_id, numbers in started.value:
            by_size.setdefault(len(numbers), []).append((vec_id, numbers))
        for batch in batches:
            floors = np.full(batch.num_rows, -np.inf)
            ids = batch["vec_id"].to_numpy()
            sizes = pa.compute.binary_length(batch["numbers"]).to_numpy()
            for size in np.unique(sizes).tolist():
                others = by_size.get(size, [])
                rows = np.flatnonzero(sizes == size)
                if len(others) <= k:
                    continue
                left = _matrix(batch["numbers"].take(pa.array(rows)), size // 8)
                right = np.array([np.frombuffer(n, "<f8") for _, n in others])
                with np.errstate(over="ignore", invalid="ignore"):
                    products = left @ right.T
                    products -= 1e-9 * lengths(left)[:, None] * lengths(right) + 1
                products[np.isnan(products)] = -np.inf
                products[ids[rows][:, None] == np.array([i for i, _ in others])] = -np.inf
                floors[rows] = np.partition(products, -k, axis=1)[:, -k]
            yield batch.append_column("floor", pa.array(floors))

    schema = "vec_id long, numbers binary, length double, floor double"
    return asked.mapInArrow(start, schema)


def _block_top(
    asked: pa.Table, rows: pa.Table, turns: dict[int, np.ndarray], k: int
) -> pa.Table:
    """The k best rows of a block for each of its queries that can matter."""
    found: list[tuple] = []
    sizes = pa.compute.binary_length(rows["numbers"])
    asked_sizes = pa.compute.binary_length(asked["numbers"])
    for size in sizes.unique().to_pylist():
        own = rows.filter(pa.compute.equal(sizes, size))
        own = own.sort_by([("length", "descending"), ("vec_id", "ascending")])
        queries = asked.filter(pa.compute.equal(asked_sizes, size))
        if own.num_rows and queries.num_rows:
            search = _Search(queries, own, turns.get(size // 8, np.eye(size // 8)), k)
            found += search.run()
    columns = list(zip(*found)) if found else [[], [], [], [], []]
    names = ["query_id", "query", "vec_id", "score", "beyond"]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.table({n: pa.array(c, kind) for n, c, kind in zip(names, columns, kinds)})


def _as_long(score: int) -> tuple[int, bytes | None]:
    """The nearest long, and for scores beyond it bytes in the order of the scores."""
    nearest = min(max(score, -(2**63)), 2**63 - 1)
    return nearest, (score + _ABOVE).to_bytes(276, "big") if abs(score) >= 2**63 - 1 else None


class _Search:
    """A group of queries against a block of vectors of descending length."""

    def __init__(self, asked: pa.Table, rows: pa.Table, turn: np.ndarray, k: int):
        size = len(turn)
        self.k, self.size = k, size
        self.hashes = asked["query"].to_pylist()
        self.query_ids, self.ids = asked["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
        self.queries, self.rows = _matrix(asked["numbers"], size), _matrix(rows["numbers"], size)
        self.floor = asked["floor"].to_numpy().copy()
        self.turned_queries, self.turned = self.queries @ turn, self.rows @ turn
        self.query_lengths, self.lengths = lengths(self.queries), lengths(self.rows)
        self.stages = sorted({min(size, n) for n in (max(size // 4, 1), max(size // 2, 1), size)})
        self.best: list[list[tuple[int, int]]] = [[] for _ in self.query_ids]

    def run(self) -> list[tuple]:
        with np.errstate(over="ignore", invalid="ignore"):  # a bound that overflows rules nothing out
            self.search()
        return [
            (query_id, query, vec_id, *_as_long(-negative))
            for query_id, query, kept in zip(self.query_ids.tolist(), self.hashes, self.best)
            for negative, vec_id in kept
        ]

    def search(self) -> None:
        for begin in range(0, len(self.rows), STEP):
            reach = self.query_lengths * self.lengths[begin] * (1 + 1e-9) + 1e-6
            active = np.flatnonzero(~(reach < self.floor))
            if not len(active):
                break
            self.step(active, slice(begin, begin + STEP))

    def step(self, active: np.ndarray, part: slice) -> None:
        slack = 1e-9 * self.query_lengths[active] * self.lengths[part.start] + 1e-6
        need = (self.floor[active] - slack)[:, None]
        sums, done, pairs = 0.0, 0, None
        for stage in self.stages:
            left, right = self.turned_queries[active], self.turned[part]
            sums = sums + left[:, done:stage] @ right[:, done:stage].T
            rest = np.linalg.norm(left[:, stage:], axis=1)[:, None]
            able = ~(sums + rest * np.linalg.norm(right[:, stage:], axis=1) < need)
            some = able.any(axis=1)
            if not some.any():
                return
            active, sums, need, able = active[some], sums[some], need[some], able[some]
            done, pairs = stage, able
        first, second = np.nonzero(pairs)
        first, second = active[first], second + part.start
        other = self.query_ids[first] != self.ids[second]
        first, second = first[other], second[other]
        for begin in range(0, len(first), 1 << 15):
            q, v = first[begin : begin + (1 << 15)], second[begin : begin + (1 << 15)]
            exact = exact_products(self.queries[q], self.rows[v])
            for query, vec_id, score in zip(q.tolist(), self.ids[v].tolist(), exact):
                self.best[query].append((-score, vec_id))
        for query in np.unique(first).tolist():
            kept = sorted(self.best[query])[: self.k]
            self.best[query] = kept
            if len(kept) == self.k:
                least = -kept[-1][0]
                if abs(least) < 2**1000:
                    self.floor[query] = max(self.floor[query], float(least))
