"""Shared pieces of the corpus operators: hold-out rows, text rules and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.storage import discard, written

#: White space that the contracts strip and split at.
SPACES = " \t\n\x0b\x0c\r"
#: Rows go to Python in Arrow batches of about so many bytes.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[pa.Table]:
    """The rows of each key of a partition that is sorted by ``keys``, a table for each."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        if not table.num_rows:
            continue
        starts = {0}
        for key in keys:
            column = table[key].combine_chunks()
            differs = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            starts.update((differs.nonzero()[0] + 1).tolist())
        bounds = sorted(starts)
        for begin, end in zip(bounds[:-1], bounds[1:]):
            yield table.slice(begin, end - begin)
        rest = table.slice(bounds[-1])
    if rest is not None and rest.num_rows:
        yield rest


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Makes this package known to the executors if they would not find it where they start."""
    package = Path(__file__).resolve().parent.parent
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    context = spark.sparkContext
    if str(package.parent) in map(os.path.realpath, paths) or context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="skyloom-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def bound_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by ``BATCH_BYTES``, unless it has a bound set already.

    Spark's own are 10,000 rows or 64 MB, so that a whole partition of texts is one batch: both sides
    hold it, with what is made of it, and processes that serve one job after another keep the room.
    Rows are not cut or left out.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no model may learn from: crc32 of the id as text leaves 2 modulo 4 (null id: no)."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def free_name(name: str, columns: list[str]) -> str:
    """A column name like ``name`` that none of the columns has."""
    taken = {column.lower() for column in columns}
    while name in taken:
        name += "_"
    return name


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of an edge in ``a, b``.

    Large-star and small-star rounds: every node hands its neighbours to its smallest one until
    each component is a star, which one aggregation by node tells. A round is two aggregations and
    two joins by node; minima are combined before the shuffle and a hub's edges are spread by the
    skew join. Rounds grow with the logarithm of the longest path. Every round is written to the
    shared folder, so a lost executor costs one round, and discarded after the next. Loops and
    repeated edges are harmless, an empty table gives none.
    """
    links = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    )
    links = written(links.distinct(), "links")
    for _ in range(max_rounds):
        if _all_stars(links):
            break
        links = _star_round(links)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    found = written(members.unionByName(roots), "components")
    discard(links)
    return found


def _all_stars(links: DataFrame) -> bool:
    """Whether every node is either linked with one smaller node, or with larger ones only."""
    ends = links.select(F.col("hi").alias("node"), F.lit(1).alias("upper")).unionByName(
        links.select(F.col("lo").alias("node"), F.lit(0).alias("upper"))
    )
    nodes = ends.groupBy("node").agg(F.sum("upper").alias("upper"), F.count("*").alias("ends"))
    return nodes.where("upper > 0 AND ends > 1").isEmpty()


def _star_round(links: DataFrame) -> DataFrame:
    """First every larger neighbour of a node is linked with the node's smallest neighbour or itself,
    then a node and its smaller neighbours with the smallest of them.

    The minima are written, so that both sides of a join are shuffled for it: only then is a hub
    split by the skew join.
    """
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    nearest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    nearest = written(nearest, "least")
    large = both.where(F.col("v") > F.col("u")).join(nearest, "u")
    large = written(
        large.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "links"
    )
    lowest = written(large.groupBy("hi").agg(F.min("lo").alias("m")), "least")
    moved = large.join(lowest, "hi").where(F.col("lo") != F.col("m"))
    small = moved.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(
        lowest.select("hi", F.col("m").alias("lo"))
    )
    small = written(small.distinct(), "links")
    discard(links, nearest, large, lowest)
    return small
