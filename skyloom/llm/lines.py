"""Line dedup with levelled sorted runs of line hashes.

The documents are taken in batches of descending ids. A batch's lines become a run: one row per
line key with the number of documents that hold it and the largest of their ids, sorted by key.
Before a run is added, keys that the earlier runs have settled already are merged away by an anti
join: a settled key was found in enough documents, and its largest id came in an earlier batch, so
nothing a later batch says about it matters. Runs gather in levels; whenever a level holds
``fanout`` runs, they are compacted into one run of the next level.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import SPACES, free_name
from skyloom.storage import discard, scratch_path, written

#: A null id counts as the smallest of all.
_NO_ID = -(2**63)


def line_hash(line: str, min_chars: int) -> bytes | None:
    """128 bits of a line's key; None if the key is shorter than ``min_chars`` code points."""
    key = line.strip(SPACES)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


def repeated_lines(
    docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = 4, fanout: int = 2
) -> DataFrame:
    """``doc, part, keys``: for each text of a document the keys of the lines it has to give up.

    ``part`` is a hash of the text: an id with very many rows has a list for each of its texts, none
    longer than the text.
    """
    lines = _line_table(docs, min_chars, batches)
    runs = LineRuns(min_docs, fanout)
    for number in range(batches):
        runs.add(lines.where(F.col("batch") == number).drop("batch"))
    doomed = (
        lines.drop("batch")
        .join(runs.settled(), "key")
        .where(F.col("doc") < F.col("last_doc"))
        .groupBy("doc", "part")
        .agg(F.collect_set("key").alias("keys"))
    )
    doomed = written(doomed, "lines-doomed")
    discard(lines, *(run for level in runs.levels for run in level))
    return doomed


class LineRuns:
    """The levels of runs; a run is a Parquet table in the shared folder, sorted by key."""

    def __init__(self, min_docs: int, fanout: int):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]

    def add(self, lines: DataFrame) -> None:
        """Adds a batch of ``key, doc`` rows; its ids must not exceed those of earlier batches."""
        run = (
            lines.select("key", "doc")
            .distinct()
            .groupBy("key")
            .agg(F.count("*").alias("docs"), F.max("doc").alias("last_doc"))
        )
        settled = self.settled()
        if settled is not None:
            run = run.join(settled.select("key"), "key", "left_anti")
        self.levels[0].append(self._sorted(run, 0))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._sorted(_merged(self.levels[level]), level + 1))
            discard(*self.levels[level])
            self.levels[level] = []
            level += 1

    def settled(self) -> DataFrame | None:
        """The keys found in enough documents, each with the largest id."""
        runs = [run for level in self.levels for run in level]
        if not runs:
            return None
        merged = runs[0] if len(runs) == 1 else _merged(runs)
        return merged.where(F.col("docs") >= self.min_docs).select("key", "last_doc")

    @staticmethod
    def _sorted(run: DataFrame, level: int) -> DataFrame:
        return written(run.sortWithinPartitions("key"), f"lines-level{level}")


def _merged(runs: list[DataFrame]) -> DataFrame:
    return (
        reduce(DataFrame.unionByName, runs)
        .groupBy("key")
        .agg(F.sum("docs").alias("docs"), F.max("last_doc").alias("last_doc"))
    )


def _line_table(docs: DataFrame, min_chars: int, batches: int) -> DataFrame:
    """``key, doc, part, batch``: a text's distinct line keys; batch 0 has the largest ids."""
    spark = docs.sparkSession
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc")
    shares = [(batches - i) / batches for i in range(1, batches)]
    bounds = docs.select(doc).agg(F.percentile_approx("doc", shares or [0.0], 1000)).first()[0]
    batch = F.lit(0)
    for bound in bounds or [] if batches > 1 else []:
        batch = batch + (F.col("doc") < bound).cast("int")

    def keys(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found, owners = [], []
            for row, text in enumerate(part["text"].to_pylist()):
                own = {line_hash(line, min_chars) for line in (text or "").split("\n")} - {None}
                found.extend(own)
                owners.extend([row] * len(own))
            owners = pa.array(owners, pa.int64())
            yield pa.record_batch(
                [pa.array(found, pa.binary()), part["doc"].take(owners), part["part"].take(owners)],
                ["key", "doc", "part"],
            )

    lines = docs.select(doc, F.xxhash64("text").alias("part"), F.col("text"))
    lines = lines.mapInArrow(keys, "key binary, doc long, part long")
    path = scratch_path(spark, "lines")
    lines.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    table = spark.read.schema("key binary, doc long, part long, batch int").parquet(path)
    table.written_to = path
    return table


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, **runs) -> DataFrame:
    """The documents with their repeated lines cut out, and ``n_lines``, ``n_dropped``.

    A line's key is the line without white space at its ends, in lower case (A-Z only). A key of
    at least ``min_chars`` code points found in at least ``min_docs`` documents keeps its lines in
    the largest ``doc_id`` alone; the other lines stay as they are, joined by line feeds.

    Null or empty text is one empty line and comes back as an empty text. Rows with the same
    ``doc_id`` count as one document, and so do rows without one, which rank below every id. A key
    that is repeated within one document counts once. All other columns pass through; columns
    named ``n_lines`` or ``n_dropped`` are replaced. An empty table gives an empty table.
    """
    doomed = repeated_lines(docs.select("doc_id", "text"), min_docs, min_chars, **runs)

    @F.arrow_udf("struct<text: string, n_lines: long, n_dropped: long>")
    def cut(texts: pa.Array, keys: pa.Array) -> pa.Array:
        kept, counts, dropped = [], [], []
        for text, gone in zip(texts.to_pylist(), keys.to_pylist()):
            text = text or ""
            if gone:
                gone, lines = set(gone), text.split("\n")
                left = [line for line in lines if line_hash(line, min_chars) not in gone]
                text, count, lost = "\n".join(left), len(lines), len(lines) - len(left)
            else:
                count, lost = text.count("\n") + 1, 0
            kept.append(text)
            counts.append(count)
            dropped.append(lost)
        columns = [pa.array(kept, pa.string()), pa.array(counts), pa.array(dropped)]
        return pa.StructArray.from_arrays(columns, ["text", "n_lines", "n_dropped"])

    passed = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    doc = F.coalesce(F.col("d.doc_id").cast("long"), F.lit(_NO_ID))
    # Repeated keys make the files of these lists far smaller than the lists, so their size on disk
    # is no ground for sending them to all executors.
    doomed = doomed.hint("merge")
    own = (doc == F.col("x.doc")) & (F.xxhash64("d.text") == F.col("x.part"))
    joined = docs.alias("d").join(doomed.alias("x"), own, "left")
    result = free_name("cut", passed)
    done = joined.select(
        *(F.col(f"d.`{c}`") for c in passed), cut(F.col("d.text"), F.col("x.keys")).alias(result)
    )
    done = done.select(*(F.col(f"`{c}`") for c in passed), f"{result}.*")
    order = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return done.select(*(F.col(f"`{c}`") for c in order), "n_lines", "n_dropped")
