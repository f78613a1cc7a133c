"""From raw documents to packed training sequences, in five stages.

Every stage takes what the one before kept. All but the last return the columns of ``documents``;
the last returns the pieces and their places in the sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import langid, lines, minhash, packing, quality
from skyloom.llm.common import bound_batches, ship, table
from skyloom.storage import discard, written


def _prepare(spark: SparkSession) -> None:
    """The stages run one after another in the same processes, so none may leave them large."""
    ship(spark)
    bound_batches(spark)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language; those without letters or far from all centroids go.

    Null, empty and blank texts have no letters. Rows with a null or repeated ``doc_id`` are judged by
    their own texts. All columns pass through; an empty table gives an empty table.
    """
    _prepare(spark)
    return langid.keep_identified(docs)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose nearest labelled neighbours are good.

    Rows with a null or repeated ``doc_id`` are judged by their own texts, null texts as empty ones. All
    columns pass through; an empty table gives an empty table.
    """
    _prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines out of the texts; ``n_chars`` follows the text, where there is one.

    A document of which the cut leaves no word goes, as all it held stands in other documents. Rows
    that repeat a ``doc_id`` are one document, and so are those that have none.
    """
    _prepare(spark)
    found = lines.dedup_lines(docs)
    word = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = found.where(word | (F.col("n_dropped") == 0))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*(F.col(f"`{c}`") for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest id.

    Rows that repeat a ``doc_id`` are one document and stay together, rows without one stay.
    """
    _prepare(spark)
    groups = minhash.near_duplicates(docs)
    copies = groups.where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts' ids into sequences of at most 1024.

    Null and empty texts are an end id alone; every row is a document, also with a null or repeated
    ``doc_id``. An empty table gives no pieces.
    """
    _prepare(spark)
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_id),
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("packing", pack),
]

#: Models, sketches and token ids are beyond SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``; what a stage keeps is written as Parquet and read again."""
    docs, stored = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
        discard(*stored)
        stored = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
