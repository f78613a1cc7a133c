"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

1. Every text becomes its set of word shingles and a sketch of it (``shingles.sketches``); bands of
   sketch coordinates are the bucket keys. Documents with the same set form a class; from here on
   one row stands for each class.
2. Every bucket names its smallest member as pivot and each member is compared with it on full
   sets. A large group of near copies is settled by as many comparisons as it has members.
3. Buckets that still hold members of different components are searched in full, in blocks of
   bounded size inside tasks: pairs of one component are skipped, a pair is looked at only in the
   first bucket that it shares, and what leaves a task is a spanning forest of the links found.
   A component that fills blocks of its own meets the others' blocks only, so a large group of near
   copies with a few strangers in its bucket costs as many copies of sets as there are strangers.
4. The links' connected components are the groups. Links of step 3 join components of step 2, so
   only a graph of those components is left to settle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm import shingles
from skyloom.llm.common import components, sorted_groups
from skyloom.storage import discard, written

#: Up to so many ids of documents to read again are sent to all executors (8 bytes each).
BROADCAST_IDS = 4_000_000
#: A bucket is searched in blocks of about so many members.
BLOCK = 512


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 75, bands: int = 32, rows: int = 4
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: the near-duplicate group of every document.

    Two documents are linked if their sets of ``words``-word shingles (A-Z in lower case, split at
    ASCII white space; fewer words are one shingle) have ``100 * common >= percent * union``. Sets
    are sets of 64-bit hashes. Every link that is reported was confirmed on full sets; a pair right
    at the threshold shares no bucket with probability ``(1 - s**rows) ** bands``, which is 5e-6 for
    the defaults and falls fast above it.

    ``component_id`` is the smallest id reachable by links, ``kept`` whether that is the document
    itself. Null, empty and blank texts have no shingles and are linked with nothing. Rows that
    share a ``doc_id`` are one document, linked through any of their texts; each row comes back. A
    null ``doc_id`` has null in ``component_id`` and ``kept``. Other columns are left out. An empty
    table gives no rows. The result is read from a table in the shared folder; all else is discarded.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(_signatures(docs, words, bands, rows), "minhash")
    classes = written(
        signed.where("class IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("class")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")),
        "minhash-classes",
    )
    buckets = classes.select("rep", "class", F.explode("bands").alias("bucket"))
    pivots = (
        buckets.groupBy("bucket")
        .agg(F.min(F.struct("rep", "class")).alias("pivot"), F.count("*").alias("members"))
        .where("members > 1")
    )
    members = written(buckets.join(pivots, "bucket"), "minhash-members")
    sets = _sets(docs, members.select("rep", "class").distinct(), words)
    stars = members.where("rep <> pivot.rep").select(
        "rep", "class", F.col("pivot.rep").alias("pivot"), F.col("pivot.class").alias("pivot_class")
    )
    links = written(_confirmed(stars.distinct(), sets, percent), "minhash-links")
    copies = (
        signed.join(classes.select("class", "rep"), "class")
        .where("doc_id <> rep")
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    )
    known = components(links.unionByName(copies))
    more = _within_buckets(members, classes, sets, known, percent)
    merged = components(more)
    whole = merged.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    groups = (
        known.join(whole.hint("merge"), "component", "left")
        .select("node", F.coalesce("whole", "component").alias("component"))
        .unionByName(merged)
        .groupBy(F.col("node").alias("doc_id"))
        .agg(F.min("component").alias("component"))
    )
    found = signed.select("doc_id", "n_shingles").join(groups.hint("merge"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    found = found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (F.col("doc_id") == component).alias("kept"),
    )
    found = written(found, "near-duplicates")
    discard(signed, classes, members, sets, links, known, more, merged)
    return found


def _signatures(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, n_shingles, class, bands``; no class and bands for a text without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in shingles.text_blocks(batch["text"]):
                sets, starts = shingles.shingle_sets(data, offsets, words)
                sizes = np.diff(starts)
                sketch = shingles.sketches(sets, starts, bands * rows)
                keys = shingles.band_keys(sketch, bands).view(np.int64)
                classes = _classes(sets, starts)
                empty = pa.array(sizes == 0)
                lists = pa.ListArray.from_arrays(
                    np.arange(len(sizes) + 1, dtype=np.int32) * bands, keys.reshape(-1)
                )
                none = pa.scalar(None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"][first : first + len(sizes)],
                        pa.array(sizes, pa.int64()),
                        pa.compute.if_else(empty, none.cast(pa.binary()), classes),
                        pa.compute.if_else(empty, none.cast(lists.type), lists),
                    ],
                    ["doc_id", "n_shingles", "class", "bands"],
                )

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, class binary, bands array<long>")


def _classes(sets: np.ndarray, starts: np.ndarray) -> pa.Array:
    """16 bytes that tell sets apart."""
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(16), len(starts) - 1, [None, pa.py_buffer(shingles.digests(sets, starts).tobytes())]
    ).cast(pa.binary())


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``class, shingles`` of the wanted ``rep, class``, worked out again from their texts."""
    classes = written(wanted, "minhash-wanted")
    ids = classes.select(F.col("rep").alias("doc_id")).distinct()
    wanted = F.broadcast(ids) if classes.count() <= BROADCAST_IDS else ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in shingles.text_blocks(batch["text"]):
                sets, starts = shingles.shingle_sets(data, offsets, words)
                lists = pa.ListArray.from_arrays(starts.astype(np.int32), sets.view(np.int64))
                yield pa.RecordBatch.from_arrays([_classes(sets, starts), lists], ["class", "shingles"])

    chosen = docs.join(wanted, "doc_id", "left_semi").select("text")
    sets = chosen.mapInArrow(read, "class binary, shingles array<long>")
    # Rows that repeat a document hold its set again, or that of a class that another one stands for.
    own = sets.where("size(shingles) > 0").dropDuplicates(["class"])
    sets = written(
        own.join(classes.select("class").hint("merge"), "class", "left_semi"), "minhash-sets"
    )
    discard(classes)
    return sets


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``rep, pivot`` whose classes' sets are similar enough, as ``a, b``."""
    own = sets.select("class", F.col("shingles").alias("own"))
    other = sets.select(F.col("class").alias("pivot_class"), F.col("shingles").alias("other"))
    common = F.size(F.array_intersect("own", "other"))
    union = F.size("own") + F.size("other") - common
    return (
        pairs.join(own, "class")
        .join(other, "pivot_class")
        .where(100 * F.least(F.size("own"), F.size("other"))
               >= percent * F.greatest(F.size("own"), F.size("other")))
        .where(100 * common >= percent * union)
        .select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
    )


def _within_buckets(
    members: DataFrame, classes: DataFrame, sets: DataFrame, known: DataFrame, percent: int
) -> DataFrame:
    """Pairs ``a, b`` of known components that a link within a bucket joins."""
    # Sent to all executors at small sizes only, this would hide what the join costs at others.
    known = known.select(F.col("node").alias("rep"), "component").hint("merge")
    placed = members.join(known, "rep", "left").select(
        "bucket", "rep", "class", F.coalesce("component", "rep").alias("component")
    )
    divided = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("bucket")
    )
    placed = written(placed.join(divided, "bucket"), "minhash-divided")
    rows = placed.join(_chunks(placed).hint("merge"), ["bucket", "component"]).join(
        classes.select("class", "bands"), "class"
    )
    chunk = F.col("first") + F.pmod(F.xxhash64("class"), F.col("own")).cast("int")
    rows = rows.withColumn("chunk", chunk).withColumn(
        "other",
        F.explode(
            F.filter(
                F.sequence(F.lit(0), F.col("chunks") - 1),
                lambda c: ~F.col("alone") | (c < F.col("first")) | (c >= F.col("first") + F.col("own")),
            )
        ),
    )
    keys = ["bucket", "x", "y"]
    rows = (
        rows.withColumn("x", F.least("chunk", "other"))
        .withColumn("y", F.greatest("chunk", "other"))
        .join(sets, "class")
        .select(*keys, "chunk", "class", "component", "bands", "shingles")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "class")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in sorted_groups(batches, keys):
            links = block_links(block, percent)
            if links:
                yield pa.record_batch(
                    [pa.array(side, pa.int64()) for side in zip(*links)], ["a", "b"]
                )

    links = written(rows.mapInArrow(search, "a long, b long").distinct(), "minhash-links")
    discard(placed)
    return links


def _chunks(placed: DataFrame) -> DataFrame:
    """``bucket, component, alone, first, own, chunks``: where the components of a bucket go. Those
    of more than ``BLOCK`` members are ``alone`` in ``own`` chunks from ``first`` on, the others
    share the first chunks; ``chunks`` counts all of the bucket."""
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    sizes = sizes.withColumn("alone", F.col("size") > BLOCK)
    blocks = F.ceil(F.col("size") / BLOCK)
    whole = sizes.groupBy("bucket").agg(
        F.ceil(F.sum(F.when(F.col("alone"), 0).otherwise(F.col("size"))) / BLOCK).alias("shared"),
        F.sum(F.when(F.col("alone"), blocks).otherwise(0)).alias("more"),
    )
    own = F.when(F.col("alone"), blocks).otherwise(F.col("shared")).cast("int")
    # Large components only are numbered: a row for at least BLOCK members.
    before = Window.partitionBy("bucket").orderBy("component").rowsBetween(
        Window.unboundedPreceding, -1
    )
    numbered = sizes.where("alone").select(
        "bucket", "component", F.coalesce(F.sum(blocks).over(before), F.lit(0)).alias("earlier")
    )
    first = F.when(F.col("alone"), F.col("shared") + F.col("earlier")).otherwise(0).cast("int")
    return (
        sizes.join(whole.hint("merge"), "bucket")
        .join(numbered.hint("merge"), ["bucket", "component"], "left")
        .select(
            "bucket", "component", "alone", first.alias("first"), own.alias("own"),
            (F.col("shared") + F.col("more")).cast("int").alias("chunks"),
        )
    )


def block_links(block: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Pairs of components, a spanning forest of those that links among a block's members join."""
    count = block.num_rows
    component = block["component"].to_numpy().copy()
    if (component == component[0]).all():
        return []
    label, chunk = component.copy(), block["chunk"].to_numpy()
    bands = np.array(block["bands"].combine_chunks().flatten()).reshape(count, -1)
    this = int(np.flatnonzero(bands[0] == block["bucket"][0].as_py())[0])
    lists = block["shingles"].combine_chunks()
    sizes = lists.value_lengths().to_numpy()
    ends = np.cumsum(sizes)
    tokens = np.unique(lists.flatten().to_numpy(), return_inverse=True)[1]
    marked = np.zeros(int(tokens.max()) + 1, bool)
    crossed = block["x"][0].as_py() != block["y"][0].as_py()
    links = []
    for i in range(count - 1):
        later = np.arange(i + 1, count)
        fits = component[later] != component[i]
        fits &= 100 * np.minimum(sizes[later], sizes[i]) >= percent * np.maximum(
            sizes[later], sizes[i]
        )
        if crossed:
            fits &= chunk[later] != chunk[i]
        later = later[fits]
        if this and len(later):
            later = later[~(bands[later, :this] == bands[i, :this]).any(axis=1)]
        if not len(later):
            continue
        own = tokens[ends[i] - sizes[i] : ends[i]]
        marked[own] = True
        total = sizes[later]
        starts = np.cumsum(total) - total
        places = np.repeat(ends[later] - total - starts, total) + np.arange(int(total.sum()))
        common = np.add.reduceat(marked[tokens[places]].astype(np.int64), starts)
        marked[own] = False
        linked = later[100 * common >= percent * (sizes[i] + total - common)]
        for j in linked.tolist():
            if component[j] != component[i]:
                links.append((int(label[i]), int(label[j])))
                component[component == component[j]] = component[i]
    return links
