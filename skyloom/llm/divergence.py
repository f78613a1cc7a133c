"""How far the word use of a language's sources differs, in exact whole numbers.

1. Texts that are equal within a language become one, with the number of its copies in each source.
2. Each is split into terms once. Its counts and documents, times the copies, are added up in the
   task for each source before they are shuffled.
3. Terms of enough documents are kept. A term that a source lacks has the source's least share there,
   so a pair of sources differs from ``V`` times the value of their least shares only by the terms that
   one of them has. Tasks work this out for blocks of terms and tiles of sources, and give one sum for
   each pair of sources.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.llm.shingles import text_blocks
from skyloom.llm.tokens import LETTERS, find_words, spelled
from skyloom.storage import discard, written

#: Rows of counts that a task adds up before it hands them on.
PENDING = 1_000_000
#: Kept counts in a block, and sources in a tile.
BLOCK, TILE = 250_000, 64
#: Pairs of counts that are worked on together in a task.
PAIRS = 1 << 20
#: Up to so many pairs of language and source are sent to all executors.
BROADCAST_GROUPS = 200_000


def source_divergence(docs: DataFrame, min_docs: int = 3, terms: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``: how sources differ, and by which terms.

    Terms are runs of letters and all beyond ASCII, A-Z in lower case; a language keeps the ``V``
    terms that are in at least ``min_docs`` of its documents (rows, copies included). The share of a term
    in a source, or in the language, is ``p = 1 + floor(10^9 * (count + 1) / (N + V))``, with ``N`` the
    sum of its counts of kept terms. ``f(p, q) = floor((p - q)^2 / q)``.

    Part ``pair``: every other source of the language is an ``item``, with ``f`` of the source's shares
    against the other's summed over all kept terms. Part ``term``: the ``terms`` highest ``f`` against
    the language's shares, of terms that the source has and whose share is higher there. Ranks go by
    falling value, then by the bytes of the item. All numbers are exact as long as ``N + V`` is
    below 9e15.

    Null texts, languages and sources count as empty text; a source without terms has pairs, but
    no terms, and a language without kept terms has pairs of value 0. A language with one source has
    no pairs. Repeated rows are documents of their own, ids and other columns are not read. An empty
    table gives no rows.
    """
    read = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))
    )
    counts = written(
        _collapsed(read)
        .mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "term-counts",
    )
    whole = (
        counts.groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs)
        .drop("docs")
    )
    whole = written(whole, "kept-terms")
    kept = written(
        counts.drop("docs").join(whole.hint("merge"), ["lang", "term"]), "kept-counts"
    )
    groups = written(_groups(read, kept, whole), "sources")
    shared = groups.select("lang", "source", "total", "lang_total", "blocks", "tiles")
    if groups.count() <= BROADCAST_GROUPS:
        shared = F.broadcast(shared)
    rows = kept.join(shared, ["lang", "source"]).withColumn("p", _share("n", "total"))
    found = written(
        _pairs(rows, groups).unionByName(_terms(rows, terms)), "source-divergence"
    )
    discard(counts, whole, kept, groups)
    return found


def _collapsed(read: DataFrame) -> DataFrame:
    """``lang, text, copies``: every different text of a language, with its copies by source."""
    read = read.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = (
        read.groupBy("lang", "digest", "source")
        .agg(F.count("*").alias("n"))
        .groupBy("lang", "digest")
        .agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    )
    texts = read.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(copies.hint("merge"), ["lang", "digest"]).select("lang", "text", "copies")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and documents of terms by source, added up over about ``PENDING`` rows."""
    pending = _Pending()
    for batch in batches:
        copies = batch["copies"]
        sizes = copies.value_lengths().to_numpy()
        begins = np.cumsum(sizes) - sizes
        flat = copies.flatten()
        sources, times = flat.field("source"), flat.field("n").to_numpy()
        langs = batch["lang"].take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
        own = pending.numbers(langs.to_pylist(), sources.to_pylist())
        for first, data, offsets in text_blocks(batch["text"]):
            words = find_words(data, offsets, LETTERS)
            if not len(words.hashes):
                continue
            terms, at, number = np.unique(words.hashes, return_index=True, return_inverse=True)
            held, n = np.unique(words.owner * len(terms) + number, return_counts=True)
            text, term = held // len(terms) + first, held % len(terms)
            each = sizes[text]  # every term of a text counts in each of its sources
            place = np.repeat(begins[text] - (np.cumsum(each) - each), each)
            place += np.arange(len(place))
            pending.add(
                own[place], terms[np.repeat(term, each)], times[place] * np.repeat(n, each),
                times[place],
            )
            pending.spell(terms, spelled(data, words.starts[at], words.ends[at]))
            if pending.rows >= PENDING:
                yield pending.taken()
    if pending.rows:
        yield pending.taken()


class _Pending:
    """Counts that wait to be added up, and the spelling of their terms."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.clear()

    def clear(self) -> None:
        self.rows = 0
        self.counts: list[tuple[np.ndarray, ...]] = []
        self.spellings: list[tuple[np.ndarray, pa.Array]] = []

    def numbers(self, langs: list[str], sources: list[str]) -> np.ndarray:
        known = self.groups
        return np.array([known.setdefault(g, len(known)) for g in zip(langs, sources)], np.int64)

    def add(self, *columns: np.ndarray) -> None:
        columns = _added(*columns)
        self.counts.append(columns)
        self.rows += len(columns[0])

    def spell(self, hashes: np.ndarray, terms: pa.Array) -> None:
        self.spellings.append((hashes, terms))

    def taken(self) -> pa.RecordBatch:
        group, term, n, docs = _added(*(np.concatenate(c) for c in zip(*self.counts)))
        hashes, first = np.unique(
            np.concatenate([h for h, _ in self.spellings]), return_index=True
        )
        terms = pa.concat_arrays([t for _, t in self.spellings]).take(pa.array(first))
        names = list(self.groups)
        langs = pa.array([lang for lang, _ in names]).take(pa.array(group))
        sources = pa.array([source for _, source in names]).take(pa.array(group))
        terms = terms.take(pa.array(np.searchsorted(hashes, term))).cast(pa.string())
        self.clear()
        return pa.record_batch(
            [langs, sources, terms, pa.array(n), pa.array(docs)],
            ["lang", "source", "term", "n", "docs"],
        )


def _added(group, term, n, docs) -> tuple[np.ndarray, ...]:
    """Rows of equal group and term made one."""
    order = np.lexsort((term, group))
    group, term = group[order], term[order]
    new = np.ones(len(group), bool)
    new[1:] = (group[1:] != group[:-1]) | (term[1:] != term[:-1])
    begins = np.flatnonzero(new)
    return (
        group[begins], term[begins],
        np.add.reduceat(n[order], begins), np.add.reduceat(docs[order], begins),
    )


def _groups(read: DataFrame, kept: DataFrame, whole: DataFrame) -> DataFrame:
    """Every language and source, with ``N + V``, ``V`` and how its work is cut."""
    languages = whole.groupBy("lang").agg(
        F.count("*").alias("size"), F.sum("lang_n").alias("lang_n")
    )
    held = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    size, n = F.coalesce("size", F.lit(0)), F.coalesce("n", F.lit(0))
    groups = (
        read.select("lang", "source").distinct()
        .join(held, ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .select(
            "lang", "source", size.alias("size"), (n + size).alias("total"),
            (F.coalesce("lang_n", F.lit(0)) + size).alias("lang_total"),
            F.coalesce("rows", F.lit(0)).alias("rows"),
        )
    )
    cut = groups.groupBy("lang").agg(
        F.ceil(F.sum("rows") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count("*") / TILE).cast("int").alias("tiles"),
    )
    return groups.join(cut, "lang")


def _share(count: str, total: str):
    """``1 + floor(10^9 * (count + 1) / total)`` by long division, three digits at a time."""
    rest, share = f"({count} + 1)", ""
    for scale in (10**9, 10**6, 10**3, 1):
        share += f" + ({rest} div {total}) * {scale}"
        rest = f"({rest} % {total} * 1000)"
    return F.expr(f"1{share}")


def _difference(p: str, q: str):
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _terms(rows: DataFrame, terms: int) -> DataFrame:
    """The terms that a source uses more than its language does."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        rows.withColumn("q", _share("lang_n", "lang_total"))
        .where("p > q")
        .select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
            _difference("p", "q").alias("value"),
        )
        .withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= terms)
    )


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Every pair of sources of a language, in both directions."""
    least = groups.where("size > 0").withColumn("p", _share("0L", "total"))
    tile = F.pmod(F.xxhash64("source"), "tiles").cast("int")
    # Every block gets each source once without a term, for its least share.
    marks = least.select(
        "lang", "source", F.lit(None).cast("string").alias("term"), "p", "tiles",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    block = F.pmod(F.xxhash64("term"), "blocks").cast("int")
    placed = rows.select("lang", "source", "term", "p", "tiles", block.alias("block"))
    placed = (
        placed.unionByName(marks)
        .withColumn("tile", tile)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "lang", "block", F.least("tile", "other").alias("x"),
            F.greatest("tile", "other").alias("y"), "tile", "source", "term", "p",
        )
    )
    beyond = (
        placed.groupBy("lang", "block", "x", "y")
        .applyInArrow(pair_sums, "lang string, source string, item string, beyond long")
        .groupBy("lang", "source", "item")
        .agg(F.sum("beyond").alias("beyond"))
    )
    least = groups.select(
        "lang", "source", "size",
        F.when(F.col("size") > 0, _share("0L", "greatest(total, 1L)")).otherwise(1).alias("p"),
    )
    others = least.select("lang", F.col("source").alias("item"), F.col("p").alias("q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    base = F.col("size") * _difference("p", "q")
    return (
        least.join(others, "lang")
        .where(F.col("source") != F.col("item"))
        .join(beyond.hint("merge"), ["lang", "source", "item"], "left")
        .select(
            "lang", "source", F.lit("pair").alias("part"), "item",
            (base + F.coalesce("beyond", F.lit(0))).alias("value"),
        )
        .withColumn("rank", F.row_number().over(order).cast("int"))
    )


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def pair_sums(block: pa.Table) -> pa.Table:
    """What the terms of a block add to the pairs of its sources, beyond their least shares.

    A term that both have adds ``f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)``; each that the one has
    adds ``f(p, q0) - f(p0, q0)``, each that the other has ``f(p0, q) - f(p0, q0)``. Sums are whole
    numbers modulo 2^64, so their total is exact.
    """
    marks = block.filter(pa.compute.is_null(block["term"])).sort_by("source")
    names = marks["source"].combine_chunks()
    least, tiles = marks["p"].to_numpy(), marks["tile"].to_numpy()
    terms = block.filter(pa.compute.is_valid(block["term"]))
    count = len(names)
    own = pa.compute.index_in(terms["source"].combine_chunks(), names).to_numpy()
    p = terms["p"].to_numpy()
    sums = np.zeros((count, count), np.int64)
    # Terms of one source, those of equal share at once.
    lowest = _f(least[:, None], least[None, :])
    for source in range(count):
        shares, often = np.unique(p[own == source], return_counts=True)
        shares, often = shares[:, None], often[:, None]
        sums[source] += (often * (_f(shares, least[None, :]) - lowest[source])).sum(axis=0)
        sums[:, source] += (often * (_f(least[None, :], shares) - lowest[:, source])).sum(axis=0)
    # Terms that several have.
    code = terms["term"].combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.argsort(code, kind="stable")
    code, own, p = code[order], own[order], p[order]
    begins = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else code
    sizes = np.diff(np.append(begins, len(code)))
    done = 0
    reach = np.cumsum(sizes.astype(np.int64) ** 2)
    flat = sums.reshape(-1)
    while done < len(sizes):
        used = reach[done - 1] if done else 0
        last = max(done + 1, int(np.searchsorted(reach, used + PAIRS, side="right")))
        part, start = sizes[done:last], begins[done:last]
        left = np.repeat(np.repeat(start, part) + _inside(part), np.repeat(part, part))
        right = np.repeat(start, part * part) + _inside(np.repeat(part, part))
        a, b = own[left], own[right]
        value = _f(p[left], p[right]) - _f(p[left], least[b]) - _f(least[a], p[right])
        np.add.at(flat, a * count + b, value + _f(least[a], least[b]))
        done = last
    a, b = np.nonzero(~np.eye(count, dtype=bool))
    x, y = block["x"][0].as_py(), block["y"][0].as_py()
    wanted = (np.minimum(tiles[a], tiles[b]) == x) & (np.maximum(tiles[a], tiles[b]) == y)
    a, b = a[wanted], b[wanted]
    lang = pa.array([block["lang"][0].as_py()] * len(a), pa.string())
    return pa.table(
        [lang, names.take(pa.array(a)), names.take(pa.array(b)), pa.array(sums[a, b])],
        ["lang", "source", "item", "beyond"],
    )


def _inside(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive stretches."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
