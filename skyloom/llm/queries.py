"""The corpus queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import (
    decontaminate, divergence, langid, licenses, lines, minhash, neighbours, packing, pages, pieces,
    quality, topk, whitening,
)
from skyloom.llm.common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return build

    return keep


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Lines of the table ``{docs}``, one row each, with key, number and whether they are dropped.
LINES_SQL = f"""
    line_rows AS (
        SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS line_no
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {{docs}})
    ),
    keyed AS (
        SELECT *, translate(
            trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
            '{_UPPER}', '{_LOWER}') AS line_key
        FROM line_rows
    ),
    repeated AS (
        SELECT line_key, max(doc_id) AS last_doc FROM keyed WHERE length(line_key) >= 20
        GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3
    ),
    marked AS (
        SELECT k.*, r.line_key IS NOT NULL AND k.doc_id <> r.last_doc AS dropped
        FROM keyed k LEFT JOIN repeated r USING (line_key)
    ),
    kept_lines AS (
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
            coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT dropped), '')
                AS kept
        FROM marked GROUP BY doc_id
    )
"""


@query(
    "op7_line_dedup",
    f"WITH {LINES_SQL.format(docs='documents')}"
    " SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM kept_lines",
)
def _(spark, sf_dir):
    done = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query("op5_packing")
def _(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces_of = packing.pack(table(spark, sf_dir, "documents"), path)
    return pieces_of.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


@query("op9_piece_encoding")
def _(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = pieces.encode(table(spark, sf_dir, "documents"), path)
    numbers = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op10_page_text")
def _(spark, sf_dir):
    done = pages.main_text(table(spark, sf_dir, "pages"))
    return done.withColumn("n_chars", F.length("text").cast("long"))


#: All pairs that share a shingle, and what is reachable by their links.
NEAR_SQL = f"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(
            string_split_regex(
                translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'),
            lambda w: w <> '') AS w
        FROM documents
    ),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN []
            WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(
                generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')))
            END AS s
        FROM words
    ),
    sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM sets),
    items AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
        FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * common >= 75 * (x.n_shingles + y.n_shingles - common)
    ),
    ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION
        SELECT r.a, w.b FROM reached r JOIN ways w ON r.b = w.a
    ),
    lowest AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
    SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept
    FROM sizes JOIN lowest USING (doc_id)
"""


@query("op1_near_dedup", NEAR_SQL)
def _(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_language_id")
def _(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op2_quality")
def _(spark, sf_dir):
    return quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(
    "op4_vector_dedup",
    """
    WITH RECURSIVE usable AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
            ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE list_cosine_similarity(a.v, b.v) >= 0.9
    ),
    reached AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings
        UNION
        SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
    ),
    lowest AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
    counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
    SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM lowest LEFT JOIN counted USING (vec_id)
    """,
)
def _(spark, sf_dir):
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


@query(
    "op3_top_products",
    """
    WITH whole AS (
        SELECT DISTINCT vec_id, list_transform(
            embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
            CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM whole q JOIN whole c
            ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    ),
    ranked AS (
        SELECT *, CAST(row_number() OVER (
            PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def _(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_products(vectors, vectors.where("vec_id % 50 = 0"))


@query("op8_license_scan")
def _(spark, sf_dir):
    return licenses.license_passages(table(spark, sf_dir, "documents"))


DIVERGENCE_SQL = f"""
    WITH docs AS (
        SELECT coalesce(text, '') AS text, coalesce(lang, '') AS lang,
            coalesce(source, '') AS source, row_number() OVER () AS doc
        FROM documents
    ),
    words AS (
        SELECT doc, lang, source, unnest(regexp_extract_all(
            translate(text, '{_UPPER}', '{_LOWER}'),
            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM docs
    ),
    kept AS (
        SELECT lang, term, count(*) AS n FROM words
        GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
    ),
    langs AS (SELECT lang, count(*) AS size, sum(n) AS total FROM kept GROUP BY lang),
    counts AS (
        SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term)
        GROUP BY ALL
    ),
    sources AS (
        SELECT lang, source, coalesce(sum(n), 0) AS total
        FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source)
        GROUP BY ALL
    ),
    shares AS (
        SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
            1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (s.total + l.size) AS p,
            1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + l.size) AS lang_p
        FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang)
            LEFT JOIN counts c ON (c.lang, c.source, c.term) = (s.lang, s.source, k.term)
    ),
    sums AS (
        SELECT a.lang, a.source, b.source AS item,
            sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL
    ),
    rows AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON (s.lang, s.source, s.item) = (a.lang, a.source, b.source)
        UNION ALL
        SELECT lang, source, 'term', term, (p - lang_p) * (p - lang_p) // lang_p
        FROM shares WHERE n > 0 AND p > lang_p
    )
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
        CAST(row_number() OVER (
            PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM rows QUALIFY part = 'pair' OR rank <= 200
"""


@query("op11_source_divergence", DIVERGENCE_SQL)
def _(spark, sf_dir):
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


@query("op12_whitening")
def _(spark, sf_dir):
    done = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # NULL where the exact number does not fit; the operator has it in full.
    return done.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


_ITEM_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Every window of the items looked up among all runs of its length in the documents.
LEAKS_SQL = f"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ITEM_WORD}') AS w
        FROM documents
    ),
    items AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_ITEM_WORD}') AS w
        FROM benchmark
    ),
    windows AS (
        SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS words
        FROM (
            SELECT *, unnest(generate_series(1, len(w) - size + 1)) AS i
            FROM (SELECT *, least(len(w), 10) AS size FROM items WHERE len(w) > 0)
        )
    ),
    runs AS (
        SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS words
        FROM (
            SELECT *, unnest(generate_series(1, len(w) - size + 1)) AS i
            FROM words JOIN (SELECT DISTINCT size FROM windows) ON len(w) >= size
        )
    ),
    found AS (SELECT doc_id, size, i, item_id FROM runs JOIN windows USING (size, words)),
    hit AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS place FROM found)
        GROUP BY doc_id
    ),
    held AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
        coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AS contaminated
    FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""


@query("op13_decontamination", LEAKS_SQL)
def _(spark, sf_dir):
    done = decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return done.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
