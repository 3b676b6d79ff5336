"""Registered queries of the operators, each over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.archives import archived_pages
from tessera.llm.decontamination import decontaminate
from tessera.llm.flat_tokens import token_counts
from tessera.llm.language import identify
from tessera.llm.lines import linked_lines
from tessera.llm.minhash import near_duplicates
from tessera.llm.pieces import encode_decode
from tessera.llm.quality import quality
from tessera.llm.registry import query, table
from tessera.llm.repeats import remove_repeats
from tessera.llm.spelling import spelling_variants
from tessera.llm.topk import top_k
from tessera.llm.urls import judge_urls, labelled_urls
from tessera.llm.whitening import whiten

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query()
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(table(spark, sf_dir, "documents"), PIECES)


@query(
    """
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html FROM pages
    ), f AS (
        SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
               min(page_id) OVER (PARTITION BY html) AS first_id
        FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit'
                ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM f
    """
)
def op5_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages")).drop("target", "date")


@query()
def op6_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), PIECES)


@query()
def op8_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), PIECES).select("doc_id", "n_tokens")


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


# Fixed values of the query: (action, host and path).
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query()
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES, labelled_urls(spark))


@query(
    r"""
    WITH docs AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'),
                   '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws
        FROM documents
    ), items AS (
        SELECT item_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'),
                   '[0-9a-z\x{80}-\x{10FFFF}]+') AS ws
        FROM benchmark
    ), starts AS (
        SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, greatest(len(ws) - 8, 2))) AS s
        FROM items WHERE len(ws) > 0
    ), windows AS (
        SELECT DISTINCT item_id, n, array_to_string(ws[s:s + n - 1], ' ') AS w FROM starts
    ), sizes AS (
        SELECT DISTINCT n FROM windows
    ), spots AS (
        SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s
        FROM docs, sizes WHERE len(ws) >= n
    ), hits AS (
        SELECT doc_id, s, spots.n, item_id
        FROM spots JOIN windows
          ON spots.n = windows.n AND array_to_string(ws[s:s + spots.n - 1], ' ') = w
    ), hit_words AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT DISTINCT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
    ), hit_items AS (
        SELECT doc_id, count(DISTINCT item_id) AS n_items,
               array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS ids
        FROM hits GROUP BY doc_id
    )
    SELECT docs.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """
)
def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op10_similarity_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@query()
def op4_column_wise_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query()
def op3_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    keys = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("content"))
    found = linked_lines(docs).withColumnRenamed("doc_id", "l_id").withColumnRenamed("content", "l_content")
    same = (F.col("content") == F.col("l_content")) & F.col("doc_id").eqNullSafe(F.col("l_id"))
    return keys.join(found, same, "left").select(
        "doc_id",
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        "removed",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        "linked",
    )


@query(
    r"""
    WITH RECURSIVE entries AS (
        SELECT list(list_reduce(list_prepend(i, range(8)),
               lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
        FROM range(256) r(i)
    ), runs AS (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
               unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run
        FROM documents
    ), coded AS (
        SELECT run, hex(encode(id || ':' || run)) AS h FROM runs WHERE length(run) >= 7
    ), digests AS (
        SELECT run, xor(list_reduce(list_prepend(4294967295::BIGINT,
                   list_transform(range(1, length(h), 2), lambda k: CAST('0x' || h[k:k + 1] AS BIGINT))),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS d
        FROM coded, entries
    ), words AS (
        SELECT CASE WHEN d % 31 = 0 THEN run[:d % length(run)] || run[d % length(run) + 2:]
                    ELSE run END AS word
        FROM digests
    ), counted AS (
        SELECT word, count(*) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
    ), cuts AS (
        SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM counted
    ), holes AS (
        SELECT word, n, p, word[:p - 1] || word[p + 1:] AS rest FROM cuts
    ), replaced AS (
        SELECT a.word, b.word AS near, b.n AS near_n
        FROM holes a JOIN holes b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
    ), shorter AS (
        SELECT DISTINCT h.word, h.n, c.word AS near, c.n AS near_n
        FROM holes h JOIN counted c ON h.rest = c.word
    ), links AS (
        SELECT word, near, near_n FROM replaced
        UNION SELECT word, near, near_n FROM shorter
        UNION SELECT near, word, n FROM shorter
    ), best AS (
        SELECT word, count(*) AS n_near, max(near_n) AS most FROM links GROUP BY word
    ), top AS (
        SELECT links.word, min(near) AS near
        FROM links JOIN best ON links.word = best.word AND near_n = most GROUP BY links.word
    ), judged AS (
        SELECT c.word, CASE WHEN most >= 10 * n THEN near END AS form, n,
               coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * n THEN most END AS form_n
        FROM counted c LEFT JOIN best ON c.word = best.word LEFT JOIN top ON c.word = top.word
    ), chains AS (
        SELECT word, word AS root FROM judged
        UNION ALL
        SELECT chains.word, form FROM chains JOIN judged ON judged.word = root WHERE form IS NOT NULL
    ), ends AS (
        SELECT chains.word, root FROM chains JOIN judged ON judged.word = root WHERE form IS NULL
    )
    SELECT judged.word, form, root, n, n_near, form_n FROM judged JOIN ends ON judged.word = ends.word
    """
)
def op11_letter_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


@query(
    """
    WITH scaled AS (
        SELECT row_number() OVER () AS r, vec_id,
               list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS w
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), terms AS (
        SELECT r, vec_id, unnest(w) AS weight, unnest(range(len(w))) AS term FROM scaled
    ), products AS (
        SELECT q.r, c.r AS other, sum(CAST(q.weight * c.weight AS HUGEINT)) AS score
        FROM terms q JOIN terms c ON q.term = c.term WHERE q.vec_id % 50 = 0 GROUP BY q.r, c.r
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id,
               CAST(coalesce(score, 0) AS BIGINT) AS score,
               row_number() OVER (PARTITION BY q.r
                   ORDER BY coalesce(score, 0) DESC, c.vec_id NULLS LAST, c.r) AS rank
        FROM scaled q JOIN scaled c ON q.vec_id % 50 = 0 AND q.r <> c.r
        LEFT JOIN products p ON p.r = q.r AND p.other = c.r
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM scored WHERE rank <= 5
    """
)
def op12_term_at_a_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


@query()
def op13_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
