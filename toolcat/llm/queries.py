"""The registered queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from toolcat.llm.common import table
from toolcat.llm.exact_dedup import exact_dedup
from toolcat.llm.html_text import main_text
from toolcat.llm.lexical import ranked_search
from toolcat.llm.line_dedup import line_dedup
from toolcat.llm.packing import pack
from toolcat.llm.pieces import sample_pieces
from toolcat.llm.pii import pii
from toolcat.llm.prefix_parse import remove_repeats
from toolcat.llm.simhash import simhash_groups
from toolcat.llm.token_counts import token_counts
from toolcat.llm.topk import exact_topk
from toolcat.llm.toxicity import toxicity
from toolcat.llm.word_runs import periodic_runs, run_digests, spread


def op1_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents"))


def op3_html_text(spark, sf_dir):
    return main_text(table(spark, sf_dir, "pages"))


def op4_pii(spark, sf_dir):
    return pii(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents"))


def op6_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))


def op7_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return exact_topk(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark, sf_dir):
    return sample_pieces(table(spark, sf_dir, "documents"), k=2)


def op11_repeated_bytes(spark, sf_dir):
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_periodic_runs(spark, sf_dir):
    return run_digests(periodic_runs(table(spark, sf_dir, "documents"), prepare=spread))


def op13_ranked_search(spark, sf_dir):
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_simhash": op2_simhash,
        "op3_html_text": op3_html_text,
        "op4_pii": op4_pii,
        "op5_line_dedup": op5_line_dedup,
        "op6_packing": op6_packing,
        "op7_topk": op7_topk,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_token_counts": op9_token_counts,
        "op10_sentencepiece": op10_sentencepiece,
        "op11_repeated_bytes": op11_repeated_bytes,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_ranked_search": op13_ranked_search,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_topk": """
            WITH v AS (
                SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
                FROM embeddings
                WHERE embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            ), s AS (
                SELECT q.vec_id AS query_id, c.vec_id,
                       CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
                FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
            )
            SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
            FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
            WHERE rank <= 10
        """,
        "op8_exact_dedup": """
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
            FROM (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id,
                         count(*) OVER (PARTITION BY t) AS group_size
                  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
        """,
        "op13_ranked_search": r"""
            WITH t AS (
                SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
                FROM documents
            ), q AS (
                SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark
            ), n AS (
                SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS tokens FROM t WHERE len(ts) > 0
            ), p AS (
                SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM t
            ), tf AS (
                SELECT doc_id, n, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM q) GROUP BY ALL
            ), w AS (
                SELECT term, CAST(floor(CAST(1000 AS DOUBLE) * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
                FROM tf, n GROUP BY term, docs
            ), s AS (
                SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // tokens)))) AS BIGINT) AS score
                FROM tf JOIN w USING (term) JOIN q USING (term), n GROUP BY item_id, doc_id
            )
            SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
            FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
            WHERE rank <= 50
        """,
    }
