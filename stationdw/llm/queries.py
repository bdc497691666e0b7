"""The registered queries of this package, one per operator, and their DuckDB SQL where SQL can
express them. Each runs over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, iblt, langid, licenses, mixing, pii, simhash, substrings, tokencount, topk, trie, warc
from .common import read_table

#: The key of the registered query; a deployment passes its own.
PII_KEY = "demonstration key"


def op1_ecoc_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", ["doc_id", "text", "lang"])
    return langid.predict(docs, langid.fit(docs))


def op2_pii_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return pii.surrogates(docs, PII_KEY)


def op3_simhash_pigeonring(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op4_warc_segments(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages", ["page_id", "url", "html"])
    return warc.archive_round_trip(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "status")


def op5_anchor_substrings(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return substrings.dedup_substrings(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_iblt_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return iblt.version_fingerprints(read_table(spark, sf, "documents", ["doc_id", "text"]))


def op7_subset_sum_mix(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", ["doc_id", "text", "source"])
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op8_bitsliced_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf, "embeddings", ["vec_id", "embedding"]))


def op9_bpe_forced_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return bpe.bpe_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


def op10_whole_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return tokencount.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op11_block_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    own = trie.turns(read_table(spark, sf, "conversations", ["conv_id", "turn", "role", "text"]))
    return trie.prefix_trie(*trie.shared_beginnings(own))


def op12_identity_map_alignment(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op13_rare_word_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf, "documents", ["doc_id", "text"]))


QUERIES = {f.__name__: f for f in (
    op1_ecoc_language_id, op2_pii_surrogates, op3_simhash_pigeonring, op4_warc_segments,
    op5_anchor_substrings, op6_iblt_fingerprints, op7_subset_sum_mix, op8_bitsliced_topk,
    op9_bpe_forced_boundaries, op10_whole_token_counts, op11_block_prefix_trie,
    op12_identity_map_alignment, op13_rare_word_licenses)}

ORACLE_SQL = {
    "op4_warc_segments": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload FROM pages
        ), d AS (
            SELECT page_id, strlen(payload) AS n, sha1(payload) AS h,
                   max(page_id) OVER (PARTITION BY payload) AS keeper
            FROM p
        )
        SELECT page_id, n AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
                   ((16 * (instr('0123456789abcdef', substr(h, (5 * i) // 4 + 1, 1)) - 1)
                     + instr('0123456789abcdef', substr(h, (5 * i) // 4 + 2, 1)) - 1)
                    >> (3 - (5 * i) % 4)) & 31)::INT, 1) for i in range(32)], '')
                   AS payload_digest,
               CASE WHEN keeper IS NULL OR page_id = keeper THEN 'response' ELSE 'revisit' END
                   AS record_type,
               CASE WHEN keeper IS NULL OR page_id = keeper THEN NULL ELSE keeper END
                   AS refers_to,
               'ok' AS status
        FROM d""",
    "op5_anchor_substrings": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
            FROM documents
        ), win AS (
            SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS k
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i
                  FROM w WHERE len(ws) >= 50)
        ), seen AS (
            SELECT k, min(doc_id) AS least FROM win GROUP BY k
        ), gone AS (
            SELECT DISTINCT doc_id, i + o AS p
            FROM (SELECT win.doc_id, win.i, unnest(range(0, 50)) AS o
                  FROM win JOIN seen USING (k) WHERE least < win.doc_id)
        ), kept AS (
            SELECT a.doc_id, string_agg(a.word, ' ' ORDER BY a.p) AS text, count(*) AS n
            FROM (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS word
                  FROM w) a
            ANTI JOIN gone USING (doc_id, p) GROUP BY a.doc_id
        )
        SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(kept.n, 0) AS n_removed,
               sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op8_bitsliced_topk": """
        WITH v AS (
            SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   list_sum([a.q[i] * b.q[i] for i in range(1, len(a.q) + 1)])::BIGINT
                       AS score
            FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
        )
        SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score
        FROM s
        WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER best <= 20""",
    "op11_block_prefix_trie": """
        WITH t AS (
            SELECT conv_id AS c, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS turn,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
                       AS p
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT c, list(turn ORDER BY p) AS ts,
                   (xor(list_reduce([4294967295::UBIGINT] || [ascii(x)::UBIGINT
                                     for x in string_split(c::VARCHAR, '')],
                       lambda s, x: list_reduce([xor(s, x)] || [0::UBIGINT for i in range(8)],
                           lambda y, i: xor(y >> 1, 3988292384::UBIGINT * (y & 1)))),
                    4294967295::UBIGINT) % 9)::BIGINT AS h
            FROM t GROUP BY c
        ), conv AS (
            SELECT a.c, coalesce(b.ts[1:a.h], []) || a.ts[a.h + 1:] AS ts
            FROM own a LEFT JOIN own b ON b.c = a.c - a.c % 5
        ), prefixes AS (
            SELECT c, d, ts[1:d] AS path, len(ts) = d AS ends
            FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM conv)
        ), node AS (
            SELECT path, d, min(c) AS rep, count(*) AS n,
                   string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends) AS done
            FROM prefixes GROUP BY path, d
        ), child AS (
            SELECT path[1:d - 1] AS path, count(*) AS n FROM node WHERE d > 0 GROUP BY 1
        ), below AS (
            SELECT a.path, sum((child.n IS NULL)::INT) AS leaves,
                   sum((w.n - 1) * strlen(coalesce(w.path[w.d].text, ''))) AS saved
            FROM node w LEFT JOIN child ON child.path = w.path
            JOIN prefixes a ON a.c = w.rep AND a.d <= w.d
            GROUP BY a.path
        )
        SELECT v.rep AS conv_id, v.d AS depth, up.rep AS parent_conv_id, v.n AS n_convs,
               coalesce(child.n, 0) AS n_children, below.leaves::BIGINT AS n_leaves,
               below.saved::BIGINT AS saved_tokens, sha256(coalesce(v.done, '')) AS ends_sha256
        FROM node v JOIN below USING (path) LEFT JOIN child ON child.path = v.path
        LEFT JOIN node up ON v.d > 0 AND up.path = v.path[1:v.d - 1]""",
}
