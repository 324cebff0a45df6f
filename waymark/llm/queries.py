"""The queries opN_<name>, each an operator on its whole table, with check SQL where SQL can state it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import (byte_bpe, license_scan, line_dedup, lm_scoring, mixing, neighbours, ngram_join, phrase_mining,
                         quality_rules, ranked_search, suffix_dedup, toxicity, warc)
from waymark.llm.tables import documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "posterior")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(documents(spark, sf_dir, "pages"))
    return found.select(
        "metadata.page_id", F.coalesce("response.payload_bytes", "metadata.payload_bytes").alias("payload_bytes"),
        "response.payload_digest", "response.record_type", F.col("metadata.repeats_page").alias("refers_to"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.round_trip(documents(spark, sf_dir), path, pattern, keep=())


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.joined(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(documents(spark, sf_dir)).drop("kept")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.matches(documents(spark, sf_dir))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.where("vec_id % 100 = 0"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.deduplicated(documents(spark, sf_dir))
    return kept.select("doc_id", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
                       F.octet_length("text").cast("long").alias("n_bytes"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scored(documents(spark, sf_dir))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(documents(spark, sf_dir))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_warc": op2_warc,
    "op3_mixing": op3_mixing,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_toxicity": op6_toxicity,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_license_scans": op8_license_scans,
    "op9_neighbours": op9_neighbours,
    "op10_line_dedup": op10_line_dedup,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES = {
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
             q AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
                          min(page_id) OVER (PARTITION BY payload) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
        FROM q""",
    "op12_phrase_mining": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
                        FROM documents),
             split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
             f AS (SELECT lang, size, phrase, count(*) AS f
                   FROM (SELECT lang, size, unnest(list_transform(range(1, len(words) - size + 2),
                                    lambda i: array_to_string(words[i:i + size - 1], ' '))) AS phrase
                         FROM split, (VALUES (1), (2), (3)) AS sizes(size))
                   GROUP BY ALL),
             n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
             cand AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
             parts AS (SELECT *, unnest(range(1, size)) AS k FROM cand),
             sides AS MATERIALIZED (SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS head,
                                           array_to_string(w[k + 1:], ' ') AS tail FROM parts),
             cuts AS (SELECT s.lang, s.size, s.phrase, s.a, k, x.f AS l, y.f AS r,
                             CAST((1000000::HUGEINT * s.a * s.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
                      FROM sides s JOIN f x ON x.lang = s.lang AND x.phrase = s.head
                      JOIN f y ON y.lang = s.lang AND y.phrase = s.tail),
             scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
             covered AS (SELECT lang, phrase, max(longer) AS longest
                         FROM (SELECT lang, a AS longer, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
                               FROM cand WHERE size = 3) GROUP BY ALL)
        SELECT s.lang, row_number() OVER best AS rank, s.phrase, a, l, r, CAST(n AS BIGINT) AS n, score
        FROM scored s JOIN n USING (lang) LEFT JOIN covered c ON c.lang = s.lang AND c.phrase = s.phrase AND size = 2
        WHERE longest IS NULL OR 100 * longest < 50 * a
        WINDOW best AS (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase)
        QUALIFY rank <= 2000""",
    "op13_ranked_search": r"""
        WITH d AS (SELECT row_number() OVER () AS id, doc_id,
                          regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
                   FROM documents WHERE text IS NOT NULL),
             q AS (SELECT row_number() OVER () AS q_no, item_id,
                          unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                   FROM benchmark WHERE text IS NOT NULL),
             total AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d WHERE len(terms) > 0),
             tf AS (SELECT id, doc_id, CAST(len(terms) AS BIGINT) AS n, term, count(*) AS tf
                    FROM (SELECT id, doc_id, terms, unnest(terms) AS term FROM d) GROUP BY ALL),
             q_tf AS (SELECT q_no, item_id, term, count(*) AS repeats FROM q GROUP BY ALL),
             w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
                   FROM tf, total GROUP BY term, n_docs),
             scores AS (SELECT q_no, item_id, id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (
                                   25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
                        FROM q_tf JOIN tf USING (term) JOIN w USING (term), total GROUP BY ALL)
        SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
        WINDOW best AS (PARTITION BY q_no ORDER BY score DESC, doc_id NULLS LAST, id)
        QUALIFY rank <= 10""",
}
