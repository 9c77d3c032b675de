"""One query per operator, over its whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers

from tidemark.llm import (
    decontamination,
    imatch,
    licences,
    mixing,
    near_duplicates,
    personal_data,
    ranked,
    simhash,
    tokens,
    toxicity,
    warc,
    whitening,
    wrappers,
)
from tidemark.llm.registry import LLM_ORACLE, LLM_QUERIES, query, table

__all__ = ["LLM_ORACLE", "LLM_QUERIES"]

OP1_SQL = r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), phrase AS (
    SELECT DISTINCT item_id, len(p) AS size, array_to_string(p, ' ') AS p FROM (
        SELECT item_id, unnest([words[i:i + 9] FOR i IN range(1, greatest(len(words) - 9, 1) + 1)]) AS p
        FROM b WHERE len(words) > 0)
), place AS (
    SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS first FROM w
), hit AS (
    SELECT doc_id, first, s.size, item_id
    FROM place CROSS JOIN (SELECT DISTINCT size FROM phrase) s
    JOIN phrase ON phrase.size = s.size AND phrase.p = array_to_string(words[first:first + s.size - 1], ' ')
    WHERE first + s.size - 1 <= len(words)
), hit_word AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(first, first + size)) AS pos FROM hit) GROUP BY doc_id
), item AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit_word USING (doc_id) LEFT JOIN item USING (doc_id)
"""


@query("op1_decontamination", OP1_SQL)
def op1(spark, folder):
    """Exact ten-word phrases of ``benchmark`` in ``documents``."""
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("n_near_items")


@query("op3_token_files")
def op3(spark, folder):
    """Token ids of all documents in binary files, read back."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return tokens.round_trip(table(spark, folder, "documents"), vocabulary, end_id=2)


@query("op4_mixing")
def op4(spark, folder):
    """Words of each document in a mix of sources weighing 5, 2, 1."""
    return mixing.mixture(table(spark, folder, "documents"))


@query("op5_near_duplicates")
def op5(spark, folder):
    """Groups of ``documents`` that share 80 % of their two-word shingles."""
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), size=2, percent=80)


@query("op2_toxicity")
def op2(spark, folder):
    """Probabilities and verdicts of the classifier chain for all ``documents``."""
    labels = toxicity.labelled(table(spark, folder, "labels"))
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, labels))


@query("op6_personal_data")
def op6(spark, folder):
    """Personal data in all ``documents``."""
    return personal_data.find(table(spark, folder, "documents"))


@query("op8_warc")
def op8(spark, folder):
    """All ``pages`` written to WARC archives and read back."""
    return warc.round_trip(table(spark, folder, "pages"))


@query("op10_fingerprints")
def op10(spark, folder):
    """I-Match fingerprints of all ``documents`` and of their edited texts."""
    return imatch.fingerprints(table(spark, folder, "documents"))


@query("op7_main_text")
def op7(spark, folder):
    """Main text of all ``pages``."""
    return wrappers.extract(table(spark, folder, "pages"))


@query("op9_licences")
def op9(spark, folder):
    """Licence texts and notices in all ``documents``."""
    return licences.licences(table(spark, folder, "documents"))


@query("op11_simhash")
def op11(spark, folder):
    """SimHash fingerprints and groups of all ``documents``."""
    return simhash.near_duplicates(table(spark, folder, "documents"), size=4, most=4)


@query("op12_whitening")
def op12(spark, folder):
    """First eight whitened components of all ``embeddings``."""
    return whitening.whiten(table(spark, folder, "embeddings"))


OP13_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents WHERE text IS NOT NULL
), b AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL
), q AS (
    SELECT item_id, term, count(*) AS reps FROM b GROUP BY item_id, term
), size AS (
    SELECT row_number() OVER () AS row, doc_id, words, CAST(len(words) AS BIGINT) AS n FROM d WHERE len(words) > 0
), total AS (
    SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size
), tf AS (
    SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM size)
    WHERE term IN (SELECT term FROM q) GROUP BY row, term
), weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
    FROM tf CROSS JOIN total GROUP BY term, docs
), scored AS (
    SELECT item_id, row, CAST(sum(reps * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
    FROM q JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (row) CROSS JOIN total
    GROUP BY item_id, row
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
        doc_id, score
    FROM scored JOIN size USING (row) WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""


@query("op13_ranked_search", OP13_SQL)
def op13(spark, folder):
    """The ten best ``documents`` for each item of ``benchmark``."""
    return ranked.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
