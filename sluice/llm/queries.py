"""One registered query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.batches import table_at
from sluice.llm.best_fit import pack_documents
from sluice.llm.cover_tree import hard_negatives
from sluice.llm.lm_bloom import lm_scores
from sluice.llm.multi_index import nearest_vectors
from sluice.llm.parity_join import similar_texts
from sluice.llm.phrases import collocations
from sluice.llm.pieces import encode_documents
from sluice.llm.pii_anchors import pii_spans
from sluice.llm.quotient_dedup import exact_copies
from sluice.llm.repetition import repetition_figures
from sluice.llm.template import extract_pages
from sluice.llm.toxicity import fit, severity
from sluice.llm.url_cascade import filter_urls, url_host

# Verdict, host and path of the rules on urls.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of each text: score, size and digest of each."""
    return encode_documents(table_at(spark, sf_dir, "documents"), with_ids=False)


def op2_suffix_array_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules on each text; the columns that SQL can state."""
    return repetition_figures(table_at(spark, sf_dir, "documents")).drop("n_repeats", "longest_repeat")


def op3_bloom_cascade_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on each url; hosts of whose pages rules block over half are listed whole."""
    pages = table_at(spark, sf_dir, "pages")
    ruled = filter_urls(pages, URL_RULES)
    blocked = F.count_if((F.col("verdict") == "block") & F.col("rule").isNotNull())
    hosts = ruled.filter("host <> ''").groupBy("host").agg((2 * blocked > F.count("*")).alias("listed"))
    return filter_urls(pages, URL_RULES, hosts.filter("listed").select("host"))


def op4_log_frequency_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add-one unigram and Bloom-filter bigram scores of each text."""
    return lm_scores(table_at(spark, sf_dir, "documents"))


def op5_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of texts of which 80 % of the shingles agree."""
    return similar_texts(table_at(spark, sf_dir, "documents"))


def op6_anchor_expansion_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in each text."""
    return pii_spans(table_at(spark, sf_dir, "documents"))


def op7_best_fit_decreasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each piece of each document and its place in a sequence of 2048 tokens."""
    return pack_documents(table_at(spark, sf_dir, "documents"))


def op8_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of each text, from a model fitted on a sample of the labels."""
    docs = table_at(spark, sf_dir, "documents")
    return severity(docs, fit(docs, table_at(spark, sf_dir, "labels")))


def op9_equivalence_class_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return extract_pages(table_at(spark, sf_dir, "pages"))


def op10_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of each twentieth one."""
    return nearest_vectors(table_at(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of the five positives of each hundredth vector."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table_at(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


def op12_counting_quotient_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of equal texts stays."""
    return exact_copies(table_at(spark, sf_dir, "documents"))


def op13_multikey_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    return collocations(table_at(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece_nbest, op2_suffix_array_repetition, op3_bloom_cascade_urls, op4_log_frequency_bloom_lm,
        op5_parity_sketch_join, op6_anchor_expansion_pii, op7_best_fit_decreasing, op8_ordinal_toxicity,
        op9_equivalence_class_templates, op10_multi_index_hashing, op11_cover_tree_negatives, op12_counting_quotient_dedup, op13_multikey_phrases, pipeline,
    )
}

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), tokens AS (
  SELECT r, words, i, len(words) AS n FROM w, unnest(range(1, len(words) + 1)) AS t(i)
), grams AS (
  SELECT r, i, n,
    CASE WHEN i + 2 <= n THEN md5(array_to_string(words[i:i + 2], ' ')) END AS g3,
    CASE WHEN i + 9 <= n THEN md5(array_to_string(words[i:i + 9], ' ')) END AS g10,
    CASE WHEN i + 50 <= n THEN md5(array_to_string(words[i:i + 50], ' ')) END AS g51
  FROM tokens
), twice AS (
  SELECT r, i,
    g3 IS NOT NULL AND count(*) OVER (PARTITION BY r, g3) > 1 AS t3,
    g10 IS NOT NULL AND count(*) OVER (PARTITION BY r, g10) > 1 AS t10,
    g51 IS NOT NULL AND count(*) OVER (PARTITION BY r, g51) > 1 AS t51
  FROM grams
), cover AS (
  SELECT r,
    bool_or(t3) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3,
    bool_or(t10) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS c10, t51
  FROM twice
), sums AS (
  SELECT r, count_if(c3) AS n_repeat_words, count_if(c10) AS covered_words, bool_or(t51) AS long_repeat
  FROM cover GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM w, unnest(string_split(text, chr(10))) AS t(line)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), base AS (
  SELECT w.doc_id, len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(covered_words, 0)::BIGINT AS covered_words, coalesce(long_repeat, false) AS long_repeat
  FROM w LEFT JOIN sums USING (r) LEFT JOIN lines USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, covered_words,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * covered_words <= 20 * n_words
    AND NOT long_repeat AS kept
FROM base
"""

OP3_SQL = r"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path,
    row_number() OVER () AS r
  FROM pages
), rules(verdict, h, s) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fit AS (
  SELECT r, h || s AS rule, rules.verdict,
    row_number() OVER (PARTITION BY r ORDER BY length(h || s) DESC, h || s) AS k
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)
), ruled AS (
  SELECT p.*, rule, verdict FROM p LEFT JOIN (SELECT * FROM fit WHERE k = 1) f USING (r)
), listed AS (
  SELECT host FROM ruled WHERE host <> '' GROUP BY host HAVING 2 * count_if(verdict = 'block') > count(*)
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""

OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""

OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), g AS (
  SELECT doc_id, text, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256 FROM g
"""

OP13_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w, row_number() OVER () AS p FROM pieces
), rows AS (
  SELECT lang, p, unnest(w) AS w, unnest(range(len(w))) AS i FROM words
), follow AS (
  SELECT lang, w AS w1, lead(w, 1) OVER q AS w2, lead(w, 2) OVER q AS w3 FROM rows WINDOW q AS (PARTITION BY p ORDER BY i)
), f AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*)::HUGEINT AS n FROM follow GROUP BY ALL
  UNION ALL
  SELECT lang, 2, w1 || ' ' || w2, count(*) FROM follow WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM follow WHERE w3 IS NOT NULL GROUP BY ALL
), totals AS (
  SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 10
), cuts AS (
  SELECT c.lang, c.k, c.phrase, a, cut, x.n AS l, y.n AS r, (1000000 * a * a) // (x.n * y.n) AS score
  FROM (
    SELECT lang, k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)
  ) c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = tail
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), around AS (
  SELECT lang, part, max(a) AS a
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM cand WHERE k = 3)
  GROUP BY ALL
), kept AS (
  SELECT c.* FROM lowest c LEFT JOIN around o ON o.lang = c.lang AND o.part = c.phrase
  WHERE o.a IS NULL OR 100 * o.a < 50 * c.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, totals.n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op2_suffix_array_repetition": OP2_SQL, "op3_bloom_cascade_urls": OP3_SQL,
    "op11_cover_tree_negatives": OP11_SQL, "op12_counting_quotient_dedup": OP12_SQL, "op13_multikey_phrases": OP13_SQL,
}
