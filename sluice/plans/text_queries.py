"""Registered queries on words, stems, TF-IDF and the grouped reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import clean_text, word_tokens
from sluice.operators import similarity, tfidf, topics, words
from sluice.plans import sql_text as S
from sluice.plans.registry import query
from sluice.plans.tables import DOMAIN_WORDS, documents, score, survey, table, tokenised
from sluice.session import cut_lineage

MAX_SCORE = 6
MIN_SIMILARITY = 0.8
SETTINGS = tfidf.TfidfSettings()


@query(
    f"""with {S.DOCS}, w as (select source, unnest(tokens) as word from docs),
    c as (select source, word, count(*) as n from w group by all)
    select source, word, n,
      row_number() over (partition by source order by n desc, word) as rank
    from c qualify rank <= 10"""
)
def source_top_words(spark: SparkSession, sf: str) -> DataFrame:
    """The ten most frequent words of each source."""
    return words.top_words(tokenised(spark, sf, "source"), "source", 10)


@query(f"select doc_id, text, {S.SCORE} as ltr from documents where text is not null")
def topic_input(spark: SparkSession, sf: str) -> DataFrame:
    return survey(spark, sf)


@query(
    f"select doc_id, text, {S.SCORE} as ltr from documents "
    f"where text is not null and {S.SCORE} <= {MAX_SCORE}"
)
def topic_score_filter(spark: SparkSession, sf: str) -> DataFrame:
    return survey(spark, sf).filter(F.col("ltr") <= MAX_SCORE)


@query(f"select doc_id, {S.CLEAN} as cleaned from documents")
def text_clean(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf, "text")
    return docs.select("doc_id", clean_text(F.col("text"), DOMAIN_WORDS).alias("cleaned"))


@query(f"select doc_id, array_to_string({S.SPLIT}, ' ') as tokens from documents")
def text_tokens(spark: SparkSession, sf: str) -> DataFrame:
    tokens = word_tokens(clean_text(F.col("text"), DOMAIN_WORDS))
    return documents(spark, sf, "text").select(
        "doc_id", F.array_join(tokens, " ").alias("tokens")
    )


@query(f"with {S.DOCS} select doc_id, array_to_string(tokens, ' ') as tokens from docs")
def tokens_no_stopwords(spark: SparkSession, sf: str) -> DataFrame:
    return tokenised(spark, sf).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@query(f"with {S.DOCS}, {S.WORDS} select word, count(*) as n from words group by word")
def corpus_words(spark: SparkSession, sf: str) -> DataFrame:
    return words.word_counts(tokenised(spark, sf))


@query(f"with {S.DOCS}, {S.WORDS} select distinct word from words")
def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return words.vocabulary(tokenised(spark, sf))


@query(f"with {S.DOCS}, {S.WORDS}, {S.VOCAB} select orig, stem, n from vocab")
def stem_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return words.stem_vocabulary(tokenised(spark, sf))


@query(
    f"with {S.DOCS}, {S.WORDS}, {S.VOCAB} select orig, stem, n from vocab "
    "qualify n = max(n) over (partition by stem)"
)
def stem_vocab_max(spark: SparkSession, sf: str) -> DataFrame:
    return words.stem_maxima(words.stem_vocabulary(tokenised(spark, sf)))


@query(f"with {S.DOCS}, {S.WORDS}, {S.VOCAB}, {S.REPRESENTATIVES} select stem, orig, n from best")
def stem_representative(spark: SparkSession, sf: str) -> DataFrame:
    return words.stem_representatives(words.stem_vocabulary(tokenised(spark, sf)))


@query(
    f"with {S.DOCS}, {S.WORDS}, {S.VOCAB}, {S.REPRESENTATIVES}, {S.RESTORED_DOCS} "
    "select doc_id, array_to_string(tokens, ' ') as restored from restored"
)
def stem_retranslate(spark: SparkSession, sf: str) -> DataFrame:
    docs = words.canonical_tokens(tokenised(spark, sf))
    return docs.select("doc_id", F.array_join("tokens", " ").alias("restored"))


@query(f"with {S.DOCS}, {S.grams('docs', 3)} select term, count(*) as n from grams group by term")
def word_ngram_counts(spark: SparkSession, sf: str) -> DataFrame:
    grams = tfidf.gram_rows(tokenised(spark, sf))
    return grams.groupBy("term").agg(F.count("*").alias("n"))


@query(
    f"with {S.DOCS}, {S.grams('docs', 3)} "
    "select doc_id, term, count(*) as tf from grams group by all"
)
def word_ngrams_per_document(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.term_frequencies(tokenised(spark, sf))


@query(f"with {S.DOCS}, {S.tfidf('docs', 1, 200_000)} select term, df, cf from stats")
def term_stats(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.term_statistics(tfidf.term_frequencies(tokenised(spark, sf), n_max=1))


@query(f"with {S.DOCS}, {S.tfidf('docs', 3, 200_000)} select term, df, cf from kept")
def tfidf_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.vocabulary_of(tokenised(spark, sf), settings=SETTINGS)


@query(
    f"with {S.DOCS}, {S.tfidf('docs', 3, 200_000)} "
    "select doc_id, term, round(weight, 6) as weight from weights"
)
def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = tfidf.tfidf_weights(tokenised(spark, sf), settings=SETTINGS)
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    f"""with {S.DOCS}, {S.WORDS}, {S.VOCAB}, {S.REPRESENTATIVES}, {S.RESTORED_DOCS},
    scored as (select * from restored where ltr <= {MAX_SCORE}),
    {S.tfidf('scored', 3, 200_000)}
    select doc_id, term, round(weight, 6) as weight from weights"""
)
def topic_weights(spark: SparkSession, sf: str) -> DataFrame:
    """The whole text side of the topic job: stems from all texts, weights of the scored ones."""
    return topic_matrix(spark, sf).withColumn("weight", F.round("weight", 6))


def topic_matrix(spark: SparkSession, sf: str) -> DataFrame:
    docs = words.canonical_tokens(tokenised(spark, sf))
    scored = survey(spark, sf).filter(F.col("ltr") <= MAX_SCORE).select("doc_id")
    # the weights read the documents twice, so their words are written once
    chosen = cut_lineage(docs.join(scored, "doc_id"))
    return tfidf.tfidf_weights(chosen, settings=SETTINGS)


@query(
    f"""with {S.DOCS}, {S.tfidf('docs', 1, 200_000)},
    spelled as (select doc_id, string_agg(term || '=' || round(weight, 9), ' ' order by term) as v
      from weights group by doc_id),
    groups as (select min(doc_id) as rep, count(*) as n from spelled group by v),
    kept_docs as (select w.*, g.n as copies from weights w join groups g on g.rep = w.doc_id)
    select a.doc_id as doc_a, b.doc_id as doc_b, max(a.copies) as copies_a,
      max(b.copies) as copies_b, round(sum(a.weight * b.weight), 6) as similarity
    from kept_docs a join kept_docs b on a.term = b.term and a.doc_id < b.doc_id
    group by a.doc_id, b.doc_id having sum(a.weight * b.weight) >= {MIN_SIMILARITY}"""
)
def doc_cosine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Similar pairs of distinct documents, with the number of equal copies of each."""
    settings = tfidf.TfidfSettings(n_max=1)
    weights = tfidf.tfidf_weights(tokenised(spark, sf), settings=settings)
    pairs = similarity.cosine_pairs(weights, MIN_SIMILARITY)
    return pairs.withColumn("similarity", F.round("similarity", 6))


@query(
    f"""with {S.DOCS}, {S.WORDS}, {S.VOCAB}, {S.REPRESENTATIVES}, {S.RESTORED_DOCS},
    scored as (select * from restored where ltr <= {MAX_SCORE}),
    {S.tfidf('scored', 3, 200_000)},
    spelled as (select doc_id, string_agg(term || '=' || round(weight, 9), ' ' order by term) as v
      from weights group by doc_id)
    select doc_id, min(doc_id) over (partition by v) as representative,
      count(*) over (partition by v) as copies from spelled"""
)
def doc_copies(spark: SparkSession, sf: str) -> DataFrame:
    """For each document of the topic job's matrix the least one with the same weights."""
    return similarity.copy_groups(similarity.document_vectors(topic_matrix(spark, sf)))


@query(
    f"""with {S.DOCS}, {S.tfidf('docs', 1, 200_000)},
    spelled as (select doc_id, string_agg(term || '=' || round(weight, 9), ' ' order by term) as v
      from weights group by doc_id)
    select doc_id, min(doc_id) over (partition by v) as representative,
      count(*) over (partition by v) as copies from spelled"""
)
def doc_pair_members(spark: SparkSession, sf: str) -> DataFrame:
    """The documents behind each entry of ``doc_cosine_pairs``, those of groups in no pair among them."""
    weights = tfidf.tfidf_weights(tokenised(spark, sf), settings=tfidf.TfidfSettings(n_max=1))
    return similarity.copy_groups(similarity.document_vectors(weights))


@query(
    f"""with {S.DOCS}, {S.tfidf('docs', 1, 200_000)},
    sums as (select lang, term, sum(weight) as total from weights join docs using (doc_id)
      group by lang, term),
    sizes as (select lang, count(*) as size from docs group by lang),
    means as (select lang, term, round(total / size, 9) as w from sums join sizes using (lang))
    select lang, term, round(w, 6) as weight,
      row_number() over (partition by lang order by w desc, term) as rank
    from means qualify rank <= 10"""
)
def lang_top_terms(spark: SparkSession, sf: str) -> DataFrame:
    """Top terms of each language's mean TF-IDF vector: a clustering with known groups."""
    docs = tokenised(spark, sf, "lang")
    settings = tfidf.TfidfSettings(n_max=1)
    weights = tfidf.tfidf_weights(docs, settings=settings)
    centroids = topics.centroid_terms(weights, docs.select("doc_id", "lang"), "lang")
    return topics.top_terms(centroids, "lang").withColumn("weight", F.round("weight", 6))


@query(
    f"""select source, count(ltr) as n, round(avg(ltr), 6) as mean, min(ltr) as least,
    max(ltr) as most, quantile_cont(ltr, 0.5) as median
    from (select source, {S.SCORE} as ltr from documents where text is not null) group by source"""
)
def group_scores(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").filter(F.col("text").isNotNull())
    scores = topics.group_scores(docs.select("source", score().alias("ltr")), "source", "ltr")
    return scores.withColumn("mean", F.round("mean", 6))


@query("select source, count(*) as n from documents group by source order by n desc, source")
def source_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return topics.group_sizes(table(spark, sf, "documents"), "source")
