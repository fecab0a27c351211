"""Text queries over whole documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import text as TX
from stratum.plans.registry import query
from stratum.session import load

def _sql_list(words):
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _tok_sql(text: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower(regexp_replace({text}, '{TX.STRIP}', '', 'g')), "
            f"'{TX.SEPARATOR}'), lambda w: w <> '')")


def _oracle_word_counts(min_n: int) -> str:
    return f"""
SELECT word, count(*) AS n FROM (SELECT unnest({_tok_sql('text')}) AS word FROM documents) t
WHERE word NOT IN ({_sql_list(_stop_words_static())}) GROUP BY word HAVING count(*) >= {min_n}"""


def _stop_words_static():
    # The oracle SQL is built at import time without a JVM: Spark's English list, fixed.
    return STOP_WORDS


# Spark ML's default English stop-word list (StopWordsRemover), in its order.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves",
    "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above", "below", "to", "from", "up",
    "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when",
    "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor",
    "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "should",
    "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd",
    "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've", "you've", "they've",
    "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't",
    "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's",
    "let's", "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]


@query("word_count_min5", _oracle_word_counts(5))
def word_count_min5(spark, sf):
    d = load(spark, sf, "documents")
    return TX.word_counts(d, "text", STOP_WORDS, min_count=5)


@query("word_dictionary_top2000", f"""
SELECT word, n FROM ({_oracle_word_counts(1)}) t ORDER BY n DESC, word LIMIT 2000""")
def word_dictionary_top2000(spark, sf):
    """Top-2000 frequency dictionary (the limit is the feature: a bounded word-cloud input)."""
    d = load(spark, sf, "documents")
    return TX.word_counts(d, "text", STOP_WORDS).orderBy(F.col("n").desc(), "word").limit(2000)


@query("word_count_by_lang", f"""
SELECT lang, count(*) AS n_tokens, count(DISTINCT word) AS n_words
FROM (SELECT lang, unnest({_tok_sql('text')}) AS word FROM documents) t GROUP BY lang""")
def word_count_by_lang(spark, sf):
    from stratum.session import spread

    d = spread(load(spark, sf, "documents").select("lang", "text"))
    w = d.select("lang", F.explode(TX.tokens("text")).alias("word"))
    return w.groupBy("lang").agg(F.count(F.lit(1)).alias("n_tokens"), F.count_distinct("word").alias("n_words"))


@query("top_bigrams", f"""
SELECT ngram, count(*) AS n FROM (
  SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS ngram FROM (
    SELECT list_filter({_tok_sql('text')}, lambda w: w NOT IN ({_sql_list(STOP_WORDS)})) AS t FROM documents) a) b
GROUP BY ngram ORDER BY n DESC, ngram LIMIT 50""")
def top_bigrams(spark, sf):
    d = load(spark, sf, "documents")
    return TX.ngram_counts(d, "text", 2, STOP_WORDS).orderBy(F.col("n").desc(), "ngram").limit(50)


@query("token_tags", f"""
SELECT role, tag, count(*) AS n FROM (
  SELECT role, {TX.pos_tag_sql('word')} AS tag FROM (
    SELECT role, unnest({_tok_sql('text')}) AS word FROM conversations) a) b GROUP BY role, tag""")
def token_tags(spark, sf):
    c = load(spark, sf, "conversations")
    w = c.select("role", F.explode(TX.tokens("text")).alias("word"))
    words = w.groupBy("role", "word").agg(F.count(F.lit(1)).alias("n"))  # the rules run once per distinct word
    return words.groupBy("role", TX.pos_tag("word").alias("tag")).agg(F.sum("n").alias("n"))


@query("lda_topics")
def lda_topics(spark, sf):
    """Top 5 terms of 3 LDA topics (10 iterations, seeded) over count vectors of the 50 most frequent words."""
    d = load(spark, sf, "documents").select("doc_id", "text")
    model, vocab = TX.topic_model(d, "text", k=3, max_iter=10, vocab_size=50, seed=42, stop_words=STOP_WORDS)
    return TX.top_terms(model, vocab, 5)


@query("lda_doc_labels")
def lda_doc_labels(spark, sf):
    """Documents per topic label: first topic with weight > 0.6, else Unknown."""
    d = load(spark, sf, "documents").select("doc_id", "text")
    model, vocab = TX.topic_model(d, "text", k=3, max_iter=10, vocab_size=50, seed=42, stop_words=STOP_WORDS)
    scored = model.transform(d)
    lab = scored.select(TX.topic_label("topicDistribution", ["topic_0", "topic_1", "topic_2"]).alias("label"))
    return lab.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def _cleaned(spark, sf):
    """Conversation turns as notes: lower case, without ``.!?-``."""
    return load(spark, sf, "conversations").select(F.lower(F.regexp_replace("text", "[.!?-]", "")).alias("note"))


@query("bigram_topics")
def bigram_topics(spark, sf):
    """Top 5 two-word terms of 3 topics over cleaned notes (vocabulary of 50 bigrams, 10 iterations, seeded)."""
    model, vocab = TX.topic_model(_cleaned(spark, sf), "note", k=3, max_iter=10, vocab_size=50, seed=42, stop_words=STOP_WORDS, ngram=2)
    return TX.top_terms(model, vocab, 5)


@query("bigram_vocabulary", f"""
, notes AS (SELECT lower(regexp_replace(text, '[.!?-]', '', 'g')) AS note FROM conversations WHERE text IS NOT NULL)
SELECT CAST(row_number() OVER (ORDER BY n DESC) - 1 AS INTEGER) AS rank, n FROM (
  SELECT ngram, count(*) AS n FROM (
    SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS ngram FROM (
      SELECT list_filter({_tok_sql('note')}, lambda w: w NOT IN ({_sql_list(STOP_WORDS)})) AS t FROM notes) a) b
  GROUP BY ngram ORDER BY n DESC LIMIT 50) c""".replace(", notes AS", "WITH notes AS", 1))
def bigram_vocabulary(spark, sf):
    """Counts of the 50 bigrams that the topic model's vectoriser keeps, in its order (which words tie at the end is left open)."""
    from pyspark.ml.functions import vector_to_array

    d = _cleaned(spark, sf).where("note is not null")
    model, vocab = TX.topic_model(d, "note", k=3, max_iter=1, vocab_size=50, seed=42, stop_words=STOP_WORDS, ngram=2)
    counts = model.transform(d).select(F.posexplode(vector_to_array("features")).alias("rank", "c"))
    return counts.groupBy("rank").agg(F.sum("c").cast("long").alias("n"))
