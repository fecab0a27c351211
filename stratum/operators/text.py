"""Text operators (N1–N8): tokenise, stop words, counts, n-grams, lexicon
part-of-speech tags, count vectors and topic models — all on whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Punctuation stripped before tokenising and the token separator (explicit ASCII
# whitespace so every engine splits the same way).
STRIP = "[.!?-]"
SEPARATOR = "[ \t\n\r\f]+"


def english_stop_words() -> list[str]:
    """Spark ML's built-in English stop-word list (a public resource of Spark)."""
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords("english"))


def tokens(text, strip: str | None = STRIP, sep: str = SEPARATOR) -> Column:
    """Lower-cased whitespace tokens of the whole text; punctuation ``strip`` removed; no empty tokens."""
    t = F.col(text) if isinstance(text, str) else text
    if strip:
        t = F.regexp_replace(t, strip, "")
    return F.filter(F.split(F.lower(t), sep), lambda w: w != "")


def drop_words(arr: Column, words: Sequence[str]) -> Column:
    """Array without the given words (hash-set membership, JVM-side)."""
    ws = list(words)
    return F.filter(arr, lambda w: ~w.isin(ws))


def word_counts(df: DataFrame, text: str, stop_words: Sequence[str] = (), min_count: int = 1) -> DataFrame:
    """(word, n) over all texts; stop words removed after lower-casing; counts ≥ ``min_count``.

    explode → partial count per task → shuffle of distinct words only.
    """
    from stratum.session import spread

    w = spread(df.select(text)).select(F.explode(tokens(text)).alias("word"))
    if stop_words:
        w = w.where(~F.col("word").isin(list(stop_words)))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def ngrams(arr: Column, n: int = 2) -> Column:
    """Space-joined n-grams of a token array (same output as ``ml.feature.NGram``).

    Bigrams pair the array with itself shifted by one (one ``zip_with`` pass);
    longer n-grams join a slice per position.
    """
    if n == 2:
        pairs = F.zip_with(arr, F.slice(arr, 2, F.greatest(F.size(arr) - 1, F.lit(1))),
                           lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b)))
        grams = F.filter(pairs, lambda g: g.isNotNull())
        return F.when(F.size(arr) >= 2, grams).otherwise(F.array().cast("array<string>"))
    idx = F.sequence(F.lit(0), F.size(arr) - n)
    grams = F.transform(idx, lambda i: F.array_join(F.slice(arr, i + 1, n), " "))
    return F.when(F.size(arr) >= n, grams).otherwise(F.array().cast("array<string>"))


def ngram_counts(df: DataFrame, text: str, n: int = 2, stop_words: Sequence[str] = ()) -> DataFrame:
    t = tokens(text)
    if stop_words:
        t = drop_words(t, stop_words)
    # Materialise the token array once: the n-gram lambda reads it per position, and an
    # inlined token expression would re-run the regex for every position.
    from stratum.session import spread

    g = spread(df.select(text)).select(t.alias("_t"))
    g = g.select(F.explode(ngrams(F.col("_t"), n)).alias("ngram"))
    return g.groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))


# Closed-class English words and their Penn Treebank tags.
LEXICON: dict[str, list[str]] = {
    "DT": ["the", "a", "an", "this", "that", "these", "those", "every", "each", "some", "any", "no"],
    "IN": ["of", "in", "on", "at", "by", "for", "with", "from", "about", "into", "over", "under", "after",
           "before", "between", "through", "during", "without", "within", "upon", "as", "than"],
    "TO": ["to"],
    "CC": ["and", "or", "but", "nor", "yet"],
    "PRP": ["i", "you", "he", "she", "it", "we", "they", "me", "him", "us", "them"],
    "PRP$": ["my", "your", "his", "her", "its", "our", "their"],
    "MD": ["can", "could", "will", "would", "shall", "should", "may", "might", "must"],
    "VBZ": ["is", "has", "does"],
    "VBP": ["are", "am", "have", "do"],
    "VBD": ["was", "were", "had", "did"],
    "VB": ["be"],
    "VBN": ["been"],
    "RB": ["not", "very", "also", "just", "only", "never", "always", "often"],
    "WP": ["who", "whom", "what"],
    "WDT": ["which"],
    "EX": ["there"],
}
# Suffix rules applied in this order to words outside the lexicon.
SUFFIX_RULES: list[tuple[str, str]] = [
    ("^[0-9]+([.,][0-9]+)?$", "CD"),
    ("ing$", "VBG"),
    ("ed$", "VBD"),
    ("ly$", "RB"),
    ("(tion|ment|ness|ity)$", "NN"),
    ("s$", "NNS"),
]


def pos_tag(word) -> Column:
    """Context-free part-of-speech tag of one token: lexicon, then suffix rules, else NN."""
    w = F.col(word) if isinstance(word, str) else word
    expr = None
    for tag, words in LEXICON.items():
        cond = w.isin(words)
        expr = F.when(cond, F.lit(tag)) if expr is None else expr.when(cond, F.lit(tag))
    for pat, tag in SUFFIX_RULES:
        expr = expr.when(w.rlike(pat), F.lit(tag))
    return expr.otherwise(F.lit("NN"))


def pos_tag_sql(w: str) -> str:
    """The same rule as a SQL CASE (used by oracles and SQL users)."""
    parts = []
    for tag, words in LEXICON.items():
        lst = ", ".join("'" + x.replace("'", "''") + "'" for x in words)
        parts.append(f"WHEN {w} IN ({lst}) THEN '{tag}'")
    for pat, tag in SUFFIX_RULES:
        parts.append(f"WHEN regexp_matches({w}, '{pat}') THEN '{tag}'")
    return "CASE " + " ".join(parts) + " ELSE 'NN' END"


def topic_model(df: DataFrame, text: str, k: int = 3, max_iter: int = 10, vocab_size: int = 50, seed: int = 42,
                stop_words: Sequence[str] | None = None, ngram: int | None = None):
    """Tokenise → stop words → (optional n-grams) → count vectors → LDA; returns (pipeline model, vocabulary)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import CountVectorizer, NGram, RegexTokenizer, StopWordsRemover

    stages = [RegexTokenizer(inputCol=text, outputCol="_tok", pattern=SEPARATOR, gaps=True, toLowercase=True),
              StopWordsRemover(inputCol="_tok", outputCol="_words",
                               stopWords=list(stop_words) if stop_words is not None else english_stop_words())]
    col = "_words"
    if ngram:
        stages.append(NGram(n=ngram, inputCol="_words", outputCol="_ngrams"))
        col = "_ngrams"
    stages += [CountVectorizer(inputCol=col, outputCol="features", vocabSize=vocab_size),
               LDA(k=k, maxIter=max_iter, seed=seed, featuresCol="features")]
    model = Pipeline(stages=stages).fit(df)
    vocab = model.stages[-2].vocabulary
    return model, vocab


def top_terms(model, vocab: Sequence[str], n: int = 5) -> DataFrame:
    """Top ``n`` terms per topic with weights (vocabulary lookup by index)."""
    lda = model.stages[-1]
    topics = lda.describeTopics(n)
    spark = topics.sparkSession
    v = spark.createDataFrame([(i, t) for i, t in enumerate(vocab)], "term_index int, term string")
    z = topics.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "tw"))
    z = z.select("topic", "rank", F.col("tw.termIndices").alias("term_index"), F.col("tw.termWeights").alias("weight"))
    return z.join(F.broadcast(v), "term_index").select("topic", "rank", "term", "weight")


def topic_label(dist: Column, names: Sequence[str], threshold: float = 0.6) -> Column:
    """Name of the first topic whose weight exceeds ``threshold``, else 'Unknown'."""
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(dist)
    expr = None
    for i, name in enumerate(names):
        cond = arr.getItem(i) > threshold
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("Unknown"))
