"""Quality rules as one Spark projection: a threshold table over length, symbol, stop-word and line ratios.

Only built-in column functions run (no user functions). Words are ``[^\\x20\\x09-\\x0D]+``; lines are split at ``\\n``.
A null or empty text has no words and fails the base rule; repeated rows get the same row each; an empty table gives an
empty result; only the id and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WS = "[ \\t-\\r]"

# Frequent function words of the corpus languages (en, de, fr, es).
STOP_WORDS = ("the of and to in is that for with was on are this der die das und ist ein eine nicht zu mit den le la les "
              "et est une un des en pour que qui dans el los las y de por con es se del").split()
CASED = [*STOP_WORDS, *(w.title() for w in STOP_WORDS), *(w.upper() for w in STOP_WORDS)]

#: metric, smallest allowed, largest allowed (None: no bound on that side), smallest word count the rule applies to.
RULES: tuple[tuple[str, float | None, float | None, int], ...] = (
    ("n_words", 50, None, 0),
    ("mean_word_chars", 1.5, 20.0, 0),
    ("symbol_ratio", None, 0.05, 0),
    ("dup_line_ratio", None, 0.50, 0),
    ("shout_ratio", None, 0.50, 0),
    ("stop_word_ratio", 0.01, None, 100),
)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS + "+"))


def _next(array: str, start: int) -> Column:
    return F.slice(array, F.lit(start), F.greatest(F.size(array), F.lit(1)))


def _repeated() -> Column:
    """Positions in 3-word windows that occur at least twice, from the columns _w (words) and _x (a hash per window).

    Texts whose windows all differ (found by a hash set) spare the sort; else equal neighbours in sorted order, compared
    word by word, name the repeated windows, and each covers three positions.
    """
    order = F.array_sort(F.transform("_x", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    three = lambda i: F.slice("_w", i + 1, F.lit(3))
    return F.when(F.size(F.array_distinct("_x")) == F.size("_x"), F.array().cast("array<struct<x:bigint,i:int>>")).otherwise(order), lambda o: F.size(
        F.array_distinct(F.flatten(F.transform(F.array_distinct(F.flatten(F.filter(F.zip_with(
            o, _next(o, 2), lambda a, b: F.when(
                a["x"] == b["x"], F.when(three(a["i"]) == three(b["i"]), F.array(a["i"], b["i"])))),
            lambda p: p.isNotNull()))), lambda i: F.array(i, i + 1, i + 2)))))


def metrics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` (as ``id_col``), the counts and the ratios the rules speak of; ``keep`` passes input columns along."""
    src = df.select(*[F.col(c) for c in dict.fromkeys((id_col, *keep))],
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    # one step per array that is used twice, so that none is computed twice
    src = src.withColumn("_w", _words(F.col("_t")))
    src = src.withColumns({
        "_h": F.transform("_w", lambda w: F.xxhash64(w)),
        "_l": F.filter(F.split("_t", "\n"), lambda x: x.rlike("[^ \\t-\\r]")),
        "n_symbols": F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long"),
        "n_shout_pairs": F.regexp_count("_t", F.lit("\\p{Lu}{2}")).cast("long"),
    })
    src = src.withColumn("_x", F.slice(F.zip_with(F.zip_with("_h", _next("_h", 2), lambda a, b: F.xxhash64(a, b)), _next("_h", 3),
                                                  lambda a, b: F.xxhash64(a, b)), F.lit(1), F.greatest(F.size("_h") - 2, F.lit(0))))
    order, count = _repeated()
    src = src.withColumn("_o", order)
    src = src.select(
        *[F.col(c) for c in dict.fromkeys((id_col, *keep))],
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        count("_o").cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        F.size(F.filter("_w", lambda w: w.isin(CASED))).cast("long").alias("n_stop_words"),
        "n_shout_pairs",
    )
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return src.withColumns({
        "mean_word_chars": F.col("word_chars") / words,
        "symbol_ratio": F.col("n_symbols") / chars,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "shout_ratio": F.col("n_shout_pairs") * 2 / chars,
        "stop_word_ratio": F.col("n_stop_words") / words,
    })


def compile_rules(rules=RULES) -> Column:
    """The threshold table as one boolean column: true where every applicable rule holds."""
    ok = F.lit(True)
    for metric, low, high, least in rules:
        c, rule = F.col(metric), F.lit(True)
        if low is not None:
            rule = rule & (c >= low)
        if high is not None:
            rule = rule & (c <= high)
        ok = ok & (rule | (F.col("n_words") < least))
    return ok


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts, ``base_failed`` (fewer than 50 words, or over half the words in repeated 3-word windows) and ``kept``."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (metrics(df, id_col, text_col, keep).withColumn("base_failed", base)
            .withColumn("kept", ~F.col("base_failed") & compile_rules(rules)))


def keep_good(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``df``, all columns, that are kept.

    The partition number in the filter holds the optimizer from moving the filter below the metrics, where it would
    compute every array of every rule anew.
    """
    whole = df.select(F.col(id_col), F.col(text_col), F.struct(*df.columns).alias("_row"))  # one column: names cannot clash
    judged = quality(whole, id_col, text_col, rules, keep=("_row",)).withColumn("_part", F.spark_partition_id())
    return judged.where(F.col("kept") & (F.col("_part") >= 0)).select("_row.*")
