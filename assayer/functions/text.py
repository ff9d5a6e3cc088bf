"""Stylometric features of a text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions.numbers import ratio

# ASCII punctuation, white space, sentence ends, vowels counted as syllable cores.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WHITE_SPACE = " \t\n\r\f"
GAP = r"\s+"
SENTENCE_END = r"[.!?]+"
SYLLABLE = r"[aeiouy]+"
# A word with at least three vowel runs, matched whole; the runs never need to give a letter back.
LONG_WORD = r"[^aeiouy\s]*+[aeiouy]++[^aeiouy\s]++[aeiouy]++[^aeiouy\s]++[aeiouy]++\S*+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def _count(text: Column, pattern: str) -> Column:
    # A split makes one piece more than there are matches, and is twice as fast as extracting them.
    return (F.size(F.split(text, pattern)) - 1).cast("bigint")


def _length(text: Column) -> Column:
    return F.length(text).cast("bigint")


def sentence_count(text: Column) -> Column:
    return F.greatest(_count(text, SENTENCE_END), F.lit(1).cast("bigint"))


def with_stylometrics(df: DataFrame, text: str = "text_content") -> DataFrame:
    """Counts, lengths and ratios of `text` as columns of the stylometric table."""
    source = F.col(text)
    # The words are extracted once; both the count and the vocabulary are taken from them.
    return (
        df.withColumn("_words", words(F.lower(source)))
        .withColumn("word_count", F.size("_words").cast("bigint"))
        .withColumn("character_count", _length(source))
        .withColumn("sentence_count", sentence_count(source))
        .withColumn("_letters", _length(F.translate(source, WHITE_SPACE, "")))
        .withColumn("_plain", _length(F.translate(source, PUNCTUATION, "")))
        .withColumn("lexical_diversity", ratio(F.size(F.array_distinct("_words")), F.col("word_count")))
        .withColumn("avg_sentence_length", F.col("word_count") / F.col("sentence_count"))
        .withColumn("avg_word_length", ratio(F.col("_letters"), F.col("word_count")))
        .withColumn("punctuation_ratio", ratio(F.col("character_count") - F.col("_plain"), F.col("character_count")))
        .drop("_words", "_letters", "_plain")
    )


def with_readability(df: DataFrame, text: str = "text_content", english: Column | None = None) -> DataFrame:
    """Flesch reading ease and Gunning fog; NULL without words or where `english` does not hold.

    Needs `word_count` and `avg_sentence_length` (see `with_stylometrics`).
    """
    words = F.col("word_count")
    readable = (words > 0) if english is None else (words > 0) & english
    lowered = F.lower(F.col(text))
    return (
        df.withColumn("_syllables", F.when(readable, _count(lowered, SYLLABLE)))
        .withColumn("_long_words", F.when(readable, _count(lowered, LONG_WORD)))
        .withColumn(
            "flesch_reading_ease",
            F.lit(206.835)
            - F.lit(1.015) * F.col("avg_sentence_length")
            - F.lit(84.6) * ratio(F.col("_syllables"), words),
        )
        .withColumn(
            "gunning_fog_index",
            F.lit(0.4) * (F.col("avg_sentence_length") + F.lit(100.0) * ratio(F.col("_long_words"), words)),
        )
        .withColumn("flesch_reading_ease", F.when(readable, F.col("flesch_reading_ease")))
        .withColumn("gunning_fog_index", F.when(readable, F.col("gunning_fog_index")))
        .drop("_syllables", "_long_words")
    )


def with_burstiness(df: DataFrame, text: str = "text_content") -> DataFrame:
    """Spread of the sentence lengths: population deviation over mean, from exact integer sums."""
    lengths = F.transform(F.split(F.col(text), SENTENCE_END), lambda s: F.size(words(s)).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    n, total, squares = F.col("_n"), F.col("_total"), F.col("_squares")
    return (
        df.withColumn("_lengths", F.filter(lengths, lambda x: x > 0))
        .withColumn("_n", F.size("_lengths").cast("bigint"))
        .withColumn("_total", F.aggregate("_lengths", zero, lambda acc, x: acc + x))
        .withColumn("_squares", F.aggregate("_lengths", zero, lambda acc, x: acc + x * x))
        .withColumn("burstiness", ratio(F.sqrt((n * squares - total * total).cast("double")), total))
        .drop("_lengths", "_n", "_total", "_squares")
    )
