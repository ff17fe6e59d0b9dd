"""Vocabulary and gratitude measures over whole texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.words import (
    IRREGULAR,
    STOP_WORDS,
    THANKS,
    VERBS,
    chunk_tokens,
    chunks,
    tokens,
    verb_lemma,
    without_stop_words,
)


def word_counts(
    df: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Occurrences of every token which is no stop word.

    Chunks between separators are counted first, so that the finer cutting runs once per
    distinct chunk and not once per word of the corpus. Both counts reduce before they shuffle.
    """
    parts = df.select(F.explode(chunks(text)).alias("chunk"))
    counted = parts.groupBy("chunk").agg(F.count("*").alias("n"))
    words = counted.select(
        F.explode(without_stop_words(chunk_tokens(F.col("chunk")), stop_words)).alias("token"), "n"
    )
    return words.groupBy("token").agg(F.sum("n").alias("n"))


def token_frequency(df: DataFrame, n: int = 30, text: str = "text") -> DataFrame:
    """The ``n`` most frequent tokens; equal counts in order of the token."""
    return word_counts(df, text).orderBy(F.desc("n"), "token").limit(n)


def word_forms(
    df: DataFrame,
    text: str = "text",
    verbs: Sequence[str] = VERBS,
    irregular: Mapping[str, str] = IRREGULAR,
) -> DataFrame:
    """Vocabulary with counts and verb lemmas: the lemma is found once per distinct token."""
    counted = word_counts(df, text)
    return counted.withColumn("lemma", verb_lemma(F.col("token"), verbs, irregular))


def forms_from_table(words: DataFrame, table: DataFrame, form: str) -> DataFrame:
    """Add the stem or lemma which a table ``(token, <form>)`` gives; else the token itself.

    ``words`` is a vocabulary (``word_counts``): the join runs once per distinct token.
    """
    given = table.select(F.col("token").alias("_token"), F.col(form).alias("_form"))
    joined = words.join(given, F.col("token") == F.col("_token"), "left")
    return joined.withColumn(form, F.coalesce("_form", "token")).drop("_token", "_form")


def thank_you_posts(
    df: DataFrame,
    text: str = "text",
    verbs: Sequence[str] = VERBS,
    irregular: Mapping[str, str] = IRREGULAR,
) -> DataFrame:
    """Add ``lemmas``: the lower-case verb lemmas of a post that says thanks, else null."""
    # Every form of these words contains the word, or is a listed exception: a text without
    # any of them is settled by one scan, and in the others only words with a sign can say so.
    signs = [*THANKS, *[form for form, verb in irregular.items() if verb in THANKS]]

    def has_sign(value: Column) -> Column:
        return reduce(lambda a, b: a | b, [value.contains(sign) for sign in signs])

    def lemma(word: Column) -> Column:
        return verb_lemma(word, verbs, irregular)

    possible = has_sign(F.lower(F.col(text)))
    words = F.transform(without_stop_words(tokens(text)), F.lower)
    thanks = F.array(*[F.lit(t) for t in THANKS])
    with_words = df.withColumn("_words", F.when(possible, words))
    says_thanks = F.arrays_overlap(F.transform(F.filter("_words", has_sign), lemma), thanks)
    lemmas = F.when(says_thanks, F.transform("_words", lemma))
    return with_words.withColumn("lemmas", lemmas).drop("_words")
