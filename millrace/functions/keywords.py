"""Search text to words."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runs of latin letters and digits, or runs of CJK characters.
WORD_PATTERN = r"[a-z0-9]+|[\x{4e00}-\x{9fff}]+"


def words_of(text, pattern: str = WORD_PATTERN) -> Column:
    """All words of a text, lower case, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def explode_words(df: DataFrame, text: str, word: str = "keyword", pattern: str = WORD_PATTERN) -> DataFrame:
    """One row per word of ``text``; the other columns are repeated and the text is dropped."""
    return df.select(*[c for c in df.columns if c != text], F.explode(words_of(F.col(text), pattern)).alias(word))


def register_words(spark: SparkSession, name: str = "keyword_words", pattern: str = WORD_PATTERN) -> None:
    """Register ``words_of`` as the SQL table function ``name(text) -> (word)``, which stays in the JVM.

    ``SELECT word FROM log, LATERAL keyword_words(log.text)``
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE (word STRING) "
        f"RETURN SELECT explode(regexp_extract_all(lower(text), '{quoted}', 0))"
    )


def register_tokenizer(
    spark: SparkSession, tokenize: Callable[[str], Iterable[str]], name: str = "split_words"
) -> None:
    """Register a user's tokenizer as the SQL table function ``name(text) -> (word)``.

    ``SELECT word FROM log, LATERAL split_words(log.text)``. The built-in ``words_of`` stays in the JVM and is the
    one to prefer; this is for tokenizers that exist only in Python.
    """
    from pyspark.sql.functions import udtf

    class Words:
        def eval(self, text: str):
            for word in tokenize(text) if text is not None else ():
                yield (word,)

    spark.udtf.register(name, udtf(Words, returnType="word string"))
