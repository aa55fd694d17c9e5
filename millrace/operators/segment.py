"""Text without spaces cut into the words of a list: at every place the longest word that begins there, from left to right.

The list is a table and may be larger than a worker: every piece of a text that could be a word is joined to it. Different texts are cut once, however many rows have them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def longest_words(rows: DataFrame, text: str, words: DataFrame, word: str, longest: int) -> DataFrame:
    """The rows with ``words``: the chosen words in order. ``longest``: characters of the longest word; longer words of the list are never found.

    A character at which no word begins stands alone if it is a letter or digit and is left out otherwise. Words and texts are compared in lower case. Null texts have null.
    """
    texts = rows.where(F.col(text).isNotNull()).select(F.lower(text).alias("_text")).distinct()
    n = F.length("_text")
    places = texts.select("_text", F.explode(F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).alias("_at"))
    lengths = F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("_at") + 1)))
    pieces = places.where(F.col("_at") <= n).select("_text", "_at", lengths.alias("_size"))
    pieces = pieces.withColumn("_piece", F.substring("_text", F.col("_at"), F.col("_size")))
    listed = words.select(F.lower(word).alias("_piece")).where("_piece <> ''").distinct()
    # of each place the longest; a map has an entry per character of a text at most
    best = pieces.join(listed, "_piece").groupBy("_text", "_at").agg(F.max("_size").alias("_size"))
    maps = best.groupBy("_text").agg(F.map_from_entries(F.collect_list(F.struct("_at", "_size"))).alias("_sizes"))
    cut = texts.join(maps, "_text", "left").withColumn("_sizes", F.coalesce("_sizes", F.create_map().cast("map<int,int>")))

    def step(acc, at):
        size = F.coalesce(F.try_element_at(F.col("_sizes"), at), F.lit(1))
        piece = F.substring(F.col("_text"), at, size)
        known = F.map_contains_key(F.col("_sizes"), at) | piece.rlike(r"^[\p{L}\p{N}]$")
        took = F.struct((at + size).alias("next"), F.when(known, F.concat(acc["words"], F.array(piece))).otherwise(acc["words"]).alias("words"))
        return F.when(at < acc["next"], acc).otherwise(took)

    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("words"))
    positions = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    cut = cut.select("_text", F.aggregate(positions, start, step, lambda acc: acc["words"]).alias("words"))
    return rows.join(cut, F.lower(rows[text]) == cut["_text"], "left").drop("_text")
