"""Words by a list, the longest first, and the SQL table function of words."""

import random

from millrace.functions.keywords import register_words
from millrace.operators.segment import longest_words


def by_hand(text, words, longest):
    if text is None:
        return None
    text, out, at = text.lower(), [], 0
    while at < len(text):
        size = max((n for n in range(1, longest + 1) if at + n <= len(text) and text[at : at + n] in words), default=0)
        if size or text[at].isalnum():
            out.append(text[at : at + max(size, 1)])
        at += max(size, 1)
    return out


def test_random_texts(spark):
    rnd = random.Random(4)
    piece = lambda n: "".join(rnd.choice("abC, 红色") for _ in range(n))
    words = {piece(rnd.randint(1, 5)).lower() for _ in range(60)}
    rows = [(k, rnd.choice([None, "", piece(1), piece(12), piece(30)])) for k in range(120)] + [(500, "ABAB"), (501, "abab")]
    table = spark.createDataFrame([(w,) for w in words] + [("",), (None,)], "w string")
    docs = spark.createDataFrame(rows, "id int, text string")
    for longest in (1, 3, 9):
        got = longest_words(docs, "text", table, "w", longest)
        assert got.columns == ["id", "text", "words"]
        assert {r.id: r.words for r in got.collect()} == {k: by_hand(t, words, longest) for k, t in rows}
    assert {tuple(r.words or ["null"]) for r in longest_words(docs.where("id >= 500"), "text", table.limit(0), "w", 3).collect()} == {("a", "b", "a", "b")}


def test_table_function(spark):
    register_words(spark, "own_words", r"[a-z']+|\d+")
    spark.createDataFrame([(1, "It's 12\\3"), (2, None), (3, "...")], "id int, t string").createOrReplaceTempView("said")
    rows = spark.sql("SELECT id, word FROM said, LATERAL own_words(said.t)").collect()
    assert sorted(map(tuple, rows)) == [(1, "12"), (1, "3"), (1, "it's")]
