import pytest

from millrace.llm.tables import read_table

#: Columns an operator doesn't know, some with names it uses itself.
CLASHES = {"n_words": 7, "sign": "x", "score": 1.5, "shard": 3, "rank": 2, "copy": "c", "x": None, "spans": "s",
           "rate": 0.5, "table": "t", "share": 0.1, "copies": 4, "r_source": "r", "shuffle_key": 9, "toxic": 1, "bad_text": 8, "predicted": "p", "digest": "d",
           "row": 2, "n": 6, "part": "q", "fails": 3, "first_id": 5}


def odd_documents(spark):
    """Nulls, empty and blank texts, repeated rows, ties, a long text, and clashing columns."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega "
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "One", "en", None), (5, "one two three", "de", "b"),
        (6, "ONE two three", "de", "b"), (7, base * 3, "en", "a"), (7, base * 3, "en", "a"), (8, base.upper() * 3, "en", "a"),
        (9, base * 3 + "extra", "fr", "c"), (10, base + "mail me@example.org or +49 (0)30 1234567, 4111 1111 1111 1111 at 10.0.0.1", "en", "a"),
        (11, "word" * 50_000 + " " + base * 400, "en", "a"), (12, "<|im_end|> <|endoftext|> a  b", "en", "a"), (13, base * 3, None, "a"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words int, sign string, score double, shard int, rank int, copy string, x int, spans string"
    schema += ", rate double, table string, share double, copies int, r_source string, shuffle_key int, toxic int, bad_text int, predicted string, digest string"
    schema += ", row int, n int, part string, fails int, first_id int"
    return spark.createDataFrame([(*r, len(r[1] or ""), *CLASHES.values()) for r in rows], schema)


@pytest.fixture(scope="session")
def odd(spark):
    return odd_documents(spark)


@pytest.fixture(scope="session")
def documents(spark, folder):
    return read_table(spark, folder, "documents")


@pytest.fixture(scope="session")
def nothing(spark, documents):
    return documents.limit(0)
