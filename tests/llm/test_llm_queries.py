"""The registered queries on the given tables, against SQL or plain versions."""

import hashlib

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import tokens, toxicity
from millrace.llm.queries import ORACLE, QUERIES
from millrace.llm.tables import read_table
from tests.compare import connect, difference
from tests.llm import brute


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, folder, name):
    assert difference(QUERIES[name](spark, folder), connect(folder), ORACLE[name]) is None


def test_personal_data(spark, folder, texts):
    for row in QUERIES["op3_pii"](spark, folder).collect():
        found = brute.personal(texts[row.doc_id])
        counts = [sum(k == kind for k, *_ in found) for kind in brute.BASE]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone, row.base_sha256] == [*counts, brute.personal_digest(texts[row.doc_id])]


def test_toxicity_on_held_out_documents(spark):
    """On the larger table: labels in the small ones are too few to tell."""
    folder = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in read_table(spark, folder, "labels").collect()}
    rows = [r for r in QUERIES["op4_toxicity"](spark, folder).collect() if r.doc_id in toxic and r.held_out]
    good, bad = [r for r in rows if not toxic[r.doc_id]], [r for r in rows if toxic[r.doc_id]]
    assert sum(r.predicted for r in good) <= 0.01 * len(good)
    assert sum(r.predicted for r in bad) >= 0.8 * len(bad)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_toxicity_against_a_plain_model(spark, documents):
    """Equal scores from loops, and from the plan that joins the counts instead of sending them."""
    folder = "/root/testdata/sf0.01"
    docs = read_table(spark, folder, "documents").select("doc_id", "text").where("doc_id < 600")
    labels = read_table(spark, folder, "labels")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    marked = [(r.doc_id, r.toxic) for r in labels.collect() if r.doc_id < 600]
    expected = brute.toxic_scores(rows, marked)
    assert max(expected.values()) > 0.7 > 0.1 > min(expected.values())
    for settings in (toxicity.Settings(), toxicity.Settings(broadcast_entries=0)):
        got = toxicity.score(docs, labels.where("doc_id < 600"), settings).collect()
        assert len(got) == len(rows)
        text_of = dict(rows)
        assert all(abs(r.score - expected[r.doc_id, text_of[r.doc_id]]) < 1e-6 for r in got)


def test_jaccard_components(spark, folder, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op5_jaccard_join"](spark, folder).collect()}
    assert got == brute.jaccard_classes(texts)


def test_token_files(spark, folder, texts):
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op7_token_files"](spark, folder).collect())
    assert got == brute.packed_documents(list(texts.items()), Tokenizer.from_file(tokens.default_vocabulary()))


def test_token_counts(spark, folder, documents):
    tokenizer = Tokenizer.from_file(tokens.default_vocabulary())
    lengths: dict = {}
    for r in documents.select("source", "text").collect():
        lengths.setdefault(r.source, []).append(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids))
    rows = QUERIES["op8_token_counts"](spark, folder).collect()
    assert len(rows) == sum(len(set(own)) for own in lengths.values())
    for r in rows:
        own, n = lengths[r.source], r.n_tokens
        longer = [x for x in own if x >= n]
        assert (r.n_docs, r.docs_from, r.tokens_from) == (own.count(n), len(longer), sum(longer))
        assert (r.docs_in_all, r.tokens_in_all, r.kept_at_limit) == (len(own), sum(own), sum(min(x, n) for x in own))


def test_decontamination(spark, folder, texts):
    items = [(r.item_id, r.text) for r in read_table(spark, folder, "benchmark").collect()]
    expected = dict(zip(texts, brute.contamination(list(texts.values()), items), strict=True))
    for r in QUERIES["op9_decontamination"](spark, folder).collect():
        n, hit, found = expected[r.doc_id]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert tuple(r[1:]) == (n, hit, len(found), digest, hit > 0 and 20 * hit >= n)


def test_quality_measures(spark, folder, texts):
    for r in QUERIES["op10_quality_outliers"](spark, folder).collect():
        found = brute.quality_measures(texts[r.doc_id])
        failed = found[0] < 20 or 100 * found[4] > 30 * found[0]
        assert (*r[1:6], r.base_failed) == (*found, failed)
        assert not (failed and r.kept)


def test_pipeline(spark, folder):
    """Each stage's decisions against the plain version on its own input."""
    stages = dict(corpus_pipeline.STAGES)
    docs = read_table(spark, folder, "documents")
    sober = stages["toxicity"](spark, docs, folder)
    assert sober.columns == docs.columns and 0 < sober.count() <= docs.count()
    alone = stages["jaccard_join"](spark, sober, folder)
    classes = brute.jaccard_classes({r.doc_id: r.text for r in sober.collect()})
    kept = {r.doc_id: r.text for r in alone.collect()}
    assert set(kept) == {d for d, (_, top) in classes.items() if top == d} and alone.columns == docs.columns
    clean = stages["decontamination"](spark, alone, folder)
    items = [(r.item_id, r.text) for r in read_table(spark, folder, "benchmark").collect()]
    judged = dict(zip(kept, brute.contamination(list(kept.values()), items), strict=True))
    ids = {r.doc_id for r in clean.collect()}
    assert ids == {d for d, (n, hit, _) in judged.items() if not (hit and 20 * hit >= n)} and clean.columns == docs.columns
    mixed = stages["source_mixing"](spark, clean, folder)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= ids
    rows = [(r.doc_id, r.text) for r in mixed.collect()]
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in stages["token_files"](spark, mixed, folder).collect())
    assert got == brute.packed_documents(rows, Tokenizer.from_file(tokens.default_vocabulary()))
