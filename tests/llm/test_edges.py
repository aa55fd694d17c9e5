"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import random
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import chat, components, decontaminate, jaccard, mixing, pii, quality, token_files, tokens, toxicity, warc
from millrace.session import shared_dir
from tests.llm import brute


@pytest.fixture(scope="module")
def rows(odd):
    return [(r.doc_id, r.text) for r in odd.collect()]


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tokens string, start int")


def test_chat(spark):
    long_turn = "word <|im_end|>\n\\ " * 3000
    rows = [
        (1, 0, "system", "be kind", "x", 1), (1, 1, "user", None, "x", 1), (1, 1, "assistant", "same turn", "x", 1),
        (1, 2, "assistant", long_turn, "x", 1), (1, 3, None, "no role", "x", 1), (1, None, "user", "no turn", "x", 1),
        (None, 0, "user", "no conversation", "x", 1), (2, 0, "a\n\\b", "<|im_start|>", "x", 1), (2, 0, "a\n\\b", "<|im_start|>", "x", 1),
    ]
    rows += [(3, k, "user" if k % 2 else "assistant", f"turn {k} " * 40, "x", 1) for k in range(2000)]
    budget = chat.Budget(window=600, history=100, least_fresh=200)
    windows = chat.format_windows(chats(spark, rows), budget).cache()
    got = {r.conv_id: r for r in chat.read_windows(windows).collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        own = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        assert [tuple(t) for t in got[conv].turns] == own
        assert got[conv].targets == [t for role, t in own if role == "assistant"]
    assert all(r.tokens <= 600 or r.n_fresh == 1 for r in windows.collect())
    assert windows.where("conv_id = 3 AND n_history > 0").count() > 10
    assert chat.read_windows(chat.format_windows(chats(spark, []))).count() == 0


def test_personal_data(odd, nothing, rows):
    got = [(r.doc_id, [(s.kind, s.start, s.end) for s in r.spans if s.kind in pii.BASE_KINDS]) for r in pii.find_spans(odd).collect()]
    assert sorted(got) == sorted((d, brute.personal(t)) for d, t in rows)
    assert pii.find_spans(nothing).count() == 0


def test_toxicity(spark, odd, nothing):
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0), (9, None), (None, 1), (99, 1), (5, 0)], "doc_id long, toxic int")
    scored = toxicity.with_scores(odd, labels)
    assert scored.count() == odd.count() and set(odd.columns) <= set(scored.columns)
    assert all(0 <= r.score <= 1 for r in scored.collect())
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns
    assert toxicity.score(odd, labels.limit(0)).where("score <> 0").count() == 0
    assert toxicity.score(nothing, labels).count() == 0


def test_jaccard(odd, nothing, rows):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(odd).collect()}
    assert got == {(d, *v) for d, v in brute.jaccard_classes(dict(rows)).items()}
    assert jaccard.jaccard_components(nothing).count() == 0


def test_jaccard_ids_with_several_texts(spark):
    """Links of any text of an id are links of the id."""
    text = lambda p: [f"{p}{k}" for k in range(100)]
    near = [*text("b")[:-1], "other"]
    rows = [(7, text("a")), (7, text("b")), (3, text("a")), (5, near), (7, text("b")), (9, text("c")), (8, ["d"]), (8, [])]
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in rows], "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard.jaccard_components(docs).collect())
    assert got == [(3, 97, 3), (5, 97, 3), (7, 97, 3), (7, 97, 3), (7, 97, 3), (8, 0, 8), (8, 1, 8), (9, 97, 9)]


def test_jaccard_near_copies_in_a_chain(spark):
    """A chain of texts, each linked to the next ones only, and a crowd of near copies, with few signatures kept."""
    words = [f"w{k}" for k in range(400)]
    chain = {k: " ".join(words[3 * k : 3 * k + 100]) for k in range(60)}
    crowd = {1000 + k: " ".join(w if i != k % 100 else f"x{k}" for i, w in enumerate(f"v{j}" for j in range(100))) for k in range(150)}
    texts = {**chain, **crowd}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, jaccard.Join(frequent=4)).collect()}
    assert got == brute.jaccard_classes(texts)


def test_token_files(spark, odd, nothing, rows):
    path = shared_dir(spark, "test-ids")
    token_files.write_token_files(odd, path, docs_per_shard=3)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_documents(spark, path).orderBy("start").collect()]
    assert got == brute.packed_documents([(d, t or "") for d, t in rows], Tokenizer.from_file(tokens.default_vocabulary()))
    manifest = token_files.read_manifest(spark, path).collect()
    assert len(manifest) > 2
    last = token_files.TokenFile(f"{path}/{manifest[-1].file}")
    assert (last.ids(3, 2) == last.ids(0, last.n_ids)[3:5]).all()
    path = shared_dir(spark, "test-ids")
    token_files.write_token_files(nothing, path)
    assert token_files.read_documents(spark, path).count() == 0


def test_token_counts(odd, nothing):
    sums = tokens.with_suffix_sums(tokens.length_histogram(odd))
    assert sums.where("source IS NULL").count() == 2
    assert {r.source: r.kept for r in tokens.kept_at(sums, 0).collect()} == {"a": 0, "b": 0, "c": 0, None: 0}
    assert tokens.with_suffix_sums(tokens.length_histogram(nothing)).count() == 0


def test_archives(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u\r\nv", "x"), (3, "u", "x"), (4, "u", "x"), (None, "u", "x"), (None, "u", "z"), (None, "u", "z"), (5, "u", "é" * 100_000), (6, "u", "y")]
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, digest string")
    path = shared_dir(spark, "test-warc")
    warc.write_archives(pages, path, pages_per_shard=2, roll_bytes=400)
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archives(spark, path).collect())
    assert got == Counter({
        (1, 0, "response", None): 1, (2, 0, "revisit", 1): 1, (3, 1, "response", None): 1, (3, 1, "revisit", 3): 1, (4, 1, "revisit", 3): 1,
        (None, 1, "revisit", 3): 1, (None, 1, "response", None): 1, (None, 1, "revisit", None): 1, (5, 200_000, "response", None): 1, (6, 1, "response", None): 1,
    })
    again = shared_dir(spark, "test-warc")
    warc.write_archives(pages.repartition(3), again, pages_per_shard=2, roll_bytes=400)
    assert sorted(map(tuple, warc.read_manifest(spark, path).collect())) == sorted(map(tuple, warc.read_manifest(spark, again).collect()))
    # short payloads are all responses
    path = shared_dir(spark, "test-warc")
    warc.write_archives(pages, path, least_bytes=2)
    assert warc.read_archives(spark, path).where("record_type = 'revisit'").count() == 0
    path = shared_dir(spark, "test-warc")
    warc.write_archives(pages.limit(0), path)
    assert warc.read_archives(spark, path).count() == 0


def test_decontamination(spark, odd, nothing, rows, monkeypatch):
    items = [(1, "Alpha beta gamma. delta epsilon zeta eta theta iota kappa lambda mu nu xi"), (2, "one two"), (3, None), (4, ""), (1, "One"), (None, "three")]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, n_words int")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontaminate.judged(odd, benchmark).collect())
    plain = brute.contamination([t for _, t in rows], [(i if i is not None else -1, t) for i, t in items])
    expected = sorted((d, n, hit, [i for i in found if i != -1]) for (d, _), (n, hit, found) in zip(rows, plain, strict=True))
    assert got == expected
    # the same with a block for every item
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 1)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in decontaminate.judged(odd, benchmark).collect()) == expected
    bad = {d for d, n, hit, _ in expected if hit and 20 * hit >= n}
    assert {r.doc_id for r in decontaminate.clean(odd, benchmark).collect()} == {d for d, _ in rows} - bad
    assert decontaminate.clean(odd, benchmark).columns == odd.columns
    assert decontaminate.judged(nothing, benchmark).count() == 0
    assert decontaminate.judged(odd, benchmark.limit(0)).where("contaminated").count() == 0


def test_longest_matches(spark, odd):
    benchmark = spark.createDataFrame([(1, "none beta gamma delta epsilon zeta eta none")], "item_id long, text string")
    best = decontaminate.longest_matches(odd, benchmark).orderBy("word").collect()
    assert [(r.word, r.n_words) for r in best] == [(1, 6), (2, 5)] and best[0].doc_id in (7, 8, 9, 10, 11, 13) and best[0].doc_word % 24 == 1


def test_longest_matches_of_long_passages(spark):
    """Of several partial copies that share more than 64 words, the longest counts, with its place."""
    item = [f"w{k}" for k in range(150)]
    for lengths in ([70, 100], [70, 100, 149, 130], [64, 65, 128, 129], [150, 70]):
        docs = spark.createDataFrame([(n, " ".join(["x", *item[:n], "unknown"])) for n in lengths], "doc_id long, text string").coalesce(1)
        best = decontaminate.longest_matches(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
        longest = max(lengths)
        found = {r.word: (r.n_words, r.doc_id, r.doc_word) for r in best.collect()}
        assert found == {k: (longest - k, longest, k + 1) for k in range(longest - 4)}


def test_quality(spark, odd, nothing):
    judged = quality.judge(odd)
    assert judged.count() == odd.count() and judged.where("kept AND n_words < 20").count() == 0
    assert quality.judge(nothing).count() == 0


def test_quality_outlier(spark):
    """In a group of like texts, those full of symbols go and the others stay."""
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8)))
    good = [(k, " ".join(word() for _ in range(60 + k % 30)), "en", "s") for k in range(200)]
    bad = [(1000 + k, " ".join(f"#{word()}$%{j}" for j in range(60)), "en", "s") for k in range(3)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string")
    judged = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert not any(r.base_failed for r in judged.values())
    assert not any(judged[1000 + k].kept for k in range(3))
    assert all(judged[k].kept for k in range(200))


def test_quality_outliers_in_small_groups(spark):
    """Small groups are judged by their language, then by all documents."""
    rnd = random.Random(5)

    def text(again):
        word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
        lines = [" ".join([*(word() for _ in range(6)), "#" * rnd.randint(0, 4)]) for _ in range(rnd.randint(20, 60))]
        return "\n".join(lines + [rnd.choice(lines) for _ in range(int(again * len(lines)))])

    symbols = "\n".join(f"#$%& word{k} *|<> other{k} ###$$$" for k in range(40))
    docs = [(k, text(rnd.random() * 0.2), "en", "s") for k in range(300)]
    docs += [(1000, symbols, "en", "small"), (1001, symbols, "xx", "t"), (1002, text(0), "en", "small"), (1003, text(0), "xx", "t")]
    judged = {r.doc_id: r for r in quality.judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()}
    assert all(not judged[k].base_failed and judged[k].distance is not None for k in range(1000, 1004))
    assert [judged[k].kept for k in range(1000, 1004)] == [False, False, True, True]
    assert sum(judged[k].kept for k in range(300)) >= 297


def test_quality_cutoff():
    """Nearly all lines repeated, in a group whose distances need no scaling, is beyond the cutoff; most varied texts are within."""
    rule = quality.Rule()
    assert quality.CHI_SQUARE_FAR < rule.cutoff < (1.98 / rule.least_spread) ** 2


def test_mixing(odd, nothing):
    mixed = mixing.mix(odd, {"a": 4.0}, seed="s").collect()
    assert all(r.copy >= 1 for r in mixed)
    kept = mixing.mix_rows(odd, {"a": 4.0}, seed="s")
    assert kept.columns == odd.columns and {r["copy"] for r in kept.collect()} == {"c"} and len(kept.collect()) == len(mixed)
    assert mixing.mix(nothing, {}).count() == 0
    rates = {r.source: r.rate for r in mixing.source_rates(odd, {"a": 4.0}).collect()}
    assert set(rates) == {"a", "b", "c", None} and rates["b"] > rates["a"] > 0


@pytest.mark.parametrize("rate", [0.5, 3.0, 40.0, 900.0])
def test_poisson_copies(spark, rate):
    """Mean and variance of the copies are the rate."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('x', 10) AS text", "'s' AS source")
    counts = Counter(r.doc_id for r in mixing.mix(docs, {}, size=rate).select("doc_id").collect())
    values = [counts.get(k, 0) for k in range(4000)]
    mean = sum(values) / 4000
    variance = sum((v - mean) ** 2 for v in values) / 4000
    assert abs(mean - rate) < 5 * (rate / 4000) ** 0.5 and abs(variance / rate - 1) < 0.15


def test_pipeline_on_nothing_and_on_odd_rows(spark, odd, nothing, folder):
    for docs in (nothing, odd):
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, folder)
            assert docs.columns == columns or k == len(corpus_pipeline.STAGES) - 1
        assert {"doc_id", "start", "n_tokens", "ids_crc32"} <= set(docs.columns)
        docs.collect()


def test_jaccard_of_a_template(spark, monkeypatch):
    """Pages of one form, none alike enough to be linked but for a few planted copies, are not compared pair by pair."""
    rnd = random.Random(8)
    form = [f"f{k}" for k in range(200)]
    slots = rnd.sample(range(200), 20)
    texts = {}
    for d in range(1500):
        words = form.copy()
        for slot in slots:
            words[slot] = f"s{rnd.randrange(60)}"
        texts[d] = " ".join(words)
    for d in range(20):
        texts[2000 + d] = texts[d] + f" and more {d}"
    compared = []
    plain = jaccard._perhaps

    def counting(pairs, sets, join):
        compared.append(pairs.count())
        return plain(pairs, sets, join)

    monkeypatch.setattr(jaccard, "_perhaps", counting)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert sum(compared) < 1520 * 1519 // 2 // 10
    assert all(got[2000 + d] == got[d] for d in range(20))
    sets = {d: brute.shingles(t) for d, t in texts.items()}
    top = {d: d for d in texts}

    def find(d):
        return d if top[d] == d else find(top[d])

    for a in texts:
        for b in texts:
            if a < b:
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((find(a), find(b)))
                    top[high] = low
    assert got == {d: find(d) for d in texts}


@pytest.mark.parametrize("seed", range(3))
def test_sketches_never_part_linked_sets(seed):
    rnd = np.random.default_rng(seed)
    join = jaccard.Join()
    for _ in range(200):
        n = int(rnd.integers(1, 2000))
        common, a, b = (rnd.integers(0, 2**63, k).astype(np.uint64) for k in (n, rnd.integers(0, 1 + n // 5), rnd.integers(0, 1 + n // 5)))
        x, y = np.concatenate([common, a]), np.concatenate([common, b])
        bound = jaccard.surely_different(*(jaccard.sketch(z, jaccard.sketch_bits(join, len(z))) for z in (x, y)))
        assert bound <= len(a) + len(b) and (bound > 0 or len(a) + len(b) < 40)


def test_components_are_written_no_more_often_than_they_change(spark, monkeypatch):
    written, plain = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, purpose: written.append(purpose) or plain(df, purpose))
    star = spark.createDataFrame([(k, 1) for k in range(2, 40)] + [(50, 49)], "u long, v long")
    assert sorted(map(tuple, components.components(star).collect())) == [*((k, 1) for k in range(2, 40)), (50, 49)]
    assert len(written) == 1
    rnd = random.Random(5)
    pairs = [(k, k + 1) for k in range(60, 90)] + [(rnd.randrange(100, 200), rnd.randrange(100, 200)) for _ in range(80)]
    top = {x: x for p in pairs for x in p}
    for _ in top:
        for u, v in pairs:
            top[u] = top[v] = min(top[u], top[v])
    got = components.components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {tuple(r) for r in got} == {(u, v) for u, v in top.items() if u != v} and len(got) == len({r.u for r in got})


def test_jaccard_rounds_of_a_crowd_without_links(spark, monkeypatch):
    """A form with long slots: all texts share signatures, none but planted copies are linked, and rounds would spare nothing."""
    rnd, rounds, plain = random.Random(3), [], jaccard._perhaps
    form = [f"form{j}" for j in range(120)]
    texts = {k: " ".join(form[:60] + [f"slot{rnd.randrange(10**6)}" for _ in range(30)] + form[60:]) for k in range(90)}
    texts |= {200 + k: texts[k] + " end" for k in range(0, 90, 9)}
    monkeypatch.setattr(jaccard, "_perhaps", lambda *a: rounds.append(1) or plain(*a))
    for join in (jaccard.Join(frequent=4), jaccard.Join(frequent=4, others_at_once=0), jaccard.Join(frequent=4, others_at_once=0, met_at_once=0)):
        rounds.clear()
        docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, join).collect()}
        assert got == brute.jaccard_classes(texts)
        assert not join.met_at_once or len(rounds) <= 3
