"""Parts of the operators on random small inputs, against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import decontaminate, jaccard, pii, quality, tables, token_files, tokens, toxicity, warc
from millrace.llm.words import LETTER_OR_DIGIT, NOT_SPACE, find_words, slices
from tests.llm import brute

PIECES = ["a", "b", "@", ".", "-", "1", "42", " ", "+", "%", "(", "é", "255", "300", "😀", "\n", "4111 1111 1111 1111", "1.2.3.4", "account: "]
texts_of = lambda pieces: st.lists(st.sampled_from(pieces), max_size=40).map("".join)


@settings(max_examples=500, deadline=None)
@given(texts_of(PIECES))
def test_spans_by_anchors(text):
    found = [(kind, a, b) for a, b, kind in pii.Finder().spans(text) if kind in pii.BASE_KINDS]
    assert found == brute.personal(text)


def test_added_kinds():
    text = "see https://a.example/x?y=1. IBAN DE89 3704 0044 0532 0130 00, account no: 12345678 by @some_one"
    kinds = {kind: text[a:b] for a, b, kind in pii.Finder().spans(text)}
    assert kinds["url"] == "https://a.example/x?y=1" and kinds["account"] == "12345678" and kinds["handle"] == "@some_one"
    assert kinds["iban"] == "DE89 3704 0044 0532 0130 00"
    assert pii.masked("mail a@b.cd now", [(5, 11, "email")]) == "mail [EMAIL] now"


@settings(max_examples=200, deadline=None)
@given(st.lists(texts_of(["W1", "w2", "É3", " ", "\n", ". ", "\x0b", "~", "😀"]), max_size=6))
def test_words(texts):
    column = pa.array(texts, pa.large_string())
    for allowed, words_of in ((LETTER_OR_DIGIT, brute.bench_words), (NOT_SPACE, lambda t: __import__("re").findall(r"[^\x20\x09-\x0D]+", t))):
        words = find_words(column, allowed, lower=allowed is LETTER_OR_DIGIT)
        assert words.counts.tolist() == [len(words_of(t)) for t in texts]
        names: dict = {}
        for value, name in zip(words.hashes.tolist(), [w for t in texts for w in words_of(t)], strict=True):
            assert names.setdefault(value, name) == name
        assert len(names) == len({w for t in texts for w in words_of(t)})


def test_slices_keep_every_row_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (3, 0, 50, 1, 1, 9)])], names=["text"])
    parts = list(slices(batch, limit=10))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or sum(map(len, p.column(0).to_pylist())) <= 10 for p in parts)


@pytest.mark.parametrize("seed", range(40))
def test_suffix_arrays(seed):
    rnd = random.Random(seed)
    vocabulary = rnd.choice([2, 3, 8, 40])
    make = lambda n: " ".join(rnd.choice("Wé") + str(rnd.randrange(vocabulary)) for _ in range(n))
    items = [(j, make(rnd.choice([0, 1, 3, 12, 13, 14, 30]))) for j in range(rnd.randint(0, 5))]
    texts = [f"{make(rnd.randint(0, 60))} {rnd.choice(['', *[t for _, t in items]])} {make(3)}" for _ in range(rnd.randint(1, 8))]
    block = decontaminate.make_block(items)
    words = find_words(pa.array(texts, pa.large_string()), LETTER_OR_DIGIT, lower=True)
    shard = decontaminate.make_shard(words, block)
    hit, text, item = decontaminate.hits(shard, block)
    ends = shard.first + words.counts
    got = [
        (int(n), int(hit[a:b].sum()), sorted({block.item_ids[i] for i in item[text == d]}))
        for d, (n, a, b) in enumerate(zip(words.counts, shard.first, ends, strict=True))
    ]
    assert got == brute.contamination(texts, items)
    suffix = lambda stream, at: stream[at : at + int(np.flatnonzero(stream[at:] == 0)[0])].tolist()
    all_suffixes = [suffix(shard.stream, at) for at in shard.array]
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    length, _ = shard.longest(block)
    assert length.tolist() == [max([0, *(common(suffix(block.suffixes, at), s) for s in all_suffixes)]) for at in block.suffix_item]


@pytest.mark.parametrize("bits", [1, 5, 16, 17, 31])
def test_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype(np.uint32)
    assert (token_files.unpack(token_files.pack(ids, bits), bits, 1000) == ids).all()
    assert token_files.bits_for(50257) == 16 and token_files.bits_for(1) == 1


def test_encoder():
    own, rnd = tokens.Encoder(tokens.default_vocabulary()), random.Random(1)
    for _ in range(60):
        pieces = ["a", " ", "  ", "\n", "the", "é", "<|endoftext|>", "don't", " 12", "\x1c", "Ġ", "!", "😀", " x"]
        texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 15))) for _ in range(8)]
        ids, first = own.encode(pa.array(texts))
        plain = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)] == plain


@pytest.mark.parametrize("percent", [60, 85, 95])
def test_linked_sets_share_a_signature(percent):
    """Pairs at the edge of the bound, in one band and across bands, over sizes where segments are small."""
    join, rnd = jaccard.Join(percent=percent), random.Random(percent)
    for _ in range(150):
        n = rnd.choice([6, 9, 14, 20, 21, 40, 72, 108, 150])
        a = {rnd.getrandbits(63) for _ in range(n)}
        b = set(a)
        while True:
            c = set(b)
            if rnd.random() < 0.5 and len(c) > 1:
                c.discard(rnd.choice(sorted(c)))
            else:
                c.add(rnd.getrandbits(63))
            if 100 * len(a & c) < percent * len(a | c):
                break
            b = c
        if a == b:
            continue
        both = [np.array(sorted(s), np.uint64) for s in (a, b)]
        sets = jaccard.Sets(np.concatenate(both), np.cumsum([0, *map(len, both)]))
        sig, text, _ = jaccard.signatures(sets, np.arange(2), join)
        assert set(sig[text == 0].tolist()) & set(sig[text == 1].tolist()), (len(a), len(b), len(a & b))
        # the second split, with any shingles taken out of both
        share = rnd.choice([0.0, 0.3, 0.9, 1.0])
        out = {x for x in sorted(a | b) if rnd.random() < share}
        rest = [np.array(sorted(s - out), np.uint64) for s in (a, b)]
        sets = jaccard.Sets(np.concatenate(rest), np.cumsum([0, *map(len, rest)]))
        sig, text, note = jaccard.signatures(sets, np.arange(2), join, np.array([len(a), len(b)]))
        enough = [(text == k).any() and note[text == k].min() >= 0 for k in (0, 1)]
        assert not any(enough) or set(sig[text == 0].tolist()) & set(sig[text == 1].tolist()), (len(a), len(b), len(a & b), len(out))


@settings(max_examples=200, deadline=None)
@given(st.lists(texts_of(["a", "b", "c", " ", "\n", "#", "é", "\x0b", "a b c a b c a b "]), max_size=5))
def test_measures(texts):
    found = quality.measures(pa.array(texts, pa.large_string()))
    assert list(zip(*(found[m].tolist() for m in quality.MEASURES[:5]), strict=True)) == [brute.quality_measures(t) for t in texts]


def test_archive_record():
    member = warc.page_record(5, 0, "http://a.example/\r\nx", "é".encode(), None, "2020-01-01T00:00:00Z")
    (plain,) = warc.members(__import__("io").BytesIO(member), piece=7)
    headers, block = warc.parse_record(plain)
    assert headers["WARC-Target-URI"] == "http://a.example/ x" and block.endswith("\r\n\r\né".encode())
    assert headers["WARC-Payload-Digest"] == f"sha1:{warc.digest32('é'.encode())}"


def test_toxicity_counts_of_large_vocabularies(spark):
    """Each expression has counts of its own, and joined counts give the scores of broadcast ones."""
    words = spark.range(1_500_000).selectExpr("concat('w', hex(id)) AS word", "2L AS n0", "0L AS n1")
    counts = toxicity._counts(words, toxicity.Settings(broadcast_entries=0))
    keys = toxicity._keys(pa.array(["wABCDE", "w12345"]))
    own = counts.rows.where(F.col("key").isin(keys.tolist())).collect()
    assert [(r.c0, r.c1) for r in own] == [(2, 0)] * 2
    assert counts.table is None and counts.total.tolist() == [3_000_000, 0] and counts.different == 1_500_000


def test_words_of_scripts_without_spaces():
    words, first = toxicity.words_of(pa.array(["Ab, ÇD e1", None, "你好 x", "“a”–b"]))
    found = [[w for w in words.to_pylist()[a:z] if w] for a, z in zip(first, first[1:], strict=False)]
    assert found == [["ab", "çd", "e1"], [], ["你", "好", "x"], ["a", "b"]]


def test_toxicity_joined_or_broadcast(spark, documents):
    docs = documents.limit(300).unionByName(documents.limit(5))
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 4 = 0 AS int) AS toxic").distinct()
    rows = [sorted(toxicity.score(docs, labels, toxicity.Settings(broadcast_entries=n)).collect()) for n in (0, 4_000_000)]
    assert [r[:1] + r[2:] for r in rows[0]] == [r[:1] + r[2:] for r in rows[1]]
    assert all(abs(a.score - b.score) < 1e-9 for a, b in zip(*rows, strict=True))


@pytest.mark.parametrize("text", ["User ID: 12345678", "İ Customer No 4711001", "User Id 12345678", "uSeR iD 12345678", "Https://example.org/a", "SSN 123456789"])
def test_cues_of_any_case(text):
    found = [(text[a:b], kind) for a, b, kind in pii.Finder().spans(text) if kind in ("account", "url")]
    assert found == [(text.split(" ")[-1], "url" if "://" in text else "account")]


def test_token_workers_get_small_batches(spark, tmp_path, monkeypatch):
    """Whole batches of 64 MB beside what is taken from them at once went over an executor's memory."""

    def watched(batch, *args, **named):
        if batch.nbytes > 3 * tokens.BYTES_AT_ONCE:
            raise AssertionError(f"{batch.nbytes} bytes in a batch")
        return slices(batch, *args, **named)

    monkeypatch.setattr(token_files, "slices", watched)
    before = spark.conf.get(tables.BATCH_BYTES)
    docs = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "repeat('some words ', 30000) AS text")
    token_files.write_token_files(docs, str(tmp_path / "ids"))
    back = token_files.read_documents(spark, str(tmp_path / "ids")).collect()
    assert len({r.doc_id for r in back}) == 40 and len({r.ids_crc32 for r in back}) == 1
    assert spark.conf.get(tables.BATCH_BYTES) == before


@pytest.mark.parametrize("one_hash", [False, True])
def test_pieces_met_again_and_again_are_encoded_once(monkeypatch, one_hash):
    monkeypatch.setattr(tokens, "PIECES_AT_MOST", 60)
    if one_hash:  # pieces are told apart by their bytes
        monkeypatch.setattr(tokens, "text_hashes", lambda data, offsets: np.ones(len(offsets) - 1, np.uint64))
    own, asked = tokens.Encoder(tokens.default_vocabulary()), []
    whole = own._whole
    monkeypatch.setattr(own, "_whole", lambda texts: asked.extend(texts) or whole(texts))
    plain = lambda text: own.tokenizer.encode(text, add_special_tokens=False).ids
    for k in range(12):
        texts = ["start " + " ".join(f"often sélten {k}x{j}" for j in range(10 * i, 10 * i + 10)) for i in range(3)] + [None, "", "a  b"]
        ids, first = own.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [plain(t or "") for t in texts]
    assert one_hash or sum(" often" in t for t in asked) == sum(" sélten" in t for t in asked) == 1
