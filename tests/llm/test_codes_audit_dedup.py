"""Vector codes, the filter audit and the dedup index against plain versions, with odd rows."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import audit, exact_dedup, vector_codes
from millrace.llm.cuckoo import CuckooFilter
from millrace.session import shared_dir

# vector codes


def plain_codes(rows, entries=256, rounds=4):
    """(vec_id, code, error, label_error) by loops over all parts and entries, and the codebooks."""
    kept = []
    for vec_id, vector, label in rows:
        if vector is not None and all(x is not None and np.isfinite(x) and abs(x * 1024) < 2**53 for x in vector):
            kept.append((vec_id, label, [int(np.floor(np.float64(x) * 1024)) for x in vector]))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) if kept else 0
    cuts = [width * k // 4 for k in range(5)]
    whole = [r for r in kept if len(r[2]) == width]
    part = lambda v, p: v[cuts[p] : cuts[p + 1]]
    books = [[part(r[2], p) for r in whole[:entries]] for p in range(4)]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(part(v, p), c, strict=True)), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        after = []
        for p in range(4):
            found = {}
            for _, _, v in whole:
                found.setdefault(near(v, p)[1], []).append(part(v, p))
            after.append([[sum(c) // len(c) for c in zip(*found[e], strict=True)] if e in found else old for e, old in enumerate(books[p])])
        books = after
    out = []
    for vec_id, label, v in kept:
        best = [near(v, p) for p in range(4)] if len(v) == width else None
        out.append((vec_id, label, "".join(f"{e:02x}" for _, e in best) if best else None, sum(d for d, _ in best) if best else None))
    of = {}
    for _, label, _, error in out:
        if error is not None:
            of[label] = of.get(label, 0) + error
    return [(i, c, e, of.get(label)) for i, label, c, e in out], books


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, code string, n int")


def in_order(rows):
    return sorted(rows, key=str)


def check_codes(spark, rows, entries):
    coding = vector_codes.Coding(entries=entries)
    coded, books = vector_codes.compress(frame(spark, rows), coding)
    expected, plain = plain_codes(rows, entries)
    assert in_order(tuple(r[c] for c in ("vec_id", "code", "error", "label_error")) for r in coded.collect()) == in_order(expected)
    assert [[list(map(int, c)) for c in b] for b in books] == plain
    digest = hashlib.sha256(",".join(str(x) for b in plain for c in b for x in c).encode()).hexdigest()
    assert vector_codes.books_digest(books) == digest


def test_codes_of_odd_vectors(spark):
    rnd = random.Random(3)
    vector = lambda: [rnd.choice([-1, 0, 0.5, 0.25]) + rnd.randrange(3) / 1024 for _ in range(8)]
    rows = [(k, vector(), rnd.choice([1, 2, None])) for k in range(120)]
    rows += [(k, rows[5][1], 2) for k in range(500, 540)]
    rows += [
        (200, None, 1), (201, [1.0, None] * 4, 1), (202, [float("nan")] * 8, 1), (203, [float("inf")] * 8, 1), (204, [-float("inf")] + [0.0] * 7, 1),
        (205, [1e300] * 8, 1), (206, [0.5] * 5, 3), (207, [], 3), (None, vector(), 1), (None, vector(), 1), (7, vector(), 1), (7, rows[7][1], 1),
    ]
    check_codes(spark, rows, 16)


def test_codes_where_sums_leave_floating_point(spark):
    """Differences beyond the exact range of doubles, and a width that can't be divided by four."""
    rnd = random.Random(4)
    rows = [(k, [rnd.choice([-1, 1]) * rnd.random() * 3e5 for _ in range(6)], None) for k in range(60)]
    check_codes(spark, rows, 8)


def test_codes_of_few_vectors_and_none(spark):
    check_codes(spark, [(2, [0.1, 0.2, 0.3, 0.4], 1), (1, [0.1, 0.2, 0.3, 0.5], 1)], 256)
    check_codes(spark, [(2, [], 1), (3, [0.5], 1)], 256)
    check_codes(spark, [(2, None, 1)], 256)
    check_codes(spark, [], 256)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(1, 9), st.integers(1, 60), st.integers(1, 6), st.sampled_from([3, 200, 2**40]), st.integers(0, 10**6))
def test_nearest_entries(width, entries, n, values, scale, seed):
    rnd = np.random.default_rng(seed)
    rows, which = vector_codes.distinct_rows(rnd.integers(-values, values, (n, width)) * scale)
    assert (np.diff([tuple(r) for r in rows.tolist()], axis=0) != 0).any(axis=1).all() and rows.tolist() == sorted(rows.tolist())
    book = rnd.integers(-values, values, (entries, width)) * scale
    entry, distance = vector_codes.nearest(rows, book)
    for row, e, d in zip(rows.tolist(), entry.tolist(), distance.tolist(), strict=True):
        assert (d, e) == min((sum((a - b) ** 2 for a, b in zip(row, c, strict=True)), k) for k, c in enumerate(book.tolist()))
    assert len(which) == n


# the filter audit


def plain_audit(rows, labels):
    """Every order worked through document by document."""
    good = {d for d, quality, _ in labels if quality == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    texts = {}
    for doc, text, _ in rows:
        if doc is not None:
            texts[text or ""] = min(doc, texts.get(text or "", doc))
    docs = []
    for doc, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": re.search("[#$%&*|]", text) is not None, "E": doc is not None and texts[text] < doc,
        }
        docs.append((source or "", {f for f in fails if fails[f]}, doc in good, doc in toxic))
    out = []
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        removals = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removals[f] += len(gone)
                failing = sum(f in d[1] for d in own)
                found.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(*r, removals[r[1][r[2] - 1]]) for r in found]
    return out


def test_audit_of_odd_documents(spark, odd, nothing):
    labels = [(7, 1, 1), (8, 1, None), (8, 0, 1), (9, None, 0), (None, 1, 1), (99, 1, 1), (1, 1, 0), (12, 0, 1)]
    table = spark.createDataFrame([(*r, "p") for r in labels], "doc_id long, quality int, toxic int, part string")
    symbols = "Some #words and $others " * 60
    more = [(20, symbols, ""), (21, symbols, "a"), (None, symbols, "a"), (None, None, "b"), (2, "", "z"), (30, "ABC " * 300, "a")]
    extra = spark.createDataFrame(more, "doc_id long, text string, source string")
    docs = odd.unionByName(extra, allowMissingColumns=True)
    got = sorted(tuple(r) for r in audit.interactions(docs, table).collect())
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()] + more
    assert got == sorted(plain_audit(rows, labels))
    assert audit.interactions(nothing, table).count() == 0
    unlabelled = audit.interactions(docs, table.limit(0))
    assert unlabelled.count() == len(got) and unlabelled.where("good_lost + toxic_lost > 0").count() == 0


def test_potentials_give_shapley_values():
    rnd = np.random.default_rng(1)
    counts = rnd.integers(0, 50, (3, 32))
    v = audit.worths(counts)
    potential, factor = audit.scaled_potentials(v)
    for part in range(3):
        for k in range(5):
            total = 0
            for order in permutations(range(5)):
                before = sum(1 << x for x in order[: order.index(k)])
                total += v[part, before | 1 << k] - v[part, before]
            assert total * factor == 120 * (potential[part, 31] - potential[part, 31 ^ 1 << k])


# the dedup index


def plain_dedup(rows):
    """(doc_id, keep_id, group_size, text_sha256) and the number of rows kept per digest."""
    groups = {}
    for doc, text in rows:
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()
        groups.setdefault(digest, []).append(doc)
    least = {d: min((x for x in own if x is not None), default=None) for d, own in groups.items()}
    return sorted(((doc, least[d], len(own), d) for d, own in groups.items() for doc in own), key=str)


def decided(rows):
    rows = rows.collect()
    kept = [r for r in rows if r.kept]
    assert all(r.doc_id == r.keep_id for r in kept)
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str), sorted(r.text_sha256 for r in kept)


def test_dedup_of_odd_documents(spark, odd, nothing):
    more = [(None, "One"), (None, "lonely"), (None, "lonely"), (40, "a\tb"), (39, "a \n b"), (41, "a b "), (42, " \x0b\x0c"), (43, "a\xa0b")]
    docs = odd.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got, kept = decided(exact_dedup.deduplicate(docs, shared_dir(spark, "test-dedup")))
    assert got == plain_dedup(rows) and kept == sorted({d for *_, d in got})
    assert exact_dedup.deduplicate(nothing, shared_dir(spark, "test-dedup")).count() == 0


def test_index_over_batches(spark, monkeypatch):
    """Batches, a smaller id that comes later, deletion, files put together, filters that overflow, and an index opened anew."""
    monkeypatch.setattr(exact_dedup, "LEAST_BUCKETS", 3)
    monkeypatch.setattr(exact_dedup.DedupIndex, "files_at_most", 3)
    path = shared_dir(spark, "test-dedup")
    exact_dedup.DedupIndex.create(spark, path, 10)
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    rnd = random.Random(6)
    ids, live = rnd.sample(range(10, 10**6), 3000), []
    for batch in range(5):
        index = exact_dedup.DedupIndex.open(spark, path)
        assert (index.version, index.buckets) == (batch, 3)
        new = [(d, f"text {rnd.randrange(400)}") for d in ids[600 * batch : 600 * batch + 600]]
        held = index.insert(frame(new))
        live += new
        expected = plain_dedup(live)
        got, _ = decided(index.decided(held))
        own = {d for d, _ in new}
        assert set(got) == {r for r in expected if r[0] in own} and index.content().count() == len({t for _, t in live})
    states = index.manifest().collect()
    assert sum(s.n_keys for s in states) == len({t for _, t in live}) and all(s.n_resizes > 0 for s in states) and max(len(s.files) for s in states) <= 3
    # the first half of the texts is withdrawn, and some of an index that never were in it
    gone = {f"text {k}" for k in range(200)}
    index.delete(frame([(0, t) for t in gone] + [(0, "never there"), (0, None)]))
    live = [r for r in live if r[1] not in gone]
    assert index.content().count() == sum(s.n_keys for s in index.manifest().collect()) == len({t for _, t in live})
    again = [(5, "text 3"), (6, "text  3"), (7, "text 300")]
    got, kept = decided(index.decided(index.insert(frame(again))))
    assert [g[:3] for g in got[:2]] == [(5, 5, 2), (6, 5, 2)] and got[2][2] == 1 + sum(t == "text 300" for _, t in live)
    assert exact_dedup.digest_of("text 3").hex() in kept


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 7), st.integers(1, 400))
def test_cuckoo_filter(seed, power, n):
    rnd = np.random.default_rng(seed)
    held = CuckooFilter(1 << power)
    inside = np.zeros((0, 2), np.uint64)
    for _ in range(6):
        keys = rnd.integers(0, 2**63, (n, 2)).astype(np.uint64)
        before = held.slots.copy()
        if held.insert(keys):
            inside = np.concatenate([inside, keys])
        else:
            assert (held.slots == before).all() and len(inside) + n > 0.7 * held.slots.size
        assert held.contains(inside).all()
        gone = rnd.random(len(inside)) < 0.3
        held.delete(inside[gone])
        inside = inside[~gone]
        assert held.contains(inside).all() and (held.slots > 0).sum() == len(inside)
        held = CuckooFilter.from_bytes(held.to_bytes())
    strange = rnd.integers(0, 2**63, (2000, 2)).astype(np.uint64)
    assert held.contains(strange).mean() < 0.01


def test_cuckoo_filter_of_one_fingerprint():
    """More equal fingerprints than two buckets have places don't fit."""
    keys = np.stack([np.full(9, 5, np.uint64), np.full(9, 7, np.uint64)], axis=1)
    held = CuckooFilter(64)
    assert not held.insert(keys) and held.insert(keys[:8]) and not held.insert(keys[:1])
    held.delete(keys[:8])
    assert not held.slots.any()


@pytest.mark.parametrize("n", [1, 3, 4, 100, 5000])
def test_cuckoo_filter_has_room(n):
    keys = np.random.default_rng(n).integers(0, 2**63, (n, 2)).astype(np.uint64)
    assert CuckooFilter.for_keys(n).insert(keys)
