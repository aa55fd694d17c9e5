"""Lookups as of a row's time: both plans against a search by hand, on random versions with ties, deletions and gaps."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.asof import Versions, as_of_chunks, as_of_ranges


def by_hand(rows, versions):
    out = []
    for key, ts, n in rows:
        found = [(since, seq, name, gone) for k, since, seq, name, gone in versions if k == key and key is not None and None not in (since, ts) and since <= ts]
        last = max(found, default=None, key=lambda v: v[:2])
        out.append((key, ts, n, last[2] if last and not last[3] else None, bool(last and not last[3])))
    return out


def frames(spark, rows, versions):
    instant = lambda df, c: df.withColumn(c, F.timestamp_millis(c))
    asked = instant(spark.createDataFrame(rows, "code string, ts long, n int"), "ts")
    changes = instant(spark.createDataFrame(versions, "code string, since long, seq int, name string, gone boolean"), "since")
    return asked, Versions(changes, ["code"], "since", ["name"], ["seq"], "gone")


@pytest.mark.parametrize("seed", range(4))
def test_random_versions(spark, seed):
    rnd = random.Random(seed)
    key = lambda: rnd.choice(["a"] * 6 + ["b", "c", None])
    time = lambda: rnd.choice([None, *range(-5, 60)])
    versions = [(key(), time(), k, rnd.choice([f"name {k}", None]), rnd.random() < 0.2) for k in range(40)]
    rows = [(key(), time(), k) for k in range(200)]
    asked, table = frames(spark, rows, versions)
    expected = by_hand(rows, versions)
    everything = sorted([(k, n, name) for k, _, n, name, _ in expected], key=str)
    held = sorted([(k, n, name) for k, _, n, name, known in expected if known], key=str)
    plans = [as_of_ranges] + [lambda *a, c=c, **o: as_of_chunks(*a, **o, chunk_millis=c) for c in (1, 7, 1000)]
    for plan in plans:
        for inner, wanted in ((False, everything), (True, held)):
            got = plan(asked, table, ["code"], "ts", inner=inner)
            assert got.columns == ["code", "ts", "n", "name"]
            assert sorted([(r.code, r.n, r.name) for r in got.collect()], key=str) == wanted


def test_several_keys_and_no_versions(spark):
    asked, table = frames(spark, [("a", 5, 1), ("b", 5, 2)], [("a", 1, 0, "x", False), ("b", 6, 0, "y", None)])
    double = Versions(table.rows.withColumn("n", F.lit(1)), ["code", "n"], "since", ["name", "gone"])
    for plan in (as_of_ranges, as_of_chunks):
        assert sorted(map(tuple, plan(asked, double, ["code", "n"], "ts").select("n", "name", "gone").collect())) == [(1, "x", False), (2, None, None)]
        none = Versions(table.rows.limit(0), ["code"], "since", ["name"])
        assert plan(asked, none, ["code"], "ts").where("name IS NULL").count() == 2
        assert plan(asked, none, ["code"], "ts", inner=True).count() == 0


def test_a_hot_key_is_dealt_over_its_chunks(spark):
    """The last window runs over key and chunk, and versions are not joined to every row."""
    asked, table = frames(spark, [("a", k, k) for k in range(100)], [("a", k, k, f"v{k}", False) for k in range(0, 100, 10)])
    plan = as_of_chunks(asked, table, ["code"], "ts", chunk_millis=10)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "_asof_chunk" in text.split("Window")[1] and "Cartesian" not in text
    assert [r.name for r in plan.orderBy("n").collect()] == [f"v{k // 10 * 10}" for k in range(100)]


@pytest.mark.parametrize("seed", range(2))
def test_pages_of_pages(spark, seed):
    """Several levels, in the order of the search by hand."""
    rnd = random.Random(seed)
    versions = [(rnd.choice("aaab"), rnd.randrange(400), k, f"name {k}", rnd.random() < 0.2) for k in range(300)]
    rows = [(rnd.choice("abc"), rnd.randrange(-9, 450), k) for k in range(300)]
    asked, table = frames(spark, rows, versions)
    wanted = sorted([(k, n, name) for k, _, n, name, _ in by_hand(rows, versions)], key=str)
    for page in (2, 5, 64, 1000):
        got = as_of_ranges(asked, table, ["code"], "ts", page=page)
        assert sorted([(r.code, r.n, r.name) for r in got.collect()], key=str) == wanted


def test_a_row_does_not_meet_all_versions_of_its_key(spark):
    """Joins are equalities of key and page, of which there are few per row."""
    asked, table = frames(spark, [("a", k, k) for k in range(50)], [("a", k, k, f"v{k}", False) for k in range(50)])
    got = as_of_ranges(asked, table, ["code"], "ts", page=4)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert len(joins) == 3 and not any("<" in line or ">" in line for line in joins)
    assert [r.name for r in got.orderBy("n").collect()] == [f"v{k}" for k in range(50)]
