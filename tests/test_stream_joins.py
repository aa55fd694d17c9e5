"""Left joins of streams: what is given at once, what is taken back, and what holds in the end."""

import os
import random
import time
import uuid
from datetime import datetime
from decimal import Decimal

import pytest

from millrace.operators import joins
from millrace.session import shared_dir
from millrace.sinks import changelog
from millrace.sinks.reports import start_stream
from millrace.streaming.joins import in_force, left_join_versions

LEFT = "l_id long, l_key string, amount decimal(10,2), at timestamp"
RIGHT = "r_id long, r_key string, name string, score double"


def put(spark, rows, schema, path, at):
    """One file, older than the next one's."""
    out = f"{path}-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(out)
    os.makedirs(path, exist_ok=True)
    part = next(f for f in os.listdir(out) if f.endswith(".parquet"))
    os.rename(f"{out}/{part}", f"{path}/{at:03d}.parquet")
    os.utime(f"{path}/{at:03d}.parquet", (at, at))


def versions_of(spark, batches, tmp_path, **options):
    """All versions of a join whose sides arrive in the given micro-batches: (left rows, right rows) each."""
    paths = [str(tmp_path / side) for side in ("l", "r")]
    for path, schema in zip(paths, (LEFT, RIGHT), strict=True):
        put(spark, [], schema, path, 0)
    left, right = (spark.readStream.schema(s).parquet(p) for s, p in zip((LEFT, RIGHT), paths, strict=True))
    out, state = shared_dir(spark, "versions"), shared_dir(spark, "state")
    versions = left_join_versions(left, right, [("l_key", "r_key")], **options)
    for at, batch in enumerate(batches, 1):
        for path, schema, rows in zip(paths, (LEFT, RIGHT), batch, strict=True):
            if rows:
                put(spark, rows, schema, path, at)
        start_stream(versions, state, changelog.append_changes(out), interval=None).awaitTermination()
    return changelog.read_changes(spark, out, versions.schema)


def left_row(k, key):
    return (k, key, Decimal(k) / 4, datetime(2024, 1, 1, 0, 0, 0, 1000 * k + 7))


def right_row(k, key):
    return (k, key, f"name {k}" if k % 3 else None, k / 7)


def test_a_row_is_given_at_once_and_replaced_later(spark, tmp_path):
    batches = [([left_row(1, "a"), left_row(2, "b"), left_row(3, None)], []), ([], [right_row(1, "a")]), ([left_row(4, "a")], [right_row(2, "a")])]
    changes = versions_of(spark, batches, tmp_path)
    steps = {}
    for r in changes.orderBy("batch_id", "change_place").collect():
        steps.setdefault(r.batch_id, []).append((r.change, r.l_id, r.r_id))
    assert sorted(steps[0]) == [("+", 1, None), ("+", 2, None), ("+", 3, None)]
    assert steps[1] == [("-", 1, None), ("+", 1, 1)]
    assert sorted(steps[2]) == [("+", 1, 2), ("+", 4, 1), ("+", 4, 2)]
    held = in_force(changes, ["l_id", "r_id"], ["batch_id"])
    assert sorted((r.l_id, r.r_id) for r in held.collect() if r.r_id) == [(1, 1), (1, 2), (4, 1), (4, 2)]
    assert held.where("r_id IS NULL").count() == 2
    first = held.where("l_id = 1 AND r_id = 1").first()
    assert (first.amount, first["at"], first.score) == (Decimal("0.25"), datetime(2024, 1, 1, 0, 0, 0, 1007), 1 / 7)


@pytest.mark.parametrize("seed", range(3))
def test_any_arrival_ends_in_the_table_join(spark, tmp_path, seed):
    rnd = random.Random(seed)
    key = lambda: rnd.choice(["a", "a", "a", "b", "c", "d", "e", None])
    lefts, rights = [left_row(k, key()) for k in range(1, 40)], [right_row(k, key()) for k in range(1, 12)]
    cut = [rnd.randrange(4) for _ in range(60)]
    batches = [([r for r in lefts if cut[r[0]] == b], [r for r in rights if cut[-r[0]] == b]) for b in range(4)]
    changes = versions_of(spark, batches, tmp_path, salts=1 + 2 * (seed % 2))
    table = joins.regular_join(spark.createDataFrame(lefts, LEFT), spark.createDataFrame(rights, RIGHT), [("l_key", "r_key")], "left")
    held = in_force(changes, ["l_id", "r_id"], ["batch_id"]).drop("batch_id")
    assert sorted(map(tuple, held.collect()), key=str) == sorted(map(tuple, table.collect()), key=str)
    # every left row had a version in the micro-batch it came in
    shown = {(r.l_id, r.batch_id) for r in changes.where("change = '+'").collect()}
    first = {}
    for l_id, batch in shown:
        first[l_id] = min(batch, first.get(l_id, batch))
    seen = [b for b in range(4) if batches[b][0] or batches[b][1]]
    assert first == {r[0]: seen.index(cut[r[0]]) for r in lefts}


def test_rows_are_forgotten_after_their_time(spark, tmp_path):
    """Processing time: what came before the wait finds no partner after it."""
    paths = [str(tmp_path / side) for side in ("l", "r")]
    put(spark, [left_row(1, "a")], LEFT, paths[0], 1)
    put(spark, [right_row(1, "b")], RIGHT, paths[1], 1)
    left, right = (spark.readStream.schema(s).parquet(p) for s, p in zip((LEFT, RIGHT), paths, strict=True))
    versions = left_join_versions(left, right, [("l_key", "r_key")], ttl_millis=2000)
    out = shared_dir(spark, "versions")
    query = start_stream(versions, shared_dir(spark, "state"), changelog.append_changes(out), interval="1 second")

    def held(n):
        for _ in range(120):
            if os.path.isdir(out.removeprefix("file://")) and (rows := changelog.read_changes(spark, out, versions.schema).collect()) and len(rows) >= n:
                return sorted(((r.change, r.l_id, r.r_id) for r in rows), key=str)
            time.sleep(0.5)
        raise AssertionError("no rows")

    try:
        assert held(1) == [("+", 1, None)]
        time.sleep(4)
        put(spark, [right_row(2, "a")], RIGHT, paths[1], 2)
        put(spark, [left_row(2, "b"), left_row(3, "a")], LEFT, paths[0], 2)
        time.sleep(8)
        changes = held(3)
        assert ("-", 1, None) not in changes and ("+", 1, 2) not in changes and ("+", 2, None) in changes
    finally:
        query.stop()
