"""Chunks read at any time, in any order, with any changes in between, end in the table itself."""

import random

import pytest

from millrace.sources.snapshot import READ, cut_over, current_rows


@pytest.mark.parametrize("seed", range(4))
def test_any_interleaving_ends_in_the_table(spark, seed):
    rnd = random.Random(seed)
    n_chunks, end = 4, 200
    history, log = [{}], []
    for seq in range(1, end + 1):
        state = dict(history[-1])
        key = rnd.randrange(24)
        op = "d" if key in state and rnd.random() < 0.3 else ("u" if key in state else "c")
        if op == "d":
            del state[key]
        else:
            state[key] = f"v{seq}"
        log.append((key, None if op == "d" else f"v{seq}", key % n_chunks, op, seq))
        history.append(state)
    marks, rows = [], []
    for chunk in range(n_chunks):
        low = rnd.randrange(end)
        high = min(end, low + rnd.choice([0, 1, 10, 60]))
        seen = history[rnd.randint(low, high)]
        marks.append((chunk, low, high))
        rows += [(k, v, chunk) for k, v in seen.items() if k % n_chunks == chunk]
    lowest = min(m[1] for m in marks)
    changes = cut_over(
        spark.createDataFrame(rows, "id int, v string, chunk int"),
        spark.createDataFrame([r for r in log if r[4] > lowest], "id int, v string, chunk int, op string, seq int"),
        spark.createDataFrame(marks, "chunk int, low int, high int"), ["id"],
    )
    table = current_rows(changes, ["id"])
    assert {r.id: r.v for r in table.collect()} == history[-1] and table.columns == ["id", "v", "chunk"]
    got = changes.collect()
    assert len({(r.id, r.seq) for r in got}) == len(got)
    low = {m[0]: m[1] for m in marks}
    assert all((r.op == READ) == (r.seq == low[r.chunk]) and r.seq >= low[r.chunk] for r in got)


def test_chunks_not_yet_read(spark):
    rows = spark.createDataFrame([(1, "a", 0)], "id int, v string, chunk int")
    log = spark.createDataFrame([(2, "b", 1, "c", 5), (1, "c", 0, "u", 9)], "id int, v string, chunk int, op string, seq int")
    marks = spark.createDataFrame([(0, 3, 4)], "chunk int, low int, high int")
    assert sorted((r.id, r.v, r.op, r.seq) for r in cut_over(rows, log, marks, ["id"]).collect()) == [(1, "a", READ, 3), (1, "c", "u", 9)]
