"""Left joins of streams on a store that counts how often it is asked."""

import pandas as pd

from millrace.streaming.joins import _LEFT, _RIGHT, _ROWS_OF_A_PART, LeftJoinVersions
from millrace.streaming.pages import KEY
from tests.test_pages import Times, started


def changes_of(processor, rows, now=0):
    """(key, side, row) in chunks, and what came out in its order."""
    frame = pd.DataFrame(rows, columns=[KEY, "join_side", "join_row"])
    chunks = [frame.iloc[k : k + 50] for k in range(0, len(frame), 50)]
    out = pd.concat([pd.DataFrame(columns=["join_left", "join_right", "change", "change_place"]), *processor.handleInputRows((7,), iter(chunks), Times(now))])
    assert out["change_place"].tolist() == list(range(len(out)))
    return [(r.change, r.join_left, r.join_right if isinstance(r.join_right, str) else None) for r in out.itertuples()]


def test_joins_of_many_keys_are_few_questions():
    processor, store = started(LeftJoinVersions())
    got = changes_of(processor, [(f"k{k % 1000}", _LEFT, f"l{k}") for k in range(3000)])
    assert sorted(got, key=str) == sorted((("+", f"l{k}", None) for k in range(3000)), key=str)
    assert store.calls < 150


def test_a_left_row_that_comes_with_its_partner_never_waits():
    """Also if many others of its group come between them."""
    processor, _ = started(LeftJoinVersions())
    rows = [("a", _LEFT, "l"), *[(f"k{k}", _LEFT, f"x{k}") for k in range(500)], ("a", _RIGHT, "r")]
    assert [c for c in changes_of(processor, rows) if c[1] == "l"] == [("+", "l", "r")]


def test_a_key_with_many_rows_is_not_written_whole():
    processor, store = started(LeftJoinVersions())
    n = 40 * _ROWS_OF_A_PART
    changes_of(processor, [("a", _LEFT, f"l{k}") for k in range(n)])
    store.calls = 0
    assert changes_of(processor, [("a", _LEFT, "last")]) == [("+", "last", None)]
    assert store.calls < 8
    got = changes_of(processor, [("a", _RIGHT, "r"), ("b", _RIGHT, "s")])
    assert len(got) == 2 * (n + 1) and {c[0] for c in got if c[2] is None} == {"-"} and len({c[1] for c in got if c[2] == "r"}) == n + 1
    assert {c[0] for c in changes_of(processor, [("a", _RIGHT, "t")])} == {"+"}
    assert changes_of(processor, [("a", _LEFT, "m")]) == [("+", "m", "r"), ("+", "m", "t")]


def test_rows_of_a_key_are_forgotten_one_by_one():
    processor, _ = started(LeftJoinVersions(ttl_millis=100))
    changes_of(processor, [("a", _LEFT, "old")], now=0)
    changes_of(processor, [("a", _LEFT, "new")], now=60)
    assert changes_of(processor, [("a", _RIGHT, "r")], now=120) == [("-", "new", None), ("+", "new", "r")]
    assert changes_of(processor, [("a", _LEFT, "late")], now=230) == [("+", "late", None)]
