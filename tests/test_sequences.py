"""Visit rules against a row-by-row state machine on random sequences, with ties and boundary gaps."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.operators import trade, visits

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "log_id long, mid string, uid string, ts timestamp, page_id string, last_page_id string, is_new string"


def sequence(seed: int, n: int = 150):
    rng = random.Random(seed)
    at, rows = START + timedelta(hours=rng.randrange(24)), []
    for i in range(n):
        gap = rng.choice([0, 0, 1, 500, 9_999, 10_000, 10_001, 60_000, 3_600_000, 40_000_000, 500_000_000])
        at += timedelta(milliseconds=gap)
        mid = f"{seed}-{rng.randrange(3)}"
        uid = rng.choice([None, "", mid, mid])
        rows.append((i, mid, uid, at, rng.choice(["home", "good_detail", "x"]), rng.choice([None, "", "home", "login"]), rng.choice("01")))
    return rows


ROWS = [row for seed in range(12) for row in sequence(seed)]


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


def by_key(rows, at):
    keys = {}
    for row in sorted(rows, key=lambda r: (r[3], r[0])):
        keys.setdefault(row[at], []).append(row)
    return keys


def entry(row):
    return not row[5]


def day(row):
    return row[3].date()


def expect_repair():
    out = {}
    for mid, rows in by_key(ROWS, 1).items():
        anchor = None
        for r in rows:
            flag = r[6]
            if flag == "1":
                if anchor is None:
                    anchor = day(r)
                elif anchor != day(r):
                    flag = "0"
            elif anchor is None:
                anchor = day(r) - timedelta(days=1)
            out[mid, r[0]] = flag
    return out


def expect_unique():
    out = set()
    for mid, rows in by_key(ROWS, 1).items():
        last = None
        for r in rows:
            if entry(r) and last != day(r):
                out.add((mid, r[0]))
                last = day(r)
    return out


def expect_bounces(timeout=timedelta(seconds=10)):
    out = set()
    for mid, rows in by_key(ROWS, 1).items():
        waiting = None
        for r in rows:
            if waiting and (r[3] - waiting[3] >= timeout or entry(r)):
                out.add((mid, waiting[0]))
            waiting = r if entry(r) else None
        if waiting:
            out.add((mid, waiting[0]))
    return out


def ids(df):
    return {(r.mid, r.log_id) for r in df.collect()}


def test_repair(log):
    got = {(r.mid, r.log_id): r.is_new for r in visits.repair_new_flag(log).collect()}
    assert got == expect_repair()


def test_unique_visitors(log):
    assert ids(visits.unique_visitors(log)) == expect_unique()


@pytest.mark.parametrize("hot_rows", [visits.HOT_ROWS, 155, 0])
@pytest.mark.parametrize("timeout", [10, 7200])
def test_flags(log, hot_rows, timeout):
    flagged = visits.flag_visits(log, f"{timeout} seconds", hot_rows).cache()
    assert {(r.mid, r.log_id): r.is_new for r in flagged.collect()} == expect_repair()
    assert ids(flagged.where("is_unique_visit")) == expect_unique()
    assert ids(flagged.where("is_bounce")) == expect_bounces(timedelta(seconds=timeout))
    assert flagged.count() == len(ROWS)


def test_bounce_rows_are_untouched(log):
    got = {(r.mid, r.log_id): r.is_new for r in visits.bounces(log).collect()}
    original = {(r[1], r[0]): r[6] for r in ROWS}
    assert got == {key: original[key] for key in expect_bounces()}


def test_home_and_detail(log):
    expected = []
    for rows in by_key(ROWS, 1).values():
        last = {}
        for r in rows:
            if r[4] in ("home", "good_detail") and last.get(r[4]) != day(r):
                last[r[4]] = day(r)
                expected.append((r[1], r[3].replace(tzinfo=None), int(r[4] == "home"), int(r[4] == "good_detail")))
    assert sorted(map(tuple, visits.home_detail_visits(log).collect())) == sorted(expected)


def test_logins(log):
    expected = []
    kept = [r for r in ROWS if r[2] and (entry(r) or r[5] == "login")]
    for uid, rows in by_key(kept, 2).items():
        last = None
        for r in rows:
            if last != day(r):
                expected.append((uid, r[3].replace(tzinfo=None), 1, int(last is not None and (day(r) - last).days >= 8)))
                last = day(r)
    got = visits.login_days(visits.logins(log)).select("uid", "ts", "uu_ct", "back_ct")
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert any(row[3] for row in expected)


def test_order_users(log):
    lines = log.select(F.concat("mid", F.lit("-"), F.format_string("%04d", "log_id")).alias("id"), F.col("mid").alias("user_id"), "ts")
    expected = set()
    for mid, rows in by_key(ROWS, 1).items():
        last = None
        for r in rows:
            if last != day(r):
                expected.add(f"{mid}-{r[0]:04d}")
                last = day(r)
    flagged = trade.flag_order_users(lines)
    assert {r.id for r in flagged.where("order_uu_count = 1").collect()} == expected
    assert flagged.count() == len(ROWS)


def test_hot_keys_are_few(spark):
    rows = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("mid"))
    assert [r.mid for r in visits.hot_keys(rows, "mid", 1000).collect()] == [-1]
    assert visits.hot_keys(rows, "mid", 1).count() <= visits.HOT_SHARE
