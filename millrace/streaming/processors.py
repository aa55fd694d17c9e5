"""Keyed state for the rules that follow one key's rows through a stream.

A key's rows of one micro-batch are put in ``(ts, log_id)`` order first. They can come in several chunks; how many is
bounded by the rate limit of the source. Where a rule keeps few rows, chunks are reduced before they are held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from millrace.streaming.pages import GROUP, KEY, Pages

_DAY_MILLIS = 24 * 3600 * 1000

#: Event time in milliseconds since 1970 UTC, next to ``ts``. Columns whose names begin with an underscore lose them on the way to Python.
MILLIS = "event_millis"


def _days(ts: pd.Series) -> pd.Series:
    """Dates as text, each different one written once."""
    codes, days = pd.factorize(ts.dt.normalize())
    return pd.Series(np.append(days.strftime("%Y-%m-%d").to_numpy(dtype=object), None)[codes], index=ts.index, dtype=object)


def _plain(frame: pd.DataFrame, columns: list[str]) -> list[tuple]:
    """Rows as plain values, with None for missing ones."""
    part = frame[columns].astype(object)
    return list(part.where(part.notna(), None).itertuples(index=False, name=None))


class FirstOfDay(StatefulProcessor):
    """Marks rows whose date differs from the last marked row's date of their key, for a group of keys (``pages.with_groups``).

    Adds ``previous_day`` (text, null at first) and ``is_first`` (0/1). Unless ``keep_all``, only marked rows go on.

    State of idle keys goes away in one of two ways. ``ttl_millis``: so long after it was written, in processing time.
    ``expire``: by an event-time timer at the first midnight (UTC) two days after the row that set it, so at least a day after its date has ended in any zone; a row
    that is not late has another date by then anyway, so only ``previous_day`` depends on it.

    Times of timers come from the column ``MILLIS``, made by Spark: ``ts`` reaches Python as a local time without its zone.
    """

    def __init__(
        self, order: tuple[str, ...], keep_all: bool = False, expire: bool = False, ttl_millis: int | None = None
    ):
        self.order = list(order)
        self.keep_all = keep_all
        self.expire = expire
        self.ttl_millis = ttl_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        # by key: the day, and when it goes away (with a time to live: when it was written)
        self.last_days = Pages(handle, "last_days", self.ttl_millis)

    def _goes(self, at: int, now: int) -> int | None:
        if self.ttl_millis is not None:
            return now
        return -(-(at + 2 * _DAY_MILLIS) // _DAY_MILLIS) * _DAY_MILLIS if self.expire else None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        by, chunks = [KEY, *self.order], []
        for chunk in rows:
            chunk = chunk.sort_values(by).assign(_day=lambda f: _days(f["ts"]))
            if not self.keep_all:  # within a chunk only the first row of a run of equal dates can be marked
                chunk = chunk[(chunk[KEY] != chunk[KEY].shift()) | (chunk["_day"] != chunk["_day"].shift())]
            chunks.append(chunk)
        frame = pd.concat(chunks).sort_values(by, ignore_index=True) if len(chunks) > 1 else chunks[0].reset_index(drop=True)
        starts = np.flatnonzero(frame[KEY] != frame[KEY].shift())
        keys = frame[KEY].iloc[starts].tolist()
        now = timerValues.getCurrentProcessingTimeInMs() if self.ttl_millis is not None else 0

        def gone(value) -> bool:
            return self.ttl_millis is not None and value[1] + self.ttl_millis <= now

        self.last_days.open()
        held = [self.last_days.get(k) for k in keys]
        before = frame["_day"].shift().astype(object)
        before.iloc[starts] = pd.Series([v[0] if v is not None and not gone(v) else None for v in held], dtype=object)
        first = frame["_day"] != before
        # the date before a marked row is the date of the row before it, as unmarked rows share their mark's date
        frame = frame.assign(previous_day=before.where(before.notna(), None), is_first=first.astype("int64"))
        ends = np.append(starts[1:], len(frame)) - 1
        changed = np.logical_or.reduceat(first.to_numpy(dtype=bool), starts)
        days, times = frame["_day"].iloc[ends].tolist(), frame[MILLIS].iloc[ends].tolist()
        first_goes = None
        for k in np.flatnonzero(changed).tolist():
            goes = self._goes(int(times[k]), now)
            self.last_days.put(keys[k], [days[k], goes])
            if self.expire and (first_goes is None or goes < first_goes):
                first_goes = goes
        self.last_days.prune(gone)
        if first_goes is not None:
            self.last_days.wake(first_goes)
        self.last_days.save()
        frame = frame.drop(columns=["_day", KEY, GROUP])
        yield frame if self.keep_all else frame[first.to_numpy()]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        self.last_days.open()
        self.last_days.sweep(lambda value: value[1] <= passed, lambda value: value[1])
        return iter(())

    def close(self) -> None:
        pass


class FirstInWindow(StatefulProcessor):
    """Marks the first row of each member of a key's window (0/1 in ``is_first``); rows without member are not marked.

    The state is an entry for every member, in pages: a row looks up its own, and no set of all members is read or written. Grouping keys hold the window; an event-time timer at
    its end, in the column ``ends`` (milliseconds), clears it.
    """

    def __init__(self, member: str, ends: str):
        self.member = member
        self.ends = ends

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.members = Pages(handle, "members")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self.members.open()
        for chunk in rows:
            self.members.wake(int(chunk[self.ends].iloc[0]))
            member = chunk[self.member]
            fresh = [m for m in member.dropna().unique().tolist() if self.members.get(m) is None]
            for m in fresh:
                self.members.put(m, 1)
            yield chunk.assign(is_first=(member.isin(fresh) & ~member.duplicated()).astype("int64"))
        self.members.save()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.members.clear()
        return iter(())

    def close(self) -> None:
        pass


class NewFlagRepair(StatefulProcessor):
    """Keeps each device's first-visit date and turns ``is_new`` to '0' on rows marked new on another date."""

    def __init__(self, order: tuple[str, ...]):
        self.order = list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.anchor = handle.getValueState("anchor", "day string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if self.anchor.exists():
            anchor = self.anchor.get()[0]
        else:
            rows = list(rows)
            first = pd.concat([chunk.nsmallest(1, self.order[0], keep="all") for chunk in rows])
            first = first.sort_values(self.order).iloc[0]
            marked_new = first["is_new"] == "1"
            anchor = (first["ts"] - pd.Timedelta(days=0 if marked_new else 1)).strftime("%Y-%m-%d")
            self.anchor.update((anchor,))
        for chunk in rows:
            wrong = (chunk["is_new"] == "1") & (_days(chunk["ts"]) != anchor)
            yield chunk.assign(is_new=chunk["is_new"].mask(wrong, "0"))

    def close(self) -> None:
        pass


class Bounces(StatefulProcessor):
    """Emits a visit start once it is clear that nothing follows it within ``timeout_millis``.

    The last visit start waits in state for the device's next row or for its event-time timer. The gap to the next
    row decides, not whether the timer fired before it.
    """

    def __init__(self, schema: StructType, order: tuple[str, ...], timeout_millis: int):
        self.schema = schema
        self.columns = schema.fieldNames()
        self.order = list(order)
        self.timeout_millis = timeout_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", self.schema)
        self.timer = handle.getValueState("timer", "at long")

    def _frame(self, values: tuple) -> pd.DataFrame:
        return pd.DataFrame([values], columns=self.columns)

    def _forget(self) -> None:
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
            self.timer.clear()
        self.waiting.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(self.order)[self.columns]
        if self.waiting.exists():
            frame = pd.concat([self._frame(tuple(self.waiting.get())).astype(frame.dtypes), frame])
            self._forget()
        entry = frame["last_page_id"].fillna("") == ""
        late = frame[MILLIS].shift(-1) - frame[MILLIS] >= self.timeout_millis
        has_next = pd.Series(True, index=range(len(frame)))
        has_next.iloc[-1] = False
        bounce = entry.to_numpy() & has_next.to_numpy() & (late.to_numpy() | entry.shift(-1, fill_value=False).to_numpy())
        if entry.iloc[-1]:
            last = frame.tail(1)
            self.waiting.update(_plain(last, self.columns)[0])
            at = int(last[MILLIS].iloc[0]) + self.timeout_millis
            self.timer.update((at,))
            self.handle.registerTimer(at)
        if bounce.any():
            yield frame[bounce]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.waiting.exists():
            yield self._frame(tuple(self.waiting.get()))
            self.waiting.clear()
            self.timer.clear()

    def close(self) -> None:
        pass


class LatestAfterDelay(StatefulProcessor):
    """Holds the newest version of a key by ``version`` and emits it a fixed time after its first version came.

    Versions that come later start a new wait. Equal versions: the later arrival wins, which is the greater ``log_id`` where rows carry one;
    rows reach a task in any order, so without it the choice among equal versions of one micro-batch is open.
    """

    def __init__(self, schema: StructType, version: str, delay_millis: int):
        self.schema = schema
        self.columns = schema.fieldNames()
        self.order = [version, *(["log_id"] if "log_id" in self.columns else [])]
        self.delay_millis = delay_millis

    def _place(self, row: tuple) -> tuple:
        version, *arrival = (row[self.columns.index(c)] for c in self.order)
        return (pd.Timestamp(version), *arrival)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.newest.exists()
        best = tuple(self.newest.get()) if held else None
        for chunk in rows:
            row = _plain(chunk.sort_values(self.order, kind="stable").tail(1), self.columns)[0]
            if best is None or self._place(row) >= self._place(best):
                best = row
        self.newest.update(best)
        if not held:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.delay_millis)
        yield pd.DataFrame(columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.newest.exists():
            yield pd.DataFrame([tuple(self.newest.get())], columns=self.columns)
            self.newest.clear()

    def close(self) -> None:
        pass
