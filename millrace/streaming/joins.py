"""Left joins of streams that give a row without partner at once and replace it when a partner comes.

A left row whose key has no right row yet gives a version with nulls. The first right row of the key takes these versions back and gives the matched ones.
So a reader always has a row for every left row, and the rows in force are those of the table form, in whatever order both sides arrive.

The state of a key are its left rows, each of which still waits or has been matched, and its right rows. Keys are dealt over groups and kept in pages (``pages``), as a call per key is far
dearer than a row. Of a key with many rows only the last ones lie in its page, the others in parts that are written once and again when their rows stop waiting. Rows
live there as JSON text, so every type of both sides comes back as it went in. With a time to live, rows older than that are forgotten,
counted from when they were written: a right row that comes later finds no left row any more, and a left row no partner.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from millrace.operators.changelog import latest_by_key
from millrace.streaming.pages import GROUP, KEY, Pages, with_groups

#: What a row of the result does to the table of results.
INSERT, RETRACT = "+", "-"
#: Columns of the result besides those of both sides: what the row does, and its place among the changes of its group of keys in a micro-batch.
CHANGE, PLACE = "change", "change_place"

_LEFT, _RIGHT = 0, 1
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_OUT = "join_left string, join_right string, change string, change_place long"
_ROWS_AT_ONCE = 10_000
#: Rows of a group that are held in memory until the right ones among them have been worked off, of a key that lie together, and keys that do.
_ROWS_HELD_BACK, _ROWS_OF_A_PART, _KEYS_OF_A_PAGE = 200_000, 64, 32
#: Rows of keys are larger than days of keys, and a group holds all of a micro-batch.
GROUPS = 2048


class LeftJoinVersions(StatefulProcessor):
    """Rows ``join_side, join_row`` of a group of keys in, versions of joined rows out."""

    def __init__(self, ttl_millis: int | None = None):
        self.ttl_millis = ttl_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        # by key: its last rows of both sides, the first and the next number of each side's full parts, and when it was written; a row is a text, whether it waits, and when it was written
        self.keys = Pages(handle, "keys", self.ttl_millis, most=_KEYS_OF_A_PAGE)
        self.parts = handle.getMapState("parts", "join_key string, side long, part long", "held string", self.ttl_millis)

    def _alive(self, rows: list) -> list:
        return rows if self.ttl_millis is None else [row for row in rows if row[2] + self.ttl_millis > self.now]

    def _of_key(self, key: str) -> list:
        return self.keys.get(key) or [[], [], [0, 0], [0, 0], 0]

    def _full_parts(self, key: str, held: list, side: int) -> Iterator[tuple[int, list]]:
        numbers = held[2 + side]
        for part in range(*numbers):
            row = self.parts.getValue((key, side, part))
            if row is not None:
                yield part, self._alive(json.loads(row[0]))
            elif part == numbers[0]:  # forgotten
                numbers[0] += 1

    def _write_part(self, key: str, side: int, part: int, rows: list) -> None:
        self.parts.updateValue((key, side, part), (json.dumps(rows, separators=(",", ":")),))

    def _keep(self, key: str, held: list, side: int, rows: list[str], waits: int = 0) -> None:
        last = held[side] + [[row, waits, self.now] for row in rows]
        full = len(last) - len(last) % _ROWS_OF_A_PART
        for begin in range(0, full, _ROWS_OF_A_PART):
            self._write_part(key, side, held[2 + side][1], last[begin : begin + _ROWS_OF_A_PART])
            held[2 + side][1] += 1
        held[side] = last[full:]
        held[4] = self.now
        self.keys.put(key, held)

    def _met(self, rows: list, rights: list[str]) -> Iterator[tuple[str, str | None, str]]:
        """What new right rows do to left rows, none of which waits after it."""
        for row in rows:
            if row[1]:
                yield row[0], None, RETRACT
                row[1], row[2] = 0, self.now
            for partner in rights:
                yield row[0], partner, INSERT

    def _right_changes(self, key: str, rights: list[str]) -> Iterator[tuple[str, str | None, str]]:
        """(left row, right row, what it does) for new right rows of a key."""
        held = self._of_key(key)
        for part, rows in self._full_parts(key, held, _LEFT):
            waits = any(row[1] for row in rows)
            yield from self._met(rows, rights)
            if waits:
                self._write_part(key, _LEFT, part, rows)
        held[_LEFT] = self._alive(held[_LEFT])
        yield from self._met(held[_LEFT], rights)
        self._keep(key, held, _RIGHT, rights)

    def _left_changes(self, key: str, lefts: list[str]) -> Iterator[tuple[str, str | None, str]]:
        held = self._of_key(key)
        held[_RIGHT] = self._alive(held[_RIGHT])
        partners = [row[0] for _, rows in self._full_parts(key, held, _RIGHT) for row in rows] + [row[0] for row in held[_RIGHT]]
        for row in lefts:
            for partner in partners or [None]:
                yield row, partner, INSERT
        self._keep(key, held, _LEFT, lefts, 0 if partners else 1)

    def _changes(self, chunks: Iterator[pd.DataFrame]) -> Iterator[tuple[str, str | None, str]]:
        """The right rows first, as long as the left ones can be held back, so a left row that comes with its partner never waits."""
        lefts: dict[str, list[str]] = {}
        kept = 0
        for chunk in chunks:
            rights: dict[str, list[str]] = {}
            for key, side, row in zip(chunk[KEY].tolist(), chunk["join_side"].tolist(), chunk["join_row"].tolist(), strict=True):
                (rights if side == _RIGHT else lefts).setdefault(key, []).append(row)
            for key, rows in rights.items():
                yield from self._right_changes(key, rows)
            kept += len(chunk)
            if kept >= _ROWS_HELD_BACK:
                for key, rows in lefts.items():
                    yield from self._left_changes(key, rows)
                lefts, kept = {}, 0
        for key, rows in lefts.items():
            yield from self._left_changes(key, rows)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self.now = timerValues.getCurrentProcessingTimeInMs() if self.ttl_millis is not None else 0
        self.keys.open()
        changes, place = self._changes(rows), 0
        while found := list(islice(changes, _ROWS_AT_ONCE)):
            lefts, rights, does = zip(*found, strict=True)
            yield pd.DataFrame({
                "join_left": pd.Series(lefts, dtype=object), "join_right": pd.Series(rights, dtype=object), CHANGE: does, PLACE: range(place, place + len(found)),
            })
            place += len(found)
        if self.ttl_millis is not None:
            self.keys.prune(lambda held: held[4] + self.ttl_millis <= self.now)
        self.keys.save()

    def close(self) -> None:
        pass


def _as_text(row: DataFrame) -> Column:
    return F.to_json(F.struct(*row.columns), _JSON)


def left_join_versions(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], ttl_millis: int | None = None, salts: int = 1
) -> DataFrame:
    """Versions of the left join of two streams with distinct column names: their columns, ``change`` and ``change_place``.

    Left rows with a null key never match and are given at once. ``salts`` deals the left rows of a key over so many states, each of which gets all right
    rows of the key: for keys with so many left rows that one task should not hold them. With ``ttl_millis`` the stream runs on processing time and has to be started
    with an interval.
    """
    keys = [f"join_key_{k}" for k in range(len(on))]
    l_keys, r_keys = ([left[l].alias(k) for (l, _), k in zip(on, keys, strict=True)], [right[r].alias(k) for (_, r), k in zip(on, keys, strict=True)])
    text = _as_text(left)
    lefts = left.select(*l_keys, F.pmod(F.xxhash64(text), F.lit(salts)).cast("int").alias("join_salt"), F.lit(_LEFT).alias("join_side"), text.alias("join_row"))
    rights = right.select(*r_keys, F.explode(F.array(*[F.lit(k) for k in range(salts)])).alias("join_salt"), F.lit(_RIGHT).alias("join_side"), _as_text(right).alias("join_row"))
    both = lefts.unionByName(rights)
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    grouped = with_groups(both.where(whole), [*keys, "join_salt"], GROUPS).select(GROUP, KEY, "join_side", "join_row").groupBy(GROUP)
    versions = grouped.transformWithStateInPandas(
        LeftJoinVersions(ttl_millis), outputStructType=_OUT, outputMode="append", timeMode="none" if ttl_millis is None else "processingTime"
    )
    lonely = both.where(~whole & (F.col("join_side") == _LEFT)).select(
        F.col("join_row").alias("join_left"), F.lit(None).cast("string").alias("join_right"), F.lit(INSERT).alias(CHANGE), F.lit(0).cast("long").alias(PLACE)
    )
    rows = versions.select("join_left", "join_right", CHANGE, PLACE).unionByName(lonely)

    def back(column: str, schema: StructType) -> Column:
        return F.from_json(column, schema, _JSON).alias(column)

    parsed = rows.select(back("join_left", left.schema), back("join_right", right.schema), CHANGE, PLACE)
    return parsed.select("join_left.*", "join_right.*", CHANGE, PLACE)


def in_force(versions: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The joined rows that hold: of each pair of rows, named by ``keys`` (null where there is no right row), the last version, if it is no retraction."""
    last = latest_by_key(versions, list(keys), [*order, PLACE])
    return last.where(F.col(CHANGE) == INSERT).drop(CHANGE, PLACE)
