"""State of many keys in pages.

A call of a processor, and each question to its store, costs a round trip that is far dearer than a row. So keys are dealt over a fixed number of groups, a group is what the stream
calls a key, and ``Pages`` holds the values of its keys together: a call reads and writes the pages its keys fall in, never more of them than it has keys.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessorHandle

#: How many groups the keys of a state are dealt over. Fixed for a checkpoint; many more than there are state partitions would only cost calls.
GROUPS = 512
#: Columns for the group of a row's key, and for the key as text.
GROUP, KEY = "state_group", "state_key"


def with_groups(rows: DataFrame, keys: list[str], groups: int = GROUPS) -> DataFrame:
    """Add group and text of the key that the columns ``keys`` make; null is a value like others."""
    return rows.withColumns({GROUP: group_of(*keys, groups=groups), KEY: F.to_json(F.struct(*keys))})


def group_of(*keys: str, groups: int = GROUPS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(groups))


class Pages:
    """Values (what JSON can hold) by text, for the keys of one group, in pages of at most ``most`` keys.

    Keys are dealt by checksum over a power of two of pages, each a text in a map. When one has too many, each page is dealt over so many more that they are about half full:
    that happens once each time the keys have doubled, page by page. One timer of the group can be kept, for the first value that has to go. With ``ttl_millis`` pages go away so long
    after they were written; whose values may go earlier than their page leaves them out itself (``prune``).
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, ttl_millis: int | None = None, most: int = 512):
        self.handle = handle
        self.ttl_millis = ttl_millis
        self.most = most
        self.map = handle.getMapState(name, "page long", "held string", ttl_millis)
        self.about = handle.getValueState(f"{name}_about", "pages long, timer long", ttl_millis)

    def open(self) -> None:
        """Begin with another group."""
        about = self.about.get()
        self.pages, self.timer = about if about is not None else (0, None)
        self.held: dict[int, dict[str, Any]] = {}
        self.changed: set[int] = set()
        self.about_changed = False

    def _page(self, key: str) -> dict[str, Any]:
        page = self._number(key, self.pages)
        if page not in self.held:
            self.held[page] = self._read(page)
        return self.held[page]

    @staticmethod
    def _number(key: str, pages: int) -> int:
        return crc32(key.encode()) & (pages - 1) if pages else 0

    def _read(self, page: int) -> dict[str, Any]:
        row = self.map.getValue((page,)) if self.pages else None
        return json.loads(row[0]) if row is not None else {}

    def _write(self, page: int, values: dict[str, Any]) -> None:
        self.map.updateValue((page,), (json.dumps(values, separators=(",", ":")),))

    def get(self, key: str) -> Any:
        return self._page(key).get(key)

    def put(self, key: str, value: Any) -> None:
        self._page(key)[key] = value
        self.changed.add(self._number(key, self.pages))

    def prune(self, gone: Callable[[Any], bool]) -> None:
        """Leave out such values of the pages that have been changed."""
        for page in self.changed:
            self.held[page] = {k: v for k, v in self.held[page].items() if not gone(v)}

    def wake(self, at: int) -> None:
        """The group's timer is not to be later than ``at``."""
        if self.timer is None or at < self.timer:
            if self.timer is not None:
                self.handle.deleteTimer(self.timer)
            self.handle.registerTimer(at)
            self.timer, self.about_changed = at, True

    def save(self) -> None:
        """Write what has changed, and begin anew."""
        fullest = max((len(self.held[page]) for page in self.changed), default=0)
        if self.changed and (not self.pages or fullest > self.most):
            self._deal(fullest)
        for page in self.changed:
            self._write(page, self.held[page])
        if self.about_changed or (self.changed and self.ttl_millis is not None):
            self.about.update((self.pages, self.timer))
        self.held, self.changed, self.about_changed = {}, set(), False

    def _deal(self, fullest: int) -> None:
        before, after = max(1, self.pages), max(1, self.pages)
        while fullest > self.most and 2 * fullest * before > self.most * after:
            after *= 2
        for old in range(before):
            dealt: dict[int, dict[str, Any]] = {new: {} for new in range(old, after, before)}
            for key, value in (self.held.pop(old) if old in self.held else self._read(old)).items():
                dealt[self._number(key, after)][key] = value
            for new, values in dealt.items():
                self._write(new, values)
        self.pages, self.changed, self.about_changed = after, set(), True

    def sweep(self, gone: Callable[[Any], bool], timer_of: Callable[[Any], int]) -> None:
        """Leave out such values of all pages after the timer came, and set it for the first of the others."""
        self.timer, first = None, None
        for page in range(self.pages):
            values = self._read(page)
            rest = {k: v for k, v in values.items() if not gone(v)}
            if len(rest) < len(values):
                self._write(page, rest)
            first = min([timer_of(v) for v in rest.values()] + ([] if first is None else [first]), default=None)
        if first is None:
            self.clear()
        else:
            self.wake(first)
            self.save()

    def clear(self) -> None:
        self.map.clear()
        self.about.clear()
