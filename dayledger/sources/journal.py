"""The journal of a mart: which writes are finished, and from which period on each
changed a table.

A write takes the next number and marks its rows with it; the journal notes that it
started, what it touched, and last that it is finished. Rows of a write that never
ended are not shown, so readers see the nine appends of a load all at once or not at
all. One writer at a time is assumed; any number may read.

The journal also says which state snapshots are there. One is good while no later
write touched a period before it, which the journal alone tells: nothing needs to be
taken back when a write fails half-way.

An event is an empty file whose name says all, so the driver reads the journal with
one listing: some ten names a write, whatever the tables hold.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

STARTED, FINISHED, DISCARDED, TOUCHED, SNAPSHOT = "started", "finished", "discarded", "touched", "snapshot"

#: The period of a write that may have changed all of a table.
ALL = -(1 << 31)


class Event(NamedTuple):
    write: int
    kind: str
    table: str = ""
    period: int = 0

    def name(self) -> str:
        return ".".join((f"{self.write:09d}", self.kind, self.table, str(self.period)))


@dataclass(frozen=True)
class Writes:
    """The last write that is known, and those up to it that have not ended."""

    last: int
    open: tuple[int, ...]

    def shown(self, column: str) -> Column:
        seen = F.col(column) <= self.last
        return seen & ~F.col(column).isin(*self.open) if self.open else seen


class Snapshot(NamedTuple):
    """The state before a period, as of a write."""

    before: int
    write: int


class Journal:
    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        self._folder = self._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def events(self) -> list[Event]:
        """All events, by write."""
        if not self._files.exists(self._folder):
            return []
        paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(self._files.listStatus(self._folder))
        names = self._jvm.org.apache.commons.lang3.ArrayUtils.toString(paths)[1:-1].split(",")
        found = []
        for parts in (name.rsplit("/", 1)[-1].split(".") for name in names if name):
            if len(parts) == 4 and parts[0].isdigit():
                found.append(Event(int(parts[0]), parts[1], parts[2], int(parts[3])))
        return sorted(found)

    def note(self, events: Iterable[Event]) -> None:
        """Add events, one after the other."""
        for event in events:
            path = self._jvm.org.apache.hadoop.fs.Path(self._folder, event.name())
            self._files.create(path, True).close()

    def writes(self) -> Writes:
        ended: dict[int, bool] = defaultdict(bool)
        for event in self.events():
            ended[event.write] |= event.kind in (FINISHED, DISCARDED)
        return Writes(max(ended, default=0), tuple(n for n, over in ended.items() if not over))

    def start(self) -> int:
        number = self.writes().last + 1
        self.note([Event(number, STARTED)])
        return number

    def snapshots(self, table: str) -> tuple[list[Snapshot], list[Snapshot]]:
        """Good snapshots of a table by period, and those that later writes spoilt."""
        newest: dict[int, int] = {}
        touched: list[Event] = []
        for event in self.events():
            if event.table == table and event.kind == SNAPSHOT:
                newest[event.period] = event.write
            elif event.table == table and event.kind == TOUCHED:
                touched.append(event)
        good, spoilt = [], []
        for before, write in sorted(newest.items()):
            is_spoilt = any(t.write > write and t.period < before for t in touched)
            (spoilt if is_spoilt else good).append(Snapshot(before, write))
        return good, spoilt

    def first_period(self, table: str) -> int | None:
        """The first period that an append touched since all of the table changed."""
        first = None
        for event in self.events():
            if event.table == table and event.kind == TOUCHED:
                first = None if event.period == ALL else event.period if first is None else min(first, event.period)
        return first
