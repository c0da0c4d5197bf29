"""Stored tables of one mart: Parquet folders under a shared root."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.operators.incremental import within
from dayledger.operators.quality import LEVELS
from dayledger.sources.journal import (
    ALL,
    DISCARDED,
    FINISHED,
    SNAPSHOT,
    TOUCHED,
    Event,
    Journal,
    Writes,
)
from dayledger.sources.schemas import FACTS, STATES, TABLES
from dayledger.sources.staging import stage_at, stage_counted

_PERIOD = "period"
_REPORTED = "report_period"
_WRITE = "write_id"
_FINDINGS = "findings"
FINDING_COLUMNS = "file string, row_idx int, level string, code string, message string, qc boolean"

# Days per stored period of tables keyed by day number.
PERIOD_DAYS = 32


@dataclass(frozen=True)
class Written:
    """What a write put down, counted by its own tasks: rows, and the first and last
    period they were reported in (None without rows)."""

    rows: int
    first: int | None = None
    last: int | None = None


class Catalog:
    """Facts are partitioned by the period of their key's day, so existence checks
    read only the periods an incoming batch touches. Those keyed by the day of a test
    are partitioned by the period of the report as well.

    A journal says which writes are finished; rows of others are not shown. For facts
    that are read as states it also lists snapshots: the last row of every entity
    before a period, so that a read of a state needs one of them and the periods that
    follow it, however long the history."""

    def __init__(self, spark: SparkSession, root: str, period_days: int = PERIOD_DAYS):
        self.spark = spark
        self.period_days = period_days
        self.root = root.rstrip("/")
        self.journal = Journal(spark, f"{self.root}/_journal")
        self._known: Writes | None = None
        self._one_write = Lock()
        self._staged: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self) -> None:
        """Write every table empty; existing contents are replaced."""
        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(self.truncate, TABLES))

    def truncate(self, name: str) -> None:
        columns = T.StructType.fromDDL(TABLES[name])
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in columns]
        self.replace(self.spark.range(0, 0, 1, 1).select(*none), name)

    # --- reads ---

    def refresh(self) -> Writes:
        """Look up which writes are finished by now."""
        self._known = self.journal.writes()
        return self._known

    def table(self, name: str) -> DataFrame:
        if name in FACTS:
            self.refresh()
        return self._plain(self._shown(name))

    def tables(self) -> Mapping[str, DataFrame]:
        """All tables as of one moment."""
        self.refresh()
        return {name: self._plain(self._shown(name)) for name in TABLES}

    def near(self, name: str, incoming: DataFrame) -> DataFrame:
        """The part of a fact whose periods the incoming rows touch."""
        dated = incoming.select(self._period(name).alias(_PERIOD))
        return self._plain(within(self._shown(name), dated, _PERIOD))

    def since(self, name: str, incoming: DataFrame, days_before: int = 0) -> DataFrame:
        """The part of a fact from the periods of the incoming rows on, or of
        ``days_before`` days earlier. The bound reaches the scan as a subquery."""
        first = incoming.select((F.min(FACTS[name].on) - F.lit(days_before)).alias(FACTS[name].on))
        low = first.select(self._period(name)).scalar()
        return self._plain(self._shown(name).where(F.col(_PERIOD) >= low))

    def before(self, name: str, incoming: DataFrame) -> DataFrame:
        """What tells the state of each entity before the first incoming row: rows of a
        fact up to that row's period, of earlier ones a snapshot and what follows it."""
        first = incoming.agg(F.min("report_date_id")).first()[0]
        if first is None:
            return self._plain(self._shown(name)).where(F.lit(False))
        return self.history(name, first, first)

    def history(self, name: str, first: int, last: int) -> DataFrame:
        """Rows reported from the day number ``first`` to ``last``'s period, and at least
        the last one of each entity before: one snapshot, and the periods from it on."""
        low, high = first // self.period_days, last // self.period_days
        reported = F.col(self._reported(name))
        stored = self._shown(name).where(reported <= high)
        good = [s for s in self.journal.snapshots(name)[0] if s.before <= low]
        if not good:
            return self._plain(stored)
        newest = good[-1]
        state = self._snapshot(name).where((F.col("before") == newest.before) & (F.col("as_of") == newest.write))
        return self._plain(stored.where(reported >= newest.before)).unionByName(state.drop("before", "as_of"))

    def of_days(self, first: int, last: int) -> Mapping[str, DataFrame]:
        """The tables for a mart of the day numbers ``first`` to ``last``: of the daily
        base their periods, of the states what tells them on these days."""
        found = dict(self.tables())
        for name in STATES:
            found[name] = self.history(name, first, last)
        period = F.col(_PERIOD).between(first // self.period_days, last // self.period_days)
        found["daily_well_parameters"] = self._plain(self._shown("daily_well_parameters").where(period))
        return found

    # --- writes ---

    def append(self, df: DataFrame, name: str, write: int | None = None) -> Written:
        """Append to a table; as part of a write that is finished later, if given."""
        if name not in FACTS:
            self._write(df, name, "append")
            return Written(0)
        number = self.journal.start() if write is None else write
        done = self._write(df, name, "append", number)
        if write is None:
            self.finish(number, {name: done})
        return done

    def finish(self, write: int, done: Mapping[str, Written]) -> None:
        """Show a write, and bring the snapshots up to it."""
        touched = {n: w for n, w in done.items() if w.rows}
        self.journal.note(Event(write, TOUCHED, n, w.first) for n, w in touched.items())
        self.journal.note([Event(write, FINISHED)])
        self.refresh()
        self.take_snapshots(write, {n: w.last for n, w in touched.items()})

    def replace(self, df: DataFrame, name: str) -> None:
        """Overwrite a table. ``df`` must not read the same table."""
        if name not in FACTS:
            self._write(df, name, "overwrite")
            return
        with self._one_write:
            number = self.journal.start()
        self.journal.note([Event(number, TOUCHED, name, ALL)])
        self._write(df, name, "overwrite", number)
        self.journal.note([Event(number, FINISHED)])

    def rewrite(self, name: str, change: Callable[[DataFrame], DataFrame]) -> None:
        """Overwrite a table with contents computed from itself, through staging."""
        self.replace(self.stage(change(self.table(name))), name)

    def discard_open(self) -> None:
        """Remove the rows of writes that never ended."""
        left = self.refresh().open
        if left:
            for name in FACTS:
                doomed = F.col(_WRITE).isin(*left)
                self._rewrite_periods(name, doomed, lambda rows: rows.where(~F.col(_WRITE).isin(*left)))
            self.journal.note(Event(number, DISCARDED) for number in left)
            self.refresh()

    def delete(
        self,
        name: str,
        hit: Column,
        survivors: Callable[[DataFrame], DataFrame],
        day: int | None = None,
    ) -> None:
        """Keep ``survivors(rows)`` of the periods that hold a row where ``hit``.

        ``hit`` is a cheap condition every doomed row meets; ``day`` says that all
        of them were reported on that day number, so that its period alone is read.
        Only the periods that are found are rewritten, one left empty as an empty file;
        snapshots after them are taken anew.
        """
        number = self.journal.start()
        first = self._rewrite_periods(name, hit, survivors, day, number)
        self.journal.note([Event(number, FINISHED)])
        self.refresh()
        if first is not None:
            self.take_snapshots(number, {name: None})

    def _rewrite_periods(
        self,
        name: str,
        hit: Column,
        survivors: Callable[[DataFrame], DataFrame],
        day: int | None = None,
        write: int | None = None,
    ) -> int | None:
        """The first reported period that was rewritten, None where no row is hit."""
        stored, parts = self._stored(name), self._partitions(name)
        if day is not None:
            stored = stored.where(F.col(self._reported(name)) == day // self.period_days)
        touched = [tuple(r) for r in stored.where(hit).select(*parts).distinct().collect()]
        if not touched:
            return None
        first = min(t[-1] for t in touched)
        if write is not None:
            self.journal.note([Event(write, TOUCHED, name, first)])
        chosen = F.struct(*parts).isin(*[F.struct(*map(F.lit, t)) for t in touched])
        whole = self._stored(name).where(F.col(_PERIOD).isin(*{t[0] for t in touched}) & chosen)
        kept = self.stage(survivors(whole.drop(*parts)))
        left = {tuple(r) for r in kept.select(*[c.alias(n) for n, c in self._places(name)]).distinct().collect()}
        if left:
            self._write(kept, name, "overwrite", dynamic=True)
        nothing = self._stored(name).drop(*parts).where(F.lit(False)).coalesce(1)
        for empty in set(touched) - left:
            folder = "/".join(f"{n}={v}" for n, v in zip(parts, empty, strict=True))
            nothing.write.mode("overwrite").parquet(f"{self.path(name)}/{folder}")
        return first

    # --- snapshots ---

    def take_snapshots(self, write: int, newest: Mapping[str, int | None]) -> None:
        """Of each table given: take the snapshots anew that writes have spoilt, and the
        one before its ``newest`` period, unless that is there already."""
        names = [n for n in newest if n in STATES]
        if names:
            with ThreadPoolExecutor(max_workers=len(names)) as pool:
                list(pool.map(lambda n: self._take(write, n, newest[n]), names))

    def _take(self, write: int, name: str, newest: int | None) -> None:
        good, spoilt = self.journal.snapshots(name)
        wanted = {s.before for s in spoilt}
        first = self.journal.first_period(name)
        if newest is not None and first is not None and newest > max([first, *(s.before for s in good)]):
            wanted.add(newest)
        if not wanted:
            return
        # one pass for all: a row is the state before each period up to its successor's
        rows = self.history(name, min(wanted) * self.period_days, max(wanted) * self.period_days)
        own = F.floor(F.col("report_date_id") / self.period_days).cast("int")
        fact = FACTS[name]
        following = F.lead("own").over(Window.partitionBy(*fact.by).orderBy(*fact.state_order))
        spans = rows.withColumn("own", own).withColumn("next", following)
        until = F.coalesce("next", F.lit(max(wanted)))
        before = F.filter(
            F.array(*[F.lit(w) for w in sorted(wanted)]), lambda w: (w > F.col("own")) & (w <= until)
        )
        state = spans.withColumn("before", F.explode(before)).drop("own", "next")
        state = state.withColumn("as_of", F.lit(write))
        state.hint("rebalance", "before").write.mode("append").partitionBy("before", "as_of").parquet(
            f"{self.root}/_snapshots/{name}"
        )
        self.journal.note(Event(write, SNAPSHOT, name, period) for period in sorted(wanted))
        for old in spoilt:
            self._remove(f"{self.root}/_snapshots/{name}/before={old.before}/as_of={old.write}")

    def _snapshot(self, name: str) -> DataFrame:
        schema = f"{TABLES[name]}, before int, as_of int"
        return self.spark.read.schema(schema).parquet(f"{self.root}/_snapshots/{name}")

    def log(self, findings: DataFrame) -> tuple[DataFrame, dict[str, int]]:
        """Append findings to the kept ones, those for quality control apart; they
        are computed once, and counted by level while they are. Returns the findings
        of this load and the counts."""
        levels = {level: F.count_if(F.col("level") == level) for level in LEVELS}
        path = f"{self._staging()}/{uuid.uuid4().hex}"
        self._staged.append(path)
        written, counts = stage_counted(findings, path, levels)
        written.write.mode("append").partitionBy("qc").parquet(self.path(_FINDINGS))
        return written, counts

    def findings(self) -> DataFrame:
        """All findings of earlier loads; ``qc`` tells the flagged ones."""
        return self.spark.read.schema(FINDING_COLUMNS).parquet(self.path(_FINDINGS))

    def stage(self, df: DataFrame) -> DataFrame:
        """A written copy in the cluster's shared folder, or beside the tables,
        until ``release``."""
        copy, path = stage_at(df, self._staging())
        self._staged.append(path)
        return copy

    def _staging(self) -> str:
        shared = self.spark.conf.get("spark.checkpoint.dir", None)
        return f"{shared or self.root}/_staging".replace("//_staging", "/_staging")

    def release(self) -> None:
        """Remove the staged copies; frames that read them are of no use after."""
        while self._staged:
            self._remove(self._staged.pop())

    def _remove(self, path: str) -> None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def create_view(self, df: DataFrame, name: str) -> None:
        df.createOrReplaceTempView(name)

    def _stored(self, name: str) -> DataFrame:
        own = [_WRITE, *self._partitions(name)] if name in FACTS else []
        ddl = ", ".join([TABLES[name], *(f"{c} int" for c in own)])
        return self.spark.read.schema(ddl).parquet(self.path(name))

    def _shown(self, name: str) -> DataFrame:
        """Stored rows of the writes that were finished when last looked."""
        if name not in FACTS:
            return self._stored(name)
        known = self._known or self.refresh()
        return self._stored(name).where(known.shown(_WRITE))

    def _plain(self, df: DataFrame) -> DataFrame:
        return df.drop(_PERIOD, _REPORTED, _WRITE)

    def _period(self, name: str) -> Column:
        day = F.col(FACTS[name].on)
        if FACTS[name].on == "report_date_id":
            return F.floor(day / self.period_days).cast("int")
        return F.year(day) * 12 + F.month(day)

    def _reported(self, name: str) -> str:
        """The partition column that holds the period of the report."""
        return self._partitions(name)[-1]

    def _partitions(self, name: str) -> Sequence[str]:
        return (_PERIOD,) if FACTS[name].on == "report_date_id" else (_PERIOD, _REPORTED)

    def _places(self, name: str) -> list[tuple[str, Column]]:
        reported = F.floor(F.col("report_date_id") / self.period_days).cast("int")
        return list(zip(self._partitions(name), (self._period(name), reported), strict=False))

    def _write(
        self, df: DataFrame, name: str, mode: str, write: int | None = None, dynamic: bool = False
    ) -> Written:
        """Rows that have the number of a write keep it."""
        columns = [F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(TABLES[name])]
        if name not in FACTS:
            df.select(*columns).write.mode(mode).parquet(self.path(name))
            return Written(0)
        number = F.col(_WRITE) if _WRITE in df.columns else F.lit(write).cast("int")
        out = df.select(*columns, number.alias(_WRITE)).withColumns(dict(self._places(name)))
        seen, reported = Observation(), F.col(self._reported(name))
        # counted by the tasks that write, each of which counts once
        out = out.hint("rebalance", _PERIOD).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.min(reported).alias("first"), F.max(reported).alias("last")
        )
        overwrite = "dynamic" if dynamic else "static"
        writer = out.write.mode(mode).partitionBy(*self._partitions(name))
        writer.option("partitionOverwriteMode", overwrite).parquet(self.path(name))
        return Written(**seen.get)
