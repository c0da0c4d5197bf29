"""Whole-mart upkeep: deleting entries, moving the calendar, one-off corrections."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.operators import maintenance as M
from dayledger.operators.incremental import repair_late
from dayledger.sources.catalog import Catalog
from dayledger.sources.schemas import FACTS, REPORTED


def delete_entries_created_on(catalog: Catalog, day: dt.date) -> None:
    """Delete from every fact what was created on ``day``."""
    for name in FACTS:
        hit = F.to_date("created_at") == F.lit(day)
        catalog.delete(name, hit, lambda rows: M.delete_created_on(rows, day))


def delete_entries_of_report(
    catalog: Catalog, report_date: dt.date, platform: int | None = None
) -> None:
    """Delete one report day from every fact, on one platform or on all."""
    platforms, wells = catalog.table("platforms"), catalog.table("wells")
    dates = catalog.table("report_dates").where(F.col("report_date") == F.lit(report_date))
    found = dates.select("id").first()
    if found is None:
        return
    day = found["id"]

    def survivors(name: str):
        if name == "daily_general_comments":
            return lambda rows: M.delete_report_by_name(rows, day, platforms, platform)
        through = None if name == "flowmeters" else wells
        return lambda rows: M.delete_report(rows, day, platforms, through, platform)

    for name in FACTS:
        catalog.delete(name, F.col("report_date_id") == day, survivors(name), day)


def store_late(
    catalog: Catalog, name: str, late: DataFrame, load_date: dt.date, constants: Mapping[str, Column] | None = None
) -> dict[str, int]:
    """Store rows of wells that come late in a fact of changes, and mend what later days
    have stored: how many rows were inserted and retracted.

    ``late`` has the fact's key, its tracked columns, and ``file`` and ``row_idx`` to
    choose among rows of one key. The days that were reported are those of the daily
    parameters, which are stored every day. Reads one snapshot and the periods from the
    first late day on. Rows are inserted first: until the others are retracted, these
    only say again what is so.
    """
    fact = FACTS[name]
    first = late.agg(F.min(fact.on)).first()[0]
    if first is None:
        return {"insert": 0, "retract": 0}
    catalog.refresh()
    stored = catalog.history(name, first, (1 << 31) - 1)
    reports = catalog.since("daily_well_parameters", late)
    order = [c for c in ("file", "row_idx") if c in late.columns]
    found = catalog.stage(repair_late(late, stored, reports, fact.by, fact.on, fact.tracked, order or [fact.on]))
    new = found.where("action = 'insert'").drop("action")
    new = new.withColumns({**(constants or {}), "created_at": F.lit(load_date)})
    done = catalog.append(new, name)
    gone = found.where("action = 'retract'").select(*fact.key)
    days = [r[0] for r in gone.select(fact.on).distinct().collect()]  # the calendar bounds them
    if days:
        catalog.delete(name, F.col(fact.on).isin(days), lambda rows: rows.join(gone, list(fact.key), "left_anti"))
    return {"insert": done.rows, "retract": gone.count()}


def delete_all_entries(catalog: Catalog) -> None:
    for name in FACTS:
        catalog.truncate(name)


def move_calendar(catalog: Catalog, target: Catalog, start: dt.date, end: dt.date, old_start: dt.date) -> None:
    """Write the mart with a calendar that starts on ``start`` to a new location.
    There is no transaction over many tables, so readers switch when it is done."""
    days = (old_start - start).days
    for name, table in catalog.tables().items():
        if name == "report_dates":
            target.replace(M.calendar(catalog.spark, start, end), name)
        elif name in FACTS or name in REPORTED:
            target.replace(M.shift_key(table, "report_date_id", days), name)
        else:
            target.replace(table, name)
