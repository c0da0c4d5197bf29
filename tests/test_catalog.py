"""Stored facts: writes that break off, and state snapshots against full scans."""

import datetime as dt
import random

import pytest
from helpers import rows_of
from pyspark.sql import functions as F
from test_load import counts, load, partition_filters, three_wells

from dayledger.operators.incremental import append_if_changed
from dayledger.operators.picks import last_per_key
from dayledger.plans import upkeep
from dayledger.plans.mart import complete_table
from dayledger.sources.catalog import Catalog
from dayledger.sources.schemas import FACTS, TABLES

LOADED = dt.date(2025, 2, 1)


def test_load_that_breaks_off_is_not_seen_and_is_replaced(catalog, monkeypatch):
    append = Catalog.append

    def breaks(self, df, name, write=None):
        if name == "laboratory_results":
            raise OSError("lost")
        return append(self, df, name, write)

    with monkeypatch.context() as broken:
        broken.setattr(Catalog, "append", breaks)
        with pytest.raises(OSError):
            load(catalog, three_wells())
    assert catalog._stored("well_tests").count() == 3
    assert not any(counts(catalog).values())
    assert not any(counts(Catalog(catalog.spark, catalog.root)).values())
    result = load(catalog, three_wells())
    assert counts(catalog)["well_tests"] == 3 == catalog._stored("well_tests").count()
    summary = {r["name"]: r["rows"] for r in result.summary.where("section = 'table'").collect()}
    assert summary == counts(catalog)


def stock_row(well, day, draw):
    return (well, day, draw.randrange(3), 1, draw.randrange(2), draw.choice([None, 1, 2]), LOADED)


def tested_row(well, day, draw):
    return (well, day, dt.date(2024, 1, 1) + dt.timedelta(day - draw.randrange(20)), float(day), 1.0, None, LOADED)


def test_snapshots_equal_full_scans(spark, tmp_path):
    draw, used = random.Random(4), set()
    catalog = Catalog(spark, str(tmp_path / "mart"), period_days=8)
    batches = [range(8, 20), range(20, 60), range(60, 75), range(30, 40), range(76, 90)]
    for step, days in enumerate(batches):
        for name, make in (("well_stock", stock_row), ("well_tests", tested_row)):
            fresh = [(w, d) for w in range(6) for d in days if draw.random() < 0.3 and (name, w, d) not in used]
            used |= {(name, w, d) for w, d in fresh}
            rows = {(r[0], r[2] if name == "well_tests" else r[1]): r for r in (make(w, d, draw) for w, d in fresh)}
            catalog.append(spark.createDataFrame(list(rows.values()), TABLES[name]), name)
        if step == 3:  # a delete in the middle spoils what follows
            gone = F.col("report_date_id") == 25
            catalog.delete("well_stock", gone, lambda rows: rows.where(~gone), 25)
        for name in ("well_stock", "well_tests"):
            fact = FACTS[name]
            for first in (9, 33, 70, 89):
                def state(rows):
                    return rows_of(last_per_key(rows.where(F.col("report_date_id") < first), fact.by, fact.state_order))

                assert state(catalog.history(name, first, first)) == state(catalog.table(name))
    good, spoilt = catalog.journal.snapshots("well_stock")
    assert not spoilt and len(good) >= 2
    # one snapshot, and of the table the periods from it on
    filters = " ".join(partition_filters(catalog.history("well_stock", 89, 89)))
    assert f"(before#" in filters and f" = {good[-1].before})" in filters and f">= {good[-1].before})" in filters


def test_bounded_mart_from_snapshots(catalog):
    dates = ["1/2/2025", "2/20/2025", "4/1/2025", "4/2/2025"]
    for i, date in enumerate(dates[:3]):
        load(catalog, three_wells(file=str(i), date=date))
    load(catalog, three_wells(file="last", date=dates[3]))
    first = catalog.table("daily_well_parameters").agg(F.max("report_date_id")).first()[0] - 1
    found = complete_table(catalog.of_days(first, first + 1), days=(first, first + 1))
    whole = complete_table(catalog.tables()).where(F.col("report_date") >= dt.date(2025, 4, 1))
    assert rows_of(found) == rows_of(whole) and found.count() == 6


def test_late_rows_are_stored_as_if_they_had_come_in_time(spark, tmp_path):
    draw = random.Random(8)
    catalog = Catalog(spark, str(tmp_path / "mart"), period_days=8)
    fact, schema = FACTS["well_stock"], TABLES["well_stock"]
    raw = [stock_row(w, d, draw) for w in range(40) for d in range(8, 32) if draw.random() < 0.6]
    draw.shuffle(raw)
    cuts = [(0, 500), (500, 560), (560, len(raw))]
    totals = {"insert": 0, "retract": 0}
    catalog.append(spark.createDataFrame([], schema), "well_stock")
    daily = TABLES["daily_well_parameters"]
    catalog.append(spark.createDataFrame([], daily), "daily_well_parameters")
    for a, b in cuts:
        late = spark.createDataFrame(raw[a:b], schema)
        done = upkeep.store_late(catalog, "well_stock", late, LOADED, {"well_stock_sub_category_id": F.lit(1)})
        totals = {k: totals[k] + done[k] for k in totals}
        keys = late.select("well_id", "report_date_id")
        empty = spark.createDataFrame([], daily)
        catalog.append(empty.unionByName(keys, allowMissingColumns=True), "daily_well_parameters")
        seen = spark.createDataFrame(raw[:b], schema)
        rebuilt = append_if_changed(seen, None, fact.by, fact.on, fact.tracked, ["created_at"])
        columns = [*fact.key, *fact.tracked]
        assert rows_of(catalog.table("well_stock"), *columns) == rows_of(rebuilt, *columns)
    assert totals["retract"] > 0 and catalog.table("well_stock").count() == totals["insert"] - totals["retract"]
