"""One query per operator over the sample tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions import dates as D
from dayledger.functions import numbers as N
from dayledger.functions.text import (
    decimal_point,
    differs,
    key_text,
    trim_all,
    without_sentinel,
)
from dayledger.operators import allocation as A
from dayledger.operators import maintenance as M
from dayledger.operators import quality as Q
from dayledger.operators.asof import State, asof_join, asof_join_many, asof_timeline, densify
from dayledger.operators.incremental import append_if_absent, append_if_changed, changes, repair_late
from dayledger.operators.lookup import Dimension, denormalise, lookup, prefix_lookup
from dayledger.operators.meters import check_meters
from dayledger.operators.picks import last_per_key
from dayledger.plans import load as L
from dayledger.plans import mart
from dayledger.plans import rules as R
from dayledger.sources import reports as P
from dayledger.sources.catalog import Catalog
from dayledger.sources.sample_sheets import SampleSheets
from dayledger.sources.samples import Samples
from dayledger.sources.schemas import FACTS, REPORTED_KEYS
from dayledger.sources.seeds import (
    CALENDAR_START,
    OLD_CALENDAR_START,
    SUB_CATEGORIES,
    SUB_CATEGORY_RECODING,
    seed,
)
from dayledger.sources.staging import scratch, stage_at, stage_counted

Query = Callable[[SparkSession, str], DataFrame]

DENSITY_REGION = "ASIA"
STORED_UNTIL = dt.date(2024, 1, 15)
INCOMING_FROM = dt.date(2024, 1, 10)
CREATED_DAY = dt.date(2024, 1, 9)
REPORT_DAY = dt.date(2024, 1, 12)
MART_DAYS = (dt.date(2024, 1, 12), dt.date(2024, 1, 14))

QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Samples], DataFrame], name: str | None = None) -> Callable[[Samples], DataFrame]:
    QUERIES[name or fn.__name__] = lambda spark, folder: fn(Samples(spark, folder))
    return fn


def named(name: str) -> Callable:
    """``query`` under a name that is that of an operator already."""
    return lambda fn: query(fn, name)


def _round(column: str | Column, scale: int = 9) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value, scale)


# As-of reads.


@query
def asof_latest_test(s: Samples) -> DataFrame:
    joined = asof_join(
        s.daily,
        s.well_tests.withColumn("reported", F.col("d")),
        ["well_id"],
        "d",
        ties=["well_test_date"],
        columns=["well_test_date", "liquid_ton", "reported"],
        unique=True,
    )
    wt = F.struct(F.col("liquid_ton").alias("liquid_ton"))
    return joined.select(
        "well_id",
        "d",
        "well_uptime_hours",
        "reported",
        "well_test_date",
        mart.liquid_ton(wt, F.col("well_uptime_hours")).alias("liquid_ton"),
    )


@query
def asof_strict_previous(s: Samples) -> DataFrame:
    lab = s.lab.select("well_id", "d", "lab_date", "water_cut")
    return asof_join(
        s.daily.select("well_id", "d", "n_events"),
        lab,
        ["well_id"],
        "d",
        inclusive=False,
        ties=["lab_date"],
    )


def _sample_states(s: Samples) -> dict[str, State]:
    return {
        "ws": State(s.well_stock_raw, ["category_id", "sub_category_id", "method_id"]),
        "c": State(s.completions_raw, ["horizon_id", "casing"]),
        "wdr": State(s.downtime_raw, ["category", "comments"]),
        "wt": State(
            s.well_tests, ["well_test_date", "liquid_ton", "oil_ton", "water_ton"], ["well_test_date"]
        ),
        "lr": State(s.lab, ["lab_date", "water_cut", "mechanical_impurities"], ["lab_date"]),
        "gwt": State(
            s.gas_well_tests, ["well_test_date", "total_gas", "gaslift_gas"], ["well_test_date"]
        ),
    }


def _states(s: Samples) -> DataFrame:
    return asof_join_many(s.daily, _sample_states(s), ["well_id"], "d", unique=True)


@query
def asof_many_states(s: Samples) -> DataFrame:
    return _states(s).select(
        "well_id",
        "d",
        F.col("ws.category_id").alias("category_id"),
        F.col("ws.method_id").alias("method_id"),
        F.col("c.horizon_id").alias("horizon_id"),
        F.col("wdr.category").alias("downtime_category"),
        F.col("wdr.comments").alias("comments"),
        F.col("wt.liquid_ton").alias("liquid_ton"),
        F.col("lr.water_cut").alias("water_cut"),
        F.col("gwt.total_gas").alias("total_gas"),
    )


@query
def asof_orders_lineitem(s: Samples) -> DataFrame:
    """Every line item with its customer's latest order on or before the ship date."""
    orders = s.table("orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderdate").cast("date").alias("day"),
        "o_orderkey",
        "o_totalprice",
    )
    owner = orders.select("custkey", F.col("o_orderkey").alias("l_orderkey"))
    lines = s.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day")
    )
    return asof_join(
        lines.join(owner, "l_orderkey", "left"),
        orders,
        ["custkey"],
        "day",
        ties=["o_orderkey"],
        columns=["o_orderkey", "o_totalprice"],
        prefix="latest_",
    )


@query
def asof_timeline_events(s: Samples) -> DataFrame:
    """Every purchase and error with the user's latest view up to that moment."""
    events = s.table("events").select("event_id", "ts", "user_id", "event_type", "value")
    asked = events.where(F.col("event_type").isin("purchase", "error"))
    views = events.where("event_type = 'view'").select("user_id", "ts", "event_id", "value")
    found = asof_timeline(asked, views, ["user_id"], "ts", ties=["event_id"], columns=["event_id", "value"], prefix="view_")
    return found.select("event_id", "user_id", "event_type", "view_event_id", _round("view_value").alias("view_value"))


STOCK = ("category_id", "sub_category_id", "method_id")


def _stock_history(raw: DataFrame) -> DataFrame:
    return append_if_changed(raw, None, ["well_id"], "d", STOCK, ["event_id"])


@query
def densify_history(s: Samples) -> DataFrame:
    history = _stock_history(s.well_stock_raw).select("well_id", "d", *STOCK)
    until = s.events.select(F.max("d")).scalar()
    return densify(history, ["well_id"], "d", until)


# Incremental loading.


@named("append_if_absent")
def append_absent_tests(s: Samples) -> DataFrame:
    tests = s.well_tests.select("well_id", "well_test_date", "d", "event_id", "liquid_ton")
    key = ["well_id", "well_test_date"]
    empty = tests.where(F.lit(False))
    stored = append_if_absent(tests.where(F.col("d") <= STORED_UNTIL), empty, key, ["event_id"])
    incoming = tests.where(F.col("d") > STORED_UNTIL)
    return append_if_absent(incoming, stored, key, ["event_id"], prune="well_test_date")



@named("append_if_changed")
def append_changed_stock(s: Samples) -> DataFrame:
    raw = s.well_stock_raw
    stored = _stock_history(raw.where(F.col("d") <= STORED_UNTIL))
    incoming = raw.where(F.col("d") >= INCOMING_FROM)
    return append_if_changed(incoming, stored, ["well_id"], "d", STOCK, ["event_id"])



@query
def append_if_changed_repeated(s: Samples) -> DataFrame:
    """Several rows of a well and day, before and after stored ones."""
    raw = s.stock_events
    columns = ["well_id", "d", "event_id", "category_id", "method_id"]
    tracked = ["category_id", "method_id"]
    stored = append_if_changed(raw.where(F.col("d") <= STORED_UNTIL), None, ["well_id"], "d", tracked, ["event_id"])
    incoming = raw.where(F.col("d") >= INCOMING_FROM)
    new = append_if_changed(incoming, stored, ["well_id"], "d", tracked, ["event_id"])
    return stored.withColumn("source", F.lit("stored")).unionByName(new.withColumn("source", F.lit("new"))).select(
        "source", *columns
    )


SNAPSHOT_PERIOD = 7
SNAPSHOT_DAYS = (dt.date(2024, 1, 9), dt.date(2024, 1, 18), dt.date(2024, 1, 26))


def _number(day: dt.date) -> int:
    return (day - CALENDAR_START).days + 1


@query
def state_snapshots(s: Samples) -> DataFrame:
    """Stock and test states before a day, of tables that were stored in four writes,
    the last of them late, from one snapshot and the periods that follow it."""
    catalog = Catalog(s.spark, scratch(s.spark, "snapshots"), SNAPSHOT_PERIOD)
    one, two, asked = map(_number, SNAPSHOT_DAYS)
    day, is_late = F.col("report_date_id"), (F.col("well_id") % 5 == 0) & (F.col("report_date_id") < two)
    writes = (~is_late & (day < one), ~is_late & day.between(one, two - 1), ~is_late & (day >= two), is_late)
    found = None
    for name, value in (("well_stock", "production_method_id"), ("well_tests", "liquid_ton")):
        for batch in writes:
            catalog.append(s.mart_tables[name].where(batch), name)
        fact = FACTS[name]
        rows = catalog.history(name, asked, asked).where(day < asked)
        state = last_per_key(rows, fact.by, fact.state_order).select(
            F.lit(name).alias("table_name"), "well_id", "report_date_id", _round(F.col(value).cast("double")).alias("amount")
        )
        found = state if found is None else found.unionByName(state)
    return found


@query
def late_repair(s: Samples) -> DataFrame:
    """What the rows of every third day, coming late, change in the stock history."""
    raw = s.well_stock_raw.select("well_id", "d", "event_id", *STOCK)
    is_late = (F.dayofmonth("d") + F.col("well_id")) % 3 == 0
    known = raw.where(~is_late)
    history = _stock_history(known)
    return repair_late(raw.where(is_late), history, known, ["well_id"], "d", STOCK, ["event_id"])


@query
def change_detail(s: Samples) -> DataFrame:
    found = changes(s.completions_raw, ["well_id"], "d", ["horizon_id", "casing"])
    return found.select(
        "well_id", "d", F.concat_ws(",", "changed_columns").alias("changed_columns")
    )


# Date and measures of the results that are kept by their own date.
RESULTS = {
    "well_tests": ("well_test_date", "liquid_ton", "oil_ton", "water_ton"),
    "gas_well_tests": ("well_test_date", "total_gas", "gaslift_gas"),
    "laboratory_results": ("last_lab_date", "water_cut", "mechanical_impurities"),
}


class SheetLoad:
    """The load steps over the sample sheets, without a catalog to write to. Each step
    is written once, as a load does, so later ones plan and read nothing but that."""

    def __init__(self, s: Samples):
        self.folder = scratch(s.spark, "sheets")
        sheets = SampleSheets(s)
        self.tables = sheets.tables
        self.rows = self.kept(sheets.rows)
        self.files = self.kept(L.checked_files(self.rows, self.tables))
        self.records = self.kept(L.checked_records(self.rows, self.files, self.tables))

    def kept(self, df: DataFrame) -> DataFrame:
        return stage_at(df, self.folder)[0]

    def routed(self) -> dict[str, DataFrame]:
        routed = L.route(self.records.where(~Q.rejected()))
        return routed | {"daily_general_comments": L.comments(self.files, self.records)}

    def inserted(self, name: str) -> DataFrame:
        if name == "flowmeters":
            return self.meters.where("inserted")
        return L.new_rows(name, self.routed()[name], None)

    def all_inserted(self) -> dict[str, tuple[DataFrame, int]]:
        """The new rows of each fact, written, and how many they are."""
        names = [*self.routed(), "flowmeters"]
        rows = {"rows": F.count(F.lit(1))}
        self.meters  # noqa: B018 - written before the others need it
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            found = pool.map(lambda n: stage_counted(self.inserted(n), self.folder, rows), names)
            return {n: (df, counts["rows"]) for n, (df, counts) in zip(names, found, strict=True)}

    @cached_property
    def meters(self) -> DataFrame:
        return self.kept(L.meter_fates(self.files, None))


def _entity(name: str) -> Column:
    if name == "flowmeters":
        return F.col("platform_id").cast("string")
    if name == "daily_general_comments":
        return F.concat_ws("/", F.col("field_id").cast("string"), "platform")
    return F.col("well_id").cast("string")


_AMOUNTS = {
    "flowmeters": "reading2",
    "well_stock": "method_id_or_zero",
    "well_tests": "liquid_ton",
    "gas_well_tests": "gaslift_gas",
    "laboratory_results": "water_cut",
    "daily_well_parameters": "gaslift_gas",
    "completions": "horizon_id",
    "well_downtime_reasons": "production_sub_skins_activity_id",
}


def _fact_lines(frames: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for name, df in frames.items():
        df = df.withColumn("method_id_or_zero", F.coalesce("production_method_id", F.lit(0))) if (
            name == "well_stock"
        ) else df
        amount = F.col(_AMOUNTS[name]) if name in _AMOUNTS else F.lit(0)
        parts.append(
            df.select(
                F.lit(name).alias("table_name"),
                _entity(name).alias("entity"),
                "report_date_id",
                F.round(amount.cast("double"), 9).alias("amount"),
            )
        )
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    return lines


@query
def sheet_facts(s: Samples) -> DataFrame:
    """Every row the sample sheets insert into the nine facts."""
    return _fact_lines({n: df for n, (df, _) in SheetLoad(s).all_inserted().items()})


@query
def sheet_parameters(s: Samples) -> DataFrame:
    """Every column of the daily parameters that the sample sheets insert."""
    rows = SheetLoad(s).inserted("daily_well_parameters")
    return rows.drop(*L.ORDER).withColumn("gaslift_gas", _round("gaslift_gas"))


@query
def sheet_stock(s: Samples) -> DataFrame:
    """Every column of the stock rows that the sample sheets insert."""
    return SheetLoad(s).inserted("well_stock").drop(*L.ORDER)


@query
def sheet_results(s: Samples) -> DataFrame:
    """Dates and measures of the test and laboratory results that the sheets insert."""
    load, parts = SheetLoad(s), []
    for name, (date, *values) in RESULTS.items():
        amounts = [F.col(v) for v in values] + [F.lit(None).cast("double")] * (3 - len(values))
        parts.append(
            load.inserted(name).select(
                F.lit(name).alias("table_name"), "well_id", "report_date_id", F.col(date).alias("day"),
                *[_round(a).alias(f"value{i}") for i, a in enumerate(amounts, 1)],
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def route_records(s: Samples) -> DataFrame:
    """Candidate rows per target table."""
    lines = _fact_lines(SheetLoad(s).routed())
    return lines.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("entity").alias("entities")
    )


@query
def sheet_findings(s: Samples) -> DataFrame:
    load = SheetLoad(s)
    findings = L.all_findings(load.files, load.records, load.meters)
    return findings.select("file", "row_idx", "level", "code", "qc")


@query
def load_summary(s: Samples) -> DataFrame:
    """Findings by level and new rows by table, counted by the tasks that write them."""
    load = SheetLoad(s)
    inserted = load.all_inserted()
    frames = (load.files, load.records, load.meters)
    findings = L.all_findings(*frames).unionByName(L.all_outcomes(*frames, {n: df for n, (df, _) in inserted.items()}))
    levels = {level: F.count_if(F.col("level") == level) for level in Q.LEVELS}
    _, seen = stage_counted(findings, load.folder, levels)
    return L.counted_summary(s.spark, seen, {n: rows for n, (_, rows) in inserted.items()})


@query
def summary_lines(s: Samples) -> DataFrame:
    """The lines that report a load."""
    load = SheetLoad(s)
    findings = L.all_findings(load.files, load.records, load.meters)
    stored = {n: load.inserted(n) for n in ("flowmeters", "well_stock")}
    return L.summary_lines(L.load_summary(findings, stored))


@query
def validate_files(s: Samples) -> DataFrame:
    sheets = SampleSheets(s)
    files = L.checked_files(sheets.rows, sheets.tables)
    code = F.element_at(F.transform("findings", lambda f: f["code"]), 1)
    code = F.when(F.size("findings") > 0, code)
    return files.select("file", "field_id", "report_date_id", code.alias("code"))


# Lookups.


@query
def lookup_first_match(s: Samples) -> DataFrame:
    part = s.table("part").select("p_partkey", "p_brand", "p_size")
    brand = (F.col("p_brand"), F.col("name"))
    by_name = lookup(part, s.horizons, [brand], "horizon_id")
    in_field = (1 + F.col("p_size") % 3, F.col("field_id"))
    both = lookup(by_name, s.horizons, [brand, in_field], "field_horizon_id")
    return both.select("p_partkey", "horizon_id", "field_horizon_id")


@query
def lookup_null_safe(s: Samples) -> DataFrame:
    customer = s.table("customer").select("c_custkey", "c_nationkey")
    place = s.platforms.select(F.col("id").alias("place_id"), "name", "square", "field_id")
    placed = customer.join(place, F.col("c_nationkey") == F.col("place_id"), "left")
    on = [(F.col(c), F.col(c)) for c in ("name", "field_id", "square")]
    safe = lookup(placed, s.platforms, on, "platform_id", null_safe=[2])
    plain = lookup(safe, s.platforms, on, "strict_platform_id")
    return plain.select("c_custkey", "platform_id", "strict_platform_id")


@query
def lookup_trimmed(s: Samples) -> DataFrame:
    numbered = s.wells.select("id", F.col("id").cast("string").alias("name"))
    typed = s.events.select(
        "event_id",
        F.col("k").cast("double").cast("string").alias("number_text"),
        F.concat(F.lit(" \t"), "event_type", F.lit(" \n")).alias("type_text"),
    )
    pair = (key_text(F.col("number_text")), key_text(F.col("name")))
    found = lookup(typed, numbered, [pair], "well_id")
    return found.select("event_id", "well_id", trim_all(F.col("type_text")).alias("event_type"))


@query
def lookup_prefix(s: Samples) -> DataFrame:
    part = s.table("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    found = prefix_lookup(part.withColumnRenamed("id", "part"), part, F.col("name"), "name", "first_id")
    return found.select("part", "first_id")


@query
def calendar_lookup(s: Samples) -> DataFrame:
    day = (F.col("d"), F.col("report_date"))
    found = lookup(s.daily.select("well_id", "d"), s.calendar, [day], "report_date_id")
    number = M.day_number(F.col("d"), CALENDAR_START)
    return found.withColumn("by_arithmetic", number)


@named("denormalise")
def denormalise_wells(s: Samples) -> DataFrame:
    dims = [
        Dimension(s.wells, "well_id", {"name": "well", "platform_id": "platform_id"}),
        Dimension(
            s.platforms,
            "platform_id",
            {"name": "platform_name", "square": "square", "field_id": "field_id"},
        ),
        Dimension(s.fields, "field_id", {"name": "field"}),
    ]
    label = mart.platform_label(F.col("platform_name"), F.col("square"))
    joined = denormalise(s.daily, dims)
    return joined.select("well_id", "d", "well", label.alias("platform"), "field")



# Report sheets.


@query
def pivot_cells(s: Samples) -> DataFrame:
    rows = s.report_rows
    at = {"c02": 2, "c05": 5, "c19": 19, "c20": 20}
    pairs = [
        F.struct(F.lit(i).alias("col_idx"), F.col(name).alias("value")) for name, i in at.items()
    ]
    cells = rows.select("file", "row_idx", F.inline(F.array(*pairs)))
    return P.report_rows(cells).select("file", "row_idx", *at)


@query
def report_header(s: Samples) -> DataFrame:
    cells = {
        "ogpd_name": (14, 5),
        "field_name": (15, 5),
        "first_mark": (14, 2),
        "report_date_cell": (16, 19),
        "reading1_cell": (18, 20),
    }
    header = L.resolve_layout(P.report_header(s.report_rows, cells))
    return header.select("file", *cells, "is_lts", "platform_by_file")


@query
def report_body(s: Samples) -> DataFrame:
    return P.body_rows(s.report_rows).select(
        "file",
        "row_idx",
        "end_row",
        D.cell_date(F.col("c19")).alias("test_date"),
        N.number(F.col("c20")).alias("liquid_ton"),
    )


@query
def report_footer(s: Samples) -> DataFrame:
    rows = s.report_rows
    return P.report_footer(
        rows, P.body_ends(rows), error_column="c20", error_offsets=(7, 22), comment_column="c05"
    )


@query
def normalise_numbers(s: Samples) -> DataFrame:
    cell = N.number_cell(F.col("c20"))
    typed = s.report_rows.withColumn("cell", cell)
    return typed.select(
        "file",
        "row_idx",
        F.col("cell.value").alias("value"),
        F.col("cell.status").alias("status"),
        N.rule_value(F.col("cell")).alias("rule_value"),
        decimal_point(without_sentinel(F.col("c20"))).alias("point_text"),
    )


@query
def normalise_dates(s: Samples) -> DataFrame:
    return s.report_rows.select("file", "row_idx", D.cell_date(F.col("c19")).alias("day"))


@query
def loader_gaslift(s: Samples) -> DataFrame:
    per_day = N.number_cell(F.col("c20"))["value"]
    uptime = N.number_cell(F.col("c02"))["value"]
    amount = L.loader_gaslift(per_day, uptime)
    return s.report_rows.select("file", "row_idx", amount.alias("gaslift_gas"))


# Checks.


@query
def validate_rows(s: Samples) -> DataFrame:
    """Findings per well and day over same-day records."""
    key = ["well_id", "d"]
    stock = s.well_stock_raw.select(*key, "category_id", "sub_category_id")
    downtime = s.downtime_raw.select(*key, "category", "comments")
    tests = s.well_tests.select(*key, "well_test_date", "liquid_ton")
    gas = s.gas_well_tests.select(*key, "total_gas", "gaslift_gas")
    lab = s.lab.select(*key, "lab_date", "water_cut", "mechanical_impurities")
    wells = s.wells.select("id", "platform_id").join(
        s.platforms.select(F.col("id").alias("place"), "field_id"), F.col("platform_id") == F.col("place")
    )
    days = s.daily
    for side in (stock, downtime, tests, gas, lab):
        days = days.join(side, key, "left")
    days = days.join(wells, F.col("well_id") == F.col("id"), "left")
    meter = F.when(F.col("n_events") > 1, F.col("casing_text"))
    days = days.withColumn("casing_text", F.col("n_events").cast("string"))
    uptime, cut = F.col("well_uptime_hours") + 1, F.col("water_cut") * 1.1
    category = F.col("category").cast("string")
    rules = [
        Q.Rule("WELL_UNKNOWN", F.col("id").isNull(), "", stops=True),
        Q.Rule("RESULT_DATE_INVALID", F.col("well_test_date").isNull(), ""),
        Q.Rule(
            "FLOWMETER_MISSING",
            R.flowmeter_missing(
                F.col("field_id"), F.col("category_id"), F.col("sub_category_id"), meter
            ),
            "",
        ),
        Q.Rule("UPTIME_RANGE", R.uptime_out_of_range(uptime), ""),
        Q.Rule(
            "DOWNTIME_UNEXPLAINED",
            R.downtime_unexplained(uptime, category, F.col("category"), F.col("comments")),
            "",
        ),
        Q.Rule("LIQUID_RANGE", R.liquid_too_high(F.col("category_id"), F.col("liquid_ton")), ""),
        Q.Rule("GAS_BELOW_GASLIFT", F.col("total_gas") < F.col("gaslift_gas"), ""),
        Q.Rule("PERCENT_RANGE", R.outside_percent(cut), ""),
    ]
    _, findings = Q.validate(days, rules, key)
    return findings.select(*key, "level", "code")


@query
def stale_results(s: Samples) -> DataFrame:
    old = R.results_too_old(
        F.col("ws.sub_category_id"),
        F.col("d"),
        F.col("wt.well_test_date"),
        F.col("lr.lab_date"),
    )
    return (
        _states(s)
        .where(old)
        .select(
            "well_id",
            "d",
            F.col("wt.well_test_date").alias("well_test_date"),
            F.col("lr.lab_date").alias("lab_date"),
        )
    )


@query
def meter_checks(s: Samples) -> DataFrame:
    """Users as meters: every meter must be continuous and may be stale."""
    candidates = s.meter.select(
        "meter_id",
        M.day_number(F.col("d"), CALENDAR_START).alias("day_id"),
        F.col("reading1").cast("double").alias("reading1"),
        F.when(F.col("reading2") != 3, F.col("reading2")).cast("double").alias("reading2"),
    )
    return check_meters(
        candidates,
        None,
        "meter_id",
        "day_id",
        ["reading1"],
        needs_opening=F.lit(True),
        may_be_stale=F.lit(True),
        pairs=[("reading1", "reading2")],
    )


@query
def meter_checks_repeated(s: Samples) -> DataFrame:
    """Every event a candidate: several of a meter and day."""
    candidates = s.meter_events.select(
        "meter_id", "event_id", M.day_number(F.col("d"), CALENDAR_START).alias("day_id"), "reading1", "reading2"
    )
    return check_meters(
        candidates,
        None,
        "meter_id",
        "day_id",
        ["event_id"],
        needs_opening=F.lit(True),
        may_be_stale=F.lit(True),
        pairs=[("reading1", "reading2")],
    )


@query
def orphans(s: Samples) -> DataFrame:
    """Parts of line items that no completion uses as horizon, and customers of
    orders that have no events."""
    used = s.completions_raw.select("horizon_id").distinct()
    lines = Q.orphans(s.table("lineitem"), "l_partkey", used, "horizon_id")
    users = s.events.select("user_id").distinct()
    orders = Q.orphans(s.table("orders"), "o_custkey", users, "user_id")
    return lines.select(F.lit("l_partkey").alias("fk"), F.col("l_partkey").alias("value"), "rows").union(
        orders.select(F.lit("o_custkey"), "o_custkey", "rows")
    )


@query
def duplicates(s: Samples) -> DataFrame:
    return Q.duplicates(s.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def nulls(s: Samples) -> DataFrame:
    wells = s.wells.join(
        s.platforms.select(F.col("id").alias("platform_id"), "square"), "platform_id"
    )
    stock = Q.nulls(s.well_stock_raw, ["category_id", "method_id"])
    return stock.unionByName(Q.nulls(wells, ["name", "square"]))


@query
def mart_constraints(s: Samples) -> DataFrame:
    """Every constraint that the sample mart declares, from one scan of each fact."""
    tables = s.mart_tables
    columns = {n: df.columns for n, df in tables.items() if n in FACTS or n in REPORTED_KEYS}
    return Q.check_constraints(tables, R.declared_constraints(columns, list(s.mart_dimensions)))


# Mart formulas.


def _targets(s: Samples) -> DataFrame:
    return A.monthly_target(s.mart_tables["monthly_reported"], s.calendar, "produced_oil")


def _with_field(s: Samples, df: DataFrame) -> DataFrame:
    dims = [
        Dimension(s.wells, "well_id", {"platform_id": "platform_id"}),
        Dimension(s.platforms, "platform_id", {"field_id": "field_id"}),
        Dimension(s.fields, "field_id", {"name": "field"}),
    ]
    return denormalise(df, dims)


@query
def month_end_target(s: Samples) -> DataFrame:
    daily = _with_field(s, s.daily.select("well_id", "d"))
    found = A.month_end_lookup(daily, _targets(s), "d")
    per_day = F.col("target") / D.days_in_month(F.col("d"))
    return found.select("well_id", "d", "field_id", "target", _round(per_day).alias("per_day"))


@query
def allocate_pro_rata(s: Samples) -> DataFrame:
    days = _with_field(s, s.daily.select("well_id", "d", "well_uptime_hours"))
    shared = A.allocate(days, _targets(s), "well_uptime_hours", "allocated", date="d")
    return shared.select("well_id", "d", "field_id", _round("allocated").alias("allocated"))


@query
def production_formulas(s: Samples) -> DataFrame:
    states = _with_field(s, _states(s)).withColumn("horizon_id", F.col("c.horizon_id"))
    states = denormalise(states, [Dimension(s.horizons, "horizon_id", {"oil_density": "oil_density"})])
    calc = mart.with_production_calc(states, DENSITY_REGION)
    wt, lr, gwt = F.col("wt"), F.col("lr"), F.col("gwt")
    computed = mart.measures(wt, lr, gwt, F.col("well_uptime_hours"))
    return calc.select(
        "well_id",
        "d",
        _round("oil_ton_wellTest").alias("oil_ton"),
        _round("water_ton").alias("water_ton"),
        *[_round(v).alias(n) for n, v in computed.items()],
    )


MART_DOUBLES = (
    "oil_ton_wellTest",
    "water_ton",
    "oil_ton_allocated",
    "oil_loss_ton_wellTest",
)


@query
def complete_table(s: Samples) -> DataFrame:
    wide = mart.complete_table(s.mart_tables, DENSITY_REGION)
    return wide.withColumns({c: _round(c) for c in MART_DOUBLES})


@query
def complete_table_range(s: Samples) -> DataFrame:
    """The mart of three days."""
    days = tuple((day - CALENDAR_START).days + 1 for day in MART_DAYS)
    wide = mart.complete_table(s.mart_tables, DENSITY_REGION, days)
    return wide.withColumns({c: _round(c) for c in MART_DOUBLES})


# Maintenance and sources.


@query
def split_table(s: Samples) -> DataFrame:
    return M.split_table(s.gas_well_tests, ["well_id", "d", "well_test_date", "total_gas", "gaslift_gas"])


@query
def evolve_schema(s: Samples) -> DataFrame:
    return M.evolve(
        s.lab,
        drop=["mechanical_impurities", "event_id"],
        add={"reported_cut": "double", "field_id": "int", "note": "string"},
        defaults={"field_id": 1},
    )


@query
def seed_rows(s: Samples) -> DataFrame:
    """Stock rows per seeded sub-category name and day."""
    names = seed(s.spark, SUB_CATEGORIES, "id int, name string")
    named = denormalise(s.well_stock_raw, [Dimension(names, "sub_category_id", {"name": "name"})])
    return named.groupBy("name", "d").agg(F.count(F.lit(1)).alias("rows"))


@query
def dimension_scan(s: Samples) -> DataFrame:
    return s.wells


@query
def delete_created_on(s: Samples) -> DataFrame:
    dated = s.lab.withColumn("created_at", F.when(F.col("water_cut") != 7, F.col("lab_date")))
    kept = M.delete_created_on(dated, CREATED_DAY)
    return kept.select("well_id", "d", "event_id", "created_at")


def _numbered_platforms(s: Samples) -> DataFrame:
    number = F.regexp_extract("name", "[0-9]+", 0)
    return s.platforms.withColumn("name", F.when(F.col("id") != 5, number).otherwise(F.col("name")))


def _dated_tests(s: Samples) -> DataFrame:
    day = M.day_number(F.col("d"), CALENDAR_START).alias("report_date_id")
    return s.well_tests.select("well_id", day, "event_id")


def _report_day_id(s: Samples) -> Column:
    return s.calendar.where(F.col("report_date") == REPORT_DAY).select("id").scalar()


@query
def delete_report(s: Samples) -> DataFrame:
    """One platform's tests of one report day are deleted."""
    platforms = _numbered_platforms(s)
    return M.delete_report(_dated_tests(s), _report_day_id(s), platforms, s.wells, platform=7)


@query
def delete_report_all(s: Samples) -> DataFrame:
    """Without a platform: the whole day, for wells that reach a platform."""
    return M.delete_report(_dated_tests(s), _report_day_id(s), _numbered_platforms(s), s.wells)


@query
def recode_values(s: Samples) -> DataFrame:
    raw = s.well_stock_raw.withColumn("sub_category_id", F.col("sub_category_id") + 1)
    recoded = M.recode(raw, "sub_category_id", SUB_CATEGORY_RECODING)
    return recoded.select("well_id", "d", "sub_category_id")


@query
def update_where(s: Samples) -> DataFrame:
    first = M.update_where(
        s.horizons,
        (F.col("name") == "Brand#7") & (F.col("field_id") == 1),
        {"oil_density": F.lit(0.754)},
    )
    updates = s.table("part").groupBy(F.col("p_brand").alias("name")).agg(
        (F.max("p_size") / F.lit(100.0)).alias("oil_density")
    )
    updates = updates.where("oil_density >= 0.5")
    second = M.update_from(first.withColumnRenamed("oil_density", "density"),
                           updates.withColumnRenamed("oil_density", "density"), ["name"], "density")
    return second.select("id", "name", "field_id", "density")


@query
def delete_ids(s: Samples) -> DataFrame:
    return M.delete_ids(s.horizons, (1, 4, 5, 6, 14, 16, 17)).select("id", "name")


@query
def shift_key(s: Samples) -> DataFrame:
    days = (OLD_CALENDAR_START - CALENDAR_START).days
    numbered = s.daily.select(
        "well_id", M.day_number(F.col("d"), OLD_CALENDAR_START).alias("report_date_id")
    )
    return M.shift_key(numbered, "report_date_id", days)


@query
def state_changes(s: Samples) -> DataFrame:
    """Null-safe inequality of consecutive as-of states, inclusive against strict."""
    now = _states(s).select("well_id", "d", F.col("wdr.comments").alias("now"))
    before = asof_join(now, s.downtime_raw, ["well_id"], "d", inclusive=False, columns=["comments"])
    return before.select("well_id", "d", differs(F.col("now"), F.col("comments")).alias("changed"))
