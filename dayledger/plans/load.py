"""Load report sheets: rows -> checked records -> fact tables, idempotently.

The steps are plain DataFrame functions; :func:`load_reports` runs them against
a catalog, staging each intermediate result once as a written table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions.dates import cell_date
from dayledger.functions.numbers import zero_if_null
from dayledger.functions.text import key_text, padded_count, trim_all
from dayledger.operators.incremental import append_if_absent, append_if_changed
from dayledger.operators.lookup import lookup, prefix_lookup
from dayledger.operators.meters import check_meters
from dayledger.operators.quality import (
    ERROR,
    FINDINGS,
    INFO,
    SUCCESS,
    WARNING,
    check,
    findings_of,
    rejected,
)
from dayledger.plans import rules as R
from dayledger.sources import schemas as S
from dayledger.sources.catalog import Catalog
from dayledger.sources.reports import (
    body_ends,
    body_rows,
    flowmeter_block,
    report_footer,
    report_header,
    well_records,
)

# Header texts that change the layout of a sheet.
OGPD_WITH_FILE_PLATFORM = "28 May"
LTS = "LTS"
LTS_FIELDS = {"3": "Palçıq Pilpiləsi"}
LTS_OTHER_FIELD = "Neft Daşları"

ORDER = ("file", "row_idx")
WELL_FACTS = (
    "well_stock",
    "completions",
    "well_downtime_reasons",
    "daily_well_parameters",
    "well_tests",
    "gas_well_tests",
    "laboratory_results",
)
# A new row of these is reported as a change of the well.
REPORTED_CHANGES = ("well_stock", "completions", "well_downtime_reasons")


@dataclass
class LoadResult:
    """Inserted rows by table, findings (qc marks the flagged subset) and summary."""

    inserted: Mapping[str, DataFrame]
    findings: DataFrame
    summary: DataFrame = field(repr=False)

    @property
    def qc(self) -> DataFrame:
        return self.findings.where("qc")


def resolve_layout(header: DataFrame) -> DataFrame:
    """Add ``is_lts`` (field and platform per row) and ``platform_by_file``."""
    return header.withColumns(
        {
            "is_lts": F.col("field_name").eqNullSafe(F.lit(LTS)),
            "platform_by_file": F.col("ogpd_name").eqNullSafe(F.lit(OGPD_WITH_FILE_PLATFORM)),
        }
    )


def checked_files(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per file: header, footer, resolved keys and ``findings``."""
    ends = body_ends(rows)
    files = resolve_layout(flowmeter_block(report_header(rows)))
    files = files.join(report_footer(rows, ends), "file", "left")
    files = files.withColumns(
        {
            "report_date": cell_date(F.col("report_date_cell")),
            "platform": key_text(F.col("platform_name")),
        }
    )
    files = lookup(files, tables["fields"], [(F.col("field_name"), F.col("name"))], "field_id")
    on_field = [
        (F.when(F.col("platform_by_file"), F.col("platform")), key_text(F.col("name"))),
        (F.col("field_id"), F.col("field_id")),
    ]
    files = lookup(files, tables["platforms"], on_field, "platform_id")
    day = [(F.col("report_date"), F.col("report_date"))]
    files = lookup(files, tables["report_dates"], day, "report_date_id")
    return check(files, R.file_rules(), first_only=True)


# Columns that lookups read or set; the rest of a record rides along packed.
_LOOKUP_COLUMNS = (
    *ORDER, "is_lts", "platform_by_file", "field_id", "platform", "platform_id", "row_platform",
    "square", "well_name", "category_name", "sub_category_name", "method_name", "horizon_name",
    "activity_name",
)


def resolve_rows(body: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Body records with field, platform, well and dimension keys."""
    packed = [c for c in body.columns if c not in _LOOKUP_COLUMNS]
    rows = _resolve_places(
        body.select(*_LOOKUP_COLUMNS, F.struct(*packed).alias("__rest")), tables
    )
    for column, table, output in (
        ("category_name", "well_stock_categories", "well_stock_category_id"),
        (
            "sub_category_name",
            "production_well_stock_sub_categories",
            "production_well_stock_sub_category_id",
        ),
        ("method_name", "production_methods", "production_method_id"),
        ("horizon_name", "horizons", "horizon_id"),
    ):
        pair = (trim_all(F.col(column)), trim_all(F.col("name")))
        rows = lookup(rows, tables[table], [pair], output)
    rows = prefix_lookup(
        rows,
        tables["production_sub_skins_activities"],
        F.col("activity_name"),
        "name",
        "production_sub_skins_activity_id",
    )
    return rows.select("*", "__rest.*").drop("__rest")


def _resolve_places(rows: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Field, platform and well; an LTS sheet names field and platform per row."""
    lts_field = F.lit(LTS_OTHER_FIELD)
    for platform, name in LTS_FIELDS.items():
        is_platform = key_text(F.col("row_platform")) == platform
        lts_field = F.when(is_platform, F.lit(name)).otherwise(lts_field)

    def own(row_value: Column, file_value: str) -> Column:
        return F.when(F.col("is_lts"), row_value).otherwise(F.col(file_value))

    rows = rows.withColumns(
        {
            "__lts_field": F.when(F.col("is_lts"), lts_field),
            "platform": own(key_text(F.col("row_platform")), "platform"),
        }
    )
    rows = lookup(rows, tables["fields"], [(F.col("__lts_field"), F.col("name"))], "__lts_id")
    rows = rows.withColumn("field_id", own(F.col("__lts_id"), "field_id"))
    by_square = [
        (F.when(~F.col("platform_by_file"), F.col("platform")), key_text(F.col("name"))),
        (F.col("field_id"), F.col("field_id")),
        (key_text(F.col("square")), key_text(F.col("square"))),
    ]
    rows = lookup(rows, tables["platforms"], by_square, "__row_platform_id", null_safe=[2])
    rows = rows.withColumn("platform_id", F.coalesce("platform_id", "__row_platform_id"))
    on_platform = [
        (key_text(F.col("well_name")), key_text(F.col("name"))),
        (F.col("platform_id"), F.col("platform_id")),
    ]
    rows = lookup(rows, tables["wells"], on_platform, "well_id")
    return rows.drop("__lts_field", "__lts_id", "__row_platform_id")


def checked_records(
    rows: DataFrame, files: DataFrame, tables: Mapping[str, DataFrame]
) -> DataFrame:
    """Body records of the accepted files, with keys and ``findings``."""
    accepted = files.where(~rejected()).select(
        "file", "end_row", "is_lts", "platform_by_file", "field_id", "platform", "platform_id",
        "report_date", "report_date_id", "responsible_person", "phone_number",
    )
    body = body_rows(rows, ends=accepted)
    return check(resolve_rows(well_records(body), tables), [*R.record_rules(), R.age_rule()])


def gas_test_date(policy: str) -> Column:
    """``gas``: the gas test's own date; ``well_for_field``: in the metered field
    the well test's date."""
    if policy == "gas":
        return F.col("last_gas_well_test_date")
    if policy != "well_for_field":
        raise ValueError(f"unknown gas test date policy {policy!r}")
    metered = F.col("field_id") == R.METERED_FIELD
    return F.when(metered, F.col("last_well_test_date")).otherwise(
        F.col("last_gas_well_test_date")
    )


def loader_gaslift(per_day: Column, uptime: Column) -> Column:
    """Daily gas lift for the hours the well ran; a missing side counts as zero."""
    return zero_if_null(per_day) / 24 * zero_if_null(uptime)


def route(records: DataFrame, gas_policy: str = "gas") -> dict[str, DataFrame]:
    """One frame per fact table from the accepted records."""
    keyed = [F.col(c) for c in (*ORDER, "well_id", "report_date_id")]

    def numbers(*names: str) -> list[Column]:
        return [F.col(n)["value"].alias(n) for n in names]

    def table(*columns: str | Column) -> DataFrame:
        return records.select(*keyed, *columns)

    gaslift = loader_gaslift(F.col("gaslift_gas_day")["value"], F.col("well_uptime_hours")["value"])
    return {
        "well_stock": table(
            "well_stock_category_id",
            F.lit(1).alias("well_stock_sub_category_id"),
            "production_well_stock_sub_category_id",
            "production_method_id",
        ),
        "completions": table("horizon_id", *S.COMPLETION_TEXTS),
        "well_downtime_reasons": table(
            "downtime_category", "production_sub_skins_activity_id", "comments"
        ),
        "daily_well_parameters": table(
            "flowmeter",
            *numbers("well_uptime_hours"),
            *S.PRESSURES,
            gaslift.alias("gaslift_gas"),
            "gaslift_system_pressure",
            *numbers(*S.PUMP_NUMBERS),
            "esp_downhole_gas_separator",
            "srp_pumpjack_type",
            *numbers(*S.ROD_AND_SCREW_NUMBERS),
            "responsible_person",
            "phone_number",
        ),
        "well_tests": table(
            F.col("last_well_test_date").alias("well_test_date"),
            *numbers("liquid_ton", "oil_ton", "water_ton"),
        ),
        "gas_well_tests": table(
            gas_test_date(gas_policy).alias("well_test_date"),
            *numbers("total_gas", "gaslift_gas"),
        ),
        "laboratory_results": table(
            "last_lab_date", *numbers("water_cut", "mechanical_impurities")
        ),
    }


def comments(files: DataFrame, records: DataFrame) -> DataFrame:
    """Footer comments. An LTS sheet names field and platform per row, and its
    comment belongs to those of the last body row."""
    ended = files.where(~rejected() & F.col("end_row").isNotNull())
    last = records.where("is_lts").select(
        "file",
        (F.col("row_idx") + 1).alias("end_row"),
        F.col("field_id").alias("__field_id"),
        F.col("platform").alias("__platform"),
    )
    placed = ended.join(last, ["file", "end_row"], "left")

    def own(row_value: str, file_value: str) -> Column:
        return F.when(F.col("is_lts"), F.col(row_value)).otherwise(F.col(file_value))

    return placed.select(
        "file",
        F.col("end_row").alias("row_idx"),
        own("__field_id", "field_id").alias("field_id"),
        own("__platform", "platform").alias("platform"),
        "report_date_id",
        "general_comments",
    ).dropna(subset=["field_id", "platform"])


def meter_fates(files: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Flowmeter candidates of the accepted files with their check flags."""
    platform = F.col("platform").try_cast("int")
    metered = (F.col("field_id") == R.METERED_FIELD) & platform.isin(*R.METERED_PLATFORMS)
    candidates = files.where(~rejected() & F.col("platform_id").isNotNull() & metered).select(
        "file", platform.alias("platform_no"), "platform_id", "report_date_id",
        "reading1", "reading2", "reading3", "reading4", "calibration_date",
    )
    return check_meters(
        candidates,
        stored,
        "platform_id",
        "report_date_id",
        ["file"],
        needs_opening=F.col("platform_no").isin(*R.CONTINUOUS_PLATFORMS),
        may_be_stale=F.col("platform_no").isin(*R.STALE_PLATFORMS),
    )


def new_rows(
    name: str, incoming: DataFrame, stored: DataFrame | None, recent: DataFrame | None = None
) -> DataFrame:
    """Rows to append to a fact: changes only where it tracks columns, else new keys."""
    fact = S.FACTS[name]
    if fact.tracked:
        return append_if_changed(incoming, stored, fact.by, fact.on, fact.tracked, ORDER, recent)
    return append_if_absent(incoming, stored, fact.key, ORDER)


def new_rows_of(catalog: Catalog, name: str, incoming: DataFrame) -> DataFrame:
    """``new_rows`` against the periods of a stored fact that can matter."""
    if S.FACTS[name].tracked:
        return new_rows(name, incoming, catalog.before(name, incoming), catalog.since(name, incoming))
    return new_rows(name, incoming, catalog.near(name, incoming))


def new_meters(catalog: Catalog, files: DataFrame) -> DataFrame:
    """``meter_fates`` against the stored periods from the day before the files on."""
    days = files.where("report_date_id is not null").select("report_date_id")
    return meter_fates(files, catalog.since("flowmeters", days, days_before=1))


def _remark(rows: DataFrame, level: str, code: str, message: str, qc: bool) -> DataFrame:
    return rows.select(
        "file",
        F.col("row_idx").cast("int").alias("row_idx"),
        F.lit(level).alias("level"),
        F.lit(code).alias("code"),
        F.lit(message).alias("message"),
        F.lit(qc).alias("qc"),
    )


def outcomes(
    records: DataFrame, inserted: Mapping[str, DataFrame], names: Sequence[str] = WELL_FACTS
) -> DataFrame:
    """One line per accepted record and target table: stored, changed or already
    there. One join answers all tables."""
    marks = None
    for name in names:
        mark = inserted[name].select(*ORDER, F.lit(name).alias("table"))
        marks = mark if marks is None else marks.unionByName(mark)
    marks = marks.groupBy(*ORDER).agg(F.collect_set("table").alias("tables"))
    lines = records.select(*ORDER).join(marks, list(ORDER), "left")
    each = F.explode(F.array(*[F.lit(n) for n in names])).alias("table")
    lines = lines.select(*ORDER, "tables", each)
    stored = F.coalesce(F.array_contains("tables", F.col("table")), F.lit(False))
    return _outcome(lines, stored, F.col("table").isin(*REPORTED_CHANGES))


def _outcome(lines: DataFrame, stored: Column, as_change: Column) -> DataFrame:
    changed = stored & as_change
    level = F.when(changed, WARNING).when(stored, SUCCESS).otherwise(INFO)
    code = F.when(changed, "CHANGED").when(stored, "STORED").otherwise("ALREADY_STORED")
    row_idx = F.col("row_idx").cast("int")
    return lines.select(
        "file",
        row_idx.alias("row_idx"),
        level.alias("level"),
        code.alias("code"),
        F.col("table").alias("message"),
        changed.alias("qc"),
    )


def all_findings(files: DataFrame, records: DataFrame, meters: DataFrame) -> DataFrame:
    """What was wrong with files, rows and meters."""
    no_row = F.lit(None).cast("int").alias("row_idx")
    row = F.col("row_idx").cast("int").alias("row_idx")
    accepted = files.where(~rejected())
    kept_back = files.where(rejected() & (F.col(FINDINGS)[0]["code"] != "FOOTER_ERROR"))
    # The age of results is reported for kept rows only.
    without_warnings = F.filter(FINDINGS, lambda f: f["level"] != WARNING)
    reported = F.when(rejected(), without_warnings).otherwise(F.col(FINDINGS))
    not_kept = "data is not stored"
    incomplete = meters.where("incomplete")
    parts = [
        findings_of(files, ["file", no_row]),
        findings_of(records.withColumn(FINDINGS, reported), ["file", row]),
        _remark(kept_back.select("file", no_row), WARNING, "NOT_STORED", not_kept, False),
        _remark(records.where(rejected()), WARNING, "NOT_STORED", not_kept, False),
        _remark(
            accepted.join(meters.select("file"), "file", "left_anti").select("file", no_row),
            INFO,
            "METER_ABSENT",
            "no flowmeter on the platform",
            False,
        ),
        _remark(
            incomplete.select("file", no_row), ERROR, "METER_INCOMPLETE", "a reading is missing", True
        ),
        _remark(incomplete.select("file", no_row), WARNING, "NOT_STORED", not_kept, False),
        _remark(
            meters.where("discontinuous").select("file", no_row),
            ERROR,
            "METER_DISCONTINUOUS",
            "opening reading differs from the closing reading of the day before",
            True,
        ),
        _remark(
            meters.where("stale").select("file", no_row),
            WARNING,
            "METER_STALE",
            "same reading as the day before",
            True,
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def all_outcomes(
    files: DataFrame, records: DataFrame, meters: DataFrame, inserted: Mapping[str, DataFrame]
) -> DataFrame:
    """What happened to every candidate row of the nine facts."""
    comment = outcomes(
        comments(files, records), inserted, names=["daily_general_comments"]
    )
    no_row = F.lit(None).cast("int").alias("row_idx")
    sound = meters.where("inserted or exists").select(
        "file", no_row, F.lit("flowmeters").alias("table"), "inserted"
    )
    meter = _outcome(sound, F.col("inserted"), F.lit(False))
    kept = records.where(~rejected())
    return outcomes(kept, inserted).unionByName(comment).unionByName(meter)


def load_summary(findings: DataFrame, inserted: Mapping[str, DataFrame]) -> DataFrame:
    """(section, name, rows): findings per level and inserted rows per table."""
    by_level = findings.groupBy(F.lit("level").alias("section"), F.col("level").alias("name"))
    summary = by_level.agg(F.count(F.lit(1)).alias("rows"))
    for name, new in inserted.items():
        counted = new.agg(F.count(F.lit(1)).alias("rows"))
        line = counted.select(F.lit("table").alias("section"), F.lit(name).alias("name"), "rows")
        summary = summary.unionByName(line)
    return summary


def counted_summary(
    spark: SparkSession, levels: Mapping[str, int], inserted: Mapping[str, int]
) -> DataFrame:
    """The same from counts that writes took."""
    lines = [("level", name, rows) for name, rows in levels.items() if rows]
    lines += [("table", name, rows) for name, rows in inserted.items()]
    return spark.createDataFrame(lines, "section string, name string, rows bigint")


def summary_lines(summary: DataFrame) -> DataFrame:
    """Right-aligned report lines of a summary."""
    tail = F.when(
        F.col("section") == "table", F.format_string("row(s) inserted into %s", F.col("name"))
    ).otherwise(F.lower("name"))
    return summary.select(F.concat_ws("\t\t", padded_count(F.col("rows")), tail).alias("line"))


def load_reports(
    rows: DataFrame, catalog: Catalog, load_date: dt.date, gas_policy: str = "gas"
) -> LoadResult:
    """Load sheets into the catalog. Running it again inserts nothing.

    Everything is computed and staged against the tables as they were before
    any is appended to. The nine appends are one write: readers see them when all are
    done, and what a load left that broke off is removed first. ``load_date`` becomes
    ``created_at``. The findings are kept in the catalog; the result reads staged
    copies, until ``catalog.release()``. Its summary is counted by the writes.
    """
    catalog.discard_open()
    tables = catalog.tables()
    files = catalog.stage(checked_files(rows, tables))
    records = catalog.stage(checked_records(rows, files, tables))
    routed = route(records.where(~rejected()), gas_policy)
    routed["daily_general_comments"] = comments(files, records)

    def staged(name: str) -> DataFrame:
        if name == "flowmeters":
            return catalog.stage(new_meters(catalog, files))
        return catalog.stage(new_rows_of(catalog, name, routed[name]))

    # The nine tables do not depend on each other: their jobs share the cluster.
    names = [*routed, "flowmeters"]
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        inserted = dict(zip(names, pool.map(staged, names)))
        meters = inserted["flowmeters"]
        inserted["flowmeters"] = meters.where("inserted")
        inserted = {n: df.withColumn("created_at", F.lit(load_date)) for n, df in inserted.items()}
        write = catalog.journal.start()
        done = dict(zip(names, pool.map(lambda n: catalog.append(inserted[n], n, write), names)))
    catalog.finish(write, done)
    findings = all_findings(files, records, meters)
    findings, levels = catalog.log(findings.unionByName(all_outcomes(files, records, meters, inserted)))
    summary = counted_summary(catalog.spark, levels, {n: done[n].rows for n in names})
    return LoadResult(inserted, findings, summary)
