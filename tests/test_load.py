import datetime as dt
from pathlib import Path

import pytest
from helpers import DAY, Sheet, cells_frame, rows_of
from pyspark.sql import functions as F

from dayledger.plans import upkeep
from dayledger.plans.load import load_reports, summary_lines
from dayledger.plans.mart import complete_table
from dayledger.sources.catalog import Catalog
from dayledger.sources.reports import list_reports, report_rows
from dayledger.sources.schemas import FACTS

LOADED = dt.date(2025, 2, 1)


def load(catalog, *sheets, **options):
    rows = report_rows(cells_frame(catalog.spark, *sheets))
    return load_reports(rows, catalog, LOADED, **options)


def codes(result, *levels):
    chosen = result.findings.where(F.col("level").isin(*levels)) if levels else result.findings
    return rows_of(chosen, "file", "code")


def counts(catalog):
    return {name: catalog.table(name).count() for name in FACTS}


def good_sheet(file="a", date="1/2/2025", platform="3"):
    return Sheet(file, platform=platform, date=date).readings("1", "2", "3", "4")


def three_wells(**options):
    return good_sheet(**options).well("10").well(" 11").well("12").end(comment="calm")


def test_good_sheet_fills_nine_tables(catalog):
    result = load(catalog, three_wells())
    assert counts(catalog) == {
        "flowmeters": 1, "well_stock": 3, "completions": 3, "well_downtime_reasons": 0,
        "daily_well_parameters": 3, "well_tests": 3, "gas_well_tests": 3,
        "laboratory_results": 3, "daily_general_comments": 1,
    }
    day = (DAY(2025, 1, 2) - DAY(2024, 1, 1)).days + 1
    stock = rows_of(catalog.table("well_stock"))
    assert stock[0] == (100, day, 1, 1, 1, 1, LOADED)
    tests = rows_of(catalog.table("well_tests"))
    assert tests[0] == (100, day, DAY(2025, 1, 1), 100.0, 60.0, 40.0, LOADED)
    daily = catalog.table("daily_well_parameters").where("well_id = 100").first()
    assert (daily["pqa"], daily["gaslift_gas"], daily["pump_depth"]) == ("12.5", 24.0, None)
    assert (daily["responsible_person"], daily["phone_number"]) == ("person", "phone")
    assert rows_of(catalog.table("completions"), "well_id", "horizon_id", "casing") == [
        (100, 5, "168"), (101, 5, "168"), (102, 5, "168"),
    ]
    levels = {r["name"]: r["rows"] for r in result.summary.where("section = 'level'").collect()}
    # One line per inserted row; changes are warnings; unchanged downtime and blank numbers are notes.
    assert levels["SUCCESS"] == 1 + 1 + 4 * 3 and levels["WARNING"] == 2 * 3
    lines = [r["line"] for r in summary_lines(result.summary).collect()]
    assert "     3\t\trow(s) inserted into well_tests" in lines


def test_loading_twice_inserts_nothing(catalog):
    load(catalog, three_wells())
    before = counts(catalog)
    again = load(catalog, three_wells())
    assert counts(catalog) == before
    assert all(df.count() == 0 for df in again.inserted.values())


def test_two_files_of_one_day_count_once(catalog):
    load(catalog, three_wells(file="a"), three_wells(file="b"))
    assert counts(catalog)["daily_well_parameters"] == 3
    assert counts(catalog)["flowmeters"] == 1


def test_second_day_stores_changes_only(catalog):
    load(catalog, three_wells())
    second = (
        good_sheet(file="b", date="1/3/2025").readings("2", "5", "4", "6")
        .well("10").well("11", c9=None).well("12", c7=None).end(comment="windy")
    )
    result = load(catalog, second)
    new = {n: df.count() for n, df in result.inserted.items()}
    assert new["completions"] == 1 and new["well_stock"] == 1
    assert new["daily_well_parameters"] == 3 and new["daily_general_comments"] == 1
    assert new["well_tests"] == 0 and new["laboratory_results"] == 0
    assert [c for c in codes(result, "WARNING")] == [("b", "CHANGED"), ("b", "CHANGED")]


def test_files_rejected_by_header_and_footer(catalog):
    sheets = [
        Sheet("field", field="nowhere").well("10").end(),
        Sheet("platform", platform="99").well("10").end(),
        Sheet("date", date="500").well("10").end(),
        Sheet("calendar", date="1/2/2031").well("10").end(),
        Sheet("footer").well("10").end(error="x"),
        Sheet("twice", field="nowhere", date="junk").well("10").end(),
    ]
    result = load(catalog, *sheets)
    assert codes(result, "ERROR") == [
        ("calendar", "NO_CALENDAR_DATE"), ("date", "REPORT_DATE_INVALID"), ("field", "FIELD_UNKNOWN"),
        ("footer", "FOOTER_ERROR"), ("platform", "PLATFORM_UNKNOWN"), ("twice", "FIELD_UNKNOWN"),
    ]
    assert not any(counts(catalog).values())


def test_each_row_rule(catalog, spark, tmp_path):
    sheet = (
        good_sheet()
        .well("99")
        .well("10", c19="junk")
        .well("10", c18=None)
        .well("10", c58="25")
        .well("10", c58="20")
        .well("10", c20="501")
        .well("10", c24="10", c25="20")
        .well("10", c27="101")
        .well("10", c28="-1")
        .well("10", c58="30", c20="600", c26=None)
        .well("11", c58="20", c59="1", c62="01.01 other", c63="pump")
        .end()
    )
    result = load(catalog, sheet)
    found = rows_of(result.findings.where("level = 'ERROR'"), "row_idx", "code")
    assert found == [
        (14, "WELL_UNKNOWN"), (15, "RESULT_DATE_INVALID"), (16, "FLOWMETER_MISSING"),
        (17, "UPTIME_RANGE"), (18, "DOWNTIME_UNEXPLAINED"), (19, "LIQUID_RANGE"),
        (20, "GAS_BELOW_GASLIFT"), (21, "PERCENT_RANGE"), (22, "PERCENT_RANGE"),
        (23, "LIQUID_RANGE"), (23, "RESULT_DATE_INVALID"), (23, "UPTIME_RANGE"),
    ]
    assert rows_of(catalog.table("daily_well_parameters"), "well_id") == [(101,)]
    assert rows_of(catalog.table("well_downtime_reasons"), "production_sub_skins_activity_id") == [(1,)]
    assert catalog.findings().where("qc and level = 'ERROR'").count() == 12
    assert rows_of(catalog.findings()) == rows_of(result.findings)


def test_missing_uptime_needs_a_reason_and_unreadable_does_not(catalog):
    sheet = good_sheet().well("10", c58="y").well("11", c58=None).well("12", c58="abc").end()
    result = load(catalog, sheet)
    assert rows_of(result.findings.where("level = 'ERROR'"), "row_idx", "code") == [
        (14, "DOWNTIME_UNEXPLAINED")
    ]
    stored = rows_of(catalog.table("daily_well_parameters"), "well_id", "well_uptime_hours", "gaslift_gas")
    assert stored == [(101, None, 0.0), (102, None, 0.0)]
    noted = result.findings.where("code = 'UNPARSABLE_NUMBER'")
    assert rows_of(noted, "row_idx") == [(14,), (15,), (16,)]


def test_old_results_of_a_producing_well_warn(catalog):
    sheet = good_sheet().well("10", c19="12/1/2024").well("11", c6="Fəaliyyətsiz", c26="2024-12-01")
    result = load(catalog, sheet.end())
    warned = result.findings.where("code = 'RESULTS_TOO_OLD'")
    assert rows_of(warned, "row_idx") == [(14,)]


def test_lts_sheet_names_field_and_platform_per_row(catalog):
    sheet = (
        Sheet("lts", ogpd="Neft Daşları", field="LTS", platform=None)
        .well("70", c2="3", c3=None, c18=None)
        .well("71", c2="642.0", c3="642", c18=None)
        .well("71", c2="642", c3=None, c18=None)
        .end(comment="storm")
    )
    result = load(catalog, sheet)
    assert codes(result, "ERROR") == []
    assert rows_of(catalog.table("daily_well_parameters"), "well_id") == [(200,), (201,), (202,)]
    said = rows_of(catalog.table("daily_general_comments"), "field_id", "platform", "general_comments")
    assert said == [(2, "642", "storm")]


def test_row_level_platform_of_another_ogpd(catalog):
    sheet = Sheet("o", ogpd="other", platform="5").well("51", c3=None).end(comment="x")
    load(catalog, sheet)
    assert rows_of(catalog.table("daily_well_parameters"), "well_id") == [(120,)]
    assert rows_of(catalog.table("daily_general_comments"), "platform") == [("5",)]


def test_sheet_without_terminator_and_short_sheet(catalog):
    endless = good_sheet(file="endless").well("10")
    short = Sheet("short", date="1/3/2025").readings("1", "2", "3", "4").well("11")
    short.cells[short.next_row, 2] = None
    result = load(catalog, endless, short)
    assert codes(result, "ERROR") == []
    assert counts(catalog)["daily_well_parameters"] == 2
    assert counts(catalog)["daily_general_comments"] == 0


def meter_sheet(file, date, platform, *readings):
    return Sheet(file, platform=platform, date=date).readings(*readings).end()


def test_flowmeter_checks(catalog):
    result = load(
        catalog,
        meter_sheet("a", "1/2/2025", "8", "0", "10", "0", "20"),
        meter_sheet("b", "1/3/2025", "8", "11", "15", "20", "25"),
        meter_sheet("c", "1/4/2025", "8", "99", "100", "25", "30"),
        meter_sheet("d", "1/2/2025", "3", None, "7", None, "8"),
        meter_sheet("e", "1/3/2025", "3", None, "7", None, "9"),
        meter_sheet("f", "1/2/2025", "13", None, "7", "1", "8"),
        meter_sheet("g", "1/2/2025", "5", "1", "2", "3", "4"),
    )
    # b breaks with a; c has no entry of the day before, since b was not stored.
    assert codes(result, "ERROR") == [("b", "METER_DISCONTINUOUS"), ("f", "METER_INCOMPLETE")]
    assert rows_of(result.inserted["flowmeters"], "file") == [("a",), ("c",), ("d",), ("e",)]
    assert rows_of(result.findings.where("code = 'METER_STALE'"), "file") == [("e",)]
    assert rows_of(result.findings.where("code = 'METER_ABSENT'"), "file") == [("g",)]


def test_a_day_that_arrives_twice(catalog):
    load(catalog, meter_sheet("a", "1/2/2025", "8", "5", "10", "5", "20"))
    result = load(
        catalog,
        meter_sheet("b", "1/3/2025", "8", "99", "100", "20", "30"),
        meter_sheet("c", "1/3/2025", "8", "10", "15", "20", "25"),
    )
    assert codes(result, "ERROR") == [("b", "METER_DISCONTINUOUS")]
    assert rows_of(result.inserted["flowmeters"], "file") == [("c",)]


def partition_filters(df):
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [x for x in plan.split("\n") if x.startswith("PartitionFilters: ")]


def test_existence_checks_read_only_periods_that_matter(catalog, spark):
    load(catalog, good_sheet().well("11", c58="20", c59="1", c62="01.01 other", c63="pump").end(comment="x"))
    days = spark.createDataFrame([(400, 100)], "report_date_id int, well_id int")
    for name in ("flowmeters", "well_stock", "completions", "well_downtime_reasons", "daily_general_comments"):
        for part in (catalog.since(name, days), catalog.before(name, days)):
            assert [x[:32] for x in partition_filters(part)] == ["PartitionFilters: [isnotnull(per"]


def test_deletes_touch_only_their_periods(catalog, tmp_path):
    load(catalog, three_wells(file="a"), three_wells(file="b", date="5/2/2025"), three_wells(file="c", date="5/3/2025"))

    def files():
        found = (tmp_path / "mart" / "daily_well_parameters").glob("period=*/*.parquet")
        return {str(f) for f in found}

    before = files()
    upkeep.delete_entries_of_report(catalog, DAY(2025, 1, 2))
    assert catalog.table("daily_well_parameters").count() == 6
    gone = before - files()
    assert len({f.split("period=")[1].split("/")[0] for f in gone}) == 1
    upkeep.delete_entries_of_report(catalog, DAY(2025, 5, 2))
    assert catalog.table("daily_well_parameters").count() == 3


def test_release_removes_staged_copies(catalog):
    result = load(catalog, three_wells())
    staged = [Path(p.removeprefix("file:")) for p in catalog._staged]
    assert result.findings.count() > 0 and len(staged) > 10 and all(p.exists() for p in staged)
    catalog.release()
    assert not any(p.exists() for p in staged)
    assert catalog.findings().count() > 0


def test_gas_test_date_policy(catalog):
    sheet = three_wells()
    load(catalog, sheet, gas_policy="well_for_field")
    assert {r[0] for r in rows_of(catalog.table("gas_well_tests"), "well_test_date")} == {DAY(2025, 1, 1)}
    with pytest.raises(ValueError):
        load(catalog, sheet, gas_policy="other")


def test_upkeep(catalog, spark, tmp_path):
    load(catalog, three_wells())
    other = Sheet("lts", ogpd="x", field="LTS", date="1/3/2025").well("70", c2="3", c3=None).end("hm")
    load_reports(report_rows(cells_frame(spark, other)), catalog, dt.date(2025, 2, 2))
    assert counts(catalog)["daily_well_parameters"] == 4
    upkeep.delete_entries_of_report(catalog, DAY(2025, 1, 2), platform=8)
    assert counts(catalog)["daily_well_parameters"] == 4
    upkeep.delete_entries_created_on(catalog, dt.date(2025, 2, 2))
    assert rows_of(catalog.table("daily_well_parameters"), "well_id") == [(100,), (101,), (102,)]
    moved = Catalog(spark, str(tmp_path / "moved"))
    upkeep.move_calendar(catalog, moved, DAY(2015, 1, 1), DAY(2030, 1, 1), DAY(2024, 1, 1))
    old = {r[0] for r in rows_of(catalog.table("well_tests"), "report_date_id")}
    assert {r[0] for r in rows_of(moved.table("well_tests"), "report_date_id")} == {d + 3287 for d in old}
    assert moved.table("report_dates").count() == 5480
    upkeep.delete_entries_of_report(catalog, DAY(2025, 1, 2), platform=3)
    assert not any(counts(catalog).values())
    load(catalog, three_wells())
    upkeep.delete_all_entries(catalog)
    assert not any(counts(catalog).values())


def test_mart_of_a_loaded_sheet(catalog, spark):
    low = good_sheet().well("10").well("11", c58="12", c59="1", c62="02.05", c63="pump").end()
    load(catalog, low)
    month = (DAY(2025, 1, 31) - DAY(2024, 1, 1)).days + 1
    catalog.replace(
        spark.createDataFrame([(1, month, 3100.0, None, None, None, None, LOADED)], "a int, b int, c double, d double, e double, f double, g double, h date").toDF(
            *catalog.table("monthly_reported").columns
        ),
        "monthly_reported",
    )
    mart = complete_table(catalog.tables())
    assert mart.count() == catalog.table("daily_well_parameters").count()
    rows = {r["well"].strip(): r for r in mart.collect()}
    full, half = rows["10"], rows["11"]
    # 100 t of liquid, density 0.8, water cut 25 %: 100 * 0.6 / 0.85 and 100 * 0.25 / 0.85.
    assert (full["oil_ton_wellTest"], full["water_ton"]) == (71.0, 29.0)
    assert (half["liquid_ton"], half["oil_ton_wellTest"]) == (50.0, 35.0)
    assert half["oil_loss_ton_wellTest"] == 100 * 0.75 * 12 / 24
    assert full["oil_ton_allocated"] + half["oil_ton_allocated"] == pytest.approx(100.0)
    assert (half["total_gas"], half["gaslift_gas"], half["produced_gas"]) == (25.0, 10.0, 15.0)
    assert (half["production_skin"], half["downtime_category"]) == ("02.05 repair", "1")
    assert full["platform"] == "3" and full["horizon"] == "FLD" and len(mart.columns) == 60
    assert mart.columns[:9] == [
        "report_date", "field", "platform", "well", "well_stock_category", "production_well_stock_sub_category",
        "production_method", "horizon", "completion_interval",
    ]
    catalog.create_view(mart, "complete_table")
    assert spark.table("complete_table").count() == mart.count()


def test_list_reports(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.XLSX", "b.xls", "c.txt", "sub/d.xlsx"):
        (tmp_path / name).write_text("x")

    def names(recursive):
        found = list_reports(spark, str(tmp_path), recursive)
        return sorted(r["path"].rsplit("/", 1)[1] for r in found.collect())

    assert names(False) == ["a.XLSX", "b.xls"]
    assert names(True) == ["a.XLSX", "b.xls", "d.xlsx"]
