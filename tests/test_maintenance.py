import datetime as dt

from helpers import rows_of
from pyspark.sql import functions as F

from dayledger.operators import maintenance as M
from dayledger.sources import seeds

DAY = dt.date


def test_calendar_has_every_day(spark):
    got = M.calendar(spark, seeds.CALENDAR_START, seeds.CALENDAR_END)
    assert got.count() == 5480
    ends = got.where("id in (1, 5480)")
    assert rows_of(ends) == [(1, DAY(2015, 1, 1)), (5480, DAY(2030, 1, 1))]


def test_seeded_months_end_on_the_old_calendar(spark):
    calendar = M.calendar(spark, seeds.OLD_CALENDAR_START, DAY(2026, 1, 1))
    ids = {r[1] for r in seeds.MONTHLY_REPORTED}
    found = calendar.where(F.col("id").isin(*ids))
    assert {r["report_date"] for r in found.collect()} == {
        DAY(2025, 1, 31), DAY(2025, 2, 28), DAY(2025, 3, 31)
    }


def test_shift_key_by_the_calendar_move(spark):
    days = (seeds.OLD_CALENDAR_START - seeds.CALENDAR_START).days
    df = spark.createDataFrame([(1,), (397,)], "report_date_id int")
    assert days == 3287
    assert rows_of(M.shift_key(df, "report_date_id", days)) == [(3288,), (3684,)]


def test_delete_created_on_keeps_undated_rows(spark):
    df = spark.createDataFrame(
        [(1, DAY(2025, 1, 1)), (2, DAY(2025, 1, 2)), (3, None)], "id int, created_at date"
    )
    assert rows_of(M.delete_created_on(df, DAY(2025, 1, 1)), "id") == [(2,), (3,)]


def fact(spark):
    rows = [(1, 7), (2, 7), (3, 7), (1, 8), (9, 7)]
    return spark.createDataFrame(rows, "well_id int, report_date_id int")


def places(spark):
    platforms = spark.createDataFrame([(70, "3"), (71, "3"), (72, "A")], "id int, name string")
    wells = spark.createDataFrame([(1, 70), (2, 72), (3, 99)], "id int, platform_id int")
    return platforms, wells


def test_delete_report_on_one_platform(spark):
    platforms, wells = places(spark)
    got = M.delete_report(fact(spark), 7, platforms, wells, platform=3)
    assert rows_of(got) == [(1, 8), (2, 7), (3, 7), (9, 7)]


def test_delete_report_on_all_keeps_rows_without_a_platform(spark):
    platforms, wells = places(spark)
    got = M.delete_report(fact(spark), 7, platforms, wells)
    assert rows_of(got) == [(1, 8), (3, 7), (9, 7)]


def test_delete_report_by_platform_name(spark):
    platforms, _ = places(spark)
    df = spark.createDataFrame([("3", 7), ("A", 7), ("zz", 7)], "platform string, report_date_id int")
    assert rows_of(M.delete_report_by_name(df, 7, platforms, 3)) == [("A", 7), ("zz", 7)]
    assert rows_of(M.delete_report_by_name(df, 7, platforms)) == [("zz", 7)]


def test_recode_reads_the_original_value(spark):
    df = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 9)] + [(None,)], "c int")
    got = [r[0] for r in M.recode(df, "c", seeds.SUB_CATEGORY_RECODING).collect()]
    assert got == [1, 1, 2, 3, 9, None]


def test_update_where_and_from(spark):
    df = spark.createDataFrame([(1, "FLD", 1, None), (2, "FLD", 2, 0.8)], "id int, name string, field_id int, oil_density double")
    named = M.update_where(df, F.col("id") == 1, {"name": F.lit("new")})
    assert rows_of(named, "id", "name") == [(1, "new"), (2, "FLD")]
    updates = spark.createDataFrame([("FLD", 1, 0.855)], "name string, field_id int, oil_density double")
    got = M.update_from(df, updates, ["name", "field_id"], "oil_density")
    assert rows_of(got, "id", "oil_density") == [(1, 0.855), (2, 0.8)]


def test_delete_ids_evolve_split_truncate(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, name string")
    assert rows_of(M.delete_ids(df, (1,))) == [(2, "b"), (None, "c")]
    got = M.evolve(df, ["name"], {"field_id": "int", "oil_density": "double"}, {"field_id": 1})
    assert got.dtypes == [("id", "int"), ("field_id", "int"), ("oil_density", "double")]
    assert {r["field_id"] for r in got.collect()} == {1}
    assert M.split_table(df, ["name"]).columns == ["name"]
    assert M.truncate(df).count() == 0 and M.truncate(df).schema == df.schema


def test_seed_lists_come_from_csv(spark, tmp_path):
    (tmp_path / "wells.csv").write_text("id,name,platform_id\n1,\"11 \",3\n2,,4\n", encoding="utf-8")
    got = seeds.seed_csv(spark, str(tmp_path / "wells.csv"), "id int, name string, platform_id int")
    assert rows_of(got) == [(1, "11 ", 3), (2, None, 4)]
