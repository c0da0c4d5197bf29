import datetime as dt

import pytest
from pyspark.sql import functions as F

from dayledger.functions import dates as D
from dayledger.functions import numbers as N
from dayledger.functions import text as T

DAY = dt.date


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_trim_all_strips_every_space(spark):
    values = [" a b\t", " x \n", "﻿y", None]
    assert column(spark, values, T.trim_all) == ["a b", "x", "y", None]


def test_key_text_joins_numbers_and_texts(spark):
    values = [" 642.0 ", "642", "A.0", "10.50", "7.00"]
    assert column(spark, values, T.key_text) == ["642", "642", "A.0", "10.50", "7"]


def test_prefix_key_trims_after_cutting(spark):
    assert column(spark, ["ASIA x", "01.01 stop"], T.prefix_key) == ["ASIA", "01.01"]


def test_truthy(spark):
    values = [None, "", "0", "false", "x", "00"]
    assert column(spark, values, T.truthy) == [False, False, False, False, True, True]


def test_file_extension(spark):
    values = ["/a/b.XLSX", "/a.b/c", "/a/.xls", "/a/x.y.xls"]
    assert column(spark, values, T.file_extension) == [".xlsx", "", "", ".xls"]


def test_differs_is_never_null(spark):
    df = spark.createDataFrame([(None, None), (None, "a"), ("", None), ("a", "a")], "a string, b string")
    got = [r[0] for r in df.select(T.differs(F.col("a"), F.col("b"))).collect()]
    assert got == [False, True, True, False]


def test_padded_count(spark):
    assert column(spark, [5, 1234567], T.padded_count, "bigint") == ["     5", "1234567"]


NUMBERS = ["1,5", "y", "Y", None, "", "abc", "-3", "1e3", "5d", "NaN", " 7 ", "1.2.3", ".5"]


def test_number_cell_has_three_states(spark):
    got = column(spark, NUMBERS, N.number_cell)
    assert [tuple(r) for r in got] == [
        (1.5, "ok"), (None, "missing"), (None, "missing"), (None, "unparsable"),
        (None, "unparsable"), (None, "unparsable"), (-3.0, "ok"), (1000.0, "ok"),
        (None, "unparsable"), (None, "unparsable"), (7.0, "ok"), (None, "unparsable"), (0.5, "ok"),
    ]


def test_number_cell_without_sentinel(spark):
    got = column(spark, ["y", "2"], lambda c: N.number_cell(c, sentinel=False))
    assert [tuple(r) for r in got] == [(None, "unparsable"), (2.0, "ok")]


def test_rule_value_missing_is_zero_unparsable_null(spark):
    got = column(spark, ["y", None, "x", "3"], lambda c: N.rule_value(N.number_cell(c)))
    assert got == [0.0, None, None, 3.0]


def test_over_zero_divisor_is_null(spark):
    got = column(spark, [0.0, 2.0, None], lambda c: N.over(F.lit(1.0), c), "double")
    assert got == [None, 0.5, None]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("45658", DAY(2025, 1, 1)), ("45658.7", DAY(2025, 1, 1)), ("0", DAY(1899, 12, 30)),
        ("99", DAY(1900, 4, 8)), ("100", None), ("18000", None), ("18001", DAY(1949, 4, 13)),
        ("-1", None), ("1/2/2025", DAY(2025, 1, 2)), ("01/02/2025, 10:11:12", DAY(2025, 1, 2)),
        ("2025-01-02", DAY(2025, 1, 2)), ("2025-01-02T21:00:00.000Z", DAY(2025, 1, 3)),
        ("2025-01-01T21:30:00.000Z", DAY(2025, 1, 2)), ("2025-01-01T19:59Z", DAY(2025, 1, 1)),
        ("2025-01-02 01:30:00+0400", DAY(2025, 1, 2)), ("2025-01-01T23:30:00-05:00", DAY(2025, 1, 2)),
        ("2025-01-02T23:30:00", DAY(2025, 1, 2)),
        ("13/13/2025", None), ("2025-13-01", None), ("junk", None), ("", None), (None, None),
        ("99999999999", None),
    ],
)
def test_cell_date(spark, text, expected):
    assert column(spark, [text], D.cell_date) == [expected]


def test_local_date_uses_the_reporting_zone(spark):
    df = spark.sql("select timestamp_seconds(1735765199) a, timestamp_seconds(1735761600) b")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        got = df.select(D.local_date(F.col("a")), D.local_date(F.col("b"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    # 20:59:59 UTC and 20:00 UTC on 1 January are after midnight four hours east.
    assert tuple(got) == (DAY(2025, 1, 2), DAY(2025, 1, 2))


def test_month_helpers(spark):
    df = spark.sql("select date '2024-02-10' d")
    got = df.select(D.month_end(F.col("d")), D.days_in_month(F.col("d"))).first()
    assert tuple(got) == (DAY(2024, 2, 29), 29)
