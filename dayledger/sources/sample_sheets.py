"""Whole report sheets derived from the sample events: one sheet per platform and day.

Each sheet has a header, flowmeter block, a body row per well and a footer, with
deliberate faults in every check's reach.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.operators.picks import number_rows
from dayledger.sources import schemas as S
from dayledger.sources.samples import Samples, shaped

# Region names of the sample tables by id, used as category names.
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _text(column: Column) -> Column:
    return column.cast("string")


def _comma(column: Column) -> Column:
    return F.replace(_text(column), F.lit("."), F.lit(","))


class SampleSheets:
    """``rows`` is the sheet table; ``tables`` the dimensions it is loaded against."""

    def __init__(self, samples: Samples):
        self.samples = samples

    @cached_property
    def platforms(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.samples.table("nation").select(
            key.alias("id"),
            _text(key).alias("name"),
            F.when(key % 3 != 0, _text(F.col("n_regionkey"))).alias("square"),
            F.when(key < 15, F.lit(1)).otherwise(F.col("n_regionkey") + 1).alias("field_id"),
        )

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        dims = {n: shaped(df, S.DIMENSIONS[n]) for n, df in self.samples.mart_dimensions.items()}
        return dims | {"platforms": self.platforms}

    @cached_property
    def well_days(self) -> DataFrame:
        events = self.samples.events.groupBy(F.col("user_id").alias("well_id"), "d")
        days = events.agg(
            F.max("k").alias("m"),
            F.min("k").alias("s"),
            F.min("value").alias("v"),
            F.count(F.lit(1)).alias("n"),
        )
        wells = self.samples.wells.select(
            F.col("id").alias("well_id"), F.col("name").alias("well"), "platform_id"
        )
        places = self.platforms.select(F.col("id").alias("platform_id"), "square", "field_id")
        names = self.samples.fields.select(F.col("id").alias("field_id"), F.col("name").alias("field"))
        placed = days.join(wells, "well_id").join(places, "platform_id").join(names, "field_id")
        return placed.withColumn("file", F.concat_ws("_", _text(F.col("platform_id")), _text(F.col("d"))))

    @cached_property
    def files(self) -> DataFrame:
        """Sheets with the row of their terminator: body rows are numbered by well."""
        grouped = self.well_days.groupBy("file", "platform_id", "d", "field")
        return grouped.agg((14 + F.count(F.lit(1))).cast("int").alias("end_row"))

    @cached_property
    def rows(self) -> DataFrame:
        return self._body().unionByName(self._frame())

    def _cells(self, row: Column, cells: dict[int, Column]) -> list[Column]:
        return [
            row.cast("int").alias("row_idx"),
            *[
                cells.get(i, F.lit(None)).cast("string").alias(S.cell(i))
                for i in range(S.SHEET_COLUMNS)
            ],
        ]

    def _body(self) -> DataFrame:
        numbered = number_rows(self.well_days, "file", "well_id", "place")

        p, m, s, n, v = (F.col(c) for c in ("platform_id", "m", "s", "n", "v"))

        def region(index: Column) -> Column:
            return F.element_at(F.array(*[F.lit(name) for name in REGIONS]), index)

        own = {i: F.concat(_text(m + i), F.lit(",5")) for i in (*range(30, 36), *range(37, 58))}
        own[45] = F.when(m % 2 == 0, "true").otherwise("false")
        marks = {i: F.when(m % 3 == 0, "y").otherwise(value) for i, value in own.items()}
        test_date = F.date_format(F.date_sub("d", m % 20), "M/d/yyyy")
        serial = F.datediff(F.date_sub("d", s % 20), F.lit("1899-12-30").cast("date"))
        cells = marks | {
            2: _text(p),
            3: F.col("square"),
            4: F.when(m == 50, "no such well").otherwise(F.concat(F.lit(" "), F.col("well"), F.lit(" "))),
            5: F.concat(F.lit(" "), region(1 + m % 2)),
            6: region(1 + m % 3),
            7: F.when(m % 5 != 0, region(1 + m % 4)),
            8: F.concat(F.lit("Brand#"), _text(1 + m % 25)),
            9: _text(s % 3),
            18: F.when(n % 3 != 0, "F1"),
            19: F.when(m % 23 == 0, "not a date").otherwise(test_date),
            20: _comma(v * 3),
            21: _comma(v * 2),
            22: F.when(s % 13 == 0, "abc").otherwise(_comma(v)),
            23: F.concat(_text(serial), F.lit(".5")),
            24: _comma(v * 10),
            25: _comma(v * (m % 12)),
            26: _text(F.date_sub("d", s % 9)),
            27: F.when(m == 98, "101").otherwise(_text(m)),
            28: _text(s % 7),
            29: _comma(v),
            36: F.when(m % 10 == 0, "y").otherwise(_comma(n * F.lit(1.5))),
            58: F.when(m % 17 == 0, "Y").otherwise(_text(m % 26)),
            59: _text(m % 5),
            62: F.concat(region(1 + s % 5), F.lit(" x")),
            63: F.when(m % 7 != 0, F.concat(F.lit("c"), _text(s % 3))),
        }
        return numbered.select("file", *self._cells(13 + F.col("place"), cells))

    def _frame(self) -> DataFrame:
        """The rows around the body, all from one row for each file."""
        rows = [F.struct(*self._cells(at, cells)) for at, cells in (*self._header(), *self._footer())]
        return self.files.select("file", F.inline(F.array(*rows)))

    def _header(self) -> list[tuple[Column, dict[int, Column]]]:
        p, day = F.col("platform_id"), F.dayofmonth("d")
        both = p + day
        field = F.when(both % 19 == 0, "nowhere").otherwise(F.col("field"))
        date = F.when(both % 23 == 0, "500").otherwise(F.date_format("d", "M/d/yyyy"))
        ogpd = F.when(p % 4 != 0, "28 May").otherwise("other")
        closing = day * 10 + p
        opening = F.when(day % 4 == 0, closing - 9).otherwise(closing - 10)
        closing2 = F.when(p == 7, F.lit(5)).otherwise(closing * 2)
        opening2 = F.when(p == 7, F.lit(5)).otherwise((closing - 10) * 2)
        return [
            (F.lit(2), {5: ogpd}),
            (F.lit(3), {5: field, 18: F.lit("person"), 61: opening, 63: opening2}),
            (
                F.lit(4),
                {
                    5: F.concat(_text(p), F.lit(".0")),
                    18: F.lit("phone"),
                    61: closing,
                    63: F.when(day % 11 != 0, closing2),
                },
            ),
            (F.lit(6), {5: date, 61: F.lit("20000")}),
        ]

    def _footer(self) -> list[tuple[Column, dict[int, Column]]]:
        end = F.col("end_row")
        p, day = F.col("platform_id"), F.dayofmonth("d")
        comment = F.when(day % 6 != 0, F.concat(F.lit("note "), _text(F.floor(day / 5))))
        broken = F.when((p + day) % 29 == 0, "wrong")
        return [
            (end, {}),
            (end + 7, {26: comment}),
            (end + 9, {6: broken}),
        ]
