"""Dates as they come in cells: serial day numbers, local text, ISO text, timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.functions.numbers import number

# Day 0 of spreadsheet serials, the reporting zone, accepted serials.
SERIAL_DAY_ZERO = "1899-12-30"
REPORT_ZONE = "Asia/Baku"
LOW_SERIALS_BELOW = 100
HIGH_SERIALS_ABOVE = 18000

# The last serial a spreadsheet can hold, 9999-12-31.
_MAX_SERIAL = 2958465

_LOCAL = r"^\d{1,2}/\d{1,2}/\d{4}$"
_ISO = r"^ *\d{4}-\d{2}-\d{2}(?!\d)"
# A moment: date, time and zone.
_MOMENT = r"^ *(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}(?::\d{2})?)(?:\.\d+)? ?(?:Z|([+-])(\d{2}):?(\d{2})) *$"


def serial_date(serial: Column) -> Column:
    """Whole days after day 0; the time part is dropped."""
    day = F.when((serial >= 0) & (serial < _MAX_SERIAL + 1), F.floor(serial).cast("int"))
    return F.date_add(F.lit(SERIAL_DAY_ZERO).cast("date"), day)


def is_date_serial(serial: Column) -> Column:
    low = (serial >= 0) & (serial < LOW_SERIALS_BELOW)
    return low | (serial > HIGH_SERIALS_ABOVE)


def text_date(text: Column) -> Column:
    """``M/d/yyyy`` (a time after a comma is ignored) or ``yyyy-MM-dd...``; else null.
    A text with time and zone is a moment, and gives its day in the reporting zone.

    The shape is tested first: a failed date parse costs far more than a pattern.
    """
    before_comma = F.trim(F.split_part(text, F.lit(","), F.lit(1)))
    local = F.try_to_date(before_comma, "M/d/yyyy")
    iso = F.try_to_date(F.substring(F.trim(text), 1, 10), "yyyy-MM-dd")
    moment = local_date(_utc_moment(text))
    return (
        F.when(before_comma.rlike(_LOCAL), local)
        .when(text.rlike(_MOMENT), moment)
        .when(text.rlike(_ISO), iso)
    )


def _utc_moment(text: Column) -> Column:
    """Clock time in UTC of a text that is a moment."""

    def part(group: int) -> Column:
        return F.regexp_extract(text, _MOMENT, group)

    clock = F.concat_ws(" ", part(1), F.when(F.length(part(2)) == 5, F.concat(part(2), F.lit(":00"))).otherwise(part(2)))
    seconds = part(4).try_cast("int") * 3600 + part(5).try_cast("int") * 60
    ahead = F.when(part(3) == "+", seconds).when(part(3) == "-", -seconds).otherwise(0)
    return clock.try_cast("timestamp_ntz") - F.make_interval(secs=ahead)


def cell_date(text: Column) -> Column:
    """Date of a cell, or null when the cell holds no acceptable date."""
    serial = number(text)
    return F.when(
        serial.isNotNull(), F.when(is_date_serial(serial), serial_date(serial))
    ).otherwise(text_date(text))


def local_date(utc: Column, zone: str = REPORT_ZONE) -> Column:
    """Calendar day in the reporting zone of a clock time in UTC."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz")))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def month_end(day: Column) -> Column:
    return F.last_day(day)


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))
