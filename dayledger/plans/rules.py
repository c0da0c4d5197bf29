"""The checks of report files and body rows, in the order they are reported."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.functions.dates import days_between
from dayledger.functions.numbers import UNPARSABLE, rule_value
from dayledger.functions.text import truthy
from dayledger.operators.quality import INFO, WARNING, Constraint, Rule
from dayledger.sources.reports import number_columns
from dayledger.sources.schemas import FACTS, REPORTED_KEYS

# Limits of the checks.
METERED_FIELD = 1
METERED_PLATFORMS = (2, 3, 4, 7, 8, 13)
CONTINUOUS_PLATFORMS = (8, 13)
STALE_PLATFORMS = (2, 3, 4, 7)
PRODUCING_CATEGORIES = (1, 2)
PRODUCING_SUB_CATEGORY = 1
HOURS_PER_DAY = 24
MAX_LIQUID_TON = 500
MAX_RESULT_AGE_DAYS = 15


def file_rules() -> list[Rule]:
    """The first broken one rejects the whole file."""
    return [
        Rule("FIELD_UNKNOWN", ~F.col("is_lts") & F.col("field_id").isNull(), "unknown field name"),
        Rule(
            "PLATFORM_UNKNOWN",
            F.col("platform_by_file") & F.col("platform_id").isNull(),
            "unknown platform for the field",
        ),
        Rule("REPORT_DATE_INVALID", F.col("report_date").isNull(), "unreadable report date"),
        Rule("NO_CALENDAR_DATE", F.col("report_date_id").isNull(), "date is not in the calendar"),
        Rule("FOOTER_ERROR", F.col("has_error"), "the sheet reports an error"),
    ]


def uptime_out_of_range(uptime: Column) -> Column:
    return (uptime < 0) | (uptime > HOURS_PER_DAY)


def downtime_unexplained(uptime: Column, category: Column, activity: Column, comment: Column) -> Column:
    unexplained = ~truthy(category) | activity.isNull() | ~truthy(comment)
    return (uptime < HOURS_PER_DAY) & unexplained


def liquid_too_high(category_id: Column, liquid: Column) -> Column:
    return category_id.isin(*PRODUCING_CATEGORIES) & (liquid > MAX_LIQUID_TON)


def outside_percent(value: Column) -> Column:
    return (value < 0) | (value > 100)


def flowmeter_missing(field_id: Column, category_id: Column, sub_id: Column, meter: Column) -> Column:
    return (
        (field_id == METERED_FIELD)
        & category_id.isin(*PRODUCING_CATEGORIES)
        & (sub_id == PRODUCING_SUB_CATEGORY)
        & ~truthy(meter)
    )


def results_too_old(sub_id: Column, report_date: Column, *result_dates: Column) -> Column:
    old = F.lit(False)
    for result_date in result_dates:
        age = days_between(report_date, result_date)
        old = old | F.coalesce(age > MAX_RESULT_AGE_DAYS, F.lit(False))
    return (sub_id == PRODUCING_SUB_CATEGORY) & old


def record_rules() -> list[Rule]:
    """All broken ones are reported, except that an unknown well stops at once."""
    category, sub = F.col("well_stock_category_id"), F.col("production_well_stock_sub_category_id")
    uptime = rule_value(F.col("well_uptime_hours"))
    dates = ["last_well_test_date", "last_gas_well_test_date", "last_lab_date"]
    bad_date = F.lit(False)
    for date in dates:
        bad_date = bad_date | F.col(date).isNull()
    cut, dirt = rule_value(F.col("water_cut")), rule_value(F.col("mechanical_impurities"))
    cut_bad = F.coalesce(outside_percent(cut), F.lit(False))
    dirt_bad = F.coalesce(outside_percent(dirt), F.lit(False))
    unreadable = F.lit(False)
    for name in number_columns():
        unreadable = unreadable | (F.col(name)["status"] == UNPARSABLE)
    return [
        Rule("WELL_UNKNOWN", F.col("well_id").isNull(), "unknown well on the platform", stops=True),
        Rule("RESULT_DATE_INVALID", bad_date, "unreadable test or laboratory date"),
        Rule(
            "FLOWMETER_MISSING",
            flowmeter_missing(F.col("field_id"), category, sub, F.col("flowmeter")),
            "flowing well without a flowmeter",
        ),
        Rule("UPTIME_RANGE", uptime_out_of_range(uptime), "uptime outside 0 to 24 hours"),
        Rule(
            "DOWNTIME_UNEXPLAINED",
            downtime_unexplained(
                uptime,
                F.col("downtime_category"),
                F.col("production_sub_skins_activity_id"),
                F.col("comments"),
            ),
            "uptime under 24 hours without category, activity and comment",
        ),
        Rule(
            "LIQUID_RANGE",
            liquid_too_high(category, rule_value(F.col("liquid_ton"))),
            "liquid above 500 tons",
        ),
        Rule(
            "GAS_BELOW_GASLIFT",
            rule_value(F.col("total_gas")) < rule_value(F.col("gaslift_gas")),
            "total gas below gas lift gas",
        ),
        Rule("PERCENT_RANGE", cut_bad | dirt_bad, "water cut or impurities outside 0 to 100"),
        Rule("UNPARSABLE_NUMBER", unreadable, "a number could not be read", INFO, qc=False),
    ]


def age_rule() -> Rule:
    """Reported for kept rows only."""
    old = results_too_old(
        F.col("production_well_stock_sub_category_id"),
        F.col("report_date"),
        F.col("last_well_test_date"),
        F.col("last_lab_date"),
    )
    return Rule("RESULTS_TOO_OLD", old, "test or laboratory result over 15 days old", WARNING, False)


# Which dimension each reference of a fact is to.
REFERENCES = {
    "well_id": "wells",
    "platform_id": "platforms",
    "field_id": "fields",
    "ogpd_id": "ogpd",
    "report_date_id": "report_dates",
    "well_stock_category_id": "well_stock_categories",
    "production_well_stock_sub_category_id": "production_well_stock_sub_categories",
    "production_method_id": "production_methods",
    "horizon_id": "horizons",
    "production_sub_skins_activity_id": "production_sub_skins_activities",
}


def declared_constraints(
    tables: Mapping[str, Sequence[str]], dimensions: Sequence[str]
) -> dict[str, list[Constraint]]:
    """What the facts declare, of the tables given with their columns: references to
    these dimensions, their key unique, and no null in it."""
    found = {}
    for name, columns in tables.items():
        key = FACTS[name].key if name in FACTS else REPORTED_KEYS[name]
        found[name] = [Constraint("not_null", tuple(key)), Constraint("unique", tuple(key))] + [
            Constraint("refers", (c,), REFERENCES[c]) for c in columns if REFERENCES.get(c) in dimensions
        ]
    return found
