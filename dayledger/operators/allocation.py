"""Spread reported monthly totals over days and entities by their share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions.dates import month_end
from dayledger.functions.numbers import over


def monthly_target(
    monthly: DataFrame, calendar: DataFrame, value: str, by: str = "field_id"
) -> DataFrame:
    """(by, month_end, target): reported values with their calendar date. A second
    value for one (by, date) raises when the row is used."""
    dated = monthly.join(calendar, monthly["report_date_id"] == calendar["id"], "inner")
    once = dated.groupBy(by, F.col("report_date").alias("month_end")).agg(
        F.max(value).alias("target"), F.count(F.lit(1)).alias("__rows")
    )
    repeated = F.raise_error(F.lit("more than one monthly value for a key and date"))
    target = F.when(F.col("__rows") > 1, repeated.cast("double")).otherwise(F.col("target"))
    return once.select(by, "month_end", target.alias("target"))


def month_end_lookup(
    df: DataFrame, targets: DataFrame, date: str, by: str = "field_id"
) -> DataFrame:
    """Add ``target``: the value reported for the row's key at its month end."""
    keyed = df.withColumn("month_end", month_end(F.col(date)))
    return keyed.join(targets, [by, "month_end"], "left").drop("month_end")


def group_totals(df: DataFrame, weight: Column, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(weight).alias("total"))


def allocate(
    df: DataFrame,
    targets: DataFrame,
    weight: str,
    output: str,
    date: str = "report_date",
    by: str = "field_id",
    weights: DataFrame | None = None,
) -> DataFrame:
    """``output = target / days in month * weight / sum(weight over by and day)``;
    null when there is no target or the sum is zero.

    The sum is a map-side aggregate joined back, not a window, so a group with
    a third of all rows never meets in one task. ``weights`` holds the same
    weights in a frame that is cheaper to compute than ``df``; by default they
    are summed from ``df``. How the totals are joined is left to Spark.
    """
    source = df if weights is None else weights
    totals = group_totals(source, F.col(weight), [by, date]).where(F.col(by).isNotNull())
    daily = month_end_lookup(totals, targets, date, by)
    daily = daily.withColumn("target", F.col("target") / F.dayofmonth(month_end(F.col(date))))
    shared = df.join(daily, [by, date], "left")
    share = over(F.col("target") * F.col(weight), F.col("total"))
    return shared.withColumn(output, share).select(*df.columns, output)
