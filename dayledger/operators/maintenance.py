"""Table upkeep. Each function returns the new contents; the caller writes them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """(id, report_date) for every day of ``start..end``, ids from 1."""
    days = (end - start).days + 1
    first = F.lit(start.isoformat()).cast("date")
    ids = spark.range(1, days + 1).select(F.col("id").cast("int").alias("id"))
    return ids.select("id", F.date_add(first, F.col("id") - 1).alias("report_date"))


def day_number(day: Column, start: dt.date) -> Column:
    """Calendar id of a date by arithmetic; no join."""
    return F.datediff(day, F.lit(start.isoformat()).cast("date")) + 1


def shift_key(df: DataFrame, column: str, days: int) -> DataFrame:
    return df.withColumn(column, F.col(column) + F.lit(days))


def delete_created_on(df: DataFrame, day: dt.date, column: str = "created_at") -> DataFrame:
    """Rows not created on ``day``; rows without a creation date stay."""
    victim = F.to_date(F.col(column)).eqNullSafe(F.lit(day))
    return df.where(~victim)


def platform_ids(platforms: DataFrame, platform: int | None) -> DataFrame:
    """Ids of the platforms a delete refers to: all, or those with that number."""
    if platform is None:
        return platforms.select("id")
    numbered = F.col("name").try_cast("int") == F.lit(platform)
    return platforms.where(numbered).select("id")


def delete_report(
    fact: DataFrame,
    report_date_id: int | Column,
    platforms: DataFrame,
    wells: DataFrame | None = None,
    platform: int | None = None,
) -> DataFrame:
    """Rows of ``fact`` left after deleting one report day, on one platform or all.

    With ``wells`` the fact reaches its platform through ``well_id``, otherwise
    it holds ``platform_id``. Rows that reach no known platform stay, also when
    every platform is deleted.
    """
    chosen = platform_ids(platforms, platform)
    if wells is None:
        key, doomed = "platform_id", chosen.withColumnRenamed("id", "platform_id")
    else:
        on_platform = wells["platform_id"] == chosen["id"]
        doomed = wells.join(chosen, on_platform, "left_semi")
        key, doomed = "well_id", doomed.select(F.col("id").alias("well_id"))
    return _without(fact, report_date_id, doomed, key)


def delete_report_by_name(
    fact: DataFrame,
    report_date_id: int | Column,
    platforms: DataFrame,
    platform: int | None = None,
    column: str = "platform",
) -> DataFrame:
    """As :func:`delete_report` for a table that names its platform in text."""
    chosen = platforms
    if platform is not None:
        chosen = platforms.where(F.col("name").try_cast("int") == F.lit(platform))
    doomed = chosen.select(F.col("name").alias(column)).distinct()
    return _without(fact, report_date_id, doomed, column)


def _without(
    fact: DataFrame, report_date_id: int | Column, doomed: DataFrame, key: str
) -> DataFrame:
    day = F.lit(report_date_id) if isinstance(report_date_id, int) else report_date_id
    marked = doomed.select(F.col(key).alias("__key")).distinct()
    on_day = F.col("report_date_id") == day
    return fact.join(marked, on_day & (F.col(key) == F.col("__key")), "left_anti")


def delete_ids(df: DataFrame, ids: Sequence[int], column: str = "id") -> DataFrame:
    """Rows whose id is not listed; a null id stays."""
    return df.where(~F.coalesce(F.col(column).isin(*ids), F.lit(False)))


def recode(df: DataFrame, column: str, mapping: Mapping[int, int]) -> DataFrame:
    """Replace values by ``mapping``, read from the original value; others stay."""
    old, new = F.col(column), F.col(column)
    for source, value in mapping.items():
        new = F.when(old == source, F.lit(value)).otherwise(new)
    return df.withColumn(column, new.cast(df.schema[column].dataType))


def update_where(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows where ``condition`` is true."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns(
        {c: F.when(hit, v).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in values.items()}
    )


def update_from(df: DataFrame, updates: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Set ``column`` from the update table where it has the row's key (one row per key)."""
    new = updates.select(*keys, F.col(column).alias("__new"), F.lit(True).alias("__hit"))
    joined = df.join(new, list(keys), "left")
    value = F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(column))
    return joined.withColumn(column, value).select(*df.columns)


def evolve(
    df: DataFrame,
    drop: Sequence[str] = (),
    add: Mapping[str, str] | None = None,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """Drop columns and add new ones by type, null or with a default value."""
    defaults = defaults or {}
    new = {name: F.lit(defaults.get(name)).cast(t) for name, t in (add or {}).items()}
    return df.drop(*drop).withColumns(new) if new else df.drop(*drop)


def split_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The part of a table that moves to a table of its own."""
    return df.select(*columns)


def truncate(df: DataFrame) -> DataFrame:
    return df.where(F.lit(False))
