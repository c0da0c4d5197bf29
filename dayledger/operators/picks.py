"""One row per key, and row numbers, without gathering a hot key in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row of each key. Spark prunes each map task to one row per key
    before the shuffle (``WindowGroupLimit``), so copies of one key stay cheap."""
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def number_rows(
    df: DataFrame, key: str, unique: str, output: str, block: int = 65536
) -> DataFrame:
    """1, 2, 3... within ``key`` in the order of the unique integer column ``unique``.

    Rows are numbered inside blocks of ``unique`` values, so one task holds at
    most ``block`` rows of a key; block counts then give each block its offset.
    """
    blocked = df.withColumn("__block", F.floor(F.col(unique) / block))
    before = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy(key, "__block")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .select(key, "__block", "__offset")
    )
    inside = Window.partitionBy(key, "__block").orderBy(unique)
    return (
        blocked.withColumn("__inside", F.row_number().over(inside))
        .join(offsets, [key, "__block"])
        .withColumn(output, F.col("__inside") + F.col("__offset"))
        .drop("__block", "__inside", "__offset")
    )
