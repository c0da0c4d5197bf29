"""Connected components of an edge table, by alternating star contractions.

Each round replaces links to neighbours by links to the smallest one, in the large
and then the small direction, until every component is a star. Rounds are grouped
minima with map-side combine and shuffle joins, written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import stage


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links (a > b) after one direction of contraction."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.withColumn("root", F.least("a", "least"))
    linked = both.where("b > a") if large else both
    moved = linked.join(least.select("a", "root"), "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("root").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for each node of ``edges`` (a, b: numbers) that is not the
    smallest of its component. Order and repeats of links do not matter; an empty
    table gives no rows."""
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stage(links, "links")
    before = _print(links)
    while True:
        links = stage(_stars(_stars(links, large=True), large=False), "links")
        now = _print(links)
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _print(links: DataFrame) -> tuple:
    """Count and checksums that tell whether a round changed anything."""
    h = F.xxhash64("a", "b")
    row = links.agg(
        F.count(F.lit(1)), F.bit_xor(h), F.coalesce(F.sum(F.pmod(h, F.lit(1 << 31))), F.lit(0))
    ).first()
    return tuple(row)
