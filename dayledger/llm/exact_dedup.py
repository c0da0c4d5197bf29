"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Each pass reads only what it needs: the first only lengths and short prefixes, the
last the whole text of rows whose (length, prefix) occurs more than once. Built-in
functions only. Texts never gather in one task: groups meet as counts and maxima,
and the joins back are plain shuffle joins that adaptive execution splits where one
text holds many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import ascii_lower, text_of

PREFIX_CHARS = 64
SKETCH = ("text_bytes", "prefix_hash")


def full_hash(text: Column) -> Column:
    return F.sha2(ascii_lower(text).cast("binary"), 256)


def sketches(docs: DataFrame, *more: Column, text: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Length and prefix hash of each normalised text, besides other columns."""
    whole = text_of(text)
    return docs.select(
        *more,
        F.octet_length(whole).alias("text_bytes"),
        F.xxhash64(ascii_lower(F.substring(whole, 1, prefix_chars))).alias("prefix_hash"),
    )


def exact_dedup(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """One row per input row: its id, ``keep_id``, ``group_size``, ``kept``, the two
    sketch columns, and ``text_sha256`` where the whole text had to be read.

    Texts are equal when identical after lower-casing A to Z; null counts as empty.
    Of equal texts the row with the largest id stays. A row whose (length, prefix)
    is unique is kept without its full hash (null). Null ids rank lowest; of rows
    that repeat id and text one is kept. An empty table gives no rows. Other columns
    of ``docs``, whatever their names, are not read.
    """
    rows = docs.select(F.col(id_column).alias("row_id"), F.col(text).cast("string").alias("row_text"))
    sketch = sketches(rows, F.col("row_id"), text="row_text", prefix_chars=prefix_chars)

    lengths = sketch.groupBy("text_bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("text_bytes")
    suspects = (
        sketch.join(lengths, "text_bytes", "left_semi")
        .groupBy(*SKETCH)
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(*SKETCH)
    )
    unique = sketch.join(suspects, list(SKETCH), "left_anti")

    read = sketches(rows, F.col("row_id"), F.col("row_text"), text="row_text", prefix_chars=prefix_chars)
    hashed = (
        read.join(suspects, list(SKETCH), "left_semi")
        .select("row_id", *SKETCH, full_hash(text_of("row_text")).alias("text_sha256"))
        .groupBy("row_id", "text_sha256", *SKETCH)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    groups = hashed.groupBy("text_sha256", "text_bytes").agg(
        F.max("row_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    found = (
        hashed.join(groups, ["text_sha256", "text_bytes"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .withColumn("kept", F.col("row_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
    )
    columns = ("keep_id", "group_size", "kept", *SKETCH, "text_sha256")
    return (
        unique.withColumns(
            {
                "keep_id": F.col("row_id"),
                "group_size": F.lit(1).cast("long"),
                "kept": F.lit(True),
                "text_sha256": F.lit(None).cast("string"),
            }
        )
        .select(F.col("row_id").alias(id_column), *columns)
        .unionByName(found.select(F.col("row_id").alias(id_column), *columns))
    )
