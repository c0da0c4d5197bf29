"""Questions that blocks of documents ask each other.

Documents are dealt into blocks of some MB. A block reduces what it holds to unique
64-bit keys, packed by bucket of the key; a bucket sees every block's keys, answers
each block, and the answers meet the documents of the block again. A key that a
third of all documents hold is one entry for each block, so no group grows with it,
and the texts are shuffled once, however many questions follow.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import joined, partitions, text_of, tidy_group

BLOCKS_PER_PARTITION = 4
NO_ID = np.iinfo(np.int64).max


def in_blocks(docs: DataFrame, id_column: str = "doc_id", text: str = "text", *more: str) -> DataFrame:
    """``block``, ``row_id``, ``body`` (the text in bytes) and other columns, dealt
    by block. Rows that repeat an id and a text are in one block."""
    spark = docs.sparkSession
    deal = partitions(spark)
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("row_id"), text_of(text).cast("binary").alias("body"), *more
    )
    block = F.pmod(F.xxhash64("row_id", "body"), F.lit(deal * BLOCKS_PER_PARTITION)).cast("int")
    return rows.withColumn("block", block).repartition(deal, "block")


def row_ids(rows: pa.Table) -> np.ndarray:
    """Ids as numbers; null ids follow all others."""
    return rows.column("row_id").combine_chunks().fill_null(int(NO_ID)).to_numpy()


def bodies(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts of a block, and where each begins and ends."""
    return joined(rows.column("body").combine_chunks())


def by_bucket(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each bucket that has keys: their positions, in the order of the keys."""
    bucket = (keys >> np.uint64(32)) % np.uint64(buckets)
    order = np.lexsort((keys, bucket))
    ends = np.flatnonzero(np.diff(bucket[order])) + 1 if len(keys) else []
    for own in np.split(order, ends) if len(keys) else []:
        yield int(bucket[own[0]]), own


#: A row holds columns of numbers as bytes, aligned with each other.
def packed(schema: dict[str, str]) -> str:
    return ", ".join(["block int", "bucket int", *(f"{name} binary" for name in schema)])


def pack(schema: dict[str, str], block: int, parts: list[tuple[int, dict[str, np.ndarray]]]) -> pa.Table:
    columns = {
        "block": pa.array(np.full(len(parts), block, np.int32)),
        "bucket": pa.array([b for b, _ in parts], pa.int32()),
    }
    for name, kind in schema.items():
        columns[name] = pa.array([np.ascontiguousarray(p[name], kind).tobytes() for _, p in parts], pa.binary())
    return pa.table(columns)


def unpack(rows: pa.Table, schema: dict[str, str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """All numbers of some rows, column by column, and the row each comes from."""
    columns, sizes = {}, np.zeros(rows.num_rows, np.int64)
    for name, kind in schema.items():
        parts = [np.frombuffer(x, kind) if x else np.zeros(0, kind) for x in rows.column(name).to_pylist()]
        sizes = np.array([len(p) for p in parts], np.int64)
        columns[name] = np.concatenate(parts) if parts else np.zeros(0, kind)
    return columns, np.repeat(np.arange(rows.num_rows), sizes)


def ask(blocks: DataFrame, emit: Callable, schema: dict[str, str], *answers: DataFrame) -> DataFrame:
    """Packed rows that ``emit(rows[, answer rows])`` makes from each block."""
    if answers:
        heard = answers[0].repartition(partitions(blocks.sparkSession), "block")
        return blocks.groupBy("block").cogroup(heard.groupBy("block")).applyInArrow(tidy_group(emit), packed(schema))
    return blocks.groupBy("block").applyInArrow(tidy_group(emit), packed(schema))


def answer(asked: DataFrame, reduce: Callable, schema: dict[str, str]) -> DataFrame:
    """Packed rows that ``reduce(rows of one bucket)`` sends back to the blocks."""
    return asked.repartition(partitions(asked.sparkSession), "bucket").groupBy("bucket").applyInArrow(
        tidy_group(reduce), packed(schema)
    )


def conclude(blocks: DataFrame, heard: DataFrame, conclude: Callable, schema: str) -> DataFrame:
    """What ``conclude(rows, answer rows)`` makes of each block that has rows."""
    replies = heard.repartition(partitions(blocks.sparkSession), "block")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(tidy_group(conclude), schema)


# --- which keys do several sources hold? --------------------------------------

#: Low halves of keys, and a bit each: held by several sources in the block already.
HELD = {"low": "<u4", "several": "u1"}
SHARED = {"low": "<u4"}


def held_keys(block: int, keys: np.ndarray, sources: np.ndarray, buckets: int) -> pa.Table:
    """The question which of these keys several sources hold. 32 bits in a bucket
    tell keys apart but for chance: an answer may name too many keys, never too few."""
    code = ((keys >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
    order = np.lexsort((sources, code))
    code, sources = code[order], sources[order]
    first = np.ones(len(code), bool)
    first[1:] = code[1:] != code[:-1]
    starts = np.flatnonzero(first)
    changes = np.zeros(len(code), bool)
    changes[1:] = ~first[1:] & (sources[1:] != sources[:-1])
    several = np.add.reduceat(changes, starts) > 0 if len(starts) else np.zeros(0, bool)
    code = code[starts]
    bucket = (code >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    parts = [
        (int(bucket[own[0]]), {"low": code[own], "several": np.packbits(several[own])})
        for own in np.split(np.arange(len(code)), cuts)
        if len(own)
    ]
    return pack(HELD, block, parts)


def shared_keys(rows: pa.Table) -> pa.Table:
    """Of each block's keys in a bucket, those that several sources hold."""
    lows = [np.frombuffer(x, "<u4") for x in rows.column("low").to_pylist()]
    flags = [
        np.unpackbits(np.frombuffer(x, np.uint8), count=len(own)).astype(bool)
        for x, own in zip(rows.column("several").to_pylist(), lows, strict=True)
    ]
    every = np.concatenate(lows)
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    shared = np.zeros(len(every), bool)
    same = ranked[1:] == ranked[:-1]
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    shared |= np.concatenate(flags)
    # a key that one block flags is shared for that block alone: no other holds it
    bucket = rows.column("bucket")[0].as_py()
    replies, at = [], 0
    for block, own in zip(rows.column("block").to_pylist(), lows, strict=True):
        found = own[shared[at : at + len(own)]]
        at += len(own)
        if len(found):
            replies.append((block, found))
    return pa.table(
        {
            "block": pa.array([b for b, _ in replies], pa.int32()),
            "bucket": pa.array(np.full(len(replies), bucket, np.int32)),
            "low": pa.array([f.tobytes() for _, f in replies], pa.binary()),
        }
    )


def is_shared(keys: np.ndarray, replies: pa.Table, buckets: int) -> np.ndarray:
    """Which keys of a block the answers name."""
    lows, row = unpack(replies, SHARED)
    bucket = replies.column("bucket").to_numpy().astype(np.uint64)[row]
    named = np.sort((bucket << np.uint64(32)) | lows["low"].astype(np.uint64))
    code = ((keys >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (keys & np.uint64(0xFFFFFFFF))
    return member(code, named)


def member(values: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    if not len(ranked):
        return np.zeros(len(values), bool)
    return ranked[np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)] == values
