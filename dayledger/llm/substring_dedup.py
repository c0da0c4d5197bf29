"""Removal of word windows that an earlier document holds, by anchors at the
positions of a difference cover.

Words are hashed at 3 of every 7 positions of a document, 7 words each. Whatever
the alignment, two occurrences of 13 common words share such an anchor inside them.
Blocks ask which anchors several documents hold; only the windows around those are
hashed in full and asked for again, for the smallest document that holds them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dayledger.llm import blocks as B
from dayledger.llm.common import WordHasher, partitions, window_hashes, word_spans

WINDOW = 13

CANDIDATES = {"key": "<u8", "check": "<u4", "least": "<i8"}
EARLIER = {"key": "<u8", "check": "<u4", "least": "<i8"}

_hasher = WordHasher(5)


def difference_cover(period: int) -> tuple[int, ...]:
    """A small set of residues whose differences are all residues of the period."""
    cover = [0]
    while len(_differences(cover, period)) < period:
        cover.append(max(range(period), key=lambda r: (len(_differences([*cover, r], period)), -r)))
    return tuple(sorted(cover))


def _differences(cover: list[int], period: int) -> set[int]:
    return {(a - b) % period for a in cover for b in cover}


class Words:
    """Word hashes of the texts of a block, and where each text's words begin."""

    def __init__(self, rows: pa.Table, window: int):
        self.window, self.period = window, (window + 1) // 2
        self.data, self.offsets = B.bodies(rows)
        self.starts, self.ends, self.doc = word_spans(self.data, self.offsets)
        self.hashes = _hasher(self.data, self.starts, self.ends)
        self.counts = np.bincount(self.doc, minlength=rows.num_rows)
        self.first = np.cumsum(self.counts) - self.counts
        self.at = np.arange(len(self.doc)) - self.first[self.doc]
        self.left = self.counts[self.doc] - self.at

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the anchors, and their hashes."""
        width = self.window - self.period + 1
        cover = np.zeros(self.period, bool)
        cover[list(difference_cover(self.period))] = True
        where = np.flatnonzero(
            cover[self.at % self.period] & (self.left >= width) & (self.counts[self.doc] >= self.window)
        )
        return where, window_hashes(self.hashes, width, 51)[where]

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of whole windows, their hashes and second hashes."""
        where = np.flatnonzero(self.left >= self.window)
        return where, *(window_hashes(self.hashes, self.window, seed)[where] for seed in (52, 53))


def _smallest(keys: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by key, check and id, and which of it is the first of its key."""
    order = np.lexsort((ids, checks, keys))
    first = np.ones(len(order), bool)
    k, c = keys[order], checks[order]
    first[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    return order, first


def substring_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: its id, ``n_words``, ``n_removed``, the removed
    ``spans`` (first word and the word past the last) and ``kept``, the other words
    joined by one space.

    A word goes if it lies in ``window`` consecutive words that also start in a
    document with a smaller id. Windows are judged on the input. Words are runs of
    bytes other than space and 0x09 to 0x0D, as they are; null texts have none, and
    texts shorter than a window stay. Rows that repeat an id are one document to
    each other: neither makes the other lose words. Rows without id neither lose
    words nor take them from others. An empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = partitions(spark)
    blocks = B.in_blocks(docs, id_column, text)

    def anchors(key, rows):
        words = Words(rows, window)
        where, hashes = words.anchors()
        return B.held_keys(key[0].as_py(), hashes, words.doc[where], buckets)

    def candidates(key, rows, replies):
        if not rows.num_rows:
            return B.pack(CANDIDATES, 0, [])
        words = Words(rows, window)
        where, hashes = words.anchors()
        hot = np.zeros(len(words.doc) + 1, np.int64)
        hot[where[B.is_shared(hashes, replies, buckets)] + 1] = 1
        hot = np.cumsum(hot)
        where, keys, checks = words.windows()
        ids = B.row_ids(rows)[words.doc[where]]
        near = (hot[where + words.period] > hot[where]) & (ids != B.NO_ID)
        keys, checks, ids = keys[near], checks[near].astype(np.uint32), ids[near]
        order, first = _smallest(keys, checks, ids)
        own = order[first]
        keys, checks, ids = keys[own], checks[own], ids[own]
        parts = [
            (b, {"key": keys[at], "check": checks[at], "least": ids[at]}) for b, at in B.by_bucket(keys, buckets)
        ]
        return B.pack(CANDIDATES, rows.column("block")[0].as_py(), parts)

    def smallest(key, rows):
        found, row = B.unpack(rows, CANDIDATES)
        order, first = _smallest(found["key"], found["check"], found["least"])
        group = np.cumsum(first) - 1
        least = found["least"][order][first][group]
        later = least < found["least"][order]
        order, least = order[later], least[later]
        block = rows.column("block").to_numpy()
        parts = []
        by_row = np.argsort(row[order], kind="stable")
        order, least = order[by_row], least[by_row]
        cuts = np.flatnonzero(np.diff(row[order])) + 1
        for at in np.split(np.arange(len(order)), cuts) if len(order) else []:
            own = order[at]
            part = {"key": found["key"][own], "check": found["check"][own], "least": least[at]}
            parts.append((int(block[row[own[0]]]), part))
        bucket = key[0].as_py()
        made = B.pack(EARLIER, 0, [(bucket, p) for _, p in parts])
        return made.set_column(0, "block", pa.array([b for b, _ in parts], pa.int32()))

    def remove(key, rows, replies):
        words = Words(rows, window)
        where, keys, checks = words.windows()
        checks = checks.astype(np.uint32)
        ids = B.row_ids(rows)
        own_ids = ids[words.doc[where]]
        # smallest holder inside the block, then among the answers
        order, first = _smallest(keys, checks, own_ids)
        least = np.empty(len(keys), np.int64)
        least[order] = own_ids[order][first][np.cumsum(first) - 1]
        told, _ = B.unpack(replies, EARLIER)
        if len(told["key"]) and len(keys):
            by_key = np.argsort(told["key"], kind="stable")
            at = np.minimum(np.searchsorted(told["key"][by_key], keys), len(by_key) - 1)
            at = by_key[at]
            same = (told["key"][at] == keys) & (told["check"][at] == checks)
            least[same] = np.minimum(least, told["least"][at])[same]
        gone = (least < own_ids) & (own_ids != B.NO_ID)
        marks = np.zeros(len(words.doc) + 1, np.int64)
        np.add.at(marks, where[gone], 1)
        np.add.at(marks, where[gone] + window, -1)
        covered = np.cumsum(marks[:-1]) > 0
        return _result(rows, words, covered)

    shared = B.answer(B.ask(blocks, anchors, B.HELD), B.shared_keys, B.SHARED)
    asked = B.ask(blocks, candidates, CANDIDATES, shared)
    found = B.conclude(blocks, B.answer(asked, smallest, EARLIER), remove, RESULT)
    return found.withColumnRenamed("row_id", id_column)


RESULT = "row_id bigint, n_words bigint, n_removed bigint, spans array<struct<first:bigint,past:bigint>>, kept string"
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))


def _result(rows: pa.Table, words: Words, covered: np.ndarray) -> pa.Table:
    raw = words.data.tobytes()
    removed = np.bincount(words.doc[covered], minlength=rows.num_rows)
    spans, kept = [], []
    for d in range(rows.num_rows):
        text = raw[words.offsets[d] : words.offsets[d + 1]]
        own = text.split()
        cut = []
        if removed[d]:
            mask = covered[words.first[d] : words.first[d] + words.counts[d]]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))).tolist()
            cut = [{"first": a, "past": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]
            own = [w for w, gone in zip(own, mask.tolist(), strict=True) if not gone]
        spans.append(cut)
        kept.append(b" ".join(own).decode())
    return pa.table(
        {
            "row_id": rows.column("row_id"),
            "n_words": pa.array(words.counts.astype(np.int64)),
            "n_removed": pa.array(removed.astype(np.int64)),
            "spans": pa.array(spans, _SPANS),
            "kept": pa.array(kept, pa.string()),
        }
    )
