"""Removal of lines that repeat an earlier line, but for one word.

Lines are compared as word sequences by edit distance in words. The deletion
neighbourhood of a line is the line and every variant without one of its words; all
go out as hashed keys. Two lines are one substitution apart if they share a variant
that lacks the word at the same place, and one insertion apart if the whole of one
is a variant of the other; keys that meet otherwise fail the check of the distance.
So of a key only the earliest line of each kind matters, and no pairs are made.

Blocks of documents first ask which lines have an earlier equal, then, for the lines
that are left, which of their keys another block or line holds at all, then for the
earliest holders of those.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from dayledger.llm import blocks as B
from dayledger.llm.common import WordHasher, boxed, mix, partitions, steps, unboxed, word_spans

#: Lines of fewer words only go if equal to an earlier one: a word in so few is
#: more than a tenth of the line.
MIN_WORDS = 10
WHOLE = -1
#: Bytes of text whose words are found and hashed at once.
STRETCH = 1 << 18

_hasher = WordHasher(7)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))

EQUAL = {"key": "<u8", "check": "<u4", "row_id": "<i8", "line": "<i4"}
VARIANTS = {"key": "<u8", "place": "<i4", "row_id": "<i8", "line": "<i4"}


class Lines:
    """The lines of a block that have words: document, number, and word hashes."""

    def __init__(self, rows: pa.Table):
        self.ids = B.row_ids(rows)
        data, offsets = B.bodies(rows)
        n, begin, doc, number, words = 0, [], [], [], []
        for part in steps(np.diff(offsets), STRETCH):
            low = offsets[part.start]
            own = data[low : offsets[part.stop]]
            bounds = offsets[part.start : part.stop + 1] - low
            starts, ends, of = word_spans(own, bounds)
            breaks = np.flatnonzero(own == 0x0A)
            line = np.searchsorted(breaks, starts) - np.searchsorted(breaks, bounds)[of]
            first = np.ones(len(starts), bool)
            first[1:] = (of[1:] != of[:-1]) | (line[1:] != line[:-1])
            at = np.flatnonzero(first)
            begin.append(at + n)
            doc.append(of[at] + part.start)
            number.append(line[at].astype(np.int32))
            words.append(_hasher(own, starts, ends))
            n += len(starts)
        none = np.zeros(0, np.int64)
        self.begin, self.doc = np.concatenate([none, *begin]), np.concatenate([none, *doc])
        self.number = np.concatenate([none.astype(np.int32), *number])
        self.words = np.concatenate([none.astype(np.uint64), *words])
        self.size = np.diff(np.append(self.begin, n))
        self.row_id = self.ids[self.doc]

    def whole(self, seed: int = 0) -> np.ndarray:
        """A key for each line: a polynomial over its word hashes."""
        sums = self._sums(seed)
        total = sums[self.begin + self.size] - sums[self.begin]
        return self._key(total * _power(_INVERSE, self.begin), self.size)

    def variants(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Line, place of the missing word and key of each variant of some lines."""
        size, begin = self.size[chosen], self.begin[chosen]
        line = np.repeat(chosen.astype(np.int32), size)
        place = np.arange(len(line), dtype=np.int32) - np.repeat((np.cumsum(size) - size).astype(np.int32), size)
        sums = self._sums(0)
        at = np.repeat(begin, size)
        at += place
        # the words before, and those after by one power less
        total = sums[at]
        at += 1
        total -= sums[at] * _INVERSE
        del at
        total += np.repeat(sums[begin + size] * _INVERSE - sums[begin], size)
        total *= np.repeat(_power(_INVERSE, begin), size)
        return line, place, self._key(total, np.repeat(size - 1, size))

    def _sums(self, seed: int) -> np.ndarray:
        words = mix(self.words + np.uint64(seed)) if seed else self.words
        powers = _power(np.uint64(_BASE), np.arange(len(words)))
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])

    @staticmethod
    def _key(total: np.ndarray, size: np.ndarray) -> np.ndarray:
        return mix(total + size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def _power(base: np.uint64, exponents: np.ndarray) -> np.ndarray:
    if not len(exponents):
        return np.zeros(0, np.uint64)
    table = np.full(int(exponents.max()) + 1, base, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)[exponents]


def _earliest(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of (key columns..., row id, line), and which begin a key.
    The last two columns are the row id and the line."""
    order = np.lexsort(columns[::-1])
    first = np.ones(len(order), bool)
    first[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns[:-2]], axis=0)
    return order, first


def _back(found: dict[str, np.ndarray], row: np.ndarray, rows: pa.Table, keep: np.ndarray, schema: dict) -> pa.Table:
    """Answer each asking row with the entries of ``found`` at ``keep``."""
    keep = keep[np.argsort(row[keep], kind="stable")]
    block, bucket = rows.column("block").to_numpy(), rows.column("bucket")[0].as_py()
    cuts = np.flatnonzero(np.diff(row[keep])) + 1
    parts = [own for own in np.split(keep, cuts) if len(own)]
    made = B.pack(schema, 0, [(bucket, {n: found[n][own] for n in schema}) for own in parts])
    return made.set_column(0, "block", pa.array([int(block[row[own[0]]]) for own in parts], pa.int32()))


def _later(a_id, a_line, b_id, b_line) -> np.ndarray:
    """Whether place a comes after place b, by row id, then line."""
    return (a_id > b_id) | ((a_id == b_id) & (a_line > b_line))


def first_of_equal(lines: Lines, answers: pa.Table) -> np.ndarray:
    """Which lines of a block are the first of their kind anywhere. ``answers``
    hold the block's lines that have an earlier equal elsewhere."""
    key, check = lines.whole(), lines.whole(1).astype(np.uint32)
    order, first = _earliest(key, check, lines.row_id, lines.number)
    group = np.cumsum(first) - 1
    is_first = np.ones(len(key), bool)
    lead = order[first][group]
    is_first[order] = ~_later(lines.row_id[order], lines.number[order], lines.row_id[lead], lines.number[lead])
    told, _ = B.unpack(answers, EQUAL)
    by_key = np.argsort(told["key"], kind="stable")
    ranked = told["key"][by_key]
    if len(ranked):
        at = by_key[np.minimum(np.searchsorted(ranked, key), len(ranked) - 1)]
        is_first &= ~((told["key"][at] == key) & (told["check"][at] == check))
    return is_first


def _told(answers: pa.Table, kind: str) -> pa.Table:
    return answers.filter(pc.equal(answers.column("kind"), kind))


def _near_code(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    return mix(key + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _nearest(key, place, row_id, line) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each entry the earliest one whose line is one edit from its own, among
    entries of the same key: for a whole line any variant, for a variant the whole
    line and the variants without the word at the same place. Entries without any
    other are left out; a variant may find itself."""
    order = np.lexsort((line, row_id, place, key))
    k, p = key[order], place[order]
    n = len(order)
    new_key = np.ones(n, bool)
    new_key[1:] = k[1:] != k[:-1]
    new_place = new_key.copy()
    new_place[1:] |= p[1:] != p[:-1]
    lead = order[new_place][np.cumsum(new_place) - 1]  # earliest of its key and place
    whole = p == WHOLE
    key_at = np.flatnonzero(new_key)[np.cumsum(new_key) - 1]
    best = lead.copy()
    # variants: the whole line of the key comes first in it, if there is one
    first = order[key_at]
    has_whole = place[first] == WHOLE
    use = ~whole & has_whole & _later(row_id[best], line[best], row_id[first], line[first])
    best[use] = first[use]
    # whole lines: the earliest variant of the key
    by_place = np.lexsort((line, row_id, place == WHOLE, key))
    k2 = key[by_place]
    starts = np.ones(n, bool)
    starts[1:] = k2[1:] != k2[:-1]
    earliest = by_place[starts][np.cumsum(new_key) - 1]
    best[whole] = earliest[whole]
    found = ~whole | (place[earliest] != WHOLE)
    return order[found], row_id[best[found]], line[best[found]]


def mark_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``text`` without the lines that go, ``rest`` (a struct of the other columns),
    ``n_lines`` and ``dropped``, the sorted numbers from 0 of those lines, for every
    row of ``docs``.

    Lines end at a line feed; a line's place is the id of its row, then its number.
    A line with words goes if a line at an earlier place has the same words, or, if
    either has ``min_words`` words or more, words one insertion, deletion or
    substitution apart. Lines are judged on the input, not on what is left: of near
    lines the earliest stays, and a chain of them may shrink to its first. Lines
    without words stay. Null ids come last; rows that repeat an id, or have none,
    share their places, and lines at the same place do not remove each other. Null
    texts have no lines and come back empty; an empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = partitions(spark)
    rows = boxed(docs, text)
    blocks = B.in_blocks(rows, f"rest.`{id_column}`", "text", "rest")

    def ask_equal(key, rows):
        lines = Lines(rows)
        keys, check = lines.whole(), lines.whole(1).astype(np.uint32)
        order, first = _earliest(keys, check, lines.row_id, lines.number)
        own = order[first]
        found = {"key": keys[own], "check": check[own], "row_id": lines.row_id[own], "line": lines.number[own]}
        parts = [(b, {n: c[at] for n, c in found.items()}) for b, at in B.by_bucket(found["key"], buckets)]
        return B.pack(EQUAL, key[0].as_py(), parts)

    def find_equal(key, rows):
        found, row = B.unpack(rows, EQUAL)
        order, first = _earliest(found["key"], found["check"], found["row_id"], found["line"])
        lead = order[first][np.cumsum(first) - 1]
        later = _later(found["row_id"][order], found["line"][order], found["row_id"][lead], found["line"][lead])
        return _back(found, row, rows, order[later], EQUAL)

    def keys_of(rows, answers):
        """The lines of a block, which are first of their kind, and the keys of
        those: line, place of the missing word, key."""
        lines = Lines(rows)
        first = first_of_equal(lines, _told(answers, "equal"))
        left = np.flatnonzero(first)
        line, place, key = lines.variants(left[lines.size[left] >= min_words])
        near = left[lines.size[left] >= min_words - 1]
        line = np.concatenate([near, line])
        place = np.concatenate([np.full(len(near), WHOLE, np.int32), place])
        return lines, first, line, place, np.concatenate([lines.whole()[near], key])

    def ask_held(key, rows, answers):
        _, _, line, _, keys = keys_of(rows, answers)
        return B.held_keys(key[0].as_py(), keys, line, buckets)

    def ask_near(key, rows, answers):
        lines, _, line, place, keys = keys_of(rows, answers)
        shared = B.is_shared(keys, _told(answers, "shared"), buckets)
        line, place, keys = line[shared], place[shared], keys[shared]
        row_id, number = lines.row_id[line], lines.number[line]
        order, first = _earliest(keys, place, row_id, number)
        own = order[first]
        found = {"key": keys[own], "place": place[own], "row_id": row_id[own], "line": number[own]}
        parts = [(b, {n: c[at] for n, c in found.items()}) for b, at in B.by_bucket(found["key"], buckets)]
        return B.pack(VARIANTS, key[0].as_py(), parts)

    def find_near(key, rows):
        found, row = B.unpack(rows, VARIANTS)
        at, row_id, line = _nearest(found["key"], found["place"], found["row_id"], found["line"])
        told = {n: c.copy() for n, c in found.items()}
        told["row_id"][at], told["line"][at] = row_id, line
        return _back(told, row, rows, at, VARIANTS)

    def mark(key, rows, answers):
        lines, first, line, place, keys = keys_of(rows, answers)
        dropped = ~first
        told, _ = B.unpack(_told(answers, "near"), VARIANTS)
        if len(told["key"]) and len(keys):
            codes = _near_code(told["key"], told["place"])
            order = np.argsort(codes, kind="stable")
            own = _near_code(keys, place)
            at = order[np.minimum(np.searchsorted(codes[order], own), len(order) - 1)]
            hit = codes[at] == own
            line, at = line[hit], at[hit]
            gone = _later(lines.row_id[line], lines.number[line], told["row_id"][at], told["line"][at])
            dropped[line[gone]] = True
        numbers: list[list[int]] = [[] for _ in range(rows.num_rows)]
        for d, n in zip(lines.doc[dropped].tolist(), lines.number[dropped].tolist(), strict=True):
            numbers[d].append(n)
        kept, sizes = [], []
        for body, gone in zip(rows.column("body").to_pylist(), numbers, strict=True):
            own = body.split(b"\n")
            sizes.append(len(own) if body else 0)
            if gone:
                out = set(gone)
                body = b"\n".join(x for i, x in enumerate(own) if i not in out)
            kept.append(body.decode())
        return pa.table(
            {
                "text": pa.array(kept, pa.string()),
                "rest": rows.column("rest"),
                "n_lines": pa.array(sizes, pa.int64()),
                "dropped": pa.array(numbers, pa.list_(pa.int32())),
            }
        )

    equal = B.answer(B.ask(blocks, ask_equal, EQUAL), find_equal, EQUAL).withColumn("kind", F.lit("equal"))
    held = B.answer(B.ask(blocks, ask_held, B.HELD, equal), B.shared_keys, B.SHARED)
    told = equal.unionByName(held.withColumn("kind", F.lit("shared")), allowMissingColumns=True)
    near = B.answer(B.ask(blocks, ask_near, VARIANTS, told), find_near, VARIANTS)
    told = equal.unionByName(near.withColumn("kind", F.lit("near")), allowMissingColumns=True)
    made = (
        StructType()
        .add("text", "string")
        .add("rest", rows.schema["rest"].dataType)
        .add("n_lines", "long")
        .add("dropped", ArrayType(IntegerType()))
    )
    return B.conclude(blocks, told, mark, made)


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with its texts less the lines that ``mark_lines`` drops. Where there
    is an ``n_chars`` column, it follows a shortened text."""
    return unboxed(mark_lines(docs, id_column, text, min_words), docs, text, F.size("dropped") > 0)
