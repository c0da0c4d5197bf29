"""Benchmark decontamination by a generalised suffix automaton of test items.

The automaton accepts every run of consecutive words of any item. Documents stream
through it, which keeps the longest run that ends at each word; where it reaches
the window length, the last words are a window of an item. Items are few and known:
their size is checked, and beyond ``SHARD_WORDS`` they are dealt into shards, each
with an automaton of its own that all documents pass in turn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import (
    ALNUM_BYTES,
    FOLD_CASE,
    WordHasher,
    boxed,
    joined,
    stage,
    steps,
    tidy,
    unboxed,
    word_spans,
)

WINDOW = 13
#: Words of items in one automaton, about 0.2 GB of Python objects.
SHARD_WORDS = 200_000
COVERAGE = 0.05

_hasher = WordHasher(10, fold_case=True)


class ItemAutomaton:
    """Suffix automaton of several word sequences, and the items of its states."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.shortest = window
        self.ids: list[object] = []
        sequences = []
        for name, words in items:
            if words:
                self.ids.append(name)
                sequences.append([self.words.setdefault(w, len(self.words)) for w in words])
                self.shortest = min(self.shortest, len(words))
                self._add(sequences[-1])
        #: Items that hold the runs of a state; and of the items shorter than a
        #: window, by the state of the whole item: length -> items.
        self.items: list[set[int]] = [set() for _ in self.next]
        self.whole: dict[int, dict[int, set[int]]] = {}
        for k, sequence in enumerate(sequences):
            state = 0
            for c in sequence:
                state = self.next[state][c]
                s = state
                while s > 0 and k not in self.items[s]:
                    self.items[s].add(k)
                    s = self.link[s]
            if len(sequence) < window:
                self.whole.setdefault(state, {}).setdefault(len(sequence), set()).add(k)

    def _add(self, sequence: list[int]) -> None:
        """Extend the automaton by one more sequence, starting from the root."""
        last = 0
        for c in sequence:
            known = self.next[last].get(c)
            if known is not None:
                last = known if self.length[known] == self.length[last] + 1 else self._split(last, c, known)
                continue
            new = self._state(self.length[last] + 1, {}, 0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            last = new

    def _state(self, length: int, following: dict[int, int], link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of state ``q`` for the runs no longer than those of ``p`` + c."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def scan(self, words: np.ndarray) -> Iterator[tuple[int, int, set[int]]]:
        """Windows in a sequence of word numbers: (end, length, items)."""
        following, link, length = self.next, self.link, self.length
        state = run = 0
        for end, c in enumerate(words.tolist(), 1):
            while state and c not in following[state]:
                state = link[state]
                run = length[state]
            step = following[state].get(c)
            if step is None:
                continue
            state, run = step, run + 1
            if run < self.shortest:
                continue
            s = state
            if run >= self.window:
                while length[link[s]] >= self.window:
                    s = link[s]
                yield end, self.window, self.items[s]
            while self.whole and s > 0:
                for n, items in self.whole.get(s, {}).items():
                    if n <= run:
                        yield end, n, items
                s = link[s]


def item_words(text: str | None) -> list[bytes]:
    data = np.frombuffer((text or "").encode(), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALNUM_BYTES)
    folded = FOLD_CASE[data].tobytes()
    return [folded[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _vocabulary(automaton: ItemAutomaton) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the item words, and the number of the word of each."""
    words = list(automaton.words)
    data = np.frombuffer(b"".join(words), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)]).astype(np.int64)
    hashes = _hasher(data, offsets[:-1], offsets[1:])
    order = np.argsort(hashes)
    return hashes[order], order.astype(np.int64)


def _hits(automaton: ItemAutomaton, vocabulary, data, offsets):
    """For each document with a window: its number, words, hit mask and items."""
    starts, ends, doc = word_spans(data, offsets, ALNUM_BYTES)
    counts = np.bincount(doc, minlength=len(offsets) - 1)
    found: dict[int, tuple[np.ndarray, set[int]]] = {}
    hashes, numbers = vocabulary
    if len(starts) and len(hashes):
        h = _hasher(data, starts, ends)
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        known = hashes[at] == h
        first_word = np.concatenate([[0], np.cumsum(counts)])
        # runs of item words inside one document, long enough for a window
        edge = np.ones(len(known) + 1, bool)
        edge[1:-1] = (known[1:] != known[:-1]) | (doc[1:] != doc[:-1])
        edges = np.flatnonzero(edge)
        long = known[edges[:-1]] & (np.diff(edges) >= automaton.shortest)
        for a, b in zip(edges[:-1][long].tolist(), edges[1:][long].tolist(), strict=True):
            d = int(doc[a])
            for end, n, items in automaton.scan(numbers[at[a:b]]):
                if d not in found:
                    found[d] = (np.zeros(counts[d], bool), set())
                last = a + end - first_word[d]
                found[d][0][last - n : last] = True
                found[d][1].update(items)
    return starts, ends, counts, found


def _automata(benchmark: DataFrame, item_column: str, text: str, window: int, shard_words: int):
    """Automata of the items, one shard at a time."""
    items = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()["bytes"]
    shards = max(1, -(-int(size) // (6 * shard_words)))
    shard = F.pmod(F.xxhash64("item", "text"), F.lit(shards))
    for k in range(shards):
        rows = items.where(shard == k).collect() if shards > 1 else items.collect()
        ordered = sorted(rows, key=lambda r: (r["item"] or "", r["text"] or ""))
        yield ItemAutomaton([(r["item"], item_words(r["text"])) for r in ordered], window), k == shards - 1


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    cut: bool = False,
) -> DataFrame:
    """``docs`` with one struct column ``found``: ``n_words``, ``spans`` (start and
    end word of each maximal run of hit words) and ``items`` (sorted item ids). With
    ``cut`` the texts have lost the words of these spans.

    Words are lower-cased runs of letters, digits and non-ASCII characters. A window
    is ``window`` consecutive words of an item, or the whole of a shorter item; a
    word inside any occurrence of a window is hit. Null and empty texts have no
    words, null items no windows; a null item id counts as an empty string. The
    columns of ``docs`` stay, but for one named ``found``, which is replaced;
    repeated rows are judged alike; an empty benchmark gives rows without hits.
    """
    spark = docs.sparkSession
    kind = "struct<n_words:bigint,spans:array<struct<first:bigint,past:bigint>>,items:array<string>>"
    result = docs.withColumn("found", F.lit(None).cast(kind))
    for automaton, last in _automata(benchmark, item_column, item_text, window, shard_words):
        shared = spark.sparkContext.broadcast((automaton, _vocabulary(automaton)))
        schema = result.schema

        def scan(batches, shared=shared, column=text, cutting=cut and last):
            automaton, vocabulary = shared.value
            for batch in batches:
                names = batch.schema.names
                texts = batch.column(names.index(column)).cast(pa.binary())
                before = batch.column(names.index("found"))
                merged: list[dict | None] = before.to_pylist()
                data, offsets = joined(texts)
                for part in steps(np.diff(offsets)):
                    low, high = offsets[part.start], offsets[part.stop]
                    *_, counts, found = _hits(
                        automaton, vocabulary, data[low:high], offsets[part.start : part.stop + 1] - low
                    )
                    for k, n in enumerate(counts.tolist()):
                        merged[part.start + k] = _merge(merged[part.start + k], n, found.get(k), automaton.ids)
                new = {"found": merged}
                if cutting and any(m["spans"] for m in merged):
                    whole = batch.column(names.index(column)).to_pylist()
                    new[column] = [_cut(t, m["spans"]) for t, m in zip(whole, merged, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(new[n], type=batch.schema.field(i).type) if n in new else batch.column(i)
                        for i, n in enumerate(names)
                    ],
                    schema=batch.schema,
                )

        result = result.mapInArrow(tidy(scan), schema)
        if not last:
            result = stage(result, "decontaminate")
    return result


def _merge(before: dict | None, n_words: int, hit, ids: list) -> dict:
    spans = before["spans"] if before else []
    items = before["items"] if before else []
    if hit:
        mask = hit[0].copy()
        for s in spans:
            mask[s["first"] : s["past"]] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
        spans = [{"first": int(a), "past": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]
        items = sorted({*items, *(ids[k] or "" for k in hit[1])})
    return {"n_words": n_words, "spans": spans, "items": items}


def n_hit():
    return F.aggregate(
        "found.spans", F.lit(0).cast("long"), lambda total, s: total + s["past"] - s["first"]
    )


def is_contaminated(coverage: float = COVERAGE):
    """Some word is hit, and the hit words are at least this share of all."""
    share = round(1 / coverage)
    return (n_hit() > 0) & (n_hit() * share >= F.col("found.n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", coverage: float = COVERAGE, **options) -> DataFrame:
    """``docs`` without what they share with the benchmark: documents beyond the
    coverage limit go, the others lose the words of their hit spans together with
    the characters between those words. Texts without hits stay as they are. Where
    there is an ``n_chars`` column, it follows a shortened text.
    """
    kept = find_items(boxed(docs, text), benchmark, cut=True, **options).where(~is_contaminated(coverage))
    return unboxed(kept, docs, text, F.size("found.spans") > 0)


def _cut(text: str | None, spans: list[dict]) -> str | None:
    return without_words(text, [(s["first"], s["past"]) for s in spans]) if spans else text


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words first..past-1 of each span."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), ALNUM_BYTES)
    parts, at = [], 0
    for first, past in spans:
        parts.append(raw[at : starts[first]])
        at = ends[past - 1]
    return b"".join([*parts, raw[at:]]).decode()
