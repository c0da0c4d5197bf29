"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A text is its lower-cased words, a space after each, and an end. Every byte is a
path of bits through a Huffman tree. For each of several contexts (the last two to
four bytes, the word so far) it is known how often a bit was 0 and 1 after that
context at that node, over all training texts. The predictions are mixed in the
logistic domain. Weights learn online from the first to the last bit of a text; a gate
picks among sets of them by how well the bits before were predicted. The mixed
probability is refined by a table of corrections by its size, learned online too. The
cost of all bits gives the log-probability and the bits per byte.

Blocks of documents ask for the contexts they hold and the bytes after them, as they
ask for words: what is known grows with the corpus, and no two contexts share counts.

Beside it stands the unigram model: blocks of documents ask for the counts of their
words over all training texts.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm import blocks as B
from dayledger.llm.common import WordHasher, mix, partitions, steps, text_of, word_spans

SPACE, END = 0x20, 0x0A
#: Numbers of last bytes that are contexts; the word so far is one more.
ORDERS = (2, 3, 4)
#: Bytes of it at most, the last ones of a longer word.
WORD_REACH = 6
#: Bits that are mixed with the same weights.
BLOCK = 64
#: Costs of a bit in the block before that pick the weights.
GATES = (0.25, 0.6)
RATE = 0.002
#: Mixed predictions, log(p / (1 - p)), are refined by the whole number next to them,
#: up to this one; the corrections learn at a rate of their own.
REACH = 8
REFINE_RATE = 0.005
FIRST_WEIGHTS = (0.1, 0.2, 0.45, 0.5)
#: Bytes of text whose words are hashed at once.
STRETCH = 1 << 18
#: Bytes of text whose bits are laid out at once.
LAYOUT = 1 << 16
#: Bits of a byte's path that are laid out together.
FIRST = 8
#: Bytes of texts that are mixed side by side; a longer text is alone.
MIXED = 1 << 23
#: Blocks of bits whose numbers are made floating together.
CAST = 1024
#: Bytes whose pairs are sorted at once; 64 bits hold five bytes and a place among them.
PIECE = 1 << 23
SCALE = 4096.0

_hasher = WordHasher(8, fold_case=True)


@dataclass
class Tree:
    """Codes of the bytes: length, and for each depth the node and the bit."""

    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray
    number: np.ndarray  # of the node, from 0


def huffman(counts: np.ndarray) -> Tree:
    """A Huffman tree over all 256 bytes, each counted once more than seen."""
    heap = [(int(c) + 1, i, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    made = 256
    while len(heap) > 1:
        (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x], parent[y] = (made, 0), (made, 1)
        heapq.heappush(heap, (a + b, made, made))
        made += 1
    paths = []
    for symbol in range(256):
        path, at = [], symbol
        while at in parent:
            path.append(parent[at])
            at = parent[at][0]
        paths.append(path[::-1])
    deepest = max(map(len, paths))
    node, bit = np.zeros((256, deepest), np.uint32), np.zeros((256, deepest), np.uint8)
    number = np.zeros((256, deepest), np.uint8)
    for symbol, path in enumerate(paths):
        for j, (n, b) in enumerate(path):
            node[symbol, j], bit[symbol, j], number[symbol, j] = NODES[n - 256], b, n - 256
    return Tree(np.array([len(p) for p in paths]), node, bit, number)


def symbols(text: bytes) -> bytes:
    """The bytes that are scored: lower-cased words, a space after each, an end."""
    words = text.lower().split()
    return b" ".join(words) + b" \n" if words else b"\n"


def lay_out(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(parts), np.uint8)
    return data, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many bytes of its text, and of its word (up to ``WORD_REACH``), stand before
    each byte."""
    at = np.arange(len(data))
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    edge = np.ones(len(data), bool)
    edge[1:] = data[:-1] == SPACE
    edge[begins] = True
    into = at - np.repeat(offsets[:-1], np.diff(offsets))
    return into, np.minimum(at - np.maximum.accumulate(np.where(edge, at, 0)), WORD_REACH)


def context(kind: int, data: np.ndarray, into: np.ndarray, written: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The context of a kind before some positions, in 51 bits; none reaches into
    another text."""
    into, written, word = into[at], written[at], kind == len(ORDERS)
    found = written.astype(np.uint64) << np.uint64(48) if word else np.zeros(len(at), np.uint64)
    for k in range(1, (WORD_REACH if word else ORDERS[kind]) + 1):
        before = data[np.maximum(at - k, 0)]
        before = np.where(written < k, 0, before) if word else np.where(into < k, END, before)
        found |= before.astype(np.uint64) << np.uint64(8 * (k - 1))
    return found


def contexts(data: np.ndarray, offsets: np.ndarray, table_bits: int | None = None) -> Iterator[np.ndarray]:
    """For each context, what it is before each byte, in 53 bits of which the first two
    are its kind. ``table_bits`` keeps that many bits of a hash instead."""
    into, written = places(data, offsets)
    for kind in range(CONTEXTS):
        yield _of_kind(kind, context(kind, data, into, written, np.arange(len(data))), table_bits)


def before(parts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Some bytes of the texts after others: each and the seven before it as one number,
    the byte lowest, and how many bytes of its word (up to ``WORD_REACH``) stand before
    it. Before a text stand ends."""
    gap = bytes([END]) * 7
    laid = np.frombuffer(gap.join([b"", *parts]), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(sizes + 7)  # of the texts in ``laid``
    real = np.ones(max(0, len(laid) - 7), bool)
    real[(ends[:-1, None] - 7 + np.arange(7)).ravel()] = False
    within = laid[6:-1] != SPACE
    within[ends[:-1][ends[:-1] < len(within)]] = False
    within[:1] = False
    run, written = within, within.astype(np.uint8)
    for _ in range(1, WORD_REACH):
        last, run = run, np.zeros(len(run), bool)
        np.logical_and(last[:-1], within[1:], out=run[1:])
        written += run
    for low in range(0, len(real), PIECE):
        some = slice(low, min(len(real), low + PIECE))
        eight = np.ndarray(some.stop - low, ">u8", laid, low, (1,))
        yield eight.astype(np.uint64)[real[some]], written[some][real[some]]


def last_bytes(eight: np.ndarray, n: int) -> np.ndarray:
    return eight & np.uint64((1 << 8 * n) - 1)


def in_word(eight: np.ndarray, written: np.ndarray) -> np.ndarray:
    """The pairs of the word so far and the byte after it."""
    own = WORD_MASKS[written]
    own &= eight
    own |= written.astype(np.uint64) << np.uint64(56)
    return own


def changes(ranked: np.ndarray) -> np.ndarray:
    """Where values in order differ from the one before."""
    first = np.ones(len(ranked), bool)
    np.not_equal(ranked[1:], ranked[:-1], out=first[1:])
    return first


def ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the number of each value among them. Values
    and their places share 64 bits, so plain numbers are sorted."""
    bits = max(1, len(values) - 1).bit_length()
    both = values << np.uint64(bits)
    both |= np.arange(len(values), dtype=np.uint64)
    both.sort()
    at = (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    both >>= np.uint64(bits)
    first = changes(both)
    number = np.empty(len(values), np.int32)
    number[at] = np.cumsum(first, dtype=np.int32) - np.int32(1)
    return both[first], number


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sums of their counts."""
    order = np.argsort(keys)
    keys = keys[order]
    at = np.flatnonzero(changes(keys))
    return keys[at], np.add.reduceat(counts[order], at) if len(at) else counts[:0]


def key_of(kind: int, pairs: np.ndarray, table_bits: int | None) -> np.ndarray:
    return followed(_of_kind(kind, pairs >> np.uint64(8), table_bits), last_bytes(pairs, 1))


def _of_kind(kind: int, context: np.ndarray, table_bits: int | None) -> np.ndarray:
    if table_bits is not None:
        context = mix(context) >> np.uint64(64 - table_bits)
    return context | np.uint64(kind << 51)


CONTEXTS = len(ORDERS) + 1
#: Added to the hash of a context for each node of the tree.
NODES = np.random.default_rng(8).integers(0, 2**32, 511, np.uint32)
#: The bits of a byte and of those of its word before it.
WORD_MASKS = np.array([(1 << 8 * (n + 1)) - 1 for n in range(WORD_REACH + 1)], np.uint64)


@dataclass
class Bits:
    """The bits of some texts, laid out in blocks that belong to one text each."""

    counts: np.ndarray  # bits of each byte, the filling of a text's last block included
    node: np.ndarray
    bit: np.ndarray
    real: np.ndarray  # 1, or 0 for filling
    blocks: np.ndarray  # of each text


def bits_of(data: np.ndarray, offsets: np.ndarray, tree: Tree, block: int = 1) -> Bits:
    length = tree.length[data]
    ends = np.concatenate([[0], np.cumsum(length)])
    own = np.diff(ends[offsets])
    blocks = -(-own // block)
    filling = blocks * block - own
    counts = length.copy()
    counts[offsets[1:][own > 0] - 1] += filling[own > 0]
    first = np.cumsum(counts) - counts
    total = int(counts.sum())
    cell = np.repeat((data * np.int32(tree.node.shape[1]) - first).astype(np.int32), counts)
    cell += np.arange(total, dtype=np.int32)
    np.minimum(cell, tree.node.size - 1, out=cell)
    real = np.ones(total, bool)
    past = np.cumsum(blocks * block)
    for end, n in zip(past[filling > 0].tolist(), filling[filling > 0].tolist(), strict=True):
        real[end - n : end] = False
    return Bits(counts, tree.node.ravel()[cell], tree.bit.ravel()[cell], real, blocks)


def slots(context: np.ndarray, bits: Bits, table_bits: int) -> np.ndarray:
    """Slots of a table of bounded size, for texts that are scored in memory."""
    hashed = (mix(context) >> np.uint64(32)).astype(np.uint32)
    return (np.repeat(hashed, bits.counts) + bits.node) >> np.uint32(32 - table_bits)


def count_bits(parts: list[bytes], tree: Tree, table_bits: int, counts: np.ndarray) -> None:
    """Add the bits of some texts to ``counts`` (contexts x slots and bits)."""
    data, offsets = lay_out(parts)
    bits = bits_of(data, offsets, tree)
    for k, context in enumerate(contexts(data, offsets)):
        cell = slots(context, bits, table_bits).astype(np.int64)
        cell <<= 1
        cell |= bits.bit
        np.add.at(counts[k], cell, np.uint32(1))


def stretched(counts: np.ndarray) -> np.ndarray:
    """log(p / (1 - p)) of a 1 in each slot, in steps of 1 / ``SCALE``; 0 if unseen."""
    pair = counts.reshape(-1, 2).astype(np.float64)
    value = np.log((pair[:, 1] + 0.4) / (pair[:, 0] + 0.4))
    return np.round(np.clip(value, -7.9, 7.9) * SCALE).astype(np.int16)


def _value_codes() -> np.ndarray:
    """All values of bits; those after few bits, whose codes are small, come first."""
    few = [stretched(np.array([n - ones, ones])) for n in range(MANY_BITS) for ones in range(n + 1)]
    every = np.concatenate([*few, np.arange(-(1 << 15), 1 << 15, dtype=np.int16)])
    _, first = np.unique(every, return_index=True)
    return every[np.sort(first)]


MANY_BITS = 256
#: The value that a code stands for, and the code of each value, as an unsigned number.
VALUES = _value_codes()
CODES = np.empty(1 << 16, np.uint16)
CODES[VALUES.view(np.uint16)] = np.arange(1 << 16, dtype=np.uint16)


@dataclass
class Places:
    """Where the bits of some bytes are taken from: the first ones of a byte's path from
    a row for each byte, the few others one by one."""

    at: np.ndarray  # in the rows of all bytes
    late: np.ndarray  # the bits that are not in the rows
    owner: np.ndarray  # their bytes
    nth: np.ndarray  # and which of a byte's bits they are

    def take(self, rows: np.ndarray, late: Callable[[], np.ndarray]) -> np.ndarray:
        found = rows.ravel().take(self.at)
        if len(self.late):
            found[self.late] = late()
        return found


def places_of(length: np.ndarray, offsets: np.ndarray, filling: np.ndarray) -> tuple[Places, np.ndarray]:
    """Places of the bits of some texts, whose bytes have codes of these lengths, and
    where the filling stands that follows each text."""
    ends = np.concatenate([[0], np.cumsum(length)])
    past = np.cumsum(filling)
    void = np.repeat(ends[offsets[1:]] + past - filling, filling) + counted_up(filling)
    direct = np.ones(int(ends[-1]) + len(void), bool)
    direct[void] = False
    longer = np.flatnonzero(length > FIRST)
    more = length[longer] - FIRST
    owner, nth = np.repeat(longer, more), counted_up(more) + FIRST
    late = ends[owner] + nth + np.concatenate([[0], past])[np.searchsorted(offsets[1:], owner, "right")]
    direct[late] = False
    at = np.zeros(len(direct), np.int64)
    at[direct] = np.flatnonzero(WITHIN.take(length, 0, mode="clip"))
    return Places(at, late, owner, nth), void


def counted_up(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


#: Which of its first bits a byte has, whose code is so long; a longer one has all.
WITHIN = np.arange(FIRST) < np.arange(FIRST + 1)[:, None]


class Known:
    """What is known of each bit after the contexts that some texts hold: for each
    (context, byte), in order, a value for each bit of the byte."""

    def __init__(self, keys: np.ndarray, starts: np.ndarray, values: np.ndarray, table_bits: int | None):
        self.keys, self.starts, self.table_bits = keys, starts, table_bits
        self.values = np.append(values, np.zeros(FIRST, values.dtype))  # a row may read past the end
        self.first = self.values[starts[:, None] + np.arange(FIRST)]

    def inputs(self, data: np.ndarray, offsets: np.ndarray, bits: Bits):
        """The values of the bits of some texts, context by context."""
        first = np.cumsum(bits.counts) - bits.counts
        nth = np.arange(len(bits.real))
        for context in contexts(data, offsets, self.table_bits):
            own = np.searchsorted(self.keys, followed(context, data))
            yield self.values[np.repeat(self.starts[own] - first, bits.counts) + nth]

    def laid(self, places: Places, rows: list[np.ndarray]) -> Iterator[np.ndarray]:
        """The values of the bits at some places, context by context; of filling, any.
        ``rows`` tells where the pair at each byte stands in ``keys``."""
        for own in rows:
            yield places.take(self.first.take(own, 0), lambda: self.values[self.starts[own[places.owner]] + places.nth])


def followed(context: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Keys of contexts and the byte after each."""
    return context << np.uint64(8) | data


def slot_inputs(table: np.ndarray, data: np.ndarray, offsets: np.ndarray, bits: Bits) -> Iterator[np.ndarray]:
    table_bits = int(table.shape[1]).bit_length() - 1
    for own, context in zip(table, contexts(data, offsets), strict=True):
        yield own[slots(context, bits, table_bits)]


def code_lengths(
    parts: list[bytes], tree: Tree, table: np.ndarray | Known, rows: list[np.ndarray] | None = None
) -> np.ndarray:
    """Bits that the mixed model spends on each text. ``rows`` are those of ``Known.inputs``.

    A lane is a text, a run of blocks of ``BLOCK`` bits. All lanes move on by a block
    at a time: predict its bits with the weights that the gate picks, correct the
    predictions, pay for them, then let weights and corrections learn from them. The
    blocks of a step lie side by side, those of longer texts first.
    """
    sizes = np.array([len(p) for p in parts], np.int64)
    own = np.array([int(tree.length[np.frombuffer(p, np.uint8)].sum()) for p in parts], np.int64)
    blocks = -(-own // BLOCK)
    order = np.argsort(-blocks, kind="stable")
    lanes = np.searchsorted(-blocks[order], -np.arange(blocks.max(initial=0)), "left")  # of each step
    rank = np.empty(len(parts), np.int64)
    rank[order] = np.arange(len(parts))
    step = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    place = (np.cumsum(lanes) - lanes)[step] + np.repeat(rank, blocks)
    total = len(place)
    inputs = np.empty((total, CONTEXTS, BLOCK), np.int16)
    signs = np.empty((total, BLOCK), np.int8)
    sign = 1 - 2 * np.pad(tree.bit, ((0, 0), (0, max(0, FIRST - tree.bit.shape[1])))).astype(np.int8)
    first_signs = np.ascontiguousarray(sign[:, :FIRST])
    filling = blocks * BLOCK - own
    low = byte = 0
    for part in steps(sizes, LAYOUT):
        data, offsets = lay_out(parts[part])
        high = low + int(blocks[part].sum())
        if isinstance(table, Known):
            spots, void = places_of(tree.length[data], offsets, filling[part])
            found = table.laid(spots, [row[byte : byte + len(data)] for row in rows])
            signed = spots.take(first_signs.take(data, 0), lambda: sign[data[spots.owner], spots.nth])
            signed[void] = 0
        else:
            bits = bits_of(data, offsets, tree, BLOCK)
            found = slot_inputs(table, data, offsets, bits)
            signed = (1 - 2 * bits.bit.view(np.int8)) * bits.real
        to = place[low:high]
        for k, value in enumerate(found):
            inputs[:, k][to] = value.reshape(-1, BLOCK)
        signs[to] = signed.reshape(-1, BLOCK)
        low, byte = high, byte + len(data)
    return _mixed(inputs, signs, lanes)[rank] / np.log(2) - filling


def _mixed(inputs: np.ndarray, signs: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """What the texts cost, longer ones first, and their filling, as natural logarithms.
    ``lanes`` tells how many blocks each step has. Inputs stay in steps of 1 / ``SCALE``;
    weights are that much smaller for it.

    Most steps have few lanes, so what they cost is the number of operations. Only the
    last block of a text has filling, and no block follows that its gate could pick for."""
    n, cells, sets = int(lanes.max(initial=0)), 2 * REACH + 1, len(GATES) + 1
    n = max(n, 1)
    weights = np.tile(np.array(FIRST_WEIGHTS, np.float32) / np.float32(SCALE), (sets * n, 1))
    corrections = np.zeros(n * cells, np.float32)
    first_set = sets * np.arange(n)
    chosen = first_set + 1
    middle = (cells * np.arange(n) + REACH)[:, None]
    cost, gates = np.zeros(n), (np.array(GATES) * BLOCK * np.log(2)).astype(np.float32)
    learn, most = np.float32(RATE / SCALE**2), np.float32(60)
    first = 0
    for some in steps(lanes, CAST):
        counts = lanes[some].tolist()
        last = first + sum(counts)
        xs, ss = inputs[first:last].astype(np.float32), signs[first:last].astype(np.float32)
        at = 0
        for n in counts:
            x, sign, own = xs[at : at + n], ss[at : at + n], chosen[:n]
            w = weights.take(own, 0)
            z = np.vecmat(w, x)
            near = np.maximum(z, -REACH)
            np.minimum(near, REACH, out=near)
            near = np.rint(near, out=near).astype(np.int64)
            near += middle[:n]
            z += corrections.take(near)
            # the signs are -1 for a 1, 1 for a 0 and 0 for filling, which costs 1 bit
            z *= sign
            np.minimum(z, most, out=z)
            e = np.exp(z, out=z)
            one = e + 1
            e /= one
            e *= sign
            bill = np.add.reduce(np.log(one, out=one), axis=1)
            cost[:n] += bill
            grown = np.matvec(x, e)
            grown *= learn
            w -= grown
            weights[own] = w
            learned = np.bincount(near.ravel(), e.ravel(), n * cells)
            learned *= REFINE_RATE
            corrections[: n * cells] -= learned
            np.add(first_set[:n], gates.searchsorted(bill), out=own)
            at += n
        first = last
    return cost


def byte_counts(docs: DataFrame) -> np.ndarray:
    """How often each byte occurs in the scored form of the texts (column ``body``)."""

    def count(batches):
        total = np.zeros(256, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(np.frombuffer(symbols(text), np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], names=["byte", "n"])

    rows = docs.select("body").mapInArrow(count, "byte bigint, n bigint").groupBy("byte").agg(F.sum("n").alias("n"))
    counts = np.zeros(256, np.int64)
    for r in rows.collect():
        counts[r["byte"]] = r["n"]
    return counts


def _rows_of_piece(eight: np.ndarray, written: np.ndarray):
    """The distinct pairs of the highest order and of words, and which is at each byte."""
    runs, row = ranks(last_bytes(eight, max(ORDERS) + 1))
    word, words = np.empty(len(row), np.int32), []
    # a run of bytes tells a word that is no longer; beyond that, those before it do
    at = written <= max(ORDERS)
    size = max(ORDERS) + 1
    own = row[at].astype(np.int64) * size + written[at]
    there = np.zeros(len(runs) * size, bool)
    there[own] = True
    every = np.flatnonzero(there)
    found, number = np.unique(in_word(runs[every // size], every % size), return_inverse=True)
    numbers = np.empty(len(there), np.int32)
    numbers[every] = number
    word[at] = numbers[own]
    words.append(found)
    at = np.flatnonzero(written > max(ORDERS))
    if len(at):
        far = in_word(eight[at], written[at])
        beyond = 8 * (max(ORDERS) + 1)
        own = (far >> np.uint64(beyond)) - np.uint64((max(ORDERS) + 1) << 56 - beyond)
        own |= row[at].astype(np.uint64) << np.uint64(17)
        found, number = ranks(own)
        word[at] = number + np.int32(len(words[0]))
        some = np.empty(len(found), np.int64)
        some[number] = np.arange(len(at))
        words.append(far[some])
    return (runs, row), (np.concatenate(words), word)


def _merged(pieces: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of all pieces in order, and which is at each byte."""
    every, number = np.unique(np.concatenate([pairs for pairs, _ in pieces]), return_inverse=True)
    parts = np.split(number.astype(np.int32), np.cumsum([len(pairs) for pairs, _ in pieces])[:-1])
    return every, np.concatenate([own[row] for own, (_, row) in zip(parts, pieces, strict=True)])


def pair_rows(parts: list[bytes], table_bits: int | None) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct (context, byte) of some texts in order and, for each context, where
    among them the one at each byte of the texts stands."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int32)
    runs, words = [none], [none]
    for piece in before(parts):
        for found, own in zip((runs, words), _rows_of_piece(*piece), strict=True):
            found.append(own)
    (every, row), word = _merged(runs), _merged(words)
    found = [(every, row)]
    for order in ORDERS[-2::-1]:  # what is shorter is told by what is longer
        own, number = np.unique(last_bytes(every, order + 1), return_inverse=True)
        found.append((own, number.astype(np.int32)[row]))
    keys, rows, total = [], [], 0
    for kind, (pairs, row) in enumerate([*found[::-1], word]):
        own = key_of(kind, pairs, table_bits)
        if table_bits is not None:
            own, number = np.unique(own, return_inverse=True)
            row = number.astype(np.int32)[row]
        keys.append(own)
        rows.append(row + np.int32(total))
        total += len(own)
    return np.concatenate(keys), rows


def _counted(pairs: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs in order, and how many of each are marked."""
    both = pairs << np.uint64(1)
    both |= marks
    both.sort()
    marks = (both & np.uint64(1)).astype(np.int64)
    both >>= np.uint64(1)
    at = np.flatnonzero(changes(both))
    return both[at], np.add.reduceat(marks, at) if len(at) else marks


def held(parts: list[bytes], learned: np.ndarray, table_bits: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (context, byte) of some texts in order, and how often those texts
    that are learned from hold each."""
    own = np.repeat(learned, [len(p) for p in parts])
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    runs, words, low = [none], [none], 0
    for eight, written in before(parts):
        marks = own[low : low + len(eight)]
        low += len(eight)
        runs.append(_counted(last_bytes(eight, max(ORDERS) + 1), marks))
        words.append(_counted(in_word(eight, written), marks))
    found = [summed(*map(np.concatenate, zip(*runs, strict=True)))]
    for order in ORDERS[-2::-1]:  # what is shorter is told by what is longer
        found.append(summed(last_bytes(found[-1][0], order + 1), found[-1][1]))
    found = [*found[::-1], summed(*map(np.concatenate, zip(*words, strict=True)))]
    keys, seen = [], []
    for kind, (pairs, counts) in enumerate(found):
        pairs = key_of(kind, pairs, table_bits)
        if table_bits is not None:
            pairs, counts = summed(pairs, counts)
        keys.append(pairs)
        seen.append(counts)
    return np.concatenate(keys), np.concatenate(seen)


def by_bucket(keys: np.ndarray, buckets: int) -> dict[int, np.ndarray]:
    """Positions of the keys by bucket; all bytes after a context are in one."""
    hashed = mix(keys >> np.uint64(8)) >> np.uint64(32)
    bucket = (hashed % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order])) + 1
    return {int(bucket[own[0]]): own for own in np.split(order, ends) if len(own)}


def squeezed(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of their bytes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def expanded(packed: bytes | None, kind: str) -> np.ndarray:
    n, width = int.from_bytes((packed or b"")[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(packed[8:], n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind)[:, 0]


def bit_values(keys: np.ndarray, seen: np.ndarray, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """For distinct (context, byte) that were seen so often: a value for each bit of the
    byte's path, and where the values of each key begin. All bytes seen after a context
    are among the keys."""
    byte = (keys & np.uint64(255)).astype(np.int64)
    length = tree.length[byte]
    starts = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(keys)), length)
    nth = np.arange(len(owner)) - starts[owner]
    node = (keys[owner] & ~np.uint64(255)) | tree.number[byte[owner], nth]
    _, at = np.unique(node, return_inverse=True)
    cell = 2 * at + tree.bit[byte[owner], nth]
    pairs = np.bincount(cell, seen[owner], minlength=2 * len(at))
    return stretched(pairs)[at], starts


def gather(starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions of runs that begin at ``starts``, one run after another."""
    skip = np.cumsum(length) - length
    return np.repeat(starts - skip, length) + np.arange(int(length.sum()))


#: All are compressed: words, as differences, and their counts; contexts with the byte
#: after them, likewise.
ASKED = {"words": "u1", "trained": "u1", "pairs": "u1", "seen": "u1"}
#: Counts of the words in the order they were asked in, the bucket's distinct trained
#: words and their occurrences, and codes of the values of the bits.
TOLD = {"count": "u1", "totals": "<i8", "values": "u1"}


def _bytes(values: np.ndarray) -> np.ndarray:
    return np.frombuffer(squeezed(values), np.uint8)


def _block_words(rows: pa.Table):
    """Hashes of the words of a block, found a stretch at a time, and their texts."""
    data, offsets = B.bodies(rows)
    hashes, doc = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for part in steps(np.diff(offsets), STRETCH):
        low, high = offsets[part.start], offsets[part.stop]
        starts, ends, own = word_spans(data[low:high], offsets[part.start : part.stop + 1] - low)
        hashes.append(_hasher(data[low:high], starts, ends))
        doc.append(own + part.start)
    return np.concatenate(hashes), np.concatenate(doc)


def score(docs: DataFrame, trained: str, id_column: str = "doc_id", text: str = "text", table_bits: int | None = None) -> DataFrame:
    """One row per input row: its id, ``n_tokens`` (words and one end), ``n_known``
    (tokens that occur in training), ``train_tokens``, ``base_score`` (log10 of the
    add-one unigram probability), ``score`` (log10 of the mixed model's) and
    ``bits_per_byte``. ``trained`` names a boolean column: the rows learned from.

    Null and empty texts are an end alone. Null in ``trained`` is false. Without
    training rows all counts are zero. Repeated rows count and score each for
    itself; an empty table gives no rows; other columns are not read. With
    ``table_bits``, contexts are told apart by that many bits of a hash only.
    """
    spark = docs.sparkSession
    buckets = partitions(spark)
    own = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(trained), F.lit(False)).alias("learned"),
    )
    blocks = B.in_blocks(own, "doc_id", "text", "learned")
    learned = own.where("learned").select(text_of("text").cast("binary").alias("body"))

    tree = huffman(byte_counts(learned))

    def ask(key, rows):
        hashes, doc = _block_words(rows)
        flags = rows.column("learned").to_numpy()
        keys = np.unique(hashes)
        trained, often = np.unique(hashes[flags[doc]], return_counts=True)
        counts = np.zeros(len(keys), np.int64)
        counts[np.searchsorted(keys, trained)] = often
        words = dict(B.by_bucket(keys, buckets))
        pairs, seen = held([symbols(t) for t in rows.column("body").to_pylist()], flags, table_bits)
        after = by_bucket(pairs, buckets)
        none, parts = np.zeros(0, np.int64), []
        for b in range(buckets):  # all, as each tells its totals
            at, own = words.get(b, none), after.get(b, none)
            part = {
                "words": _bytes(np.diff(keys[at], prepend=np.uint64(0))),
                "trained": _bytes(counts[at].astype(np.uint32)),
                "pairs": _bytes(np.diff(pairs[own], prepend=np.uint64(0))),
                "seen": _bytes(seen[own].astype(np.uint32)),
            }
            parts.append((b, part))
        return B.pack(ASKED, key[0].as_py(), parts)

    def add(key, rows):
        words = [np.cumsum(expanded(x, "<u8"), dtype=np.uint64) for x in rows.column("words").to_pylist()]
        trained = np.concatenate([expanded(x, "<u4") for x in rows.column("trained").to_pylist()])
        keys, number = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.bincount(number, trained, minlength=len(keys)).astype(np.int64)
        block, made = rows.column("block").to_numpy(), []
        ends = np.cumsum([len(x) for x in words])
        totals = np.array([np.count_nonzero(counts), counts.sum()])
        asked = [np.cumsum(expanded(x, "<u8"), dtype=np.uint64) for x in rows.column("pairs").to_pylist()]
        seen = np.concatenate([expanded(x, "<u4") for x in rows.column("seen").to_pylist()])
        pairs, nth = np.unique(np.concatenate(asked), return_inverse=True)
        values, starts = bit_values(pairs, np.bincount(nth, seen, minlength=len(pairs)), tree)
        codes, length = CODES[values.view(np.uint16)], tree.length[(pairs & np.uint64(255)).astype(np.int64)]
        own = np.split(nth, np.cumsum([len(x) for x in asked])[:-1])
        for i, end in enumerate(ends.tolist()):
            at = slice(ends[i - 1] if i else 0, end)
            told = codes[gather(starts[own[i]], length[own[i]])]
            part = {"count": _bytes(counts[number[at]]), "totals": totals, "values": _bytes(told)}
            made.append((key[0].as_py(), part))
        return B.pack(TOLD, 0, made).set_column(0, "block", pa.array(block, pa.int32()))

    counts = B.answer(B.ask(blocks, ask, ASKED), add, TOLD)
    n_ends = learned.count()

    def _told(pairs, replies):
        order = np.concatenate([at for _, at in sorted(by_bucket(pairs, buckets).items())])
        values = VALUES[np.concatenate([expanded(x, "<u2") for x in replies.column("values").to_pylist()])]
        length = tree.length[(pairs[order] & np.uint64(255)).astype(np.int64)]
        starts = np.empty(len(pairs), np.int64)
        starts[order] = np.cumsum(length) - length
        return Known(pairs, starts, values, table_bits)

    def judge(rows, replies):
        hashes, doc = _block_words(rows)
        replies = replies.sort_by("bucket")
        totals = B.unpack(replies, {"totals": TOLD["totals"]})[0]["totals"].reshape(-1, 2).sum(axis=0)
        n_train = int(totals[1]) + n_ends
        n_distinct = int(totals[0]) + (n_ends > 0)
        keys, number = np.unique(hashes, return_inverse=True)
        known = np.zeros(len(keys), np.int64)
        if len(keys):
            known[np.concatenate([at for _, at in B.by_bucket(keys, buckets)])] = np.concatenate(
                [expanded(x, "<i8") for x in replies.column("count").to_pylist()]
            )
        c = known[number]
        total = np.log10(n_train + n_distinct + 1)
        words = np.bincount(doc, minlength=rows.num_rows)
        base = np.bincount(doc, np.log10(c + 1) - total, minlength=rows.num_rows) + np.log10(n_ends + 1) - total
        n_known = np.bincount(doc[c > 0], minlength=rows.num_rows) + (n_ends > 0)
        parts = [symbols(t) for t in rows.column("body").to_pylist()]
        sizes = np.array([len(p) for p in parts], np.int64)
        bits = np.zeros(rows.num_rows)
        order = np.argsort(-sizes, kind="stable")
        ranked = [parts[i] for i in order]
        pairs, own = pair_rows(ranked, table_bits)
        table, ends = _told(pairs, replies), np.cumsum(sizes[order])
        for part in steps(sizes[order], MIXED):
            at = slice(ends[part.start] - sizes[order[part.start]], ends[part.stop - 1])
            bits[order[part]] = code_lengths(ranked[part], tree, table, [row[at] for row in own])
        return pa.table(
            {
                "doc_id": rows.column("row_id"),
                "learned": rows.column("learned"),
                "n_tokens": pa.array(words + 1),
                "n_known": pa.array(n_known),
                "train_tokens": pa.array(np.full(rows.num_rows, n_train)),
                "base_score": pa.array(base),
                "score": pa.array(-bits * np.log10(2)),
                "bits_per_byte": pa.array(bits / sizes),
            }
        )

    schema = (
        "doc_id bigint, learned boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double, bits_per_byte double"
    )
    found = B.conclude(blocks, counts, judge, schema)
    return found.withColumnRenamed("doc_id", id_column).withColumnRenamed("learned", trained)
