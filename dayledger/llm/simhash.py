"""SimHash near-duplicates, found by vantage-point trees over the fingerprints.

Distinct fingerprints are dealt to leaves of a vantage-point tree by their Hamming
distance to the vantage point of each node. The tree is fitted on a bounded sample;
that shapes the shards, not the result. A fingerprint lives in one leaf and, by the
triangle bound, also queries those leaves that may hold a neighbour across a
boundary: on the near side of a node only if its distance is within the bit bound of
the split. Of two fingerprints that part at a node only the nearer one crosses, so
each pair meets once. In a leaf, rows are compared to the columns whose distance to
a local vantage point differs by no more than the bound.

Leaves send back links of a spanning forest, not pairs. A crowded leaf is dealt into
tiles of bounded size, each pair of tiles a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.llm.common import boxed, hashed_sample, stage, text_of, tidy, unboxed
from dayledger.llm.components import components

SHINGLE = 3
MAX_BITS = 2
HASH_SEED = 42
#: Fingerprints the tree is fitted on, at most.
SAMPLE = 65_536
#: Fingerprints of a leaf that the tree aims at, and of a tile at most.
LEAF = 4_096
TILE = 16_384
#: Numbers that one comparison step holds.
STEP = 1 << 21


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the hashes of the word shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    hashes = shingle_hashes(words, shingle)
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int((2 * ones > len(hashes)) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(line, HASH_SEED)], "<u8")
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    digest = xxhash.xxh64_intdigest
    last = (ends[shingle - 1 :] - 1).tolist()
    return np.array([digest(line[a:b], HASH_SEED) for a, b in zip(starts, last, strict=False)], "<u8")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``row_id``, ``row_hash`` of id and text, and ``bits``, the fingerprint as a
    signed number, of every row."""
    rows = docs.select(
        F.col(id_column).alias("row_id"),
        row_hash(id_column, text).alias("row_hash"),
        text_of(text).cast("binary").alias("row_text"),
    )

    def compute(batches):
        for batch in batches:
            own = [fingerprint(t, shingle) for t in batch.column(2).to_pylist()]
            bits = pa.array(np.array(own, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), bits], names=["row_id", "row_hash", "bits"])

    kind = dict(rows.dtypes)["row_id"]
    return rows.mapInArrow(tidy(compute), f"row_id {kind}, row_hash bigint, bits bigint")


def row_hash(id_column: str, text: str, *more: Column) -> Column:
    return F.xxhash64(F.col(id_column), F.col(text), *more)


# --- the tree ----------------------------------------------------------------


@dataclass
class Node:
    """A vantage point and the distance up to which fingerprints are near."""

    point: int
    split: int
    near: Node | int
    far: Node | int


def distances(bits: np.ndarray, point) -> np.ndarray:
    return np.bitwise_count(bits ^ np.uint64(point))


def grow(sample: np.ndarray, capacity: float, seed: int = 2) -> tuple[Node | int, int]:
    """A tree over distinct fingerprints, and the number of its leaves."""
    draw = np.random.default_rng(seed)
    leaves = 0

    def build(rows: np.ndarray):
        nonlocal leaves
        if len(rows) > max(capacity, 2):
            best = None
            for point in draw.choice(rows, min(8, len(rows)), replace=False):
                d = distances(rows, point)
                spread = d.std()
                if best is None or spread > best[0]:
                    best = spread, int(point), d
            _, point, d = best
            split = int(np.median(d))
            if (d <= split).all():
                split -= 1
            near = d <= split
            if near.any() and not near.all():
                return Node(point, split, build(rows[near]), build(rows[~near]))
        leaves += 1
        return leaves - 1

    return build(sample), leaves


def homes(tree: Node | int, bits: np.ndarray, max_bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each leaf that is reached: rows of ``bits`` that live or query there."""
    todo = [(tree, np.arange(len(bits)), np.zeros(len(bits), bool))]
    while todo:
        node, rows, guest = todo.pop()
        if not len(rows):
            continue
        if not isinstance(node, Node):
            yield node, rows, guest
            continue
        d = distances(bits[rows], node.point).astype(np.int16)
        near = d <= node.split
        to_near = near | (guest & (d <= node.split + max_bits))
        to_far = d > node.split - max_bits
        todo.append((node.near, rows[to_near], guest[to_near]))
        todo.append((node.far, rows[to_far], (guest | near)[to_far]))


# --- links inside a shard ----------------------------------------------------


def roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    found = parent[nodes]
    while True:
        above = parent[found]
        if np.array_equal(above, found):
            return found
        found = above


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of a[i] and b[i]; the smaller root stays."""
    while len(a):
        x, y = roots(parent, a), roots(parent, b)
        apart = x != y
        a, b = a[apart], b[apart]
        if len(a):
            np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])


def forest(rows: np.ndarray, columns: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprints) that span what rows and columns within the bound join."""
    everything, where = np.unique(np.concatenate([rows, columns]), return_inverse=True)
    row_at, column_at = where[: len(rows)], where[len(rows) :]
    parent = np.arange(len(everything))
    if len(rows) and len(columns):
        point = columns[len(columns) // 2]
        d_columns = distances(columns, point)
        order = np.argsort(d_columns, kind="stable")
        columns, column_at, d_columns = columns[order], column_at[order], d_columns[order]
        d_rows = distances(rows, point)
        for d in np.unique(d_rows).tolist():
            low, high = np.searchsorted(d_columns, [d - max_bits, d + max_bits + 1])
            if low == high:
                continue
            own = np.flatnonzero(d_rows == d)
            size = max(1, STEP // (high - low))
            for at in range(0, len(own), size):
                part = own[at : at + size]
                close = np.bitwise_count(rows[part, None] ^ columns[None, low:high]) <= max_bits
                i, j = np.nonzero(close)
                unite(parent, row_at[part][i], column_at[low:high][j])
    top = roots(parent, np.arange(len(everything)))
    linked = top != np.arange(len(everything))
    return everything[linked], everything[top[linked]]


SHARD = "leaf int, i int, j int, role int, bits bigint"


def links(distinct: DataFrame, max_bits: int = MAX_BITS, sample: int = SAMPLE, leaf: int = LEAF, tile: int = TILE) -> DataFrame:
    """``a``, ``b``: links that span the components of distinct fingerprints
    (column ``bits``) at ``max_bits`` or fewer differing bits."""
    spark = distinct.sparkSession
    count = distinct.count()
    hashed = distinct.select("bits", F.xxhash64("bits").alias("h"))
    chosen = hashed_sample(hashed, sample, count).collect() if count > leaf else []
    points = np.array([r["bits"] for r in chosen], np.int64).view(np.uint64)
    tree, leaves = grow(points, leaf * len(points) / max(count, 1))
    shared = spark.sparkContext.broadcast(tree)

    def living(batches):
        for batch in batches:
            bits = batch.column(0).to_numpy().view(np.uint64)
            for k, _, guest in homes(shared.value, bits, max_bits):
                yield pa.RecordBatch.from_pydict(
                    {"leaf": pa.array([k], pa.int32()), "n": pa.array([int((~guest).sum())], pa.int64())}
                )

    sizes = distinct.mapInArrow(living, "leaf int, n bigint").groupBy("leaf").agg(F.sum("n").alias("n"))
    tiles = np.ones(leaves, np.int64)
    for r in sizes.where(F.col("n") > tile).collect():  # at most a row for each leaf
        tiles[r["leaf"]] = -(-r["n"] // tile)

    def deal(batches):
        for batch in batches:
            bits = batch.column(0).to_numpy().view(np.uint64)
            for k, rows, guest in homes(shared.value, bits, max_bits):
                own, n = bits[rows], int(tiles[k])
                salt = (own * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % n
                for t in range(n):
                    # role 0: both row and column of tile (t, t); 1: row; 2: column
                    mine = salt == t
                    for other in range(n):
                        living = own[mine & ~guest]
                        if other == t:
                            yield from _shards(k, t, t, 0, living)
                        elif other > t:
                            yield from _shards(k, t, other, 1, living)
                        if other != t:
                            yield from _shards(k, other, t, 2, living)
                        yield from _shards(k, t, other, 3, own[mine & guest])

    def solve(key, shard):
        role = shard.column("role").to_numpy()
        bits = shard.column("bits").to_numpy().view(np.uint64)
        residents = np.unique(bits[(role == 0) | (role == 2)])
        rows = np.concatenate([bits[role == 0], bits[role == 1], bits[role == 3]])
        a, b = forest(np.unique(rows), residents, max_bits)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return distinct.mapInArrow(deal, SHARD).groupBy("leaf", "i", "j").applyInArrow(solve, "a bigint, b bigint")


def _shards(leaf: int, i: int, j: int, role: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(bits):
        whole = lambda x: pa.array(np.full(len(bits), x, np.int32))
        yield pa.RecordBatch.from_arrays(
            [whole(leaf), whole(i), whole(j), whole(role), pa.array(bits.view(np.int64))],
            names=["leaf", "i", "j", "role", "bits"],
        )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per input row: its id, ``fingerprint`` (16 lower-case hex digits) and
    ``component_id``, the smallest id reachable over fingerprints that differ in
    ``max_bits`` bits or fewer; ``row_hash`` tells rows of one id apart by text.

    A to Z are lower-cased; words are runs of bytes other than space and 0x09 to
    0x0D. Texts of fewer words than a shingle have one shingle, texts without words,
    null ones included, fingerprint zero, linked like any other. Null ids do not
    count as smallest unless a component has no other. Repeated rows stay repeated;
    an empty table gives no rows; other columns are not read.
    """
    found = rooted(docs, id_column, text, shingle, max_bits)
    return found.withColumnRenamed("row_id", id_column).drop("root")


def rooted(docs: DataFrame, id_column: str, text: str, shingle: int, max_bits: int) -> DataFrame:
    """``row_id, fingerprint, component_id, row_hash`` and ``root``, a fingerprint of
    the component: components of one smallest id, as of repeated ids, differ in it."""
    rows = stage(fingerprints(docs, id_column, text, shingle), "fingerprints")
    classes = stage(rows.groupBy("bits").agg(F.min("row_id").alias("least")), "classes")
    joins = components(links(classes.select("bits"), max_bits))
    placed = classes.join(joins.withColumnRenamed("node", "bits"), "bits", "left").withColumn(
        "root", F.coalesce("root", "bits")
    )
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("bits", "root", "component_id")
    return rows.join(named, "bits").select(
        "row_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
        "row_hash",
        "root",
    )


def keep_one(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, null ids
    last, and of rows that repeat it that of the smallest hash of id and text, once.
    Rows of one id whose texts are not linked are components of their own."""
    found = rooted(docs, id_column, text, shingle, max_bits)
    first = F.min(F.struct(F.col("row_id").isNull().alias("last"), "row_id", "row_hash")).alias("first")
    kept = found.groupBy("root").agg(first).select("first.row_id", "first.row_hash").distinct()
    # two hashes and the id: that different rows agree in all is out of the question
    box = boxed(docs, text).withColumns(
        {"row_hash": row_hash(f"rest.`{id_column}`", "text"), "again": row_hash(f"rest.`{id_column}`", "text", F.lit(1))}
    )
    same = (F.col("rest")[id_column].eqNullSafe(F.col("row_id"))) & (F.col("row_hash") == F.col("kept_hash"))
    rows = box.join(kept.withColumnRenamed("row_hash", "kept_hash"), same, "left_semi")
    return unboxed(rows.dropDuplicates(["row_hash", "again"]), docs, text)
