"""A Merkle manifest of a dataset, with a proof for every document.

Nodes are labelled with the interval of leaf ranks they cover. The labels nest: an
ancestor of a leaf is the node of a level whose interval contains the leaf's rank,
and what a parent's interval holds beside a node's own is the node's sibling.

Levels are taken in bands of ``BAND``. A bucket is one node at the top of a band with
all it covers at the band's base, 2^BAND nodes at most, so no group grows with the
data, however large a language is. Going up, each bucket reduces its nodes to one.
Going down, a bucket is joined to the node of the band above whose interval contains
its own, which brings the siblings from there to the root. Leaves are shuffled as
digests, never with their texts, and once a level band instead of once a level.

Defined cases: a null is ``-``; an empty text is ``0:``. Leaves of a null ``doc_id``
come first, and rows that repeat an id follow each other by digest. A lone leaf is its
own subtree's root and, alone in the table, the root; its proof is empty. An empty
table has no rows and no root. Columns beside the five that are hashed are not read.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import pairwise
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.llm.common import partitions, stage

#: Levels of a band; a bucket holds 2^BAND digests at its base.
BAND = 10

HASHED = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<digest:binary,before:boolean>>"


def leaf_hash(values: list[Column]) -> Column:
    """The digest of values in order, each with its size in bytes before it."""
    parts = []
    for value in values:
        text = value.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """``tree`` (ascending as the languages do, null first), ``doc_id``, ``digest``
    and, where ``tampered`` holds, the digest after the size in characters grew by 1."""
    cols = {c: F.col(c) for c in HASHED}
    grown = cols | {"n_chars": cols["n_chars"].cast("decimal(20,0)") + 1}
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf_hash(list(cols.values())).alias("digest"),
        F.when(tampered, leaf_hash(list(grown.values()))).alias("tampered"),
    )


def ranked(nodes: DataFrame, tree: str, *order: str) -> DataFrame:
    """Adds ``lo``, the rank of a row in its tree, and ``n``, the rows of the tree.

    Rows are sorted over all tasks; a tree may spread over many. The offsets of a
    task's trees are sums over tasks, one row a task and tree."""
    keys = [tree, *order]
    spread = nodes.repartitionByRange(partitions(nodes.sparkSession), *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    placed = stage(
        spread.select("*", F.shiftright(place, 33).alias("part"), place.alias("place")), "merkle-ranked"
    )
    before = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        placed.groupBy("part", tree)
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
        .select(
            "part",
            tree,
            (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("rows").over(Window.partitionBy(tree)).alias("n"),
        )
    )
    return placed.join(parts, ["part", tree]).select(
        *nodes.columns, (F.col("place") + F.col("shift")).alias("lo"), "n"
    )


def node_hash(digests: list[bytes]) -> bytes:
    return sha256(b"".join(d.hex().encode() for d in digests)).digest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    return max(n - 1, 0).bit_length()


def levels(
    digests: list[bytes], n: int, lo: int, hi: int, width: int, band: int
) -> list[list[tuple[int, int, bytes]]]:
    """Nodes ``(lo, hi, digest)`` of a bucket, level by level up to the band's top.

    ``n`` counts the nodes of the whole tree at the base; each covers ``width`` leaves
    but for the last, which ends with the tree."""
    found = [[(lo + i * width, min(lo + (i + 1) * width, hi), d) for i, d in enumerate(digests)]]
    for _ in range(min(band, height(n))):
        below = found[-1]
        pairs = [below[i : i + 2] for i in range(0, len(below), 2)]
        found.append([(p[0][0], p[-1][1], node_hash([x[2] for x in p])) for p in pairs])
    return found


def siblings(nodes: list[list[tuple[int, int, bytes]]], at: int) -> list[tuple[bytes, bool]]:
    """What the parents of a base node and of its ancestors cover beside them, from
    the bottom up: the digest, and whether it stands before the node. A node that is
    alone in its parent has no sibling, but is hashed: an empty digest says so."""
    out = []
    for level, over in pairwise(nodes):
        (lo, hi, _), (first, last, _) = level[at], over[at >> 1]
        if first < lo:
            out.append((level[at - 1][2], True))
        elif hi < last:
            out.append((level[at + 1][2], False))
        else:
            out.append((b"", False))
        at >>= 1
    return out


def fold(digest: bytes, proof: list[tuple[bytes, bool]]) -> bytes:
    """The root that a digest and its siblings give."""
    for other, before in proof:
        pair = [other, digest] if before else [digest, other]
        digest = node_hash([d for d in pair if d])
    return digest


def buckets(nodes: DataFrame, width: int, band: int, payload: tuple[str, ...]) -> DataFrame:
    """One row per bucket: ``tree``, ``bucket``, ``lo``, ``hi`` (leaf ranks covered),
    ``n`` (nodes of the tree at the base), its members in order, and its top digest.

    ``nodes`` has ``tree, at`` (rank among the nodes of its level)``, n, hi`` (leaves
    of the tree) and ``digest``."""
    kinds = dict(nodes.dtypes)
    grouped = (
        nodes.withColumn("bucket", F.shiftright("at", band))
        .groupBy("tree", "bucket")
        .agg(
            F.first("n").alias("n"),
            F.first("leaves").alias("leaves"),
            F.sort_array(F.collect_list(F.struct("at", "digest", *payload))).alias("members"),
        )
        .withColumn("lo", F.shiftleft("bucket", band) * width)
        .withColumn("hi", F.least("leaves", F.col("lo") + (width << band)))
    )
    member = ",".join(f"{c}:{kinds[c]}" for c in ("at", "digest", *payload))
    schema = (
        f"tree {kinds['tree']}, bucket bigint, n bigint, leaves bigint, "
        f"members array<struct<{member}>>, lo bigint, hi bigint, top binary"
    )

    def add_top(batches):
        for batch in batches:
            members = batch.column(batch.schema.names.index("members"))
            sizes = members.offsets.to_numpy()
            digests = members.flatten().field("digest").to_pylist()
            first = sizes[0]
            tops = []
            for i, (n, lo, hi) in enumerate(
                zip(*(batch.column(batch.schema.names.index(c)).to_pylist() for c in ("n", "lo", "hi")), strict=True)
            ):
                own = digests[sizes[i] - first : sizes[i + 1] - first]
                tops.append(levels(own, n, lo, hi, width, band)[-1][0][2])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tops, pa.binary())], names=[*batch.schema.names, "top"]
            )

    return grouped.mapInArrow(add_top, schema)


class Band(NamedTuple):
    """Buckets of one band, the leaves that a node at its base covers, its levels."""

    buckets: DataFrame
    width: int
    levels: int


def bands(nodes: DataFrame, levels: int, payload: tuple[str, ...] = ()) -> list[Band]:
    """All bands of a forest from the bottom up. Every band is written, so a lost
    executor costs one of them."""
    found, width = [], 1
    while True:
        rows = stage(buckets(nodes, width, levels, payload), "merkle-band")
        found.append(Band(rows, width, levels))
        most = rows.agg(F.max("n")).first()[0] or 0
        if most <= 1 << levels:
            return found
        payload, width = (), width << levels
        nodes = rows.select(
            "tree",
            F.col("bucket").alias("at"),
            F.shiftright(F.col("n") + ((1 << levels) - 1), levels).alias("n"),
            "leaves",
            F.col("top").alias("digest"),
        )


def containing(band: Band, above: DataFrame) -> DataFrame:
    """Buckets with the node above that contains them: equal in tree and level bucket,
    and its interval holds theirs. ``above`` has ``tree, at, lo, hi, proof`` and more."""
    outer = above.withColumnsRenamed({"at": "bucket", "lo": "outer_lo", "hi": "outer_hi"})
    inside = (F.col("outer_lo") <= F.col("lo")) & (F.col("hi") <= F.col("outer_hi"))
    return band.buckets.join(outer, ["tree", "bucket"]).where(inside).drop("outer_lo", "outer_hi")


def _walk(batch: pa.RecordBatch, width: int, band: int):
    """Rows of a batch of buckets as dictionaries, each with its nodes."""
    for i in range(batch.num_rows):
        row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
        digests = [m["digest"] for m in row["members"]]
        yield row, levels(digests, row["n"], row["lo"], row["hi"], width, band)


def descend(band: Band, above: DataFrame, keep: dict[str, str]) -> DataFrame:
    """Each member of a bucket with its interval and the proof from it to the root."""
    schema = f"tree string, at bigint, lo bigint, hi bigint, proof {PROOF}, " + ", ".join(
        f"{n} {t}" for n, t in keep.items()
    )
    arrow = pa.list_(pa.struct([("digest", pa.binary()), ("before", pa.bool_())]))

    _, width, high = band

    def spread(batches):
        for batch in batches:
            for row, nodes in _walk(batch, width, high):
                base, proof = nodes[0], [(x["digest"], x["before"]) for x in row["proof"]]
                members = row["members"]
                columns = {
                    "tree": pa.array([row["tree"]] * len(base), pa.string()),
                    "at": pa.array([m["at"] for m in members], pa.int64()),
                    "lo": pa.array([b[0] for b in base], pa.int64()),
                    "hi": pa.array([b[1] for b in base], pa.int64()),
                    "proof": pa.array([siblings(nodes, i) + proof for i in range(len(base))], arrow),
                }
                for n in keep:
                    values = [m[n] if n in m else row[n] for m in members]
                    columns[n] = pa.array(values, pa.binary() if keep[n] == "binary" else pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return containing(band, above).mapInArrow(spread, schema)


def _down(forest: list[Band], above: DataFrame, keep: dict[str, str]) -> DataFrame:
    """The proofs of the lowest band's buckets, from those of the highest."""
    for band in reversed(forest[1:]):
        above = stage(descend(band, above, keep), "merkle-proofs")
    return above


def _tops(band: Band, *more: Column) -> DataFrame:
    """The only bucket of each tree at the highest band."""
    return band.buckets.select("tree", F.col("bucket").alias("at"), "lo", "hi", *more)


def conclude(band: Band, above: DataFrame) -> DataFrame:
    """One row per document: its proof, and what folding it gives."""
    schema = (
        "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean, leaf_rank bigint"
    )

    _, width, high = band

    def verify(batches):
        for batch in batches:
            for row, nodes in _walk(batch, width, high):
                above = [(x["digest"], x["before"]) for x in row["proof"]]
                text_above = b"".join(d.hex().encode() for d, _ in above)
                tops: dict[bytes, bytes] = {}
                out = {n: [] for n in ("doc_id", "leaf", "proof_sha256", "folded_root", "verified", "leaf_rank")}
                root = row["root"]
                for i, member in enumerate(row["members"]):
                    own = siblings(nodes, i)
                    claimed = member["tampered"] or member["digest"]
                    top = fold(claimed, own)
                    if top not in tops:
                        tops[top] = fold(top, above)
                    folded = tops[top]
                    text = b"".join(d.hex().encode() for d, _ in own) + text_above
                    out["doc_id"].append(member["doc_id"])
                    out["leaf"].append(member["digest"].hex())
                    out["proof_sha256"].append(sha256(text).hexdigest())
                    out["folded_root"].append(folded.hex())
                    out["verified"].append(folded == root)
                    out["leaf_rank"].append(nodes[0][i][0])
                size = len(row["members"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out["doc_id"], pa.int64()),
                        pa.array(out["leaf"]),
                        pa.array([row["subroot"].hex()] * size),
                        pa.array([root.hex()] * size),
                        pa.array(out["proof_sha256"]),
                        pa.array(out["folded_root"]),
                        pa.array(out["verified"]),
                        pa.array(out["leaf_rank"], pa.int64()),
                    ],
                    names=[f.split()[0] for f in schema.split(", ")],
                )

    return containing(band, above).mapInArrow(verify, schema)


def manifest(docs: DataFrame, tampered: Column, band: int = BAND) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256`` of every document as it is, and
    ``folded_root`` and ``verified`` of what ``tampered`` made of it. ``leaf_rank`` is
    its place in its language."""
    hashed = stage(leaves(docs, tampered), "merkle-leaves")
    nodes = ranked(hashed, "tree", "doc_id", "digest").select(
        "tree", F.col("lo").alias("at"), "n", F.col("n").alias("leaves"), "digest", "doc_id", "tampered"
    )
    low = bands(nodes, band, ("doc_id", "tampered"))
    subroots = _tops(low[-1], F.lit("").alias("forest"), F.col("top").alias("digest"))
    over = ranked(subroots.select("forest", F.col("tree").alias("member"), "digest"), "forest", "member")
    high = bands(
        over.select(F.col("forest").alias("tree"), F.col("lo").alias("at"), "n", F.col("n").alias("leaves"),
                    "digest", "member"),
        band,
        ("member",),
    )
    above = _tops(high[-1], F.array().cast(PROOF).alias("proof"), F.col("top").alias("root"))
    trees = descend(
        high[0],
        _down(high, above, {"root": "binary"}),
        {"root": "binary", "member": "string", "digest": "binary"},
    ).select(F.col("member").alias("tree"), "proof", "root", F.col("digest").alias("subroot"))
    above = _tops(low[-1]).join(stage(trees, "merkle-subroots"), "tree")
    return conclude(low[0], _down(low, above, {"root": "binary", "subroot": "binary"}))
