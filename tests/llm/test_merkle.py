"""The Merkle manifest against a plain tree built level by level."""

import random
import zlib
from hashlib import sha256

import pytest
from odd import CLASHING
from oracle import connect, differences
from pyspark.sql import functions as F

from dayledger.llm import merkle
from dayledger.llm import queries as Q
from dayledger.llm.common import fold

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def proofs(digests):
    """The root, and for each leaf its siblings (None where alone) and their sides."""
    level, at = list(digests), list(range(len(digests)))
    paths = [[] for _ in digests]
    while len(level) > 1:
        for path, i in zip(paths, at, strict=True):
            path.append((level[i ^ 1] if (i ^ 1) < len(level) else "", i % 2))
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def by_hand(rows):
    trees = {}
    for row in rows:
        trees.setdefault("" if row[2] is None else "=" + row[2], []).append(row)
    found, subroots = [], []
    names = sorted(trees, key=lambda t: t.encode())
    for name in names:
        rows = sorted(trees[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        root, paths = proofs([leaf(*r) for r in rows])
        subroots.append((root, rows, paths))
    root, over = proofs([s[0] for s in subroots])
    for (subroot, rows, paths), above in zip(subroots, over, strict=True):
        for row, path in zip(rows, paths, strict=True):
            i, text, lang, source, n = row
            tampered = i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and n is not None
            digest = leaf(i, text, lang, source, n + 1) if tampered else leaf(*row)
            for other, before in path + above:
                digest = h(other, digest) if before else h(digest, other)
            proof = h(*(o for o, _ in path + above))
            found.append((i, leaf(*row), subroot, root, proof, digest, digest == root))
    return found


def rows_of(found):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=str)


def random_rows(n, seed):
    draw = random.Random(seed)
    langs = ["en"] * 8 + ["de", "é", "", None, "z"]
    return [
        (
            draw.choice([None, draw.randrange(n)]) if draw.random() < 0.1 else draw.randrange(10 * n),
            draw.choice([None, "", "été", "x" * draw.randrange(9)]),
            draw.choice(langs),
            draw.choice([None, "web", "ñ"]),
            draw.choice([None, 0, 9, 2**63 - 1]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("n", [1, 17, 150])
def test_equals_a_tree_built_by_hand(spark, n):
    rows = random_rows(n, n)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(merkle.manifest(docs, fold("doc_id", 7, 0), band=2)) == sorted(by_hand(rows), key=str)


def test_bands_do_not_change_the_result(spark):
    rows = [*random_rows(2500, 7), *[(5, "same", "en", "web", 4)] * 40]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(merkle.manifest(docs, fold("doc_id", 7, 0))) == sorted(by_hand(rows), key=str)


def test_empty_table_and_clashing_names(spark):
    names = [*CLASHING, "tree", "lo", "hi", "at", "n", "leaf", "digest", "tampered", "members", "part", "root"]
    rows = random_rows(9, 3)
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("own").alias(c) for c in names))
    assert rows_of(merkle.manifest(docs, F.lit(False)))[0][6] is True
    assert merkle.manifest(docs.where(F.lit(False)), F.lit(True)).count() == 0


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = Q.op13_merkle_manifest(spark, folder)
    assert differences(found, connect(folder), Q.OP13_SQL) == []
