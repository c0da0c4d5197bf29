import numpy as np
import pytest
import xxhash
from odd import TEXTS, documents, plain
from pyspark.sql import functions as F

from dayledger.llm import simhash as S
from dayledger.llm.components import components


def by_hand(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(bits, max_bits):
    parent = list(range(len(bits)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    i, j = np.nonzero(np.triu(np.bitwise_count(bits[:, None] ^ bits[None]) <= max_bits, 1))
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return [top(x) for x in range(len(bits))]


def clustered(seed, n):
    """Distinct fingerprints, some in chains and balls of a few bits."""
    draw = np.random.default_rng(seed)
    bits = draw.integers(0, 2**64, n, np.uint64)
    for k in range(n // 2, n):
        flips = draw.choice(64, draw.integers(1, 4), replace=False)
        bits[k] = bits[draw.integers(0, k) if k % 3 else 0] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))
    return np.unique(bits)


@pytest.mark.parametrize("leaf,tile", [(16, 1000), (16, 9), (10_000, 50)])
def test_links_span_the_components(spark, leaf, tile):
    bits = clustered(leaf + tile, 700)
    frame = spark.createDataFrame([(int(b),) for b in bits.view(np.int64)], "bits long").repartition(3)
    found = S.links(frame, 2, sample=300, leaf=leaf, tile=tile).collect()
    of = {int(b): i for i, b in enumerate(bits.view(np.int64))}
    want = groups(bits, 2)
    parent = list(range(len(bits)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        a, b = of[r["a"]], of[r["b"]]
        assert want[a] == want[b]
        parent[max(top(a), top(b))] = min(top(a), top(b))
    assert [top(x) for x in range(len(bits))] == want
    assert len(found) < 40 * len(bits)


def test_each_pair_shares_a_leaf():
    bits = clustered(7, 2000)
    tree, leaves = S.grow(bits[::4], 20)
    assert leaves > 10
    lives, visits = {}, {}
    for leaf, rows, guest in S.homes(tree, bits, 2):
        for r, g in zip(rows.tolist(), guest.tolist(), strict=True):
            (visits if g else lives).setdefault(r, set()).add(leaf)
    assert all(len(lives[r]) == 1 for r in range(len(bits)))
    i, j = np.nonzero(np.triu(np.bitwise_count(bits[:, None] ^ bits[None]) <= 2, 1))
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        at_a, at_b = lives[a] | visits.get(a, set()), lives[b] | visits.get(b, set())
        assert lives[a] & at_b or lives[b] & at_a


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 205), (205, 203), (203, 200), (7, 7)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(1, 101)}, 203: 200, 205: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_documents(spark):
    found = S.near_duplicates(documents(spark)).collect()
    assert len(found) == len(TEXTS)
    prints = np.array([by_hand(t) for _, t in TEXTS], np.uint64)
    want = groups(prints, 2)
    least = {}
    for (i, _), g in zip(TEXTS, want, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    expected = sorted(
        (str(i), f"{int(p):016x}", str(least.get(g))) for (i, _), p, g in zip(TEXTS, prints, want, strict=True)
    )
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in found) == expected


def test_one_row_of_each_component_stays(spark):
    docs = documents(spark)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    rows = kept.select("doc_id", "text", "found").collect()
    want = groups(np.array([by_hand(t) for _, t in TEXTS], np.uint64), 2)
    member = {(i, t): g for (i, t), g in zip(TEXTS, want, strict=True)}
    assert sorted(member[r["doc_id"], r["text"]] for r in rows) == sorted(set(want))
    least = {}
    for (i, _), g in zip(TEXTS, want, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    assert all(r["doc_id"] == least.get(member[r["doc_id"], r["text"]]) for r in rows)
    assert all(r["found"] == "own found" for r in rows)
    assert S.keep_one(docs.where(F.lit(False))).count() == 0


def test_unrelated_texts_of_one_id_both_stay(spark):
    texts = ["alpha beta gamma delta epsilon", "one two three four five six seven", "alpha beta gamma delta epsilon"]
    docs = plain(spark, [(7, t) for t in texts] + [(None, "un id nul tout seul ici"), (None, "another without an id")])
    kept = sorted((r["doc_id"], r["text"]) for r in S.keep_one(docs).where("doc_id is not null").collect())
    assert kept == [(7, texts[0]), (7, texts[1])]
    assert S.keep_one(docs).where("doc_id is null").count() == 2


def test_sample_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id")
    rows = docs.select("doc_id", "text").collect()
    want = groups(np.array([by_hand(r["text"]) for r in rows], np.uint64), 2)
    found = {r["doc_id"]: r["component_id"] for r in S.near_duplicates(docs).collect()}
    assert [found[r["doc_id"]] for r in rows] == [rows[g]["doc_id"] for g in want]
