"""Exact, substring and line dedup against brute force."""

import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from odd import TEXTS, documents, plain
from pyspark.sql import functions as F

from dayledger.llm.exact_dedup import exact_dedup
from dayledger.llm.line_dedup import STRETCH, Lines, line_dedup, mark_lines
from dayledger.llm.substring_dedup import difference_cover, substring_dedup


def lower(text):
    return (text or "").encode().lower()


def test_exact_groups_of_odd_documents(spark):
    texts = [*TEXTS, (20, "AbC"), (21, "aBc"), (22, "abd"), (23, "É"), (24, "é")]
    found = exact_dedup(documents(spark, texts), prefix_chars=2).collect()
    groups = defaultdict(list)
    for i, t in texts:
        groups[lower(t)].append(i)
    assert len(found) == len(texts)
    assert sum(r["kept"] for r in found) == len(groups)
    size = {i: len(own) for own in groups.values() for i in own if i not in (7, None)}
    assert all(size.get(r["doc_id"], r["group_size"]) == r["group_size"] for r in found)
    for r in found:
        if r["text_sha256"] is not None:
            own = next(g for t, g in groups.items() if hashlib.sha256(t).hexdigest() == r["text_sha256"])
            assert r["keep_id"] == max((i for i in own if i is not None), default=None)
    # a unique length or prefix needs no full hash
    assert {r["doc_id"] for r in found if r["text_sha256"] is None} >= {8}
    assert exact_dedup(documents(spark).where(F.lit(False))).count() == 0


def gone_words(texts, window):
    """For each row the words that lie in windows of smaller ids."""
    holders = defaultdict(lambda: None)
    split = [((i, (t or "").encode().split())) for i, t in texts]
    for i, words in split:
        for k in range(len(words) - window + 1):
            seq = tuple(words[k : k + window])
            if i is not None and (holders[seq] is None or i < holders[seq]):
                holders[seq] = i
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            least = holders[tuple(words[k : k + window])]
            if i is not None and least is not None and least < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return Counter(out)


@pytest.mark.parametrize("period", range(1, 15))
def test_difference_covers(period):
    cover = difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert len(cover) <= period**0.5 * 1.5 + 1


@pytest.mark.parametrize("seed,window", [(1, 13), (2, 4), (3, 5), (4, 13)])
def test_substrings_of_random_documents(spark, seed, window):
    draw = random.Random(seed)
    passages = [[draw.choice("abcdefgh") for _ in range(draw.randint(3, 30))] for _ in range(12)]
    texts = []
    for i in range(60):
        words = []
        for _ in range(draw.randint(0, 5)):
            own = draw.choice(passages)
            at = draw.randint(0, 5)
            words += own[at : at + draw.randint(1, 30)] + [f"w{draw.randint(0, 9)}" for _ in range(draw.randint(0, 4))]
        texts.append((i if i % 17 else None, draw.choice([" ", "\n"]).join(words)))
    texts += texts[:3]
    found = substring_dedup(documents(spark, texts), window=window)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect())
    assert got == gone_words(texts, window)


def test_substrings_of_odd_documents(spark):
    found = substring_dedup(documents(spark)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found) == gone_words(TEXTS, 13)
    assert [r["spans"] for r in found if r["doc_id"] == 9][0][0].asDict() == {"first": 0, "past": 14}
    assert substring_dedup(plain(spark).where(F.lit(False))).count() == 0


def near(a, b):
    """Whether word sequences are one edit apart, or equal."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def dropped_lines(texts, min_words):
    places = []
    for row, (i, t) in enumerate(texts):
        for n, line in enumerate((t or "").encode().split(b"\n") if t else []):
            if line.split():
                places.append(((i if i is not None else float("inf"), n), row, line.split()))
    gone = [set() for _ in texts]
    for place, row, words in places:
        for other, _, own in places:
            if other < place and (
                words == own or (max(len(words), len(own)) >= min_words and near(words, own))
            ):
                gone[row].add(place[1])
                break
    return gone


def expected_lines(texts, min_words):
    gone = dropped_lines(texts, min_words)
    return Counter(
        (i, tuple(sorted(g)), "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in g))
        for (i, t), g in zip(texts, gone, strict=True)
    )


@pytest.mark.parametrize("seed,min_words", [(1, 4), (2, 6), (3, 2), (4, 10)])
def test_lines_of_random_documents(spark, seed, min_words):
    draw = random.Random(seed)
    lines = [[draw.choice("abc") for _ in range(draw.randint(1, 14))] for _ in range(25)]

    def varied():
        own = list(draw.choice(lines))
        for _ in range(draw.choice([0, 0, 1, 1, 2])):
            k = draw.randrange(len(own) + 1)
            own[k : k + draw.randint(0, 1)] = draw.choice([[], ["x"], ["a"], ["b"]])
        return draw.choice([" ", "  "]).join(own)

    texts = [(i if i % 13 else None, "\n".join(varied() for _ in range(draw.randint(0, 6)))) for i in range(40)]
    found = mark_lines(documents(spark, texts), min_words=min_words).select("rest.doc_id", "dropped", "text").collect()
    got = Counter((r["doc_id"], tuple(r["dropped"]), r["text"]) for r in found)
    assert got == expected_lines(texts, min_words)


def test_lines_of_odd_documents(spark):
    docs = documents(spark).withColumn("n_chars", F.length("text"))
    found = mark_lines(docs).select("rest.doc_id", "dropped", "text").collect()
    assert Counter((r["doc_id"], tuple(r["dropped"]), r["text"]) for r in found) == expected_lines(TEXTS, 10)
    cleaned = line_dedup(docs)
    assert cleaned.columns == docs.columns
    rows = {(r["doc_id"], r["n_chars"]): r for r in cleaned.collect()}
    assert rows[2, None]["text"] == "" and rows[2, None]["found"] == "own found"
    assert rows[9, 0]["text"] == "" and rows[6, 0]["text"] == ""
    assert line_dedup(docs.where(F.lit(False))).count() == 0


def test_lines_of_a_block_take_little_memory():
    """Beside the text; a word has some 6 bytes here. (Before: 25 times the text.)"""
    draw = np.random.default_rng(5)
    pick = ["a", "word", "some", "longer", "été", "words of", "line\n", "\n"]
    texts = [" ".join(draw.choice(pick, n)).encode() for n in [*draw.integers(0, 600, 600), 2 * STRETCH // 4, 0, 1]]
    rows = pa.table({"row_id": pa.array(range(len(texts))), "body": pa.array(texts, pa.binary())})
    size = sum(map(len, texts))
    tracemalloc.start()
    lines = Lines(rows)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = [(i, n, len(x.split())) for i, t in enumerate(texts) for n, x in enumerate(t.split(b"\n")) if x.split()]
    assert list(zip(lines.row_id.tolist(), lines.number.tolist(), lines.size.tolist(), strict=True)) == want
    assert size > 4 * STRETCH and most < 12 * size
