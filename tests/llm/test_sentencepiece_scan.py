import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from odd import TEXTS, documents
from pyspark.sql import functions as F

from dayledger.llm import sentencepiece_scan as S

FILE = public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = [
    "", "  ", "  x ", "a  b\tc\n\nd", "▁x", "é中🦙\x00z", "<s> </s> <unk>", "ﬁ Ａ", "a" * 70, " " * 40 + "x",
    "中文字符测试没有空格的长文本" * 5, "http://www.example.com/path?x=1&y=2", "    def f(x):\n        return x", "▁▁ ▁",
]


def random_texts(seed, n, letters=" abcdeinorst,.\n'éü中"):
    draw = random.Random(seed)
    return ["".join(draw.choices(letters, k=draw.randint(1, 200))) for _ in range(n)]


@pytest.fixture(scope="module")
def lattice():
    with open(FILE, "rb") as file:
        return S.Lattice(file.read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def ids(raw):
    return np.frombuffer(raw, "<i4").tolist()


def test_encodes_and_decodes_as_the_library(spark, lattice, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    with open(FILE, "rb") as file:
        pieces = S.Pieces(file.read())
    for text in [r["text"] for r in docs] + ODD_TEXTS + random_texts(1, 300):
        assert ids(lattice.encode(text)) == library.encode(text)
        own = np.array(library.encode(text), np.int64)
        assert pieces(own, np.array([len(own)]))[0].decode("utf-8", "replace") == library.decode(own.tolist())


def chunks(lattice, text, size):
    line = S.SPACE + text.replace(" ", S.SPACE)
    out = []
    for low in range(0, len(line), size):
        begin, high = max(0, low - lattice.longest), min(len(line), low + size)
        out.append((line[begin : high + lattice.longest], low - begin, high - begin))
    return out


@pytest.mark.parametrize("size", [17, 20, 33, 64])
def test_chunks_give_the_same_wherever_they_are_cut(lattice, library, size):
    texts = ODD_TEXTS + random_texts(size, 200) + random_texts(size, 60, "abcdeinorst") + random_texts(size, 40, " a")
    for text in filter(None, texts):
        own = chunks(lattice, text, size)
        states = S.path_states([lattice.matrix(*c) for c in own])
        parts = [lattice.chunk(*c, states[k], states[k + 1]) for k, c in enumerate(own)]
        assert ids(b"".join(parts)) == library.encode(text)


def test_products_are_associative(lattice):
    text = random_texts(9, 1, "abcdeinorst")[0] * 3
    matrices = [lattice.matrix(*c) for c in chunks(lattice, text, 20)]
    assert any(len(m) > 1 for m in matrices)
    one, two, three = matrices[1:4]
    assert S.combine(S.combine(one, two), three) == S.combine(one, S.combine(two, three))
    running, want = matrices[0], [matrices[0]]
    for m in matrices[1:]:
        running = S.combine(running, m)
        want.append(running)
    assert S.prefixes(matrices) == want


@pytest.mark.parametrize("chunk", [40, 1 << 15])
def test_odd_documents(spark, library, chunk):
    texts = TEXTS + [(100 + k, t) for k, t in enumerate(ODD_TEXTS + random_texts(5, 30))]
    found = S.decode(S.encode(documents(spark, texts), FILE, chunk=chunk), FILE)
    rows = found.select("doc_id", "ids", "decoded", "found").collect()
    want = [(i, tuple(library.encode(t or ""))) for i, t in texts]
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == Counter(want)
    assert Counter(r["decoded"] for r in rows) == Counter((t or "").replace("▁", " ") for _, t in texts)
    assert {r["found"] for r in rows} == {"own found"}
    trips = S.round_trips(documents(spark, texts), FILE, chunk=chunk).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in trips) == Counter(want)
    assert {r["round_trip"] for r in trips} == {True} and {r["found"] for r in trips} == {"own found"}
    assert S.encode(documents(spark).where(F.lit(False)), FILE).count() == 0


def test_new_words_of_many_texts_are_worked_on_together(library, monkeypatch):
    with open(FILE, "rb") as file:
        lattice = S.Lattice(file.read())
    texts = ODD_TEXTS + random_texts(11, 300) + random_texts(12, 100, "abcdeinorst") + ["", "x 中y🦙z."]
    taken, learn = [], lattice.learn_parts
    monkeypatch.setattr(lattice, "learn_parts", lambda parts: taken.append(len(parts)) or learn(parts))
    assert [ids(raw) for raw in lattice.encode_all(texts)] == [library.encode(t) for t in texts]
    assert len(taken) == 1 and taken[0] > 500
    assert [ids(raw) for raw in lattice.encode_all(texts[::-1])] == [library.encode(t) for t in texts[::-1]]
    assert len(taken) == 1


def test_parts_of_all_sizes_alone(lattice):
    """The same path as a walk over one text at a time finds."""
    parts = sorted({t.replace(" ", S.SPACE) for t in random_texts(13, 400, "aeinorst▁")} | {"a", "▁", "é中", "🦙a", "\x00"})
    lattice.known_parts.clear()
    lattice.learn_parts(parts)
    assert [ids(lattice.known_parts[p]) for p in parts] == [lattice.numbers(lattice.pieces_of(p)) for p in parts]
    lattice.learn_parts([])


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(S, "REMEMBERED", 3)
    with open(FILE, "rb") as file:
        lattice = S.Lattice(file.read())
    for text in ODD_TEXTS * 2 + random_texts(14, 20):
        assert ids(lattice.encode(text)) == library.encode(text)


class Counting(dict):
    """Counts how often it is asked for one key."""

    asked = 0

    def __contains__(self, key):
        Counting.asked += 1
        return super().__contains__(key)

    def __getitem__(self, key):
        Counting.asked += 1
        return super().__getitem__(key)

    def get(self, key, default=None):
        Counting.asked += 1
        return super().get(key, default)


def test_known_pairs_are_looked_up_together():
    """(Before: each distinct pair of a step one by one, twice.)"""
    with open(FILE, "rb") as file:
        lattice = S.Lattice(file.read())
    words = sorted({f" {w}" for t in random_texts(15, 400, "aeinorst ") for w in t.split()})
    lattice.learn_words(words)
    found = dict(lattice.words)
    lattice.known_parts.clear()
    lattice.number_pairs = Counting(lattice.number_pairs)
    lattice.learn_words(words)
    assert lattice.words == found and len(lattice.number_pairs) > 1000
    assert Counting.asked < len(lattice.number_pairs) / 10, Counting.asked


def test_pairs_that_share_a_slot_keep_their_answers(library, monkeypatch):
    monkeypatch.setattr(S, "PAIR_BITS", 3)
    with open(FILE, "rb") as file:
        lattice = S.Lattice(file.read())
    texts = random_texts(16, 200) + ODD_TEXTS
    assert [ids(raw) for raw in lattice.encode_all(texts)] == [library.encode(t) for t in texts]


@pytest.mark.parametrize("size", [0, 1, 40, 5000])
def test_ranks_are_those_of_the_order(size):
    draw = np.random.default_rng(size)
    values = np.unique(draw.integers(0, 1 << 45, size)) if size != 40 else np.arange(40)
    ranks = S.Ranks(draw.permutation(values))
    asked = np.concatenate([values, values + 1, draw.integers(0, 1 << 45, 99)])
    at, there = ranks.find(asked)
    assert (there == np.isin(asked, values)).all() and (values[at[there]] == asked[there]).all()
