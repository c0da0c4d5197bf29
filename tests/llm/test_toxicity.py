import random

import numpy as np
import pytest
from odd import TEXTS, documents
from pyspark.sql import functions as F

from dayledger.llm import toxicity as T

BAD = ["wretch", "oaf", "knave"]


def texts(seed, n):
    """Random words; every third text has a few bad ones somewhere."""
    draw = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    out, labels = [], []
    for k in range(n):
        words = ["".join(draw.choices(syllables, k=draw.randint(1, 3))) for _ in range(draw.randint(5, 150))]
        if k % 3 == 0:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(BAD))
        out.append(" ".join(words))
        labels.append(int(k % 3 == 0))
    return out, np.array(labels)


@pytest.fixture(scope="module")
def net():
    own, labels = texts(1, 700)
    return T.train([t.encode() for t in own], labels)


def scores(net, own):
    parts = [t.encode() for t in own]
    offsets = np.cumsum([0, *map(len, parts)])
    return T.text_scores(net, np.frombuffer(b"".join(parts), np.uint8), offsets)


def test_held_out_accuracy(net):
    own, labels = texts(2, 200)
    found = scores(net, own) >= T.THRESHOLD
    assert found[labels == 1].mean() > 0.9 and found[labels == 0].mean() < 0.1


def test_every_window_counts(net):
    """Bad words at the very end of a long text, or across two windows, are met."""
    clean = texts(3, 60)[0]
    long = " ".join(t for k, t in enumerate(clean) if k % 3)
    for place in (long + " wretch knave oaf", "oaf knave wretch " + long, long + " wretch oaf knave " + long):
        assert scores(net, [place])[0] >= T.THRESHOLD


def test_a_text_scores_alike_in_any_company(net):
    own = [texts(4, 12)[0][k] for k in range(12)] + ["", "one"]
    assert np.allclose(scores(net, own), [scores(net, [t])[0] if t else 0 for t in own], atol=1e-4)


def test_gradients_equal_differences():
    net = T.Network.fresh(3)
    number, doc, vocabulary = T.read_texts([t.encode() for t in texts(5, 6)[0]])
    rows, own = T.windows(number, doc, 6)
    targets = (own % 2).astype(np.float32)

    def loss():
        logits = T._logits(net, vocabulary, rows).astype(np.float64)
        return np.mean(np.logaddexp(0, logits) - targets * logits)

    for w, g in zip(net.weights(), T.gradients(net, vocabulary, rows, targets), strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, step = w[at], 2e-2
        w[at] = keep + step
        up = loss()
        w[at] = keep - step
        down = loss()
        w[at] = keep
        assert abs((up - down) / (2 * step) - g[at]) < 0.03 * abs(g[at]) + 2e-4


def test_windows_overlap_and_cover():
    doc = np.repeat([0, 2, 3], [3, T.WINDOW + 1, 5 * T.WINDOW])
    rows, own = T.windows(np.arange(len(doc)), doc, 5)
    for d in (0, 2, 3):
        assert set(rows[own == d].ravel().tolist()) - {-1} == set(np.flatnonzero(doc == d).tolist())
    assert not (own == 1).any() and (own == 3).sum() >= 9


def test_odd_documents(spark, net):
    found = T.score(documents(spark), net)
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert {r["score"] for r in rows if not (r["text"] or "").strip()} == {0.0}
    assert {r["found"] for r in rows} == {"own found"}
    assert T.score(documents(spark).where(F.lit(False)), net).count() == 0
    assert {r["score"] for r in T.score(documents(spark), None).collect()} == {0.0}


def test_nothing_to_learn_from(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (5, 1), (6, None), (9, 1), (2, 0), (99, 0)], "doc_id long, toxic int")
    assert T.fit(docs, labels) is None
    assert T.fit(docs, labels.where("toxic is null")) is None


def test_the_sample_is_bounded_and_balanced(spark, monkeypatch):
    own, labels = texts(6, 400)
    docs = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")
    docs = docs.unionByName(spark.createDataFrame([(1000, "long text " * 5000)], "doc_id long, text string"))
    marks = spark.createDataFrame([(k, int(x)) for k, x in enumerate(labels)] + [(1000, 1)], "doc_id long, toxic int")
    seen = {}
    monkeypatch.setattr(T, "train", lambda parts, targets: seen.update(parts=parts, targets=targets))
    T.fit(docs, marks, sample_rows=(30, 20))
    assert seen["targets"].tolist() == [0] * 30 + [1] * 20 and {t.decode() for t in seen["parts"]} <= set(own)
    T.fit(docs, marks, sample_rows=(1000, 1000))
    assert len(seen["parts"]) == 401 and max(map(len, seen["parts"])) <= T.WHOLE_CHARS + 40


def test_repeated_ids_are_one_example(spark, monkeypatch):
    rows = [(i % 4, f"text {i}") for i in range(200)] + [(i, f"other {i}") for i in range(10, 30)] + [(1, None), (2, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, i % 2) for i in range(30)] * 5 + [(0, 1), (3, None)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    seen = {}
    monkeypatch.setattr(T, "train", lambda texts, targets: seen.update(texts=texts, targets=targets.tolist()))
    T.fit(docs, labels, sample_rows=(50, 50))
    assert len(seen["texts"]) == 24 and sum(seen["targets"]) == 13
    assert {b"text 0", b"text 1", b"text 10", b"text 103"} <= set(seen["texts"])
    T.fit(docs, labels, sample_rows=(3, 2))
    assert len(seen["texts"]) == 5
