import numpy as np
from odd import TEXTS, documents
from pyspark.sql import functions as F

from dayledger.llm import language_id as L
from dayledger.llm.queries import op3_language_id

FOLDER = "/root/testdata/sf0.01"


def test_folded_tables_equal_the_filters():
    draw = np.random.default_rng(1)
    net = L.train(draw.integers(0, 256, (64, L.WINDOW), np.uint8), draw.integers(0, 2, 64), ["a", "b"], epochs=1)
    data = draw.integers(0, 256, (5, L.WINDOW), np.uint8)
    x = net.embedding[data]
    pooled = []
    for f, b in zip(net.filters, net.biases, strict=True):
        n = L.WINDOW - len(f) + 1
        pooled.append((sum(x[:, k : n + k] @ f[k] for k in range(len(f))) + b).max(axis=1))
    assert np.allclose(net.features(data), np.maximum(np.concatenate(pooled, axis=1), 0), atol=1e-4)


def test_gradients_equal_differences():
    draw = np.random.default_rng(2)
    data, targets, weight = draw.integers(0, 256, (6, L.WINDOW), np.uint8), np.array([0, 1, 2, 0, 1, 2]), np.ones(3)
    net = L.train(data, targets, ["a", "b", "c"], epochs=1)

    def loss():
        net.fold()
        return -np.log(net.probabilities(data)[np.arange(6), targets].astype(np.float64)).mean()

    found = L._gradients(net, data, targets, weight)
    for w, g in zip([net.dense, net.offset, net.filters[1]], [found[-2], found[-1], found[2]], strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, step = w[at], 1e-3  # a larger one crosses switches of the max pooling
        w[at] = keep + step
        up = loss()
        w[at] = keep - step
        down = loss()
        w[at] = keep
        assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 1e-3


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    held = [r for r in op3_language_id(spark, FOLDER).collect() if r["held_out"]]
    assert len(held) > 200
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in held)


def test_only_the_text_decides(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    net = L.fit(docs)
    one = L.predict(docs, net).select("text", "lang_pred", "score")
    two = L.predict(docs.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.lit(1)), net)
    assert sorted(one.collect()) == sorted(two.select("text", "lang_pred", "score").collect())


def test_odd_documents(spark):
    net = L.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    found = L.predict(documents(spark), net)
    assert found.count() == len(TEXTS)
    rows = {(r["doc_id"], r["text"]): r for r in found.collect()}
    for key in ((2, None), (3, ""), (4, " \n\t \n"), (8, "12345 !!! ...")):
        assert rows[key]["lang_pred"] == "und" and rows[key]["score"] == 0
    assert rows[1, TEXTS[0][1]]["lang_pred"] in net.labels and rows[1, TEXTS[0][1]]["found"] == "own found"
    assert L.predict(documents(spark).where(F.lit(False)), net).count() == 0


def test_nothing_to_learn_from(spark):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert L.fit(docs) is None
    assert {r["lang_pred"] for r in L.predict(docs, None).collect()} == {"und"}


def test_rare_languages_and_rows_without_letters(spark, monkeypatch):
    """A label on 3 of 4,003 rows is learned, and rows without a letter take no place."""
    rows = [(k, f"common words {k}", "aa") for k in range(1000)] + [(k, f"other words {k}", "bb") for k in range(1000, 1200)]
    rows += [(k, "12 34", "aa") for k in range(2000, 4800)] + [(k, f"seldom {k}", "cc") for k in range(5000, 5003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = {}
    monkeypatch.setattr(L, "train", lambda data, targets, labels: seen.update(n=np.bincount(targets).tolist(), labels=labels))
    L.fit(docs, sample_rows=100)
    assert seen == {"n": [49, 48, 3], "labels": ["aa", "bb", "cc"]} or seen == {"n": [48, 49, 3], "labels": ["aa", "bb", "cc"]}
    L.fit(docs, sample_rows=2)
    assert seen["labels"] == ["aa", "bb", "cc"]
