import random
import re

import pytest
from odd import TEXTS, documents, plain
from pyspark.sql import functions as F

from dayledger.llm import decontaminate as D

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text):
    return WORDS.findall((text or "").encode().lower())


def hits(texts, items, window):
    out = []
    for i, t in texts:
        words = words_of(t)
        mask, own = [False] * len(words), set()
        for item, text in items:
            w = words_of(text)
            n = min(window, len(w))
            parts = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
            for k in range(len(words) - n + 1 if n else 0):
                if tuple(words[k : k + n]) in parts:
                    mask[k : k + n] = [True] * n
                    own.add(str(item) if item is not None else "")
        out.append((str(i), len(words), sum(mask), ",".join(sorted(own))))
    return sorted(out)


def got(frame):
    rows = frame.select("doc_id", "found.n_words", D.n_hit().alias("n_hit"), "found.items").collect()
    return sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], ",".join(r["items"])) for r in rows)


@pytest.mark.parametrize("seed,window,shard_words", [(1, 5, 10**6), (2, 13, 10**6), (3, 4, 12), (4, 3, 5)])
def test_random_texts(spark, seed, window, shard_words):
    draw = random.Random(seed)
    items = [(k, " ".join(draw.choice("abcd") for _ in range(draw.randint(0, 20)))) for k in range(15)]
    items += [(15, None), (None, "d d a"), (3, "b b b b a"), (3, "b b b b a")]
    texts = []
    for i in range(50):
        words = [draw.choice("abcdefg") for _ in range(draw.randint(0, 40))]
        for _ in range(draw.randint(0, 2)):
            own = (draw.choice(items)[1] or "").split()
            words[draw.randint(0, len(words)) :] += own[draw.randint(0, 4) :]
        texts.append((i, draw.choice([" ", ", ", "--\n"]).join(words)))
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    found = D.find_items(plain(spark, texts), benchmark, window=window, shard_words=shard_words)
    assert got(found) == hits(texts, items, window)


def test_odd_documents(spark):
    items = [(1, TEXTS[0][1]), (2, "Été, ñandú!"), (3, ""), (4, "中文")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark)
    assert got(D.find_items(docs, benchmark)) == hits(TEXTS, items, 13)
    kept = D.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["found"] for r in kept.collect()} == {"own found"}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(
        i for i, n, h, _ in hits(TEXTS, items, 13) if not (h and 20 * h >= n)
    )
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(docs, empty).count() == len(TEXTS)
    assert D.decontaminate(docs.where(F.lit(False)), benchmark).count() == 0


def test_spans_are_cut_out_below_the_limit(spark):
    item = "p q r s"
    long = " ".join(f"w{k}" for k in range(100))
    texts = [(1, f"{long}, P Q-R s! {long}"), (2, long), (3, item), (4, None)]
    docs = plain(spark, texts).withColumn("n_chars", F.length("text"))
    benchmark = spark.createDataFrame([(1, item)], "item_id int, text string")
    rows = {r["doc_id"]: r for r in D.decontaminate(docs, benchmark).collect()}
    assert rows[1]["text"] == f"{long}, ! {long}" and rows[1]["n_chars"] == len(rows[1]["text"])
    assert rows[2]["text"] == long and rows[4]["text"] is None and 3 not in rows
