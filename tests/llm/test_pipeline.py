import pytest
import sentencepiece
from odd import documents
from pyspark.sql import functions as F
from test_decontaminate import hits
from test_dedup import dropped_lines
from test_simhash import by_hand, groups

import numpy as np
import public_tokenizers

import __spark_entry__ as driver
import corpus_pipeline as P
from dayledger.llm.common import stage, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage leaves of the sample documents."""
    docs, out = table(spark, FOLDER, "documents"), []
    out.append(sorted((r["doc_id"], r["text"]) for r in docs.collect()))
    for name, apply in P.STAGES:
        docs = stage(apply(spark, docs, FOLDER), name)
        if name != P.STAGES[-1][0]:
            assert docs.columns == table(spark, FOLDER, "documents").columns
            out.append(sorted((r["doc_id"], r["text"]) for r in docs.collect()))
    return out, {r["doc_id"]: r for r in docs.collect()}


def test_language_keeps_all_with_letters(kept):
    before, after = kept[0][0], kept[0][1]
    assert after == [r for r in before if any(c.isalpha() for c in r[1] or "")]


def test_lines_go_as_by_hand(kept):
    before, after = kept[0][1], kept[0][2]
    gone = dropped_lines(before, 10)
    assert any(gone)
    assert after == [
        (i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in g)) for (i, t), g in zip(before, gone, strict=True)
    ]


def test_one_of_each_group_stays(kept):
    before, after = kept[0][2], kept[0][3]
    first = groups(np.array([by_hand(t) for _, t in before], np.uint64), 2)
    assert after == [before[k] for k in sorted(set(first))]


def test_contaminated_documents_go(spark, kept):
    before, after = kept[0][3], dict(kept[0][4])
    items = [(r["item_id"], r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
    found = {int(i): (n, h) for i, n, h, _ in hits(before, items, 13)}
    assert sorted(after) == sorted(i for i, (n, h) in found.items() if not (h and 20 * h >= n))
    assert all(after[i] == t for i, t in before if i in after and found[i][1] == 0)
    assert all(len(after[i]) < len(t) for i, t in before if i in after and found[i][1])


def test_pieces_are_those_of_the_library(kept):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    before, rows = kept[0][4], kept[1]
    assert sorted(rows) == [i for i, _ in before]
    assert all(rows[i]["ids"] == library.encode(t) and rows[i]["round_trip"] for i, t in before)


def test_run_applies_all_stages(spark, kept):
    found = driver.queries()["pipeline"](spark, FOLDER).collect()
    assert {r["doc_id"]: r["ids"] for r in found} == {i: r["ids"] for i, r in kept[1].items()}


def test_odd_documents(spark):
    docs = documents(spark).withColumn("lang", F.lit("en"))
    for name, apply in P.STAGES:
        assert apply(spark, docs.where(F.lit(False)), FOLDER).count() == 0
        docs = stage(apply(spark, docs, FOLDER), name)
        assert docs.count() > 0
