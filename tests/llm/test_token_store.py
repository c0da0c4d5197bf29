import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from odd import TEXTS, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayledger.llm import token_store as S

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = [
    "", "  ", "<|ENDOFTEXT|> A", "<|endoftext|>hello, World<|startoftext|>", "don't Won'T", "É é É",
    "Ωσ ΣΑΣ áb", "x y z 12ab!!c", "İstanbul ﬁ ½", "a\x1cb \x85 c", "日本語 テキスト", "a.b,c ''s 's", "́x y", "w,, (q) [z]\\",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def expected(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_words_encode_as_whole_texts_do(spark, tokenizer):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + ODD_TEXTS
    encoder = S.WordEncoder(Path(FILE).read_text(encoding="utf-8"))
    assert encoder.by_word and encoder.folds and encoder.pieces
    for text, ids in zip(texts, encoder([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_forgetting_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(S, "REMEMBERED_WORDS", 3)
    encoder = S.WordEncoder(Path(FILE).read_text(encoding="utf-8"))
    for text in ODD_TEXTS * 2:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder([text.encode()])[0], "<i4").tolist() == ids


def test_other_tokenizers_get_whole_texts():
    encoder = S.WordEncoder(Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8"))
    assert not encoder.by_word
    whole = encoder.tokenizer.encode("two  words", add_special_tokens=False).ids
    assert np.frombuffer(encoder([b"two  words"])[0], "<i4").tolist() == whole


def test_positions_follow_the_ids_of_documents(spark, tokenizer, tmp_path):
    S.write_tokens(documents(spark), str(tmp_path / "t"), FILE, files=3)
    rows = S.with_crc(S.read_tokens(spark, str(tmp_path / "t"))).collect()
    want = Counter((i, tuple(expected(tokenizer, t))) for i, t in TEXTS)
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in TEXTS)
    by_start = sorted(rows, key=lambda r: r["start"])
    assert [r["start"] for r in by_start] == np.cumsum([0] + [r["n_tokens"] for r in by_start[:-1]]).tolist()
    ids = [r["doc_id"] if r["doc_id"] is not None else -1 for r in by_start]
    assert ids == sorted(ids)
    sums = Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    assert sums == Counter(
        {(i, len(t), zlib.crc32(np.array(t, "<u4").tobytes())): n for (i, t), n in want.items()}
    )


def test_files_have_the_stated_encodings_and_indexes(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    S.write_tokens(docs, str(tmp_path / "t"), FILE, files=2, row_group_bytes=1 << 18, page_bytes=1 << 13)
    groups = 0
    for file in (tmp_path / "t" / "tokens").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        groups += meta.num_row_groups
        columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert "RLE_DICTIONARY" in columns["tokens.list.element"].encodings
        assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    assert groups > 4


def test_selective_reads(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = str(tmp_path / "t")
    S.write_tokens(docs, path, FILE, files=4)
    whole = {r["doc_id"]: r for r in S.read_tokens(spark, path).collect()}
    some = S.read_tokens(spark, path, ids=(10, 19)).collect()
    assert {r["doc_id"]: r for r in some} == {i: whole[i] for i in range(10, 20)}
    at = whole[50]["start"]
    covering = S.read_tokens(spark, path, span=(at, at + whole[50]["n_tokens"])).collect()
    assert sorted(r["doc_id"] for r in covering) == [50, 51]
    plan = S.read_tokens(spark, path, ids=(10, 19)).select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    scan = plan[plan.rindex("Physical Plan") :]
    assert "GreaterThanOrEqual(doc_id,10)" in scan and "tokens:array" not in scan


def test_no_documents(spark, tmp_path):
    S.write_tokens(documents(spark).where(F.lit(False)), str(tmp_path / "t"), FILE, files=2)
    assert S.read_tokens(spark, str(tmp_path / "t")).count() == 0


def test_words_of_letters_and_marks_are_learned_together(tokenizer, monkeypatch):
    draw = np.random.default_rng(3)
    pick = lambda of, n: "".join(draw.choice(list(of), n))
    words = [pick("abeinrst\xdf\xe9\xf8\xf7\xd7\u0101'1", a) + pick(".,!()\"'-_x\n", b).strip() for a, b in draw.integers(0, 7, (600, 2))]
    encoder = S.WordEncoder(Path(FILE).read_text(encoding="utf-8"))
    taken, learn = [], encoder._learn_pieces
    monkeypatch.setattr(encoder, "_learn_pieces", lambda pieces: taken.append(len(pieces)) or learn(pieces))
    for text in (" ".join(words), "  ".join(words[::-1])):
        assert np.frombuffer(encoder([text.encode()])[0], "<i4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert max(taken) > 100 and len(taken) <= 2


def test_words_in_use_are_not_learned_again(tokenizer, monkeypatch):
    monkeypatch.setattr(S, "REMEMBERED_WORDS", 3)
    encoder = S.WordEncoder(Path(FILE).read_text(encoding="utf-8"))
    learned, learn = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: learned.append(sorted(words)) or learn(words))
    for text in (b"the cat, sat on", b"the dog sat,", b"the dog ran"):
        assert np.frombuffer(encoder([text])[0], "<i4").tolist() == tokenizer.encode(text.decode(), add_special_tokens=False).ids
    assert learned == [[b"cat,", b"on", b"sat", b"the"], [b"dog", b"sat,"], [b"ran"]]
    assert set(encoder.known) == {b"the", b"dog", b"ran"}
