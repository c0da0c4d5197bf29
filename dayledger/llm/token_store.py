"""Token ids of documents in Parquet files made for selective reads.

Documents are dealt into files by ranges of their id and encoded in id order, so a
file holds a contiguous stretch of the corpus. Ids are dictionary-encoded list
columns, ids of documents and positions delta-encoded; row groups and pages are
small enough, and the page index is written, for a reader to fetch a few documents
or the metadata columns alone. A small index holds the position each file starts
at; it has a row per file.
"""

from __future__ import annotations

import re
import zlib
from itertools import chain, compress, pairwise
from operator import add
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayledger.llm.common import partitions, text_of, tidy

END_ID = 1
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
FILE_SCHEMA = "doc_id bigint, part int, part_start bigint, n_tokens int, tokens array<int>"

#: Distinct words whose ids a worker remembers; beyond it, it goes on with those that
#: the texts at hand have as well, mostly frequent ones.
REMEMBERED_WORDS = 500_000


class WordEncoder:
    """Encodes texts word by word, remembering words it has met.

    That equals encoding whole texts for a tokenizer that never joins over white
    space, which ``splits_on_space`` tests; other tokenizers get whole texts. Words
    of plain letters with marks behind them go straight to the model, piece by piece,
    where ``takes_pieces`` finds that the tokenizer does the same.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.by_word = splits_on_space(self.tokenizer)
        self.folds = self.by_word and self._ids(["AZ"]) == self._ids(["az"])
        self.pieces = self.folds and takes_pieces(self)
        self.known: dict[bytes, bytes] = {}
        self.known_pieces: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [pack(f"<{len(e)}i", *e.ids) for e in found]

    def piece(self, text: str) -> bytes:
        """The ids of a run of letters, or of other marks."""
        self._learn_pieces({text})
        return self.known_pieces[text]

    def _learn_pieces(self, texts: set[str]) -> None:
        new = list(texts.difference(self.known_pieces))
        if not new:
            return
        # all are written as the model's characters in one go
        plain = BYTE_CHARACTERS[np.frombuffer("\n".join(new).encode(), np.uint8)].tobytes().decode("utf-32-le")
        tokenize, ids, ends = self.tokenizer.model.tokenize, [], [0]
        for text in plain.split(LINE_END):
            ids += [t.id for t in tokenize(text)]
            ends.append(4 * len(ids))
        data = np.array(ids, "<i4").tobytes()
        self.known_pieces.update(zip(new, (data[a:b] for a, b in pairwise(ends)), strict=True))

    def _learn(self, words: list[bytes]) -> None:
        if self.pieces and words:
            texts = b"\n".join(words).decode().split("\n")
            marks = [text.lstrip(LETTERS) for text in texts]
            plain_ends = {end for end in set(marks) if MARKS.fullmatch(end)}
            split = [end in plain_ends and end != text for text, end in zip(texts, marks, strict=True)]
            texts, marks = list(compress(texts, split)), list(compress(marks, split))
            letters = list(map(str.removesuffix, texts, marks))
            self._learn_pieces({*letters, *marks})
            get = self.known_pieces.__getitem__
            self.known.update(zip(compress(words, split), map(add, map(get, letters), map(get, marks)), strict=True))
            words = [word for word, own in zip(words, split, strict=True) if not own]
        self.known.update(zip(words, self._ids([w.decode() for w in words]), strict=True))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        if not self.by_word:
            return self._ids([t.decode() for t in texts])
        # a special token's own string must keep its case
        words = [(t.lower() if self.folds and b"<|" not in t else t).split() for t in texts]
        every = set(chain.from_iterable(words))
        if len(self.known) + len(self.known_pieces) > REMEMBERED_WORDS:
            self.known = {w: self.known[w] for w in every.intersection(self.known)}
            self.known_pieces.clear()
        self._learn(list(every.difference(self.known)))
        del every
        get = self.known.__getitem__
        return [b"".join(map(get, own)) for own in words]


#: Lower-case letters up to U+00FF.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
#: ASCII marks other than the apostrophe.
MARKS = re.compile(r"[!-&(-/:-@\[-`{-~]*")


def _byte_characters() -> np.ndarray:
    """The characters that byte-level vocabularies write bytes as: printable ones as
    they are, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    characters = np.arange(256, dtype="<u4")
    characters[others] = 0x100 + np.arange(len(others))
    return characters


BYTE_CHARACTERS = _byte_characters()
LINE_END = chr(BYTE_CHARACTERS[0x0A])


def takes_pieces(encoder: WordEncoder) -> bool:
    """Whether the tokenizer encodes letters and the marks behind them apart, each as
    the model alone does."""
    encoder.known_pieces = {}
    letters = ["a", "the", "ouèque", "straße", "ñandú", "øåæþð", "ÿ", "zzxqvw", "ciónlla"]
    marks = [chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'"] + ["", ".,", "!!", "...", "|)", "&&&"]
    return all(encoder._ids([a + m])[0] == encoder.piece(a) + (encoder.piece(m) if m else b"") for a in letters for m in marks)


def splits_on_space(tokenizer: Tokenizer) -> bool:
    """Whether white space only separates words: it leaves no ids of its own, and
    words next to it are encoded as if alone."""
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    words = ["the", "Of", "don't", "12", ",", "a.b", "été", "́x", "<|endoftext|>", "'s"]
    alone = [ids(w) for w in words]
    return all(
        ids(f"{a}{space}{b}") == x + y
        for a, x in zip(words, alone, strict=True)
        for b, y in zip(words, alone, strict=True)
        for space in (" ", "\n", " \t\r\n\v\f ")
    )


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    id_column: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    files: int | None = None,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Encode every text, append ``end_id``, and write ``path``/tokens and /index.

    Null texts count as empty and give the end id alone. Files and rows ascend by
    document id, nulls first; rows that repeat an id follow each other by a hash of
    their text. An empty table gives files without rows. Other columns are not read.
    The vocabulary file is read on the driver and broadcast: a few MB.
    """
    spark = docs.sparkSession
    vocabulary = open(tokenizer_file, encoding="utf-8").read()
    shared = spark.sparkContext.broadcast(vocabulary)
    files = files or partitions(spark)
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), text_of(text).cast("binary").alias("text")
    )
    order = ("doc_id", F.xxhash64("text"))
    ordered = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)

    def encode(batches):
        part, start = TaskContext.get().partitionId(), 0
        encoder, last = _encoder(shared), np.array([end_id], "<i4").tobytes()
        for batch in batches:
            ids = batch.column(0)
            texts = batch.column(1)
            for low in range(0, len(texts), 2000):
                own = encoder(texts.slice(low, 2000).to_pylist())
                sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4 + 1
                ends = np.cumsum(sizes)
                flat = np.frombuffer(last.join([*own, b""]), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(low, 2000),
                        pa.array(np.full(len(own), part, np.int32)),
                        pa.array(start + ends - sizes),
                        pa.array(sizes.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), flat),
                    ],
                    names=["doc_id", "part", "part_start", "n_tokens", "tokens"],
                )
                start += int(ends[-1])

    options = {
        "compression": "zstd",
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.enable.dictionary": "true",
        **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part_start", "n_tokens")},
    }
    ordered.mapInArrow(tidy(encode), FILE_SCHEMA).write.options(**options).parquet(f"{path}/tokens")
    (
        spark.read.schema(FILE_SCHEMA)
        .parquet(f"{path}/tokens")
        .groupBy("part")
        .agg(
            F.sum("n_tokens").alias("n_tokens"),
            F.count(F.lit(1)).alias("n_docs"),
            F.min("doc_id").alias("first_id"),
            F.max("doc_id").alias("last_id"),
        )
        .withColumn("file_start", F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens"))
        .coalesce(1)
        .write.parquet(f"{path}/index")
    )


_encoders: dict[int, WordEncoder] = {}


def _encoder(shared) -> WordEncoder:
    """One encoder for each worker process and vocabulary."""
    key = hash(shared.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(shared.value)
    return _encoders[key]


def read_tokens(
    spark: SparkSession,
    path: str,
    ids: tuple[int, int] | None = None,
    span: tuple[int, int] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens``, ``tokens``.

    ``ids`` bounds document ids and ``span`` token positions, both closed; either
    reaches the files as filters on part and id that row groups and pages are
    skipped by. Select fewer columns to read fewer.
    """
    rows = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/tokens")
    index = spark.read.parquet(f"{path}/index")
    if ids:
        rows = rows.where(F.col("doc_id").between(*ids))
    if span:
        parts = index.where(f"file_start <= {int(span[1])} and file_start + n_tokens > {int(span[0])}")
        rows = rows.where(F.col("part").isin([r["part"] for r in parts.select("part").collect()]))
    starts = index.select("part", "file_start")
    found = rows.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("file_start") + F.col("part_start")).alias("start"), "n_tokens", "tokens"
    )
    if span:
        found = found.where(
            (F.col("start") <= int(span[1])) & (F.col("start") + F.col("n_tokens") > int(span[0]))
        )
    return found if where is None else found.where(where)


def with_crc(tokens: DataFrame) -> DataFrame:
    """Adds ``ids_crc32`` of the ids as little-endian unsigned 32-bit integers."""

    def crc(batches):
        for batch in batches:
            lists = batch.column(batch.schema.names.index("tokens"))
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            sizes = np.diff(lists.offsets.to_numpy())
            ends = np.cumsum(sizes)
            sums = [zlib.crc32(flat[b - n : b]) for n, b in zip(sizes.tolist(), ends.tolist(), strict=True)]
            kept = [i for i, n in enumerate(batch.schema.names) if n != "tokens"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), pa.array(sums, pa.int64())],
                names=[*(batch.schema.names[i] for i in kept), "ids_crc32"],
            )

    kinds = [f"`{n}` {t}" for n, t in tokens.dtypes if n != "tokens"]
    return tokens.mapInArrow(crc, ", ".join([*kinds, "ids_crc32 bigint"]))
