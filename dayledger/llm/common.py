"""What several operators share: folds, texts, work folders, word spans of bytes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable
from functools import lru_cache
from inspect import Parameter, Signature, signature

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Bytes of text that one vectorised step of a Python task looks at; a longer
#: document is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(column: str, modulus: int, value: int) -> Column:
    """Whether crc32 of a column as text leaves ``value``; false for null."""
    remainder = F.crc32(F.col(column).cast("string").cast("binary")) % modulus
    return F.coalesce(remainder == value, F.lit(False))


def text_of(column: str = "text") -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only. ``lower`` does just that where all is ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def hashed_sample(rows: DataFrame, number: int, of: int, order: str = "h") -> DataFrame:
    """The ``number`` rows with the smallest ``order``, a 64-bit hash. ``of`` rows are
    expected: where that is many more, a bound on the hash leaves about twice as many
    as are wanted before they are ranked, however many tasks there are."""
    if of > 4 * number:
        low = -(1 << 63) + int(2 * number / of * (1 << 64))
        rows = rows.where(F.col(order) < F.lit(low))
    return rows.orderBy(order).limit(number)


def boxed(docs: DataFrame, text: str = "text") -> DataFrame:
    """``text`` and ``rest``, a struct of all other columns: whatever their names,
    they cannot meet those an operator adds."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(
        F.col(f"`{text}`").cast("string").alias("text"),
        F.struct(*(others or [F.lit(True).alias("none")])).alias("rest"),
    )


def unboxed(found: DataFrame, docs: DataFrame, text: str = "text", changed: Column | None = None) -> DataFrame:
    """The columns of ``docs`` again. Where ``changed`` says that the text did, an
    ``n_chars`` column follows it."""
    columns = {c: F.col("text") if c == text else F.col(f"rest.`{c}`") for c in docs.columns}
    if changed is not None and "n_chars" in columns and text != "n_chars":
        size = F.char_length("text").cast(dict(docs.dtypes)["n_chars"])
        columns["n_chars"] = F.when(changed, size).otherwise(columns["n_chars"])
    return found.select(*(c.alias(n) for n, c in columns.items()))


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path under the folder all executors share. A local session that has
    no ``spark.checkpoint.dir``, as in tests, gets one of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _own_folder(spark.sparkContext.applicationId)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@lru_cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"llm-{application}-")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts its lineage."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(run: Callable) -> Callable:
    """``run`` over batches; after the last one, memory it freed goes back to the
    system. Idle workers of earlier stages would keep it from those of later ones."""

    def tidied(batches):
        yield from run(batches)
        gc.collect()
        give_back()

    return tidied


def tidy_group(run: Callable) -> Callable:
    """``run`` over one group, after which memory it freed goes back to the system."""

    def tidied(*group):
        found = run(*group)
        give_back()
        return found

    # Spark counts the parameters, to know whether the key is wanted
    names = [Parameter(n, Parameter.POSITIONAL_OR_KEYWORD) for n in signature(run).parameters]
    tidied.__signature__ = Signature(names)
    return tidied


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- texts as bytes, many documents at once ---------------------------------


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans: true outside the given closed ranges."""
    inside = np.ones(256, bool)
    for first, last in ranges:
        inside[first : last + 1] = False
    return inside


#: Bytes of words: all but space and 0x09 to 0x0D.
WORD_BYTES = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words of letters, digits and non-ASCII characters, A to Z included.
ALNUM_BYTES = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

FOLD_CASE = np.arange(256, dtype=np.uint8)
FOLD_CASE[0x41:0x5B] += 0x20


def steps(lengths: np.ndarray, limit: int = STEP_BYTES):
    """Slices of consecutive documents of about ``limit`` bytes together."""
    first, total = 0, 0
    for i, n in enumerate(lengths):
        if i > first and total + n > limit:
            yield slice(first, i)
            first, total = i, 0
        total += int(n)
    if first < len(lengths):
        yield slice(first, len(lengths))


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary array and the offsets of its values."""
    if texts.null_count:
        texts = texts.fill_null(b"")
    values = texts.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8)
    if not len(values) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(
    data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = WORD_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document of each word; no word crosses documents."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = word_bytes[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


HALF_BITS = 16
HALF = 1 << HALF_BITS


class WordHasher:
    """64-bit hashes of byte spans by prefix sums of a polynomial modulo 2^64."""

    def __init__(self, seed: int, fold_case: bool = False):
        draw = np.random.default_rng(seed)
        values = draw.integers(1, 2**63, 256, np.uint64) | np.uint64(1)
        self.values = values[FOLD_CASE] if fold_case else values
        self.base = int(draw.integers(1, 2**62)) * 4 + 3
        self.inverse = pow(self.base, -1, 2**64)
        self._powers, self._inverses = (self._tables(b) for b in (self.base, self.inverse))

    def _tables(self, base: int) -> list[np.ndarray]:
        """Powers of low and high halves of exponents below 2^32: any power is a
        product of two, so the tables stay small however long the texts."""
        out = []
        for step in (base, pow(base, HALF, 2**64)):
            table = np.full(HALF, step, np.uint64)
            table[0] = 1
            out.append(np.multiply.accumulate(table))
        return out

    def _sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums of the terms of all bytes, a stretch that caches hold at a time."""
        low, high = self._powers
        if len(data) > HALF * HALF:
            raise ValueError("a text of more than 2^32 bytes")
        sums = np.zeros(len(data) + 1, np.uint64)
        for k, first in enumerate(range(0, len(data), HALF)):
            terms = self.values[data[first : first + HALF]]
            terms *= low[: len(terms)]
            own = sums[first + 1 : first + 1 + len(terms)]
            np.cumsum(terms, out=own)
            own *= high[k]
            own += sums[first]
        return sums

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = self._sums(data)
        low, high = self._inverses
        h = (sums[ends] - sums[starts]) * low[starts & (HALF - 1)] * high[starts >> HALF_BITS]
        return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def window_hashes(words: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash for each run of ``width`` consecutive word hashes."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = np.random.default_rng(seed).integers(1, 2**63, width, np.uint64) | np.uint64(1)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h += words[k : k + n] * factors[k]
    return mix(h)
