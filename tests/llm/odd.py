"""Documents that no operator may stumble over."""

from pyspark.sql import functions as F

LONG = "the long text goes on and on " * 4000
TEXTS = [
    (1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (2, None),
    (3, ""),
    (4, " \n\t \n"),
    (5, LONG),
    (5, LONG),
    (6, "ONE two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (7, "été ñandú straße 中文 🦙 \x00 ▁ İ"),
    (7, "another text with the same id"),
    (None, "a text without an id"),
    (None, None),
    (8, "12345 !!! ..."),
    (9, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
]
#: Names that operators use for columns of their own.
CLASHING = (
    "row_id", "block", "bucket", "body", "found", "ids", "score", "bits", "rest", "row", "key", "text_bytes",
    "row_hash", "lang_pred", "n_words", "decoded", "dropped", "giant_text_key", "learned", "component_id",
)


def documents(spark, texts=TEXTS):
    """The odd documents with columns of clashing names."""
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    return rows.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING))


def plain(spark, texts=TEXTS):
    return spark.createDataFrame(texts, "doc_id long, text string")
