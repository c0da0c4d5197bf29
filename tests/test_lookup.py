from helpers import rows_of
from pyspark.sql import functions as F

from dayledger.functions.text import key_text
from dayledger.operators.lookup import Dimension, denormalise, lookup, prefix_lookup


def dim(spark):
    rows = [(5, "a", None, 1), (3, "a", None, 1), (4, "a", "s", 1), (9, "b", None, 2)]
    return spark.createDataFrame(rows, "id int, name string, square string, field_id int")


def test_first_match_never_multiplies_rows(spark):
    facts = spark.createDataFrame([("a",), ("a",), ("zz",), (None,)], "x string")
    got = lookup(facts, dim(spark), [(F.col("x"), F.col("name"))], "found")
    assert rows_of(got) == sorted([("a", 3), ("a", 3), ("zz", None), (None, None)], key=repr)


def test_null_safe_position(spark):
    facts = spark.createDataFrame([("a", None), ("a", "s"), ("b", "s")], "x string, sq string")
    on = [(F.col("x"), F.col("name")), (F.col("sq"), F.col("square"))]
    safe = lookup(facts, dim(spark), on, "found", null_safe=[1])
    plain = lookup(facts, dim(spark), on, "found")
    assert rows_of(safe) == sorted([("a", None, 3), ("a", "s", 4), ("b", "s", None)], key=repr)
    assert rows_of(plain) == sorted([("a", None, None), ("a", "s", 4), ("b", "s", None)], key=repr)


def test_number_and_text_keys_meet(spark):
    facts = spark.createDataFrame([("642.0",), (" 642",)], "x string")
    names = spark.createDataFrame([(1, "642")], "id int, name string")
    got = lookup(facts, names, [(key_text(F.col("x")), key_text(F.col("name")))], "found")
    assert [r["found"] for r in got.collect()] == [1, 1]


def test_prefix(spark):
    facts = spark.createDataFrame([("ASIA x",), ("EUROPEAN",), (None,)], "x string")
    names = spark.createDataFrame([(1, "ASIA"), (2, "EUROPE"), (3, "EUROP z")], "id int, name string")
    got = prefix_lookup(facts, names, F.col("x"), "name", "found")
    assert rows_of(got) == sorted([("ASIA x", 1), ("EUROPEAN", 2), (None, None)], key=repr)


def test_chain_keeps_unmatched_rows(spark):
    facts = spark.createDataFrame([(1, 10), (2, 99)], "f int, well_id int")
    wells = spark.createDataFrame([(10, "w", 7)], "id int, name string, platform_id int")
    platforms = spark.createDataFrame([(7, "p")], "id int, name string")
    got = denormalise(
        facts,
        [
            Dimension(wells, "well_id", {"name": "well", "platform_id": "platform_id"}),
            Dimension(platforms, "platform_id", {"name": "platform"}),
        ],
    )
    assert rows_of(got, "f", "well", "platform") == [(1, "w", "p"), (2, None, None)]


def test_small_dimensions_are_broadcast_by_size(spark):
    facts = spark.range(1000).selectExpr("cast(id % 7 as string) as x")
    got = lookup(facts, dim(spark), [(F.col("x"), F.col("name"))], "found")
    # Literal frames have no file statistics; a wide threshold shows the choice is by size.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = got.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastNestedLoop" not in plan
