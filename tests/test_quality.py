import random

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from dayledger.operators import quality as Q
from dayledger.operators.meters import check_meters


def rules():
    return [
        Q.Rule("NO_NAME", F.col("name").isNull(), "", stops=True),
        Q.Rule("HIGH", F.col("n") > 10, ""),
        Q.Rule("ODD", F.col("n") % 2 == 1, "", level=Q.WARNING),
    ]


def data(spark):
    rows = [(1, "a", 2), (2, "b", 11), (3, None, 13), (4, "d", None), (5, "e", 3)]
    return spark.createDataFrame(rows, "id int, name string, n int")


def test_every_broken_rule_is_reported_until_one_stops(spark):
    good, findings = Q.validate(data(spark), rules(), ["id"])
    assert [r[0] for r in rows_of(good, "id")] == [1, 4, 5]
    assert rows_of(findings, "id", "code", "level") == [
        (2, "HIGH", "ERROR"), (2, "ODD", "WARNING"), (3, "NO_NAME", "ERROR"), (5, "ODD", "WARNING"),
    ]


def test_first_only(spark):
    _, findings = Q.validate(data(spark), rules(), ["id"], first_only=True)
    assert rows_of(findings, "id", "code") == [(2, "HIGH"), (3, "NO_NAME"), (5, "ODD")]


def test_orphans_duplicates_nulls(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,)], "id int")
    assert rows_of(Q.orphans(child, "k", parent, "id")) == [(1, 2)]
    assert rows_of(Q.duplicates(child, ["k"])) == [(1, 2)]
    assert rows_of(Q.nulls(child, ["k"])) == [("k", 1)]


def test_findings_by_level(spark):
    _, findings = Q.validate(data(spark), rules(), ["id"])
    assert rows_of(Q.findings_by_level(findings)) == [("ERROR", 2), ("WARNING", 2)]


def one_by_one(candidates, stored):
    """Each candidate in turn against what is stored by then: what becomes of it."""
    table = {(p, d): (r1, r2) for p, d, r1, r2 in stored}
    fates = {}
    for p, d, f, r1, r2 in sorted(candidates, key=lambda r: (r[1], r[2])):
        if r1 is None or r2 is None:
            fates[f] = "incomplete"
            continue
        before = [x for x in table if x[0] == p and x[1] < d]
        last = max(before, key=lambda x: x[1]) if before else None
        if last and d - last[1] == 1 and table[last][1] != r1:
            fates[f] = "discontinuous"
        elif (p, d) in table:
            fates[f] = "exists"
        else:
            stale = bool(last) and d - last[1] == 1 and table[last][1] == r2
            table[p, d] = (r1, r2)
            fates[f] = "stale" if stale else "inserted"
    return fates


@pytest.mark.parametrize("seed,most", [(0, 1), (1, 1), (2, 3), (3, 4), (4, 2)])
def test_meters_against_one_by_one_loading(spark, seed, most):
    rnd = random.Random(seed)

    def reading():
        return rnd.choice([1.0, 2.0, 2.0, None])

    stored = [(p, d, rnd.choice([1.0, 2.0]), rnd.choice([1.0, 2.0])) for p in range(6) for d in range(8) if rnd.random() < 0.3]
    places = [(p, d) for p in range(6) for d in range(3, 25) for _ in range(rnd.randint(0, most))]
    incoming = [(p, d, f, reading(), reading()) for f, (p, d) in zip(rnd.sample(range(10**6), len(places)), places)]
    stored_frame = spark.createDataFrame(stored, "p int, d int, reading1 double, reading2 double")
    for table, rows in ((stored_frame, stored), (None, [])):
        got = check_meters(
            spark.createDataFrame(incoming, "p int, d int, f int, reading1 double, reading2 double"),
            table,
            "p",
            "d",
            ["f"],
            needs_opening=F.lit(True),
            may_be_stale=F.lit(True),
            pairs=[("reading1", "reading2")],
        ).collect()
        fates = {}
        for r in got:
            names = [n for n in ("incomplete", "discontinuous", "stale", "inserted", "exists") if r[n]]
            fates[r["f"]] = names[0]
            assert len(names) == 1 or names == ["stale", "inserted"]
        assert fates == one_by_one(incoming, rows)


def test_each_candidate_of_a_day_is_judged_on_its_own(spark):
    ddl = "p int, d int, f string, reading1 double, reading2 double"
    stored = spark.createDataFrame([(1, 1, "x", 5.0, 10.0)], ddl)
    df = spark.createDataFrame([(1, 2, "a", 99.0, 100.0), (1, 2, "b", 10.0, 20.0), (1, 2, "c", 98.0, 1.0)], ddl)
    got = check_meters(
        df, stored, "p", "d", ["f"], F.lit(True), F.lit(False), pairs=[("reading1", "reading2")]
    )
    assert rows_of(got, "f", "inserted", "exists", "discontinuous") == [
        ("a", False, False, True), ("b", True, False, False), ("c", False, False, True),
    ]


def test_second_candidate_of_a_day_is_already_there(spark):
    ddl = "p int, d int, f string, reading1 double, reading2 double"
    df = spark.createDataFrame([(1, 1, "b", 1.0, 2.0), (1, 1, "a", 1.0, 3.0)], ddl)
    got = check_meters(
        df, None, "p", "d", ["f"], F.lit(False), F.lit(False), pairs=[("reading1", "reading2")]
    )
    assert rows_of(got, "f", "inserted", "exists") == [("a", True, False), ("b", False, True)]


def test_constraints_of_tables(spark):
    tables = {
        "child": spark.createDataFrame(
            [(1, 10, "a"), (2, 10, "a"), (2, 99, None), (None, None, "a"), (None, 98, "b"), (5, 98, None)],
            "id int, ref int, name string",
        ),
        "parent": spark.createDataFrame([(10,), (11,), (11,), (None,)], "id bigint"),
        "empty": spark.createDataFrame([], "id int, ref int"),
    }
    refers = Q.Constraint("refers", ("ref",), "parent")
    declared = {
        "child": [refers, Q.Constraint("unique", ("id",)), Q.Constraint("not_null", ("id", "name")), Q.Constraint("unique", ("id", "ref"))],
        "empty": [refers, Q.Constraint("unique", ("id",))],
    }
    assert rows_of(Q.check_constraints(tables, declared)) == sorted([
        ("child(ref) refers -> parent.id", 6, 3),
        ("child(id) unique", 6, 4),
        ("child(id, name) not_null", 6, 4),
        ("child(id, ref) unique", 6, 0),
        ("empty(ref) refers -> parent.id", 0, 0),
        ("empty(id) unique", 0, 0),
    ], key=repr)
    only = {"child": [Q.Constraint("not_null", ("id",))]}
    assert rows_of(Q.check_constraints(tables, only)) == [("child(id) not_null", 6, 2)]


def test_constraints_scan_a_table_once(spark):
    child = spark.range(9).selectExpr("id", "id % 3 as ref")
    declared = {"child": [Q.Constraint("refers", ("ref",), "parent"), Q.Constraint("unique", ("id",))]}
    found = Q.check_constraints({"child": child, "parent": spark.createDataFrame([(0,)], "id int")}, declared)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 9") == 1
