import random

from helpers import rows_of

from dayledger.operators.incremental import append_if_absent, append_if_changed, changes, repair_late
from dayledger.operators.picks import first_per_key, number_rows

HISTORY = "k int, d int, s string, n int, o int"


def frame(spark, rows):
    return spark.createDataFrame(rows, HISTORY)


def append(spark, incoming, stored):
    target = None if stored is None else frame(spark, stored)
    got = append_if_changed(frame(spark, incoming), target, ["k"], "d", ["s", "n"], ["o"])
    return rows_of(got)


def test_absent_keeps_the_first_of_each_key(spark):
    incoming = frame(spark, [(1, 1, "b", 0, 2), (1, 1, "a", 0, 1), (2, 1, "c", 0, 3)])
    target = frame(spark, [(2, 1, "x", 0, 0)])
    got = append_if_absent(incoming, target, ["k", "d"], ["o"], prune="d")
    assert rows_of(got) == [(1, 1, "a", 0, 1)]


def test_first_all_null_row_is_not_stored(spark):
    assert append(spark, [(1, 1, None, None, 0)], None) == []


def test_null_to_value_and_back_are_changes(spark):
    incoming = [(1, 1, "a", None, 0), (1, 2, "a", 5, 0), (1, 3, "a", None, 0), (1, 4, "a", None, 0)]
    assert [r[1] for r in append(spark, incoming, None)] == [1, 2, 3]


def test_empty_text_differs_from_null(spark):
    assert [r[1] for r in append(spark, [(1, 1, "", 1, 0), (1, 2, None, 1, 0)], None)] == [1, 2]


def test_compared_with_the_latest_stored_state_however_old(spark):
    stored = [(1, 1, "a", 1, 0), (2, 1, "b", 1, 0)]
    incoming = [(1, 90, "a", 1, 0), (2, 90, "a", 1, 0)]
    assert append(spark, incoming, stored) == [(2, 90, "a", 1, 0)]


def test_stored_row_of_the_same_key_wins(spark):
    stored = [(1, 5, "a", 1, 0)]
    incoming = [(1, 5, "b", 1, 0), (1, 6, "a", 1, 0), (1, 7, "b", 1, 0)]
    assert append(spark, incoming, stored) == [(1, 7, "b", 1, 0)]


def test_late_rows_do_not_touch_newer_stored_rows(spark):
    stored = [(1, 1, "a", 1, 0), (1, 9, "b", 1, 0)]
    assert append(spark, [(1, 4, "c", 1, 0)], stored) == [(1, 4, "c", 1, 0)]


def one_by_one(incoming, stored):
    """The state machine: rows in day order, each compared with what is stored then."""
    table = {(k, d): (s, n) for k, d, s, n, _ in stored}
    new = []
    for k, d, s, n, o in sorted(incoming, key=lambda r: (r[1], r[4])):
        before = [x for x in table if x[0] == k and x[1] < d]
        previous = table[max(before, key=lambda x: x[1])] if before else (None, None)
        if (k, d) not in table and previous != (s, n):
            table[k, d] = (s, n)
            new.append((k, d, s, n, o))
    return sorted(new, key=repr)


def test_against_one_by_one_loading(spark):
    for seed in range(4):
        rnd = random.Random(seed)

        def row(o, days):
            return (rnd.randrange(3), rnd.choice(days), rnd.choice(["a", "b", None]), rnd.choice([1, None]), o)

        # One stored row per (k, d); days may overlap, and incoming ones repeat.
        stored = list({(r[0], r[1]): r for r in (row(i, range(12)) for i in range(15))}.values())
        stored = one_by_one(stored, [])
        incoming = list({(r[0], r[1]): r for r in (row(i, range(6, 20)) for i in range(25))}.values())
        assert append(spark, incoming, stored) == one_by_one(incoming, stored)
        repeated = incoming + [row(100 + i, range(6, 20)) for i in range(20)]
        assert append(spark, repeated, stored) == one_by_one(repeated, stored)


def test_a_repeat_of_the_state_does_not_hide_a_change_of_the_same_day(spark):
    stored = [(1, 1, "a", 5, 0)]
    incoming = [(1, 2, "a", 5, 1), (1, 2, "a", 6, 2), (1, 3, "a", 6, 3), (1, 3, "a", 5, 4)]
    assert append(spark, incoming, stored) == [(1, 2, "a", 6, 2), (1, 3, "a", 5, 4)]


def test_loading_twice_inserts_nothing(spark):
    incoming = [(1, 1, "a", 1, 0), (1, 2, "a", 1, 0), (1, 3, "b", 1, 0)]
    first = append(spark, incoming, [(9, 1, "q", 1, 0)])
    assert [r[1] for r in first] == [1, 3]
    assert append(spark, incoming, first) == []


def test_changes_name_the_columns(spark):
    df = frame(spark, [(1, 1, "a", 1, 0), (1, 2, "a", 2, 0), (1, 3, "a", 2, 0), (1, 4, None, 3, 0)])
    got = changes(df, ["k"], "d", ["s", "n"]).select("d", "changed_columns").collect()
    assert sorted((r[0], tuple(r[1])) for r in got) == [(1, ("s", "n")), (2, ("n",)), (4, ("s", "n"))]


def test_first_per_key_is_pruned_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 as k")
    plan = first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_number_rows_over_small_blocks(spark):
    rnd = random.Random(3)
    rows = [(i, 0 if rnd.random() < 0.5 else rnd.randrange(5)) for i in rnd.sample(range(500), 200)]
    df = spark.createDataFrame(rows, "id int, k int")
    got = {(r["id"], r["k"]): r["n"] for r in number_rows(df, "k", "id", "n", block=7).collect()}
    for key in {k for _, k in rows}:
        ids = sorted(i for i, k in rows if k == key)
        assert [got[i, key] for i in ids] == list(range(1, len(ids) + 1))


def test_late_rows_repair_a_history(spark):
    """3,000 entities whose days come in shuffled batches: after each one the history is
    that of a rebuild from all raw rows."""
    draw = random.Random(10)
    schema = "k int, d int, a int, b string, e int"
    batches = [[], [], [], []]
    for k in range(3000):
        for d in draw.sample(range(12), draw.randrange(1, 10)):
            batches[draw.randrange(4)].append((k, d, draw.choice([None, 1, 2]), draw.choice([None, "x"]), len(batches)))
    tracked = ["a", "b"]

    def rebuild(rows):
        history, last = [], {}
        for k, d, a, b, _ in sorted(rows, key=lambda r: r[:2]):
            if last.get(k, (None, None)) != (a, b):
                history.append((k, d, a, b))
            last[k] = (a, b)
        return sorted(history, key=str)

    stored, raw = [], []
    for batch in batches:
        late = spark.createDataFrame(batch + batch[:50], schema)
        reports = spark.createDataFrame(raw, schema)
        found = repair_late(
            late, spark.createDataFrame(stored, "k int, d int, a int, b string"), reports, ["k"], "d", tracked, ["e"]
        ).collect()
        gone = {(r["k"], r["d"]) for r in found if r["action"] == "retract"}
        assert gone <= {r[:2] for r in stored}
        stored = [r for r in stored if r[:2] not in gone]
        stored += [(r["k"], r["d"], r["a"], r["b"]) for r in found if r["action"] == "insert"]
        raw += batch
        assert sorted(stored, key=str) == rebuild(raw)
