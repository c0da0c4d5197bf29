import datetime as dt
import random

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from dayledger.operators.asof import State, asof_join, asof_join_many, asof_timeline, densify

DAY = dt.date


def left(spark):
    return spark.createDataFrame([(1, d) for d in (1, 2, 3, 5)] + [(2, 2), (None, 2)], "k int, d int")


def states(spark):
    rows = [(1, 2, "a", 10), (1, 3, None, None), (2, 3, "z", 1)]
    return spark.createDataFrame(rows, "k int, d int, s string, n int")


@pytest.mark.parametrize("unique", [True, False])
def test_inclusive_and_null_state_wins(spark, unique):
    got = asof_join(left(spark), states(spark), ["k"], "d", unique=unique)
    assert rows_of(got) == sorted(
        [
            (1, 1, None, None), (1, 2, "a", 10), (1, 3, None, None), (1, 5, None, None),
            (2, 2, None, None), (None, 2, None, None),
        ],
        key=repr,
    )


@pytest.mark.parametrize("unique", [True, False])
def test_strict_takes_the_day_before(spark, unique):
    got = asof_join(left(spark), states(spark), ["k"], "d", inclusive=False, unique=unique)
    assert (1, 3, "a", 10) in rows_of(got) and (1, 2, None, None) in rows_of(got)


@pytest.mark.parametrize("unique", [True, False])
def test_ties_take_the_greatest(spark, unique):
    right = spark.createDataFrame(
        [(1, 2, 5, "old"), (1, 2, 9, "new"), (1, 2, 7, "mid")], "k int, d int, t int, s string"
    )
    got = asof_join(
        left(spark).where("k = 1"), right, ["k"], "d", ties=["t"], columns=["s"], unique=unique
    )
    assert rows_of(got) == [(1, 1, None), (1, 2, "new"), (1, 3, "new"), (1, 5, "new")]


def test_repeated_left_rows_are_kept(spark):
    twice = left(spark).union(left(spark))
    got = asof_join(twice, states(spark), ["k"], "d")
    assert got.count() == twice.count()


def test_timestamps_are_refused(spark):
    df = spark.sql("select 1 as k, timestamp '2025-01-01 00:00:00' as d")
    with pytest.raises(TypeError):
        asof_join(df, df, ["k"], "d")


def brute_force(points, right, inclusive):
    out = []
    for k, d in points:
        ok = [r for r in right if r[0] == k and (r[1] <= d if inclusive else r[1] < d)]
        out.append((k, d, max(ok, key=lambda r: (r[1], r[2]))[2] if ok else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_with_a_hot_key(spark, inclusive, seed):
    rnd = random.Random(seed)

    def key():
        return 0 if rnd.random() < 0.4 else rnd.randrange(1, 9)

    points = [(key(), rnd.randrange(30)) for _ in range(300)]
    right = [(key(), rnd.randrange(30), i) for i in range(120)]
    got = asof_join(
        spark.createDataFrame(points, "k int, d int"),
        spark.createDataFrame(right, "k int, d int, v int"),
        ["k"],
        "d",
        inclusive=inclusive,
        ties=["v"],
    )
    assert rows_of(got) == brute_force(points, right, inclusive)


def test_many_states_share_one_exchange_by_key(spark):
    base = left(spark).dropna()
    named = {n: State(states(spark)) for n in ("a", "b", "c")}
    plan = asof_join_many(base, named, ["k"], "d", unique=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(k#") == 1
    assert text.count("Join") == 0


def test_densify_repeats_until_the_next_state(spark):
    history = spark.createDataFrame(
        [(1, DAY(2025, 1, 1), "a"), (1, DAY(2025, 1, 3), "b"), (2, DAY(2025, 1, 5), "z")],
        "k int, d date, s string",
    )
    from pyspark.sql import functions as F

    got = rows_of(densify(history, ["k"], "d", F.lit(DAY(2025, 1, 4))))
    assert got == sorted(
        [
            (1, DAY(2025, 1, 1), "a"), (1, DAY(2025, 1, 2), "a"), (1, DAY(2025, 1, 3), "b"),
            (1, DAY(2025, 1, 4), "b"),
        ],
        key=repr,
    )


@pytest.mark.parametrize("inclusive", [True, False])
def test_timeline_equals_brute_force(spark, inclusive):
    """Timestamps of few keys, one of them with most rows, in hourly buckets."""
    draw = random.Random(11)
    start = dt.datetime(2024, 3, 30)

    def rows(n):
        found = []
        for i in range(n):
            key = draw.choice([1] * 8 + [2, None])
            at = draw.choice([start + dt.timedelta(minutes=draw.randrange(6000)), start, None if draw.random() < 0.1 else start])
            found.append((key, at, i))
        return found

    left, right = rows(700), rows(300)
    asked = spark.createDataFrame(left, "k int, at timestamp_ntz, id int")
    states = spark.createDataFrame([(*r, None if r[2] % 7 == 0 else r[2]) for r in right], "k int, at timestamp_ntz, tie int, v int")
    hour = lambda t: F.floor(F.timestamp_diff("MINUTE", F.lit(start), t) / 60)
    found = asof_timeline(asked, states, ["k"], "at", hour, inclusive, ties=["tie"], columns=["tie", "v"])
    want = []
    for k, at, i in left:
        known = [
            (s_at, tie) for s_k, s_at, tie in right
            if None not in (k, at, s_k, s_at) and s_k == k and (s_at <= at if inclusive else s_at < at)
        ]
        tie = max(known)[1] if known else None
        want.append((k, at, i, tie, None if tie is None or tie % 7 == 0 else tie))
    assert rows_of(found) == sorted(want, key=repr)
    assert found.columns == ["k", "at", "id", "tie", "v"]


def test_timeline_spreads_a_hot_key(spark):
    days = spark.range(4000).selectExpr("1 as k", "timestamp_seconds(id * 1000) as at", "id")
    found = asof_timeline(days, days.withColumnRenamed("id", "v"), ["k"], "at")
    parts = found.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 3000
    assert found.where("id = v").count() == 4000
