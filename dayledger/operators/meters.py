"""Meter readings by day: completeness, continuity with the day before, stale meters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from dayledger.operators.picks import first_per_key

# Opening and closing reading of each meter on a platform.
PAIRS = (("reading1", "reading2"), ("reading3", "reading4"))


def _any(conditions: Sequence[Column]) -> Column:
    return F.coalesce(reduce(or_, conditions), F.lit(False))


def check_meters(
    candidates: DataFrame,
    stored: DataFrame | None,
    by: str,
    on: str,
    order: Sequence[str],
    needs_opening: Column,
    may_be_stale: Column,
    pairs: Sequence[tuple[str, str]] = PAIRS,
) -> DataFrame:
    """Candidates with the flags ``incomplete, exists, discontinuous, inserted, stale``.

    Days are judged in turn, and of a day each candidate on its own, by ``order``. A
    complete candidate that must be continuous is blocked when the entry of exactly
    the day before closed differently. Of the others the first is inserted, unless
    the day is stored already; the rest find that it exists. What a day's entry is
    depends on that of the day before, so each meter's days are folded in one row:
    ``on`` is a day number, which bounds their number, and of candidates with the
    same readings only the first enters, chosen map side.
    """
    readings = [r for pair in pairs for r in pair]
    closings = [c for _, c in pairs]
    missing = _any([F.col(c).isNull() for c in closings])
    no_opening = needs_opening & _any([F.col(o).isNull() for o, _ in pairs])
    flagged = candidates.withColumns(
        {
            "incomplete": missing | F.coalesce(no_opening, F.lit(False)),
            "__opens": F.coalesce(needs_opening, F.lit(False)),
            "__stales": F.coalesce(may_be_stale, F.lit(False)),
        }
    )
    judged = [*readings, "__opens"]
    distinct = first_per_key(flagged.where(~F.col("incomplete")), [by, on, *judged], order)
    rank = F.struct(*[F.col(c).alias(f"__{c}") for c in order])
    new = distinct.select(by, on, F.struct(rank.alias("rank"), *judged).alias("new"))
    if stored is not None:
        start = candidates.select(F.min(on)).scalar()
        near = stored.where(F.col(on) >= start - 1)
        new = new.unionByName(
            near.select(by, on, F.struct(*closings).alias("old")), allowMissingColumns=True
        )
    else:
        new = new.withColumn("old", F.lit(None).cast(_closing_type(closings)))
    days = new.groupBy(by, on).agg(
        F.sort_array(F.collect_list("new")).alias("new"),
        F.first("old", ignorenulls=True).alias("old"),
    )
    fates = _fold(days, by, on, pairs, rank_type=new.schema["new"].dataType["rank"].dataType)
    joined = flagged.join(fates, [by, on], "left")
    before, winner = F.col("__before"), F.col("__winner")
    sound = ~F.col("incomplete")
    broken = F.coalesce(F.col("__opens") & _differs(before, pairs), F.lit(False))
    inserted = F.coalesce(winner.eqNullSafe(rank) & winner.isNotNull(), F.lit(False))
    same = F.col("__stales") & _any([before[c] == F.col(c) for c in closings])
    flags = {
        "incomplete": F.col("incomplete"),
        "exists": sound & ~broken & ~inserted,
        "discontinuous": sound & broken,
        "inserted": sound & inserted,
        "stale": sound & inserted & F.coalesce(same, F.lit(False)),
    }
    return joined.select(*candidates.columns, *[c.alias(n) for n, c in flags.items()])


def _closing_type(closings: Sequence[str]) -> str:
    return f"struct<{', '.join(f'{c}:double' for c in closings)}>"


def _differs(before: Column, pairs: Sequence[tuple[str, str]], new: Column | None = None) -> Column:
    """Whether an opening differs from the closing of the day before, if any."""
    opening = (lambda o: F.col(o)) if new is None else (lambda o: new[o])
    return _any([before[c] != opening(o) for o, c in pairs])


def _fold(
    days: DataFrame, by: str, on: str, pairs: Sequence[tuple[str, str]], rank_type: DataType
) -> DataFrame:
    """For each day with candidates: ``__before``, the closings of the day before,
    and ``__winner``, the rank of the candidate that is inserted, if one is."""
    closings = [c for _, c in pairs]
    closing = _closing_type(closings)
    rank = rank_type.simpleString()
    kind = dict(days.dtypes)[on]

    def closed(entry: Column) -> Column:
        return F.struct(*[entry[c].cast("double").alias(c) for c in closings])

    def step(state: Column, day: Column) -> Column:
        before = F.when(state["day"] == day[on] - 1, state["closed"])
        passing = F.filter(
            day["new"], lambda c: ~F.coalesce(c["__opens"] & _differs(before, pairs, c), F.lit(False))
        )
        first = F.get(passing, F.lit(0))
        entry = F.when(day["old"].isNotNull(), closed(day["old"])).when(first.isNotNull(), closed(first))
        fate = F.struct(
            day[on].alias(on),
            before.alias("__before"),
            F.when(day["old"].isNull(), first["rank"]).alias("__winner"),
        )
        return F.struct(
            F.when(entry.isNotNull(), day[on]).otherwise(state["day"]).alias("day"),
            F.coalesce(entry, state["closed"]).alias("closed"),
            F.concat(state["fates"], F.array(fate)).alias("fates"),
        )

    start = F.struct(
        F.lit(None).cast(kind).alias("day"),
        F.lit(None).cast(closing).alias("closed"),
        F.array().cast(f"array<struct<{on}:{kind}, __before:{closing}, __winner:{rank}>>").alias("fates"),
    )
    lines = days.groupBy(by).agg(F.sort_array(F.collect_list(F.struct(on, "new", "old"))).alias("days"))
    folded = F.aggregate("days", start, step, lambda state: state["fates"])
    return lines.select(by, F.inline(folded))
