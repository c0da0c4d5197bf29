"""Idempotent appends: rows not stored yet, or rows that change the state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayledger.functions.text import differs
from dayledger.operators.picks import first_per_key, last_per_key

_RANK = "__choice"
_STATE = "__state"
_PREV = "__prev"


def within(target: DataFrame, incoming: DataFrame, column: str) -> DataFrame:
    """Target rows inside the incoming range of ``column``. The bounds are scalar
    subqueries, so the scan prunes partitions and row groups with them."""
    low = incoming.select(F.min(column)).scalar()
    high = incoming.select(F.max(column)).scalar()
    return target.where((F.col(column) >= low) & (F.col(column) <= high))


def anti_existing(incoming: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored."""
    return incoming.join(target.select(*keys), list(keys), "left_anti")


def append_if_absent(
    incoming: DataFrame,
    target: DataFrame | None,
    keys: Sequence[str],
    order: Sequence[str | Column],
    prune: str | None = None,
) -> DataFrame:
    """Rows to append: the first incoming row of each key that is not stored.
    ``prune`` names the key column that bounds the part of the target to read."""
    first = first_per_key(incoming, keys, order)
    if target is None:
        return first
    return anti_existing(first, within(target, incoming, prune) if prune else target, keys)


def append_if_changed(
    incoming: DataFrame,
    target: DataFrame | None,
    by: Sequence[str],
    on: str,
    tracked: Sequence[str],
    order: Sequence[str | Column],
    recent: DataFrame | None = None,
) -> DataFrame:
    """Rows to append to a change-only history: the (by, on) is not stored and a
    tracked column differs, null-safe, from the latest earlier row.

    Rows are judged in turn, by day and then ``order``: of a day's rows the first
    that differs from the state before is stored, and the others find the key taken.
    So only the first two different rows of a key matter. Where no day of an entity
    has two, its rows are compared with ``lag``; the days of the other entities are
    folded in one row each, as what a day stores depends on the day before. ``on``
    must bound the number of days.

    Stored rows are final. Of the history of the entities that come in, the part
    before the first incoming day is reduced to one last row each, map side.
    ``recent`` is a part of the target that holds its rows from that day on, where
    reading it alone is cheaper; ``target`` then need not hold later ones.
    ``target=None`` rebuilds the history from raw rows.
    """
    distinct = first_per_key(incoming, [*by, on, *tracked], order)
    day = Window.partitionBy(*by, on).orderBy(*order)
    rows = distinct.withColumn(_RANK, F.row_number().over(day)).where(F.col(_RANK) <= 2)
    state = F.struct(*tracked)
    slim = rows.select(*by, on, _RANK, state.alias(_STATE))
    if target is not None:
        entities = incoming.select(*by).distinct()

        def known(part: DataFrame) -> DataFrame:
            return part.join(entities, list(by), "left_semi").select(*by, on, *tracked)

        start = incoming.select(F.min(on)).scalar()
        before = last_per_key(known(target.where(F.col(on) < start)), by, [on])
        since = known((target if recent is None else recent).where(F.col(on) >= start))
        stored = before.unionByName(since).select(*by, on, F.lit(0).alias(_RANK), state.alias(_STATE))
        slim = stored.unionByName(anti_existing(slim, since, [*by, on]))
    entity = Window.partitionBy(*by)
    slim = slim.withColumn("__most", F.max(_RANK).over(entity))
    single = slim.where("__most < 2")
    compared = single.withColumn(_PREV, F.lag(_STATE).over(Window.partitionBy(*by).orderBy(on)))
    changed = _changed(F.col(_PREV), F.col(_STATE), tracked)
    keys = compared.where((F.col(_RANK) == 1) & changed).select(*by, on, _RANK)
    keys = keys.unionByName(_folded(slim.where("__most = 2"), by, on, tracked))
    return rows.join(keys, [*by, on, _RANK], "left_semi").select(*incoming.columns)


def repair_late(
    late: DataFrame,
    stored: DataFrame,
    reports: DataFrame,
    by: Sequence[str],
    on: str,
    tracked: Sequence[str],
    order: Sequence[str | Column],
) -> DataFrame:
    """What rows that come late change in a change-only history: rows to ``insert`` and
    stored ones to ``retract`` (column ``action``), with ``by``, ``on`` and ``tracked``.

    ``reports`` holds the (by, on) that were reported before. A day that was reported
    but not stored had the state of the day before it, so the history need not be
    rebuilt from raw rows: a late row can only change what is to be stored for itself
    and for the next day that was reported. That day is stored anew where the late row
    parted it from an equal one, and retracted where it now equals the late row.

    Of late rows of one (by, on) the first by ``order`` counts; those of a day that was
    reported before are dropped, as stored rows are final. Each day of an entity is
    one row; ``on`` must bound their number. Null states and first states follow
    :func:`append_if_changed`: a first state of nulls is not stored.
    """
    keys, state = [*by, on], F.struct(*tracked)
    entities = late.select(*by).distinct()
    days = reports.select(*keys).distinct()
    new = anti_existing(first_per_key(late, keys, order), days, keys).select(*keys, state.alias("__late"))
    known = stored.join(entities, list(by), "left_semi").select(*keys, state.alias("__stored"))
    seen = days.join(entities, list(by), "left_semi")
    # one row per (by, on): what is stored, what comes late, and days without either
    rows = (
        seen.unionByName(new, allowMissingColumns=True)
        .unionByName(known, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(F.first("__late", True).alias("__late"), F.first("__stored", True).alias("__stored"))
    )
    line = Window.partitionBy(*by).orderBy(on)
    upto = line.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn(_STATE, F.coalesce("__late", F.last("__stored", True).over(upto)))
    rows = rows.withColumns(
        {_PREV: F.lag(_STATE).over(line), "__after_late": F.lag(F.col("__late").isNotNull()).over(line)}
    )
    is_late, is_stored = F.col("__late").isNotNull(), F.col("__stored").isNotNull()
    changed = _changed(F.col(_PREV), F.col(_STATE), tracked)
    after = F.coalesce("__after_late", F.lit(False))
    action = F.when((is_late | after & ~is_stored) & changed, "insert").when(
        ~is_late & after & is_stored & ~changed, "retract"
    )
    found = rows.withColumn("action", action).where("action is not null")
    return found.select("action", *keys, *[F.col(_STATE)[c].alias(c) for c in tracked])


def _changed(before: Column, now: Column, tracked: Sequence[str]) -> Column:
    changed = F.lit(False)
    for column in tracked:
        changed = changed | differs(before[column], now[column])
    return changed


def _folded(slim: DataFrame, by: Sequence[str], on: str, tracked: Sequence[str]) -> DataFrame:
    """Keys and ranks of the rows that are stored, of entities with two different
    rows on some day."""
    kind, state = dict(slim.dtypes)[on], dict(slim.dtypes)[_STATE]
    lines = slim.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(on, _RANK, _STATE))).alias("rows"))

    def step(seen: Column, row: Column) -> Column:
        taken = F.coalesce(seen["day"] == row[on], F.lit(False))
        is_new = ~taken & _changed(seen["state"], row[_STATE], tracked)
        stored = row[_RANK] == 0
        found = F.array(F.struct(row[on].alias(on), row[_RANK].alias(_RANK)))
        return F.struct(
            F.when(stored | is_new, row[on]).otherwise(seen["day"]).alias("day"),
            F.when(stored | is_new, row[_STATE]).otherwise(seen["state"]).alias("state"),
            F.when(is_new & ~stored, F.concat(seen["found"], found)).otherwise(seen["found"]).alias("found"),
        )

    start = F.struct(
        F.lit(None).cast(kind).alias("day"),
        F.lit(None).cast(state).alias("state"),
        F.array().cast(f"array<struct<{on}:{kind}, {_RANK}:int>>").alias("found"),
    )
    return lines.select(*by, F.inline(F.aggregate("rows", start, step, lambda seen: seen["found"])))


def changes(df: DataFrame, by: Sequence[str], on: str, tracked: Sequence[str]) -> DataFrame:
    """Rows that differ from the key's preceding row, with the array
    ``changed_columns``; ``df`` holds one row per (by, on)."""
    history = Window.partitionBy(*by).orderBy(on)
    compared = df.withColumn(_PREV, F.lag(F.struct(*tracked)).over(history))
    flags = [F.when(differs(F.col(_PREV)[c], F.col(c)), F.lit(c)) for c in tracked]
    named = compared.withColumn("changed_columns", F.array_compact(F.array(*flags)))
    return named.where(F.size("changed_columns") > 0).drop(_PREV)
