"""As-of reads: the latest state of a key on, or strictly before, a day.

``on`` must be a date or an integer day number. That bounds the timeline of
one key by the length of the calendar, whatever share of the rows the key
holds, so a plain window per key is safe once each side has one row per
(key, day). Timelines without that bound, as of timestamps, go through
:func:`asof_timeline`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayledger.operators.picks import last_per_key

_SRC = "__src"
_LEFT = "__left"
_DAY_TYPES = (T.DateType, T.IntegerType, T.LongType, T.ShortType)


@dataclass(frozen=True)
class State:
    """A stored state table. ``ties`` order rows of one (key, day); the greatest wins."""

    frame: DataFrame
    columns: Sequence[str] | None = None
    ties: Sequence[str] = ()

    def payload(self, keys: Sequence[str]) -> list[str]:
        return list(self.columns or [c for c in self.frame.columns if c not in keys])


def asof_join_many(
    left: DataFrame,
    states: Mapping[str, State],
    by: Sequence[str],
    on: str,
    inclusive: bool = True,
    unique: bool = False,
) -> DataFrame:
    """Left rows plus one struct column per state: its latest row with
    ``state.on <= left.on`` (``<`` when not ``inclusive``), or null.

    A stored row whose fields are all null still wins over an older one.

    ``unique=True`` declares that ``left`` holds one row per (by, on) and each
    state a calendar-bounded number per key; then one union, one shuffle on
    ``by`` and one sort answer all states. Otherwise left keys and states are
    first reduced to one row per (by, on), map side, and the answer is joined
    back by (by, on), where adaptive execution may split hot keys.
    """
    by = list(by)
    keys = [*by, on]
    _require_day_column(left, on)
    if unique:
        return _sweep(left, states, by, on, inclusive)
    reduced = {
        name: replace(
            state,
            frame=last_per_key(state.frame.dropna(subset=keys), keys, state.ties or [on]),
            columns=state.payload(keys),
            ties=(),
        )
        for name, state in states.items()
    }
    points = left.select(*keys).dropna().distinct()
    return left.join(_sweep(points, reduced, by, on, inclusive), keys, "left")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    on: str,
    inclusive: bool = True,
    ties: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    prefix: str = "",
    unique: bool = False,
) -> DataFrame:
    """Single-state form of :func:`asof_join_many` with the state's columns flattened.
    The state's own day comes along when ``on`` is listed in ``columns``."""
    state = State(right, columns, ties)
    names = state.payload([*by, on])
    joined = asof_join_many(left, {"__state": state}, by, on, inclusive, unique)
    flat = [F.col("__state")[c].alias(f"{prefix}{c}") for c in names]
    return joined.select(*left.columns, *flat)


def asof_timeline(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    on: str,
    bucket: Callable[[Column], Column] = F.to_date,
    inclusive: bool = True,
    ties: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """As :func:`asof_join`, over timelines that nothing bounds: ``on`` is anything that
    sorts, a timestamp say, and ``bucket`` a column of it that never falls as it grows.

    The sweep has two levels. Inside a (key, bucket) rows are swept as usual, so the
    rows of a hot key are spread over its buckets; they alone must fit a task's sort,
    which spills. What a bucket begins with is the last state of the buckets before it:
    the last one of each is found map side, and carried over a key's buckets in a
    window that holds one row a bucket. It then joins the sweep of its bucket as one
    state more, so no join back is needed.

    Left rows without a key or ``on`` find nothing; states without are not read. Of
    states with equal ``on`` the greatest by ``ties`` counts.
    """
    keys, by = [*by, on], list(by)
    payload = State(right, columns, ties).payload(keys)
    name, own = "__bucket", [*by, "__bucket"]
    body = list(dict.fromkeys([on, *payload, *ties]))
    states = right.dropna(subset=keys).select(*by, *body).withColumn(name, bucket(F.col(on)))
    rows = left.withColumn(name, bucket(F.col(on)))
    row = F.struct(*[F.col(c) for c in body])
    newest = F.max_by(row, F.struct(on, *ties)).alias("__last")
    lasts = states.groupBy(*own).agg(newest, F.lit(False).alias("__asked"))
    asked = rows.select(*own, F.lit(None).cast(lasts.schema["__last"].dataType).alias("__last"), F.lit(True).alias("__asked"))
    steps = lasts.unionByName(asked.dropna(subset=own).distinct())
    # of a bucket the asking row comes before its own last state
    line = Window.partitionBy(*by).orderBy(name, F.desc("__asked")).rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.withColumn("__before", F.last("__last", ignorenulls=True).over(line))
    carried = carried.where(F.col("__asked") & F.col("__before").isNotNull()).select(*own, "__before.*")
    state = State(states.unionByName(carried), payload, ties)
    joined = _sweep(rows, {"__state": state}, own, on, inclusive)
    flat = [F.col("__state")[c].alias(f"{prefix}{c}") for c in payload]
    return joined.select(*left.columns, *flat)


def _sweep(
    left: DataFrame,
    states: Mapping[str, State],
    by: list[str],
    on: str,
    inclusive: bool,
) -> DataFrame:
    # Each side travels as one struct: a row of another side then costs one null
    # field in the shuffle instead of one per column.
    left_src, state_src = (1, 0) if inclusive else (0, 1)
    keys = [*by, on]
    rest = [c for c in left.columns if c not in keys]
    rows = left.select(
        *keys, F.lit(left_src).alias(_SRC), F.struct(F.lit(True).alias(_SRC), *rest).alias(_LEFT)
    )
    order: list[Column] = [F.col(on), F.col(_SRC)]
    for name, state in states.items():
        columns = [
            *keys,
            F.lit(state_src).alias(_SRC),
            F.struct(*state.payload(keys)).alias(name),
        ]
        if state.ties:
            tie = f"__tie_{name}"
            columns.append(F.struct(*state.ties).alias(tie))
            order.append(F.col(tie))
        rows = rows.unionByName(state.frame.select(*columns), allowMissingColumns=True)
    upto = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.withColumns({n: F.last(n, ignorenulls=True).over(upto) for n in states})
    own = [F.col(_LEFT)[c].alias(c) if c in rest else F.col(c) for c in left.columns]
    return filled.where(F.col(_SRC) == left_src).select(*own, *states)


def densify(
    history: DataFrame, by: Sequence[str], on: str, until: Column, start: Column | None = None
) -> DataFrame:
    """Change-only history to one row per day, from the key's first stored day
    (or ``start``) up to ``until``. Each stored row is repeated until the day
    before the next one; no calendar join is needed."""
    following = F.lead(on).over(Window.partitionBy(*by).orderBy(on))
    first = F.col(on) if start is None else F.greatest(F.col(on), start)
    spans = history.withColumns({"__next": following, "__until": until, "__first": first})
    last = F.least(F.date_sub("__next", 1), F.col("__until"))
    spans = spans.withColumn("__last", last).where(F.col("__first") <= F.col("__last"))
    days = F.explode(F.sequence("__first", "__last"))
    rest = [c for c in history.columns if c != on]
    return spans.select(*rest, days.alias(on)).select(*history.columns)


def _require_day_column(df: DataFrame, on: str) -> None:
    if not isinstance(df.schema[on].dataType, _DAY_TYPES):
        raise TypeError(f"{on} must be a date or an integer day number")
