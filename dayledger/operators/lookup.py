"""Name-to-key lookups and dimension joins.

No broadcast hints: Spark broadcasts a dimension when its known size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions.text import prefix_key


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[Column, Column]],
    output: str,
    take: str = "id",
    null_safe: Sequence[int] = (),
) -> DataFrame:
    """Add ``output``: the smallest ``take`` among dimension rows whose key
    expressions equal the fact expressions, or null.

    ``on`` pairs (fact expression, dimension expression); positions listed in
    ``null_safe`` treat null as equal to null. Keys are made unique first, so
    repeated names never multiply fact rows.
    """
    names = [f"__key{i}" for i in range(len(on))]
    keyed = dim.select(*[d.alias(n) for n, (_, d) in zip(names, on)], F.col(take).alias(output))
    keyed = keyed.groupBy(*names).agg(F.min(output).alias(output))
    probe = facts.withColumns({f"{n}f": f for n, (f, _) in zip(names, on)})
    condition = None
    for i, name in enumerate(names):
        left, right = F.col(f"{name}f"), F.col(name)
        match = left.eqNullSafe(right) if i in null_safe else left == right
        condition = match if condition is None else condition & match
    return probe.join(keyed, condition, "left").drop(*names, *[f"{n}f" for n in names])


def prefix_lookup(
    facts: DataFrame, dim: DataFrame, text: Column, name: str, output: str, length: int = 5
) -> DataFrame:
    """Lookup on the trimmed first ``length`` characters of both sides."""
    pair = (prefix_key(text, length), prefix_key(F.col(name), length))
    return lookup(facts, dim, [pair], output)


@dataclass(frozen=True)
class Dimension:
    """Left join of ``frame`` on ``ref = key``, bringing ``columns`` (source -> output)."""

    frame: DataFrame
    ref: str
    columns: Mapping[str, str] = field(default_factory=dict)
    key: str = "id"


def denormalise(facts: DataFrame, dims: Sequence[Dimension]) -> DataFrame:
    """Left joins in order; a later dimension may refer to a column an earlier one brought."""
    out = facts
    for dim in dims:
        ref = "__ref"
        brought = [F.col(s).alias(o) for s, o in dim.columns.items()]
        side = dim.frame.select(F.col(dim.key).alias(ref), *brought)
        out = out.join(side, out[dim.ref] == side[ref], "left").drop(ref)
    return out
