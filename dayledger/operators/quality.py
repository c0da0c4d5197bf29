"""Validation rules that explain themselves, and table integrity checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARNING, SUCCESS, INFO = LEVELS = "ERROR", "WARNING", "SUCCESS", "INFO"

FINDINGS = "findings"


@dataclass(frozen=True)
class Rule:
    """``condition`` true means the row breaks the rule; null means it passes."""

    code: str
    condition: Column
    message: str
    level: str = ERROR
    qc: bool = True
    stops: bool = False


def check(df: DataFrame, rules: Sequence[Rule], first_only: bool = False) -> DataFrame:
    """Add the array ``findings`` of the broken rules, in rule order.

    Every broken rule gives a finding; after a ``stops`` rule, or after any when
    ``first_only``, later rules of that row are not reported.
    """
    hits = []
    stopped = F.lit(False)
    for rule in rules:
        broken = F.coalesce(rule.condition, F.lit(False))
        hits.append(F.when(broken & ~stopped, _finding(rule)))
        if rule.stops or first_only:
            stopped = stopped | broken
    return df.withColumn(FINDINGS, F.array_compact(F.array(*hits)))


def _finding(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.level).alias("level"),
        F.lit(rule.code).alias("code"),
        F.lit(rule.message).alias("message"),
        F.lit(rule.qc).alias("qc"),
    )


def rejected() -> Column:
    """True for a checked row with at least one ERROR."""
    return F.exists(FINDINGS, lambda f: f["level"] == ERROR)


def findings_of(checked: DataFrame, subject: Sequence[str | Column]) -> DataFrame:
    """One row per finding: the ``subject`` columns and ``level, code, message, qc``."""
    exploded = checked.select(*subject, F.explode(FINDINGS).alias("__finding"))
    kept = [c for c in exploded.columns if c != "__finding"]
    return exploded.select(*kept, "__finding.*")


def validate(
    df: DataFrame,
    rules: Sequence[Rule],
    subject: Sequence[str | Column],
    first_only: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(rows without an ERROR, findings)."""
    checked = check(df, rules, first_only)
    return checked.where(~rejected()).drop(FINDINGS), findings_of(checked, subject)


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign-key values without a parent, and how many rows hold each. The
    child is counted per value before the join, so hot values stay cheap."""
    used = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("rows"))
    known = parent.select(F.col(pk).alias(fk))
    return used.join(known, fk, "left_anti")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per checked column: how many rows hold no value."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("rows")) for c in columns]
    )
    return counts.select(F.inline(pairs))


@dataclass(frozen=True)
class Constraint:
    """What a table declares of ``columns``: each not null (``not_null``), together
    held by one row (``unique``), or, of one column, held by ``parent`` (``refers``,
    to its column ``parent_key``)."""

    kind: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_key: str = "id"

    def name(self, table: str) -> str:
        target = f" -> {self.parent}.{self.parent_key}" if self.parent else ""
        return f"{table}({', '.join(self.columns)}) {self.kind}{target}"


def check_constraints(
    tables: Mapping[str, DataFrame], declared: Mapping[str, Sequence[Constraint]]
) -> DataFrame:
    """(constraint, checked, violations) for every declared constraint: rows checked,
    and rows that hold a null, a value the parent does not hold, or a key that another
    row holds too.

    Each table is scanned once, whatever it declares: a row becomes a (constraint, key)
    for each, these are counted map side, so a hot value is a row a task, and the keys
    of references meet the united parents in one anti-join. A null reference passes;
    nulls in unique keys equal each other.
    """
    pairs, parents = [], {}
    names: list[tuple[str, str]] = []
    for table, constraints in declared.items():
        parts = []
        for c in constraints:
            name = c.name(table)
            names.append((name, c.kind))
            if c.kind == "refers":
                key, bad = F.col(c.columns[0]).cast("string"), F.lit(False)
                parents[c.parent, c.parent_key] = None
            elif c.kind == "unique":
                key, bad = F.to_json(F.struct(*c.columns)), F.lit(False)
            else:
                bad = F.lit(False)
                for column in c.columns:
                    bad = bad | F.col(column).isNull()
                key = F.lit(None).cast("string")
            parent = F.lit(f"{c.parent}.{c.parent_key}" if c.parent else None).cast("string")
            parts.append(
                F.struct(F.lit(name).alias("constraint"), parent.alias("parent"), key.alias("key"), bad.alias("bad"))
            )
        if parts:
            pairs.append(tables[table].select(F.inline(F.array(*parts))))
    lines = reduce(DataFrame.unionByName, pairs)
    rows = F.count(F.lit(1)).alias("rows")
    counted = lines.groupBy("constraint", "parent", "key", "bad").agg(rows)
    known = [
        tables[table].select(F.lit(f"{table}.{key}").alias("parent"), F.col(key).cast("string").alias("key"))
        for table, key in parents
    ]
    if known:
        held = reduce(DataFrame.unionByName, known).where("key is not null").distinct().withColumn("held", F.lit(True))
        counted = counted.join(held, ["parent", "key"], "left")
    else:
        counted = counted.withColumn("held", F.lit(None).cast("boolean"))
    spark = lines.sparkSession
    all_names = spark.createDataFrame(names, "constraint string, kind string")
    orphan = F.col("key").isNotNull() & F.col("held").isNull()
    judged = counted.join(F.broadcast(all_names), "constraint").withColumn(
        "violates",
        F.when(F.col("kind") == "not_null", F.col("bad"))
        .when(F.col("kind") == "unique", F.col("rows") > 1)
        .otherwise(orphan),
    )
    totals = judged.groupBy("constraint").agg(
        F.sum("rows").alias("checked"), F.sum(F.when(F.col("violates"), F.col("rows")).otherwise(0)).alias("violations")
    )
    found = all_names.join(totals, "constraint", "left")
    none = F.lit(0).cast("bigint")
    return found.select("constraint", *[F.coalesce(c, none).alias(c) for c in ("checked", "violations")])


def findings_by_level(findings: DataFrame) -> DataFrame:
    return findings.groupBy("level").agg(F.count(F.lit(1)).alias("rows"))
