"""Conversation repair against a search over all edits, on odd and random turns."""

import random
import zlib
from functools import lru_cache
from hashlib import sha256

import pytest
from odd import CLASHING
from oracle import connect, differences
from pyspark.sql import functions as F

from dayledger.llm import conversations as C
from dayledger.llm import queries as Q

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    found = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if v is None else v for v in (role, text))
        own = found.setdefault(conv, [])
        match zlib.crc32(key.encode()) % 20:
            case 0:
                continue
            case 1:
                text = ""
            case 2:
                text = "".join(c for c in text if c not in ".!?")
            case 3:
                own.append((turn, role, text))
            case 4:
                role = "user"
        own.append((turn, role, text))
    for own in found.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha256(r[2].encode()).digest()))
    return found


def by_hand(conv, rows):
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        if not bare:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))

    @lru_cache(None)
    def best(i, state, inserted):
        """Least (cost, audit, lines) from row i; states by their last initial."""
        options = []
        after = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        role = {"u": "user", "a": "assistant"}[after]
        if inserted < 3:
            cost, audit, lines = best(i, after, inserted + 1)
            options.append((cost + 3, "I" + audit, ((role, ""), *lines)))
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
            return min(options, default=(10**9, "", ()))
        cost, audit, lines = best(i + 1, state, 0)
        options.append((cost + 4, "D" + audit, lines))
        if faults[i] not in ("blank", "duplicate"):
            late = 3 if faults[i] == "truncated" else 0
            _, own, text = rows[i]
            if own[:1] == after or (state == "" and own[:1] == "s"):
                cost, audit, lines = best(i + 1, own[:1], 0)
                options.append((cost + late, "K" + audit, ((own, text), *lines)))
            cost, audit, lines = best(i + 1, after, 0)
            options.append((cost + late + 3, "R" + audit, ((role, text), *lines)))
        return min(options)

    for i in range(len(rows), -1, -1):  # the later rows first, so that recursion stays shallow
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, lines = best(0, "", 0)
    text = "\n".join(f"{r}:{t}" for r, t in lines)
    counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
    return (conv, gaps, *counts, illegal, cost, audit, sha256(text.encode()).hexdigest())


def expected(rows):
    return sorted((by_hand(c, own) for c, own in damaged(rows).items()), key=str)


def found(docs, chunk=C.CHUNK):
    return sorted(map(tuple, C.repair(C.damage(docs), chunk).collect()), key=str)


def random_rows(n, convs, seed):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "and then", "", " \n", "Why?", "é. ", "ok.\t"]
    return [
        (
            draw.choice([*range(convs), None]),
            draw.choice([*range(12), 40, None]),
            draw.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "User", "sys"]),
            draw.choice([*texts, f"number {draw.randrange(99)}.", None]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("chunk", [1, 3, C.CHUNK])
def test_random_conversations(spark, chunk):
    rows = random_rows(500, 60, chunk)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert found(docs, chunk) == expected(rows)


def test_giant_conversation_over_many_batches(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(300)]
    rows += [(2, 0, "user", "x " * 100_000 + "."), (2, 1, "assistant", "."), (3, 5, "system", "Be kind.")]
    docs = spark.createDataFrame(rows, SCHEMA)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = found(docs, 50)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert got == expected(rows)


def test_empty_table_and_clashing_names(spark):
    rows = random_rows(40, 5, 9)
    names = [*CLASHING, "gone", "fault", "copy", "kind", "digest", "edits", "is_row", "cost", "audit", "gaps"]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("own").alias(c) for c in names))
    assert found(docs) == expected(rows)
    assert found(docs.where(F.lit(False))) == []


def test_conversation_that_loses_all_rows(spark):
    lost = next(i for i in range(999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    docs = spark.createDataFrame([(lost, 0, "user", "Hello.")], SCHEMA)
    assert found(docs) == [(lost, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert differences(Q.op12_conversation_repair(spark, folder), connect(folder), Q.OP12_SQL) == []
