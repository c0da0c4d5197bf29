"""Written intermediate results: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def stage_at(df: DataFrame, folder: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet under a folder that all executors share and read it
    back; also its path, which the caller removes in the end."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stage_counted(
    df: DataFrame, folder: str, counts: Mapping[str, Column]
) -> tuple[DataFrame, dict[str, int]]:
    """``stage_at`` without the path, and aggregates that the writing tasks took."""
    seen = Observation()
    # behind an exchange, so that a stage that runs again is not counted again
    watched = df.hint("rebalance").observe(seen, *[c.alias(n) for n, c in counts.items()])
    return stage_at(watched, folder)[0], seen.get


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the folder all executors share. A local session without
    ``spark.checkpoint.dir``, as in tests, gets one of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = _own(spark.sparkContext.applicationId)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@lru_cache
def _own(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"dayledger-{application}-")
