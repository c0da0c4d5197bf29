"""Run the batch load on each group of newly arrived cell files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from dayledger.plans.load import load_reports
from dayledger.sources.catalog import Catalog
from dayledger.sources.reports import report_rows

CELLS = "file string, row_idx int, col_idx int, value string"


def read_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of cell tables; every file holds whole sheets."""
    return spark.readStream.schema(CELLS).parquet(folder)


def load_arrivals(
    cells: DataFrame, catalog: Catalog, load_date: dt.date, checkpoint: str
) -> StreamingQuery:
    """Load what has arrived since the last run, then stop. A repeated batch
    inserts nothing, so a restart after a failure is safe; its findings are kept
    once more. Each batch is pivoted once, into a staged copy."""

    def load(batch: DataFrame, batch_id: int) -> None:
        load_reports(catalog.stage(report_rows(batch)), catalog, load_date)
        catalog.release()

    writer = cells.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
