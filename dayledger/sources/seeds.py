"""Literal rows to start a mart with. Long lists come from CSV files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Seed rows and one-off corrections.
CALENDAR_START = dt.date(2015, 1, 1)
CALENDAR_END = dt.date(2030, 1, 1)
OLD_CALENDAR_START = dt.date(2024, 1, 1)

SUB_CATEGORIES = [(1, "Fəaliyyətdə"), (2, "Fəaliyyətsiz"), (3, "Qazmadan mənimsədə")]
SUB_CATEGORY_RECODING = {1: 1, 2: 1, 3: 2, 4: 3}
DENSITY_FIELD = "Günəşli"
NEW_OGPD = [(2, "Neft Daşları")]
NEW_FIELDS = [(2, "Neft Daşları", 2), (3, "Palçıq Pilpiləsi", 2)]

# (field_id, report_date_id, produced_oil, produced_condensate, produced_gas),
# day numbers of the calendar that starts on OLD_CALENDAR_START.
MONTHLY_REPORTED = [
    (1, 397, 264262.0, 5300.0, 318128000.0),
    (2, 397, 91177.0, 0.0, 4786000.0),
    (3, 397, 5966.0, 0.0, 344000.0),
    (1, 425, 219196.0, 4950.0, 286915000.0),
    (2, 425, 82399.0, 0.0, 4302000.0),
    (3, 425, 5873.0, 0.0, 318000.0),
    (1, 456, 247803.0, 5950.0, 314625000.0),
    (2, 456, 93326.0, 0.0, 6008000.0),
    (3, 456, 6187.0, 0.0, 445000.0),
]


def seed(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def seed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Long seed lists (platforms, wells, horizons) kept as CSV with a header."""
    return spark.read.schema(schema).option("header", "true").csv(path)
