"""Mart-shaped frames derived from the sample tables (events, orders, ...)."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.operators.maintenance import calendar, day_number
from dayledger.operators.picks import first_per_key, number_rows
from dayledger.sources import schemas as S
from dayledger.sources.seeds import CALENDAR_END, CALENDAR_START

# Schemas of the sample tables this library reads.
SAMPLE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

MONTH_END = dt.date(2024, 1, 31)


def _k() -> Column:
    return F.col("k")


def _text(column: Column) -> Column:
    return column.cast("string")


class Samples:
    """Lazy frames over one folder of sample tables; wells are event users."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read.schema(SAMPLE_TABLES[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        number = F.regexp_extract("props", "[0-9]+", 0).cast("int")
        return self.table("events").select(
            "event_id",
            F.col("ts").cast("date").alias("d"),
            "user_id",
            "event_type",
            "value",
            number.alias("k"),
        )

    def _first(self, event_type: str) -> DataFrame:
        """First event of a type per well and day."""
        typed = self.events.where(F.col("event_type") == event_type)
        first = first_per_key(typed, ["user_id", "d"], ["event_id"])
        return first.withColumnRenamed("user_id", "well_id")

    # Dimensions.

    @cached_property
    def fields(self) -> DataFrame:
        region = self.table("region")
        return region.select((F.col("r_regionkey") + 1).alias("id"), F.col("r_name").alias("name"))

    @cached_property
    def platforms(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.table("nation").select(
            key.alias("id"),
            F.col("n_name").alias("name"),
            F.when(key % 3 != 0, _text(F.col("n_regionkey"))).alias("square"),
            (F.col("n_regionkey") + 1).alias("field_id"),
        )

    @cached_property
    def wells(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("platform_id"),
        )

    @cached_property
    def horizons(self) -> DataFrame:
        size = F.col("p_size")
        density = F.lit(0.7) + (size % 20) / F.lit(100.0)
        return self.table("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_brand").alias("name"),
            (1 + size % 5).alias("field_id"),
            density.alias("oil_density"),
        )

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar(self.spark, CALENDAR_START, CALENDAR_END)

    # Facts, keyed by the date ``d``.

    @cached_property
    def daily(self) -> DataFrame:
        grouped = self.events.groupBy(F.col("user_id").alias("well_id"), "d")
        return grouped.agg(
            (F.max("k") % 25).cast("double").alias("well_uptime_hours"),
            F.min("value").alias("pqa"),
            F.count(F.lit(1)).alias("n_events"),
        )

    @cached_property
    def well_stock_raw(self) -> DataFrame:
        return self._first("view").select(
            "well_id",
            "d",
            "event_id",
            (1 + _k() % 2).alias("category_id"),
            (1 + _k() % 3).alias("sub_category_id"),
            F.when(_k() % 5 != 0, 1 + _k() % 4).alias("method_id"),
        )

    @cached_property
    def stock_events(self) -> DataFrame:
        """Stock rows of every view, several of a well and day."""
        views = self.events.where(F.col("event_type") == "view")
        method = F.when(_k() % 5 != 0, 1 + _k() % 2)
        return views.select(
            F.col("user_id").alias("well_id"), "d", "event_id", (_k() % 2).alias("category_id"), method.alias("method_id")
        )

    @cached_property
    def completions_raw(self) -> DataFrame:
        return self._first("click").select(
            "well_id", "d", "event_id", _k().alias("horizon_id"), _text(_k() % 3).alias("casing")
        )

    @cached_property
    def downtime_raw(self) -> DataFrame:
        comment = F.when(_k() % 7 != 0, F.concat(F.lit("c"), _text(_k() % 3)))
        return self._first("error").select(
            "well_id", "d", "event_id", (_k() % 5).alias("category"), comment.alias("comments")
        )

    @cached_property
    def well_tests(self) -> DataFrame:
        value = F.col("value")
        return self._first("purchase").select(
            "well_id",
            "d",
            "event_id",
            F.date_sub("d", _k() % 20).alias("well_test_date"),
            (value * 3).alias("liquid_ton"),
            (value * 2).alias("oil_ton"),
            value.alias("water_ton"),
        )

    @cached_property
    def gas_well_tests(self) -> DataFrame:
        value = F.col("value")
        return self._first("purchase").select(
            "well_id",
            "d",
            "event_id",
            F.date_sub("d", _k() % 20).alias("well_test_date"),
            (value * 10).alias("total_gas"),
            (value * (_k() % 12)).alias("gaslift_gas"),
        )

    @cached_property
    def lab(self) -> DataFrame:
        return self._first("signup").select(
            "well_id",
            "d",
            "event_id",
            F.date_sub("d", _k() % 9).alias("lab_date"),
            _k().cast("double").alias("water_cut"),
            (_k() % 7).cast("double").alias("mechanical_impurities"),
        )

    @cached_property
    def monthly(self) -> DataFrame:
        return self.fields.where("id < 5").select(
            F.col("id").alias("field_id"),
            F.lit(MONTH_END).alias("report_date"),
            (1000 * F.col("id")).cast("double").alias("produced_oil"),
        )

    @cached_property
    def meter(self) -> DataFrame:
        grouped = self.events.groupBy(F.col("user_id").alias("meter_id"), "d")
        return grouped.agg(
            (F.min("k") % 5).alias("reading1"), (F.max("k") % 5).alias("reading2")
        )

    @cached_property
    def meter_events(self) -> DataFrame:
        """Readings of every event, several of a meter and day."""
        closing = F.when(_k() % 7 != 0, F.floor(_k() / 3) % 3)
        return self.events.select(
            F.col("user_id").alias("meter_id"),
            "d",
            "event_id",
            (_k() % 3).cast("double").alias("reading1"),
            closing.cast("double").alias("reading2"),
        )

    @cached_property
    def report_rows(self) -> DataFrame:
        """One sheet per user: a row per event from row 14 on."""
        numbered = number_rows(self.events, "user_id", "event_id", "n")
        comma = F.replace(_text(F.col("value")), F.lit("."), F.lit(","))
        number = F.when(_k() % 10 == 0, "y").when(_k() % 11 == 0, None).when(_k() % 13 == 0, "abc")
        date = (
            F.when(_k() % 6 == 0, "45300.25")
            .when(_k() % 6 == 1, "1/9/2024")
            .when(_k() % 6 == 2, "500")
            .when(_k() % 6 == 3, "not a date")
            .when(_k() % 6 == 4, F.concat(_text(F.col("d")), F.lit("T"), F.lpad(_text(_k() % 24), 2, "0"), F.lit(":30:00.000Z")))
            .otherwise("20000")
        )
        return numbered.select(
            F.concat(F.lit("r"), _text(F.col("user_id"))).alias("file"),
            (13 + F.col("n")).cast("int").alias("row_idx"),
            F.when(_k() != 99, _text(_k() % 9)).alias("c02"),
            F.concat(F.lit(" "), "event_type", F.lit(" ")).alias("c05"),
            number.otherwise(comma).alias("c20"),
            date.alias("c19"),
        )

    # The same in the shape of the stored tables.

    @cached_property
    def mart_dimensions(self) -> dict[str, DataFrame]:
        names = self.fields.select("id", "name")
        return {
            "fields": names,
            "platforms": self.platforms,
            "wells": self.wells,
            "horizons": self.horizons,
            "well_stock_categories": names,
            "production_well_stock_sub_categories": names,
            "production_methods": names,
            "production_sub_skins_activities": names,
            "report_dates": self.calendar,
        }

    @cached_property
    def mart_tables(self) -> dict[str, DataFrame]:
        day = day_number(F.col("d"), CALENDAR_START).alias("report_date_id")

        def fact(name: str, df: DataFrame, **renamed: str) -> DataFrame:
            have = df.withColumns({new: F.col(old) for old, new in renamed.items()})
            have = have.withColumn("report_date_id", day)
            return shaped(have, S.TABLES[name])

        return self.mart_dimensions | {
            "well_stock": fact(
                "well_stock",
                self.well_stock_raw,
                category_id="well_stock_category_id",
                sub_category_id="production_well_stock_sub_category_id",
                method_id="production_method_id",
            ),
            "completions": fact("completions", self.completions_raw),
            "well_downtime_reasons": fact(
                "well_downtime_reasons",
                self.downtime_raw.withColumn("activity", F.col("category") + 1),
                category="downtime_category",
                activity="production_sub_skins_activity_id",
            ),
            "daily_well_parameters": fact("daily_well_parameters", self.daily),
            "well_tests": fact("well_tests", self.well_tests),
            "gas_well_tests": fact("gas_well_tests", self.gas_well_tests),
            "laboratory_results": fact("laboratory_results", self.lab, lab_date="last_lab_date"),
            "monthly_reported": shaped(
                self.monthly.withColumn(
                    "report_date_id", day_number(F.col("report_date"), CALENDAR_START)
                ),
                S.TABLES["monthly_reported"],
            ),
        }


def shaped(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of a stored table; those the sample does not have are null."""
    have = set(df.columns)
    columns = [c.strip().split(" ") for c in ddl.split(",")]
    return df.select(
        *[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in columns]
    )
