"""``complete_table``: one wide row per well and day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayledger.functions.numbers import over, zero_if_null
from dayledger.operators.allocation import allocate, monthly_target
from dayledger.operators.asof import State, asof_join_many
from dayledger.operators.lookup import Dimension, denormalise
from dayledger.operators.picks import last_per_key
from dayledger.sources.schemas import (
    COMPLETION_TEXTS,
    PRESSURES,
    PUMP_NUMBERS,
    ROD_AND_SCREW_NUMBERS,
)
from dayledger.sources.seeds import DENSITY_FIELD

# Short names of the state structs.
STATES = {
    "ws": "well_stock",
    "c": "completions",
    "wdr": "well_downtime_reasons",
    "wt": "well_tests",
    "lr": "laboratory_results",
    "gwt": "gas_well_tests",
}
# Latest test date decides between results reported on one day.
TIES = {"wt": ["well_test_date"], "lr": ["last_lab_date"], "gwt": ["well_test_date"]}


def platform_label(name: Column, square: Column) -> Column:
    plain = square.isNull() | (square == "")
    return F.when(plain, name).otherwise(F.concat(name, F.lit(" / "), square))


def per_uptime(amount: Column, uptime: Column) -> Column:
    """A 24-hour amount for the hours the well ran."""
    return amount / 24 * uptime


def liquid_ton(wt: Column, uptime: Column) -> Column:
    return zero_if_null(F.round(per_uptime(wt["liquid_ton"], uptime), 0))


def _split(
    measured: Column, share: Column, wt: Column, lr: Column, uptime: Column,
    density: Column, field: Column, density_field: str,
) -> Column:
    water = lr["water_cut"] / 100
    mix = density * (1 - water) + water
    from_density = F.round(over(per_uptime(wt["liquid_ton"], uptime) * share, mix), 0)
    return (
        F.when(field != density_field, zero_if_null(per_uptime(measured, uptime)))
        .when((density == 0) & (lr["water_cut"] == 0), F.lit(0.0))
        .otherwise(zero_if_null(from_density))
    )


def with_production_calc(
    df: DataFrame,
    density_field: str = DENSITY_FIELD,
    wt: str = "wt",
    lr: str = "lr",
    uptime: str = "well_uptime_hours",
    density: str = "oil_density",
    field: str = "field",
) -> DataFrame:
    """Add ``oil_ton_wellTest`` and ``water_ton``. In the density field, or when
    the field is unknown, both come from liquid, density and water cut;
    elsewhere from the measured test."""
    w, l, u = F.col(wt), F.col(lr), F.col(uptime)
    d, f = F.col(density), F.col(field)
    water = l["water_cut"] / 100
    return df.withColumns(
        {
            "oil_ton_wellTest": _split(
                w["oil_ton"], d * (1 - water), w, l, u, d, f, density_field
            ),
            "water_ton": _split(w["water_ton"], water, w, l, u, d, f, density_field),
        }
    )


def measures(wt: Column, lr: Column, gwt: Column, uptime: Column) -> dict[str, Column]:
    """Computed measures that need no other row."""
    return {
        "liquid_ton": liquid_ton(wt, uptime),
        "oil_loss_ton_wellTest": wt["liquid_ton"]
        * ((100 - lr["water_cut"]) / 100)
        * (24 - uptime)
        / 24,
        "total_gas": F.round(per_uptime(gwt["total_gas"], uptime), 0),
        "gaslift_gas": F.round(per_uptime(gwt["gaslift_gas"], uptime), 0),
        "produced_gas": F.round((gwt["total_gas"] - gwt["gaslift_gas"]) * uptime / 24, 0),
        "mechanical_impurities": F.round(lr["mechanical_impurities"], 1),
    }


def states_as_of(
    tables: Mapping[str, DataFrame],
    base: Sequence[str] | None = None,
    states: Sequence[str] = tuple(STATES),
) -> DataFrame:
    """Daily parameters (or their ``base`` columns) with the states as structs:
    one shuffle by well.

    The base holds one row per well and day and every state one per well and
    day or test date, so a well's group is bounded by the calendar.
    """
    keys = ("well_id", "report_date_id")
    chosen = {}
    for short in states:
        frame = tables[STATES[short]]
        payload = [c for c in frame.columns if c not in (*keys, "created_at")]
        chosen[short] = State(frame, payload, TIES.get(short, ()))
    daily = tables["daily_well_parameters"]
    columns = base or [c for c in daily.columns if c not in (*keys, "created_at")]
    return asof_join_many(
        daily.select(*keys, *columns), chosen, ["well_id"], "report_date_id", unique=True
    )


def tables_of_days(tables: Mapping[str, DataFrame], first: int, last: int) -> dict[str, DataFrame]:
    """The tables, with only what the mart of these days depends on."""
    on = F.col("report_date_id")
    cut = dict(tables)
    cut["daily_well_parameters"] = tables["daily_well_parameters"].where(on.between(first, last))
    for short, name in STATES.items():
        frame, order = tables[name], ["report_date_id", *TIES.get(short, ())]
        before = last_per_key(frame.where(on < first), ["well_id"], order)
        cut[name] = frame.where(on.between(first, last)).unionByName(before)
    return cut


def _place_dimensions(tables: Mapping[str, DataFrame]) -> list[Dimension]:
    """Date, well, platform and field; platform and field are reached through the well."""
    return [
        Dimension(tables["report_dates"], "report_date_id", {"report_date": "report_date"}),
        Dimension(
            tables["wells"], "well_id", {"name": "well", "platform_id": "platform_id"}
        ),
        Dimension(
            tables["platforms"],
            "platform_id",
            {"name": "platform_name", "square": "square", "field_id": "platform_field_id"},
        ),
        Dimension(
            tables["fields"].withColumn("field_id", F.col("id")),
            "platform_field_id",
            {"name": "field", "field_id": "field_id"},
        ),
        Dimension(
            tables["horizons"], "horizon_id", {"name": "horizon", "oil_density": "oil_density"}
        ),
    ]


def _name_dimensions(tables: Mapping[str, DataFrame]) -> list[Dimension]:
    names = {
        "category_id": ("well_stock_categories", "well_stock_category"),
        "sub_category_id": (
            "production_well_stock_sub_categories",
            "production_well_stock_sub_category",
        ),
        "method_id": ("production_methods", "production_method"),
        "activity_id": ("production_sub_skins_activities", "production_skin"),
    }
    return [Dimension(tables[t], ref, {"name": output}) for ref, (t, output) in names.items()]


def oil_weights(tables: Mapping[str, DataFrame], density_field: str = DENSITY_FIELD) -> DataFrame:
    """The allocation weights alone: only the states and dimensions they depend on."""
    states = states_as_of(tables, ["well_uptime_hours"], ["c", "wt", "lr"])
    placed = states.withColumn("horizon_id", F.col("c")["horizon_id"])
    placed = denormalise(placed, _place_dimensions(tables))
    calc = with_production_calc(placed, density_field)
    return calc.select("field_id", "report_date", "oil_ton_wellTest")


def with_dimensions(states: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Nine left joins. The measures of a row ride along packed."""
    refs = {
        "category_id": F.col("ws")["well_stock_category_id"],
        "sub_category_id": F.col("ws")["production_well_stock_sub_category_id"],
        "method_id": F.col("ws")["production_method_id"],
        "horizon_id": F.col("c")["horizon_id"],
        "activity_id": F.col("wdr")["production_sub_skins_activity_id"],
    }
    keys = ["well_id", "report_date_id"]
    rest = F.struct(*[c for c in states.columns if c not in keys]).alias("__rest")
    packed = states.select(*keys, *[v.alias(n) for n, v in refs.items()], rest)
    dims = [*_place_dimensions(tables), *_name_dimensions(tables)]
    return denormalise(packed, dims).select("*", "__rest.*").drop("__rest")


def complete_table(
    tables: Mapping[str, DataFrame],
    density_field: str = DENSITY_FIELD,
    days: tuple[int, int] | None = None,
) -> DataFrame:
    """The mart; with ``days``, of those day numbers alone (first and last).

    A filter on the date cannot pass the as-of sweep, so a bounded read cuts the
    daily base, and each state to the range and its last row before it.
    """
    if days:
        tables = tables_of_days(tables, *days)
    wide = with_dimensions(states_as_of(tables), tables)
    wide = with_production_calc(wide, density_field)
    targets = monthly_target(tables["monthly_reported"], tables["report_dates"], "produced_oil")
    wide = allocate(
        wide,
        targets,
        "oil_ton_wellTest",
        "oil_ton_allocated",
        weights=oil_weights(tables, density_field),
    )
    ws, c, wdr, wt, lr, gwt = (F.col(s) for s in STATES)
    computed = measures(wt, lr, gwt, F.col("well_uptime_hours"))
    texts = [n for n in COMPLETION_TEXTS if n not in ("completion_interval", "packer_depth")]
    as_stored = {"pqa": "Pqa", "phf": "Phf", "pba": "Pba"}
    as_stored |= {"p6x9": "P6x9", "p9x13": "P9x13", "p13x20": "P13x20"}
    return wide.select(
        "report_date",
        "field",
        platform_label(F.col("platform_name"), F.col("square")).alias("platform"),
        "well",
        "well_stock_category",
        "production_well_stock_sub_category",
        "production_method",
        "horizon",
        *[c[name].alias(name) for name in ("completion_interval", *texts)],
        "flowmeter",
        "well_uptime_hours",
        computed["liquid_ton"].alias("liquid_ton"),
        "oil_ton_wellTest",
        lr["water_cut"].alias("water_cut"),
        "oil_ton_allocated",
        computed["oil_loss_ton_wellTest"].alias("oil_loss_ton_wellTest"),
        "water_ton",
        *[computed[n].alias(n) for n in ("total_gas", "gaslift_gas", "produced_gas", "mechanical_impurities")],
        *[F.col(name).alias(as_stored.get(name, name)) for name in PRESSURES],
        F.col("gaslift_gas").alias("gaslift_gas_daily"),
        "gaslift_system_pressure",
        *PUMP_NUMBERS,
        "esp_downhole_gas_separator",
        "srp_pumpjack_type",
        *ROD_AND_SCREW_NUMBERS,
        wdr["downtime_category"].alias("downtime_category"),
        "production_skin",
        wdr["comments"].alias("comments"),
    )
