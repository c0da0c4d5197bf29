"""Declared schemas of the stored tables and the positions of sheet cells."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Fact:
    """A stored fact. ``key`` is unique; ``on`` is its day column; a fact with
    ``tracked`` columns stores changes only, others every new key."""

    ddl: str
    key: tuple[str, ...]
    on: str
    tracked: tuple[str, ...] = ()

    @property
    def by(self) -> tuple[str, ...]:
        return tuple(c for c in self.key if c != self.on)

    @property
    def state_order(self) -> tuple[str, ...]:
        """What orders the rows of an entity where its last one is its state: the day
        they were reported on, then that of the test."""
        return tuple(dict.fromkeys(("report_date_id", self.on)))


# Table and column names and types of the mart.
DIMENSIONS = {
    "ogpd": "id int, name string",
    "fields": "id int, name string, ogpd_id int",
    "platforms": "id int, name string, square string, field_id int",
    "wells": "id bigint, name string, platform_id int",
    "horizons": "id int, name string, field_id int, oil_density double",
    "well_stock_categories": "id int, name string",
    "production_well_stock_sub_categories": "id int, name string",
    "production_methods": "id int, name string",
    "production_sub_skins_activities": "id int, name string",
    "report_dates": "id int, report_date date",
}

PRESSURES = ("pqa", "phf", "pba", "p6x9", "p9x13", "p13x20", "choke")
PUMP_NUMBERS = (
    "pump_depth",
    "pump_frequency",
    "pump_hydrostatic_pressure",
    "esp_pump_size",
    "esp_pump_stages",
    "esp_pump_rate",
    "esp_pump_head",
)
ROD_AND_SCREW_NUMBERS = (
    "srp_pump_plunger_diameter",
    "srp_plunger_stroke_length",
    "srp_balancer_oscillation_frequency",
    "srp_pump_rate_coefficient",
    "srp_max_motor_speed",
    "srp_shaft_diameter",
    "pcp_pump_rate",
    "pcp_rpm",
    "pcp_screw_diameter",
    "static_fluid_level",
    "dynamic_fluid_level",
)
COMPLETION_TEXTS = (
    "casing",
    "completion_interval",
    "tubing1_depth",
    "tubing1_length",
    "tubing2_depth",
    "tubing2_length",
    "tubing3_depth",
    "tubing3_length",
    "packer_depth",
)
REPORTED_MEASURES = (
    "produced_oil",
    "produced_condensate",
    "produced_gas",
    "produced_water",
    "injected_water",
)


def _columns(names: tuple[str, ...], kind: str) -> str:
    return ", ".join(f"{n} {kind}" for n in names)


_WELL_DAY = "well_id bigint, report_date_id int"
_CREATED = "created_at date"

FACTS = {
    "flowmeters": Fact(
        "platform_id int, report_date_id int, "
        + _columns(("reading1", "reading2", "reading3", "reading4"), "double")
        + f", calibration_date date, {_CREATED}",
        ("platform_id", "report_date_id"),
        "report_date_id",
    ),
    "well_stock": Fact(
        f"{_WELL_DAY}, well_stock_category_id int, well_stock_sub_category_id int, "
        f"production_well_stock_sub_category_id int, production_method_id int, {_CREATED}",
        ("well_id", "report_date_id"),
        "report_date_id",
        (
            "well_stock_category_id",
            "production_well_stock_sub_category_id",
            "production_method_id",
        ),
    ),
    "completions": Fact(
        f"{_WELL_DAY}, horizon_id int, {_columns(COMPLETION_TEXTS, 'string')}, {_CREATED}",
        ("well_id", "report_date_id"),
        "report_date_id",
        ("horizon_id", *COMPLETION_TEXTS),
    ),
    "well_downtime_reasons": Fact(
        f"{_WELL_DAY}, downtime_category string, production_sub_skins_activity_id int, "
        f"comments string, {_CREATED}",
        ("well_id", "report_date_id"),
        "report_date_id",
        ("downtime_category", "production_sub_skins_activity_id", "comments"),
    ),
    "daily_well_parameters": Fact(
        f"{_WELL_DAY}, flowmeter string, well_uptime_hours double, "
        f"{_columns(PRESSURES, 'string')}, gaslift_gas double, gaslift_system_pressure string, "
        f"{_columns(PUMP_NUMBERS, 'double')}, esp_downhole_gas_separator boolean, "
        f"srp_pumpjack_type string, {_columns(ROD_AND_SCREW_NUMBERS, 'double')}, "
        f"responsible_person string, phone_number string, {_CREATED}",
        ("well_id", "report_date_id"),
        "report_date_id",
    ),
    "well_tests": Fact(
        f"{_WELL_DAY}, well_test_date date, "
        f"{_columns(('liquid_ton', 'oil_ton', 'water_ton'), 'double')}, {_CREATED}",
        ("well_id", "well_test_date"),
        "well_test_date",
    ),
    "gas_well_tests": Fact(
        f"{_WELL_DAY}, well_test_date date, "
        f"{_columns(('total_gas', 'gaslift_gas'), 'double')}, {_CREATED}",
        ("well_id", "well_test_date"),
        "well_test_date",
    ),
    "laboratory_results": Fact(
        f"{_WELL_DAY}, last_lab_date date, "
        f"{_columns(('water_cut', 'mechanical_impurities'), 'double')}, {_CREATED}",
        ("well_id", "last_lab_date"),
        "last_lab_date",
    ),
    "daily_general_comments": Fact(
        f"field_id int, platform string, report_date_id int, general_comments string, {_CREATED}",
        ("field_id", "platform", "report_date_id"),
        "report_date_id",
        ("general_comments",),
    ),
}

# Facts that are read as the last state of an entity.
STATES = (
    "well_stock", "completions", "well_downtime_reasons", "well_tests", "gas_well_tests",
    "laboratory_results", "daily_general_comments",
)

# Stored but not loaded from reports.
REPORTED = {
    "daily_operatives": f"ogpd_id int, report_date_id int, "
    f"{_columns(REPORTED_MEASURES, 'double')}, {_CREATED}",
    "monthly_reported": f"field_id int, report_date_id int, "
    f"{_columns(REPORTED_MEASURES, 'double')}, {_CREATED}",
}

REPORTED_KEYS = {
    "daily_operatives": ("ogpd_id", "report_date_id"),
    "monthly_reported": ("field_id", "report_date_id"),
}

TABLES = DIMENSIONS | {n: f.ddl for n, f in FACTS.items()} | REPORTED

# Positions in a report sheet, 0-based (row, column).
SHEET_COLUMNS = 64
FIRST_BODY_ROW = 14
END_COLUMN = 2
HEADER_CELLS = {
    "ogpd_name": (2, 5),
    "field_name": (3, 5),
    "platform_name": (4, 5),
    "report_date_cell": (6, 5),
    "responsible_person": (3, 18),
    "phone_number": (4, 18),
    "reading1_cell": (3, 61),
    "reading2_cell": (4, 61),
    "reading3_cell": (3, 63),
    "reading4_cell": (4, 63),
    "calibration_cell": (6, 61),
}
FOOTER_ERROR_COLUMN = 6
FOOTER_ERROR_OFFSETS = (7, 22)
FOOTER_COMMENT_COLUMN = 26
FOOTER_COMMENT_OFFSET = 7

# Body column -> (name, kind). Kinds: raw text; date; number;
# "?" after a kind allows the missing mark; comma is text with a decimal point.
BODY_CELLS = {
    2: ("row_platform", "raw"),
    3: ("square", "raw"),
    4: ("well_name", "raw"),
    5: ("category_name", "raw"),
    6: ("sub_category_name", "raw"),
    7: ("method_name", "raw"),
    8: ("horizon_name", "raw"),
    **{9 + i: (name, "raw") for i, name in enumerate(COMPLETION_TEXTS)},
    18: ("flowmeter", "raw"),
    19: ("last_well_test_date", "date"),
    20: ("liquid_ton", "number"),
    21: ("oil_ton", "number"),
    22: ("water_ton", "number"),
    23: ("last_gas_well_test_date", "date"),
    24: ("total_gas", "number"),
    25: ("gaslift_gas", "number"),
    26: ("last_lab_date", "date"),
    27: ("water_cut", "number"),
    28: ("mechanical_impurities", "number"),
    **{29 + i: (name, "comma?") for i, name in enumerate(PRESSURES)},
    36: ("gaslift_gas_day", "number?"),
    37: ("gaslift_system_pressure", "raw?"),
    **{38 + i: (name, "number?") for i, name in enumerate(PUMP_NUMBERS)},
    45: ("esp_downhole_gas_separator", "flag?"),
    46: ("srp_pumpjack_type", "raw?"),
    **{47 + i: (name, "number?") for i, name in enumerate(ROD_AND_SCREW_NUMBERS)},
    58: ("well_uptime_hours", "number?"),
    59: ("downtime_category", "raw"),
    62: ("activity_name", "raw"),
    63: ("comments", "raw"),
}


def cell(column: int) -> str:
    """Name of a sheet column in wide rows."""
    return f"c{column:02d}"
