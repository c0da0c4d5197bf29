"""Small literal frames and report sheets."""

from __future__ import annotations

import datetime as dt

from dayledger.operators.maintenance import calendar
from dayledger.sources import schemas as S

DAY = dt.date


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


class Sheet:
    """Cells of one report; every row of the sheet has an entry in column 2."""

    def __init__(self, file, ogpd="28 May", field="Günəşli", platform="3", date="1/2/2025"):
        self.file = file
        self.cells = {
            (2, 5): ogpd,
            (3, 5): field,
            (4, 5): platform,
            (6, 5): date,
            (3, 18): "person",
            (4, 18): "phone",
        }
        self.next_row = S.FIRST_BODY_ROW

    def readings(self, r1=None, r2=None, r3=None, r4=None):
        self.cells |= {(3, 61): r1, (4, 61): r2, (3, 63): r3, (4, 63): r4}
        return self

    def well(self, name, **overrides):
        values = {
            2: "3", 4: name, 5: "Hasilat", 6: "Fəaliyyətdə", 7: "Qazlift", 8: "FLD", 9: "168",
            18: "F1", 19: "1/1/2025", 20: "100", 21: "60", 22: "40", 23: "45658", 24: "50",
            25: "20", 26: "2025-01-01", 27: "25", 28: "0,5", 29: "12,5", 36: "24", 38: "y",
            58: "24", 59: None, 62: None, 63: None,
        }
        values |= {int(k[1:]): v for k, v in overrides.items()}
        for column, value in values.items():
            self.cells[self.next_row, column] = value
        self.next_row += 1
        return self

    def end(self, comment=None, error=None):
        self.cells[self.next_row, 2] = None
        self.cells[self.next_row + 7, 26] = comment
        self.cells[self.next_row + 9, 6] = error
        return self

    def long_cells(self):
        last = max(r for r, _ in self.cells)
        dense = {(r, 2): None for r in range(last + 1)} | self.cells
        return [(self.file, r, c, v) for (r, c), v in dense.items()]


CELLS = "file string, row_idx int, col_idx int, value string"


def cells_frame(spark, *sheets):
    return spark.createDataFrame([c for s in sheets for c in s.long_cells()], CELLS)


DIMENSION_ROWS = {
    "ogpd": [(1, "28 May"), (2, "Neft Daşları")],
    "fields": [(1, "Günəşli", 1), (2, "Neft Daşları", 2), (3, "Palçıq Pilpiləsi", 2)],
    "platforms": [
        (1, "2", None, 1), (3, "3", None, 1), (8, "8", None, 1), (13, "13", None, 1), (20, "5", None, 1),
        (30, "3", None, 3), (31, "642", "642", 2), (32, "642", None, 2),
    ],
    "wells": [
        (100, "10", 3), (101, "11 ", 3), (102, "12", 3), (108, "81", 8), (113, "131", 13),
        (200, "70", 30), (201, "71", 31), (202, "71", 32), (120, "51", 20),
    ],
    "horizons": [(5, "FLD", 1, 0.8), (9, "FLD", 2, 0.86), (7, "QD-1", 2, 0.86)],
    "well_stock_categories": [(1, "Hasilat "), (2, "Təmir"), (3, "Ləğv")],
    "production_well_stock_sub_categories": [(1, "Fəaliyyətdə"), (2, "Fəaliyyətsiz")],
    "production_methods": [(1, "Qazlift"), (2, "Fontan")],
    "production_sub_skins_activities": [(1, "01.01 stop"), (2, "02.05 repair")],
}


def fill_dimensions(catalog):
    spark = catalog.spark
    catalog.create()
    for name, rows in DIMENSION_ROWS.items():
        catalog.replace(spark.createDataFrame(rows, S.DIMENSIONS[name]), name)
    catalog.replace(calendar(spark, DAY(2024, 1, 1), DAY(2026, 12, 31)), "report_dates")
