"""Report files and sheets: discovery, cells to rows, header, body, footer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.functions.dates import cell_date
from dayledger.functions.numbers import number, number_cell
from dayledger.functions.text import decimal_point, file_extension, truthy, without_sentinel
from dayledger.sources import schemas as S

REPORT_EXTENSIONS = (".xls", ".xlsx")


def list_reports(
    spark: SparkSession,
    folder: str,
    recursive: bool = False,
    extensions: Sequence[str] = REPORT_EXTENSIONS,
) -> DataFrame:
    """(path, length) of report files; their content is not read."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return (
        reader.load(folder)
        .select("path", "length")
        .where(file_extension(F.col("path")).isin(*extensions))
    )


def report_rows(cells: DataFrame, columns: int = S.SHEET_COLUMNS) -> DataFrame:
    """Long cells (file, row_idx, col_idx, value) to wide rows (file, row_idx, c00...)."""
    positions = list(range(columns))
    wide = (
        cells.where(F.col("col_idx").between(0, columns - 1))
        .groupBy("file", "row_idx")
        .pivot("col_idx", positions)
        .agg(F.min("value"))
    )
    return wide.select("file", "row_idx", *[F.col(str(i)).alias(S.cell(i)) for i in positions])


def report_header(
    rows: DataFrame, cells: Mapping[str, tuple[int, int]] = S.HEADER_CELLS
) -> DataFrame:
    """One row per file with the named fixed cells. Only the header rows are read."""
    header = rows.where(F.col("row_idx").isin(*sorted({r for r, _ in cells.values()})))
    picks = [
        F.max(F.when(F.col("row_idx") == r, F.col(S.cell(c)))).alias(name)
        for name, (r, c) in cells.items()
    ]
    return header.groupBy("file").agg(*picks)


def body_ends(
    rows: DataFrame, start: int = S.FIRST_BODY_ROW, column: str = S.cell(S.END_COLUMN)
) -> DataFrame:
    """(file, end_row): the first body row whose ``column`` is empty."""
    empty = rows.where((F.col("row_idx") >= start) & F.col(column).isNull())
    return empty.groupBy("file").agg(F.min("row_idx").alias("end_row"))


def body_rows(
    rows: DataFrame,
    start: int = S.FIRST_BODY_ROW,
    column: str = S.cell(S.END_COLUMN),
    ends: DataFrame | None = None,
) -> DataFrame:
    """Rows from ``start`` up to the terminator, or to the last row without one.
    ``ends`` names the files to read: their columns come along."""
    body = rows.where((F.col("row_idx") >= start) & F.col(column).isNotNull())
    before_end = F.col("end_row").isNull() | (F.col("row_idx") < F.col("end_row"))
    if ends is None:
        return body.join(body_ends(rows, start, column), "file", "left").where(before_end)
    return body.join(ends, "file", "inner").where(before_end)


def report_footer(
    rows: DataFrame,
    ends: DataFrame,
    error_column: str = S.cell(S.FOOTER_ERROR_COLUMN),
    error_offsets: tuple[int, int] = S.FOOTER_ERROR_OFFSETS,
    comment_column: str = S.cell(S.FOOTER_COMMENT_COLUMN),
    comment_offset: int = S.FOOTER_COMMENT_OFFSET,
) -> DataFrame:
    """(file, end_row, has_error, general_comments) of files with a terminator.
    Cells beyond the end of a short sheet hold nothing."""
    cells = rows.select(
        "file", "row_idx", F.col(error_column).alias("e"), F.col(comment_column).alias("c")
    ).where(F.col("e").isNotNull() | F.col("c").isNotNull())
    offset = F.col("row_idx") - F.col("end_row")
    first, last = error_offsets
    near = offset.between(min(first, comment_offset), max(last, comment_offset))
    below = cells.withColumnRenamed("file", "__file")
    hits = ends.join(below, (F.col("file") == F.col("__file")) & near, "left")
    return hits.groupBy("file", "end_row").agg(
        F.bool_or(F.coalesce(offset.between(first, last) & truthy(F.col("e")), F.lit(False))).alias(
            "has_error"
        ),
        F.max(F.when(offset == comment_offset, F.col("c"))).alias("general_comments"),
    )


def _typed(text: Column, kind: str) -> Column:
    if kind.endswith("?"):
        return _typed_marked(text, kind[:-1])
    if kind == "date":
        return cell_date(text)
    if kind == "number":
        return number_cell(text, sentinel=False)
    return text


def _typed_marked(text: Column, kind: str) -> Column:
    if kind == "number":
        return number_cell(text, sentinel=True)
    plain = without_sentinel(text)
    if kind == "comma":
        return decimal_point(plain)
    if kind == "flag":
        return plain.try_cast("boolean")
    return plain


def well_records(body: DataFrame) -> DataFrame:
    """Body rows to typed records. Number columns are ``struct(value, status)``."""
    typed = [
        _typed(F.col(S.cell(i)), kind).alias(name) for i, (name, kind) in S.BODY_CELLS.items()
    ]
    carried = [c for c in body.columns if c not in {S.cell(i) for i in range(S.SHEET_COLUMNS)}]
    return body.select(*carried, *typed)


def number_columns() -> list[str]:
    return [name for name, kind in S.BODY_CELLS.values() if kind.rstrip("?") == "number"]


def flowmeter_block(header: DataFrame) -> DataFrame:
    """The header with numeric readings and the calibration date."""
    readings = {f"reading{i}": number(F.col(f"reading{i}_cell")) for i in range(1, 5)}
    dated = header.withColumns(readings | {"calibration_date": cell_date(F.col("calibration_cell"))})
    return dated.drop("calibration_cell", *[f"reading{i}_cell" for i in range(1, 5)])
