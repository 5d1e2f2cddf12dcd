"""Cell tables: the long form of workbook sheets, one row per non-empty cell."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setlog.functions.fixed import EMPTY_TEXTS, FIRST_MESO_POSITION, SHEET_MARK
from setlog.schemas import CELLS

_FILE = r"^(?:\d{8})?(.*?)(?:\.[A-Za-z]+)?$"


def read_cells(spark: SparkSession, path: str | list[str], source: str = "parquet",
               multi_line: bool = False) -> DataFrame:
    """Cells from Parquet or CSV (with a header). Texts that stand for nothing become
    null, but their row still counts as part of the sheet.

    CSV files whose values hold line breaks need ``multi_line``; such a file is one task.
    """
    reader = spark.read.schema(CELLS)
    cells = reader.csv(path, header=True, quote='"', escape='"', multiLine=multi_line) \
        if source == "csv" else reader.format(source).load(path)
    return blank_empty_texts(cells)


def blank_empty_texts(cells: DataFrame) -> DataFrame:
    return cells.withColumn(
        "value", F.when(~F.col("value").isin(*EMPTY_TEXTS), F.col("value")))


def athlete_of(workbook: Column) -> Column:
    """'20240131Ana.xlsx' belongs to 'Ana'."""
    return F.regexp_extract(workbook, _FILE, 1)


def meso_sheets(cells: DataFrame) -> DataFrame:
    """Cells of training sheets, told by their name."""
    return cells.filter(F.col("sheet_name").contains(SHEET_MARK))


def sheets_from_position(cells: DataFrame, first: int = FIRST_MESO_POSITION) -> DataFrame:
    """Cells of all sheets from a position on, whatever their name."""
    return cells.filter(F.col("sheet_pos") >= first)


def require_meso_sheets(cells: DataFrame) -> DataFrame:
    """Cells of training sheets; an error if there are none."""
    chosen = meso_sheets(cells)
    if chosen.isEmpty():
        raise ValueError(f"no sheet with {SHEET_MARK!r} in its name")
    return chosen


def workbooks_without_meso(cells: DataFrame) -> DataFrame:
    """Workbooks that have no training sheet."""
    return cells.groupBy("workbook").agg(
        F.bool_or(F.col("sheet_name").contains(SHEET_MARK)).alias("has")
    ).filter(~F.col("has")).select("workbook")


def latest_snapshot(workbooks: DataFrame) -> DataFrame:
    """The newest workbook of each athlete: dated names sort in time."""
    return workbooks.groupBy(athlete_of(F.col("workbook")).alias("athlete")).agg(
        F.max("workbook").alias("workbook"))
