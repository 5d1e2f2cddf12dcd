"""The star of a folder of order tables, built once per session and folder.

Metrics read the published silver tables, as a dashboard does; building them is a
separate step with its own queries.
"""

from pyspark.sql import DataFrame, SparkSession

from setlog.plans.bronze import Bronze, extract_bronze
from setlog.plans.silver import Star, build_star
from setlog.session import fresh_path
from setlog.sources import order_tables, sheet_tables
from setlog.sources.cells import read_cells
from setlog.sources.silver_store import read_bronze, read_silver, write_bronze, write_silver

_built: dict[tuple, object] = {}


def once(spark: SparkSession, folder: str, kind: str, build):
    """What ``build`` gives, built on first use in this session."""
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def bronze(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(sessions, sets) as published bronze tables."""
    def build():
        root = fresh_path(spark, "bronze")
        write_bronze(order_tables.sesiones(spark, folder), order_tables.series(spark, folder), root)
        return read_bronze(spark, root)
    return once(spark, folder, "bronze", build)


def star(spark: SparkSession, folder: str) -> Star:
    def build():
        sesiones, series = bronze(spark, folder)
        root = fresh_path(spark, "silver")
        write_silver(build_star(series, sesiones), root)
        return read_silver(spark, root)
    return once(spark, folder, "star", build)


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of the training sheets, written and read as a cell table."""
    def build():
        path = fresh_path(spark, "cells")
        sheet_tables.write_cells(spark, folder, path)
        return read_cells(spark, path)
    return once(spark, folder, "cells", build)


def sheet_bronze(spark: SparkSession, folder: str) -> Bronze:
    """Bronze tables read from the training sheets."""
    def build():
        found = extract_bronze(cells(spark, folder))
        root = fresh_path(spark, "sheet-bronze")
        write_bronze(found.sesiones, found.series, root)
        return Bronze(*read_bronze(spark, root), found.rejects)
    return once(spark, folder, "sheet-bronze", build)


def sheet_star(spark: SparkSession, folder: str) -> Star:
    """The star of all athletes' training sheets."""
    def build():
        bronze_tables = sheet_bronze(spark, folder)
        root = fresh_path(spark, "sheet-silver")
        write_silver(build_star(bronze_tables.series, bronze_tables.sesiones), root)
        return read_silver(spark, root)
    return once(spark, folder, "sheet-star", build)
