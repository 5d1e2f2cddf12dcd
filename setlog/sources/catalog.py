"""Checks against the session catalog."""

from pyspark.sql import SparkSession


def require_tables(spark: SparkSession, names: list[str]) -> None:
    """An error naming the tables that don't exist."""
    missing = [name for name in names if not spark.catalog.tableExists(name)]
    if missing:
        raise ValueError(f"missing tables: {', '.join(sorted(missing))}")
