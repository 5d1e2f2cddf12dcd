"""Writing and reading the star and the bronze tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlog.plans.silver import Star
from setlog.schemas import BRONZE_TABLES, SHEET_HOLDERS, SILVER_TABLES
from setlog.sources.versions import (
    checks, commit, next_version, publish, read_current, read_folders, versions, write_tables,
)

# Ranges of athletes and, within one, of time: a busy athlete spreads over several files.
FACT_LAYOUT = {"silver_fact_series": ["athlete", "fecha", "mesociclo", "serie_id"]}
# Row groups without an exercise are passed over; those of few exercises by their dictionaries.
FACT_BLOOMS = {"silver_fact_series": {"ejercicio_id": 50_000}}


def write_silver(star: Star, root: str, label: str = "") -> str:
    """Publish the four tables at once; the fact is laid out for reads of an athlete, a time
    or a mesocycle."""
    return publish(star.fact.sparkSession, root, star.tables(), SILVER_TABLES, label,
                   FACT_LAYOUT, FACT_BLOOMS)


def read_silver(spark: SparkSession, root: str) -> Star:
    tables = read_current(spark, root, SILVER_TABLES)
    if tables is None:
        raise ValueError(f"no silver tables under {root}")
    return Star(tables["silver_fact_series"], tables["silver_dim_ejercicios"],
                tables["silver_dim_fecha"], tables["silver_dim_plan"])


def sheet_holders(spark: SparkSession, root: str) -> DataFrame:
    """Per sheet the version and folder that hold its bronze rows, and their highest ids."""
    newest = versions(spark, root).orderBy(F.desc("version")).first()
    folders = [newest["folder"]] if newest else []
    return read_folders(spark, root, "sheet_holders", SHEET_HOLDERS, folders).drop("version")


def publish_sheets(sesiones: DataFrame, series: DataFrame, root: str, stay: DataFrame, label: str = "",
                   checked: bool = False) -> str:
    """Publish a version that holds these rows, and by reference those of the sheets in ``stay``, none of
    which are read or written. ``checked`` also refuses links that are missing and ids with gaps."""
    spark = series.sparkSession
    version, seen = next_version(spark, root), {}
    tables = {"bronze_sesiones": sesiones, "bronze_series": series}
    folder = write_tables(spark, root, version, tables, BRONZE_TABLES, seen=seen)
    sheet = ["athlete", "sheet_name"]
    tops = [read_folders(spark, root, name, BRONZE_TABLES[name], [folder]).groupBy(*sheet).agg(
        F.max("id").alias(f"top_{name}")) for name in tables]
    own = tops[0].join(tops[1], sheet, "full").withColumns(
        {"held": F.lit(version).cast("bigint"), "folder": F.lit(folder)})
    after = own.select(*SHEET_HOLDERS.names).unionByName(stay.select(*SHEET_HOLDERS.names))
    write_tables(spark, root, version, {"sheet_holders": after}, {"sheet_holders": SHEET_HOLDERS}, folder=folder, seen=seen)
    counted = seen if checked else {name: {"rows": n["rows"]} for name, n in seen.items()}
    commit(spark, root, version, folder, label, counted)
    return folder


def write_bronze(sesiones: DataFrame, series: DataFrame, root: str, label: str = "") -> str:
    """Publish whole bronze tables in place of what there was."""
    none = series.sparkSession.createDataFrame([], SHEET_HOLDERS)
    return publish_sheets(sesiones, series, root, none, label)


def read_bronze(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(sessions, sets) of the newest version; empty tables before the first.

    One scan each over the folders that hold live sheets. The newest version's own rows are all live, so
    that sheets are looked up only where older folders are read too.
    """
    newest = versions(spark, root).orderBy(F.desc("version")).first()
    if newest is None:
        return tuple(spark.createDataFrame([], schema) for schema in BRONZE_TABLES.values())
    holders = sheet_holders(spark, root)
    folders = {newest["folder"], *(r["folder"] for r in holders.select("folder").distinct().collect())}
    live = holders.select("athlete", "sheet_name", F.col("held").alias("version"))
    out = []
    for name, schema in BRONZE_TABLES.items():
        rows = read_folders(spark, root, name, schema, sorted(folders))
        if len(folders) > 1:
            rows = rows.join(live, ["athlete", "sheet_name", "version"], "left_semi")
        out.append(rows.drop("version"))
    return tuple(out)


def clean_bronze(spark: SparkSession, root: str) -> str:
    """Publish empty bronze tables."""
    empty = (spark.createDataFrame([], schema) for schema in BRONZE_TABLES.values())
    return write_bronze(*empty, root, "clean")


def verify_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Per table of the newest version the rows written and the links missing, as counted while writing."""
    newest = versions(spark, root).agg(F.max("version").alias("version"))
    return checks(spark, root).join(newest, "version", "left_semi")
