"""Versioned table sets: all tables of a version become visible together.

A version is written to its own folder; one small record file in ``versions`` publishes it. The
record is written under a hidden name and put in place whole, in one step, only where none of its number
exists: of two writers of one version the second fails, and a writer that dies leaves nothing that
counts. (The step is a hard link on a local file system and a rename elsewhere, which has to be atomic
there, as on HDFS.) A failed write leaves readers on the previous version, and no path is overwritten
while a plan still reads it.

While a table is written its rows, ids and missing links are counted (observed metrics, no pass of
their own); ``commit`` refuses a version that doesn't hold what was counted, and keeps the counts in its record.
"""

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setlog.schemas import ID_COLUMNS, LINK_COLUMNS
from setlog.session import shuffles_freed

_LOG = "version long, folder string, label string"
_CHECKS = "version long, checks map<string, map<string, bigint>>"
_RECORD = re.compile(r"(\d+)\.json$")


class VersionTaken(RuntimeError):
    """Another writer published this version first."""


class BadVersion(RuntimeError):
    """The written tables don't hold what was counted while writing, or their links don't agree."""


def _records(spark: SparkSession, root: str, schema: str) -> DataFrame:
    try:
        rows = spark.read.schema(schema).json(f"{root}/versions")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    # A record cut short by older writers has no fields.
    return rows.filter(F.col("version").isNotNull())


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The publication log; empty when nothing was published yet. Other errors are raised."""
    return _records(spark, root, _LOG).filter(F.col("folder").isNotNull())


def checks(spark: SparkSession, root: str) -> DataFrame:
    """version, table and what was counted while it was written: ``rows``, and by column the ``missing`` links."""
    rows = _records(spark, root, _CHECKS).select("version", F.explode("checks").alias("table", "counts"))
    return rows.select("version", "table", F.col("counts")["rows"].alias("rows"), F.expr(
        "aggregate(map_values(map_filter(counts, (k, v) -> startswith(k, 'missing_'))), 0L, (a, x) -> a + x)"
    ).alias("missing"))


def _files(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def next_version(spark: SparkSession, root: str) -> int:
    """The number after the highest in use, even by a record that can't be read."""
    files, folder = _files(spark, f"{root}/versions")
    if not files.exists(folder):
        return 1
    names = [_RECORD.fullmatch(x.getPath().getName()) for x in files.listStatus(folder)]
    return max((int(m[1]) for m in names if m), default=0) + 1


def _counts(name: str, schema: T.StructType, links: dict[str, list[str]], ids: dict[str, str]) -> list:
    """What is counted of a table while it is written."""
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in links.get(name, ())]
    if name in ids:
        counts += [F.min(ids[name]).alias("first_id"), F.max(ids[name]).alias("last_id")]
    return counts


def write_tables(spark: SparkSession, root: str, version: int, tables: dict[str, DataFrame],
                 schemas: dict[str, T.StructType], sort: dict[str, list[str]] | None = None,
                 folder: str | None = None, seen: dict[str, dict] | None = None,
                 blooms: dict[str, dict[str, int]] | None = None) -> str:
    """Tables in a new folder of the version, not yet visible. Rows carry the version number.

    ``sort`` names columns by which a table is laid out in ranges and sorted within, so that
    row-group statistics prune; the number of files is that of the ranges. What is counted
    of each table is added to ``seen``. ``blooms`` names columns whose row groups get a bloom filter, with the
    distinct values that one is made for; more make it pass more row groups, never fewer.
    """
    folder = folder or f"v{version}-{uuid.uuid4().hex[:8]}"
    for name, df in tables.items():
        rows = conform(df, schemas[name]).withColumn("version", F.lit(version).cast("bigint"))
        if sort and name in sort:
            rows = rows.repartitionByRange(*sort[name]).sortWithinPartitions(*sort[name])
        counted = Observation()
        writer = rows.observe(counted, *_counts(name, schemas[name], LINK_COLUMNS, ID_COLUMNS)).write
        for column, distinct in (blooms or {}).get(name, {}).items():
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(
                f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
        with shuffles_freed(spark):
            writer.parquet(f"{root}/{folder}/{name}")
        if seen is not None:
            seen[name] = {k: v for k, v in counted.get.items() if v is not None}
    return folder


def verify(spark: SparkSession, root: str, folder: str, seen: dict[str, dict]) -> None:
    """``BadVersion`` unless each table holds the rows that were counted (its files' own counts), every link of a
    set leads somewhere, and ids run on without gaps."""
    wrong = []
    for name, counts in seen.items():
        stored = spark.read.parquet(f"{root}/{folder}/{name}").count()
        if stored != counts["rows"]:
            wrong.append(f"{name}: {counts['rows']} rows written, {stored} stored")
        wrong += [f"{name}: {n} rows without {k.removeprefix('missing_')}"
                  for k, n in counts.items() if k.startswith("missing_") and n]
        if "last_id" in counts and counts["last_id"] - counts["first_id"] + 1 != counts["rows"]:
            wrong.append(f"{name}: ids {counts['first_id']} to {counts['last_id']} for {counts['rows']} rows")
    if wrong:
        raise BadVersion("; ".join(wrong))


def commit(spark: SparkSession, root: str, version: int, folder: str, label: str = "",
           seen: dict[str, dict] | None = None) -> None:
    """Publish a written folder as ``version``; ``VersionTaken`` if that exists already, ``BadVersion`` if it isn't
    what ``seen`` counted."""
    verify(spark, root, folder, seen or {})
    files, path = _files(spark, f"{root}/versions/{version:010d}.json")
    _, claim = _files(spark, f"{root}/versions/.{version:010d}-{uuid.uuid4().hex}")
    record = {"version": version, "folder": folder, "label": label, "checks": seen or {}}
    out = files.create(claim, False)
    try:
        out.write(bytearray(json.dumps(record).encode() + b"\n"))
    finally:
        out.close()
    try:
        _put(spark, files, claim, path)
    except Py4JJavaError as error:
        if files.exists(path):
            raise VersionTaken(f"version {version} of {root} is published") from error
        raise
    finally:
        files.delete(claim, False)


def _put(spark: SparkSession, files, claim, path) -> None:
    """Give the claim its name in one step; an error if the name is taken."""
    jvm = spark._jvm
    if files.getScheme() == "file":
        def local(p):
            return jvm.java.nio.file.Path.of(files.makeQualified(p).toUri())
        jvm.java.nio.file.Files.createLink(local(path), local(claim))
        return
    nothing = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration()).rename(claim, path, nothing)


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame],
            schemas: dict[str, T.StructType], label: str = "",
            sort: dict[str, list[str]] | None = None, blooms: dict[str, dict[str, int]] | None = None) -> str:
    """Write every table to a new version folder, then publish it."""
    version, seen = next_version(spark, root), {}
    folder = write_tables(spark, root, version, tables, schemas, sort, seen=seen, blooms=blooms)
    commit(spark, root, version, folder, label, {name: {"rows": n["rows"]} for name, n in seen.items()})
    return folder


def read_current(spark: SparkSession, root: str,
                 schemas: dict[str, T.StructType]) -> dict[str, DataFrame] | None:
    """Tables of the newest published version, None before the first."""
    newest = versions(spark, root).orderBy(F.desc("version")).first()
    if newest is None:
        return None
    return {
        name: spark.read.schema(schema).parquet(f"{root}/{newest['folder']}/{name}")
        for name, schema in schemas.items()
    }


def read_folders(spark: SparkSession, root: str, name: str, schema: T.StructType,
                 folders: list[str]) -> DataFrame:
    """One table over the given version folders in one scan, with its ``version`` column."""
    full = T.StructType([*schema.fields, T.StructField("version", T.LongType())])
    if not folders:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(*(f"{root}/{f}/{name}" for f in folders))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order; missing ones are null, the load time is now."""
    columns = []
    for field in schema:
        if field.name in df.columns:
            column = F.col(field.name).cast(field.dataType)
        elif field.name == "fecha_carga":
            column = F.current_timestamp()
        else:
            column = F.lit(None).cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)
