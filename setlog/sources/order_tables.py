"""Order tables read as a training log: orders are sessions, order lines are sets.

The mapping keeps every row and plants the cases the star has to handle: unlinked
dates, null types, padded and missing names, texts that are no numbers.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setlog.operators.ids import with_group_ids

ATHLETE = "atleta"
# Unique over all rows; the first four alone are not.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sesiones(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.lit(ATHLETE).alias("athlete"),
        F.expr("o_orderkey + 1").alias("id"),
        F.col("o_orderpriority").alias("sheet_name"),
        F.expr("cast(o_orderkey % 4 + 1 as int)").alias("numero_dia"),
        F.expr("concat('DÍA ', o_orderkey % 4 + 1)").alias("nombre_dia"),
        F.expr("concat('MICROCICLO ', o_orderkey % 6 + 1)").alias("microciclo"),
        F.expr("cast(o_orderkey % 6 + 1 as int)").alias("numero_microciclo"),
        F.expr("case when o_orderkey % 17 = 0 then null else o_orderdate end").alias("fecha"),
    )


_LINE = [*LINE_ORDER, "l_quantity", "l_discount"]
KILOS = "cast(floor(l_extendedprice / 500) as int)"


def _joined(spark: SparkSession, folder: str, lines: DataFrame, *own: str | Column) -> DataFrame:
    """Lines, with columns of their ``own``, beside their order and part. Only what the sets are made of moves on to
    the parts."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_custkey", "o_orderdate")
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type")
    ordered = lines.join(orders, "l_orderkey").select(
        *own, "l_orderkey", "l_partkey", "l_suppkey", "o_custkey", "o_orderdate", "o_orderpriority",
        F.expr("cast(l_quantity as int)").alias("reps"), F.expr("cast(round(l_discount * 100) as int)").alias("rir"))
    return ordered.join(parts, "l_partkey")


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines beside their order and part, without numbers: ``LINE_ORDER`` tells their order."""
    return _joined(spark, folder, table(spark, folder, "lineitem").select(*_LINE), "l_linenumber", "l_extendedprice")


def sets(lines: DataFrame, *own: str) -> DataFrame:
    """The sets that joined lines stand for, with columns of their ``own``."""
    whole_reps = "cast(reps as string)"
    return lines.select(
        *own, "l_orderkey", "o_custkey", "o_orderdate",
        F.lit(ATHLETE).alias("athlete"),
        F.expr("l_orderkey + 1").alias("sesion_id"),
        F.col("o_orderpriority").alias("sheet_name"),
        F.expr("cast(l_orderkey % 4 + 1 as int)").alias("numero_dia"),
        F.expr("concat('MICROCICLO ', l_orderkey % 6 + 1)").alias("microciclo"),
        F.expr("cast(l_orderkey % 6 + 1 as int)").alias("numero_microciclo"),
        F.expr("substr('ABCDEF', cast(l_suppkey % 6 + 1 as int), 1)").alias("grupo_ejercicio"),
        F.expr("case when l_partkey % 11 = 0 then null else p_type end").alias("tipo_ejercicio"),
        F.expr("case when l_partkey % 97 = 0 then 'nan' when l_partkey % 5 = 0"
               " then concat('  ', p_name, ' ') else p_name end").alias("nombre_ejercicio"),
        F.expr("case when l_partkey % 3 = 0 then concat('http://v/', l_partkey) end")
        .alias("url_ejercicio"),
        F.col("p_brand").alias("dosis"),
        "numero_serie",
        F.expr(f"case l_suppkey % 10 when 0 then '12-10' when 1 then concat({whole_reps}, '.0')"
               f" when 2 then concat({whole_reps}, '.5') else {whole_reps} end")
        .alias("repeticiones"),
        F.expr("case l_suppkey % 13 when 0 then 'PC' when 1 then null else"
               " concat(cast(kilos as string),"
               " case numero_serie % 4 when 0 then '' when 1 then '.5' when 2 then '.25'"
               " else '.0' end) end").alias("carga_kg"),
        F.expr("case l_suppkey % 7 when 0 then null else cast(rir as string) end").alias("rir_rpe"),
        F.lit(None).cast("string").alias("notas_ejercicio"),
        F.lit("RIR").alias("tipo_metrica"),
    )


def series(spark: SparkSession, folder: str) -> DataFrame:
    """Sets numbered in line order. Lines are numbered before anything is joined to them, by order, so that they
    move once for their number and their order."""
    numbered = with_group_ids(table(spark, folder, "lineitem").select(*_LINE), LINE_ORDER[:1], LINE_ORDER[1:])
    return sets(_joined(spark, folder, numbered, "id", F.col("l_linenumber").cast("int").alias("numero_serie"),
                        F.expr(KILOS).alias("kilos")), "id")
