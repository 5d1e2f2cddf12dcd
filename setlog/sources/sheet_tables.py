"""Training sheets written from the order tables: each customer is an athlete with one
workbook, each order priority one of its sheets.

The reverse of the extraction: every line is a set placed in a grid by day, microcycle, letter
and set number, so reading the sheets has to give the same sets back.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from setlog.session import shuffles_freed
from setlog.sources.order_tables import KILOS, LINE_ORDER, lines, sets

_DAY_HEIGHT = 40
_MICRO_WIDTH = 6


#: Sheets of one customer and priority are made together.
_TOGETHER = ["o_custkey", "o_orderpriority"]


def placed_sets(spark: SparkSession, folder: str) -> DataFrame:
    """A place for every line: of lines that share one, the n-th in line order goes on the n-th sheet
    of its priority. First sheets stand from position 5 on, further ones before it. Exercise attributes are
    those of the first line of the (sheet, day, letter), session values those of the
    (sheet, day, microcycle).

    Lines move once, as they are, to their customer and priority, where they are numbered (``id``) and their sheets
    are made.
    """
    order = Window.partitionBy(*_TOGETHER).orderBy(*LINE_ORDER)
    moved = lines(spark, folder).repartition(*_TOGETHER).withColumns({
        "id": F.row_number().over(order), "numero_serie": F.col("l_linenumber").cast("int"), "kilos": F.expr(KILOS)})
    found = sets(moved, "id", "o_orderpriority").withColumn("k", F.expr("(numero_serie - 1) % 5 + 1"))
    place = Window.partitionBy(*_TOGETHER, "numero_dia", "numero_microciclo", "grupo_ejercicio", "k").orderBy("id")
    return found.withColumn("copy", F.row_number().over(place)).select(
        F.concat(F.lit("20240101atleta"), F.col("o_custkey"), F.lit(".xlsx")).alias("workbook"),
        F.expr("concat('Meso ', sheet_name, if(copy > 1, concat(' ', copy), ''))").alias("sheet_name"),
        F.expr("if(copy > 1, 1, 4 + cast(substr(sheet_name, 1, 1) as int))").alias("sheet_pos"),
        F.col("numero_dia").alias("day"), F.col("numero_microciclo").alias("micro"),
        F.col("grupo_ejercicio").alias("letter"), "k", "id", "repeticiones", "carga_kg", "rir_rpe",
        "tipo_ejercicio", "nombre_ejercicio", "url_ejercicio", "dosis", "l_orderkey", "o_orderdate", *_TOGETHER)


def write_cells(spark: SparkSession, folder: str, path: str) -> None:
    """The cells of all placed sets, written as they are made; then the titles of the workbooks written."""
    with shuffles_freed(spark):
        _set_cells(placed_sets(spark, folder), _TOGETHER).write.parquet(path)
        _titles(spark.read.parquet(path)).write.mode("append").parquet(path)


def _cell(row: Column, col: Column | int, value: Column) -> Column:
    return F.struct(row.cast("int").alias("row_idx"),
                    (F.lit(col) if isinstance(col, int) else col).cast("int").alias("col_idx"),
                    value.cast("string").alias("value"))


def _no_cells() -> Column:
    return F.array().cast("array<struct<row_idx:int,col_idx:int,value:string>>")


def _if_first(first: str, *cells: Column) -> Column:
    return F.when(F.col(first), F.array(*cells)).otherwise(_no_cells())


_SHEET = ["workbook", "sheet_name", "sheet_pos"]


def sheet_cells(sets: DataFrame) -> DataFrame:
    """All cells of the sheets that hold the given sets, and per workbook a title sheet in front
    and a sheet of notes among the later positions. Sets move once, to their sheet."""
    return _set_cells(sets.repartition(*_SHEET)).unionByName(_titles(sets))


def _titles(rows: DataFrame) -> DataFrame:
    """The one cell each of the title sheet and the notes, by workbook."""
    others = F.inline(F.array(*(F.struct(F.lit(name).alias("sheet_name"), F.lit(pos).alias("sheet_pos"))
                                for name, pos in (("Resumen", 0), ("Notas", 12)))))
    return rows.select("workbook").distinct().select("workbook", others).select(
        "*", F.lit(0).alias("row_idx"), F.lit(0).alias("col_idx"), F.col("sheet_name").alias("value"),
        F.lit("str").alias("value_type"))


def _set_cells(sets: DataFrame, together: Sequence[str] = ()) -> DataFrame:
    """The cells of sets that lie with their sheet's, by ``together`` or by sheet. What an exercise, a session or a
    sheet has once stands beside its set of the lowest id."""
    sheet = _SHEET
    start = (F.col("day") - 1) * _DAY_HEIGHT
    left = F.lit(7) + (F.col("micro") - 1) * _MICRO_WIDTH
    row = start + 10 + (F.ascii("letter") - 65) * 4

    def lowest(within: str | None, *by: str) -> Column:
        ids = F.col("id") if within is None else F.when(F.col(within), F.col("id"))
        return F.col("id") == F.min(ids).over(Window.partitionBy("sheet_key", *sheet, *together, *by))
    # Each is looked for among the lowest ids of smaller groups, so that Spark keeps the order of the windows, the
    # first three of which share one sort.
    first = sets.withColumn("sheet_key", F.xxhash64(*sheet)).withColumn(
        "of_block", lowest(None, "day", "letter", "micro")).withColumn(
        "of_exercise", lowest("of_block", "day", "letter")).withColumn("of_sheet", lowest("of_exercise")).withColumn(
        "of_session", lowest("of_block", "day", "micro"))

    name = F.when(F.col("url_ejercicio").isNull(), F.col("nombre_ejercicio")).otherwise(
        F.concat("nombre_ejercicio", F.lit(" "), "url_ejercicio"))
    date = F.expr("case when l_orderkey % 17 = 0 then '#REF!'"
                  " else date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') end")
    fixed = [(d * _DAY_HEIGHT + r, c, v) for d in range(4) for r, c, v in (
        (0, 0, f"DÍA {d + 1}"), (1, 1, "FECHA"), (2, 1, "PRS"), (3, 1, "RPE"), (39, 1, "FIN"))]
    fixed += [(0, 7 + m * _MICRO_WIDTH, f"MICROCICLO {m + 1}") for m in range(6)]
    # Sheets of the last priority also hold what the layout leaves out.
    beyond = [(2, 60, "RPE"), (40, 8, "MICROCICLO 9"), (178, 0, "F"), (190, 3, "fin")]
    fixed, beyond, sixth = ([_cell(F.lit(r), c, F.lit(v)) for r, c, v in cells] for cells in (
        fixed, beyond, [(11, 43, "9")]))
    last = F.col("sheet_name").like("Meso 5%")
    cells = first.withColumn("of_last", F.col("of_sheet") & last).withColumn(
        "of_sixth", F.col("of_exercise") & last & (F.col("day") == 1) & (F.col("letter") == "A")).select(*sheet, F.inline(F.concat(
            F.array(_cell(row + 1, left + F.col("k") - 1, F.col("repeticiones")),
                    _cell(row + 2, left + F.col("k") - 1, F.col("carga_kg")),
                    _cell(row + 3, left + F.col("k") - 1, F.col("rir_rpe"))),
            _if_first("of_block", _cell(row, left, F.col("dosis"))),
            _if_first("of_exercise", _cell(row, 0, F.col("letter")), _cell(row, 1, F.col("tipo_ejercicio")),
                      _cell(row + 1, 1, name)),
            _if_first("of_session", _cell(start + 1, left + 2, date), _cell(start + 1, left + 4, F.lit("18:30:00")),
                      _cell(start + 2, left + 1, F.expr("case when l_orderkey % 3 = 0 then 'x' end")),
                      _cell(start + 2, left + 2, F.expr("case when l_orderkey % 997 = 0 then '150'"
                                                        " else concat(l_orderkey % 10, '.5') end")),
                      _cell(start + 3, left + 1, F.expr("cast(l_orderkey % 10 + 1 as string)"))),
            _if_first("of_sheet", *fixed), _if_first("of_last", *beyond), _if_first("of_sixth", *sixth))))
    return cells.filter(F.col("value").isNotNull()).withColumn("value_type", F.lit("str"))
