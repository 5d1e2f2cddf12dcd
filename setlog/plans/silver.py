"""Bronze sessions and sets to a star: three dimensions and one set-level fact."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setlog.functions.calendar import weekday, weekday_name
from setlog.functions.casts import text_to_int, text_to_load
from setlog.functions.fixed import MISSING_NAME
from setlog.operators.ids import staged, with_dense_id, with_group_ids

BLOCK_BITS = 14  # bronze ids that the fact numbers together: 2^14


@dataclass(frozen=True)
class Star:
    """The four silver tables."""

    fact: DataFrame
    exercises: DataFrame
    dates: DataFrame
    plans: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "silver_dim_ejercicios": self.exercises,
            "silver_dim_fecha": self.dates,
            "silver_dim_plan": self.plans,
            "silver_fact_series": self.fact,
        }


def _named(series: DataFrame) -> DataFrame:
    """Sets with a usable exercise name, the name trimmed of blanks."""
    name = F.trim("nombre_ejercicio")
    return series.withColumn("nombre_ejercicio", name).filter(
        F.col("nombre_ejercicio").isNotNull()
        & ~F.col("nombre_ejercicio").isin("", MISSING_NAME)
    )


def dim_ejercicios(series: DataFrame, first_non_null: bool = False) -> DataFrame:
    """One row per athlete and trimmed exercise name.

    Type and link are those of the set with the lowest id, null included; with
    ``first_non_null`` each is the first one present. The big input is reduced by a hash
    aggregation on (name, type, link) first, so a popular exercise never meets in one
    task and only the few distinct combinations are compared.
    """
    variants = (
        _named(series)
        .groupBy("athlete", "nombre_ejercicio", "tipo_ejercicio", "url_ejercicio")
        .agg(F.min("id").alias("id"))
    )
    if first_non_null:
        picked = [
            F.min_by("tipo_ejercicio", F.when(F.col("tipo_ejercicio").isNotNull(), F.col("id"))),
            F.min_by("url_ejercicio", F.when(F.col("url_ejercicio").isNotNull(), F.col("id"))),
        ]
    else:
        first = F.min_by(F.struct("tipo_ejercicio", "url_ejercicio"), "id")
        picked = [first["tipo_ejercicio"], first["url_ejercicio"]]
    dim = variants.groupBy("athlete", "nombre_ejercicio").agg(
        picked[0].alias("tipo_ejercicio"), picked[1].alias("url_video")
    )
    return with_dense_id(dim, ["athlete", "nombre_ejercicio"], "ejercicio_id")


def dim_fecha(sesiones: DataFrame) -> DataFrame:
    """One row per distinct session timestamp, numbered in time order.

    The row holds the date only, so two times on one day make two rows.
    """
    moments = (
        sesiones.filter(F.col("fecha").isNotNull())
        .select("athlete", F.col("fecha").alias("_moment"))
        .distinct()
    )
    day = F.col("_moment").cast("date")
    return with_dense_id(moments, ["athlete", "_moment"], "fecha_id").select(
        "athlete",
        "fecha_id",
        day.alias("fecha"),
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        F.dayofmonth(day).alias("dia"),
        weekday(day).alias("dia_semana"),
        weekday_name(day).alias("nombre_dia_semana"),
        F.weekofyear(day).alias("semana_anio"),
    )


def dim_plan(sesiones: DataFrame) -> DataFrame:
    """One row per distinct sheet, day and microcycle, labels included."""
    keys = ["athlete", "sheet_name", "numero_dia", "nombre_dia", "microciclo", "numero_microciclo"]
    order = ["athlete", "sheet_name", "numero_dia", "numero_microciclo", "nombre_dia", "microciclo"]
    return with_dense_id(sesiones.select(*keys).distinct(), order, "plan_id").withColumn(
        "mesociclo", F.col("sheet_name")
    )


def dated_sessions(sesiones: DataFrame, dates: DataFrame) -> DataFrame:
    """Sessions with their date row. A session matches at midnight only, so one with a
    time of day has no date. Done per session, long before the sets are touched."""
    days = dates.select(
        "athlete", "fecha_id", F.col("fecha").cast("timestamp_ntz").alias("fecha"),
        F.col("fecha").alias("dia_fecha"),
    )
    return sesiones.select("athlete", F.col("id").alias("sesion_id"), "fecha").join(
        days, ["athlete", "fecha"], "left"
    ).select("sesion_id", "fecha_id", F.col("dia_fecha").alias("fecha"))


def linked_sets(series: DataFrame, exercises: DataFrame, plans: DataFrame) -> DataFrame:
    """Sets linked to exercise and plan, in blocks of bronze ids; texts that only a number is made of are numbers.

    No join carries a broadcast hint: a dimension under Spark's size threshold is
    broadcast, a larger one is shuffled and a hot key split by adaptive execution.
    """
    plan_keys = ["athlete", "sheet_name", "numero_dia", "numero_microciclo"]
    return (
        _named(series)
        .join(exercises.select("athlete", "nombre_ejercicio", "ejercicio_id"),
              ["athlete", "nombre_ejercicio"], "left")
        .join(plans.select(*plan_keys, "plan_id", "mesociclo"), plan_keys, "left")
        .select(
            "athlete", "id", "sesion_id", "ejercicio_id", "plan_id",
            "grupo_ejercicio", "numero_serie",
            F.col("repeticiones").alias("repeticiones_texto"),
            text_to_load(F.col("carga_kg")).alias("carga_kg"),
            text_to_int(F.col("rir_rpe")).alias("rir_rpe"),
            "tipo_metrica",
            F.col("dosis").alias("dosis_prescrita"),
            F.col("notas_ejercicio").alias("notas"),
            "mesociclo", F.coalesce(F.shiftright("id", BLOCK_BITS), F.lit(-1)).alias("_block"),
        )
    )


def block_sessions(sets: DataFrame, sesiones: DataFrame, dates: DataFrame) -> DataFrame:
    """The sessions of each block of sets: how many of its sets they have (``_sets``) and their date rows (``_dates``),
    one without a date if there are none. Ids alone move, one row per block, session and task."""
    dated = dated_sessions(sesiones, dates)
    return sets.groupBy("_block", "sesion_id").agg(F.count("*").alias("_sets")).join(
        dated, "sesion_id", "left").groupBy("_block", "sesion_id").agg(
        F.first("_sets").alias("_sets"), F.collect_list(F.struct("fecha_id", "fecha")).alias("_dates"))


def _dated(sets: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sets times the dates of their session. Both move to their block; there a session's row lies among its sets."""
    together = sets.unionByName(sessions.drop("_sets"), allowMissingColumns=True).repartition("_block")
    found = F.first("_dates", ignorenulls=True).over(Window.partitionBy("_block", "sesion_id"))
    return together.withColumn("_found", found).filter(F.col("_dates").isNull()).select(
        *sets.columns, F.inline("_found"))


def fact_rows(series: DataFrame, sesiones: DataFrame, exercises: DataFrame,
              dates: DataFrame, plans: DataFrame) -> DataFrame:
    """Sets linked to their dimensions, before numbering."""
    sets = linked_sets(series, exercises, plans)
    return _dated(sets, staged(block_sessions(sets, sesiones, dates), "block-sessions")).drop("_block")


def fact_series(series: DataFrame, sesiones: DataFrame, exercises: DataFrame,
                dates: DataFrame, plans: DataFrame) -> DataFrame:
    """The set-level fact, numbered in bronze id order.

    Duplicate date rows or plan labels multiply a set, as the joins say; the quality
    report counts such rows. Rows are numbered in blocks of bronze ids, so that they are written once,
    where the fact is published, and move once before, to their block, where dates and numbers meet them.
    """
    sets = linked_sets(series, exercises, plans)
    sessions = staged(block_sessions(sets, sesiones, dates), "block-sessions")
    sizes = sessions.groupBy("_block").agg(F.sum(F.col("_sets") * F.size("_dates")).alias("_rows"))
    return with_group_ids(
        _dated(sets, sessions), ["_block"], ["id", "fecha_id", "plan_id"], "serie_id", sizes=sizes
    ).drop("id", "_block").withColumn("repeticiones_ejecutadas", text_to_int(F.col("repeticiones_texto")))


def build_star(series: DataFrame, sesiones: DataFrame, first_non_null: bool = False) -> Star:
    exercises = dim_ejercicios(series, first_non_null)
    dates = dim_fecha(sesiones)
    plans = dim_plan(sesiones)
    return Star(fact_series(series, sesiones, exercises, dates, plans), exercises, dates, plans)


def _missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def verify_silver(star: Star) -> DataFrame:
    """Row counts, date range and numbers of unlinked or empty sets, in one row."""
    fact = star.fact.agg(
        F.count("*").alias("series"),
        _missing("ejercicio_id").alias("sin_ejercicio"),
        _missing("fecha_id").alias("sin_fecha"),
        _missing("plan_id").alias("sin_plan"),
        _missing("carga_kg").alias("sin_carga"),
        _missing("rir_rpe").alias("sin_rir"),
    )
    dates = star.dates.agg(
        F.count("*").alias("fechas"), F.min("fecha").alias("min_fecha"),
        F.max("fecha").alias("max_fecha"),
    )
    exercises = star.exercises.agg(F.count("*").alias("ejercicios"))
    plans = star.plans.agg(F.count("*").alias("planes"))
    # Four one-row aggregates side by side.
    return exercises.crossJoin(dates).crossJoin(plans).crossJoin(fact)
