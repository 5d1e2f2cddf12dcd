"""Training metrics over the star, each for all athletes at once.

Sums by exercise attribute are taken by ``ejercicio_id`` first and get the attribute
afterwards: what meets the exercise dimension is a reduced table, so neither a large
dimension nor one popular exercise makes a heavy join.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setlog.functions.calendar import weekday, weekday_name, year_week
from setlog.plans.filters import Filters, of_exercise, sets
from setlog.plans.silver import Star


def _year() -> Column:
    return F.year("fecha").alias("anio")


def _week() -> Column:
    return F.weekofyear("fecha").alias("semana_anio")


def _volume() -> Column:
    """Sum of reps x kg, exact in decimals."""
    reps = F.coalesce(F.col("repeticiones_ejecutadas"), F.lit(0))
    load = F.coalesce(F.col("carga_kg"), F.lit(0))
    return F.sum(reps * load)


def _reps() -> Column:
    return F.sum(F.col("repeticiones_ejecutadas").cast("bigint"))


def _add(column: str) -> Column:
    """Second-level sum of a first-level sum, in the first level's type."""
    return F.sum(column).alias(column)


def _as_double(column: str) -> Column:
    return F.col(column).cast("double").alias(column)


def _typed(star: Star, by_exercise: DataFrame) -> DataFrame:
    """First-level sums with the muscle group; exercises without one drop out."""
    types = star.exercises.filter(F.col("tipo_ejercicio").isNotNull()).select(
        "ejercicio_id", "tipo_ejercicio")
    return by_exercise.join(types, "ejercicio_id")


def kpis(star: Star, filters: Filters = Filters()) -> DataFrame:
    """Sets, distinct exercises, top load and training days; zeros when nothing matches.

    One pass to (exercise, date) pairs, so the two distinct counts don't multiply the
    set-level rows.
    """
    pairs = (
        sets(star, filters, "exercise")
        .groupBy("athlete", "ejercicio_id", "fecha")
        .agg(F.count("*").alias("n"), F.max("carga_kg").alias("carga"))
    )
    found = pairs.groupBy("athlete").agg(
        F.sum("n").alias("n"),
        F.countDistinct("ejercicio_id").alias("e"),
        F.max("carga").alias("carga"),
        F.countDistinct("fecha").alias("d"),
    )
    athletes = star.exercises.select("athlete").distinct()
    return athletes.join(found, "athlete", "left").select(
        "athlete",
        F.coalesce("n", F.lit(0)).alias("total_series"),
        F.coalesce("e", F.lit(0)).alias("ejercicios"),
        F.col("carga").cast("double").alias("max_carga"),
        F.coalesce("d", F.lit(0)).alias("dias"),
    )


def weekly_volume(star: Star, filters: Filters = Filters()) -> DataFrame:
    """Volume and sets per calendar year and ISO week."""
    return (
        sets(star, filters, "exercise", "date")
        .groupBy("athlete", _year(), _week())
        .agg(_volume().alias("volumen"), F.count("*").alias("series"))
        .select(
            "athlete", year_week(F.col("anio"), F.col("semana_anio")).alias("semana"),
            "semana_anio", "anio", _as_double("volumen"), "series",
        )
        .orderBy("athlete", "anio", "semana_anio")
    )


def group_distribution(star: Star, filters: Filters = Filters()) -> DataFrame:
    """Sets and volume per muscle group, largest volume first."""
    by_exercise = sets(star, filters, "exercise").groupBy("athlete", "ejercicio_id").agg(
        F.count("*").alias("total_series"), _volume().alias("volumen"))
    return (
        _typed(star, by_exercise)
        .groupBy("athlete", "tipo_ejercicio")
        .agg(_add("total_series"), _add("volumen"))
        .withColumn("volumen", _as_double("volumen"))
        .orderBy("athlete", F.desc("volumen"), "tipo_ejercicio")
    )


def _loaded_sets_of(star: Star, exercise: str, filters: Filters) -> DataFrame:
    loaded = sets(star, filters, "exercise", "date").filter(F.col("carga_kg").isNotNull())
    return of_exercise(loaded, star, exercise)


def exercise_progress(star: Star, exercise: str, filters: Filters = Filters()) -> DataFrame:
    """All loaded sets of one exercise in date order."""
    return (
        _loaded_sets_of(star, exercise, filters)
        .select("athlete", "fecha", "numero_serie",
                F.col("repeticiones_ejecutadas").alias("reps"),
                _as_double("carga_kg"), "rir_rpe", "mesociclo", "serie_id")
        .orderBy("athlete", "fecha", "numero_serie", "serie_id")
        .drop("serie_id")
    )


def best_set_by_session(star: Star, exercise: str, filters: Filters = Filters()) -> DataFrame:
    """Top load and, independently, top reps per date and mesocycle."""
    return (
        _best_sets(_loaded_sets_of(star, exercise, filters), "athlete")
        .orderBy("athlete", "fecha", "mesociclo")
    )


def best_sets(star: Star, filters: Filters = Filters()) -> DataFrame:
    """Best sets of every exercise at once."""
    loaded = sets(star, filters, "exercise", "date").filter(F.col("carga_kg").isNotNull())
    return _best_sets(loaded, "athlete", "ejercicio_id")


def _best_sets(loaded: DataFrame, *by: str) -> DataFrame:
    return (
        loaded.groupBy(*by, "fecha", "mesociclo")
        .agg(F.max("carga_kg").alias("carga_kg"),
             F.max("repeticiones_ejecutadas").alias("reps"))
        .withColumn("carga_kg", _as_double("carga_kg"))
    )


def personal_records(star: Star, filters: Filters = Filters()) -> DataFrame:
    """The heaviest set of each exercise, the latest one among equals.

    Row-number-equals-one is limited per input partition before the shuffle, so a
    popular exercise sends one row per task. Names are joined to the winners only.
    """
    best_first = Window.partitionBy("ejercicio_id").orderBy(
        F.desc("carga_kg"), F.col("fecha").desc_nulls_last(), "serie_id")
    winners = (
        sets(star, filters, "exercise")
        .filter(F.col("carga_kg").isNotNull())
        .select("ejercicio_id", "carga_kg", "fecha", "serie_id",
                F.col("repeticiones_ejecutadas").alias("reps"))
        .withColumn("place", F.row_number().over(best_first))
        .filter("place = 1")
    )
    return winners.join(star.exercises, "ejercicio_id").select(
        "athlete",
        F.col("nombre_ejercicio").alias("Ejercicio"),
        F.col("tipo_ejercicio").alias("Grupo"),
        F.col("carga_kg").cast("double").alias("Record (kg)"),
        F.col("reps").alias("Reps"),
        F.col("fecha").alias("Fecha"),
    ).orderBy("athlete", F.desc("Record (kg)"), "Ejercicio")


def weekly_volume_by_group(star: Star, filters: Filters = Filters()) -> DataFrame:
    """Volume, sets and reps per week and muscle group."""
    by_exercise = (
        sets(star, filters, "exercise", "date")
        .groupBy("athlete", "ejercicio_id", _year(), _week())
        .agg(_volume().alias("volumen"), F.count("*").alias("series"), _reps().alias("total_reps"))
    )
    return (
        _typed(star, by_exercise)
        .groupBy("athlete", "anio", "semana_anio", "tipo_ejercicio")
        .agg(_add("volumen"), _add("series"), _add("total_reps"))
        .select(
            "athlete", year_week(F.col("anio"), F.col("semana_anio")).alias("semana"),
            "semana_anio", "anio", "tipo_ejercicio", _as_double("volumen"), "series",
            "total_reps",
        )
        .orderBy("athlete", "anio", "semana_anio", "tipo_ejercicio")
    )


def mesocycle_volume(star: Star, filters: Filters = Filters()) -> DataFrame:
    """Volume, sets and reps per mesocycle and muscle group."""
    by_exercise = (
        sets(star, filters, "exercise", "plan")
        .groupBy("athlete", "ejercicio_id", "mesociclo")
        .agg(_volume().alias("volumen"), F.count("*").alias("series"), _reps().alias("total_reps"))
    )
    return (
        _typed(star, by_exercise)
        .groupBy("athlete", "mesociclo", "tipo_ejercicio")
        .agg(_add("volumen"), _add("series"), _add("total_reps"))
        .withColumn("volumen", _as_double("volumen"))
        .orderBy("athlete", "mesociclo", "tipo_ejercicio")
    )


def intensity_by_session(star: Star, filters: Filters = Filters()) -> DataFrame:
    """Mean and lowest RIR per date and mesocycle."""
    return (
        sets(star, filters, "date")
        .filter(F.col("rir_rpe").isNotNull())
        .groupBy("athlete", "fecha", "mesociclo")
        .agg(F.avg("rir_rpe").alias("avg_rir"), F.min("rir_rpe").alias("min_rir"),
             F.count("*").alias("series"))
        .orderBy("athlete", "fecha", "mesociclo")
    )


def rir_by_microcycle(star: Star, filters: Filters = Filters()) -> DataFrame:
    """RIR of each set with its microcycle label."""
    plans = star.plans.select("plan_id", "numero_microciclo")
    label = F.concat(F.col("mesociclo"), F.lit(" - Micro "),
                     F.col("numero_microciclo").cast("string"))
    return (
        sets(star, filters, "plan")
        .filter(F.col("rir_rpe").isNotNull())
        .select("athlete", "plan_id", "mesociclo", "rir_rpe")
        .join(plans, "plan_id")
        .select("athlete", label.alias("micro_label"), "mesociclo", "numero_microciclo", "rir_rpe")
        .orderBy("athlete", "mesociclo", "numero_microciclo")
    )


def rir_counts(star: Star, filters: Filters = Filters()) -> DataFrame:
    """How often each RIR occurs per microcycle: all that quartiles need."""
    plans = star.plans.select("plan_id", "numero_microciclo")
    counted = (
        sets(star, filters, "plan")
        .filter(F.col("rir_rpe").isNotNull())
        .groupBy("athlete", "plan_id", "mesociclo", "rir_rpe")
        .agg(F.count("*").alias("veces"))
    )
    return (
        counted.join(plans, "plan_id")
        .groupBy("athlete", "mesociclo", "numero_microciclo", "rir_rpe")
        .agg(_add("veces"))
    )


def daily_frequency(star: Star, filters: Filters = Filters()) -> DataFrame:
    """Distinct sessions and sets per date with its calendar attributes."""
    day = F.col("fecha")
    return (
        sets(star, filters, "date")
        .groupBy("athlete", "fecha")
        .agg(F.countDistinct("sesion_id").alias("sesiones"), F.count("*").alias("series"))
        .select(
            "athlete", "fecha", weekday(day).alias("dia_semana"),
            weekday_name(day).alias("nombre_dia_semana"), _week(), _year(),
            F.month("fecha").alias("mes"), "sesiones", "series",
        )
        .orderBy("athlete", "fecha")
    )


def group_volume(star: Star, filters: Filters = Filters()) -> DataFrame:
    """Sets, volume, distinct exercises and mean load per muscle group."""
    by_exercise = (
        sets(star, filters, "exercise")
        .groupBy("athlete", "ejercicio_id")
        .agg(F.count("*").alias("total_series"), _volume().alias("volumen"),
             F.sum("carga_kg").alias("carga"), F.count("carga_kg").alias("con_carga"))
    )
    # An exercise has one group, so its rows here are the distinct exercises.
    mean = F.try_divide(F.sum("carga").cast("double"), F.sum("con_carga").cast("double"))
    return (
        _typed(star, by_exercise)
        .groupBy("athlete", "tipo_ejercicio")
        .agg(_add("total_series"), _add("volumen"),
             F.count("*").alias("ejercicios_distintos"),
             F.round(mean, 1).alias("carga_promedio"))
        .withColumn("volumen", _as_double("volumen"))
        .orderBy("athlete", F.desc("volumen"), "tipo_ejercicio")
    )


def group_sets_over_time(star: Star, filters: Filters = Filters()) -> DataFrame:
    """Sets per week and muscle group."""
    by_exercise = (
        sets(star, filters, "exercise", "date")
        .groupBy("athlete", "ejercicio_id", _year(), _week())
        .agg(F.count("*").alias("series"))
    )
    return (
        _typed(star, by_exercise)
        .groupBy("athlete", "anio", "semana_anio", "tipo_ejercicio")
        .agg(_add("series"))
        .select("athlete", year_week(F.col("anio"), F.col("semana_anio")).alias("semana"),
                "semana_anio", "anio", "tipo_ejercicio", "series")
        .orderBy("athlete", "anio", "semana_anio", "tipo_ejercicio")
    )
