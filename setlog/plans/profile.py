"""Profiles and quality checks of the star and the bronze tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlog.functions.calendar import weekday, weekday_name
from setlog.functions.casts import percent
from setlog.plans.silver import Star


def describe(df: DataFrame) -> DataFrame:
    """Column names and types, in order."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema, 1)]
    return df.sparkSession.createDataFrame(
        rows, "posicion int, columna string, tipo string").orderBy("posicion")


def counts(star: Star) -> DataFrame:
    """Rows of the four tables, side by side."""
    one_row = [
        star.exercises.agg(F.count("*").alias("total_ejercicios")),
        star.dates.agg(F.count("*").alias("total_fechas")),
        star.plans.agg(F.count("*").alias("total_planes")),
        star.fact.agg(F.count("*").alias("total_series")),
    ]
    return one_row[0].crossJoin(one_row[1]).crossJoin(one_row[2]).crossJoin(one_row[3])


def first_exercises(star: Star, n: int = 10) -> DataFrame:
    return star.exercises.select(
        "ejercicio_id", "nombre_ejercicio", "tipo_ejercicio").orderBy("ejercicio_id").limit(n)


def _with_share(grouped: DataFrame) -> DataFrame:
    """Adds each row's percentage of all counted rows; the grouped input is small."""
    total = grouped.agg(F.sum("cantidad").alias("_total"))
    return grouped.crossJoin(total).withColumn(
        "porcentaje", percent(F.col("cantidad"), F.col("_total"))).drop("_total")


def type_share(star: Star) -> DataFrame:
    grouped = star.exercises.groupBy("tipo_ejercicio").agg(F.count("*").alias("cantidad"))
    return _with_share(grouped).orderBy(F.desc("cantidad"), F.col("tipo_ejercicio").asc_nulls_last())


def url_coverage(star: Star) -> DataFrame:
    return star.exercises.agg(
        F.count("url_video").alias("con_url"),
        F.count_if(F.col("url_video").isNull()).alias("sin_url"),
        F.count("*").alias("total"),
    )


def top_exercises(star: Star, n: int = 10) -> DataFrame:
    """The most performed exercises."""
    done = star.fact.groupBy("ejercicio_id").agg(F.count("*").alias("veces"))
    return (
        done.join(star.exercises, "ejercicio_id")
        .groupBy("nombre_ejercicio", "tipo_ejercicio")
        .agg(F.sum("veces").alias("veces_realizado"))
        .orderBy(F.desc("veces_realizado"), "nombre_ejercicio",
                 F.col("tipo_ejercicio").asc_nulls_last())
        .limit(n)
    )


def dates_by_year(star: Star) -> DataFrame:
    return star.dates.groupBy("anio").agg(
        F.count("*").alias("dias"), F.min("fecha").alias("primera_fecha"),
        F.max("fecha").alias("ultima_fecha"),
    ).orderBy("anio")


def dates_by_month(star: Star, n: int = 12) -> DataFrame:
    """The latest months with data."""
    return star.dates.groupBy("anio", "mes").agg(F.count("*").alias("dias")).orderBy(
        F.desc("anio"), F.desc("mes")).limit(n)


def dates_by_weekday(star: Star) -> DataFrame:
    grouped = star.dates.groupBy("dia_semana", "nombre_dia_semana").agg(
        F.count("*").alias("cantidad"))
    return _with_share(grouped).orderBy("dia_semana").drop("dia_semana")


def first_plans(star: Star, n: int = 10) -> DataFrame:
    return star.plans.select(
        "plan_id", "mesociclo", "numero_dia", "nombre_dia", "numero_microciclo",
    ).orderBy("mesociclo", "numero_dia", "numero_microciclo", "plan_id").limit(n)


def plans_by_meso(star: Star) -> DataFrame:
    return star.plans.groupBy("mesociclo").agg(
        F.countDistinct("numero_dia").alias("dias"),
        F.countDistinct("numero_microciclo").alias("microciclos"),
        F.count("*").alias("combinaciones"),
    ).orderBy("mesociclo")


def plans_by_day(star: Star) -> DataFrame:
    return star.plans.groupBy("numero_dia").agg(
        F.countDistinct("mesociclo").alias("en_mesociclos"),
        F.count("*").alias("total_combinaciones"),
    ).orderBy("numero_dia")


def first_sets(star: Star, n: int = 10) -> DataFrame:
    """The first sets; names are joined to those few only."""
    first = star.fact.select(
        "serie_id", "ejercicio_id", "numero_serie", "repeticiones_ejecutadas",
        F.col("carga_kg").cast("double").alias("carga_kg"), "rir_rpe",
    ).orderBy("serie_id").limit(n)
    names = star.exercises.select("ejercicio_id", "nombre_ejercicio")
    return first.join(names, "ejercicio_id", "left").select(
        "serie_id", "nombre_ejercicio", "numero_serie", "repeticiones_ejecutadas", "carga_kg",
        "rir_rpe",
    ).orderBy("serie_id")


def _mean(column: str) -> Column:
    """Mean to one decimal, from an exact sum."""
    total = F.sum(column).cast("double")
    return F.round(F.try_divide(total, F.count(column).cast("double")), 1)


def fact_stats(star: Star) -> DataFrame:
    """Totals, distincts and means. Each distinct count is an aggregate of its own, which
    removes repeats before the shuffle; together they would multiply every set."""
    sets = star.fact.agg(
        F.count("*").alias("total_series"),
        F.countDistinct("sesion_id").alias("sesiones_distintas"),
        _mean("repeticiones_ejecutadas").alias("promedio_reps"),
        _mean("carga_kg").alias("promedio_carga_kg"),
        _mean("rir_rpe").alias("promedio_rir"),
    )
    return sets.crossJoin(star.fact.agg(
        F.countDistinct("ejercicio_id").alias("ejercicios_distintos")))


def block_stats(star: Star) -> DataFrame:
    """Sets, distinct exercises and mean load per block letter."""
    return (
        star.fact.filter(F.col("grupo_ejercicio").isNotNull())
        .groupBy("grupo_ejercicio")
        .agg(F.count("*").alias("total_series"),
             F.countDistinct("ejercicio_id").alias("ejercicios_distintos"),
             _mean("carga_kg").alias("promedio_carga"))
        .orderBy("grupo_ejercicio")
    )


def _distribution(star: Star, column: str) -> DataFrame:
    grouped = star.fact.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("cantidad"))
    return _with_share(grouped).orderBy(column)


def reps_distribution(star: Star, n: int = 20) -> DataFrame:
    """The lowest rep counts with their share of all sets that have one."""
    return _distribution(star, "repeticiones_ejecutadas").limit(n)


def rir_distribution(star: Star) -> DataFrame:
    return _distribution(star, "rir_rpe")


def quality_report(star: Star) -> DataFrame:
    """Unlinked and empty sets and the share of fully linked ones."""
    def missing(column: str) -> Column:
        return F.count_if(F.col(column).isNull())

    linked = F.count_if(F.col("ejercicio_id").isNotNull() & F.col("fecha_id").isNotNull()
                        & F.col("plan_id").isNotNull())
    return star.fact.agg(
        F.count("*").alias("total_series"),
        missing("ejercicio_id").alias("sin_ejercicio_id"),
        missing("fecha_id").alias("sin_fecha_id"),
        missing("plan_id").alias("sin_plan_id"),
        missing("repeticiones_ejecutadas").alias("sin_reps"),
        missing("carga_kg").alias("sin_carga"),
        missing("rir_rpe").alias("sin_rir"),
        percent(linked, F.count("*")).alias("pct_completo"),
    )


def quality_messages(report: DataFrame) -> DataFrame:
    """Findings of the quality report as sentences, one per row."""
    def when(column: str, text: str) -> Column:
        return F.when(F.col(column) > 0, F.concat(F.col(column).cast("string"), F.lit(text)))

    share = F.concat(F.coalesce(F.format_string("%.1f", "pct_completo"), F.lit("0.0")),
                     F.lit(" % de las series con todas las claves"))
    findings = F.array(
        F.struct(F.lit(1).alias("orden"), when("sin_fecha_id", " series sin fecha").alias("mensaje")),
        F.struct(F.lit(2).alias("orden"), when("sin_plan_id", " series sin plan").alias("mensaje")),
        F.struct(F.lit(3).alias("orden"), share.alias("mensaje")),
    )
    return report.select(F.inline(findings)).filter(F.col("mensaje").isNotNull()).orderBy("orden")


def key_report(star: Star, sesiones: DataFrame, series: DataFrame) -> DataFrame:
    """Rows breaking a key: repeated primary keys, orphans, and sets multiplied by
    repeated dimension labels.

    Ids are counted in bitmaps of ranges of ids, which tasks build and only the bitmaps move: a bit per id
    instead of a row. Links are counted by id before they meet the ids they lead to, in a join by shuffle: a column of
    ids is small in its file and large in memory, so that none is ever sent through the driver.
    """
    def repeated_ids(df: DataFrame, name: str, key: str) -> DataFrame:
        ranges = df.groupBy(F.bitmap_bucket_number(key).alias("range")).agg(
            F.count("*").alias("n"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(key))).alias("ids"))
        # Rows without an id repeat the first of them.
        ids = F.when(F.col("range").isNull(), 1).otherwise(F.col("ids"))
        return ranges.agg(F.coalesce(F.sum(F.col("n") - ids), F.lit(0)).alias("filas")).select(
            F.lit(name).alias("control"), "filas")

    def repeated(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
        return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("filas")).select(
                F.lit(name).alias("control"), "filas")

    def orphans(df: DataFrame, name: str, column: str, dim: DataFrame, key: str) -> DataFrame:
        links = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        ids = dim.select(F.col(key).alias(column)).hint("merge")
        return links.join(ids, column, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("filas")).select(
            F.lit(name).alias("control"), "filas")

    checks = [
        repeated_ids(sesiones, "bronze_sesiones.id", "id"),
        repeated_ids(series, "bronze_series.id", "id"),
        repeated_ids(star.exercises, "dim_ejercicios.ejercicio_id", "ejercicio_id"),
        repeated_ids(star.dates, "dim_fecha.fecha_id", "fecha_id"),
        repeated(star.dates, "dim_fecha.fecha", ["athlete", "fecha"]),
        repeated_ids(star.plans, "dim_plan.plan_id", "plan_id"),
        repeated(star.plans, "dim_plan.sheet_dia_micro",
                 ["athlete", "sheet_name", "numero_dia", "numero_microciclo"]),
        repeated_ids(star.fact, "fact_series.serie_id", "serie_id"),
        orphans(series, "bronze_series.sesion_id", "sesion_id", sesiones, "id"),
        orphans(star.fact, "fact_series.ejercicio_id", "ejercicio_id", star.exercises, "ejercicio_id"),
        orphans(star.fact, "fact_series.fecha_id", "fecha_id", star.dates, "fecha_id"),
        orphans(star.fact, "fact_series.plan_id", "plan_id", star.plans, "plan_id"),
    ]
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report.orderBy("control")


def progression_like(star: Star, pattern: str, n: int = 20) -> DataFrame:
    """First dated sets of exercises whose name matches the pattern."""
    names = star.exercises.filter(F.col("nombre_ejercicio").like(pattern)).select(
        "ejercicio_id", "nombre_ejercicio")
    return (
        star.fact.filter(F.col("fecha_id").isNotNull())
        .join(names, "ejercicio_id")
        .select("fecha_id", "fecha", "nombre_ejercicio", "numero_serie",
                "repeticiones_ejecutadas", F.col("carga_kg").cast("double").alias("carga_kg"),
                "rir_rpe", "serie_id")
        .orderBy("fecha", "numero_serie", "serie_id")
        .limit(n)
        .drop("serie_id")
    )


def sets_by_weekday(star: Star) -> DataFrame:
    """Sets, distinct sessions and mean load per weekday."""
    return (
        star.fact.filter(F.col("fecha_id").isNotNull())
        .groupBy(weekday(F.col("fecha")).alias("dia_semana"),
                 weekday_name(F.col("fecha")).alias("nombre_dia_semana"))
        .agg(F.count("*").alias("total_series"), F.countDistinct("sesion_id").alias("sesiones"),
             _mean("carga_kg").alias("promedio_carga"))
        .orderBy("dia_semana").drop("dia_semana")
    )


def bronze_stats(series: DataFrame) -> DataFrame:
    """Sessions, sets and distinct names; the two distinct counts apart, as in fact_stats."""
    sets = series.agg(F.countDistinct("sesion_id").alias("total_sesiones"),
                      F.count("*").alias("total_series"))
    return sets.crossJoin(series.agg(
        F.countDistinct("nombre_ejercicio").alias("ejercicios_unicos")))


def sheet_summary(sesiones: DataFrame) -> DataFrame:
    """Sessions, days and microcycles per sheet. Session ids are unique, so they are
    counted without a distinct and the rest reads (day, microcycle) pairs."""
    return (
        sesiones.groupBy("athlete", "sheet_name", "numero_dia", "numero_microciclo")
        .agg(F.count("*").alias("n"))
        .groupBy("athlete", "sheet_name")
        .agg(F.sum("n").alias("sesiones"), F.countDistinct("numero_dia").alias("dias"),
             F.countDistinct("numero_microciclo").alias("microciclos"))
        .orderBy("athlete", "sheet_name")
    )


def load_totals(sesiones: DataFrame, series: DataFrame) -> DataFrame:
    """Grand totals over sessions left-joined to their sets; a session without sets counts one row.

    Sets are read once and reduced to (session, name) before the join, and to (sheet, name) after it: from
    those few rows come the rows, sheets and names. Session ids are counted in bitmaps of id
    ranges, as in key_report.
    """
    named = series.groupBy(F.col("sesion_id").alias("id"), "nombre_ejercicio").agg(F.count("*").alias("n"))
    pairs = sesiones.select("id", "sheet_name").join(named, "id", "left").groupBy(
        "sheet_name", "nombre_ejercicio").agg(F.sum(F.coalesce("n", F.lit(1))).alias("n"))
    totals = pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_series"),
        F.countDistinct("sheet_name").alias("hojas_procesadas"),
        F.countDistinct("nombre_ejercicio").alias("ejercicios_unicos"),
    )
    return _distinct_ids(sesiones, "id").select(F.col("ids").alias("total_sesiones")).crossJoin(totals)


def _distinct_ids(df: DataFrame, key: str) -> DataFrame:
    """``ids``: distinct values of a numeric key, nulls aside."""
    return df.filter(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(key)).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(key))).alias("ids")).agg(
        F.coalesce(F.sum("ids"), F.lit(0)).alias("ids"))


def bronze_sessions(sesiones: DataFrame) -> DataFrame:
    return sesiones.orderBy("numero_dia", "numero_microciclo", "id")


def bronze_listing(series: DataFrame, n: int = 20) -> DataFrame:
    """The first sets by day and microcycle."""
    return series.select(
        "id", "sesion_id", "numero_dia", "numero_microciclo", "nombre_ejercicio", "numero_serie",
        "repeticiones", "carga_kg", "rir_rpe",
    ).orderBy("numero_dia", "numero_microciclo", "id").limit(n)


def links(series: DataFrame) -> DataFrame:
    """The link column of every set."""
    return series.select("url_ejercicio")


def profile(star: Star, pattern: str = "%") -> dict[str, DataFrame]:
    """All profiles of a star, by name, none of them run yet."""
    return {
        "counts": counts(star), "first_exercises": first_exercises(star),
        "type_share": type_share(star), "url_coverage": url_coverage(star),
        "top_exercises": top_exercises(star), "dates_by_year": dates_by_year(star),
        "dates_by_month": dates_by_month(star), "dates_by_weekday": dates_by_weekday(star),
        "first_plans": first_plans(star), "plans_by_meso": plans_by_meso(star),
        "plans_by_day": plans_by_day(star), "first_sets": first_sets(star),
        "fact_stats": fact_stats(star), "block_stats": block_stats(star),
        "reps_distribution": reps_distribution(star), "rir_distribution": rir_distribution(star),
        "quality_report": quality_report(star),
        "quality_messages": quality_messages(quality_report(star)),
        "progression": progression_like(star, pattern), "sets_by_weekday": sets_by_weekday(star),
        **{f"describe_{name}": describe(df) for name, df in star.tables().items()},
    }
