"""Figures derived from the metrics: streaks, months, shares, trend, quartiles."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setlog.functions.calendar import month_label, year_month, year_week
from setlog.functions.casts import one_decimal
from setlog.functions.fixed import (
    MUSCLE_LABELS, NO_VALUE, OTHERS, OTHERS_SHARE, TOP_RECORDS, WEEKDAYS_FROM_SUNDAY,
)


def longest_streak(dates: DataFrame, rest_days: int | Column = 1,
                   by: tuple[str, ...] = ("athlete",)) -> DataFrame:
    """Longest run of training days in which neighbours are at most ``rest_days`` rest
    days apart. ``dates`` holds ``by`` and ``fecha``; groups with no date yield no row.
    """
    days = dates.filter(F.col("fecha").isNotNull()).select(*by, "fecha").distinct()
    in_order = Window.partitionBy(*by).orderBy("fecha")
    allowed = rest_days if isinstance(rest_days, Column) else F.lit(rest_days)
    gap = F.datediff("fecha", F.lag("fecha").over(in_order))
    runs = (
        days.withColumn("_break", F.coalesce((gap > allowed + 1).cast("int"), F.lit(0)))
        .withColumn("_run", F.sum("_break").over(in_order))
        .groupBy(*by, "_run")
        .agg(F.count("*").alias("racha"))
    )
    return runs.groupBy(*by).agg(F.max("racha").alias("racha"))


def for_all(rows: DataFrame, athletes: DataFrame) -> DataFrame:
    """``rows`` for every listed athlete; those without any have 0 and dashes."""
    listed = athletes.select("athlete").distinct().join(rows, "athlete", "left")
    kinds = dict(rows.dtypes)
    return listed.fillna({c: NO_VALUE if kinds[c] == "string" else 0
                          for c in rows.columns if c != "athlete"})


def longest_streaks(dates: DataFrame, up_to: int = 5,
                    by: tuple[str, ...] = ("athlete",)) -> DataFrame:
    """Longest streak for 1, 2, ... ``up_to`` rest days."""
    days = dates.select(*by, "fecha").distinct()
    choices = days.withColumn(
        "dias_descanso", F.explode(F.sequence(F.lit(1), F.lit(up_to))))
    return longest_streak(choices, F.col("dias_descanso"), (*by, "dias_descanso"))


def days_per_month(freq: DataFrame, drop_partial_first: bool = False) -> DataFrame:
    """Training days per calendar month.

    With ``drop_partial_first`` an athlete's first month goes if more than two months
    exist and training began after its first day.
    """
    months = freq.groupBy("athlete", "anio", "mes").agg(
        F.countDistinct("fecha").alias("dias"), F.min("fecha").alias("_first"))
    if drop_partial_first:
        mine = Window.partitionBy("athlete")
        in_order = mine.orderBy("anio", "mes")
        months = (
            months.withColumn("_months", F.count("*").over(mine))
            .withColumn("_start", F.min("_first").over(mine))
            .withColumn("_place", F.row_number().over(in_order))
            .filter(~((F.col("_place") == 1) & (F.col("_months") > 2)
                      & (F.dayofmonth("_start") > 1)))
        )
    return months.select(
        "athlete", "anio", "mes", year_month(F.col("anio"), F.col("mes")).alias("mes_label"),
        "dias",
    ).orderBy("athlete", "anio", "mes")


def best_worst_month(freq: DataFrame) -> DataFrame:
    """Months with the most and the fewest training days, the earlier one among equals.

    Athletes without a date have no row; ``for_all`` gives them one of dashes.
    """
    months = days_per_month(freq, drop_partial_first=True)
    when = F.struct("anio", "mes", "dias")
    place = F.col("anio") * 12 + F.col("mes")
    worst = F.min_by(when, F.struct(F.col("dias"), place))
    best = F.min_by(when, F.struct(-F.col("dias"), place))
    return months.groupBy("athlete").agg(worst.alias("w"), best.alias("b")).select(
        "athlete",
        month_label(F.col("w.anio"), F.col("w.mes")).alias("peor_mes"),
        F.col("w.dias").alias("peor_dias"),
        month_label(F.col("b.anio"), F.col("b.mes")).alias("mejor_mes"),
        F.col("b.dias").alias("mejor_dias"),
    )


def frequency_summary(freq: DataFrame, athletes: DataFrame, rest_days: int = 1) -> DataFrame:
    """The frequency figures of every listed athlete, dashes and zeros where none exist."""
    week = days_per_week(freq)
    return (
        athletes.select("athlete").distinct()
        .join(week, "athlete", "left")
        .join(longest_streak(freq, rest_days), "athlete", "left")
        .join(best_worst_month(freq), "athlete", "left")
        .fillna({"total_dias": 0, "dias_por_semana": 0.0, "racha": 0, "peor_mes": NO_VALUE,
                 "peor_dias": 0, "mejor_mes": NO_VALUE, "mejor_dias": 0})
    )


def days_per_week(freq: DataFrame) -> DataFrame:
    """Training days in all and mean per (calendar year, ISO week)."""
    weeks = freq.groupBy("athlete", "anio", "semana_anio").agg(
        F.countDistinct("fecha").alias("dias"))
    # A date has one week, so weekly distinct days add up to all distinct days.
    return weeks.groupBy("athlete").agg(
        F.sum("dias").alias("total_dias"), F.avg("dias").alias("dias_por_semana"))


def calendar_heatmap(freq: DataFrame) -> DataFrame:
    """Sets per week and weekday, Monday first, zero where a trained week lacks a weekday.

    Only weekdays that occur at all are shown. Cells that exist are grouped once; the
    missing ones come from each week's list of weekdays, at most seven long.
    """
    label = year_week(F.col("anio"), F.col("semana_anio"))
    from_monday = (F.col("dia_semana") + 6) % 7
    cells = freq.groupBy("athlete", label.alias("week_label"), from_monday.alias("orden")).agg(
        F.sum("series").alias("series"))
    weekdays = Window.partitionBy("athlete")
    mine = cells.withColumn("_shown", F.sort_array(F.collect_set("orden").over(weekdays)))
    weeks = mine.groupBy("athlete", "week_label", "_shown").agg(
        F.map_from_entries(F.collect_list(F.struct("orden", "series"))).alias("_filled"))
    names = F.array(*[F.lit(WEEKDAYS_FROM_SUNDAY[(i + 1) % 7]) for i in range(7)])
    return (
        weeks.select("athlete", "week_label", "_filled",
                     F.explode("_shown").alias("orden"))
        .select(
            "athlete", "orden",
            F.element_at(names, F.col("orden") + 1).alias("nombre_dia_semana"),
            "week_label",
            F.coalesce(F.try_element_at("_filled", F.col("orden")), F.lit(0)).alias("series"),
        )
        .orderBy("athlete", "orden", "week_label")
    )


def calendar_heatmap_wide(freq: DataFrame, weeks: list[str]) -> DataFrame:
    """The calendar with one column per listed week."""
    return (
        calendar_heatmap(freq).groupBy("athlete", "orden", "nombre_dia_semana")
        .pivot("week_label", weeks).agg(F.sum("series")).fillna(0)
        .orderBy("athlete", "orden")
    )


def share_with_others(df: DataFrame, threshold: float = OTHERS_SHARE) -> DataFrame:
    """Volume shares per group; groups under the threshold become one row of others.

    With no volume at all every share is zero and everything falls to the others.
    """
    total = F.sum("volumen").over(Window.partitionBy("athlete"))
    shares = df.select("athlete", "tipo_ejercicio", "volumen", total.alias("_total")).withColumn(
        "pct", F.when(F.col("_total") > 0, F.col("volumen") / F.col("_total")).otherwise(F.lit(0.0)))
    # A flag keeps a group that happens to be named like the bucket apart from it.
    small = F.col("pct") < threshold
    return (
        shares.withColumn("_small", small)
        .withColumn("tipo_ejercicio", F.when(small, F.lit(OTHERS)).otherwise(F.col("tipo_ejercicio")))
        .groupBy("athlete", "_small", "tipo_ejercicio")
        .agg(F.sum("volumen").alias("volumen"), F.sum("pct").alias("pct"))
        .orderBy("athlete", "_small", F.desc("volumen"), "tipo_ejercicio")
        .drop("_small")
    )


def load_trend(best_sets: DataFrame, by: tuple[str, ...] = ("athlete",)) -> DataFrame:
    """Least-squares line through the best sets of each group, over their running index.

    Groups of under three points, or under two with a load, have no line.
    """
    # The line's sums run over the same window as the index: one shuffle, one sort, no second pass.
    mine = Window.partitionBy(*by)
    return (
        best_sets.withColumn("indice", F.row_number().over(mine.orderBy("fecha", "mesociclo")) - 1)
        .withColumns({
            "_points": F.count("*").over(mine), "_loaded": F.count("carga_kg").over(mine),
            "pendiente": F.regr_slope("carga_kg", "indice").over(mine),
            "ordenada": F.regr_intercept("carga_kg", "indice").over(mine),
        })
        .filter("_points >= 3 and _loaded >= 2").drop("_points", "_loaded")
        .withColumn("tendencia", F.col("ordenada") + F.col("pendiente") * F.col("indice"))
    )


def top_records(records: DataFrame, n: int = TOP_RECORDS) -> DataFrame:
    """The heaviest ``n`` records per athlete, with the upward order of a bar chart."""
    heaviest = Window.partitionBy("athlete").orderBy(F.desc("Record (kg)"), "Ejercicio")
    top = records.withColumn("puesto", F.row_number().over(heaviest)).filter(F.col("puesto") <= n)
    upward = F.count("*").over(Window.partitionBy("athlete")) - F.col("puesto") + 1
    return top.withColumn("orden", upward).withColumn(
        "etiqueta", load_label(F.col("Record (kg)"))).orderBy("athlete", "orden")


def rir_quartiles(counts: DataFrame) -> DataFrame:
    """Box-plot figures of RIR per microcycle from value counts, quartiles interpolated."""
    quartiles = F.percentile("rir_rpe", [0.25, 0.5, 0.75], F.col("veces"))
    label = F.concat(F.col("mesociclo"), F.lit(" - Micro "),
                     F.col("numero_microciclo").cast("string"))
    return (
        counts.groupBy("athlete", "mesociclo", "numero_microciclo")
        .agg(F.min("rir_rpe").alias("minimo"), quartiles.alias("_q"),
             F.max("rir_rpe").alias("maximo"), F.sum("veces").alias("series"))
        .select("athlete", label.alias("micro_label"), "mesociclo", "minimo",
                F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("mediana"),
                F.col("_q")[2].alias("q3"), "maximo", "series")
        .orderBy("athlete", "mesociclo", "numero_microciclo")
    )


def rollup_summary(df: DataFrame, key: str) -> DataFrame:
    """Totals over muscle groups per week or mesocycle; reps where ``df`` has them."""
    totals = [F.sum("volumen").alias("volumen_total"), F.sum("series").alias("series_totales")]
    if key == "semana":
        totals.append(F.coalesce(F.sum("total_reps"), F.lit(0)).alias("reps_totales"))
    return df.groupBy("athlete", key).agg(*totals).orderBy("athlete", key)


def with_labels(df: DataFrame, labels: dict[str, str] = MUSCLE_LABELS) -> DataFrame:
    """Short group name beside each group; unknown groups keep their own."""
    pairs = [F.lit(text) for pair in labels.items() for text in pair]
    short = F.try_element_at(F.create_map(*pairs), F.col("tipo_ejercicio"))
    return df.withColumn("label", F.coalesce(short, F.col("tipo_ejercicio")))


def load_label(load: Column) -> Column:
    """'82.5 kg'."""
    return F.concat(one_decimal(load), F.lit(" kg"))


def set_label(number: Column) -> Column:
    return F.concat(F.lit("Serie "), number.cast("string"))


def kpi_labels(kpis: DataFrame) -> DataFrame:
    """Key figures as display texts."""
    return kpis.select(
        "athlete",
        F.format_number("total_series", 0).alias("total_series"),
        F.col("ejercicios").cast("string").alias("ejercicios"),
        F.when(F.col("max_carga") != 0, load_label(F.col("max_carga")))
        .otherwise(F.lit(NO_VALUE)).alias("max_carga"),
        F.col("dias").cast("string").alias("dias"),
    )


def group_detail(group_volume: DataFrame) -> DataFrame:
    """The detail table: short group names and display headings."""
    return with_labels(group_volume).select(
        "athlete", "label", "total_series", "volumen", "ejercicios_distintos", "carga_promedio",
    ).toDF("athlete", "Grupo", "Series", "Volumen", "Ejercicios", "Carga prom.")
