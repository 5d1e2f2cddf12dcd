"""Named queries over a folder of order tables."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setlog.operators import grid
from setlog.operators.ids import append_with_ids, staged
from setlog.plans import analytics, bronze, filters, metrics, profile, silver
from setlog.plans.filters import Filters
from setlog.plans.reload import reload_sheets
from setlog.session import fresh_path
from setlog.sources import cells as cell_tables
from setlog.sources import order_tables, versions, workspace
from setlog.sources.silver_store import (
    clean_bronze, read_bronze, read_silver, verify_bronze, write_bronze, write_silver,
)
from setlog.streaming.snapshots import live_star, load_new

EXERCISE = "red widget"
WEEKS = ("1997-S01", "1997-S02", "1998-S30")
SOME = Filters(
    mesociclos=("1-URGENT", "2-HIGH"),
    tipos=("ECONOMY", "PROMO"),
    fecha_inicio=date(1997, 1, 1),
    fecha_fin=date(1999, 12, 31),
)


def _on_star(build):
    """A query on the published star, without the single athlete's key."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(workspace.star(spark, folder)).drop("athlete")
    return run


def _on_bronze(build):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(*workspace.bronze(spark, folder)).drop("athlete")
    return run


def _fact_series(sesiones: DataFrame, series: DataFrame) -> DataFrame:
    return silver.build_star(series, sesiones).fact.select(
        "serie_id", "sesion_id", "ejercicio_id", "fecha_id", "plan_id", "grupo_ejercicio",
        "numero_serie", "repeticiones_ejecutadas", "repeticiones_texto",
        F.col("carga_kg").cast("double").alias("carga_kg"), "rir_rpe", "tipo_metrica",
        "dosis_prescrita",
    )


def _silver_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The star written twice over; readers see the newer version only."""
    root = fresh_path(spark, "refresh")
    for _ in range(2):
        write_silver(workspace.star(spark, folder), root)
    return profile.counts(read_silver(spark, root))


def _streak_by_user(spark: SparkSession, folder: str) -> DataFrame:
    days = order_tables.table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("athlete"), F.col("ts").cast("date").alias("fecha"))
    return analytics.longest_streak(days)


def _dense_id(spark: SparkSession, folder: str) -> DataFrame:
    return order_tables.series(spark, folder).select(
        "id", "sesion_id", "numero_serie", "nombre_ejercicio")


def _display_labels(star) -> DataFrame:
    return metrics.exercise_progress(star, EXERCISE).select(
        "fecha", "mesociclo", analytics.set_label(F.col("numero_serie")).alias("serie_label"),
        analytics.load_label(F.col("carga_kg")).alias("carga_label"))


def _load_trend(star) -> DataFrame:
    trend = analytics.load_trend(metrics.best_sets(star), ("athlete", "ejercicio_id"))
    rounded = [F.round(c, 6).alias(c) for c in ("pendiente", "ordenada", "tendencia")]
    return trend.select("ejercicio_id", "fecha", "mesociclo", "carga_kg", "indice", *rounded)


def _share_by_exercise(star) -> DataFrame:
    """The small-share bucket over exercises, many of which are small."""
    by_name = star.fact.groupBy("athlete", "ejercicio_id").agg(metrics._volume().alias("volumen"))
    named = by_name.join(star.exercises.select("ejercicio_id", "nombre_ejercicio"), "ejercicio_id")
    shares = analytics.share_with_others(named.select(
        "athlete", F.col("nombre_ejercicio").alias("tipo_ejercicio"),
        F.col("volumen").cast("double").alias("volumen")))
    return shares.select("tipo_ejercicio", F.round("volumen", 2).alias("volumen"),
                         F.round("pct", 9).alias("pct"))


def _loads(spark: SparkSession, folder: str) -> str:
    """A store after two deliveries of training sheets: first everyone's; then new workbooks of one
    market segment, without their last sheet, beside outdated workbooks of the others."""
    def load() -> str:
        root = fresh_path(spark, "loads")
        landing, store = f"{root}/landing", f"{root}/store"
        cells = workspace.cells(spark, folder)

        def deliver(rows: DataFrame, name: str) -> None:
            rows.write.parquet(f"{landing}/{name}")
            load_new(spark, landing, store, f"{root}/checkpoint")

        deliver(cells, "first")
        segment = order_tables.table(spark, folder, "customer").filter(
            "c_mktsegment = 'BUILDING'").select(
                F.concat(F.lit("20240101atleta"), "c_custkey", F.lit(".xlsx")).alias("workbook"))
        redated = F.concat(F.lit("20240201"), F.substring("workbook", 9, 100))
        newer = cells.join(segment, "workbook", "left_semi").filter(
            F.col("sheet_name") != "Meso 5-LOW").withColumn("workbook", redated)
        outdated = cells.join(segment, "workbook", "left_anti").filter(
            F.col("sheet_name") == "Meso 1-URGENT").withColumn(
                "workbook", F.concat(F.lit("20231231"), F.substring("workbook", 9, 100)))
        deliver(newer.unionByName(outdated), "second")
        return store
    return workspace.once(spark, folder, "incremental", load)


def _incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.mesocycle_volume(live_star(spark, _loads(spark, folder)))


def _load_verification(spark: SparkSession, folder: str) -> DataFrame:
    """What was counted and compared while the first delivery was written."""
    return versions.checks(spark, _loads(spark, folder)).filter("version = 1").drop("version")


def _bronze_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of stored bronze tables before and after they are emptied."""
    root, out = fresh_path(spark, "clean"), []

    def counted(state: str) -> DataFrame:
        return verify_bronze(spark, root).filter("table like 'bronze%'").select(
            F.lit(state).alias("estado"), F.col("table").alias("tabla"), F.col("rows").alias("filas"))
    write_bronze(*workspace.bronze(spark, folder), root)
    out = staged(counted("antes"), "before-clean")
    clean_bronze(spark, root)
    return out.unionByName(counted("limpio"))


def _sheet_counts(series: DataFrame) -> DataFrame:
    return series.groupBy("athlete", "sheet_name").agg(
        F.count("*").alias("series"), F.countDistinct("id").alias("ids"),
        F.countDistinct("sesion_id").alias("sesiones"))


def _sheet_reload(spark: SparkSession, folder: str) -> DataFrame:
    """All sheets; then one priority's sheets twice, and another's emptied of sets."""
    def load() -> DataFrame:
        root = fresh_path(spark, "reload")
        cells = workspace.cells(spark, folder)
        reload_sheets(root, cells)
        again = cells.filter("sheet_name like 'Meso 2-HIGH%'")
        emptied = cells.filter("sheet_name like 'Meso 3-MEDIUM%' and row_idx = 0")
        reload_sheets(root, again)
        reload_sheets(root, again.unionByName(emptied))
        return _sheet_counts(read_bronze(spark, root)[1])
    return workspace.once(spark, folder, "reload", load)


def _position_load(cells: DataFrame) -> DataFrame:
    return _sheet_counts(bronze.extract_bronze(
        cells, choose=cell_tables.sheets_from_position).series)


def _streak_all(spark: SparkSession, folder: str) -> DataFrame:
    """Customers' longest runs of order days; 0 for those without an order."""
    orders = order_tables.table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("athlete"), F.col("o_orderdate").cast("date").alias("fecha"))
    customers = order_tables.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("athlete"))
    return analytics.for_all(analytics.longest_streak(orders, 60), customers)


def _on_cells(build):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(workspace.cells(spark, folder))
    return run


def _cells_scan(cells: DataFrame) -> DataFrame:
    return cells.groupBy("workbook", "sheet_name").agg(
        F.count("*").alias("celdas"), F.max("row_idx").alias("ultima_fila"),
        F.max("col_idx").alias("ultima_columna"))


def _sheet_filter(cells: DataFrame) -> DataFrame:
    def counted(chosen: DataFrame, rule: str) -> DataFrame:
        return chosen.groupBy("workbook", "sheet_name").agg(F.count("*").alias("n")).agg(
            F.count("*").alias("hojas"), F.sum("n").alias("celdas")).withColumn("regla", F.lit(rule))
    return counted(cell_tables.meso_sheets(cells), "nombre").unionByName(
        counted(cell_tables.sheets_from_position(cells), "posicion"))


def _latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    names = order_tables.table(spark, folder, "orders").select(F.concat(
        F.date_format("o_orderdate", "yyyyMMdd"), F.lit("atleta"), F.col("o_custkey"),
        F.lit(".xlsx")).alias("workbook"))
    return cell_tables.latest_snapshot(names)


def _sheet_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return workspace.sheet_bronze(spark, folder).sesiones.select(
        "athlete", "id", "sheet_name", "numero_dia", "nombre_dia", "microciclo",
        "numero_microciclo", "fecha", "hora", F.col("prs_pre_sesion").cast("double")
        .alias("prs_pre_sesion"), F.col("rpe_sesion").cast("double").alias("rpe_sesion"))


def _sheet_series(spark: SparkSession, folder: str) -> DataFrame:
    return workspace.sheet_bronze(spark, folder).series.select(
        "athlete", "id", "sesion_id", "sheet_name", "numero_dia", "microciclo",
        "numero_microciclo", "grupo_ejercicio", "tipo_ejercicio", "nombre_ejercicio",
        "url_ejercicio", "dosis", "numero_serie", "repeticiones", "carga_kg", "rir_rpe",
        "tipo_metrica")


def _session_link(sesiones: DataFrame, series: DataFrame) -> DataFrame:
    return bronze.link_sessions(series, sesiones).select("id", "sesion_id")


def _sheet_replace(sesiones: DataFrame, series: DataFrame) -> DataFrame:
    """One sheet read anew with other reps, one read anew and found empty."""
    rows = series.select("athlete", "id", "sheet_name", "repeticiones")
    new = rows.filter(F.col("sheet_name") == "1-URGENT").withColumn("repeticiones", F.lit("99"))
    read = series.sparkSession.createDataFrame(
        [(order_tables.ATHLETE, "1-URGENT"), (order_tables.ATHLETE, "2-HIGH")],
        "athlete string, sheet_name string")
    return bronze.replace_sheets(rows, new, read)


def _append_ids(spark: SparkSession, folder: str) -> DataFrame:
    old = workspace.bronze(spark, folder)[0].select("id", "sheet_name")
    new = order_tables.table(spark, folder, "customer").select(F.col("c_name").alias("sheet_name"))
    return append_with_ids(old, new, ["sheet_name"])


def _athletes(build):
    """A query on the star of all athletes' sheets."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(workspace.sheet_star(spark, folder))
    return run


def _freq(derive):
    return _on_star(lambda s: derive(metrics.daily_frequency(s)))


QUERIES = {
    # Sheets to bronze.
    "cells_scan": _on_cells(_cells_scan),
    "sheet_filter": _on_cells(_sheet_filter),
    "latest_snapshot": _latest_snapshot,
    "grid_days": _on_cells(lambda c: grid.detect_days(cell_tables.meso_sheets(c))),
    "grid_micros": _on_cells(lambda c: grid.detect_microcycles(cell_tables.meso_sheets(c))),
    "grid_labels": _on_cells(lambda c: grid.label_rows(cell_tables.meso_sheets(c))),
    "grid_cuts": _on_cells(lambda c: grid.grid_cuts(cell_tables.meso_sheets(c))),
    "grid_session_values": _on_cells(
        lambda c: grid.session_metadata(cell_tables.meso_sheets(c)).drop("day_row", "micro_col")),
    "grid_sessions": _sheet_sessions,
    "grid_series": _sheet_series,
    "sheet_rejects": lambda spark, folder: workspace.sheet_bronze(spark, folder).rejects,
    "session_link": _on_bronze(_session_link),
    "sheet_replace": _on_bronze(_sheet_replace),
    "append_ids": _append_ids,
    "incremental_load": _incremental_load,
    "load_verification": _load_verification,
    "sheet_reload": _sheet_reload,
    "bronze_clean": _bronze_clean,
    "position_load": _on_cells(_position_load),
    # All athletes' sheets to metrics.
    "athlete_kpis": _athletes(metrics.kpis),
    "athlete_weekly_volume": _athletes(metrics.weekly_volume),
    "athlete_records": _athletes(metrics.personal_records),
    "athlete_streaks": _athletes(
        lambda s: analytics.longest_streaks(metrics.daily_frequency(s))),
    "athlete_frequency": _athletes(lambda s: analytics.frequency_summary(
        metrics.daily_frequency(s), s.exercises)),
    # Star build.
    "dim_exercise": _on_bronze(lambda ses, ser: silver.dim_ejercicios(ser)),
    "dim_exercise_first_nonnull": _on_bronze(
        lambda ses, ser: silver.dim_ejercicios(ser, first_non_null=True)),
    "dim_date": _on_bronze(lambda ses, ser: silver.dim_fecha(ses)),
    "dim_plan": _on_bronze(lambda ses, ser: silver.dim_plan(ses)),
    "fact_series": _on_bronze(_fact_series),
    "silver_refresh": _silver_refresh,
    "verify_silver": _on_star(silver.verify_silver),
    "dense_id": _dense_id,
    # Filters and options.
    "filtered_kpis": _on_star(lambda s: metrics.kpis(s, SOME)),
    "filters_default_all": _on_star(lambda s: metrics.kpis(s, Filters.all(s))),
    "exercise_lookup": _on_star(
        lambda s: filters.exercise_lookup(s, EXERCISE).drop("fecha_carga")),
    "opt_mesociclos": _on_star(filters.mesociclos),
    "opt_ejercicios": _on_star(filters.ejercicios),
    "opt_tipos": _on_star(filters.tipos),
    "date_range": _on_star(filters.date_range),
    # Metrics.
    "kpis": _on_star(metrics.kpis),
    "weekly_volume": _on_star(lambda s: metrics.weekly_volume(s, SOME)),
    "weekly_volume_all": _on_star(metrics.weekly_volume),
    "group_distribution": _on_star(metrics.group_distribution),
    "exercise_progress": _on_star(lambda s: metrics.exercise_progress(s, EXERCISE)),
    "best_set_by_session": _on_star(lambda s: metrics.best_set_by_session(s, EXERCISE)),
    "personal_records": _on_star(metrics.personal_records),
    "weekly_volume_by_group": _on_star(metrics.weekly_volume_by_group),
    "mesocycle_volume": _on_star(metrics.mesocycle_volume),
    "intensity_by_session": _on_star(metrics.intensity_by_session),
    "rir_by_microcycle": _on_star(metrics.rir_by_microcycle),
    "daily_frequency": _on_star(metrics.daily_frequency),
    "group_volume": _on_star(metrics.group_volume),
    "group_sets_over_time": _on_star(metrics.group_sets_over_time),
    # Derived figures.
    "longest_streak": _freq(analytics.longest_streak),
    "longest_streak_n": _freq(analytics.longest_streaks),
    "streak_by_user": _streak_by_user,
    "streak_all_athletes": _streak_all,
    "days_per_month_full": _freq(lambda f: analytics.days_per_month(f, drop_partial_first=True)),
    "days_per_month": _freq(analytics.days_per_month),
    "best_worst_month": _freq(analytics.best_worst_month),
    "days_per_week_avg": _freq(analytics.days_per_week),
    "calendar_heatmap": _freq(analytics.calendar_heatmap),
    "calendar_wide": _freq(lambda f: analytics.calendar_heatmap_wide(f, list(WEEKS))),
    "describe_fact": lambda spark, folder: profile.describe(workspace.star(spark, folder).fact),
    "group_share_others": _on_star(
        lambda s: analytics.share_with_others(metrics.group_distribution(s))),
    "share_by_exercise": _on_star(_share_by_exercise),
    "load_trend": _on_star(_load_trend),
    "top_records": _on_star(lambda s: analytics.top_records(metrics.personal_records(s))),
    "rir_quartiles": _on_star(lambda s: analytics.rir_quartiles(metrics.rir_counts(s))),
    "weekly_summary": _on_star(
        lambda s: analytics.rollup_summary(metrics.weekly_volume_by_group(s), "semana")),
    "mesocycle_summary": _on_star(
        lambda s: analytics.rollup_summary(metrics.mesocycle_volume(s), "mesociclo")),
    "label_map": _on_star(lambda s: analytics.with_labels(metrics.group_distribution(s)).select(
        "tipo_ejercicio", "total_series", "label")),
    "display_labels": _on_star(_display_labels),
    "kpi_labels": _on_star(lambda s: analytics.kpi_labels(metrics.kpis(s))),
    "group_detail": _on_star(lambda s: analytics.group_detail(metrics.group_volume(s))),
    # Profiles.
    "profile_counts": _on_star(profile.counts),
    "first_exercises": _on_star(profile.first_exercises),
    "type_share": _on_star(profile.type_share),
    "url_coverage": _on_star(profile.url_coverage),
    "top_exercises": _on_star(profile.top_exercises),
    "dates_by_year": _on_star(profile.dates_by_year),
    "dates_by_month": _on_star(profile.dates_by_month),
    "dates_by_weekday": _on_star(profile.dates_by_weekday),
    "first_plans": _on_star(profile.first_plans),
    "plans_by_meso": _on_star(profile.plans_by_meso),
    "plans_by_day": _on_star(profile.plans_by_day),
    "first_sets": _on_star(profile.first_sets),
    "fact_stats": _on_star(profile.fact_stats),
    "block_stats": _on_star(profile.block_stats),
    "reps_distribution": _on_star(profile.reps_distribution),
    "rir_distribution": _on_star(profile.rir_distribution),
    "quality_report": _on_star(profile.quality_report),
    "quality_messages": _on_star(lambda s: profile.quality_messages(profile.quality_report(s))),
    "key_report": lambda spark, folder: profile.key_report(
        workspace.star(spark, folder), *workspace.bronze(spark, folder)),
    "progression_like": _on_star(lambda s: profile.progression_like(s, "%widget%")),
    "sets_by_weekday": _on_star(profile.sets_by_weekday),
    "bronze_stats": _on_bronze(lambda ses, ser: profile.bronze_stats(ser)),
    "sheet_summary": _on_bronze(lambda ses, ser: profile.sheet_summary(ses)),
    "load_totals": _on_bronze(profile.load_totals),
    "bronze_sessions": _on_bronze(lambda ses, ser: profile.bronze_sessions(ses).select(
        "id", "sheet_name", "numero_dia", "nombre_dia", "microciclo", "numero_microciclo",
        "fecha")),
    "bronze_listing": _on_bronze(lambda ses, ser: profile.bronze_listing(ser)),
    "bronze_links": _on_bronze(lambda ses, ser: profile.links(ser)),
}
