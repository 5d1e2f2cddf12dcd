"""Filters, metrics and derived figures on small stars."""

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from setlog.plans import analytics, filters, metrics, profile
from setlog.plans.filters import Filters
from setlog.plans.silver import Star
from setlog.schemas import DIM_EJERCICIOS, DIM_FECHA, DIM_PLAN, FACT_SERIES
from setlog.sources.versions import conform
from tests.conftest import as_rows

SETS = [
    # athlete, exercise, type, date, meso, micro, session, load, reps, rir
    ("Ana", "Press", "Empuje", date(2024, 1, 1), "Meso 1", 1, 1, 60.25, 8, 2),
    ("Ana", "Press", "Empuje", date(2024, 1, 3), "Meso 1", 2, 2, 62.5, None, 1),
    ("Ana", "Press", "Empuje", date(2024, 1, 8), "Meso 2", 1, 3, 62.5, 6, None),
    ("Ana", "D'Artagnan", None, None, "Meso 2", 1, 4, 20.0, 10, 3),
    ("Ana", "Remo", "Tracción", date(2024, 12, 30), None, None, 5, None, 12, 0),
    ("Eva", "Press", "Tracción", date(2024, 1, 1), "Meso 1", 1, 6, 40.0, 5, 4),
]


@pytest.fixture(scope="module")
def star(spark):
    names = sorted({(a, e, t) for a, e, t, *_ in SETS}, key=lambda r: r[:2])
    days = sorted({(r[0], r[3]) for r in SETS if r[3]})
    plans = sorted({(r[0], r[4], r[5]) for r in SETS if r[4]})
    fact = [
        (r[0], i, r[6], names.index(r[:3]) + 1,
         days.index((r[0], r[3])) + 1 if r[3] else None,
         plans.index((r[0], r[4], r[5])) + 1 if r[4] else None, r[8], r[7], r[9], r[3], r[4])
        for i, r in enumerate(SETS, 1)]
    df = spark.createDataFrame(
        fact, "athlete string, serie_id bigint, sesion_id bigint, ejercicio_id bigint, fecha_id bigint,"
        " plan_id bigint, repeticiones_ejecutadas int, carga_kg double, rir_rpe int, fecha date,"
        " mesociclo string")
    exercises = spark.createDataFrame(
        [(a, i, e, t) for i, (a, e, t) in enumerate(names, 1)],
        "athlete string, ejercicio_id bigint, nombre_ejercicio string, tipo_ejercicio string")
    dates = spark.createDataFrame([(a, i, d) for i, (a, d) in enumerate(days, 1)],
                                  "athlete string, fecha_id bigint, fecha date")
    plan = spark.createDataFrame(
        [(a, i, m, m, n) for i, (a, m, n) in enumerate(plans, 1)],
        "athlete string, plan_id bigint, sheet_name string, mesociclo string, numero_microciclo int")
    return Star(conform(df, FACT_SERIES), conform(exercises, DIM_EJERCICIOS),
                conform(dates, DIM_FECHA), conform(plan, DIM_PLAN))


def of(df, athlete, *columns):
    return as_rows(df.filter(F.col("athlete") == athlete), *columns)


def test_empty_filter_keeps_rows_without_dimensions(star):
    assert of(metrics.kpis(star), "Ana") == [("Ana", 5, 3, 62.5, 4)][:1]
    assert of(metrics.kpis(star, Filters.all(star)), "Ana") == [("Ana", 3, 1, 62.5, 3)]


def test_no_match_gives_zeros(star):
    nothing = Filters(ejercicios=("Sentadilla",))
    assert of(metrics.kpis(star, nothing), "Ana") == [("Ana", 0, 0, None, 0)]
    assert as_rows(analytics.kpi_labels(metrics.kpis(star, nothing)), "max_carga")[0] == ("—",)


def test_every_filter_field(star):
    def count(**fields):
        return sum(r[0] for r in as_rows(metrics.kpis(star, Filters(**fields)), "total_series"))
    assert count(mesociclos=("Meso 2",)) == 2
    assert count(ejercicios=("D'Artagnan",)) == 1
    assert count(tipos=("Empuje",)) == 3
    assert count(fecha_inicio=date(2024, 1, 3)) == 3
    assert count(fecha_fin=date(2024, 1, 3)) == 3
    assert count(mesociclos=("Meso 1",), tipos=("Tracción",), fecha_fin=date(2024, 1, 1)) == 1


def test_choosing_all_of_nothing_does_not_restrict(star):
    bare = Star(star.fact.withColumn("fecha", F.lit(None).cast("date")), star.exercises,
                star.dates.limit(0), star.plans)
    assert "fecha" not in Filters.all(bare).every


def test_all_is_within_none(star):
    everything = {r for r in as_rows(filters.sets(star, Filters()), "serie_id")}
    assert {r for r in as_rows(filters.sets(star, Filters.all(star)), "serie_id")} <= everything


def test_quote_in_a_name(star):
    assert filters.exercise_lookup(star, "D'Artagnan").count() == 1
    assert of(metrics.exercise_progress(star, "D'Artagnan"), "Ana") == []


def test_athletes_together_are_athletes_apart(star):
    for metric in (metrics.kpis, metrics.weekly_volume, metrics.group_distribution,
                   metrics.personal_records, metrics.weekly_volume_by_group,
                   metrics.mesocycle_volume, metrics.intensity_by_session,
                   metrics.rir_by_microcycle, metrics.daily_frequency, metrics.group_volume,
                   metrics.group_sets_over_time, metrics.rir_counts):
        together = metric(star)
        for athlete in ("Ana", "Eva"):
            def mine(df):
                return df.filter(F.col("athlete") == athlete)
            alone = metric(Star(mine(star.fact), mine(star.exercises), mine(star.dates),
                                mine(star.plans)))
            assert sorted(of(together, athlete), key=repr) == sorted(as_rows(alone), key=repr)


def test_week_label_keeps_the_calendar_year(star):
    assert ("2024-S01", 60.25 * 8, 3) in [
        (r[1], r[4], r[5]) for r in of(metrics.weekly_volume(star), "Ana")]


def test_record_is_the_latest_of_the_heaviest(star):
    press = [r for r in of(metrics.personal_records(star), "Ana") if r[1] == "Press"]
    assert press == [("Ana", "Press", "Empuje", 62.5, 6, date(2024, 1, 8))]
    top = analytics.top_records(metrics.personal_records(star), 1)
    assert of(top, "Ana", "Ejercicio", "puesto", "orden", "etiqueta") == [("Press", 1, 1, "62.5 kg")]


def test_same_exercise_name_keeps_to_its_athlete(star):
    assert of(metrics.group_distribution(star), "Eva") == [("Eva", "Tracción", 1, 200.0)]


def days_of(spark, *days, athlete="Ana"):
    return spark.createDataFrame([(athlete, d) for d in days], "athlete string, fecha date")


def frequency(spark, *days):
    return days_of(spark, *days).select(
        "athlete", "fecha", F.year("fecha").alias("anio"), F.month("fecha").alias("mes"),
        F.weekofyear("fecha").alias("semana_anio"), (F.dayofweek("fecha") - 1).alias("dia_semana"),
        F.lit(2).alias("series"))


def loop_streak(days, rest):
    best = run = 0
    for i, day in enumerate(sorted(set(days))):
        run = run + 1 if i and (day - previous).days <= rest + 1 else 1
        best, previous = max(best, run), day
    return best


def test_streak_example(spark):
    days = [date(2024, 1, n) for n in (1, 3, 6, 7, 9)]
    assert as_rows(analytics.longest_streak(days_of(spark, *days)), "racha") == [(3,)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 120), min_size=1, max_size=40))
def test_streaks_are_those_of_a_loop(spark, offsets):
    days = [date(2024, 1, 1) + timedelta(n) for n in offsets]
    found = dict(as_rows(analytics.longest_streaks(days_of(spark, *days)), "dias_descanso", "racha"))
    assert found == {rest: loop_streak(days, rest) for rest in range(1, 6)}


def test_partial_first_month(spark):
    three = frequency(spark, date(2024, 1, 5), date(2024, 2, 1), date(2024, 3, 1))
    two = frequency(spark, date(2024, 1, 5), date(2024, 2, 1))
    from_first = frequency(spark, date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1))
    assert [r[2] for r in as_rows(analytics.days_per_month(three, True))] == [2, 3]
    assert [r[2] for r in as_rows(analytics.days_per_month(three))] == [1, 2, 3]
    assert [r[2] for r in as_rows(analytics.days_per_month(two, True))] == [1, 2]
    assert [r[2] for r in as_rows(analytics.days_per_month(from_first, True))] == [1, 2, 3]


def test_month_ties_go_to_the_earlier(spark):
    freq = frequency(spark, date(2024, 1, 1), date(2024, 2, 1))
    assert as_rows(analytics.best_worst_month(freq)) == [
        ("Ana", "Enero 2024", 1, "Enero 2024", 1)]
    athletes = spark.createDataFrame([("Ana",), ("Eva",)], "athlete string")
    summary = analytics.frequency_summary(freq, athletes)
    assert of(summary, "Eva") == [("Eva", 0, 0.0, 0, "—", 0, "—", 0)]


def test_heatmap_fills_missing_weekdays(spark):
    freq = frequency(spark, date(2024, 1, 1), date(2024, 1, 3), date(2024, 1, 8))
    assert as_rows(analytics.calendar_heatmap(freq), "nombre_dia_semana", "week_label", "series") == [
        ("Lunes", "2024-S01", 2), ("Lunes", "2024-S02", 2),
        ("Miércoles", "2024-S01", 2), ("Miércoles", "2024-S02", 0)]
    wide = analytics.calendar_heatmap_wide(freq, ["2024-S01", "2024-S02"])
    assert as_rows(wide, "nombre_dia_semana", "2024-S01", "2024-S02") == [
        ("Lunes", 2, 2), ("Miércoles", 2, 0)]


def shares(spark, *rows):
    df = spark.createDataFrame([("Ana", t, float(v)) for t, v in rows],
                               "athlete string, tipo_ejercicio string, volumen double")
    return as_rows(analytics.share_with_others(df), "tipo_ejercicio", "volumen", "pct")


def test_small_shares_become_others(spark):
    assert shares(spark, ("A", 97), ("B", 2), ("C", 1)) == [("A", 97, 0.97), ("B", 2, 0.02), ("Otros", 1, 0.01)]
    assert shares(spark, ("A", 0), ("B", 0)) == [("Otros", 0, 0)]
    assert shares(spark, ("Otros", 99), ("B", 1)) == [("Otros", 99, 0.99), ("Otros", 1, 0.01)]


def test_trend(spark):
    def line(*loads):
        rows = [("Ana", date(2024, 1, 1 + i), "Meso 1", v) for i, v in enumerate(loads)]
        best = spark.createDataFrame(rows, "athlete string, fecha date, mesociclo string, carga_kg double")
        return [(round(a, 9), round(b, 9), i, round(t, 9)) for a, b, i, t in as_rows(
            analytics.load_trend(best).orderBy("indice"), "pendiente", "ordenada", "indice", "tendencia")]
    assert line(1.0, 2.0, 4.0, 8.0) == [(2.3, 0.3, i, round(0.3 + 2.3 * i, 9)) for i in range(4)]
    assert line(1.0, 2.0) == []
    assert line(1.0, None, None) == []


def test_labels(spark):
    df = spark.createDataFrame([("Abs",), ("Yoga",), (None,)], "tipo_ejercicio string")
    assert as_rows(analytics.with_labels(df), "label") == [("Abdominales",), ("Yoga",), (None,)]


def test_profiles_run(star):
    found = profile.profile(star, "%ress%")
    assert as_rows(found["counts"]) == [(4, 5, 4, 6)]
    assert as_rows(found["quality_report"], "total_series", "sin_fecha_id", "sin_plan_id",
                   "pct_completo") == [(6, 1, 1, 66.7)]
    assert as_rows(found["quality_messages"], "mensaje") == [
        ("1 series sin fecha",), ("1 series sin plan",), ("66.7 % de las series con todas las claves",)]
    assert as_rows(found["progression"], "numero_serie").__len__() == 4


def test_no_sets_no_division_error(star):
    empty = Star(star.fact.limit(0), star.exercises.limit(0), star.dates.limit(0), star.plans.limit(0))
    for df in profile.profile(empty).values():
        df.collect()
    assert as_rows(profile.quality_report(empty), "total_series", "pct_completo") == [(0, None)]


def test_date_filter_and_mesocycle_reach_the_scan(spark, star, tmp_path, capsys):
    star.fact.write.partitionBy("mesociclo").parquet(str(tmp_path / "fact"))
    fact = spark.read.schema(FACT_SERIES).parquet(str(tmp_path / "fact"))
    stored = Star(fact, star.exercises, star.dates, star.plans)
    some = Filters(mesociclos=("Meso 1",), fecha_inicio=date(2024, 1, 1))
    metrics.weekly_volume(stored, some).explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    pruned = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "GreaterThanOrEqual(fecha" in pushed and "Meso 1" in pruned
    assert "dosis_prescrita" not in read and "repeticiones_texto" not in read
    assert "Join" not in plan
