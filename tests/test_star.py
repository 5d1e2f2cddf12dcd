"""Star build, ids, casts and quality checks."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from setlog.functions.casts import clock_text, one_decimal, text_to_int, text_to_load
from setlog.operators.ids import append_with_ids, with_dense_id, with_group_ids
from setlog.operators import ids
from setlog.plans import filters, metrics, profile, silver
from setlog.plans.bronze import replace_sheets
from setlog.schemas import BRONZE_SERIES, BRONZE_SESIONES
from setlog.sources.silver_store import (
    clean_bronze, read_bronze, read_silver, write_bronze, write_silver,
)
from setlog.sources.catalog import require_tables
from setlog.sources.versions import VersionTaken, commit, conform, next_version, versions, write_tables
from tests.conftest import as_rows


def series(spark, *rows):
    """(id, name, type, url) and optional further columns by name."""
    full = []
    for row in rows:
        extra = row[4] if len(row) > 4 else {}
        full.append({"athlete": "Ana", "id": row[0], "sesion_id": 1, "sheet_name": "Meso 1",
                     "numero_dia": 1, "numero_microciclo": 1, "nombre_ejercicio": row[1],
                     "tipo_ejercicio": row[2], "url_ejercicio": row[3], "repeticiones": "8",
                     "carga_kg": "50", "rir_rpe": "2", "numero_serie": 1, **extra})
    columns = [f.name for f in BRONZE_SERIES]
    return spark.createDataFrame([[r.get(c) for c in columns] for r in full], BRONZE_SERIES)


def sesiones(spark, *rows):
    """(id, microcycle label, date)."""
    full = [{"athlete": "Ana", "id": i, "sheet_name": "Meso 1", "numero_dia": 1, "nombre_dia": "DÍA 1",
             "microciclo": micro, "numero_microciclo": 1, "fecha": moment} for i, micro, moment in rows]
    columns = [f.name for f in BRONZE_SESIONES]
    return spark.createDataFrame([[r.get(c) for c in columns] for r in full], BRONZE_SESIONES)


def test_exercise_row_is_that_of_the_lowest_id_nulls_included(spark):
    rows = series(spark, (1, " Press", None, "u1"), (2, "Press ", "x", None), (3, "Press", "y", "u3"),
                  (4, "nan", "z", None), (5, "  ", "z", None), (6, None, "z", None))
    assert as_rows(silver.dim_ejercicios(rows), "ejercicio_id", "nombre_ejercicio", "tipo_ejercicio",
                   "url_video") == [(1, "Press", None, "u1")]
    assert as_rows(silver.dim_ejercicios(rows, first_non_null=True), "tipo_ejercicio",
                   "url_video") == [("x", "u1")]


def test_time_of_day_has_a_date_row_but_no_link(spark):
    ses = sesiones(spark, (1, "M 1", datetime(2024, 1, 1, 10)))
    star = silver.build_star(series(spark, (1, "Press", "x", None)), ses)
    assert as_rows(star.dates, "fecha_id", "fecha") == [(1, date(2024, 1, 1))]
    assert as_rows(star.fact, "fecha_id", "fecha") == [(None, None)]


def test_two_times_on_a_day_and_two_labels_multiply_sets(spark):
    ses = sesiones(spark, (1, "M 1", datetime(2024, 1, 1)), (2, "M 1", datetime(2024, 1, 1, 10)))
    ser = series(spark, (1, "Press", "x", None))
    assert as_rows(silver.build_star(ser, ses).fact.orderBy("serie_id"), "serie_id", "fecha_id") == [
        (1, 1), (2, 2)]
    labels = sesiones(spark, (1, "M 1", datetime(2024, 1, 1)), (2, "MM 1", datetime(2024, 1, 2)))
    star = silver.build_star(ser, labels)
    assert sorted(as_rows(star.fact, "plan_id")) == [(1,), (2,)]
    report = dict(as_rows(profile.key_report(star, labels, ser)))
    assert report["dim_plan.sheet_dia_micro"] == 1
    assert sum(report.values()) == 1


def test_ids_are_not_broadcast_to_find_orphans(spark, tmp_path, capsys):
    # Stored tables of few bytes, which Spark takes for small ones.
    ses = sesiones(spark, (1, "M 1", datetime(2024, 1, 1)), (2, "M 1", None))
    ser = series(spark, *((k, "Press", "x", None, {"sesion_id": s}) for k, s in enumerate((1, 1, 2, 7, 7, 8, None), 1)))
    write_bronze(ses, ser, str(tmp_path / "b"))
    stored = read_bronze(spark, str(tmp_path / "b"))
    write_silver(silver.build_star(*reversed(stored)), str(tmp_path / "s"))
    report = profile.key_report(read_silver(spark, str(tmp_path / "s")), *stored)
    assert {name: n for name, n in as_rows(report) if n} == {"bronze_series.sesion_id": 3}
    assert dict(as_rows(report.select("control", F.typeof("filas"))))["bronze_series.sesion_id"] == "bigint"
    report.explain()
    assert "Broadcast" not in capsys.readouterr().out


def test_date_attributes_at_the_year_edge(spark):
    star_dates = silver.dim_fecha(sesiones(spark, (1, "M 1", datetime(2024, 12, 30))))
    assert as_rows(star_dates, "anio", "mes", "dia", "dia_semana", "nombre_dia_semana",
                   "semana_anio") == [(2024, 12, 30, 1, "Lunes", 1)]


def test_text_casts(spark):
    texts = ["8", "8.0", "7.5", "-8.5", ".5", "8.", "+8", "1e1", "8d", "12-10", "8,5", "x", "",
             "2147483648", " 9 ", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    ints = [r[0] for r in as_rows(df.orderBy("i"), text_to_int(F.col("t")))]
    assert ints == [8, 8, 8, -9, 1, 8, 8, 10, None, None, None, None, None, None, 9, None]
    loads = spark.createDataFrame([("82.125",), ("10000",), ("PC",)], "t string")
    assert [r[0] for r in as_rows(loads, text_to_load(F.col("t")))] == [Decimal("82.13"), None, None]


def test_clock_text(spark):
    df = spark.createDataFrame([("7:05",), ("18:30:00",), ("25:00",), ("a",)], "t string")
    assert [r[0] for r in as_rows(df, clock_text(F.col("t")))] == ["07:05:00", "18:30:00", None, None]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10000, 999999).map(lambda n: n / 100), min_size=1, max_size=400))
def test_one_decimal_is_the_c_format(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    expected = [f"{v:.1f}" for v in values]
    found = [r[0] for r in as_rows(df, one_decimal(F.col("v")))]
    assert [f.replace("-0.0", "0.0") for f in found] == [e.replace("-0.0", "0.0") for e in expected]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.text("ab", max_size=2)), max_size=60, unique=True))
def test_dense_id_is_the_global_row_number(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    wanted = df.withColumn("id", F.row_number().over(Window.orderBy("a", "b")))
    assert sorted(as_rows(with_dense_id(df, ["a", "b"]), "a", "b", "id")) == sorted(
        as_rows(wanted, "a", "b", "id"))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), st.text("ab", max_size=2), st.integers(0, 5)), max_size=90, unique=True))
def test_ids_by_groups_are_the_global_row_number(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(5)
    wanted = df.withColumn("id", F.row_number().over(Window.orderBy("a", "b", "c")))
    got = with_group_ids(df, ["a", "b"], ["c"])
    assert sorted(as_rows(got, "a", "b", "c", "id")) == sorted(as_rows(wanted, "a", "b", "c", "id"))


def test_the_fact_is_written_once(spark, tmp_path, monkeypatch):
    """What is written on the way holds no column of a set."""
    written, write = [], ids.staged
    monkeypatch.setattr(ids, "staged", lambda df, name: written.append((name, df.columns)) or write(df, name))
    rows = series(spark, *((k, f"E {k % 3}", "x", None) for k in (1, 2, 40_000, 40_001, 90_000)))
    star = silver.build_star(rows, sesiones(spark, (1, "M 1", datetime(2024, 1, 1)), (2, "M 2", None)))
    assert sorted(as_rows(star.fact, "serie_id")) == [(k,) for k in range(1, 11)]
    assert [name for name, _ in written].count("group-sizes") == 1
    assert not any({"repeticiones_ejecutadas", "numero_serie"} & set(columns) for _, columns in written)


def scanned(df):
    """Rows that leave the scan of a plan without shuffles."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_bloom_filters_pass_over_row_groups_of_many_ids(spark, tmp_path):
    rows = spark.range(0, 400_000, 2, 1).withColumnRenamed("id", "ejercicio_id")
    for blooms, name in ((None, "bare"), ({"t": {"ejercicio_id": 200_000}}, "blooms")):
        root = str(tmp_path / name)
        folder = write_tables(spark, root, 1, {"t": rows}, {"t": rows.schema}, blooms=blooms)
        table = spark.read.parquet(f"{root}/{folder}/t")
        assert (scanned(table.filter("ejercicio_id = 200001")) == 0) == bool(blooms)
        assert table.filter("ejercicio_id = 200002").count() == 1


def test_an_exercise_passes_over_row_groups_without_it(spark, tmp_path):
    days = [datetime(2024, 1, k) for k in (1, 2)]
    ses = sesiones(spark, (1, "M 1", days[0])).unionByName(
        sesiones(spark, (2, "M 1", days[1])).withColumn("numero_dia", F.lit(2)))
    ser = series(spark, *((k, "AC"[k % 2], "x", None) for k in range(1, 4001)), *(
        (k, "B", "x", None, {"sesion_id": 2, "numero_dia": 2}) for k in range(4001, 8001)))
    root = str(tmp_path / "s")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files of few rows
    try:
        write_silver(silver.build_star(ser, ses), root)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    star = read_silver(spark, root)
    assert scanned(star.fact) == 8000
    assert 4000 <= scanned(filters.of_exercise(star.fact, star, "B")) < 6000
    assert metrics.exercise_progress(star, "B").count() == 4000
    assert metrics.exercise_progress(star, "none").count() == 0
    joined = filters.of_exercise(star.fact, star, "B", at_most=0)
    assert joined.count() == filters.of_exercise(star.fact, star, "B").count() == 4000


def test_append_goes_on_from_the_highest_id(spark):
    old = spark.createDataFrame([(7, "x")], "id bigint, n string")
    new = spark.createDataFrame([("b",), ("a",)], "n string")
    assert sorted(as_rows(append_with_ids(old, new, ["n"]))) == [(7, "x"), (8, "a"), (9, "b")]
    assert sorted(as_rows(append_with_ids(old.limit(0), new, ["n"]))) == [(1, "a"), (2, "b")]


def test_replacing_sheets_is_idempotent_and_drops_emptied_ones(spark):
    rows = spark.createDataFrame([("Ana", "Meso 1", 1), ("Ana", "Meso 2", 2), ("Eva", "Meso 1", 3)],
                                 "athlete string, sheet_name string, id int")
    read = rows.filter("athlete = 'Ana' and sheet_name = 'Meso 1'")
    once = replace_sheets(rows, read, read)
    assert sorted(as_rows(once)) == sorted(as_rows(rows))
    assert sorted(as_rows(replace_sheets(once, read, read))) == sorted(as_rows(rows))
    assert [r[2] for r in sorted(as_rows(replace_sheets(rows, read.limit(0), read)))] == [2, 3]


def test_versions_are_published_whole(spark, tmp_path):
    ses, ser = sesiones(spark, (1, "M 1", datetime(2024, 1, 1))), series(spark, (1, "Press", "x", None))
    root = str(tmp_path / "silver")
    star = silver.build_star(ser, ses)
    write_silver(star, root)
    broken = silver.Star(star.fact.withColumn("serie_id", F.raise_error(F.lit("no"))), star.exercises,
                         star.dates, star.plans)
    with pytest.raises(Exception, match="no"):
        write_silver(broken, root)
    stored = read_silver(spark, root)
    assert stored.fact.count() == 1
    assert as_rows(stored.fact, "mesociclo", "fecha", "carga_kg") == [
        ("Meso 1", date(2024, 1, 1), Decimal("50.00"))]
    assert as_rows(silver.verify_silver(stored), "ejercicios", "series", "sin_fecha") == [(1, 1, 0)]

    bronze_root = str(tmp_path / "bronze")
    assert read_bronze(spark, bronze_root)[0].count() == 0
    write_bronze(ses, ser, bronze_root)
    assert read_bronze(spark, bronze_root)[1].count() == 1
    clean_bronze(spark, bronze_root)
    assert read_bronze(spark, bronze_root)[1].count() == 0


def test_required_tables(spark):
    spark.range(1).createOrReplaceTempView("bronze_series")
    try:
        require_tables(spark, ["bronze_series"])
        try:
            require_tables(spark, ["bronze_series", "bronze_sesiones"])
            raise AssertionError("missing table not noticed")
        except ValueError as error:
            assert "bronze_sesiones" in str(error)
    finally:
        spark.catalog.dropTempView("bronze_series")


def test_totals_count_sessions_without_sets_and_leave_out_orphans(spark):
    ses = sesiones(spark, (1, "M 1", None), (2, "M 1", None))
    ser = series(spark, (1, "Press", "x", None), (2, "Remo", "x", None),
                 (3, "Curl", "x", None, {"sesion_id": 9}))
    assert as_rows(profile.load_totals(ses, ser), "total_sesiones", "total_series",
                   "ejercicios_unicos", "hojas_procesadas") == [(2, 3, 2, 1)]
    assert as_rows(profile.bronze_stats(ser), "total_sesiones", "total_series",
                   "ejercicios_unicos") == [(2, 3, 3)]


def test_describe(spark):
    ser = conform(series(spark), BRONZE_SERIES)
    assert as_rows(profile.describe(ser), "columna")[:2] == [("athlete",), ("id",)]


def test_no_python_and_no_forced_broadcast_in_the_fact(spark, capsys, tmp_path):
    ses, ser = sesiones(spark, (1, "M 1", datetime(2024, 1, 1))), series(spark, (1, "Press", "x", None))
    write_silver(silver.build_star(ser, ses), str(tmp_path / "s"))
    star = read_silver(spark, str(tmp_path / "s"))
    silver.fact_rows(ser, ses, star.exercises, star.dates, star.plans).explain("extended")
    plan = capsys.readouterr().out
    for unwanted in ("Python", "ResolvedHint", "CartesianProduct", "NestedLoop", "SinglePartition"):
        assert unwanted not in plan


def test_second_writer_of_a_version_fails(spark, tmp_path):
    root = str(tmp_path / "store")
    commit(spark, root, 1, "v1-a", "one")
    with pytest.raises(VersionTaken):
        commit(spark, root, 1, "v1-b", "two")
    assert as_rows(versions(spark, root), "folder") == [("v1-a",)]
    assert next_version(spark, root) == 2


def test_only_a_missing_log_counts_as_empty(spark, tmp_path):
    assert versions(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        versions(spark, "nosuch://store/root").count()


def test_fact_files_follow_ranges_not_sheet_names(spark, tmp_path, capsys):
    ses = sesiones(spark, (1, "M 1", datetime(2024, 1, 3)))
    star = silver.build_star(series(spark, *((k, "Press", "x", None) for k in range(1, 60))), ses)
    named = star.fact.withColumn("mesociclo", F.concat(F.lit("M "), "serie_id"))
    root = str(tmp_path / "silver")
    write_silver(silver.Star(named, star.exercises, star.dates, star.plans), root)
    fact = read_silver(spark, root).fact
    assert len(fact.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    fact.filter("athlete = 'Ana' and fecha = date'2024-01-03' and mesociclo = 'M 2'").explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert all(f"EqualTo({c}," in pushed for c in ("athlete", "fecha", "mesociclo"))


def test_lines_move_once_for_their_number_and_their_order(spark, tmp_path, capsys):
    # Every join shuffled: lines move for number and order together, and to their parts.
    from setlog.sources import order_tables
    spark.createDataFrame([(1, 2, 1, 1, 5.0, 0.1, 900.0), (1, 2, 1, 2, 7.0, 0.0, 1000.0), (0, 2, 1, 1, 6.0, 0.0, 500.0),
                           (None, 2, 1, 1, 6.0, 0.0, 500.0)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
                          " l_discount double, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(0, "1-URGENT", 1, datetime(2024, 1, 1)), (1, "5-LOW", 1, datetime(2024, 1, 2))],
                          "o_orderkey long, o_orderpriority string, o_custkey long, o_orderdate timestamp_ntz"
                          ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(2, "red widget", "Brand#1", "PROMO")],
                          "p_partkey long, p_name string, p_brand string, p_type string"
                          ).write.parquet(str(tmp_path / "part.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = order_tables.series(spark, str(tmp_path))
        rows = sorted(as_rows(got, "id", "sesion_id", "repeticiones", "carga_kg", "rir_rpe"))
        got.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == [(2, 1, "6.0", None, "0"), (3, 2, "5.0", None, "10"), (4, 2, "7.0", None, "0")]
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 3  # lines, group sizes, orders
    assert plan.count("Exchange hashpartitioning(l_partkey") == 2 and "l_tax" not in plan


def test_sets_move_once_to_their_block_for_dates_and_numbers(spark, capsys):
    # A session twice, one without a date, one missing, sets without session or id, an id twice.
    ses = sesiones(spark, (1, "M 1", datetime(2024, 1, 1)), (1, "M 1", datetime(2024, 1, 1)), (2, "M 1", None))
    ser = series(spark, *((k, "Press", "x", None) for k in (1, 2, 2, 3, 40_000))).withColumns({
        "sesion_id": F.expr("case id when 1 then 1L when 2 then 2L when 3 then 9L end"),
        "id": F.expr("nullif(id, 3)")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = silver.build_star(ser, ses).fact
        rows = sorted(as_rows(fact, "serie_id", "sesion_id", "fecha_id"), key=repr)
        fact.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == [(1, 9, None), (2, 1, 1), (3, 1, 1), (4, 2, None), (5, 2, None), (6, None, None)]
    plan = capsys.readouterr().out
    assert "hashpartitioning(sesion_id" not in plan
