"""Hand cases of the sheet layout rules."""

import time
from datetime import datetime
from decimal import Decimal

import pytest

from setlog.functions.layout import Layout
from setlog.operators import grid
from setlog.operators.ids import staged
from setlog.plans.bronze import extract_bronze
from setlog.sources import sheet_tables
from setlog.sources.cells import (
    blank_empty_texts, latest_snapshot, read_cells, require_meso_sheets,
    sheets_from_position, workbooks_without_meso,
)
from setlog.sources.sheet_tables import sheet_cells
from tests.conftest import as_rows
from tests.sheets import cells, day, header


def sets_of(spark, *grids, columns=("row_idx", "numero_serie", "repeticiones")):
    return sorted(as_rows(grid.extract_sets(cells(spark, *grids)), *columns))


def test_day_needs_accent_and_missing_number_counts_on(spark):
    sheet = {(0, 0): "DIA 1", (1, 0): " Día 4 ", (5, 0): "día final", (9, 3): "x"}
    days = as_rows(grid.detect_days(cells(spark, sheet)).orderBy("fila_inicio"),
                   "nombre_dia", "numero_dia", "fila_inicio", "fila_fin")
    assert days == [("Día 4", 4, 1, 4), ("día final", 2, 5, 9)]


def test_last_day_is_cut_after_sixty_rows(spark):
    sheet = {(2, 0): "DÍA 1", (90, 3): "x"}
    assert as_rows(grid.detect_days(cells(spark, sheet)), "fila_fin") == [(62,)]


def test_microcycles_come_from_the_first_header_row_in_reach(spark):
    sheet = {(1, 6): "MICROCICLO 9", (3, 8): "microciclo 2", (3, 14): "Microciclo final ",
             (4, 8): "MICROCICLO 5", (40, 8): "MICROCICLO 6", (3, 100): "MICROCICLO 7"}
    found = as_rows(grid.detect_microcycles(cells(spark, sheet)).orderBy("col_inicio"),
                    "microciclo", "numero_microciclo", "col_inicio")
    assert found == [("microciclo 2", 2, 8), ("Microciclo final ", 2, 14)]
    assert grid.detect_microcycles(cells(spark, {(35, 8): "MICROCICLO 1"})).count() == 0


def test_label_rows_ignore_what_is_too_low_or_left(spark):
    sheet = {(0, 0): "DÍA 1", (2, 0): "FECHA", (4, 1): "la fecha", (5, 49): "PRS", (6, 50): "RPE",
             (16, 1): "RPE", (30, 2): "x"}
    labels = as_rows(grid.label_rows(cells(spark, sheet)), "fila_fecha", "fila_prs", "fila_rpe")
    assert labels == [(4, 5, None)]


def test_exercise_whose_fourth_row_ends_the_block_is_dropped(spark):
    sheet = {**header("MICROCICLO 1"), **day(letter_rows=(10, 36))}
    assert [r[0] for r in sets_of(spark, sheet)] == [10]
    higher = {**header("MICROCICLO 1"), **day(letter_rows=(10, 35))}
    assert [r[0] for r in sets_of(spark, higher)] == [10, 35]


def test_overlapping_letters_are_taken_greedily(spark):
    sheet = {**header("MICROCICLO 1"), **day(letter_rows=())}
    for row in (3, 4, 7, 11, 12, 15):
        sheet[(row, 0)] = "A"
    for row in range(4, 19):
        sheet[(row, 7)] = "5"
    assert sorted({r[0] for r in sets_of(spark, sheet)}) == [3, 7, 11, 15]


def test_letter_with_blanks_starts_the_scan_only(spark):
    sheet = {**header("MICROCICLO 1"), **day(letter_rows=(20,))}
    sheet[(5, 0)] = " A"
    sheet[(6, 7)] = "5"
    assert [r[0] for r in sets_of(spark, sheet)] == [20]


def test_names_and_links(spark):
    sheet = {**header("MICROCICLO 1"), **day(letter_rows=(10, 14, 18))}
    sheet[(11, 1)] = "Sentadilla http://a http://b"
    sheet[(15, 1)] = " Remo "
    del sheet[(19, 1)]
    assert sets_of(spark, sheet, columns=("nombre_ejercicio", "url_ejercicio")) == [
        (" Remo ", None), ("Sentadilla", "http://a "), ("nan", None)]


def test_sets_need_reps_and_stop_at_five(spark):
    sheet = {**header("MICROCICLO 1"), **day(letter_rows=(10,))}
    del sheet[(11, 7)]
    for col in range(8, 14):
        sheet[(11, col)] = str(col)
    assert sets_of(spark, sheet) == [(10, 2, "8"), (10, 3, "9"), (10, 4, "10"), (10, 5, "11")]


def test_microcycles_closer_than_five_columns_share_cells(spark):
    sheet = {**header("MICROCICLO 1", "MICROCICLO 2", width=3), **day(letter_rows=(10,))}
    sheet[(11, 10)] = "12"
    found = sets_of(spark, sheet, columns=("numero_microciclo", "numero_serie", "repeticiones"))
    assert found == [(1, 1, "8"), (1, 4, "12"), (2, 1, "12")]


def test_session_values(spark):
    sheet = {**header("MICROCICLO 1", "MICROCICLO 2"), **day(), (1, 11): "7:05"}
    sheet[(2, 8)], sheet[(2, 10)] = "x", "7.5"
    sheet.update({(1, 15): "#REF!", (2, 14): "8d", (2, 15): "#N/A 3", (2, 18): "6", (11, 13): "5"})
    found = extract_bronze(cells(spark, sheet))
    assert as_rows(found.sesiones.orderBy("id"), "id", "numero_microciclo", "fecha", "hora",
                   "prs_pre_sesion", "rpe_sesion") == [
        (1, 1, datetime(2024, 1, 2), "07:05:00", Decimal("7.5"), Decimal("9.0")),
        (2, 2, None, None, Decimal("6.0"), None)]
    assert as_rows(found.series.orderBy("id"), "id", "sesion_id", "athlete") == [
        (1, 1, "Ana"), (2, 2, "Ana")]


def test_days_without_sets_have_no_session(spark):
    sheet = {**header("MICROCICLO 1", "MICROCICLO 2"), **day()}
    assert grid.session_metadata(cells(spark, sheet)).count() == 2
    assert as_rows(extract_bronze(cells(spark, sheet)).sesiones, "numero_microciclo") == [(1,)]


def test_shared_numbers_link_to_the_last_session(spark):
    sheet = {**header("MICROCICLO 1", "MICRO CICLO MICROCICLO 1"), **day(), (11, 13): "5"}
    found = extract_bronze(cells(spark, sheet))
    assert found.sesiones.count() == 2
    assert as_rows(found.series, "sesion_id") == [(2,), (2,)]


def test_bad_sheet_is_left_out_whole_and_reported(spark):
    good = {**header("MICROCICLO 1"), **day()}
    high = {**header("MICROCICLO 1"), **day(first_number="150")}
    undated = {**header("MICROCICLO 1"), **day(fecha="martes")}
    found = extract_bronze(cells(spark, good, high, undated))
    assert as_rows(found.series, "sheet_name") == [("Meso 1",)]
    assert sorted(as_rows(found.rejects)) == [
        ("Ana", "Meso 2", "prs_pre_sesion", 1), ("Ana", "Meso 3", "fecha", 1)]
    kept = extract_bronze(cells(spark, good, high, undated), keep_bad_sheets=True)
    assert kept.series.count() == 3


def test_rows_far_right_count_for_the_sheet_end(spark):
    sheet = {**header("MICROCICLO 1"), **day(letter_rows=(36,)), (41, 700): "x"}
    assert [r[0] for r in sets_of(spark, sheet)] == [36]


def test_a_cell_given_twice_counts_once(spark):
    sheet = cells(spark, {**header("MICROCICLO 1"), **day()})
    assert grid.extract_sets(sheet.unionByName(sheet)).count() == 1


def test_no_microcycle_no_sets(spark):
    assert sets_of(spark, day()) == []


def test_sheet_choice_and_workbooks(spark, tmp_path):
    two = cells(spark, day(), day())
    other = cells(spark, {(0, 0): "NA"}, workbook="20240301Eva.xlsx").replace("Meso 1", "Notas")
    both = two.unionByName(other)
    assert as_rows(workbooks_without_meso(both)) == [("20240301Eva.xlsx",)]
    assert sheets_from_position(both, 6).select("sheet_name").distinct().count() == 1
    with pytest.raises(ValueError):
        require_meso_sheets(other)
    both.write.csv(str(tmp_path / "cells"), header=True)
    read = read_cells(spark, str(tmp_path / "cells"), "csv")
    assert read.count() == both.count()
    assert read.filter("value is null").count() == 1
    assert blank_empty_texts(two).filter("value is null").count() == 0


def test_latest_snapshot(spark):
    names = spark.createDataFrame(
        [("20240101Ana.xlsx",), ("20240301Ana.xlsx",), ("20240201Eva Paz.xlsx",)], "workbook string")
    assert sorted(as_rows(latest_snapshot(names))) == [
        ("Ana", "20240301Ana.xlsx"), ("Eva Paz", "20240201Eva Paz.xlsx")]


def test_cuts_are_listed_and_a_wider_layout_takes_them(spark):
    sheet = {**header("MICROCICLO 1"), **day(letter_rows=(10, 36)), (40, 8): "MICROCICLO 2", (2, 60): "RPE",
             (11, 12): "6", (11, 6): "no set", (99, 3): "x"}
    sheet.update({(40, 0): "DÍA 2", (57, 1): "PRS", (90, 0): "B", (104, 2): "y"})
    cut = sorted(as_rows(grid.grid_cuts(cells(spark, sheet)), "row_idx", "col_idx", "motivo"))
    assert cut == [(2, 60, "etiqueta"), (11, 12, "serie"), (36, 0, "ejercicio"), (40, 8, "microciclo"),
                   (57, 1, "etiqueta"), (104, 2, "fila")]
    wide = Layout(label_end_col=100, label_rows=30, last_day_rows=90, sets=6, header_rows=50)
    assert sorted(as_rows(grid.grid_cuts(cells(spark, sheet), wide), "row_idx", "motivo")) == [(36, "ejercicio")]
    found = grid.extract_sets(cells(spark, sheet), wide)
    assert (10, 6, "6") in as_rows(found, "row_idx", "numero_serie", "repeticiones")


def test_cells_are_told_and_sorted_by_numbers(spark, capsys):
    # Sheets are sorted by a hash: names, which begin alike, are compared within a sheet alone.
    table = cells(spark, {**header("MICROCICLO 1"), **day()})
    index = grid.sheet_index(table)
    grid.read_sheets(table, index).explain()
    plan = capsys.readouterr().out
    assert "Sort [sheet_key#" in plan and "Sort [workbook#" not in plan


def test_cells_move_without_their_sheets_names(spark, capsys):
    # One row per sheet and task moves, not one per cell; a cell without a row, column or value is none.
    sheet = {**header("MICROCICLO 1"), **day(letter_rows=(10, 14))}
    table = cells(spark, sheet, sheet).repartition(3)
    none = spark.createDataFrame([("20240101Ana.xlsx", "Meso 1", 5, *place, "str") for place in (
        (None, 7, "1"), (11, None, "1"), (11, 8, None), (-1, 7, "1"), (11, -2, "1"))], table.schema)
    index = grid.sheet_index(table)
    read = grid.read_sheets(table.unionByName(none), index)
    assert sorted(as_rows(grid.sets_of(read), "sheet_name", "row_idx", "numero_serie", "repeticiones", "carga_kg")) == [
        (f"Meso {k}", row, 1, "8", "60.5") for k in (1, 2) for row in (10, 14)]
    read.explain()
    plan = capsys.readouterr().out
    assert "partial_collect_list(struct(row_idx" in plan and "Exchange hashpartitioning(workbook" not in plan


def test_a_row_that_is_a_set_and_two_labels_gives_all_its_values(spark):
    sheet = {**header("MICROCICLO 1"), **day(letter_rows=())}
    for label_row in (1, 2, 3):
        sheet.pop((label_row, 1))
    sheet.update({(5, 0): "A", (5, 1): "Empuje", (6, 1): "fecha prs rpe", (6, 7): "8", (6, 8): "9", (6, 9): "2024-01-02"})
    read = grid.session_metadata(cells(spark, sheet))
    assert as_rows(read, "fecha", "hora", "prs_pre_sesion", "rpe_sesion") == [("2024-01-02", None, "9", "9")]
    assert sets_of(spark, sheet) == [(5, 1, "8"), (5, 2, "9"), (5, 3, "2024-01-02")]


def test_sets_move_once_to_their_sheet_for_sessions_and_numbers(spark, capsys):
    sheet = header("MICROCICLO 1", "MICROCICLO 1") | day(letter_rows=(10, 14)) | day(start=40, label="DÍA 1") | {
        (11, 13): "7", (12, 13): "50", (13, 13): "1"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = extract_bronze(cells(spark, sheet, sheet))
        sessions, sets = as_rows(found.sesiones, "sheet_name", "id"), as_rows(found.series, "sheet_name", "id", "sesion_id")
        found.series.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    last = dict(sorted(sessions))
    assert len(set(last.values())) == 2 and len(sets) == 8
    assert sorted(sets, key=lambda r: r[1]) == [(f"Meso {1 + k // 4}", k + 1, last[f"Meso {1 + k // 4}"]) for k in range(8)]
    plan = capsys.readouterr().out
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "athlete" in line]
    assert not any("numero_dia" in line.split("), ")[0] for line in moved)


def test_sets_are_numbered_where_they_are_read(spark, capsys):
    # Places within the sheet are stored with the values: no window sorts the stored sets anew.
    sheet = header("MICROCICLO 1", "MICROCICLO 2", "MICROCICLO 1") | day(letter_rows=(10, 14)) | day(
        start=40, label="DÍA 7", micro_col=13) | {(11, 8): "7", (11, 13): "6", (11, 19): "5"}
    found = extract_bronze(cells(spark, sheet, sheet))
    found.series.explain()
    assert not any("Window [" in line and "sheet_key" in line for line in capsys.readouterr().out.splitlines())
    assert as_rows(found.sesiones.orderBy("id"), "id", "sheet_name", "numero_dia", "numero_microciclo") == [
        (1, "Meso 1", 1, 1), (2, "Meso 1", 1, 2), (3, "Meso 1", 1, 1), (4, "Meso 1", 7, 2),
        (5, "Meso 2", 1, 1), (6, "Meso 2", 1, 2), (7, "Meso 2", 1, 1), (8, "Meso 2", 7, 2)]
    assert as_rows(found.series.orderBy("id"), "id", "sesion_id", "repeticiones") == [
        (k + 6 * m, s + 4 * m, reps) for m in (0, 1) for k, s, reps in (
            (1, 3, "8"), (2, 3, "7"), (3, 3, "8"), (4, 2, "6"), (5, 3, "5"), (6, 4, "8"))]


def test_sets_are_sorted_twice_for_their_cells(spark, capsys):
    rows = [("20240101Ana.xlsx", "Meso 1", 5, 1, m, "A", k, 10 * m + k, "8", "60.5", "2", "Empuje", "Press", None, "3x8", 1,
             datetime(2024, 1, 2)) for m in (1, 2) for k in (1, 2)]
    sets = spark.createDataFrame(rows, "workbook string, sheet_name string, sheet_pos int, day int, micro int, letter string,"
                                 " k int, id bigint, repeticiones string, carga_kg string, rir_rpe string, tipo_ejercicio string,"
                                 " nombre_ejercicio string, url_ejercicio string, dosis string, l_orderkey bigint,"
                                 " o_orderdate timestamp")
    table = sheet_cells(sets)
    table.explain()
    assert capsys.readouterr().out.count("Sort [sheet_key") == 2
    assert table.filter("value = '3x8'").count() == 2 and table.filter("value in ('Press', 'MICROCICLO 1')").count() == 2


def test_cuts_move_sheets_not_cells(spark, capsys):
    # Cells without a row or column keep their place among what is cut.
    sheet = {**header("MICROCICLO 1", "MICROCICLO 2"), **day(), (40, 8): "MICROCICLO 9"}
    table = cells(spark, sheet, {(0, 0): "DÍA 1", (0, 7): "MICROCICLO 1"}).repartition(3)
    odd = spark.createDataFrame([("20240101Ana.xlsx", "Meso 1", 5, *place, "MICROCICLO 8", "str") for place in (
        (None, 3), (50, None), (None, None))], table.schema)
    cut = grid.grid_cuts(table.unionByName(odd))
    assert sorted(as_rows(cut, "row_idx", "col_idx", "motivo"), key=repr) == sorted(
        [(40, 8, "microciclo"), (None, 3, "microciclo"), (50, None, "microciclo")], key=repr)
    cut.explain()
    assert "partial_collect_list" in capsys.readouterr().out


def order_rows(spark, folder):
    """Lines of two customers: two orders of one place, a line that comes twice, one without customer."""
    lines = [(0, 2, 1, 1, 5.0, 0.1, 900.0), (0, 2, 1, 2, 7.0, 0.0, 1000.0), (12, 2, 1, 1, 6.0, 0.0, 500.0), (12, 2, 1, 1, 6.0, 0.0, 500.0),
             (3, 4, 2, 1, 9.0, 0.0, 700.0), (4, 4, 2, 1, 8.0, 0.0, 700.0), (9, 2, 1, 1, 6.0, 0.0, 500.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
                          " l_discount double, l_extendedprice double").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(k, p, c, datetime(2024, 1, 1 + k)) for k, p, c in (
        (0, "1-URGENT", 1), (12, "1-URGENT", 1), (3, "5-LOW", 1), (4, "5-LOW", None))],
        "o_orderkey long, o_orderpriority string, o_custkey long, o_orderdate timestamp_ntz"
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(2, "red widget", "Brand#1", "PROMO"), (4, "blue", "Brand#2", None)],
                          "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{folder}/part.parquet")


def test_sheets_are_made_where_their_lines_are_placed(spark, tmp_path, capsys):
    # Lines move to their order, their part and, once, to their customer's sheets; no set is written on the way.
    order_rows(spark, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = sheet_tables.placed_sets(spark, str(tmp_path))
        sheet_tables._set_cells(sets, sheet_tables._TOGETHER).explain()
        plan = capsys.readouterr().out
        sheet_tables.write_cells(spark, str(tmp_path), str(tmp_path / "cells"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert sorted(moved) == ["l_orderkey", "l_orderkey", "l_partkey", "l_partkey", "o_custkey"]
    table = read_cells(spark, str(tmp_path / "cells"))
    assert sorted(as_rows(table), key=repr) == sorted(as_rows(sheet_cells(sets)), key=repr)
    reps = table.filter("row_idx % 40 >= 10 and row_idx % 4 = 3 and col_idx >= 7 and row_idx < 160").select("workbook", "sheet_name", "sheet_pos", "value")
    ana = "20240101atleta1.xlsx"
    assert sorted(as_rows(reps), key=repr) == sorted([
        (ana, "Meso 1-URGENT", 5, "5.0"), (ana, "Meso 1-URGENT", 5, "7.0"), (ana, "Meso 1-URGENT 2", 1, "6.0"),
        (ana, "Meso 1-URGENT 3", 1, "6.0"), (ana, "Meso 5-LOW", 9, "9.5"), (None, "Meso 5-LOW", 9, "8.5")], key=repr)
    assert table.filter("sheet_name = 'Resumen'").count() == 2


def test_a_table_written_on_the_way_frees_its_shuffles(spark):
    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(name)
    made = staged(spark.range(1000).repartition(4, "id"), "freed")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.1)
    assert shuffled() <= before and made.count() == 1000 and spark.conf.get(name) == setting
