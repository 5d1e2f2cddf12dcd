"""DuckDB SQL for the training sheets: the cells, and what reading them must give."""

from oracle.star import BRONZE, bronze

# Every set has a place in a sheet; further sets of a place are on further sheets.
PLACED = BRONZE + """,
placed AS (
  SELECT *, (numero_serie - 1) % 5 + 1 AS k,
         row_number() OVER (PARTITION BY o_custkey, sheet_name, numero_dia, numero_microciclo,
                            grupo_ejercicio, (numero_serie - 1) % 5 ORDER BY id) AS copy FROM ser),
src AS (SELECT o_custkey, numero_dia AS d, numero_microciclo AS m, grupo_ejercicio AS letter, k, id,
               {'reps': repeticiones, 'kg': carga_kg, 'rir': rir_rpe} AS v,
               '20240101atleta' || CAST(o_custkey AS VARCHAR) || '.xlsx' AS workbook,
               'atleta' || CAST(o_custkey AS VARCHAR) AS athlete,
               'Meso ' || sheet_name || CASE WHEN copy > 1 THEN ' ' || CAST(copy AS VARCHAR) ELSE '' END
                 AS sheet_name,
               CASE WHEN copy > 1 THEN 1 ELSE 4 + CAST(substr(sheet_name, 1, 1) AS INTEGER) END
                 AS sheet_pos,
               tipo_ejercicio AS t, nombre_ejercicio AS n, url_ejercicio AS u, dosis AS dose,
               l_orderkey AS ok, o_orderdate AS od
        FROM placed),
exer AS (SELECT workbook, sheet_name, sheet_pos, d, letter, arg_min({'t': t, 'n': n, 'u': u}, id) AS e
         FROM src GROUP BY ALL),
dose AS (SELECT workbook, sheet_name, sheet_pos, d, m, letter, arg_min(dose, id) AS dosis
         FROM src GROUP BY ALL),
sess AS (SELECT athlete, workbook, sheet_name, sheet_pos, d, m, arg_min(ok, id) AS ok,
                arg_min(od, id) AS od FROM src GROUP BY ALL),
sheets AS (SELECT DISTINCT athlete, workbook, sheet_name, sheet_pos FROM src),
bad AS (SELECT athlete, workbook, sheet_name, count(*) AS cells FROM sess WHERE ok % 997 = 0
        GROUP BY ALL),
sesiones AS (
  SELECT athlete, row_number() OVER (ORDER BY athlete, workbook, sheet_pos, sheet_name, d, m) AS id,
         sheet_name, d AS numero_dia, 'DÍA ' || CAST(d AS VARCHAR) AS nombre_dia,
         'MICROCICLO ' || CAST(m AS VARCHAR) AS microciclo, m AS numero_microciclo,
         CASE WHEN ok % 17 = 0 THEN NULL ELSE od END AS fecha, '18:30:00' AS hora,
         ok % 10 + 0.5::DOUBLE AS prs_pre_sesion, CAST(ok % 10 + 1 AS DOUBLE) AS rpe_sesion
  FROM sess ANTI JOIN bad USING (workbook, sheet_name)),
series AS (
  SELECT athlete, row_number() OVER (ORDER BY athlete, workbook, sheet_pos, sheet_name, d, m,
                                              letter, k) AS id,
         sheet_name, d AS numero_dia, 'MICROCICLO ' || CAST(m AS VARCHAR) AS microciclo,
         m AS numero_microciclo, letter AS grupo_ejercicio, e.t AS tipo_ejercicio,
         CASE WHEN e.u IS NULL THEN e.n ELSE trim(e.n) END AS nombre_ejercicio,
         e.u AS url_ejercicio, dosis, CAST(k AS INTEGER) AS numero_serie, v.reps AS repeticiones,
         v.kg AS carga_kg, v.rir AS rir_rpe, 'RIR' AS tipo_metrica
  FROM src JOIN exer USING (workbook, sheet_name, sheet_pos, d, letter)
  JOIN dose USING (workbook, sheet_name, sheet_pos, d, m, letter)
  ANTI JOIN bad USING (workbook, sheet_name)),
linked AS (
  SELECT series.*, s.id AS sesion_id
  FROM series JOIN sesiones s USING (athlete, sheet_name, numero_dia, numero_microciclo)),
rows_of AS (
  SELECT athlete, l.id AS serie_id, sesion_id, trim(nombre_ejercicio) AS nombre,
         CAST(s.fecha AS DATE) AS fecha, coalesce(try_cast(repeticiones AS INTEGER), 0) AS reps0,
         try_cast(repeticiones AS INTEGER) AS reps, try_cast(carga_kg AS DECIMAL(6,2)) AS kg
  FROM linked l JOIN (SELECT id AS sesion_id, fecha FROM sesiones) s USING (sesion_id)
  WHERE trim(nombre_ejercicio) NOT IN ('', 'nan'))"""

BEYOND = """
beyond AS (
  SELECT workbook, sheet_name, sheet_pos, x.r, x.c, x.v, x.motivo FROM sheets, (VALUES
    (2, 60, 'RPE', 'etiqueta'), (40, 8, 'MICROCICLO 9', 'microciclo'), (178, 0, 'F', 'ejercicio'),
    (190, 3, 'fin', 'fila')) AS x(r, c, v, motivo) WHERE sheet_name LIKE 'Meso 5%'
  UNION ALL
  SELECT workbook, sheet_name, sheet_pos, 11, 43, '9', 'serie' FROM exer
  WHERE d = 1 AND letter = 'A' AND sheet_name LIKE 'Meso 5%')"""

CELLS = BEYOND + """,
cells AS (
  SELECT workbook, sheet_name, sheet_pos, (d - 1) * 40 + 10 + (ascii(letter) - 65) * 4 + x.dr AS r,
         7 + (m - 1) * 6 + k - 1 AS c, x.v AS value
  FROM src, LATERAL (VALUES (1, v.reps), (2, v.kg), (3, v.rir)) AS x(dr, v)
  UNION ALL
  SELECT workbook, sheet_name, sheet_pos, (d - 1) * 40 + 10 + (ascii(letter) - 65) * 4,
         7 + (m - 1) * 6, dosis FROM dose
  UNION ALL
  SELECT workbook, sheet_name, sheet_pos, (d - 1) * 40 + 10 + (ascii(letter) - 65) * 4 + x.dr, x.c, x.v
  FROM exer, LATERAL (VALUES (0, 0, letter), (0, 1, e.t), (1, 1, e.n)) AS x(dr, c, v)
  UNION ALL
  SELECT workbook, sheet_name, sheet_pos, (d - 1) * 40 + x.dr, 7 + (m - 1) * 6 + x.dc, x.v
  FROM sess, LATERAL (VALUES (1, 2, 'd'), (1, 4, 't'), (2, 1, CASE WHEN ok % 3 = 0 THEN 'x' END),
                             (2, 2, 'n'), (3, 1, 'n')) AS x(dr, dc, v)
  UNION ALL
  SELECT workbook, sheet_name, sheet_pos, CAST(x.d AS INTEGER) * 40 + y.dr, y.c, 'x' FROM sheets,
    range(0, 4) AS x(d), (VALUES (0, 0), (1, 1), (2, 1), (3, 1), (39, 1)) AS y(dr, c)
  UNION ALL
  SELECT workbook, sheet_name, sheet_pos, 0, 7 + 6 * CAST(x.m AS INTEGER), 'x' FROM sheets, range(0, 6) AS x(m)
  UNION ALL
  SELECT workbook, sheet_name, sheet_pos, r, c, v FROM beyond
  UNION ALL
  SELECT DISTINCT workbook, y.n, y.p, 0, 0, 'x' FROM sheets,
    (VALUES ('Resumen', 0), ('Notas', 12)) AS y(n, p))"""


def sheets(select: str, ctes: str = "") -> str:
    return f"WITH {PLACED}{',' if ctes else ''}{ctes}\n{select}"


_DATED = """
days AS (SELECT DISTINCT athlete, fecha FROM rows_of WHERE fecha IS NOT NULL)"""
_RUNS = _DATED + """,
marked AS (SELECT *, CASE WHEN date_diff('day', lag(fecha) OVER w, fecha) > rest + 1
                          THEN 1 ELSE 0 END AS gap
           FROM (SELECT *, CAST(range AS INTEGER) AS rest FROM days, range(1, 6))
           WINDOW w AS (PARTITION BY athlete, rest ORDER BY fecha)),
runs AS (SELECT *, sum(gap) OVER (PARTITION BY athlete, rest ORDER BY fecha) AS run FROM marked),
streaks AS (SELECT athlete, rest AS dias_descanso, max(n) AS racha
            FROM (SELECT athlete, rest, run, count(*) AS n FROM runs GROUP BY ALL) GROUP BY ALL)"""
_MONTHS = """
months AS (SELECT athlete, year(fecha) AS y, month(fecha) AS mo, count(*) AS dias,
                  min(fecha) AS first FROM days GROUP BY ALL),
kept AS (SELECT * FROM months QUALIFY NOT (
           row_number() OVER (PARTITION BY athlete ORDER BY y, mo) = 1
           AND count(*) OVER (PARTITION BY athlete) > 2
           AND day(min(first) OVER (PARTITION BY athlete)) > 1)),
names AS (SELECT ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto',
                  'Septiembre', 'Octubre', 'Noviembre', 'Diciembre'] AS mm),
ends AS (SELECT athlete, first(mm[mo] || ' ' || CAST(y AS VARCHAR) ORDER BY dias, y, mo) AS peor_mes,
                min(dias) AS peor_dias,
                first(mm[mo] || ' ' || CAST(y AS VARCHAR) ORDER BY dias DESC, y, mo) AS mejor_mes,
                max(dias) AS mejor_dias FROM kept, names GROUP BY athlete)"""

SQL = {
    "cells_scan": sheets("""
SELECT workbook, sheet_name, count(*) AS celdas, max(r) AS ultima_fila, max(c) AS ultima_columna
FROM cells WHERE value IS NOT NULL GROUP BY workbook, sheet_name""", CELLS),
    "sheet_filter": sheets("""
SELECT x.regla, count(DISTINCT (workbook, sheet_name)) AS hojas, count(*) AS celdas
FROM cells, (VALUES ('nombre'), ('posicion')) AS x(regla)
WHERE value IS NOT NULL AND CASE x.regla WHEN 'nombre' THEN contains(sheet_name, 'Meso')
                                         ELSE sheet_pos >= 5 END GROUP BY x.regla""", CELLS),
    "latest_snapshot": """
SELECT 'atleta' || CAST(o_custkey AS VARCHAR) AS athlete,
       max(strftime(o_orderdate, '%Y%m%d') || 'atleta' || CAST(o_custkey AS VARCHAR) || '.xlsx')
         AS workbook
FROM orders GROUP BY o_custkey""",
    "grid_days": sheets("""
SELECT workbook, sheet_name, 'DÍA ' || CAST(d + 1 AS VARCHAR) AS nombre_dia,
       CAST(d + 1 AS INTEGER) AS numero_dia, CAST(d * 40 AS INTEGER) AS fila_inicio,
       CAST(CASE WHEN d = 3 AND sheet_name LIKE 'Meso 5%' THEN 180 ELSE d * 40 + 39 END AS INTEGER) AS fila_fin
FROM sheets, range(0, 4) AS x(d)"""),
    "grid_micros": sheets("""
SELECT workbook, sheet_name, 'MICROCICLO ' || CAST(m + 1 AS VARCHAR) AS microciclo,
       CAST(m + 1 AS INTEGER) AS numero_microciclo, CAST(7 + 6 * m AS INTEGER) AS col_inicio
FROM sheets, range(0, 6) AS x(m)"""),
    "grid_labels": sheets("""
SELECT workbook, sheet_name, CAST(d + 1 AS INTEGER) AS numero_dia,
       CAST(d * 40 AS INTEGER) AS fila_inicio, CAST(d * 40 + 1 AS INTEGER) AS fila_fecha,
       CAST(d * 40 + 2 AS INTEGER) AS fila_prs, CAST(d * 40 + 3 AS INTEGER) AS fila_rpe
FROM sheets, range(0, 4) AS x(d)"""),
    "grid_session_values": sheets("""
SELECT h.workbook, h.sheet_name, h.sheet_pos, CAST(x.d AS INTEGER) AS numero_dia,
       'DÍA ' || CAST(x.d AS VARCHAR) AS nombre_dia,
       'MICROCICLO ' || CAST(y.m AS VARCHAR) AS microciclo,
       CAST(y.m AS INTEGER) AS numero_microciclo,
       CASE WHEN ok % 17 <> 0 THEN strftime(od, '%Y-%m-%d %H:%M:%S') END AS fecha,
       CASE WHEN ok IS NOT NULL THEN '18:30:00' END AS hora,
       CASE WHEN ok % 997 = 0 THEN '150' ELSE CAST(ok % 10 AS VARCHAR) || '.5' END AS prs_pre_sesion,
       CAST(ok % 10 + 1 AS VARCHAR) AS rpe_sesion
FROM sheets h CROSS JOIN range(1, 5) AS x(d) CROSS JOIN range(1, 7) AS y(m)
LEFT JOIN sess s ON s.workbook = h.workbook AND s.sheet_name = h.sheet_name AND s.d = x.d AND s.m = y.m"""),
    "grid_cuts": sheets("""
SELECT workbook, sheet_name, r AS row_idx, c AS col_idx, v AS value, motivo FROM beyond""", BEYOND),
    "load_verification": sheets("""
SELECT * FROM (VALUES
  ('bronze_sesiones', (SELECT count(*) FROM sesiones)), ('bronze_series', (SELECT count(*) FROM linked)),
  ('silver_fact_series', (SELECT count(*) FROM rows_of)),
  ('silver_dim_ejercicios', (SELECT count(DISTINCT (athlete, nombre)) FROM rows_of)),
  ('silver_dim_fecha', (SELECT count(DISTINCT (athlete, fecha)) FROM sesiones WHERE fecha IS NOT NULL)),
  ('silver_dim_plan', (SELECT count(DISTINCT (athlete, sheet_name, numero_dia, numero_microciclo)) FROM sesiones)),
  ('rejects', (SELECT count(*) FROM bad)), ('loads', (SELECT count(DISTINCT workbook) FROM sheets)),
  ('holders', (SELECT count(DISTINCT workbook) FROM sheets))) AS t("table", rows), (SELECT 0::BIGINT AS missing)"""),
    "bronze_clean": bronze("""
SELECT * FROM (VALUES ('antes', 'bronze_sesiones', (SELECT count(*) FROM ses)),
                      ('antes', 'bronze_series', (SELECT count(*) FROM ser)),
                      ('limpio', 'bronze_sesiones', 0), ('limpio', 'bronze_series', 0)) AS t(estado, tabla, filas)"""),
    "grid_sessions": sheets("SELECT * FROM sesiones"),
    "grid_series": sheets("SELECT * FROM linked"),
    "sheet_rejects": sheets("SELECT athlete, sheet_name, 'prs_pre_sesion' AS reason, cells FROM bad"),
    "session_link": bronze("""
SELECT ser.id, s.id AS sesion_id FROM ser
JOIN (SELECT sheet_name, numero_dia, numero_microciclo, max(id) AS id FROM ses GROUP BY ALL) s
  USING (sheet_name, numero_dia, numero_microciclo)"""),
    "sheet_replace": bronze("""
SELECT id, sheet_name, CASE WHEN sheet_name = '1-URGENT' THEN '99' ELSE repeticiones END
         AS repeticiones
FROM ser WHERE sheet_name <> '2-HIGH'"""),
    "append_ids": bronze("""
SELECT id, sheet_name FROM ses
UNION ALL
SELECT (SELECT max(id) FROM ses) + row_number() OVER (ORDER BY c_name), c_name FROM customer"""),
    "incremental_load": sheets("""
SELECT athlete, mesociclo, tipo AS tipo_ejercicio, CAST(sum(reps0 * coalesce(kg, 0)) AS DOUBLE) AS volumen,
       count(*) AS series, CAST(sum(reps) AS BIGINT) AS total_reps
FROM (SELECT r.*, l.sheet_name AS mesociclo FROM rows_of r JOIN linked l ON r.serie_id = l.id) r
JOIN (SELECT athlete, trim(nombre_ejercicio) AS nombre, arg_min({'t': tipo_ejercicio}, id).t AS tipo
      FROM left_over GROUP BY ALL) USING (athlete, nombre)
WHERE tipo IS NOT NULL AND NOT (mesociclo = 'Meso 5-LOW' AND athlete IN (SELECT athlete FROM renewed))
GROUP BY ALL""", """
renewed AS (SELECT 'atleta' || CAST(c_custkey AS VARCHAR) AS athlete FROM customer
            WHERE c_mktsegment = 'BUILDING'),
left_over AS (SELECT * FROM linked WHERE NOT (sheet_name = 'Meso 5-LOW'
                                              AND athlete IN (SELECT athlete FROM renewed)))"""),
    # An emptied sheet loses its rows unless it was rejected, and then it never had any.
    "sheet_reload": sheets("""
SELECT athlete, sheet_name, count(*) AS series, count(DISTINCT id) AS ids,
       count(DISTINCT sesion_id) AS sesiones
FROM linked WHERE sheet_name NOT LIKE 'Meso 3-MEDIUM%' GROUP BY ALL"""),
    "position_load": sheets("""
SELECT athlete, sheet_name, count(*) AS series, count(DISTINCT id) AS ids,
       count(DISTINCT sesion_id) AS sesiones
FROM linked JOIN (SELECT DISTINCT athlete, sheet_name, sheet_pos FROM src) USING (athlete, sheet_name)
WHERE sheet_pos >= 5 GROUP BY athlete, sheet_name"""),
    "streak_all_athletes": """
WITH days AS (SELECT DISTINCT o_custkey AS c, CAST(o_orderdate AS DATE) AS f FROM orders),
marked AS (SELECT *, CASE WHEN date_diff('day', lag(f) OVER w, f) > 61 THEN 1 ELSE 0 END AS gap
           FROM days WINDOW w AS (PARTITION BY c ORDER BY f)),
runs AS (SELECT *, sum(gap) OVER (PARTITION BY c ORDER BY f) AS run FROM marked),
best AS (SELECT c, max(n) AS racha FROM (SELECT c, run, count(*) AS n FROM runs GROUP BY ALL) GROUP BY c)
SELECT CAST(c_custkey AS VARCHAR) AS athlete, coalesce(racha, 0) AS racha
FROM customer LEFT JOIN best ON c = c_custkey""",
    "athlete_kpis": sheets("""
SELECT athlete, count(*) AS total_series, count(DISTINCT nombre) AS ejercicios,
       CAST(max(kg) AS DOUBLE) AS max_carga, count(DISTINCT fecha) AS dias
FROM rows_of GROUP BY athlete"""),
    "athlete_weekly_volume": sheets("""
SELECT athlete, CAST(anio AS VARCHAR) || '-S' || lpad(CAST(semana_anio AS VARCHAR), 2, '0') AS semana,
       semana_anio, anio, CAST(sum(reps0 * coalesce(kg, 0)) AS DOUBLE) AS volumen, count(*) AS series
FROM (SELECT *, CAST(year(fecha) AS INTEGER) AS anio,
             CAST(weekofyear(fecha) AS INTEGER) AS semana_anio FROM rows_of)
WHERE fecha IS NOT NULL GROUP BY athlete, anio, semana_anio"""),
    "athlete_records": sheets("""
SELECT athlete, nombre AS "Ejercicio", tipo AS "Grupo", CAST(kg AS DOUBLE) AS "Record (kg)",
       reps AS "Reps", fecha AS "Fecha"
FROM rows_of JOIN firsts USING (athlete, nombre) WHERE kg IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY athlete, nombre
                           ORDER BY kg DESC, fecha DESC NULLS LAST, serie_id) = 1""", """
firsts AS (SELECT athlete, trim(nombre_ejercicio) AS nombre,
                  arg_min({'t': tipo_ejercicio}, id).t AS tipo
           FROM linked GROUP BY ALL)"""),
    "athlete_streaks": sheets("SELECT * FROM streaks", _RUNS),
    "athlete_frequency": sheets("""
SELECT a.athlete, coalesce(w.total_dias, 0) AS total_dias,
       coalesce(w.dias_por_semana, 0) AS dias_por_semana, coalesce(s.racha, 0) AS racha,
       coalesce(e.peor_mes, '—') AS peor_mes, coalesce(e.peor_dias, 0) AS peor_dias,
       coalesce(e.mejor_mes, '—') AS mejor_mes, coalesce(e.mejor_dias, 0) AS mejor_dias
FROM (SELECT DISTINCT athlete FROM rows_of) a
LEFT JOIN (SELECT athlete, CAST(sum(n) AS BIGINT) AS total_dias, avg(n) AS dias_por_semana
           FROM (SELECT athlete, count(*) AS n FROM days
                 GROUP BY athlete, year(fecha), weekofyear(fecha)) GROUP BY athlete) w USING (athlete)
LEFT JOIN (SELECT * FROM streaks WHERE dias_descanso = 1) s USING (athlete)
LEFT JOIN ends e USING (athlete)""", _RUNS + "," + _MONTHS),
}
