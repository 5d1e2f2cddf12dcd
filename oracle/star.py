"""DuckDB SQL for the star and everything read from it, over the order tables."""

# Order tables as sessions and sets.
BRONZE = """
ses AS (
  SELECT o_orderkey + 1 AS id, o_orderpriority AS sheet_name,
         CAST(o_orderkey % 4 + 1 AS INTEGER) AS numero_dia,
         'DÍA ' || CAST(o_orderkey % 4 + 1 AS VARCHAR) AS nombre_dia,
         'MICROCICLO ' || CAST(o_orderkey % 6 + 1 AS VARCHAR) AS microciclo,
         CAST(o_orderkey % 6 + 1 AS INTEGER) AS numero_microciclo,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderdate END AS fecha
  FROM orders),
lines AS (
  SELECT *, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
ser AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                     l_extendedprice) AS id,
         o_custkey, l_orderkey, o_orderdate,
         l_orderkey + 1 AS sesion_id, o_orderpriority AS sheet_name,
         CAST(l_orderkey % 4 + 1 AS INTEGER) AS numero_dia,
         'MICROCICLO ' || CAST(l_orderkey % 6 + 1 AS VARCHAR) AS microciclo,
         CAST(l_orderkey % 6 + 1 AS INTEGER) AS numero_microciclo,
         substr('ABCDEF', CAST(l_suppkey % 6 + 1 AS INTEGER), 1) AS grupo_ejercicio,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS tipo_ejercicio,
         CASE WHEN p_partkey % 97 = 0 THEN 'nan'
              WHEN p_partkey % 5 = 0 THEN '  ' || p_name || ' ' ELSE p_name END AS nombre_ejercicio,
         CASE WHEN p_partkey % 3 = 0 THEN 'http://v/' || CAST(p_partkey AS VARCHAR) END AS url_ejercicio,
         p_brand AS dosis, CAST(l_linenumber AS INTEGER) AS numero_serie,
         CASE l_suppkey % 10 WHEN 0 THEN '12-10' WHEN 1 THEN q || '.0' WHEN 2 THEN q || '.5'
              ELSE q END AS repeticiones,
         CASE l_suppkey % 13 WHEN 0 THEN 'PC' WHEN 1 THEN NULL
              ELSE CAST(CAST(floor(l_extendedprice / 500) AS INTEGER) AS VARCHAR)
                || CASE l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN '.5' WHEN 2 THEN '.25'
                   ELSE '.0' END END AS carga_kg,
         CASE l_suppkey % 7 WHEN 0 THEN NULL
              ELSE CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) END AS rir_rpe
  FROM lines)"""

STAR = BRONZE + """,
named AS (
  SELECT *, trim(nombre_ejercicio) AS nombre FROM ser
  WHERE trim(nombre_ejercicio) NOT IN ('', 'nan')),
de AS (
  SELECT row_number() OVER (ORDER BY nombre) AS ejercicio_id, nombre AS nombre_ejercicio,
         k.t AS tipo_ejercicio, k.u AS url_video
  FROM (SELECT nombre, arg_min({'t': tipo_ejercicio, 'u': url_ejercicio}, id) AS k
        FROM named GROUP BY nombre)),
df AS (
  SELECT row_number() OVER (ORDER BY m) AS fecha_id, CAST(m AS DATE) AS fecha,
         CAST(year(m) AS INTEGER) AS anio, CAST(month(m) AS INTEGER) AS mes,
         CAST(day(m) AS INTEGER) AS dia, CAST(dayofweek(m) AS INTEGER) AS dia_semana,
         ['Domingo', 'Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado']
           [dayofweek(m) + 1] AS nombre_dia_semana,
         CAST(weekofyear(m) AS INTEGER) AS semana_anio
  FROM (SELECT DISTINCT fecha AS m FROM ses WHERE fecha IS NOT NULL)),
dp AS (
  SELECT row_number() OVER (ORDER BY sheet_name, numero_dia, numero_microciclo, nombre_dia,
                                     microciclo) AS plan_id,
         sheet_name, sheet_name AS mesociclo, numero_dia, nombre_dia, microciclo, numero_microciclo
  FROM (SELECT DISTINCT sheet_name, numero_dia, nombre_dia, microciclo, numero_microciclo FROM ses)),
fact AS (
  SELECT row_number() OVER (ORDER BY n.id, df.fecha_id, dp.plan_id) AS serie_id, n.sesion_id,
         de.ejercicio_id, df.fecha_id, dp.plan_id, n.grupo_ejercicio, n.numero_serie,
         try_cast(n.repeticiones AS INTEGER) AS reps, n.repeticiones AS repeticiones_texto,
         try_cast(n.carga_kg AS DECIMAL(6,2)) AS kg, try_cast(n.rir_rpe AS INTEGER) AS rir,
         n.dosis
  FROM named n
  LEFT JOIN de ON n.nombre = de.nombre_ejercicio
  LEFT JOIN ses s ON n.sesion_id = s.id
  LEFT JOIN df ON s.fecha = df.fecha
  LEFT JOIN dp ON n.sheet_name = dp.sheet_name AND n.numero_dia = dp.numero_dia
    AND n.numero_microciclo = dp.numero_microciclo),
wide AS (
  SELECT f.*, coalesce(f.reps, 0) * coalesce(f.kg, 0) AS vol,
         e.nombre_ejercicio, e.tipo_ejercicio, d.fecha, d.anio, d.mes, d.dia_semana,
         d.nombre_dia_semana, d.semana_anio, p.mesociclo, p.numero_microciclo,
         CAST(d.anio AS VARCHAR) || '-S' || lpad(CAST(d.semana_anio AS VARCHAR), 2, '0') AS semana
  FROM fact f LEFT JOIN de e USING (ejercicio_id) LEFT JOIN df d USING (fecha_id)
  LEFT JOIN dp p USING (plan_id))"""

FILTER = """mesociclo IN ('1-URGENT', '2-HIGH') AND tipo_ejercicio IN ('ECONOMY', 'PROMO')
    AND fecha BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"""


def bronze(select: str) -> str:
    return f"WITH {BRONZE}\n{select}"


def star(select: str, ctes: str = "") -> str:
    return f"WITH {STAR}{',' if ctes else ''}{ctes}\n{select}"


_FREQ = """
freq AS (SELECT fecha, dia_semana, nombre_dia_semana, semana_anio, anio, mes,
                count(DISTINCT sesion_id) AS sesiones, count(*) AS series
         FROM wide WHERE fecha IS NOT NULL GROUP BY ALL)"""
_MONTHS = _FREQ + """,
months AS (SELECT anio, mes, count(DISTINCT fecha) AS dias, anio * 12 + mes AS place
           FROM freq GROUP BY anio, mes),
full_months AS (
  SELECT * FROM months
  WHERE NOT (place = (SELECT min(place) FROM months) AND (SELECT count(*) FROM months) > 2
             AND (SELECT day(min(fecha)) FROM freq) > 1))"""
_BEST = """
best AS (SELECT fecha, mesociclo, max(kg) AS carga_kg, max(reps) AS reps
         FROM wide WHERE nombre_ejercicio = 'red widget' AND kg IS NOT NULL AND fecha IS NOT NULL
         GROUP BY fecha, mesociclo)"""
_RECORDS = """
records AS (
  SELECT nombre_ejercicio, tipo_ejercicio, CAST(kg AS DOUBLE) AS kg, reps, fecha
  FROM wide WHERE kg IS NOT NULL AND ejercicio_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY ejercicio_id
                             ORDER BY wide.kg DESC, fecha DESC NULLS LAST, serie_id) = 1)"""
_GROUPS = """
groups AS (
  SELECT tipo_ejercicio, count(*) AS total_series, CAST(sum(vol) AS DOUBLE) AS volumen,
         count(DISTINCT ejercicio_id) AS ejercicios_distintos,
         round(avg(CAST(kg AS DOUBLE)), 1) AS carga_promedio
  FROM wide WHERE tipo_ejercicio IS NOT NULL GROUP BY tipo_ejercicio)"""
_WEEK_GROUPS = """
wg AS (
  SELECT semana, semana_anio, anio, tipo_ejercicio, CAST(sum(vol) AS DOUBLE) AS volumen,
         count(*) AS series, CAST(sum(reps) AS BIGINT) AS total_reps
  FROM wide WHERE tipo_ejercicio IS NOT NULL AND fecha IS NOT NULL
  GROUP BY semana, semana_anio, anio, tipo_ejercicio)"""
_MESO_GROUPS = """
mg AS (
  SELECT mesociclo, tipo_ejercicio, CAST(sum(vol) AS DOUBLE) AS volumen, count(*) AS series,
         CAST(sum(reps) AS BIGINT) AS total_reps
  FROM wide WHERE tipo_ejercicio IS NOT NULL AND plan_id IS NOT NULL
  GROUP BY mesociclo, tipo_ejercicio)"""
_LABELS = """
labels_of(tipo, corto) AS (VALUES
  ('Tracción', 'Tracción'), ('Empuje', 'Empuje'), ('DomCaderaxIsquiosxGlúteos', 'Cadera/Glúteos'),
  ('DomRodillaxCuádriceps', 'Cuádriceps'), ('CORE', 'Core'), ('Tríceps', 'Tríceps'),
  ('Biceps', 'Bíceps'), ('DeltoideMedio', 'Deltoides'), ('Abs', 'Abdominales'),
  ('GemelosxSóleo', 'Gemelos'))"""
_KPIS = """SELECT count(*) AS total_series, count(DISTINCT ejercicio_id) AS ejercicios,
  CAST(max(kg) AS DOUBLE) AS max_carga, count(DISTINCT fecha) AS dias
FROM wide WHERE ejercicio_id IS NOT NULL"""
_QUALITY = """
quality AS (
  SELECT count(*) AS total_series,
         count(*) - count(ejercicio_id) AS sin_ejercicio_id,
         count(*) - count(fecha_id) AS sin_fecha_id,
         count(*) - count(plan_id) AS sin_plan_id,
         count(*) - count(reps) AS sin_reps, count(*) - count(kg) AS sin_carga,
         count(*) - count(rir) AS sin_rir,
         round(count(*) FILTER (ejercicio_id IS NOT NULL AND fecha_id IS NOT NULL
                                AND plan_id IS NOT NULL) * 100.0 / count(*), 1) AS pct_completo
  FROM fact)"""


def _streak(days: str, by: str) -> str:
    """Longest run per ``by`` over a table of (by, rest, fecha)."""
    return f"""
marked AS (SELECT *, CASE WHEN date_diff('day', lag(fecha) OVER w, fecha) > rest + 1
                          THEN 1 ELSE 0 END AS gap
           FROM ({days}) WINDOW w AS (PARTITION BY {by} ORDER BY fecha)),
runs AS (SELECT *, sum(gap) OVER (PARTITION BY {by} ORDER BY fecha) AS run FROM marked),
lens AS (SELECT {by}, run, count(*) AS n FROM runs GROUP BY {by}, run)"""


def _repeats(table: str, name: str, key: str) -> str:
    return f"SELECT '{name}' AS control, count(*) - count(DISTINCT {key}) AS filas FROM {table}"


def _orphans(table: str, name: str, column: str, dim: str, key: str) -> str:
    return (f"SELECT '{name}' AS control, count(*) AS filas FROM {table} WHERE {column} IS NOT NULL"
            f" AND {column} NOT IN (SELECT {key} FROM {dim})")


SQL = {
    # Star build.
    "dim_exercise": star("SELECT * FROM de"),
    "dim_exercise_first_nonnull": star("""
SELECT row_number() OVER (ORDER BY nombre) AS ejercicio_id, nombre AS nombre_ejercicio,
       arg_min(tipo_ejercicio, id) FILTER (tipo_ejercicio IS NOT NULL) AS tipo_ejercicio,
       arg_min(url_ejercicio, id) FILTER (url_ejercicio IS NOT NULL) AS url_video
FROM named GROUP BY nombre"""),
    "dim_date": star("SELECT * FROM df"),
    "dim_plan": star("SELECT * FROM dp"),
    "fact_series": star("""
SELECT serie_id, sesion_id, ejercicio_id, fecha_id, plan_id, grupo_ejercicio, numero_serie,
       reps AS repeticiones_ejecutadas, repeticiones_texto, CAST(kg AS DOUBLE) AS carga_kg,
       rir AS rir_rpe, 'RIR' AS tipo_metrica, dosis AS dosis_prescrita FROM fact"""),
    "verify_silver": star("""
SELECT (SELECT count(*) FROM de) AS ejercicios, (SELECT count(*) FROM df) AS fechas,
       (SELECT min(fecha) FROM df) AS min_fecha, (SELECT max(fecha) FROM df) AS max_fecha,
       (SELECT count(*) FROM dp) AS planes, total_series AS series,
       sin_ejercicio_id AS sin_ejercicio, sin_fecha_id AS sin_fecha, sin_plan_id AS sin_plan,
       sin_carga, sin_rir FROM quality""", _QUALITY),
    "silver_refresh": star("""
SELECT (SELECT count(*) FROM de) AS total_ejercicios, (SELECT count(*) FROM df) AS total_fechas,
       (SELECT count(*) FROM dp) AS total_planes, (SELECT count(*) FROM fact) AS total_series"""),
    "dense_id": bronze("SELECT id, sesion_id, numero_serie, nombre_ejercicio FROM ser"),
    # Filters and options.
    "filtered_kpis": star(f"{_KPIS} AND {FILTER}"),
    "filters_default_all": star(
        f"{_KPIS} AND mesociclo IS NOT NULL AND tipo_ejercicio IS NOT NULL AND fecha IS NOT NULL"),
    "exercise_lookup": star("SELECT * FROM de WHERE nombre_ejercicio = 'red widget'"),
    "opt_mesociclos": star("SELECT DISTINCT mesociclo FROM dp"),
    "opt_ejercicios": star("SELECT DISTINCT nombre_ejercicio FROM de"),
    "opt_tipos": star("SELECT DISTINCT tipo_ejercicio FROM de WHERE tipo_ejercicio IS NOT NULL"),
    "date_range": star("""
SELECT min(fecha) AS fecha_inicio, max(fecha) AS fecha_fin, count(DISTINCT fecha) AS dias_unicos
FROM df"""),
    # Metrics.
    "kpis": star(_KPIS),
    "weekly_volume": star(f"""
SELECT semana, semana_anio, anio, CAST(sum(vol) AS DOUBLE) AS volumen, count(*) AS series
FROM wide WHERE {FILTER} AND ejercicio_id IS NOT NULL GROUP BY semana, semana_anio, anio"""),
    "weekly_volume_all": star("""
SELECT semana, semana_anio, anio, CAST(sum(vol) AS DOUBLE) AS volumen, count(*) AS series
FROM wide WHERE fecha IS NOT NULL AND ejercicio_id IS NOT NULL
GROUP BY semana, semana_anio, anio"""),
    "group_distribution": star("SELECT tipo_ejercicio, total_series, volumen FROM groups", _GROUPS),
    "exercise_progress": star("""
SELECT fecha, numero_serie, reps, CAST(kg AS DOUBLE) AS carga_kg, rir AS rir_rpe, mesociclo
FROM wide WHERE nombre_ejercicio = 'red widget' AND kg IS NOT NULL AND fecha IS NOT NULL"""),
    "best_set_by_session": star(
        "SELECT fecha, mesociclo, CAST(carga_kg AS DOUBLE) AS carga_kg, reps FROM best", _BEST),
    "personal_records": star("""
SELECT nombre_ejercicio AS "Ejercicio", tipo_ejercicio AS "Grupo", kg AS "Record (kg)",
       reps AS "Reps", fecha AS "Fecha" FROM records""", _RECORDS),
    "weekly_volume_by_group": star("SELECT * FROM wg", _WEEK_GROUPS),
    "mesocycle_volume": star("SELECT * FROM mg", _MESO_GROUPS),
    "intensity_by_session": star("""
SELECT fecha, mesociclo, avg(rir) AS avg_rir, min(rir) AS min_rir, count(*) AS series
FROM wide WHERE rir IS NOT NULL AND fecha IS NOT NULL GROUP BY fecha, mesociclo"""),
    "rir_by_microcycle": star("""
SELECT mesociclo || ' - Micro ' || CAST(numero_microciclo AS VARCHAR) AS micro_label, mesociclo,
       numero_microciclo, rir AS rir_rpe
FROM wide WHERE rir IS NOT NULL AND plan_id IS NOT NULL"""),
    "daily_frequency": star("SELECT * FROM freq", _FREQ),
    "group_volume": star("SELECT * FROM groups", _GROUPS),
    "group_sets_over_time": star(
        "SELECT semana, semana_anio, anio, tipo_ejercicio, series FROM wg", _WEEK_GROUPS),
    # Derived figures.
    "longest_streak": star("SELECT max(n) AS racha FROM lens", _FREQ + "," + _streak(
        "SELECT 1 AS rest, fecha FROM freq", "rest")),
    "longest_streak_n": star("SELECT rest AS dias_descanso, max(n) AS racha FROM lens GROUP BY rest",
                             _FREQ + "," + _streak(
        "SELECT CAST(range AS INTEGER) AS rest, fecha FROM freq, range(1, 6)", "rest")),
    "streak_by_user": "WITH " + _streak(
        "SELECT DISTINCT user_id, 1 AS rest, CAST(ts AS DATE) AS fecha FROM events", "user_id")
        + "\nSELECT CAST(user_id AS VARCHAR) AS athlete, max(n) AS racha FROM lens GROUP BY user_id",
    "days_per_month_full": star(
        "SELECT anio, mes, CAST(anio AS VARCHAR) || '-' || lpad(CAST(mes AS VARCHAR), 2, '0')"
        " AS mes_label, dias FROM full_months", _MONTHS),
    "days_per_month": star(
        "SELECT anio, mes, CAST(anio AS VARCHAR) || '-' || lpad(CAST(mes AS VARCHAR), 2, '0')"
        " AS mes_label, dias FROM months", _MONTHS),
    "best_worst_month": star("""
SELECT m[w.mes] || ' ' || CAST(w.anio AS VARCHAR) AS peor_mes, w.dias AS peor_dias,
       m[b.mes] || ' ' || CAST(b.anio AS VARCHAR) AS mejor_mes, b.dias AS mejor_dias
FROM (SELECT * FROM full_months ORDER BY dias, place LIMIT 1) w,
     (SELECT * FROM full_months ORDER BY dias DESC, place LIMIT 1) b,
     (SELECT ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto',
              'Septiembre', 'Octubre', 'Noviembre', 'Diciembre'] AS m)""", _MONTHS),
    "days_per_week_avg": star("""
SELECT (SELECT count(DISTINCT fecha) FROM freq) AS total_dias, avg(n) AS dias_por_semana
FROM (SELECT count(DISTINCT fecha) AS n FROM freq GROUP BY anio, semana_anio)""", _FREQ),
    "calendar_heatmap": star("""
SELECT CAST(d.orden AS INTEGER) AS orden, d.nombre AS nombre_dia_semana, w.semana AS week_label,
       CAST(coalesce(sum(f.series), 0) AS BIGINT) AS series
FROM (SELECT DISTINCT (dia_semana + 6) % 7 AS orden, nombre_dia_semana AS nombre FROM freq) d
CROSS JOIN (SELECT DISTINCT semana FROM wide WHERE fecha IS NOT NULL) w
LEFT JOIN freq f ON f.nombre_dia_semana = d.nombre
  AND CAST(f.anio AS VARCHAR) || '-S' || lpad(CAST(f.semana_anio AS VARCHAR), 2, '0') = w.semana
GROUP BY d.orden, d.nombre, w.semana""", _FREQ),
    "calendar_wide": star("""
SELECT CAST((dia_semana + 6) % 7 AS INTEGER) AS orden, nombre_dia_semana, """ + ", ".join(
        f"CAST(coalesce(sum(series) FILTER (CAST(anio AS VARCHAR) || '-S' || "
        f"lpad(CAST(semana_anio AS VARCHAR), 2, '0') = '{week}'), 0) AS BIGINT) AS \"{week}\""
        for week in ("1997-S01", "1997-S02", "1998-S30")) + """
FROM freq GROUP BY 1, 2""", _FREQ),
    "describe_fact": """
SELECT CAST(row_number() OVER () AS INTEGER) AS posicion, columna, tipo FROM (VALUES
  ('athlete', 'string'), ('serie_id', 'bigint'), ('sesion_id', 'bigint'), ('ejercicio_id', 'bigint'),
  ('fecha_id', 'bigint'), ('plan_id', 'bigint'), ('grupo_ejercicio', 'string'), ('numero_serie', 'int'),
  ('repeticiones_ejecutadas', 'int'), ('repeticiones_texto', 'string'), ('carga_kg', 'decimal(6,2)'),
  ('rir_rpe', 'int'), ('tipo_metrica', 'string'), ('dosis_prescrita', 'string'), ('notas', 'string'),
  ('fecha', 'date'), ('fecha_carga', 'timestamp'), ('mesociclo', 'string')) AS t(columna, tipo)""",
    "group_share_others": star("""
SELECT CASE WHEN pct < 0.02 THEN 'Otros' ELSE tipo_ejercicio END AS tipo_ejercicio,
       sum(volumen) AS volumen, sum(pct) AS pct
FROM (SELECT *, CASE WHEN sum(volumen) OVER () > 0 THEN volumen / sum(volumen) OVER ()
                     ELSE 0 END AS pct FROM groups) GROUP BY 1""", _GROUPS),
    "share_by_exercise": star("""
SELECT CASE WHEN pct < 0.02 THEN 'Otros' ELSE nombre_ejercicio END AS tipo_ejercicio,
       round(sum(volumen), 2) AS volumen, round(sum(pct), 9) AS pct
FROM (SELECT *, volumen / sum(volumen) OVER () AS pct
      FROM (SELECT nombre_ejercicio, CAST(sum(vol) AS DOUBLE) AS volumen FROM wide
            GROUP BY nombre_ejercicio)) GROUP BY 1""", _GROUPS),
    "load_trend": star("""
SELECT ejercicio_id, fecha, mesociclo, y AS carga_kg, x AS indice, round(a, 6) AS pendiente,
       round(b, 6) AS ordenada, round(b + a * x, 6) AS tendencia
FROM points JOIN fit USING (ejercicio_id)""", """
bests AS (SELECT ejercicio_id, fecha, mesociclo, CAST(max(kg) AS DOUBLE) AS y FROM wide
          WHERE ejercicio_id IS NOT NULL AND kg IS NOT NULL AND fecha IS NOT NULL
          GROUP BY ejercicio_id, fecha, mesociclo),
points AS (SELECT *, CAST(row_number() OVER (PARTITION BY ejercicio_id ORDER BY fecha, mesociclo)
                          - 1 AS INTEGER) AS x FROM bests),
fit AS (SELECT ejercicio_id, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM points
        GROUP BY ejercicio_id HAVING count(*) >= 3 AND count(y) >= 2)"""),
    "top_records": star("""
SELECT "Ejercicio", "Grupo", "Record (kg)", "Reps", "Fecha", puesto, 16 - puesto AS orden,
       printf('%.1f kg', "Record (kg)") AS etiqueta
FROM (SELECT nombre_ejercicio AS "Ejercicio", tipo_ejercicio AS "Grupo", kg AS "Record (kg)",
             reps AS "Reps", fecha AS "Fecha",
             row_number() OVER (ORDER BY kg DESC, nombre_ejercicio) AS puesto FROM records)
WHERE puesto <= 15""", _RECORDS),
    "rir_quartiles": star("""
SELECT mesociclo || ' - Micro ' || CAST(numero_microciclo AS VARCHAR) AS micro_label, mesociclo,
       min(rir) AS minimo, quantile_cont(rir, 0.25) AS q1, quantile_cont(rir, 0.5) AS mediana,
       quantile_cont(rir, 0.75) AS q3, max(rir) AS maximo, count(*) AS series
FROM wide WHERE rir IS NOT NULL AND plan_id IS NOT NULL GROUP BY mesociclo, numero_microciclo"""),
    "weekly_summary": star("""
SELECT semana, sum(volumen) AS volumen_total, CAST(sum(series) AS BIGINT) AS series_totales,
       CAST(coalesce(sum(total_reps), 0) AS BIGINT) AS reps_totales
FROM wg GROUP BY semana""", _WEEK_GROUPS),
    "mesocycle_summary": star("""
SELECT mesociclo, sum(volumen) AS volumen_total, CAST(sum(series) AS BIGINT) AS series_totales
FROM mg GROUP BY mesociclo""", _MESO_GROUPS),
    "label_map": star("""
SELECT tipo_ejercicio, total_series, coalesce(corto, tipo_ejercicio) AS label
FROM groups LEFT JOIN labels_of ON tipo = tipo_ejercicio""", _GROUPS + "," + _LABELS),
    "display_labels": star("""
SELECT fecha, mesociclo, 'Serie ' || CAST(numero_serie AS VARCHAR) AS serie_label,
       printf('%.1f kg', CAST(kg AS DOUBLE)) AS carga_label
FROM wide WHERE nombre_ejercicio = 'red widget' AND kg IS NOT NULL AND fecha IS NOT NULL"""),
    "kpi_labels": star(f"""
SELECT format('{{:,}}', total_series) AS total_series, CAST(ejercicios AS VARCHAR) AS ejercicios,
       CASE WHEN max_carga <> 0 THEN printf('%.1f kg', max_carga) ELSE '—' END AS max_carga,
       CAST(dias AS VARCHAR) AS dias FROM ({_KPIS})"""),
    "group_detail": star("""
SELECT coalesce(corto, tipo_ejercicio) AS "Grupo", total_series AS "Series",
       volumen AS "Volumen", ejercicios_distintos AS "Ejercicios",
       carga_promedio AS "Carga prom."
FROM groups LEFT JOIN labels_of ON tipo = tipo_ejercicio""", _GROUPS + "," + _LABELS),
    # Profiles.
    "profile_counts": star("""
SELECT (SELECT count(*) FROM de) AS total_ejercicios, (SELECT count(*) FROM df) AS total_fechas,
       (SELECT count(*) FROM dp) AS total_planes, (SELECT count(*) FROM fact) AS total_series"""),
    "first_exercises": star("""
SELECT ejercicio_id, nombre_ejercicio, tipo_ejercicio FROM de ORDER BY ejercicio_id LIMIT 10"""),
    "type_share": star("""
SELECT tipo_ejercicio, count(*) AS cantidad,
       round(count(*) * 100.0 / (SELECT count(*) FROM de), 1) AS porcentaje
FROM de GROUP BY tipo_ejercicio"""),
    "url_coverage": star("""
SELECT count(url_video) AS con_url, count(*) - count(url_video) AS sin_url, count(*) AS total
FROM de"""),
    "top_exercises": star("""
SELECT nombre_ejercicio, tipo_ejercicio, count(*) AS veces_realizado FROM wide
WHERE ejercicio_id IS NOT NULL GROUP BY nombre_ejercicio, tipo_ejercicio
ORDER BY veces_realizado DESC, nombre_ejercicio, tipo_ejercicio LIMIT 10"""),
    "dates_by_year": star("""
SELECT anio, count(*) AS dias, min(fecha) AS primera_fecha, max(fecha) AS ultima_fecha
FROM df GROUP BY anio"""),
    "dates_by_month": star("""
SELECT anio, mes, count(*) AS dias FROM df GROUP BY anio, mes
ORDER BY anio DESC, mes DESC LIMIT 12"""),
    "dates_by_weekday": star("""
SELECT nombre_dia_semana, count(*) AS cantidad,
       round(count(*) * 100.0 / (SELECT count(*) FROM df), 1) AS porcentaje
FROM df GROUP BY nombre_dia_semana"""),
    "first_plans": star("""
SELECT plan_id, mesociclo, numero_dia, nombre_dia, numero_microciclo FROM dp
ORDER BY mesociclo, numero_dia, numero_microciclo, plan_id LIMIT 10"""),
    "plans_by_meso": star("""
SELECT mesociclo, count(DISTINCT numero_dia) AS dias,
       count(DISTINCT numero_microciclo) AS microciclos, count(*) AS combinaciones
FROM dp GROUP BY mesociclo"""),
    "plans_by_day": star("""
SELECT numero_dia, count(DISTINCT mesociclo) AS en_mesociclos, count(*) AS total_combinaciones
FROM dp GROUP BY numero_dia"""),
    "first_sets": star("""
SELECT serie_id, nombre_ejercicio, numero_serie, reps AS repeticiones_ejecutadas,
       CAST(kg AS DOUBLE) AS carga_kg, rir AS rir_rpe FROM wide ORDER BY serie_id LIMIT 10"""),
    "fact_stats": star("""
SELECT count(*) AS total_series, count(DISTINCT sesion_id) AS sesiones_distintas,
       count(DISTINCT ejercicio_id) AS ejercicios_distintos, round(avg(reps), 1) AS promedio_reps,
       round(avg(CAST(kg AS DOUBLE)), 1) AS promedio_carga_kg, round(avg(rir), 1) AS promedio_rir
FROM fact"""),
    "block_stats": star("""
SELECT grupo_ejercicio, count(*) AS total_series,
       count(DISTINCT ejercicio_id) AS ejercicios_distintos,
       round(avg(CAST(kg AS DOUBLE)), 1) AS promedio_carga
FROM fact WHERE grupo_ejercicio IS NOT NULL GROUP BY grupo_ejercicio"""),
    "reps_distribution": star("""
SELECT reps AS repeticiones_ejecutadas, count(*) AS cantidad,
       round(count(*) * 100.0 / (SELECT count(reps) FROM fact), 1) AS porcentaje
FROM fact WHERE reps IS NOT NULL GROUP BY reps ORDER BY reps LIMIT 20"""),
    "rir_distribution": star("""
SELECT rir AS rir_rpe, count(*) AS cantidad,
       round(count(*) * 100.0 / (SELECT count(rir) FROM fact), 1) AS porcentaje
FROM fact WHERE rir IS NOT NULL GROUP BY rir"""),
    "quality_report": star("SELECT * FROM quality", _QUALITY),
    "quality_messages": star("""
SELECT * FROM (
  SELECT 1 AS orden, CAST(sin_fecha_id AS VARCHAR) || ' series sin fecha' AS mensaje
  FROM quality WHERE sin_fecha_id > 0
  UNION ALL SELECT 2, CAST(sin_plan_id AS VARCHAR) || ' series sin plan'
  FROM quality WHERE sin_plan_id > 0
  UNION ALL SELECT 3, printf('%.1f', pct_completo) || ' % de las series con todas las claves'
  FROM quality)""", _QUALITY),
    "key_report": star(f"""
{_repeats('ser', 'bronze_series.id', 'id')}
UNION ALL {_repeats('ses', 'bronze_sesiones.id', 'id')}
UNION ALL {_repeats('de', 'dim_ejercicios.ejercicio_id', 'ejercicio_id')}
UNION ALL {_repeats('df', 'dim_fecha.fecha', 'fecha')}
UNION ALL {_repeats('df', 'dim_fecha.fecha_id', 'fecha_id')}
UNION ALL {_repeats('dp', 'dim_plan.plan_id', 'plan_id')}
UNION ALL {_repeats('dp', 'dim_plan.sheet_dia_micro',
                    '(sheet_name, numero_dia, numero_microciclo)')}
UNION ALL {_repeats('fact', 'fact_series.serie_id', 'serie_id')}
UNION ALL {_orphans('ser', 'bronze_series.sesion_id', 'sesion_id', 'ses', 'id')}
UNION ALL {_orphans('fact', 'fact_series.ejercicio_id', 'ejercicio_id', 'de', 'ejercicio_id')}
UNION ALL {_orphans('fact', 'fact_series.fecha_id', 'fecha_id', 'df', 'fecha_id')}
UNION ALL {_orphans('fact', 'fact_series.plan_id', 'plan_id', 'dp', 'plan_id')}"""),
    "progression_like": star("""
SELECT fecha_id, fecha, nombre_ejercicio, numero_serie, reps AS repeticiones_ejecutadas,
       CAST(kg AS DOUBLE) AS carga_kg, rir AS rir_rpe
FROM wide WHERE nombre_ejercicio LIKE '%widget%' AND fecha_id IS NOT NULL
ORDER BY fecha, numero_serie, serie_id LIMIT 20"""),
    "sets_by_weekday": star("""
SELECT nombre_dia_semana, count(*) AS total_series, count(DISTINCT sesion_id) AS sesiones,
       round(avg(CAST(kg AS DOUBLE)), 1) AS promedio_carga
FROM wide WHERE fecha_id IS NOT NULL GROUP BY nombre_dia_semana"""),
    "bronze_stats": bronze("""
SELECT count(DISTINCT sesion_id) AS total_sesiones, count(*) AS total_series,
       count(DISTINCT nombre_ejercicio) AS ejercicios_unicos FROM ser"""),
    "sheet_summary": bronze("""
SELECT sheet_name, count(DISTINCT id) AS sesiones, count(DISTINCT numero_dia) AS dias,
       count(DISTINCT numero_microciclo) AS microciclos FROM ses GROUP BY sheet_name"""),
    "load_totals": bronze("""
SELECT count(DISTINCT s.id) AS total_sesiones, count(*) AS total_series,
       count(DISTINCT r.nombre_ejercicio) AS ejercicios_unicos,
       count(DISTINCT s.sheet_name) AS hojas_procesadas
FROM ses s LEFT JOIN ser r ON s.id = r.sesion_id"""),
    "bronze_sessions": bronze("SELECT * FROM ses"),
    "bronze_listing": bronze("""
SELECT id, sesion_id, numero_dia, numero_microciclo, nombre_ejercicio, numero_serie,
       repeticiones, carga_kg, rir_rpe FROM ser
ORDER BY numero_dia, numero_microciclo, id LIMIT 20"""),
    "bronze_links": bronze("SELECT url_ejercicio FROM ser"),
}
