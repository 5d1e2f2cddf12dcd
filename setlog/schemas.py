"""Explicit schemas of every table the package reads or writes.

Each table carries an ``athlete`` key so many workbooks live side by side; with
one athlete the contents are those of a single-athlete database.
"""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "score": T.DecimalType(3, 1), "load": T.DecimalType(6, 2),
}


def _schema(columns: str) -> T.StructType:
    """Schema from 'name type, ...' with the type names above."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CELLS = _schema(
    "workbook string, sheet_name string, sheet_pos int, row_idx int, col_idx int,"
    " value string, value_type string"
)

BRONZE_SESIONES = _schema(
    "athlete string, id bigint, sheet_name string, numero_dia int, nombre_dia string,"
    " microciclo string, numero_microciclo int, fecha timestamp_ntz, hora string,"
    " prs_pre_sesion score, rpe_sesion score, valoracion string,"
    " notas_sesion string, fecha_carga timestamp"
)

BRONZE_SERIES = _schema(
    "athlete string, id bigint, sesion_id bigint, sheet_name string, numero_dia int,"
    " microciclo string, numero_microciclo int, grupo_ejercicio string,"
    " tipo_ejercicio string, nombre_ejercicio string, url_ejercicio string,"
    " notas_ejercicio string, dosis string, numero_serie int, repeticiones string,"
    " carga_kg string, rir_rpe string, tipo_metrica string, fecha_carga timestamp"
)

DIM_EJERCICIOS = _schema(
    "athlete string, ejercicio_id bigint, nombre_ejercicio string, tipo_ejercicio string,"
    " url_video string, fecha_carga timestamp"
)

DIM_FECHA = _schema(
    "athlete string, fecha_id bigint, fecha date, anio int, mes int, dia int,"
    " dia_semana int, nombre_dia_semana string, semana_anio int, fecha_carga timestamp"
)

DIM_PLAN = _schema(
    "athlete string, plan_id bigint, sheet_name string, mesociclo string, numero_dia int,"
    " nombre_dia string, microciclo string, numero_microciclo int, fecha_carga timestamp"
)

# ``fecha`` and ``mesociclo`` repeat the values of the linked dimension rows so that
# date and mesocycle filters reach the scan without a join.
FACT_SERIES = _schema(
    "athlete string, serie_id bigint, sesion_id bigint, ejercicio_id bigint,"
    " fecha_id bigint, plan_id bigint, grupo_ejercicio string, numero_serie int,"
    " repeticiones_ejecutadas int, repeticiones_texto string, carga_kg load,"
    " rir_rpe int, tipo_metrica string, dosis_prescrita string, notas string,"
    " fecha date, fecha_carga timestamp, mesociclo string"
)

REJECTS = _schema("athlete string, sheet_name string, reason string, cells bigint")

BRONZE_TABLES = {"bronze_sesiones": BRONZE_SESIONES, "bronze_series": BRONZE_SERIES}
SILVER_TABLES = {
    "silver_dim_ejercicios": DIM_EJERCICIOS,
    "silver_dim_fecha": DIM_FECHA,
    "silver_dim_plan": DIM_PLAN,
    "silver_fact_series": FACT_SERIES,
}

LOADS = _schema("athlete string, workbook string")

# Per athlete the version and folder of the live rows, and the highest ids in use there.
ID_COLUMNS = {
    "bronze_sesiones": "id", "bronze_series": "id", "silver_dim_ejercicios": "ejercicio_id",
    "silver_dim_fecha": "fecha_id", "silver_dim_plan": "plan_id", "silver_fact_series": "serie_id",
}
# Links that every loaded row has.
LINK_COLUMNS = {"bronze_series": ["sesion_id"],
                "silver_fact_series": ["sesion_id", "ejercicio_id", "plan_id"]}
HOLDERS = _schema("athlete string, workbook string, held bigint, folder string, "
                  + ", ".join(f"top_{name} bigint" for name in ID_COLUMNS))
# Per sheet the version and folder of its bronze rows, and the highest ids there.
SHEET_HOLDERS = _schema("athlete string, sheet_name string, held bigint, folder string, "
                        "top_bronze_sesiones bigint, top_bronze_series bigint")
STREAM_TABLES = {**BRONZE_TABLES, **SILVER_TABLES, "rejects": REJECTS, "loads": LOADS}
