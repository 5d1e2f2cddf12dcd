"""Labels, layout limits and word lists that results depend on."""

# Sheet layout.
SHEET_MARK = "Meso"
FIRST_MESO_POSITION = 5
DAY_MARK = "DÍA"
MICRO_MARK = "MICROCICLO"
BLOCK_LETTERS = ("A", "B", "C", "D", "E", "F")
SESSION_LABELS = ("FECHA", "PRS", "RPE")
HEADER_ROWS = 35
MICRO_FIRST_COL, MICRO_END_COL = 7, 100
LABEL_FIRST_COL, LABEL_END_COL = 1, 50
LABEL_ROWS = 15
LAST_DAY_ROWS = 60
ROWS_PER_EXERCISE = 4
SETS_PER_EXERCISE = 5
DATE_OFFSET, TIME_OFFSET, NUMBER_OFFSETS = 2, 4, 5
MISSING_NAME = "nan"
METRIC_KIND = "RIR"
LINK_MARK = "http"
ERROR_MARK = "#"

# Texts a spreadsheet reader takes as an empty cell.
EMPTY_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

WEEKDAYS_FROM_SUNDAY = (
    "Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado",
)
MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
    "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
MUSCLE_LABELS = {
    "Tracción": "Tracción",
    "Empuje": "Empuje",
    "DomCaderaxIsquiosxGlúteos": "Cadera/Glúteos",
    "DomRodillaxCuádriceps": "Cuádriceps",
    "CORE": "Core",
    "Tríceps": "Tríceps",
    "Biceps": "Bíceps",
    "DeltoideMedio": "Deltoides",
    "Abs": "Abdominales",
    "GemelosxSóleo": "Gemelos",
}
OTHERS = "Otros"
OTHERS_SHARE = 0.02
NO_VALUE = "—"
TOP_RECORDS = 15
