"""Session and set extraction from sheet grids, for all sheets in one plan.

A sheet stacks training days downwards (a day label in column 0 opens a block) and lays
microcycles side by side (labels in one header row). Cells arrive one per row.

``sheet_index`` makes one small row per sheet from its marks alone: days with their label rows,
microcycles and exercises. Cells move once, to their sheet's index row, where row and column tell
what they are; a cell becomes a value of a set, an exercise or a session, and one aggregation puts
the values of each together. Nothing is gathered by grid row, and no cell meets another but those
of its own set, exercise or session.

Rules kept as they are in the source format: the day mark needs its accent; a scan starts
at a letter with blanks around it but accepts only a bare one; an exercise whose fourth
row is the block's last row is dropped; rows over sixty below the last day's start are cut;
the label search takes any text containing the label; error texts are blanked in session
data but stay as text in sets; day names are stripped, microcycle names are not. Of a cell given
twice the first text that fits, in text order, counts.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setlog.functions.casts import NUMBER_PATTERN, last_word_int, strip
from setlog.functions.fixed import (
    BLOCK_LETTERS, DAY_MARK, ERROR_MARK, LINK_MARK, METRIC_KIND, MICRO_MARK, MISSING_NAME,
    ROWS_PER_EXERCISE, SESSION_LABELS,
)
from setlog.functions.layout import LAYOUT, Layout
from setlog.operators.ids import staged

SHEET = ["workbook", "sheet_name"]
#: A sheet's columns behind a hash of them: rows are sorted by numbers, names are compared within a sheet only.
KEYED = ["sheet_key", *SHEET]
_DAY, _LETTER, _MICRO = 1, 2, 4
_LABELS = {label: 8 << i for i, label in enumerate(SESSION_LABELS)}
_ANY_LABEL = sum(_LABELS.values())
#: Number of a value's set, from 0 on; these are values of an exercise or its dose, and of a session.
_EXERCISE, _SESSION = -1, -2


def _between(column: str, first: int, end: int) -> Column:
    return (F.col(column) >= first) & (F.col(column) < end)


def _is_day() -> Column:
    return (F.col("col_idx") == 0) & F.upper("value").contains(DAY_MARK)


def _is_micro(layout: Layout) -> Column:
    return (F.col("row_idx") < layout.header_rows) & F.upper("value").contains(MICRO_MARK) & _between(
        "col_idx", layout.micro_first_col, layout.micro_end_col)


def _is_label(label: str, layout: Layout) -> Column:
    # Most texts are numbers shorter than a label, in bytes too; they need no upper case.
    return _between("col_idx", layout.label_first_col, layout.label_end_col) & (
        F.octet_length("value") >= len(label)) & F.upper("value").contains(label)


def sheet_key() -> Column:
    return F.xxhash64(*SHEET).alias("sheet_key")


_KINDS_OF_MARKS = {"day_marks": _DAY, "letter_marks": _LETTER, "micro_marks": _MICRO, "label_marks": _ANY_LABEL}


def _by_kind(wanted: int) -> list[Column]:
    """Aggregates: the sorted array of the marks of each wanted kind."""
    mark = F.struct("row_idx", "col_idx", "value", "bits")
    return [F.sort_array(F.collect_list(F.when(F.col("bits").bitwiseAND(bits) != 0, mark))).alias(name)
            for name, bits in _KINDS_OF_MARKS.items() if bits & wanted]


def _marks(cells: DataFrame, layout: Layout, wanted: int) -> DataFrame:
    """Per sheet with a wanted mark: sheet_pos, last_row and sorted arrays of marks, one for each kind.

    Marks alone are gathered; the last row comes from a plain aggregate.
    """
    tests = {_DAY: _is_day(), _LETTER: (F.col("col_idx") == 0) & F.col("value").isin(*BLOCK_LETTERS),
             _MICRO: _is_micro(layout), **{bit: _is_label(label, layout) for label, bit in _LABELS.items()}}
    bits = sum((F.when(test, bit).otherwise(0) for bit, test in tests.items() if bit & wanted), F.lit(0))
    sheets = cells.groupBy(sheet_key(), *SHEET).agg(
        F.min("sheet_pos").alias("sheet_pos"), F.max("row_idx").alias("last_row"))
    marks = cells.select(*SHEET, "row_idx", "col_idx", "value", bits.alias("bits")).filter("bits <> 0")
    return sheets.join(marks.groupBy(sheet_key(), *SHEET).agg(*_by_kind(wanted)), KEYED)


def _first_of(marks: str, by: str) -> Column:
    """The first mark of each ``by`` in a sorted array column."""
    return F.expr(f"filter({marks}, (m, i) -> i = 0 or {marks}[greatest(i - 1, 0)].{by} <> m.{by})")


def _with_days(index: DataFrame, layout: Layout) -> DataFrame:
    """Adds ``days``: start, end, name and number, from the top."""
    def day(mark: Column, i: Column) -> Column:
        start, name = mark["row_idx"], strip(mark["value"])
        return F.struct(
            start.alias("start"),
            F.coalesce(F.get("day_marks", i + 1)["row_idx"] - 1,
                       F.least(start + layout.last_day_rows, F.col("last_row"))).alias("end"),
            name.alias("name"), F.coalesce(last_word_int(name), i + 1).alias("number"))
    return index.withColumn("day_marks", _first_of("day_marks", "row_idx")).withColumn(
        "days", F.transform("day_marks", day))


def _with_micros(index: DataFrame) -> DataFrame:
    """Adds ``micros``: col, name and number, from the left, of the first row that has some."""
    return index.withColumn("micro_marks", F.expr(
        "filter(micro_marks, m -> m.row_idx = micro_marks[0].row_idx)")).withColumn(
        "micro_marks", _first_of("micro_marks", "col_idx")).withColumn("micros", F.transform(
            "micro_marks", lambda m, i: F.struct(
                m["col_idx"].alias("col"), m["value"].alias("name"),
                F.coalesce(last_word_int(m["value"]), i + 1).alias("number"))))


def _with_labels(index: DataFrame, layout: Layout) -> DataFrame:
    """Adds to each of ``days`` the first row of each session label (fecha, prs, rpe), if any."""
    def labelled(day: Column) -> Column:
        end = F.least(day["start"] + layout.label_rows, day["end"])

        def first_row(bit: int) -> Column:
            fits = F.filter("label_marks", lambda m: (m["bits"].bitwiseAND(bit) != 0) & (
                m["row_idx"] >= day["start"]) & (m["row_idx"] < end))
            return F.array_min(F.transform(fits, lambda m: m["row_idx"]))
        rows = [first_row(bit).alias(label.lower()) for label, bit in _LABELS.items()]
        return F.struct(*(day[c].alias(c) for c in ("start", "end", "name", "number")), *rows)
    return index.withColumn("days", F.transform("days", labelled))


def _opened(day: Column) -> Column:
    """First rows of the day's exercises: bare letters four or more rows below the last one taken. A letter given
    twice is one row."""
    letters = F.filter("letter_marks", lambda m: (m["row_idx"] >= day["start"]) & (m["row_idx"] < day["end"] - 3))
    return F.aggregate(letters, F.array().cast("array<int>"), lambda kept, m: F.when(
        (F.size(kept) == 0) | (m["row_idx"] >= F.try_element_at(kept, F.lit(-1)) + ROWS_PER_EXERCISE),
        F.concat(kept, F.array(m["row_idx"]))).otherwise(kept))


def sheet_index(cells: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """One small row per sheet with marks: sheet_pos, last_row, days (start, end, name, number, and the
    rows of the session labels), micros (col, name, number) and exercises (their first rows)."""
    index = _marks(cells, layout, _DAY | _LETTER | _MICRO | _ANY_LABEL)
    index = _with_labels(_with_micros(_with_days(index, layout)), layout)
    return index.select(*SHEET, "sheet_pos", "last_row", "days", "micros",
                        F.flatten(F.transform("days", _opened)).alias("exercises"))


def _at_index(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``rows`` beside their sheet's index row; rows move by sheet, and aren't sorted for it."""
    return rows.join(index.hint("shuffle_hash"), KEYED)


def _cells_at_index(cells: DataFrame, index: DataFrame) -> DataFrame:
    """Cells with a value beside their sheet's index row, which brings its KEYED columns.

    They move once, by sheet: those of a sheet and task as one row, without the sheet's names. They come out of it as
    plain columns, so that no filter pushed down to them works anything anew.
    """
    gathered = cells.filter(F.col("value").isNotNull()).groupBy(sheet_key(), *SHEET).agg(
        F.collect_list(F.struct("row_idx", "col_idx", "value")).alias("cells"))
    return _at_index(gathered, index).select(*index.columns, F.inline("cells"))


# By grid row the place of its day and the first row of its exercise, by column the last microcycle that
# starts there or before: a cell is looked up, not searched for. Bounded by the sheet, which the file format bounds.
_DAY_AT = ("flatten(transform(days, (d, i) -> concat(array_repeat(-1, if(i = 0, d.start, 0)), "
           "array_repeat(i, coalesce(get(days, i + 1).start, last_row + 1) - d.start))))")
_EXERCISE_AT = (f"flatten(transform(exercises, (r, i) -> concat(array_repeat(-1, r - "
                f"coalesce(get(exercises, i - 1) + {ROWS_PER_EXERCISE}, 0)), array_repeat(r, {ROWS_PER_EXERCISE}))))")


def _micro_at(layout: Layout) -> str:
    return ("flatten(transform(micros, (m, i) -> concat(array_repeat(-1, if(i = 0, m.col, 0)), "
            f"array_repeat(i, coalesce(get(micros, i + 1).col, {layout.last_col + 1}) - m.col))))")


# What a cell can be to a microcycle, as bits: a value of an exercise or set, and the four of a session.
_OWN, _DATE, _TIME, _PRS, _RPE = 1, 2, 4, 8, 16
_KINDS = [[bit for bit in (_OWN, _DATE, _TIME, _PRS, _RPE) if mask & bit] for mask in range(32)]


def _kinds(layout: Layout) -> str:
    """The kinds, as a sum of bits, of a cell ``away`` columns right of a microcycle; of microcycle -1 are an
    exercise's own type, name, notes and letter."""
    text = f"not contains(value, '{ERROR_MARK}')"
    number = f"away between 1 and {layout.number_offsets} and value rlike r'{NUMBER_PATTERN}' and {text}"
    own = (f"if(micro = -1, if(col_idx = 1, row_idx < exercise + 3, col_idx = 0 and row_idx = exercise), "
           f"row_idx >= exercise and if(row_idx = exercise, away = 0, away between 0 and {layout.sets - 1}))")
    session = " + ".join([
        f"if(row_idx = fecha and away = {layout.date_offset} and {text}, {_DATE}, 0)",
        f"if(row_idx = fecha and away = {layout.time_offset} and {text}, {_TIME}, 0)",
        f"if((row_idx = prs or row_idx = rpe) and {number}, if(row_idx = prs, {_PRS}, 0) + if(row_idx = rpe, {_RPE}, 0), 0)"])
    return f"if({own}, {_OWN}, 0) + if(row_idx in (fecha, prs, rpe), {session}, 0)"


def read_sheets(cells: DataFrame, index: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """The values of all sets (``number`` from 0) and sessions (``number`` -2): at, micro, number, four
    values v0 to v3, for sets the exercise's values and dose, and the columns of day and microcycle.

    Cells move once, by sheet. Rows of one exercise or session meet by sorting within their sheet; ``at`` is the
    first row of the exercise or, for session values, of the day.
    """
    by_place = index.select(sheet_key(), *SHEET, "days", "micros", F.expr(_DAY_AT).alias("day_at"), F.expr(
        _EXERCISE_AT).alias("exercise_at"), F.expr(_micro_at(layout)).alias("micro_at"))
    # Microcycles that reach the cell, as a rule one; and none, for an exercise's own values.
    reach = layout.last_col - layout.micro_end_col + 1
    reaching = F.expr("case when col_idx > 1 and last = before + 1 then array(last) else concat("
                      "if(col_idx <= 1, array(-1), array()), if(last > before, sequence(before + 1, last), array())) end")
    day = F.get("days", F.get("day_at", F.col("row_idx")))
    placed = _cells_at_index(cells.filter(F.col("col_idx") <= layout.last_col), by_place).select(
        *KEYED, "row_idx", "col_idx", "value", "micros", F.get("exercise_at", F.col("row_idx")).alias("exercise"),
        day.alias("day"), F.expr("get(micro_at, col_idx)").alias("last"),
        F.expr(f"coalesce(get(micro_at, col_idx - {reach + 1}), -1)").alias("before"),
    ).select(
        *KEYED, "row_idx", "col_idx", "value", "micros", F.when(F.col("exercise") >= 0, F.col("exercise")).alias("exercise"),
        F.col("day.start").alias("day_row"), *(F.col(f"day.{label.lower()}").alias(label.lower()) for label in SESSION_LABELS),
        reaching.alias("reaching"),
    ).filter("exercise >= 0 or row_idx in (fecha, prs, rpe)").select("*", F.explode("reaching").alias("micro")).select(
        *KEYED, "row_idx", "col_idx", "value", "micro", "exercise", "day_row", *(label.lower() for label in SESSION_LABELS),
        (F.col("col_idx") - F.get("micros", F.col("micro"))["col"]).alias("away"),
    ).withColumn("kinds", F.expr(_kinds(layout))).filter("kinds > 0")
    single = placed.select(*KEYED, "row_idx", "col_idx", "value", "micro", "exercise", "day_row", "away", F.explode(F.expr(
        "get(array(" + ", ".join(f"cast(array({', '.join(map(str, kinds))}) as array<int>)" for kinds in _KINDS) + "), kinds)"
    )).alias("kind")).select(
        *KEYED, F.expr(f"if(kind = {_OWN}, exercise, day_row)").alias("at"), "micro", F.expr(
            f"case when kind > {_OWN} then {_SESSION} when micro = -1 or row_idx = exercise then {_EXERCISE} else away end"
        ).alias("number"), F.expr(
            f"case kind when {_OWN} then if(micro = -1 and col_idx = 0, 3, row_idx - exercise) when {_DATE} then 0"
            f" when {_TIME} then 1 when {_PRS} then 2 else 3 end").alias("slot"),
        # Numbers carry how far right they stand, so that the least is the first.
        F.expr(f"if(kind >= {_PRS}, concat(lpad(away, 5, '0'), value), value)").alias("value"))
    together = single.groupBy(*KEYED, "at", "micro", "number").agg(*(
        F.min(F.when(F.col("slot") == k, F.col("value"))).alias(f"v{k}") for k in range(4)))
    exercise = Window.partitionBy(*KEYED, "at")
    block = Window.partitionBy(*KEYED, "at", "micro")
    own = {name: F.first(F.when(F.col("micro") == -1, F.col(f"v{k}")), ignorenulls=True).over(exercise)
           for k, name in enumerate(("kind", "full_name", "notes", "letter"))}
    dose = F.first(F.when((F.col("micro") >= 0) & (F.col("number") == _EXERCISE), F.col("v0")),
                   ignorenulls=True).over(block)
    whole = together.withColumns({**own, "dose": dose}).filter(
        (F.col("number") == _SESSION) | ((F.col("number") >= 0) & F.col("v1").isNotNull()))
    found = _at_index(whole, index.select(
        sheet_key(), *SHEET, "sheet_pos", "days", "micros", F.expr(_DAY_AT).alias("day_at")))
    day, micro = F.get("days", F.get("day_at", F.col("at"))), F.get("micros", F.col("micro"))
    return found.withColumns({
        "day_row": day["start"], "numero_dia": day["number"], "nombre_dia": day["name"],
        "micro_col": micro["col"], "microciclo": micro["name"], "numero_microciclo": micro["number"],
    }).drop("days", "micros", "day_at")


def sets_of(read: DataFrame, *more: str) -> DataFrame:
    """All sets with reps, each with its exercise and its day and microcycle, and ``more`` columns as they are."""
    sets = read.filter("number >= 0")
    full_name = F.coalesce("full_name", F.lit(MISSING_NAME))
    parts, linked = F.split(full_name, LINK_MARK), full_name.contains(LINK_MARK)
    return sets.select(
        *KEYED, "sheet_pos", "day_row", "numero_dia", "nombre_dia", F.col("at").alias("row_idx"),
        F.col("letter").alias("grupo_ejercicio"), F.col("kind").alias("tipo_ejercicio"),
        F.when(linked, strip(F.get(parts, F.lit(0)))).otherwise(full_name).alias("nombre_ejercicio"),
        F.when(linked, F.concat(F.lit(LINK_MARK), F.get(parts, F.lit(1)))).alias("url_ejercicio"),
        F.col("notes").alias("notas_ejercicio"), F.lit(METRIC_KIND).alias("tipo_metrica"),
        "micro_col", "microciclo", "numero_microciclo", F.col("dose").alias("dosis"),
        (F.col("number") + 1).alias("numero_serie"), F.col("v1").alias("repeticiones"),
        F.col("v2").alias("carga_kg"), F.col("v3").alias("rir_rpe"), *more)


def values_of(v: Callable[[int], Column]) -> list[Column]:
    """The values of a session, still texts, from its four texts."""
    return [v(0).alias("fecha"), v(1).alias("hora"), F.substring(v(2), 6, 1 << 30).alias("prs_pre_sesion"),
            F.substring(v(3), 6, 1 << 30).alias("rpe_sesion")]


def session_values(read: DataFrame) -> DataFrame:
    """Values of the sessions that have some, by day_row and micro_col; still texts."""
    return read.filter(F.col("number") == _SESSION).select(
        *KEYED, "day_row", "micro_col", *values_of(lambda k: F.col(f"v{k}")))


def detect_days(cells: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """Day blocks of every sheet: name, number, first and last row.

    Day labels alone are gathered.
    """
    days = _with_days(_marks(cells, layout, _DAY), layout)
    return days.select(*SHEET, F.explode("days").alias("day")).select(
        *SHEET, F.col("day.name").alias("nombre_dia"), F.col("day.number").alias("numero_dia"),
        F.col("day.start").alias("fila_inicio"), F.col("day.end").alias("fila_fin"))


def detect_microcycles(cells: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """Microcycles of every sheet: name, number and first column.

    Labels of the first rows only leave the scan, at most a few dozen per row.
    """
    labels = cells.filter(_is_micro(layout)).withColumn("bits", F.lit(_MICRO)).groupBy(
        sheet_key(), *SHEET).agg(*_by_kind(_MICRO))
    return _with_micros(labels).select(*SHEET, F.explode("micros").alias("m")).select(
        *SHEET, F.col("m.name").alias("microciclo"), F.col("m.number").alias("numero_microciclo"),
        F.col("m.col").alias("col_inicio"))


def label_rows(cells: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """First row of each session label in each day block; null where it is missing, blocks without
    any label left out."""
    days = _with_labels(_with_days(_marks(cells, layout, _DAY | _ANY_LABEL), layout), layout)
    rows = days.select(*SHEET, F.explode("days").alias("day")).select(
        *SHEET, F.col("day.number").alias("numero_dia"), F.col("day.start").alias("fila_inicio"),
        *(F.col(f"day.{label.lower()}").alias(f"fila_{label.lower()}") for label in SESSION_LABELS))
    return rows.filter(F.coalesce(*(f"fila_{label.lower()}" for label in SESSION_LABELS)).isNotNull())


def session_metadata(cells: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """Every day of a sheet under every microcycle, sets or not, values still texts."""
    index = staged(sheet_index(cells, layout), "sheet-index")
    every = index.select(sheet_key(), *SHEET, "sheet_pos", F.explode("days").alias("d"), "micros").select(
        *KEYED, "sheet_pos", "d", F.explode("micros").alias("m")).select(
        *KEYED, "sheet_pos", F.col("d.start").alias("day_row"), F.col("d.number").alias("numero_dia"),
        F.col("d.name").alias("nombre_dia"), F.col("m.col").alias("micro_col"), F.col("m.name").alias("microciclo"),
        F.col("m.number").alias("numero_microciclo"))
    return every.join(session_values(read_sheets(cells, index, layout)),
                      [*KEYED, "day_row", "micro_col"], "left").drop("sheet_key")


def extract_sets(cells: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """All sets with reps, each with its exercise."""
    index = staged(sheet_index(cells, layout), "sheet-index")
    return sets_of(read_sheets(cells, index, layout)).drop("sheet_key")


def grid_cuts(cells: DataFrame, layout: Layout = LAYOUT) -> DataFrame:
    """Cells that the layout's limits leave out, by address and reason (``motivo``).

    ``microciclo``: a microcycle label below the header rows or beside their columns; ``etiqueta``: a
    session label right of the label columns, or below the label rows of a day that has none
    of its kind above; ``fila``: anything below the last day's rows; ``ejercicio``: a letter whose four
    rows don't end before the day does; ``serie``: reps right of a microcycle's last set. A
    cell can be listed for more than one reason; sheets without marks have no layout to be cut by.
    """
    index = staged(sheet_index(cells, layout), "sheet-index").select(
        sheet_key(), *SHEET, "days", "micros", F.expr(_DAY_AT).alias("day_at"), F.expr(_EXERCISE_AT).alias("exercise_at"),
        F.expr(_micro_at(layout)).alias("micro_at"))
    text, row, col = F.upper("value"), F.col("row_idx"), F.col("col_idx")
    placed = _cells_at_index(cells, index).select(
        *SHEET, "row_idx", "col_idx", "value", "micros",
        F.get("days", F.get("day_at", row)).alias("day"), F.get("exercise_at", row).alias("exercise"),
        F.get("micros", F.get("micro_at", F.least(col, F.lit(layout.last_col)))).alias("micro"))
    day = F.col("day")
    below = row >= day["start"] + layout.label_rows
    missed = F.lit(False)
    for label in SESSION_LABELS:
        has = text.contains(label)
        missed = missed | (has & (col >= layout.label_end_col)) | (
            has & (col >= layout.label_first_col) & below & (row < day["end"]) & day[label.lower()].isNull())
    reasons = {
        "microciclo": text.contains(MICRO_MARK) & ~_is_micro(layout),
        "etiqueta": missed,
        "fila": row > day["end"],
        "ejercicio": (col == 0) & F.col("value").isin(*BLOCK_LETTERS) & (row >= day["end"] - 3) & (row <= day["end"]),
        "serie": (row == F.col("exercise") + 1) & (F.col("exercise") >= 0)
        & (col - F.col("micro")["col"] >= layout.sets),
    }
    return placed.select(*SHEET, "row_idx", "col_idx", "value", F.explode(F.array_compact(F.array(*(
        F.when(test, F.lit(name)) for name, test in reasons.items())))).alias("motivo"))
