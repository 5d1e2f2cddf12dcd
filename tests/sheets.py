"""Small literal sheets."""

from setlog.schemas import CELLS


def cells(spark, *grids, workbook="20240101Ana.xlsx"):
    """Cells of grids given as {(row, col): value}, named 'Meso 1', 'Meso 2', ..."""
    rows = []
    for i, grid in enumerate(grids, 1):
        for (row, col), value in grid.items():
            rows.append((workbook, f"Meso {i}", 4 + i, row, col, value, "str"))
    return spark.createDataFrame(rows, CELLS)


def day(start=0, label="DÍA 1", letter_rows=(10,), micro_col=7, reps="8", height=40, name="Press",
        first_number="7.5", fecha="2024-01-02 00:00:00"):
    """One day with one set per exercise, and a marker in its last row."""
    grid = {(start, 0): label, (start + 1, 1): "Fecha", (start + 2, 1): "prs", (start + 3, 1): "RPE",
            (start + height - 1, 1): "FIN", (start + 1, micro_col + 2): fecha,
            (start + 2, micro_col + 1): first_number, (start + 3, micro_col + 1): "9"}
    for i, row in enumerate(letter_rows):
        grid.update({(start + row, 0): "ABCDEF"[i], (start + row, 1): "Empuje",
                     (start + row + 1, 1): f"{name} {i}", (start + row + 1, micro_col): reps,
                     (start + row + 2, micro_col): "60.5", (start + row + 3, micro_col): "2"})
    return grid


def header(*labels, row=0, width=6):
    return {(row, 7 + width * i): label for i, label in enumerate(labels)}
