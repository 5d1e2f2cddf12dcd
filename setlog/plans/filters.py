"""The global filter: mesocycles, exercises, muscle groups and a date range."""

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlog.plans.silver import Star

LOOKED_UP = 10  # ids given to a scan as values; of longer lists only the range reaches Parquet


def _all(conditions: list[Column]) -> Column | None:
    return reduce(lambda a, b: a & b, conditions) if conditions else None


@dataclass(frozen=True)
class Filters:
    """Empty fields don't restrict. ``every`` names attributes of which all values are
    chosen: that keeps any value but drops rows without one."""

    mesociclos: tuple[str, ...] = ()
    ejercicios: tuple[str, ...] = ()
    tipos: tuple[str, ...] = ()
    fecha_inicio: date | None = None
    fecha_fin: date | None = None
    every: frozenset[str] = frozenset()

    @classmethod
    def all(cls, star: Star) -> "Filters":
        """All mesocycles, all groups and the full date range chosen, as a fresh dashboard
        has it. An attribute with no values at all stays unrestricted."""
        offered = {
            "mesociclo": star.plans.filter(F.col("mesociclo").isNotNull()),
            "tipo_ejercicio": star.exercises.filter(F.col("tipo_ejercicio").isNotNull()),
            "fecha": star.dates,
        }
        return cls(every=frozenset(k for k, rows in offered.items() if not rows.isEmpty()))

    def on_fact(self) -> Column | None:
        """Condition on the fact's own columns; reaches the scan and prunes partitions."""
        conditions = []
        if self.mesociclos:
            conditions.append(F.col("mesociclo").isin(*self.mesociclos))
        if self.fecha_inicio:
            conditions.append(F.col("fecha") >= F.lit(self.fecha_inicio))
        if self.fecha_fin:
            conditions.append(F.col("fecha") <= F.lit(self.fecha_fin))
        for name in ("mesociclo", "fecha"):
            if name in self.every:
                conditions.append(F.col(name).isNotNull())
        return _all(conditions)

    def on_exercise(self) -> Column | None:
        """Condition on exercise attributes."""
        conditions = []
        if self.ejercicios:
            conditions.append(F.col("nombre_ejercicio").isin(*self.ejercicios))
        if self.tipos:
            conditions.append(F.col("tipo_ejercicio").isin(*self.tipos))
        if "tipo_ejercicio" in self.every:
            conditions.append(F.col("tipo_ejercicio").isNotNull())
        return _all(conditions)


def sets(star: Star, filters: Filters, *linked: str) -> DataFrame:
    """Fact rows passing the filter, linked to each named dimension.

    ``linked`` lists what an inner join to 'exercise', 'date' or 'plan' would demand. The
    dimension itself is joined only where an exercise attribute is tested; the other
    demands are tests for a link.
    """
    keys = {"exercise": "ejercicio_id", "date": "fecha_id", "plan": "plan_id"}
    rows = star.fact
    tests = [F.col(keys[name]).isNotNull() for name in linked]
    if filters.on_fact() is not None:
        tests.append(filters.on_fact())
    if tests:
        rows = rows.filter(_all(tests))
    if filters.on_exercise() is not None:
        chosen = star.exercises.filter(filters.on_exercise()).select("ejercicio_id")
        rows = rows.join(chosen, "ejercicio_id", "left_semi")
    return rows


def mesociclos(star: Star) -> DataFrame:
    return _options(star.plans, "mesociclo")


def ejercicios(star: Star) -> DataFrame:
    return _options(star.exercises, "nombre_ejercicio")


def tipos(star: Star) -> DataFrame:
    present = star.exercises.filter(F.col("tipo_ejercicio").isNotNull())
    return _options(present, "tipo_ejercicio")


def _options(dim: DataFrame, column: str) -> DataFrame:
    return dim.select("athlete", column).distinct().orderBy(
        "athlete", F.col(column).asc_nulls_last())


def date_range(star: Star) -> DataFrame:
    """First and last date and number of days, per athlete."""
    return star.dates.groupBy("athlete").agg(
        F.min("fecha").alias("fecha_inicio"),
        F.max("fecha").alias("fecha_fin"),
        F.countDistinct("fecha").alias("dias_unicos"),
    )


def exercise_lookup(star: Star, name: str) -> DataFrame:
    """The dimension row of one exercise."""
    return star.exercises.filter(F.col("nombre_ejercicio") == name)


def of_exercise(rows: DataFrame, star: Star, name: str, at_most: int = LOOKED_UP) -> DataFrame:
    """Fact rows of the exercise of that name, an id per athlete.

    Up to ``at_most`` ids are looked up first and meet the scan as values, so that row groups without them are
    passed over (by statistics, dictionary or bloom filter); where there are more, the rows are joined.
    """
    chosen = exercise_lookup(star, name).select("ejercicio_id")
    ids = [r["ejercicio_id"] for r in chosen.limit(at_most + 1).collect()]
    if len(ids) > at_most:
        return rows.join(chosen, "ejercicio_id", "left_semi")
    return rows.filter(F.col("ejercicio_id").isin(ids) if ids else F.lit(False))
