"""Dense surrogate keys without a single-task sort."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setlog.session import fresh_path, shuffles_freed

# monotonically_increasing_id: partition number above bit 33, row position below.
_POSITION_BITS = 33


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later passes see the same
    rows in the same partitions even if executors are lost, and lineage is cut."""
    path = fresh_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_dense_id(
    df: DataFrame, order: list[str | Column], id_col: str = "id", start: int = 0
) -> DataFrame:
    """Number rows start+1, start+2, ... in the given order, as a global row_number would.

    Rows are range-partitioned and sorted by ``order`` (which should be unique, so that
    no range boundary falls inside a run of equal keys), then numbered by partition
    offset plus position. Only the table of partition sizes, one row per partition,
    meets in one task.
    """
    placed = staged(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "dense-id",
    )
    part = F.shiftright("_place", _POSITION_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(id_col, F.col("_offset") + position + F.lit(start + 1))
        .drop("_part", "_place", "_offset")
    )


def rows_before(sizes: DataFrame, groups: list[str], counts: list[str]) -> DataFrame:
    """``sizes`` (one row per group) with each of ``counts`` replaced by what the groups before, in order, hold
    together. The table alone is written, and one row per partition meets in one task."""
    placed = staged(
        sizes.repartitionByRange(*groups).sortWithinPartitions(*groups)
        .withColumn("_place", F.monotonically_increasing_id()),
        "group-sizes",
    ).withColumn("_part", F.shiftright("_place", _POSITION_BITS))
    so_far = Window.rowsBetween(Window.unboundedPreceding, -1)

    def before(count: str, window: Window) -> Column:
        return F.coalesce(F.sum(count).over(window), F.lit(0))
    parts = placed.groupBy("_part").agg(*(F.sum(c).alias(c) for c in counts)).select(
        "_part", *(before(c, so_far.orderBy("_part")).alias(f"_offset_{c}") for c in counts))
    within = {c: before(c, so_far.partitionBy("_part").orderBy("_place")) for c in counts}
    return placed.withColumns(within).join(F.broadcast(parts), "_part").select(
        *groups, *((F.col(f"_offset_{c}") + F.col(c)).alias(c) for c in counts))


def with_group_ids(
    df: DataFrame, groups: list[str], order: list[str | Column], id_col: str = "id", keys: list[str] | None = None,
    sizes: DataFrame | None = None
) -> DataFrame:
    """Number rows 1, 2, ... by ``groups``, then ``order``, without writing them.

    Only a table of group sizes, one row each, is written and summed up; a row's id is what the groups before
    its own hold plus its place within the group. Ids don't depend on how rows are partitioned, so a
    task that runs again gives the same ones. Groups have to be of bounded size, ``keys`` (columns
    among ``groups`` that tell them apart; all, unless named) not null, ``order`` unique within a group, and
    ``df`` the same whenever it is worked; it is worked twice, for the sizes without its other columns, unless
    ``sizes`` gives them (the groups and ``_rows``, the rows of each).
    """
    keys = keys or groups
    if sizes is None:
        sizes = df.groupBy(*groups).agg(F.count("*").alias("_rows"))
    before = rows_before(sizes, groups, ["_rows"]).select(*keys, F.col("_rows").alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys, *(g for g in groups if g not in keys)).orderBy(*order))
    return df.join(before, keys).withColumn(id_col, F.col("_before") + place).drop("_before")


def append_with_ids(
    old: DataFrame, new: DataFrame, order: list[str | Column], id_col: str = "id"
) -> DataFrame:
    """Rows of ``old`` plus ``new`` numbered on from the highest id in use."""
    top = old.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    return old.unionByName(with_dense_id(new, order, id_col, top))
