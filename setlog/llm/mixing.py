"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size is what each of its documents should be taken, whole copies
and a fraction. Fractions are settled in pairs: mass (words) moves from one document to the
other, at random and without bias, until one fraction is 0 or 1; what is left meets the next
document. Buckets of a source leave one open document each, which meet in the next level of the
tree, so a source's words miss its target by less than one document.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setlog.llm.text import columns, staged, unused

WEIGHTS = (5, 2, 1)
TOTAL, MOST = 1.5, 2  # of all words; times its size that a source or document may be taken
BUCKET = 4096  # documents settled together, about


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """source, source_size and target per source, from source and source_size.

    Sources in code point order, null last, weigh ``weights`` in turn. Filling by weight stops
    at ``most`` times a source's size: by cap over weight, the first source whose share of what
    the ones before leave is within its cap fixes the level of all that follow. One row per source meets in a
    task here.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    by_cap = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    rows = sizes.select("source", "source_size", weight.cast("double").alias("weight")).withColumn(
        "cap", F.col("source_size") * float(most)).withColumn("ratio", F.col("cap") / F.col("weight"))
    wanted = F.sum("source_size").over(Window.partitionBy()) * float(total)
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", (wanted - before) / rest)
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct(
        "ratio", "source", "level"))).over(Window.partitionBy()).getField("level")
    return rows.select("source", "source_size", F.when(
        level.isNull(), F.col("cap")).otherwise(F.least("cap", F.col("weight") * level)).alias("target"))


def settle(size: np.ndarray, part: np.ndarray, seed: int) -> np.ndarray:
    """``part`` rounded to 0 and 1 in turn, all but at most one; sum of size * part is kept."""
    out = part.astype(float)
    draw = np.random.default_rng(seed).random(len(part)).tolist()
    sizes, open_ = size.tolist(), -1
    for j, b in enumerate(out.tolist()):
        if not 0.0 < b < 1.0:
            continue
        if open_ < 0:
            open_, a = j, b
            continue
        s, t = sizes[open_], sizes[j]
        up, down = min((1 - a) * s, b * t), min(a * s, (1 - b) * t)
        if draw[j] * (up + down) < down:  # to the open document
            full, rest = up == (1 - a) * s, b - up / t
            first, second = (1.0, rest) if full else (a + up / s, 0.0)
        else:
            empty, rest = down == a * s, b + down / t
            first, second = (0.0, rest) if empty else (a - down / s, 1.0)
        first, second = (x if 1e-12 < x < 1 - 1e-12 else round(x) + 0.0 for x in (first, second))
        out[open_], out[j] = first, second
        if 0.0 < second < 1.0:
            open_, a = j, second
        elif 0.0 < first < 1.0:
            a = first
        else:
            open_ = -1
    return out


def _level(rows: DataFrame, level: int) -> DataFrame:
    """Fractions of each (source, bucket) settled, the order set by size, then by hash."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["mass", "h", "doc_id"], ascending=[False, True, True], kind="stable")
        seed = int(pdf["h"].iloc[0]) % (1 << 62) + level
        return pdf.assign(part=settle(pdf["mass"].to_numpy(float), pdf["part"].to_numpy(float), seed))
    return rows.groupBy("source", "bucket").applyInPandas(run, rows.schema)


def mix(docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: float = MOST,
        bucket: int = BUCKET) -> DataFrame:
    """doc_id, source, h, m, size, source_size, target and copies of each different document.

    Rows alike in id, source and text are one document with ``m`` rows, each taken ``copies``
    times; ``h`` is the text's hash. Null texts have size 0, as empty ones, and are taken 0
    times. Null sources are a source of their own. Other columns aren't looked at.
    """
    units = staged(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                               F.xxhash64("text").alias("h")).groupBy(
        "doc_id", "source", "size", "h").agg(F.count("*").alias("m")), "mix-units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"),
                                        F.count("*").alias("units"))
    wanted = targets(sizes.select("source", "source_size"), weights, total, most)
    wanted = staged(wanted.alias("w").join(
        sizes.alias("s"), F.col("w.source").eqNullSafe(F.col("s.source"))).select(
        F.col("w.source").alias("source_"), "w.source_size", "w.target", "s.units"), "mix-targets")
    share = F.when((F.col("size") > 0) & (F.col("source_size") > 0),
                   F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    whole = F.floor(F.col("share") + 1e-12)
    part = F.col("share") - F.col("whole")
    rows = units.join(wanted, F.col("source").eqNullSafe(F.col("source_"))).drop("source_").withColumn(
        "share", share).withColumn("whole", whole).withColumn(
        "part", F.when(part > 1e-12, part).otherwise(0.0)).withColumn(
        "mass", (F.col("size") * F.col("m")).cast("double")).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "h"), F.ceil(F.col("units") / bucket)).cast("long")
    ).drop("share", "units")
    levels, most_units = 1, wanted.agg(F.max("units")).first()[0] or 0
    while most_units > bucket:
        levels, most_units = levels + 1, -(-most_units // bucket)
    is_open = F.col("part").between(1e-12, 1 - 1e-12)
    done, rest = [rows.filter(~is_open)], rows.filter(is_open)
    for level in range(levels):
        settled = staged(_level(rest, level), "mix-level")
        done.append(settled.filter(~is_open))
        rest = settled.filter(is_open).withColumn("bucket", F.floor(F.col("bucket") / bucket))
    # One open document a source is left.
    draw = F.pmod(F.xxhash64("h", "doc_id", "source"), F.lit(1 << 30)) / float(1 << 30)
    done.append(rest.withColumn("part", F.when(draw < F.col("part"), 1.0).otherwise(0.0)))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "source", "h", "m", "size", "source_size", "target",
                      (F.col("whole") + F.round("part")).cast("long").alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: ``docs``' rows, each as often as it is taken, with ``copy`` from 1."""
    name, copy = unused(docs, "taken"), unused(docs, "copy")
    taken = mix(docs, **options).filter("copies > 0").select(
        F.struct("doc_id", "source", "h", "copies").alias(name))
    hits = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(f"{name}.doc_id"))
                     & F.col("source").eqNullSafe(F.col(f"{name}.source"))
                     & (F.xxhash64("text") == F.col(f"{name}.h")))
    return hits.select(*columns(docs), F.explode(F.sequence(
        F.lit(1).cast("long"), F.col(f"{name}.copies"))).alias(copy))
