"""Whitening of embeddings: integer sums, a covariance of centred vectors, its spectrum by slicing.

Each pass sums in the tasks and adds up per dimension or pair of dimensions on the executors; the driver gets
the sums and the covariance, bounded by the square of the dimensions, whatever the rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setlog.llm.spectrum import leading
from setlog.llm.text import staged

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
MOST = 1 << 40  # entries count as no further from 0 than this after scaling


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _integers(rows: DataFrame) -> DataFrame:
    """(vec_id, x) with the entries as integers."""
    def run(batches):
        for batch in batches:
            vectors = batch.column("vector")
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
            x = np.clip(np.floor(SCALE * flat), -MOST, MOST).astype(np.int64) + SHIFT
            offsets = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x))], ["vec_id", "x"])
    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, x array<long>")


def _sums(rows: DataFrame, column: str, kind: str) -> np.ndarray:
    """Sum of the array ``column`` by place; integers in whole."""
    def run(batches):
        total, exact = None, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(column), len(batch.column(column)[0]))
                total = x.sum(0) if total is None else total + x.sum(0)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(total)], ["place", "total"])
    total = "cast(total as decimal(38, 0))" if kind == "long" else "total"
    out = rows.select(column).mapInArrow(run, f"place long, total {kind}").groupBy("place").agg(
        F.sum(F.expr(total)).alias("total")).orderBy("place").collect()
    return [r.total for r in out]


def _products(rows: DataFrame, column: str, centre: np.ndarray, offset: np.ndarray, n: int) -> np.ndarray:
    """Covariance (divisor ``n``) of ``column``: entries less ``centre``, then less ``offset``, before they multiply."""
    dims = len(centre)

    def run(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            x = (_matrix(batch.column(column), dims) - centre) - offset
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims)), pa.ListArray.from_arrays(
                pa.array(np.arange(dims + 1) * dims, pa.int32()), pa.array(total.ravel()))], ["row", "entries"])
    parts = rows.select(column).mapInArrow(run, "row long, entries array<double>").select(
        "row", F.posexplode("entries").alias("col", "entry"))
    out = np.zeros((dims, dims))
    sums = parts.groupBy("row", "col").agg(F.sum("entry").alias("entry")).toArrow()
    out[sums.column("row").to_numpy(), sums.column("col").to_numpy()] = sums.column("entry").to_numpy()
    return out / n


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every row of
    (vec_id, embedding) and leading component.

    Rows whose vector is null or empty or holds a null or an entry that isn't finite take no part, nor do
    those whose length isn't the most common one (of equally common ones the greatest). Repeated rows
    count each, null ids stay null. Components whose variance is 0 to rounding are left out, so that one row, or
    vectors all alike, give no rows, as does an empty table. Entries beyond ``MOST`` / 64 count as that, and a
    deviation beyond 64 bits is null. Other columns aren't looked at.
    """
    spark = rows.sparkSession
    good = rows.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).filter(F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).select(
        "vec_id", F.col("embedding").alias("vector"))
    common = good.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.desc("dims")).first()
    id_type = rows.schema["vec_id"].dataType.simpleString()
    empty = (f"vec_id {id_type}, component int, n long, deviation long, whitened double, "
             "explained double, identity_error double")
    if common is None:
        return spark.createDataFrame([], empty)
    dims, n = common
    x = staged(_integers(good.filter(F.size("vector") == dims)), "integers")
    sums = [int(s) for s in _sums(x, "x", "long")]
    # The mean is an integer and a rest of at most a half, so that differences keep their digits.
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = np.array([(s - n * int(c)) / n for s, c in zip(sums, centre, strict=True)])
    covariance = _products(x, "x", centre, rest, n)
    values, vectors = leading(covariance, components)
    if not len(values):
        return spark.createDataFrame([], empty)
    explained = values / np.trace(covariance)
    weights = vectors / np.sqrt(values)
    off = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]  # n * (x - centre) - off is n * x - sum

    def project(batches):
        whole = np.array(off, object)
        for batch in batches:
            y = _matrix(batch.column("x"), dims) - centre
            if n * (np.abs(y).max(initial=0) + 1.0) < 2.0 ** 31 / dims ** 0.5:
                deviation = ((n * y - np.array(off, np.int64)) ** 2).sum(1).tolist()
            else:
                deviation = [int(v) for v in ((n * y.astype(object) - whole) ** 2).sum(1)]
            white = (y - rest) @ weights
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * white.shape[1], pa.int32()),
                                          pa.array(white.ravel()))], ["vec_id", "deviation", "whitened"])
    white = staged(x.mapInArrow(project, f"vec_id {id_type}, deviation long, whitened array<double>"), "whitened")
    mean = np.array(_sums(white, "whitened", "double")) / n
    error = np.abs(_products(white, "whitened", mean, np.zeros(len(mean)), n) - np.eye(len(mean))).max()
    shares = F.array(*(F.lit(float(e)) for e in explained))
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(int(n)).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("place")).alias("explained"), F.lit(float(error)).alias("identity_error"))
