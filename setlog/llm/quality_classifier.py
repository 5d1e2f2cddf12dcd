"""Quality classifier: random Fourier features of document figures, ridge, isotonic steps.

The features approximate a Gaussian kernel. Each partition sums its own normal equations,
which Spark adds up; the solution scores documents, and pooled adjacent violators over the
scores' histogram turn scores into probabilities.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlog.llm.text import id_remainder, ratios, staged, with_stats

FEATURES, WIDTH, RIDGE, BINS = 256, 1.5, 1.0, 2048


def split(doc_id: Column) -> Column:
    return id_remainder(doc_id, 3) == 1


@dataclass
class Model:
    names: list[str]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # figures x features
    phases: np.ndarray
    beta: np.ndarray
    edges: np.ndarray  # raw scores where the probability rises
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        wave = np.cos(z @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([wave, z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def probability(self, raw: np.ndarray) -> np.ndarray:
        """Isotonic levels joined by lines, so that different scores stay apart."""
        return np.clip(np.interp(raw, self.edges, self.levels), 0.0, 1.0)


def isotonic(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Pooled adjacent violators: the nearest nondecreasing values."""
    value, weight, size = [], [], []
    for a, b in zip(y, w, strict=True):
        value.append(float(a))
        weight.append(float(b))
        size.append(1)
        while len(value) > 1 and value[-2] >= value[-1]:
            total = weight[-2] + weight[-1]
            value[-2:] = [(value[-2] * weight[-2] + value[-1] * weight[-1]) / total]
            weight[-2:] = [total]
            size[-2:] = [size[-2] + size[-1]]
    return np.repeat(value, size)


def _matrix(batch, names: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])


def fit(rows: DataFrame, names: list[str], features: int = FEATURES) -> Model | None:
    """Model from rows of figures ``names`` and ``label`` 0/1; None without both labels.

    Only sums reach the driver: (features + figures)^2 numbers and ``BINS`` bins.
    """
    sums = rows.agg(F.sum("label").alias("p"), F.count("label").alias("n"), *(
        f(n).alias(f"{k}_{n}") for n in names for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    if not sums["n"] or sums["p"] in (0, sums["n"]):
        return None
    rng = np.random.default_rng(11)
    scale = np.array([sums[f"s_{n}"] or 1.0 for n in names])
    weights = rng.normal(size=(len(names), features)) / (WIDTH * np.sqrt(len(names) / 4))
    model = Model(names, np.array([sums[f"m_{n}"] for n in names]), np.maximum(scale, 1e-9),
                  weights, rng.uniform(0, 2 * np.pi, features), np.zeros(0), np.zeros(0),
                  np.zeros(0))
    share = sums["p"] / sums["n"]
    size = features + len(names) + 1
    columns = [*names, "label"]

    def normal_equations(batches):
        total = np.zeros((size, size + 1))
        for batch in batches:
            phi = model.features(_matrix(batch, names))
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            w = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
            total += (phi * w[:, None]).T @ np.column_stack([phi, y])
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(size), size + 1)),
                 pa.array(np.tile(np.arange(size + 1), size)), pa.array(total.ravel())],
                ["i", "j", "v"])
    summed = rows.select(*columns).mapInArrow(normal_equations, "i long, j long, v double").groupBy(
        "i", "j").agg(F.sum("v").alias("v")).toArrow()
    full = np.zeros((size, size + 1))
    full[summed.column("i").to_numpy(), summed.column("j").to_numpy()] = summed.column("v").to_numpy()
    model.beta = np.linalg.solve(full[:, :size] + RIDGE * np.eye(size), full[:, size])

    def binned(batches):
        for batch in batches:
            at = np.clip((model.raw(_matrix(batch, names)) + 0.5) / 2 * BINS, 0, BINS - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int64)), batch.column("label").cast(pa.int64())], ["b", "y"])
    bins = rows.select(*columns).mapInArrow(binned, "b long, y long").groupBy("b").agg(
        F.sum("y").alias("p"), F.count("y").alias("n")).toPandas().sort_values("b")
    middle = (bins["b"].to_numpy() + 0.5) / BINS * 2 - 0.5
    level = isotonic((bins["p"] / bins["n"]).to_numpy(), bins["n"].to_numpy())
    model.edges = np.concatenate([[middle[0] - 1], middle, [middle[-1] + 1]])
    model.levels = np.concatenate([[0.0], level, [1.0]])
    return model


def score(docs: DataFrame, labels: DataFrame, features: int = FEATURES) -> DataFrame:
    """doc_id, held_out, score and predicted for every row.

    Learned from non-null 0/1 labels of documents that aren't held out. Null and empty texts
    are scored by their counts of 0; without both labels every score is the labels' mean (0.5
    without labels). Other columns aren't looked at; repeated rows get repeated results.
    """
    figures = ratios()
    names = list(figures)
    stats = staged(with_stats(docs, doc_id=F.col("doc_id")).select(
        "doc_id", split(F.col("doc_id")).alias("held_out"),
        *(c.alias(n) for n, c in figures.items())), "classifier-stats")
    known = labels.filter("quality in (0, 1)").select(
        "doc_id", F.col("quality").cast("long").alias("label"))
    rows = staged(stats.filter("not held_out").join(known, "doc_id").select(*names, "label"),
                  "classifier-labelled")
    model = fit(rows, names, features)
    if model is None:
        mean = rows.agg(F.avg("label")).first()[0]
        constant = 0.5 if mean is None else float(mean)
        out = stats.select("doc_id", "held_out", F.lit(constant).alias("score"))
        return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

    def run(batches):
        for batch in batches:
            p = model.probability(model.raw(_matrix(batch, names)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p),
                 pa.array((p >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
    id_type = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, score double, predicted int")
