"""Hard-negative mining with exact scores, by the method of four Russians.

Components become integers, an integer's bits in two's complement become planes, and the bits
of eight dimensions in one plane become a byte. For a block of anchors and each group of eight
dimensions a table holds the sum of every subset of the anchors' eight components; a candidate's
bytes index it, and the looked-up sums of a plane are shifted and added: the inner product in
whole, without a multiplication per dimension.

Anchors are a stated query set and meet all rows: ``ANCHORS_AT_ONCE`` of them at a time are sent to
all tasks, which read the packed rows block by block and keep what they need of each. So no more
than that is ever broadcast or on the driver, however many anchors there are; each such pass
reads the packed rows (a byte per eight dimensions and bit) twice, and shuffles the best few of each task.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setlog.llm.text import staged
from setlog.operators.ids import with_dense_id

SCALE = 256
MOST = 1 << 25  # components count as no further from 0, so that sums over 4,096 dimensions fit
EVERY = 100  # vec_ids divisible by it are anchors
SHIFTED, LABELS = 7, 10  # every 7th label moves on, modulo 10
POSITIVES, NEGATIVES = 5, 5
LEAST_PERCENT = 80  # of the positive's score
ANCHORS_AT_ONCE = 8192
TABLE_ANCHORS, ROWS = 256, 2048  # anchors of a table, candidates scored together
NO_ID = np.iinfo(np.int64).max


def planes_of(values: np.ndarray, bits: int) -> np.ndarray:
    """(rows, groups * bits) bytes: for each group of eight dimensions its ``bits`` planes, lowest first."""
    n, dims = values.shape
    padded = np.zeros((n, -(-dims // 8) * 8), np.int64)
    padded[:, :dims] = values
    planes = (padded[:, :, None] >> np.arange(bits)) & 1
    packed = np.packbits(planes.reshape(n, -1, 8, bits).astype(np.uint8), axis=2, bitorder="little")
    return packed.reshape(n, -1)


def values_of(planes: np.ndarray, bits: int) -> np.ndarray:
    """The integers of packed planes; (rows, padded dimensions)."""
    n = len(planes)
    bit = np.unpackbits(planes.reshape(n, -1, 1, bits), axis=2, bitorder="little").astype(np.int64)
    worth = np.left_shift(1, np.arange(bits, dtype=np.int64))
    worth[-1] = -worth[-1]
    return (bit * worth).sum(3).reshape(n, -1)


def tables_of(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): the sum of the components whose bits each byte sets."""
    by_group = anchors.reshape(len(anchors), -1, 8).transpose(1, 2, 0)
    table = np.zeros((by_group.shape[0], 256, len(anchors)), np.int64)
    for k in range(8):
        table[:, 1 << k:2 << k] = table[:, :1 << k] + by_group[:, k, None]
    return table


def narrow(tables: np.ndarray, bits: int) -> np.ndarray:
    """The tables in 32 bits, if no shifted sum of their entries can leave them."""
    most = int(np.abs(tables).max(axis=(1, 2)).sum()) if tables.size else 0
    return tables.astype(np.int32) if most << bits < 1 << 31 else tables


def scores_of(tables: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """(rows, anchors) inner products."""
    bytes_ = planes.reshape(len(planes), -1, bits)
    out = np.zeros((len(planes), tables.shape[2]), tables.dtype)
    for plane in range(bits - 1, -1, -1):
        out <<= 1
        for group, table in enumerate(tables):
            found = table[bytes_[:, group, plane]]
            if plane == bits - 1:
                out -= found
            else:
                out += found
    return out


def _packed(rows: DataFrame, dims: int, bits: int) -> DataFrame:
    """uid, vec_id, label and planes of (vec_id, label, vector)."""
    def run(batches):
        uid = TaskContext.get().partitionId() << 36
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                vectors = part.column("vector")
                size = np.diff(vectors.offsets.to_numpy())
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
                x = np.zeros((len(size), dims), np.int64)
                owner = np.repeat(np.arange(len(size)), size)
                x[owner, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = np.clip(
                    np.floor(SCALE * flat), -MOST, MOST - 1).astype(np.int64)
                packed = planes_of(x, bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid + np.arange(len(size))), part.column("vec_id"), part.column("label"),
                     pa.array([p.tobytes() for p in packed], pa.binary())],
                    ["uid", "vec_id", "label", "planes"])
                uid += len(size)
    return rows.mapInArrow(run, "uid long, vec_id long, label long, planes binary")


def _read(batch, bits: int) -> tuple[np.ndarray, ...]:
    """uid, vec_id (``NO_ID`` for none), label and planes of packed rows."""
    ids = batch.column("vec_id").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
    planes = np.frombuffer(b"".join(batch.column("planes").to_pylist()), np.uint8)
    return (batch.column("uid").to_numpy(), ids, batch.column("label").to_numpy(),
            planes.reshape(batch.num_rows, -1))


def _first(score: np.ndarray, ids: np.ndarray, uid: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n``: higher scores, then smaller ids, then rows."""
    if len(score) > 4 * n:
        least = np.partition(score, len(score) - n)[len(score) - n]
        some = np.flatnonzero(score >= least)
        return some[np.lexsort((uid[some], ids[some], -score[some]))[:n]]
    return np.lexsort((uid, ids, -score))[:n]


def _blocks(batches, shared, wanted):
    """For each block of rows and anchors: the anchors' first place, and ``wanted``'s masks of (row, anchor)."""
    anchors = shared.value
    bits = anchors["bits"]
    made = [narrow(tables_of(values_of(anchors["planes"][k:k + TABLE_ANCHORS], bits)), bits)
            for k in range(0, len(anchors["uid"]), TABLE_ANCHORS)]
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            uid, ids, label, planes = _read(batch.slice(begin, ROWS), bits)
            for k, tables in enumerate(made):
                at = slice(k * TABLE_ANCHORS, (k + 1) * TABLE_ANCHORS)
                score = scores_of(tables, planes, bits)
                yield at, uid, ids, score, wanted(anchors, at, uid, label, score)


def _positives(batches, shared):
    """The first rows of each anchor's label, of this task's rows."""
    def other(anchors, at, uid, label, score):
        return (label[:, None] == anchors["label"][None, at]) & (uid[:, None] != anchors["uid"][None, at])
    best: dict[int, tuple[np.ndarray, ...]] = {}
    for at, uid, ids, score, mask in _blocks(batches, shared, other):
        for a in np.flatnonzero(mask.any(0)).tolist():
            rows = np.flatnonzero(mask[:, a])
            new = score[rows, a].astype(np.int64), ids[rows], uid[rows]
            old = best.get(at.start + a)
            all_ = [np.concatenate(x) for x in zip(old, new)] if old else new
            first = _first(*all_, POSITIVES)
            best[at.start + a] = tuple(x[first] for x in all_)
    yield from _found(best, shared.value["uid"])


def _found(best: dict, names: np.ndarray, most: int = 20_000):
    """The kept (score, id, uid) of each anchor as batches."""
    keys = list(best)
    for begin in range(0, len(keys), most):
        some = keys[begin:begin + most]
        parts = [best[k] for k in some]
        score, ids, uid = (np.concatenate(x) for x in zip(*parts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(names[some], [len(p[0]) for p in parts])), pa.array(score), pa.array(ids),
             pa.array(uid)], ["anchor", "score", "id", "uid"])


def _negatives(batches, shared):
    """The rows of other labels that are first under some positive of an anchor, of this task's rows."""
    def other(anchors, at, uid, label, score):
        return ((label[:, None] != anchors["label"][None, at]) & (score <= anchors["top"][None, at])
                & (100 * score.astype(np.int64) >= anchors["low"][None, at]))
    best: dict[int, tuple[np.ndarray, ...]] = {}
    for at, uid, ids, score, mask in _blocks(batches, shared, other):
        for a in np.flatnonzero(mask.any(0)).tolist():
            rows = np.flatnonzero(mask[:, a])
            new = score[rows, a].astype(np.int64), ids[rows], uid[rows]
            old = best.get(at.start + a)
            all_ = [np.concatenate(x) for x in zip(old, new)] if old else new
            order = np.lexsort((all_[2], all_[1], -all_[0]))
            falling = -all_[0][order]
            keep = np.zeros(len(order), bool)
            for p in shared.value["scores"][at.start + a]:
                begin = np.searchsorted(falling, -p)  # the first with no higher score
                end = np.searchsorted(100 * falling, -LEAST_PERCENT * p, side="right")
                keep[begin:min(end, begin + NEGATIVES)] = True
            best[at.start + a] = tuple(x[order[keep]] for x in all_)
    yield from _found(best, shared.value["uid"])


_FOUND = "anchor long, score long, id long, uid long"


def mine(rows: DataFrame, every: int = EVERY, at_once: int = ANCHORS_AT_ONCE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of (vec_id,
    embedding, label).

    Rows without label or vector, or with a component that is null or not finite, take no part.
    Shorter vectors count as ending in zeros; components beyond ``MOST`` / 256 as that. Rows of equal id
    are rows of their own: each may be anchor, positive or negative (ties by place). Rows without
    vec_id are no anchors, stand last among ties, and are given with a null id. A table without
    anchors gives no rows; other columns aren't looked at.
    """
    spark = rows.sparkSession
    label = F.col("label").cast("long")
    good = rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull()).filter(F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % SHIFTED == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        F.col("embedding").alias("vector"))
    dims, most = good.agg(F.max(F.size("vector")), F.max(F.aggregate(
        "vector", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double")))))).first()
    dims = max(dims or 0, 1)
    bits = int(min(np.floor(SCALE * (most or 0.0)) + 1, MOST)).bit_length() + 1
    packed = staged(_packed(good, dims, bits), "planes")
    anchors = staged(with_dense_id(packed.filter(F.col("vec_id") % every == 0), ["uid"], "number"), "anchors")
    last = anchors.agg(F.max("number")).first()[0] or 0
    results = [_mined(spark, packed, anchors.filter(F.col("number").between(begin + 1, begin + at_once)), bits)
               for begin in range(0, last, at_once)]
    if not results:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                     "positive_score long, negative_score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _mined(spark, packed: DataFrame, some: DataFrame, bits: int) -> DataFrame:
    """The result for the anchors ``some``, which the driver holds."""
    table = some.select("uid", "vec_id", "label", "planes").toArrow().combine_chunks()
    uid, ids, label, planes = _read(table.to_batches()[0], bits)
    order = np.argsort(uid)
    held = {"uid": uid[order], "label": label[order], "planes": planes[order], "bits": bits}
    shared = spark.sparkContext.broadcast(held)
    place = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "uid")
    near = staged(packed.mapInArrow(lambda batches: _positives(batches, shared), _FOUND).withColumn(
        "place", F.row_number().over(place)).filter(F.col("place") <= POSITIVES), "positives")
    # At most POSITIVES rows per anchor at hand.
    found = near.select("anchor", "score").toArrow()
    owner, score = np.searchsorted(held["uid"], found.column("anchor").to_numpy()), found.column("score").to_numpy()
    by_anchor: list[list[int]] = [[] for _ in held["uid"]]
    for a, p in zip(owner.tolist(), score.tolist(), strict=True):
        by_anchor[a].append(p)
    none = np.iinfo(np.int32).min
    limits = held | {
        "scores": [sorted(set(ps)) for ps in by_anchor],
        "top": np.array([max(ps, default=none) for ps in by_anchor], np.int64),
        "low": np.array([LEAST_PERCENT * min(ps, default=0) for ps in by_anchor], np.int64)}
    bounded = spark.sparkContext.broadcast(limits)
    far = packed.mapInArrow(lambda batches: _negatives(batches, bounded), _FOUND)
    pairs = far.join(near.select("anchor", F.col("score").alias("positive_score"), F.col("id").alias("positive"),
                                 F.col("uid").alias("positive_uid")), "anchor").filter(
        (LEAST_PERCENT * F.col("positive_score") <= 100 * F.col("score")) & (F.col("score") <= F.col("positive_score")))
    place = Window.partitionBy("anchor", "positive_uid").orderBy(F.desc("score"), "id", "uid")
    names = some.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))

    def named(column: str):
        return F.when(F.col(column) != int(NO_ID), F.col(column))
    return pairs.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= NEGATIVES).join(
        names, "anchor").select(
        "anchor_id", named("positive").alias("positive_id"), "rank", named("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
