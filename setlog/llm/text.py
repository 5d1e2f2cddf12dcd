"""Words, counts and staging shared by the corpus operators.

Words are runs of other bytes than space and 0x09-0x0D, which is how ``bytes.split`` cuts;
``bytes.lower`` folds A-Z alone.
"""


import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setlog.session import fresh_path

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns(docs: DataFrame) -> list[Column]:
    """All columns of ``docs`` by name, whatever the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def small(batches, column: str = "text", most: int = 4_000_000):
    """The batches cut where their texts reach ``most`` bytes, or at one text, if longer."""
    for batch in batches:
        texts = batch.column(column)
        sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < len(sizes):
            held = sizes[begin - 1] if begin else 0
            end = max(int(np.searchsorted(sizes, held + most, side="right")), begin + 1)
            yield batch.slice(begin, end - begin)
            begin = end


def least_count(rows: DataFrame, column: str, most: int) -> int:
    """The lowest count such that no more than ``most`` rows have it or more (at least 1)."""
    kinds = rows.groupBy(column).agg(F.count("*").alias("rows")).toArrow()
    n, held = kinds.column(column).to_numpy(), kinds.column("rows").to_numpy()
    order = np.argsort(-n)
    fits = np.flatnonzero(np.cumsum(held[order]) <= most)
    if len(fits) == len(n):
        return 1
    return int(n[order][fits[-1]]) if len(fits) else int(n.max()) + 1 if len(n) else 1


def words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def folded_words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def repeated_window_words(ws: list[bytes]) -> int:
    """Words in ``WINDOW``-word windows that occur twice or more; memory follows the words."""
    n = len(ws)
    if n <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, n)
    if len(number) == n:
        return 0

    def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]

    two = joined(one[:-1], one[1:])
    four = joined(two[:-2], two[2:])
    five = joined(four[:-1], one[4:])
    at = np.flatnonzero(np.bincount(five)[five] > 1)
    if not len(at):
        return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


STAT_FIELDS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_distinct", "n_same_as_last", "n_upper", "n_letters", "n_digits", "n_marks", "n_stops",
)


def count_stats(text: str | None) -> tuple[int, ...]:
    """The counts of ``STAT_FIELDS`` over the whole text; all 0 for a null or empty one.

    ``n_lines`` counts lines with a word, ``n_same_as_last`` words equal to the one before,
    ``n_marks`` exclamation and question marks, ``n_stops`` words that end a sentence.
    """
    if not text:
        return (0,) * len(STAT_FIELDS)
    ws = words(text)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    raw = np.frombuffer(text.encode(), np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    lower = int(((raw >= 97) & (raw <= 122)).sum())
    return (
        len(ws), len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)),
        repeated_window_words(ws), len(lines), len(set(ws)),
        sum(map(bytes.__eq__, ws, ws[1:])), upper, upper + lower,
        int(((raw >= 48) & (raw <= 57)).sum()), text.count("!") + text.count("?"),
        sum(w.endswith((b".", b"!", b"?")) for w in ws),
    )


STAT_TYPE = ", ".join(f"{name} long" for name in STAT_FIELDS)


def with_stats(docs: DataFrame, **keep: Column) -> DataFrame:
    """``keep``'s columns and the counts of each row's text."""
    kept = list(keep)
    rows = docs.select(*(c.alias(k) for k, c in keep.items()), F.col("text").alias("text_"))
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema
                          if f.name != "text_"), STAT_TYPE])

    def run(batches):
        for batch in small(batches, "text_"):
            stats = [count_stats(x) for x in batch.column("text_").to_pylist()]
            columns = zip(*stats, strict=True) if stats else [()] * len(STAT_FIELDS)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept), *(pa.array(c, pa.int64()) for c in columns)],
                [*kept, *STAT_FIELDS])
    return rows.mapInArrow(run, schema)


def stats_udf():
    """The same counts as a column, for filters that keep the row."""
    fields = STAT_FIELDS

    @F.pandas_udf(STAT_TYPE)
    def stats(text):
        import pandas as pd
        return pd.DataFrame([count_stats(x) for x in text], columns=list(fields), dtype="int64")
    return stats


def ratios(prefix: str = "") -> dict[str, Column]:
    """Figures of a document from its counts, all finite."""
    n = {name: F.col(prefix + name) for name in STAT_FIELDS}

    def some(name: str) -> Column:
        return F.greatest(n[name], F.lit(1))
    return {
        "log_words": F.log1p(n["n_words"]),
        "word_length": n["word_chars"] / some("n_words"),
        "symbols": n["n_symbols"] / some("n_words"),
        "dup_lines": n["n_dup_lines"] / some("n_lines"),
        "repeats": n["n_repeat_words"] / some("n_words"),
        "distinct": n["n_distinct"] / some("n_words"),
        "same_as_last": n["n_same_as_last"] / some("n_words"),
        "upper": n["n_upper"] / some("n_letters"),
        "digits": n["n_digits"] / some("word_chars"),
        "marks": n["n_marks"] / some("n_words"),
        "stops": n["n_stops"] / some("n_words"),
        "words_per_line": F.log1p(n["n_words"] / some("n_lines")),
    }


def counted(rows: DataFrame, add, width: int, name: str) -> np.ndarray:
    """Sum over all partitions of the counters that ``add(batch, counters)`` raises.

    ``width`` bounds what a task holds and what reaches the driver; the partitions' counters
    travel packed, by slices, and are summed on the executors.
    """
    step = 1 << 16

    def packed(ks, parts):
        return pa.RecordBatch.from_arrays(
            [pa.array(ks, pa.int64()), pa.array([zlib.compress(x.tobytes(), 1) for x in parts],
                                                pa.binary())], ["k", "data"])

    def run(batches):
        counters = np.zeros(width, np.int64)
        for batch in batches:
            add(batch, counters)
        ks = [k for k in range(0, width, step) if counters[k:k + step].any()]
        if ks:
            yield packed(ks, [counters[k:k + step] for k in ks])

    def total(table: pa.Table) -> pa.Table:
        out = sum(np.frombuffer(zlib.decompress(x.as_py()), np.int64) for x in table.column("data"))
        return pa.Table.from_batches([packed([table.column("k")[0].as_py()], [out])])
    sums = staged(rows.mapInArrow(run, "k long, data binary").groupBy("k").applyInArrow(
        total, "k long, data binary"), name)
    out = np.zeros(width, np.int64)
    for k, data in sums.collect():
        part = np.frombuffer(zlib.decompress(data), np.int64)
        out[k:k + len(part)] = part
    return out
