"""Connected components of an edge table, by alternating stars, without collecting it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setlog.llm.text import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node point to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))).filter("a > b").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of all nodes of edges (a, b) with a label other than themselves; the label
    is the component's least node."""
    edges = edges.filter("a <> b").select("a", "b")
    before = None
    while True:
        edges = staged(_small_star(staged(_large_star(edges), f"{name}-large")), f"{name}-small")
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")),
                        F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        before = now
