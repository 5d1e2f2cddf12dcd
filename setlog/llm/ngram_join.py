"""N-gram Jaccard join with signature trees.

A document is its set of hashed shingles. Documents with equal sets are one node. Two linked
nodes share a shingle among each one's rarest ones (as many as a linked partner may lack, and one), so
nodes that share none are never compared; nodes of like sizes that share one are a family. A family's nodes, sorted by size, become leaves of a tree whose inner nodes hold the union of
bitmaps and the range of sizes below; pairs of tree nodes are descended together and left where
sizes or the most overlap the bitmaps allow rule out a link. That is done twice: with bitmaps
alone, then, in the families that possible links form, with their whole sets, where remaining
pairs are compared exactly.

Large families are cut into blocks: first joined within blocks, then by some members of each
group found so far, and at last every node outside the family's largest group meets all blocks, so that no
link is lost and pairs already connected are skipped. Equal 64-bit hashes count as equal.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from setlog.llm.components import components
from setlog.llm.text import columns, counted, folded_words, small, staged, unused

SHINGLE, PERCENT = 5, 80
BLOCK, REPRESENTATIVES = 512, 8
SKETCH = 1 << 22  # counters that order shingles by rarity; the result doesn't depend on it
FILTER = 1 << 22  # cells that tell which nodes' sets are needed again
LEAF, FANOUT = 8, 8
BITS = 4096  # of a node's bitmap
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: list[str | None], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer than ``n`` words are one shingle."""
    number: dict[bytes, int] = {}
    ids = [np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, len(ws))
           for ws in map(folded_words, texts)]
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    out = []
    for x in ids:
        size = min(n, len(x))
        if not size:
            out.append(np.zeros(0, np.int64))
            continue
        w = hashes[x]
        h = np.full(len(x) - size + 1, size, np.uint64)
        for k in range(size):
            h = h * MULTIPLIER + w[k:len(x) - size + 1 + k]
        out.append(np.unique(_mixed(h).view(np.int64)))
    return out


def node_id(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def least_overlap(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


class Groups:
    """Union-find over positions."""

    def __init__(self, labels: np.ndarray):
        first: dict[int, int] = {}
        self.parent = [first.setdefault(int(x), k) for k, x in enumerate(labels)]

    def find(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = k = self.parent[self.parent[k]]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    row = np.zeros(BITS, bool)
    row[shingles & (BITS - 1)] = True
    return np.packbits(row, bitorder="little").view(np.uint64)


class SignatureTree:
    """Levels from leaves to the root: bitmaps, size ranges and the most shingles that share
    a bit with others of their set."""

    def __init__(self, rows: np.ndarray, size: np.ndarray):
        spare = size - np.bitwise_count(rows).sum(1)
        self.levels = [(rows, size, size, spare)]
        fan = LEAF
        while len(self.levels[-1][0]) > 1:
            rows, low, high, spare = self.levels[-1]
            cut = np.arange(0, len(rows), fan)
            self.levels.append((np.bitwise_or.reduceat(rows, cut), np.minimum.reduceat(low, cut),
                                np.maximum.reduceat(high, cut), np.maximum.reduceat(spare, cut)))
            fan = FANOUT

    def children(self, level: int, k: int) -> np.ndarray:
        fan = LEAF if level == 1 else FANOUT
        return np.arange(k * fan, min((k + 1) * fan, len(self.levels[level - 1][0])))


def possible(one, i: np.ndarray, two, j: np.ndarray, percent: int) -> np.ndarray:
    """Which of pairs (i of level ``one``, j of level ``two``) may hold a linked pair."""
    low = np.maximum(one[1][i][:, None], two[1][j][None, :])
    high = np.minimum(one[2][i][:, None], two[2][j][None, :])
    common = np.bitwise_count(one[0][i][:, None, :] & two[0][j][None, :, :]).sum(2)
    most = common + np.minimum(one[3][i][:, None], two[3][j][None, :])
    least = one[1][i][:, None] + two[1][j][None, :]
    return (100 * high >= percent * low) & ((100 + percent) * most >= percent * least)


def join_trees(left: SignatureTree, right: SignatureTree, groups: Groups, a: np.ndarray,
               b: np.ndarray, percent: int, sets: list[np.ndarray] | None) -> None:
    """Joins the groups of linked pairs between the trees' nodes, at positions ``a`` and ``b``
    of ``sets``; without sets, of pairs that may be linked. With one tree on both sides each
    pair is met once.
    """
    same = left is right
    stack = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while stack:
        p, i, q, j = stack.pop()
        if not p and not q:
            if groups.find(a[i]) != groups.find(b[j]) and (
                    sets is None or linked(sets[a[i]], sets[b[j]], percent)):
                groups.join(a[i], b[j])
            continue
        p_next, is_ = (p - 1, left.children(p, i)) if p >= q and p else (p, np.array([i]))
        q_next, js = (q - 1, right.children(q, j)) if q >= p and q else (q, np.array([j]))
        ok = possible(left.levels[p_next], is_, right.levels[q_next], js, percent)
        if same:
            ok &= is_[:, None] <= js[None, :] if p_next else is_[:, None] < js[None, :]
        for x, y in zip(*np.nonzero(ok), strict=True):
            stack.append((p_next, int(is_[x]), q_next, int(js[y])))


def join_block(nodes: np.ndarray, labels: np.ndarray, sides: np.ndarray, sizes: np.ndarray,
               maps: np.ndarray, sets: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """(node, other node of its group) of what links in a block: side 0 with side 1, or all
    with each other where all are on side 0."""
    order = np.lexsort((nodes, sizes))
    groups = Groups(labels)
    if len(nodes) <= LEAF and not sides.any():
        leaf = (maps, sizes, sizes, sizes - np.bitwise_count(maps).sum(1))
        at = np.arange(len(nodes))
        for i, j in zip(*np.nonzero(np.triu(possible(leaf, at, leaf, at, percent), 1)), strict=True):
            if groups.find(i) != groups.find(j) and (
                    sets is None or linked(sets[i], sets[j], percent)):
                groups.join(int(i), int(j))
        return [(int(nodes[k]), int(nodes[groups.find(k)])) for k in range(len(nodes))
                if groups.find(k) != k]
    first, second = order[sides[order] == 0], order[sides[order] == 1]
    left = SignatureTree(maps[first], sizes[first])
    right = SignatureTree(maps[second], sizes[second]) if len(second) else left
    join_trees(left, right, groups, first, second if len(second) else first, percent, sets)
    return [(int(nodes[k]), int(nodes[groups.find(k)])) for k in range(len(nodes))
            if groups.find(k) != k]


def _joined(rows: DataFrame, data: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Edges (a, b) from blocks (family, block, node, label, side) and the nodes' (node, size,
    data): whole sets if ``exact``, else bitmaps."""
    buckets = max(rows.count() // (2 * BLOCK), 1)

    def run(table: pa.Table) -> pa.Table:
        family, block, node, label, side, size = (table.column(c).to_numpy() for c in (
            "family", "block", "node", "label", "side", "size"))
        held = table.column("data")
        edges = []
        order = np.lexsort((node, block, family))
        new = np.r_[True, (family[order][1:] != family[order][:-1])
                    | (block[order][1:] != block[order][:-1])]
        for at in np.split(order, np.flatnonzero(new)[1:]):
            if len(at) < 2:
                continue
            raw = [held[int(k)].as_py() for k in at]
            sets = [np.frombuffer(x, np.int64) for x in raw] if exact else None
            maps = np.array([bitmap(x) for x in sets]) if exact else np.array(
                [np.frombuffer(x, np.uint64) for x in raw])
            edges += join_block(node[at], label[at], side[at], size[at], maps, sets, percent)
        a, b = zip(*edges, strict=True) if edges else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return staged(rows.join(data, "node").withColumn(
        "bucket", F.pmod(F.xxhash64("family", "block"), F.lit(buckets))).groupBy(
        "bucket").applyInArrow(run, "a long, b long"), "links")


def _labelled(family: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    labels = components(edges, name)
    return staged(family.select("family", "node", "members").join(labels, "node", "left").select(
        "family", "members", "node", F.coalesce("label", "node").alias("label")), name)


def _unsettled(labelled: DataFrame, block: int) -> DataFrame:
    """Nodes of families of several blocks with several groups, with the group's size."""
    groups = labelled.filter(F.col("members") > block).groupBy("family", "label").agg(
        F.count("*").alias("size_"))
    families = groups.groupBy("family").agg(
        F.count("*").alias("groups"), F.max(F.struct("size_", "label")).alias("top")).filter("groups > 1")
    open_ = groups.join(families, "family").select(
        "family", "label", "size_", F.col("top.label").alias("largest"))
    return staged(labelled.join(open_, ["family", "label"]), "unsettled")


def _block(column: str, members, block: int):
    return F.pmod(F.xxhash64(column), F.ceil(members / block)).cast("long")


def sized(labels: DataFrame) -> DataFrame:
    """(family, node, members) of the components (node, label), which leave out the label's
    own node."""
    every = labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
    sizes = every.groupBy("label").agg(F.count("*").alias("members"))
    return staged(every.join(sizes, "label").select(
        F.col("label").alias("family"), "node", "members"), "families")


def families(keys: DataFrame, percent: int) -> DataFrame:
    """(family, node, members) of nodes that share a key and may be alike in size, from (key,
    node, size); of families with the same nodes one is kept.

    A key's nodes fall into size classes as wide as a link allows, so that two linked nodes
    stand in one class or in neighbouring ones: each node joins its class and the next.
    """
    shared = keys.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter(
        "low < high").select("key")
    width = max(float(np.log(100 / percent) * (1 + 1e-6)), 1e-9)
    size_class = F.floor(F.log("size") / width)
    rows = staged(keys.join(shared, "key").select(
        F.explode(F.array(size_class, size_class + 1)).alias("class"), "key", "node").select(
        F.xxhash64("key", "class").alias("key"), "node").distinct(), "key-groups")
    groups = rows.groupBy("key").agg(
        F.count("*").alias("members"), F.min("node").alias("low"), F.max("node").alias("high"),
        F.sum(F.shiftright(F.xxhash64("node"), 24)).alias("one"),
        F.sum(F.hash("node").cast("long")).alias("two")).filter("members > 1")
    chosen = groups.groupBy("low", "high", "members", "one", "two").agg(F.min("key").alias("key"))
    return staged(rows.join(chosen.select("key", "members"), "key").select(
        F.col("key").alias("family"), "node", "members"), "families")


def linked_within(family: DataFrame, data: DataFrame, percent: int, block: int,
                  exact: bool) -> DataFrame:
    """(node, label) of the groups that links (or, by bitmaps alone, possible links) form within
    the families; every node has a label."""
    within = family.select("family", _block("node", F.col("members"), block).alias("block"), "node",
                           F.col("node").alias("label"), F.lit(0).alias("side"))
    edges = _joined(within, data, percent, exact)
    labels = _labelled(family, edges, "labels-blocks")
    unsettled = _unsettled(labels, block)
    if unsettled.count():
        some = unsettled.filter((F.col("node") == F.col("label")) | (F.pmod(
            F.xxhash64("node"), F.ceil(F.col("size_") / REPRESENTATIVES)) == 0))
        counts = some.groupBy("family").agg(F.count("*").alias("chosen"))
        chosen = some.join(counts, "family").select(
            "family", _block("label", F.col("chosen"), block).alias("block"), "node", "label",
            F.lit(0).alias("side"))
        edges = edges.unionByName(_joined(chosen, data, percent, exact)).unionByName(
            unsettled.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))
        labels = _labelled(family, edges, "labels-some")
        unsettled = _unsettled(labels, block)
    if unsettled.count():
        outside = unsettled.filter("label <> largest")
        outsiders = outside.groupBy("family").agg(F.count("*").alias("outside"))
        n_left = F.ceil(F.col("outside") / block)
        n_right = F.ceil(F.col("members") / block)
        left = outside.join(outsiders, "family").select(
            "family", "node", "label", F.lit(0).alias("side"),
            F.explode(F.transform(F.sequence(F.lit(0).cast("long"), n_right - 1),
                                  lambda k: _block("node", F.col("outside"), block) * n_right + k)).alias("block"))
        right = unsettled.join(outsiders, "family").select(
            "family", "node", "label", F.lit(1).alias("side"),
            F.explode(F.transform(F.sequence(F.lit(0).cast("long"), n_left - 1),
                                  lambda k: k * n_right + _block("node", F.col("members"), block))).alias("block"))
        edges = edges.unionByName(_joined(left.unionByName(right), data, percent, exact))
        labels = _labelled(family, edges, "labels-all")
    return labels.select("node", "label").distinct()


def groups_of(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT,
              block: int = BLOCK) -> DataFrame:
    """key (of id and text), doc_id, n_shingles and label of every row; the label is one
    node's of the row's component, null without shingles."""
    spark = docs.sparkSession
    rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def count(batch, counters):
        for part in small([batch]):
            for s in shingle_sets(part.column("text").to_pylist(), n):
                np.add.at(counters, s & (SKETCH - 1), 1)
    rarity = spark.sparkContext.broadcast(
        counted(rows.select("text"), count, SKETCH, "rarity").astype(np.float32))

    def prefixes(batches):
        often = rarity.value
        for batch in small(batches):
            sets = shingle_sets(batch.column("text").to_pylist(), n)
            nodes = [node_id(s) if len(s) else None for s in sets]
            rare = []
            for s in sets:
                keep = len(s) - least_overlap(len(s), percent) + 1 if len(s) else 0
                rare.append(s[np.lexsort((s, often[s & (SKETCH - 1)]))[:keep]])
            offsets = np.cumsum([0, *map(len, rare)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(
                     pa.array(offsets), pa.array(np.concatenate([*rare, np.zeros(0, np.int64)]))),
                 pa.array([bitmap(s).tobytes() for s in sets], pa.binary())],
                ["key", "doc_id", "n_shingles", "node", "rarest", "data"])
    table = staged(rows.mapInArrow(
        prefixes, f"key long, doc_id {id_type}, n_shingles long, node long, rarest array<long>, "
        "data binary"), "shingles")
    sharing = families(table.filter("node is not null").select(
        "node", F.col("n_shingles").alias("size"), F.explode("rarest").alias("key")), percent)
    maps = table.select("node", F.col("n_shingles").alias("size"), "data").join(
        sharing.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    family = sized(linked_within(sharing, staged(maps, "bitmaps"), percent, block, False).filter(
        "node <> label"))

    def mark(batch, counters):
        counters[batch.column("node").to_numpy() & (FILTER - 1)] = 1
    wanted = spark.sparkContext.broadcast(
        np.packbits(counted(family.select("node"), mark, FILTER, "wanted") > 0))

    def needed(batches):
        bits, sent = wanted.value, set()
        for batch in small(batches):
            out = []
            for s in shingle_sets(batch.column("text").to_pylist(), n):
                if len(s):
                    node = node_id(s)
                    cell = node & (FILTER - 1)
                    if bits[cell >> 3] >> (7 - (cell & 7)) & 1 and node not in sent:
                        sent.add(node)
                        out.append((node, s.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()),
                 pa.array([len(x[1]) // 8 for x in out], pa.int64()),
                 pa.array([x[1] for x in out], pa.binary())], ["node", "size", "data"])
    sets = staged(rows.select("text").mapInArrow(needed, "node long, size long, data binary").join(
        family.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
    labels = linked_within(family, sets, percent, block, True)
    return table.select("key", "doc_id", "n_shingles", "node").join(
        labels.select("node", "label"), "node", "left").select(
        "key", "doc_id", "n_shingles", F.coalesce("label", "node").alias("label"))


def join(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Null and empty texts have no shingles and are their own component. Rows with equal sets
    are linked; repeated rows too, as their texts are. A null id is passed over when the
    component's least id is chosen. An empty table gives an empty result; other columns
    aren't looked at.
    """
    named = groups_of(docs, n, percent, block)
    least = named.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    return named.join(least, "label", "left").select(
        "doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(
            F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT,
             block: int = BLOCK) -> DataFrame:
    """``docs`` with one row of each component, that with the least id (null last); rows
    without shingles all stay, and so do all columns."""
    named = staged(groups_of(docs, n, percent, block), "groups")
    chosen = named.filter("label is not null").groupBy("label").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "key")).getField("key").alias("key"))
    kept = chosen.select("key", F.lit(True).alias("one")).unionByName(named.filter(
        "label is null").select("key", F.lit(False).alias("one")).distinct())
    name, place = unused(docs, "kept"), unused(docs, "place")
    rows = docs.join(kept.select(F.struct("key", "one").alias(name)),
                     F.xxhash64("doc_id", "text") == F.col(f"{name}.key"))
    return rows.withColumn(place, F.row_number().over(Window.partitionBy(
        f"{name}.key").orderBy(f"{name}.one"))).filter(
        ~F.col(f"{name}.one") | (F.col(place) == 1)).select(*columns(docs))
