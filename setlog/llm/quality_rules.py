"""Quality rules: an ordered decision list learned by sequential covering.

Labelled documents' figures are split in two. A rule grows by the threshold that gains most
(FOIL gain) on one part, then loses last conditions while that raises its worth on the
other; rules that stay precise there join the list and what they cover leaves. The list
becomes one Spark ``CASE`` expression.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setlog.llm.text import ratios, staged, stats_udf, unused, with_stats

#: Labelled rows that the rules are learned from, at most (chosen by a hash of the id).
FIT_ROWS = 20_000


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, of: dict[str, Column]) -> Column:
        value = of[self.feature]
        return value >= self.threshold if self.above else value < self.threshold

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.threshold if self.above else values < self.threshold


@dataclass(frozen=True)
class Rule:
    """Documents that meet all conditions are rejected."""
    conditions: tuple[Condition, ...]

    def covers(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        hit = np.ones(len(x), bool)
        for c in self.conditions:
            hit &= c.holds(x[:, names.index(c.feature)])
        return hit


def _best_condition(x, bad, names, cuts) -> Condition | None:
    p0, n0 = bad.sum(), (~bad).sum()
    base = np.log2(p0 / (p0 + n0))
    best, gain = None, 1e-9
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        value = x[order, j]
        ps, ns = np.cumsum(bad[order]), np.cumsum(~bad[order])
        last = np.searchsorted(value, cuts[j], side="left")  # rows below each cut
        below_p = np.where(last > 0, ps[last - 1], 0)
        below_n = np.where(last > 0, ns[last - 1], 0)
        for above, p, n in ((True, p0 - below_p, n0 - below_n), (False, below_p, below_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where(p > 0, p * (np.log2(p / np.maximum(p + n, 1)) - base), -1.0)
            k = int(np.argmax(g)) if len(g) else -1
            if k >= 0 and g[k] > gain:
                best, gain = Condition(name, above, float(cuts[j][k])), g[k]
    return best


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], max_rules: int = 12,
          max_conditions: int = 4, precision: float = 0.95, min_cover: int = 3,
          cuts_per_feature: int = 256) -> list[Rule]:
    """Ordered rules for ``bad`` rows; none without rows of both kinds."""
    rules: list[Rule] = []
    part = np.arange(len(x)) % 3
    while len(rules) < max_rules:
        grow, prune = part != 2, part == 2
        if not bad[grow].any() or bad.all():
            break
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, cuts_per_feature),
                                      method="nearest")) for j in range(x.shape[1])]
        conditions: list[Condition] = []
        inside = grow.copy()
        while len(conditions) < max_conditions and (~bad[inside]).any():
            found = _best_condition(x[inside], bad[inside], names, cuts)
            if found is None:
                break
            conditions.append(found)
            inside &= found.holds(x[:, names.index(found.feature)])

        def worth(cs, rows):
            hit = Rule(tuple(cs)).covers(x, names) & rows
            p, n = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - n) / (p + n) if p + n else -1.0, p, n

        def holds_up(cs):
            _, p, n = worth(cs, part >= 0)
            _, hp, hn = worth(cs, prune)
            return p >= min_cover and p >= precision * (p + n) and hp >= precision * (hp + hn)

        short = list(conditions)
        while len(short) > 1 and worth(short[:-1], prune)[0] >= worth(short, prune)[0]:
            short.pop()
        found = next((cs for cs in (short, conditions) if cs and holds_up(cs)), None)
        if found is None:
            break
        rules.append(Rule(tuple(found)))
        left = ~rules[-1].covers(x, names)
        x, bad, part = x[left], bad[left], part[left]
    return rules


def labelled(labels: DataFrame, limit: int) -> DataFrame:
    return labels.filter("quality in (0, 1) and doc_id is not null").select(
        "doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(limit)


def fit(stats: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> list[Rule]:
    """Rules from the figures of labelled documents.

    ``stats`` holds doc_id and the counts; ids with several labels count once per label, rows
    alike in id and figures once, null labels don't count. At most ``limit`` of them are taken. No labels: no rules, and everything is kept.
    """
    figures = ratios()
    rows = stats.join(labelled(labels, limit), "doc_id").select(
        "doc_id", "quality", *(c.alias(k) for k, c in figures.items())).distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id", "quality", *figures).limit(limit).toPandas()
    if rows.empty:
        return []
    rows = rows.sort_values(["doc_id", "quality", *figures], kind="stable")
    shuffled = rows.iloc[np.random.default_rng(7).permutation(len(rows))]
    names = list(figures)
    return learn(shuffled[names].to_numpy(float), shuffled["quality"].to_numpy() == 0, names)


def verdict(rules: list[Rule], figures: dict[str, Column]) -> Column:
    """True to keep: an ordered CASE, the first rule that holds decides."""
    case = None
    for rule in rules:
        hit = F.lit(True)
        for c in rule.conditions:
            hit = hit & c.column(figures)
        case = F.when(hit, False) if case is None else case.when(hit, False)
    return F.lit(True) if case is None else case.otherwise(True)


def base_failed(prefix: str = "") -> Column:
    n_words = F.col(f"{prefix}n_words")
    return (n_words < 10) | (100 * F.col(f"{prefix}n_repeat_words") > 20 * n_words)


def apply_rules(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """One row per document: its counts, the base rule's and the list's verdict.

    Null and empty texts have no words, so the base rule rejects them. Other columns of
    ``docs`` aren't looked at; repeated rows give repeated results; an empty table none.
    """
    stats = staged(with_stats(docs, doc_id=F.col("doc_id")), "rule-stats")
    rules = fit(stats, labels, limit)
    return stats.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & verdict(rules, ratios()))


def keep_good(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> DataFrame:
    """``docs`` without the rows that the rules reject; all columns stay."""
    sample = labelled(labels, limit)
    known = docs.select("doc_id", "text").join(
        F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    rules = fit(staged(with_stats(known, doc_id=F.col("doc_id")), "rule-stats"), labels, limit)
    name = unused(docs, "stats")
    at = f"{name}."
    return docs.withColumn(name, stats_udf()(F.col("text"))).filter(
        ~base_failed(at) & verdict(rules, ratios(at))).drop(name)
