"""Quality classifier: a sparse ensemble of rules.

Small boosted trees are grown over text statistics. Every path from the root to a node is a rule, a
conjunction of comparisons. A logistic regression with an L1 penalty weighs the rules and drops most
of them. What is left is compiled into a Spark column expression over the statistics, so that scoring
is part of the plan.

The trees and weights are fitted on the driver from at most :data:`SAMPLE_ROWS` labelled rows of a
dozen numbers each; every document is scored.

Defined results: a null text counts as empty; an empty text gets the score of its statistics (all 0);
without labelled rows, or with one label only, the score is the smoothed share of label 1; a label that
is null is no label; repeated rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import text_of, whole_rows
from sheetloom.llm.text_stats import RATIOS, bounded_sample, ratio, text_counts

#: Bound of the labelled rows that trees and weights are fitted on.
SAMPLE_ROWS = 12_000
TREES, DEPTH, CUTS, LEAST_LEAF = 24, 3, 24, 20
PENALTY, STEPS = 0.002, 1500

FEATURES = (*RATIOS, "n_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """Comparisons (feature, is it above, cut); true where all hold."""

    tests: tuple[tuple[str, bool, float], ...]

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return np.logical_and.reduce([(table[f] > cut) == above for f, above, cut in self.tests])

    def column(self, source: str = "") -> Column:
        def value(feature: str) -> Column:
            return ratio(feature, source) if feature in RATIOS else F.col(source + feature).cast("double")

        return reduce(Column.__and__, [value(f) > cut if above else value(f) <= cut for f, above, cut in self.tests])

    def __str__(self) -> str:
        return " and ".join(f"{f} {'>' if above else '<='} {cut:.6g}" for f, above, cut in self.tests)


@dataclass(frozen=True)
class Ensemble:
    """Fitted model: the log-odds without any rule, and the rules with their weights."""

    base: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, source: str = "") -> Column:
        """Probability of label 1 as a column over the counts."""
        total = reduce(
            Column.__add__, [F.when(r.column(source), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules], F.lit(self.base)
        )
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _grow(table: dict, codes: dict, cuts: dict, rows: np.ndarray, pull: np.ndarray, path: tuple, depth: int) -> list:
    """Split ``rows`` where the squared sum of gradients gains most; leaves as (path, rows)."""
    best = (1e-9, None, None)
    total, size = pull[rows].sum(), len(rows)
    if depth and size >= 2 * LEAST_LEAF:
        for feature, bins in codes.items():
            n = len(cuts[feature]) + 1
            sums = np.cumsum(np.bincount(bins[rows], pull[rows], n))[:-1]
            sizes = np.cumsum(np.bincount(bins[rows], minlength=n))[:-1]
            fit = (sizes >= LEAST_LEAF) & (size - sizes >= LEAST_LEAF)
            if fit.any():
                gain = np.where(
                    fit, sums**2 / np.maximum(sizes, 1) + (total - sums) ** 2 / np.maximum(size - sizes, 1), -np.inf
                ) - total**2 / size
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], feature, at)
    _, feature, at = best
    if feature is None:
        return [(path, rows)]
    below = codes[feature][rows] <= at
    cut = float(cuts[feature][at])
    leaves = _grow(table, codes, cuts, rows[below], pull, (*path, (feature, False, cut)), depth - 1)
    return leaves + _grow(table, codes, cuts, rows[~below], pull, (*path, (feature, True, cut)), depth - 1)


def _simplified(path: tuple) -> Rule:
    """Of several comparisons of one feature in one direction, the tightest."""
    held: dict[tuple[str, bool], float] = {}
    for feature, above, cut in path:
        known = held.get((feature, above))
        held[feature, above] = cut if known is None else (max if above else min)(known, cut)
    return Rule(tuple(sorted((f, a, c) for (f, a), c in held.items())))


def tree_rules(table: dict[str, np.ndarray], label: np.ndarray, seed: int = 1) -> list[Rule]:
    """Rules of boosted trees: every path from a root to a node below it, without repeats."""
    draw = np.random.default_rng(seed)
    cuts = {f: np.unique(np.quantile(v, np.arange(1, CUTS + 1) / (CUTS + 1))) for f, v in table.items()}
    cuts = {f: c for f, c in cuts.items() if len(c)}
    codes = {f: np.searchsorted(c, table[f], side="left") for f, c in cuts.items()}
    margin, rules = np.zeros(len(label)), {}
    for _ in range(TREES):
        pull = label - _sigmoid(margin)
        rows = np.sort(draw.permutation(len(label))[: max(2 * LEAST_LEAF, len(label) // 2)])
        features = draw.permutation(sorted(codes))[: max(1, (2 * len(codes) + 2) // 3)]
        for path, members in _grow(table, {f: codes[f] for f in features}, cuts, rows, pull, (), DEPTH):
            for length in range(1, len(path) + 1):
                rules.setdefault(_simplified(path[:length]))
            if path:
                margin[_simplified(path).holds(table)] += 2 * pull[members].mean()
    return list(rules)


def lasso_logistic(x: np.ndarray, label: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic regression, by accelerated proximal steps."""
    n, k = x.shape
    rate = 4 * n / max(np.linalg.norm(np.column_stack([np.ones(n), x]), 2) ** 2, 1e-9)
    weights = np.zeros(k + 1)
    weights[0] = np.log((label.sum() + 1) / (n - label.sum() + 1))
    ahead, t = weights.copy(), 1.0
    for _ in range(steps):
        slack = _sigmoid(ahead[0] + x @ ahead[1:]) - label
        step = ahead - rate * np.concatenate([[slack.mean()], x.T @ slack / n])
        step[1:] = np.sign(step[1:]) * np.maximum(np.abs(step[1:]) - rate * penalty, 0)
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = step + (t - 1) / t_next * (step - weights)
        weights, t = step, t_next
    return float(weights[0]), weights[1:]


def fit(table: dict[str, np.ndarray], label: np.ndarray) -> Ensemble:
    label = np.asarray(label, float)
    share = (label.sum() + 1) / (len(label) + 2)
    if len(label) < 2 * LEAST_LEAF or label.min() == label.max():
        return Ensemble(float(np.log(share / (1 - share))), ())
    rules = tree_rules(table, label)
    x = np.column_stack([r.holds(table) for r in rules]).astype(float) if rules else np.zeros((len(label), 0))
    base, weights = lasso_logistic(x, label)
    kept = [(r, float(w)) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-6]
    return Ensemble(base, tuple(kept))


def labelled_statistics(docs: DataFrame, labels: DataFrame, label: str, most: int, usable: Column | None = None):
    """Statistics and label of at most ``most`` labelled documents, as pandas. One row per document id.

    The ids are sampled before the join, so that only texts of sampled rows are looked at; their number
    is the bound of what is broadcast.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    chosen = F.broadcast(bounded_sample(known, F.col("doc_id"), most).withColumnRenamed("doc_id", "labelled_id"))
    rows = docs.select("doc_id", text_of().alias("text")).join(chosen, F.col("doc_id") == F.col("labelled_id"))
    counted = rows.select("doc_id", "label", text_counts(F.col("text")).alias("counts"))
    wanted = counted.select(
        "doc_id", "label", *[ratio(r, "counts.").alias(r) for r in RATIOS], *[F.col(f"counts.{c}") for c in FEATURES if c not in RATIOS]
    )
    once = wanted.groupBy("doc_id").agg(F.min(F.struct("label", *FEATURES)).alias("s")).select("s.*")
    return once.toPandas()


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, label: str = "quality", most: int = SAMPLE_ROWS) -> Ensemble:
    rows = labelled_statistics(docs, labels, label, most, usable)
    rows = rows.sort_values(list(rows.columns), ignore_index=True)
    return fit({f: rows[f].to_numpy(float) for f in FEATURES}, rows["label"].to_numpy(float))


def score(docs: DataFrame, model: Ensemble, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score``."""
    counted = whole_rows(docs, counts=text_counts(text_of(text_col)))
    kept = [c for c in docs.columns if c.lower() != "score"]
    return counted.select(*[F.col("row").getField(c).alias(c) for c in kept], model.score("counts.").alias("score"))
