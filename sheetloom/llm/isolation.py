"""Quality rules: isolation forests on rule statistics.

A tree cuts a small sample at random features and random values until every row is alone. A document
that a few cuts set apart from the sample is anomalous: its mean path is short. Cuts are also drawn beyond the sample's
range, so that a value further out than any in the sample is set apart as well. Forests learn from
statistics alone; labelled rows only place their thresholds. There is one forest for the statistics that stay
put within clean prose, and one for each share that is 0 in most texts: it would be drowned by the others in a common
one, or set its few clean texts apart. A document is anomalous if one forest says so.

Forests are grown from at most :data:`SAMPLE_ROWS` documents. Every labelled document is scored, and thresholds are placed
on how many good and bad ones there are by score, in :data:`SCORE_BINS` bins; every document is judged.

Defined results: a null text is empty and fails the word-count rule; repeated rows are judged alike; without
labelled rows of both kinds a threshold is the textbook score 0.6; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import text_of, whole_rows
from sheetloom.llm.text_stats import COUNTS, STRUCT, bounded_sample, counts, ratio, shares, text_counts

SAMPLE_ROWS = 8192
#: Bins of equal width that scores, 0 to 1, are counted in.
SCORE_BINS = 1 << 14
TREES, TREE_ROWS = 100, 256
#: How far beyond the range of its rows a node may cut, in spans of that range.
BEYOND = 1.0
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Share of the labelled good documents that all thresholds together must keep.
KEEP_SHARE = 0.995
TEXTBOOK_SCORE = 0.6

#: Statistics by forest: those that stay put within clean prose together, zero-heavy ones each by itself.
GROUPS = (
    ("symbol_share", "mark_share", "mean_word"),
    ("dup_line_share",), ("repeat_share",), ("again_share",), ("upper_share",), ("digit_share",),
)
STATISTICS = tuple(s for group in GROUPS for s in group)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed(source: str = "") -> Column:
    words, repeated = F.col(f"{source}n_words"), F.col(f"{source}n_repeat_words")
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)


def _expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path of an unsuccessful search in a binary tree of ``n`` rows."""
    n = np.asarray(n, float)
    held = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(held - 1) + np.euler_gamma) - 2 * (held - 1) / held, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1 in a leaf), cut, left child (the right one is next to it), path length."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    path: np.ndarray
    depth: int
    rows: int

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """Score of each row, 0 to 1: 2 to the power of minus the mean path over the expected one."""
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for tree in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                feature = self.feature[tree][node]
                inner = feature >= 0
                right = x[every, np.maximum(feature, 0)] >= self.cut[tree][node]
                node = np.where(inner, self.left[tree][node] + right, node)
            total += self.path[tree][node]
        return 2.0 ** (-total / len(self.feature) / max(float(_expected_path(self.rows)), 1e-9))


def grow(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 5) -> Forest:
    """A forest of ``trees`` trees over ``rows`` random rows each. Values of a cut's feature must differ; a side without rows is a leaf."""
    draw = np.random.default_rng(seed)
    rows = min(rows, len(x))
    limit = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    size = 2 ** (limit + 2)
    feature = np.full((trees, size), -1, np.int64)
    cut, left, path = np.zeros((trees, size)), np.zeros((trees, size), np.int64), np.zeros((trees, size))
    for tree in range(trees):
        waiting, used = [(0, draw.permutation(len(x))[:rows], 0)], 1
        while waiting:
            node, members, depth = waiting.pop()
            low, high = (x[members].min(0), x[members].max(0)) if len(members) else (np.zeros(0), np.zeros(0))
            open_features = np.flatnonzero(high > low)
            if depth == limit or len(members) < 2 or not len(open_features):
                path[tree, node] = depth + _expected_path(len(members))
                continue
            chosen = int(draw.choice(open_features))
            span = BEYOND * (high[chosen] - low[chosen])
            at = draw.uniform(low[chosen] - span, high[chosen] + span)
            feature[tree, node], cut[tree, node], left[tree, node] = chosen, at, used
            above = x[members, chosen] >= at
            waiting += [(used, members[~above], depth + 1), (used + 1, members[above], depth + 1)]
            used += 2
    return Forest(feature, cut, left, path, limit, rows)


@dataclass(frozen=True)
class Forests:
    """A forest and its threshold for each of :data:`GROUPS`."""

    forests: tuple[Forest, ...]
    most: tuple[float, ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """A column of scores for each forest; ``x`` has a column for each of :data:`STATISTICS`."""
        ends = np.cumsum([len(group) for group in GROUPS])
        return np.column_stack([f.anomaly(part) for f, part in zip(self.forests, np.split(x, ends[:-1], axis=1), strict=True)])

    def anomaly(self, x: np.ndarray) -> np.ndarray:
        """The largest score in terms of its threshold: above 1 where a forest sets the row apart."""
        return (self.scores(x) / np.array(self.most)).max(axis=1)


def plant(x: np.ndarray) -> tuple[Forest, ...]:
    """A forest for each of :data:`GROUPS`."""
    ends = np.cumsum([len(group) for group in GROUPS])
    return tuple(grow(part) for part in np.split(x, ends[:-1], axis=1))


def threshold(scores: np.ndarray, good: np.ndarray, keep: float = KEEP_SHARE) -> float:
    """Scores above it are anomalous: of the cuts that keep enough good rows, the one that tells most apart."""
    values, which = np.unique(scores, return_inverse=True)
    return counted_threshold(values, *(np.bincount(which[kind], minlength=len(values)) for kind in (good, ~good)), keep)


def counted_threshold(values: np.ndarray, good: np.ndarray, bad: np.ndarray, keep: float = KEEP_SHARE) -> float:
    """:func:`threshold` from ascending scores and how many good and bad rows have each."""
    if not good.sum() or not bad.sum():
        return TEXTBOOK_SCORE
    kept, missed = np.cumsum(good) / good.sum(), np.cumsum(bad) / bad.sum()
    open_ = np.flatnonzero((kept >= keep) & (good + bad > 0))
    told = (kept - missed)[open_]
    return float(values[open_[len(open_) - 1 - int(np.argmax(told[::-1]))]])  # of equally good cuts the highest: it keeps more


def _statistics(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(*extra, text_counts(F.col("text")).alias("counts")).select(
        *extra, base_failed("counts.").alias("failed"), *[ratio(s, "counts.").alias(s) for s in STATISTICS]
    )


def _once(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per document id, of those that pass the base rules."""
    once = _statistics(rows, *keys).groupBy(*keys).agg(F.min(F.struct("failed", *STATISTICS)).alias("s")).select(*keys, "s.*")
    return once.where(~F.col("failed"))


def score_counts(docs: DataFrame, labels: DataFrame, forests: tuple[Forest, ...]) -> np.ndarray:
    """Labelled documents by forest, score bin and quality (0 bad, 1 good), all of them counted on Spark."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg((F.max("quality") == 1).alias("good")).withColumnRenamed("doc_id", "labelled_id")
    rows = _once(docs.where(F.col("doc_id").isNotNull()).select("doc_id", text_of().alias("text")), "doc_id")
    met = rows.join(known, F.col("doc_id") == F.col("labelled_id")).select("good", F.array(*STATISTICS).alias("x"))
    shared = docs.sparkSession.sparkContext.broadcast(Forests(forests, (TEXTBOOK_SCORE,) * len(forests)))

    @F.arrow_udf("array<int>")
    def bins(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(STATISTICS))
            found = np.minimum(shared.value.scores(x) * SCORE_BINS, SCORE_BINS - 1).astype(np.int32)
            starts = np.arange(len(batch) + 1, dtype=np.int32) * len(forests)
            yield pa.ListArray.from_arrays(pa.array(starts), pa.array(found.ravel()))

    binned = met.select("good", F.posexplode(bins("x")).alias("forest", "bin"))
    counted = np.zeros((len(forests), SCORE_BINS, 2), np.int64)
    for r in binned.groupBy("forest", "bin", "good").count().collect():  # two for each bin at most
        counted[r["forest"], r["bin"], int(r["good"])] = r["count"]
    return counted


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Forests | None:
    """Forests from a sample, whose ids are chosen first so that only its texts are looked at; thresholds from all labelled rows."""
    ids = bounded_sample(docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct(), F.col("doc_id"), sample)
    asked = F.broadcast(ids.withColumnRenamed("doc_id", "asked"))
    rows = docs.select("doc_id", text_of().alias("text")).join(asked, F.col("doc_id") == F.col("asked"))
    got = _once(rows, "doc_id").toPandas().sort_values("doc_id", ignore_index=True)
    if len(got) < 2:
        return None
    forests = plant(got[list(STATISTICS)].to_numpy(float))
    edges, keep = np.arange(1, SCORE_BINS + 1) / SCORE_BINS, 1 - (1 - KEEP_SHARE) / len(GROUPS)
    return Forests(forests, tuple(counted_threshold(edges, own[:, 1], own[:, 0], keep) for own in score_counts(docs, labels, forests)))


def judge(docs: DataFrame, labels: DataFrame, text_col: str = "text", **bounds: int) -> DataFrame:
    """``row`` (the document as it is), ``counts``, ``base_failed``, ``anomaly`` and ``kept``."""
    forests = fit(docs, labels, **bounds)
    shared = docs.sparkSession.sparkContext.broadcast(forests)  # a few hundred nodes a tree

    @F.arrow_udf(f"{STRUCT}, anomaly double")
    def look(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = counts(batch)
            x = np.column_stack([shares(found, s) for s in STATISTICS])
            found["anomaly"] = shared.value.anomaly(x) if shared.value is not None else np.zeros(len(x))
            names = [*COUNTS, "anomaly"]
            yield pa.StructArray.from_arrays([pa.array(found[n]) for n in names], names)

    looked = whole_rows(docs, counts=look(text_of(text_col)))
    scored = looked.select("row", "counts", base_failed("counts.").alias("base_failed"), F.col("counts.anomaly").alias("anomaly"))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") <= 1))


def keep(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """The documents that pass, as they are."""
    return judge(docs, labels, **bounds).where("kept").select("row.*")
