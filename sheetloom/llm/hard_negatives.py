"""Hard negatives by exact search over lists that clusters of anchors share.

Anchors are clustered by angle. For all anchors of a cluster, a candidate's score is at most its length times the
cosine of its angle to the cluster's centre less the cluster's radius. In each block of candidates this bound is computed
and sorted once per cluster, and every member walks that one list. A member stops, with a certificate, when the next bound
times its own length is below what it still looks for: the last of its best so far, or the least score that is asked for.

Candidates lie in cells around the same centres, cut into blocks. An anchor goes only to blocks whose bound reaches
what it looks for: first to its own cell, which yields a first threshold, then wherever a better positive may be, then, with the scores of
its positives known, wherever a negative may be. Nothing is approximate: the centres, from a bounded sample, decide the work only.

Defined results: a row without an id, a label or a vector, or with a component that is null or not finite, takes no part;
vectors of different lengths are filled up with zeros; an empty vector scores 0 with all; rows that agree in id,
label and vector are one row; rows with one id that differ otherwise are rows of their own, and each is another row to the
others; equal scores are in order of ids; other columns have no part, whatever they are called; an empty table gives an empty result.
A vector longer than 2 ** 19 is an error; all others have exact scores.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.llm.common import settled
from sheetloom.llm.text_stats import bounded_sample

#: Whole steps that a component of 1 is cut into.
STEPS = 256
#: Anchors that the centres are fitted on, at most, and the bound on all numbers of the centres.
SAMPLE_ROWS, CENTRE_NUMBERS = 8192, 1 << 20
#: Rows of a block of candidates, about.
BLOCK_ROWS = 1 << 16
#: Entries of a list that a walk takes at a time, and members that walk side by side.
STRIDE, ABREAST = 2048, 128
#: Length that a vector may have, so that scores and their percentages stay whole numbers of 64 bits.
LONGEST = 2.0**19
#: The share of a bound that rounding may take.
SLACK = 1e-6


def whole(vector: Column) -> Column:
    """floor(256 x) of each component as 32-bit integers in bytes; null where a component is null or not finite."""

    @F.arrow_udf("binary")
    def of(vectors: pa.Array) -> pa.Array:
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        values = vectors.flatten()
        numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False) if len(values) else np.zeros(0)
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False))])
        steps = np.floor(np.float64(STEPS) * numbers)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(numbers))])
        out: list[bytes | None] = []
        present = vectors.is_valid().to_pylist()
        for there, a, b in zip(present, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            if not there or bad[b] > bad[a]:
                out.append(None)
                continue
            if np.dot(numbers[a:b], numbers[a:b]) > LONGEST**2:
                raise ValueError(f"a vector is longer than {LONGEST:.0f}")
            out.append(steps[a:b].astype("<i4").tobytes())
        return pa.array(out, pa.binary())

    return of(vector)


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of components, as whole numbers in doubles."""
    out = np.zeros((len(vectors), width))
    for k, raw in enumerate(vectors.to_pylist()):
        out[k, : len(raw) // 4] = np.frombuffer(raw, "<i4")
    return out


def _angles(rows: np.ndarray, norms: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angle of each row to each centre; a row without length is at angle 0 to all."""
    cosines = rows @ centres.T / np.where(norms > 0, norms, 1.0)[:, None]
    return np.where(norms[:, None] > 0, np.arccos(np.clip(cosines, -1.0, 1.0)), 0.0)


def fitted_centres(rows: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Unit centres by spherical k-means, about the root of the number of rows; the first are rows at even distances."""
    width = max(rows.shape[1], 1)
    many = max(1, min(math.isqrt(len(rows)), CENTRE_NUMBERS // width))
    norms = np.linalg.norm(rows, axis=1)
    units = (rows / np.where(norms > 0, norms, 1.0)[:, None])[norms > 0]
    if not len(units):
        return np.eye(1, width)
    centres = units[np.linspace(0, len(units) - 1, many).astype(int)]
    for _ in range(rounds):
        near = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, units)
        length = np.linalg.norm(sums, axis=1)
        centres = np.where(length[:, None] > 0, sums / np.where(length > 0, length, 1.0)[:, None], centres)
    return centres


class Cells:
    """Centres, and what is known of the rows and the anchors around each. At most as many rows as there are centres."""

    def __init__(self, centres: np.ndarray, stats: list) -> None:
        many = len(centres)
        self.centres, self.width = centres, centres.shape[1]
        self.rows, self.spread, self.reach = np.zeros(many, np.int64), np.zeros(many), np.zeros(many)
        self.longest, self.shortest = np.zeros(many), np.zeros(many)
        for s in stats:
            self.rows[s["cell"]], self.spread[s["cell"]], self.reach[s["cell"]] = s["n"], s["spread"], s["reach"] or 0.0
            self.longest[s["cell"]], self.shortest[s["cell"]] = s["longest"], s["shortest"]
        self.parts = -(-self.rows // BLOCK_ROWS)

    def bounds(self, rows: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """The most that each row can score with a row of each cell."""
        cosines = np.cos(np.maximum(_angles(rows, norms, self.centres) - self.spread, 0.0))
        return norms[:, None] * np.where(cosines >= 0, self.longest, self.shortest) * cosines

    def slack(self, norms: np.ndarray) -> np.ndarray:
        return SLACK * norms[:, None] * self.longest


class Block:
    """Candidates of one block, and the list of the cluster that walks at the moment."""

    def __init__(self, cells: Cells) -> None:
        self._cells, self._held, self._cluster = cells, [], None
        self.ids = self.labels = np.zeros(0, np.int64)

    def add(self, batch: pa.RecordBatch) -> None:
        self._held.append(batch)

    def _settle(self) -> None:
        table = pa.Table.from_batches(self._held)
        self._held = []
        self.ids, self.labels = (table.column(c).to_numpy() for c in ("id", "label"))
        self.rows = _matrix(table.column("vector"), self._cells.width)
        self.norms = np.linalg.norm(self.rows, axis=1)

    def listed(self, cluster: int) -> tuple[np.ndarray, np.ndarray]:
        """Candidates by falling bound for the unit vectors of a cluster, and these bounds; sorted once for all members."""
        if self._held:
            self._settle()
        if self._cluster != cluster:
            away = _angles(self.rows, self.norms, self._cells.centres[cluster : cluster + 1])[:, 0]
            bound = self.norms * np.cos(np.maximum(away - self._cells.reach[cluster], 0.0))
            order = np.argsort(-bound, kind="stable")
            self._cluster, self._order, self._bound = cluster, order, bound[order]
        return self._order, self._bound

    @property
    def empty(self) -> bool:
        return not self._held and not len(self.ids)


def _products(members: np.ndarray, rows: np.ndarray, far: bool) -> np.ndarray:
    """Inner products as 64-bit integers. Doubles hold them exactly as long as no product of lengths is beyond 2 ** 53."""
    if far:
        return members.astype(np.int64) @ rows.astype(np.int64).T
    return (members @ rows.T).astype(np.int64)


def walk(
    block: Block, cluster: int, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray,
    owner: np.ndarray, low: np.ndarray, high: np.ndarray, most: int, same: bool,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What walkers find in a block: walker, score and id, ``most`` each at most, best first.

    Walker w belongs to member ``owner[w]`` and looks for the highest scores from ``low[w]`` to ``high[w]`` among rows
    that have the member's label (``same``; the member itself apart) or another one. It leaves the list when its bound is certain.
    """
    order, bound = block.listed(cluster)
    norms = np.linalg.norm(rows, axis=1)
    far = bool(len(order)) and float(norms.max(initial=0.0)) * float(block.norms.max()) >= 2.0**53
    least = low.copy()
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    going = np.flatnonzero(low <= high)
    for start in range(0, len(order), STRIDE):
        reach = norms[owner[going]]
        going = going[reach * bound[start] + SLACK * reach * block.norms.max() >= least[going]]
        if not len(going):
            break
        here = order[start : start + STRIDE]
        who, row = np.unique(owner[going], return_inverse=True)
        scores = _products(rows[who], block.rows[here], far)
        fits = (labels[who][:, None] == block.labels[here]) == same
        if same:
            for k, c in zip(*np.nonzero(ids[who][:, None] == block.ids[here]), strict=True):
                fits[k, c] &= not np.array_equal(rows[who[k]], block.rows[here[c]])
        each = scores[row]
        w, c = np.nonzero(fits[row] & (each >= least[going][:, None]) & (each <= high[going][:, None]))
        found = tuple(np.concatenate(x) for x in zip(found, (going[w], each[w, c], block.ids[here[c]]), strict=True))
        ranked = np.lexsort((found[2], -found[1], found[0]))
        walker = found[0][ranked]
        nth = np.arange(len(walker)) - np.searchsorted(walker, walker)
        found = tuple(x[ranked[nth < most]] for x in found)
        full = nth[nth < most] == most - 1
        least[found[0][full]] = found[1][full]
    return found


_FOUND = "id long, mark long, walker int, score long, found long"


def _meet(candidates: DataFrame, asked: DataFrame, cells: Cells, most: int, same: bool) -> DataFrame:
    """What each walker of ``asked`` (anchors with ``blocks``, ``low`` and ``high``) finds, by block: ``_FOUND``.

    A block's rows come first in their partition, then the anchors that were sent to it, cluster by cluster; a task holds one
    block and one batch of anchors.
    """
    none = F.lit(None).cast("array<long>")
    held = candidates.select(
        F.lit(0).alias("role"), "cell", "part", F.lit(-1).alias("cluster"), "id", "label", "mark", "vector", none.alias("low"), none.alias("high")
    )
    sent = asked.withColumn("block", F.explode("blocks")).select(
        F.lit(1).alias("role"),
        F.shiftright("block", 32).cast("int").alias("cell"),
        F.col("block").bitwiseAND((1 << 32) - 1).alias("part"),
        F.col("cell").alias("cluster"),
        "id", "label", "mark", "vector", "low", "high",
    )
    many = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = held.unionByName(sent).repartition(many, "cell", "part").sortWithinPartitions("cell", "part", "role", "cluster", "id")

    def of_members(block: Block, members: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, labels, marks = (members.column(c).to_numpy() for c in ("id", "label", "mark"))
        lows, highs = members.column("low"), members.column("high")
        counts = pc.list_value_length(lows).to_numpy()
        owner = np.repeat(np.arange(len(ids)), counts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        rows = _matrix(members.column("vector"), cells.width)
        w, score, at = walk(
            block, members.column("cluster")[0].as_py(), ids, labels, rows, owner,
            lows.flatten().to_numpy(), highs.flatten().to_numpy(), most, same,
        )
        columns = [ids[owner[w]], marks[owner[w]], nth[w].astype(np.int32), score, at]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "mark", "walker", "score", "found"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = Block(cells), None
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("cell", "part", "role", "cluster")]
            edges = np.zeros(max(len(batch) - 1, 0), bool)
            for key in keys:
                edges |= key[1:] != key[:-1]
            cuts = [0, *(np.flatnonzero(edges) + 1).tolist(), len(batch)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if (keys[0][a], keys[1][a]) != at:
                    block, at = Block(cells), (keys[0][a], keys[1][a])
                if keys[2][a] == 0:
                    block.add(batch.slice(a, b - a))
                elif not block.empty:
                    for c in range(a, b, ABREAST):
                        yield from of_members(block, batch.slice(c, min(ABREAST, b - c)))

    return dealt.mapInArrow(search, _FOUND)


def _best(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each walker over all blocks, with ``nth`` from 1."""
    by = Window.partitionBy("id", "mark", "walker").orderBy(F.desc("score"), "found")
    return found.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= most)


def _blocks(cells: Cells, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Callable[[Column, Column, Column], Column]:
    """Blocks that an anchor is sent to, by its vector, its cell and the least score that it still looks for (null: any)."""

    @F.arrow_udf("array<long>")
    def of(vectors: pa.Array, own: pa.Array, least: pa.Array) -> pa.Array:
        rows = _matrix(vectors, cells.width)
        norms = np.linalg.norm(rows, axis=1)
        floor = pc.fill_null(least.cast(pa.float64()), -np.inf).to_numpy(zero_copy_only=False)
        reached = cells.bounds(rows, norms) + cells.slack(norms) >= floor[:, None]
        at = np.arange(len(cells.centres)) == own.to_numpy()[:, None]
        return pa.array(
            [
                [(int(c) << 32) + p for c in np.flatnonzero(chosen) for p in range(int(cells.parts[c]))]
                for chosen in wanted(reached, at)
            ],
            pa.list_(pa.int64()),
        )

    return of


def mine(
    table: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    positives: int = 5, negatives: int = 5, least_percent: int = 80,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors of a table.

    ``anchor`` and ``label`` are expressions over the table. An anchor's positives are the ``positives`` best rows of its label;
    the negatives of a pair are the ``negatives`` best rows of other labels that score from ``least_percent`` of the positive's
    score up to that score.
    """
    rows = table.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("asks"),
        whole(F.col(vector_col)).alias("vector"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    width = max(table.agg(F.max(F.size(vector_col))).first()[0] or 0, 1)
    sample = bounded_sample(rows.where("asks"), F.col("id"), SAMPLE_ROWS).select("vector").collect()
    centres = fitted_centres(_matrix(pa.array([bytes(r["vector"]) for r in sample], pa.binary()), width))

    @F.arrow_udf("cell int, angle double, norm double")
    def near(vectors: pa.Array) -> pa.Array:
        held = _matrix(vectors, width)
        norms = np.linalg.norm(held, axis=1)
        angles = _angles(held, norms, centres)
        cell = np.argmin(angles, axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(cell, pa.int32()), pa.array(angles[np.arange(len(cell)), cell]), pa.array(norms)], ["cell", "angle", "norm"]
        )

    marked = rows.distinct().select("*", F.xxhash64("label", "vector").alias("mark"), near("vector").alias("near"))
    placed = settled(marked.select("*", "near.*").drop("near"))
    stats = placed.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("angle").alias("spread"), F.max(F.when(F.col("asks"), F.col("angle"))).alias("reach"),
        F.max("norm").alias("longest"), F.min("norm").alias("shortest"),
    )
    cells = Cells(centres, stats.collect())
    parts = F.element_at(F.array(*[F.lit(max(int(p), 1)) for p in cells.parts]), F.col("cell") + 1)
    candidates = placed.withColumn("part", F.pmod(F.xxhash64("id", "mark"), parts))
    anchors = placed.where("asks").select("id", "label", "mark", "vector", "cell")
    lowest, highest = F.array(F.lit(-(2**62))), F.array(F.lit(2**62))

    at_home = _blocks(cells, lambda reached, own: own)
    first = anchors.select("*", at_home("vector", "cell", F.lit(None).cast("long")).alias("blocks"), lowest.alias("low"), highest.alias("high"))
    home = settled(_best(_meet(candidates, first, cells, positives, True), positives))
    known = home.where(F.col("nth") == positives).select("id", "mark", F.col("score").alias("least"))
    elsewhere = _blocks(cells, lambda reached, own: reached & ~own)
    second = anchors.join(known, ["id", "mark"], "left").withColumn("blocks", elsewhere("vector", "cell", F.col("least")))
    second = second.withColumn("low", F.coalesce(F.when(F.col("least").isNotNull(), F.array("least")), lowest)).withColumn("high", highest)
    away = _meet(candidates, second, cells, positives, True)
    kin = settled(_best(home.drop("nth").unionByName(away), positives))

    pairs = kin.groupBy("id", "mark").agg(F.array_sort(F.collect_list(F.struct("nth", "score"))).alias("each"))
    low = F.expr(
        f"transform(each, p -> CASE WHEN p.score < 0 THEN -((-p.score * {least_percent}) div 100) ELSE (p.score * {least_percent} + 99) div 100 END)"
    )
    reachable = _blocks(cells, lambda reached, own: reached)
    third = anchors.join(pairs, ["id", "mark"]).select(
        "id", "label", "mark", "vector", "cell", low.alias("low"), F.col("each.score").alias("high")
    )
    third = third.withColumn("blocks", reachable("vector", "cell", F.array_min("low")))
    bad = _best(_meet(candidates, third, cells, negatives, False), negatives)
    good = kin.select("id", "mark", (F.col("nth") - 1).alias("walker"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    return bad.join(good, ["id", "mark", "walker"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("nth").alias("rank"), F.col("found").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
