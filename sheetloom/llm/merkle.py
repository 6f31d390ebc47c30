"""Merkle manifest of a data set, with an inclusion proof for every row from octopus multiproofs.

A row's leaf is the hash of its columns. The leaves of a tree (one for each value of a column) stand in order
of their ids; every run of ``FAN`` nodes becomes their hash until one node is left, the subroot. The subroots
are the leaves of one more tree, whose last node is the root.

Proofs are made by partition, not by row. A partition of leaves lists the coordinates of all nodes that its
proofs take and that it can neither hold nor derive itself (the minimal union: a node that two rows need counts once, one
below a node that it derives not at all). All of them are fetched in one join; the partition then derives the interior
that its rows share and writes out each row's proof.

Defined results: null values count as ``-``; rows without an id stand first in their tree, rows of one id in order of
their leaves; repeated rows are leaves of their own, with equal digests; a tree of one leaf has it as subroot,
with no siblings; very long texts are hashed whole; other columns of the table have no part in anything, whatever
they are called; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.llm.common import settled

#: Nodes that one node stands for.
FAN = 8
#: Levels that one task builds or proves at a time: it holds FAN ** STEP leaves at most.
STEP = 4
#: Columns of a document that its leaf covers, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of the subroots. Trees of rows are called 0 (the null value) or 1 and their value.
TOP = "2"


def leaf(values: Iterable[Column]) -> Column:
    """Digest of some values: each is ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    texts = [v.cast("string") for v in values]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*sized), 256)


def tree_name(value: Column) -> Column:
    """Name of a tree, in the order of the values: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("1"), value.cast("string")), F.lit("0"))


def levels(n: int) -> int:
    """How often the nodes of a tree of ``n`` leaves are folded until one is left."""
    found = 0
    while n > 1:
        n, found = -(-n // FAN), found + 1
    return found


def width(n: int, level: int) -> int:
    """Nodes on a level of a tree of ``n`` leaves."""
    return -(-n // FAN**level)


def _digest(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


def positioned(rows: DataFrame, *order: str) -> DataFrame:
    """Rows (``tree`` and others) with ``n``, the rows of their tree, and ``pos``, their place in it from 0.

    Rows are sorted by range, so one tree may lie in many partitions; what precedes a partition is a prefix sum over one
    count for each partition of a tree.
    """
    ordered = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    held = settled(ordered.withColumn("at", F.monotonically_increasing_id()))
    held = held.withColumn("part", F.shiftright("at", 33))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = held.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    before = counts.select(
        "tree", "part", "first",
        F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"),
        F.sum("here").over(Window.partitionBy("tree")).alias("n"),
    )
    joined = held.join(before, ["tree", "part"])
    return joined.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before")


_NODE = "tree string, n long, level int, pos long, digest string"


def _fold(table: pa.Table) -> pa.Table:
    """Up to STEP levels above the nodes of one block, which all have one level."""
    out: dict[str, list] = {name: [] for name in ("tree", "n", "level", "pos", "digest")}
    if table.num_rows:
        tree, n, level = (table.column(c)[0].as_py() for c in ("tree", "n", "level"))
        held = sorted(zip(table.column("pos").to_pylist(), table.column("digest").to_pylist(), strict=True))
        first, nodes = held[0][0], [d for _, d in held]
        for _ in range(STEP):
            if width(n, level) == 1:
                break
            nodes = [_digest("".join(nodes[k : k + FAN])) for k in range(0, len(nodes), FAN)]
            first, level = first // FAN, level + 1
            out["tree"] += [tree] * len(nodes)
            out["n"] += [n] * len(nodes)
            out["level"] += [level] * len(nodes)
            out["pos"] += range(first, first + len(nodes))
            out["digest"] += nodes
    kinds = {"tree": pa.string(), "n": pa.int64(), "level": pa.int32(), "pos": pa.int64(), "digest": pa.string()}
    return pa.table({name: pa.array(values, kinds[name]) for name, values in out.items()})


def nodes_above(leaves: DataFrame) -> DataFrame:
    """All nodes above some positioned leaves (``tree``, ``n``, ``pos``, ``digest``), as ``tree, n, level, pos, digest``.

    A task folds a block of FAN ** STEP nodes through STEP levels; the next round folds what is left.
    """
    at = leaves.select("tree", "n", F.lit(0).alias("level"), "pos", "digest")
    most = leaves.agg(F.max("n")).first()[0] or 0
    found = at.limit(0)
    for base in range(0, levels(most), STEP):
        block = F.floor(F.col("pos") / FAN**STEP).alias("block")
        up = settled(at.select("*", block).groupBy("tree", "block").applyInArrow(_fold, _NODE))
        found = found.unionByName(up)
        at = up.where(F.col("level") == base + STEP)
    return found


def missing(n: int, places: Iterable[int]) -> list[tuple[int, int]]:
    """Coordinates (level, place) of the nodes that proofs of some leaves take beside what the leaves themselves yield."""
    own, found = set(places), []
    for level in range(levels(n)):
        size = width(n, level)
        for run in sorted({p // FAN for p in own}):
            found += [(level, p) for p in range(run * FAN, min(run * FAN + FAN, size)) if p not in own]
        own = {p // FAN for p in own}
    return found


def paths(n: int, leaves: dict[int, str], fetched: dict[tuple[int, int], str]) -> dict[int, list[tuple[str, str]]]:
    """Siblings before and behind the node of each leaf, level by level, joined; from the leaves and what was fetched."""
    own, steps = leaves, []
    for level in range(levels(n)):
        size, above, around = width(n, level), {}, {}
        for run in sorted({p // FAN for p in own}):
            places = range(run * FAN, min(run * FAN + FAN, size))
            held = [own[p] if p in own else fetched[level, p] for p in places]
            above[run] = _digest("".join(held))
            for k, p in enumerate(places):
                if p in own:
                    around[p] = ("".join(held[:k]), "".join(held[k + 1 :]))
        steps.append(around)
        own = above
    return {p: [around[p // FAN**level] for level, around in enumerate(steps)] for p in leaves}


_PATH = "array<struct<before:string,after:string>>"
_PATH_TYPE = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def inclusion_paths(chosen: DataFrame, nodes: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """``chosen`` leaves (``tree``, ``n``, ``pos``, ``digest`` and others) with ``path``, their proof.

    ``nodes`` holds every node of the trees, leaves included. Any subset of the leaves may be chosen. Where ``above`` (``tree``,
    ``subroot``, ``root``, ``upper``) tells what the root of each tree leads to, paths go on to there and its columns are added; it
    meets the partitions of leaves, not the leaves.
    """
    rows = chosen.withColumn("block", F.floor(F.col("pos") / FAN**STEP))

    def coordinates(table: pa.Table) -> pa.Table:
        tree, n, block = (table.column(c)[0].as_py() for c in ("tree", "n", "block"))
        found = missing(n, table.column("pos").to_pylist())
        return pa.table({
            "tree": pa.array([tree] * len(found), pa.string()), "block": pa.array([block] * len(found), pa.int64()),
            "level": pa.array([c[0] for c in found], pa.int32()), "pos": pa.array([c[1] for c in found], pa.int64()),
        })

    wanted = rows.select("tree", "n", "block", "pos").groupBy("tree", "block")
    wanted = wanted.applyInArrow(coordinates, "tree string, block long, level int, pos long")
    fetched = wanted.join(nodes.select("tree", "level", "pos", "digest"), ["tree", "level", "pos"])
    added = []
    if above is not None:
        led = rows.select("tree", "block").distinct().join(above, "tree").withColumn("level", F.lit(-1))
        fetched = fetched.unionByName(led, allowMissingColumns=True)
        added = [T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType())]

    def expand(left: pa.Table, right: pa.Table) -> pa.Table:
        known = {(r["level"], r["pos"]): r for r in right.to_pylist()}
        led = known.get((-1, None), {"upper": [], "subroot": None, "root": None})
        listed, at = [], left.column("pos").to_pylist()
        if at:
            digests = {place: r["digest"] for place, r in known.items()}
            own = dict(zip(at, left.column("digest").to_pylist(), strict=True))
            found = paths(left.column("n")[0].as_py(), own, digests)
            listed = [[{"before": b, "after": a} for b, a in found[p]] + led["upper"] for p in at]
        for field in added:
            left = left.append_column(field.name, pa.array([led[field.name]] * len(at), pa.string()))
        return left.append_column("path", pa.array(listed, _PATH_TYPE))

    schema = T.StructType([*rows.schema.fields, *added, T.StructField("path", T.StructType.fromDDL(f"path {_PATH}")[0].dataType)])
    both = rows.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block"))
    return both.applyInArrow(expand, schema).drop("block")


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    step = lambda node, at: F.sha2(F.concat(at["before"], node, at["after"]), 256)
    return F.aggregate(path, digest, step)


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right, as one text of digests."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["before"], at["after"])), "")


def manifest(
    docs: DataFrame, columns: Iterable[str] = LEAF_COLUMNS, id_col: str = "doc_id", tree_col: str = "lang", **held: Column
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``path``, and the columns of ``held``.

    ``path`` leads from the leaf through its subroot to the root: :func:`folded` recomputes the root from it, from this
    leaf or from another one that is held against it. Texts are hashed where they are read and never shuffled.
    """
    columns = tuple(columns)
    rows = docs.select(
        tree_name(F.col(tree_col)).alias("tree"),
        F.col(id_col).alias("doc_id"),
        leaf([F.col(c) for c in columns]).alias("digest"),
        *[value.alias(f"held_{name}") for name, value in held.items()],
    )
    leaves = settled(positioned(settled(rows), "doc_id", "digest"))  # sorting by range samples its rows first: not the texts again
    ground = leaves.select("tree", "n", F.lit(0).alias("level"), "pos", "digest")
    nodes = ground.unionByName(nodes_above(leaves))

    height = F.udf(lambda n: levels(n), "int")  # on a few rows of each tree
    subroots = nodes.where("pos = 0").where(F.col("level") == height("n"))
    tops = settled(positioned(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("of"), "digest"), "of"))
    top_nodes = tops.select("tree", "n", F.lit(0).alias("level"), "pos", "digest").unionByName(nodes_above(tops))
    upper = inclusion_paths(tops, top_nodes).select(
        F.col("of").alias("tree"), F.col("digest").alias("subroot"), F.col("path").alias("upper"),
        folded(F.col("digest"), F.col("path")).alias("root"),
    )
    return inclusion_paths(leaves, nodes, settled(upper)).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", *[F.col(f"held_{n}").alias(n) for n in held]
    )
