"""Near-duplicates by SimHash: fingerprints linked through a grid of segment bit counts.

Two fingerprints that differ in k bits have bit counts per segment that differ by at most k in sum, so
the Manhattan distance of the count vectors is a lower bound of the bit distance. The vectors are laid
out on an integer grid and joined by range: with k bits spread over k // 2 + 1 groups of segments, some
group takes at most one of them, so there the vectors lie in the same cell or in cells next to each
other. A join on the cells of each group finds every pair, and the bits themselves settle it.

Defined results: a null text is the empty text; a text without words has fingerprint zero and is linked
like any other; equal texts have equal fingerprints; repeated rows are linked to one another; a null
``doc_id`` never names a group that has another id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.llm.common import settled, text_of, whole_rows
from sheetloom.llm.components import components

#: Words of a shingle and bits that linked fingerprints may differ in.
WIDTH, MAX_BITS = 3, 3
#: Cells with more fingerprints than this are compared in blocks that report a spanning forest only.
HOT_CELL = 256
#: So are cells that more fingerprints than this look into, from the cells below as well.
HOT_SEEKERS = 8192
BLOCK = 2048
#: Hot cells up to which their table is broadcast (some 40 bytes each), and keys that a cell is spread over beyond that.
BROADCAST_CELLS, SALTS = 500_000, 32
#: XXH64 seed; Spark's own xxhash64 uses the same.
SEED = 42
SEGMENT_BITS = 2
SEGMENTS = 64 // SEGMENT_BITS
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = 1 << 15


def simhash(text: str | None, width: int = WIDTH) -> int:
    """Fingerprint of one text, as a signed 64-bit number."""
    words = (text or "").encode().translate(_LOWER).split()  # bytes split at 0x20 and 0x09-0x0D only
    if not words:
        return 0
    width = min(width, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    digest, counts, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - width + 1
    for first in range(0, total, _STEP):
        last = min(first + _STEP, total)
        pairs = zip(starts[first:last], ends[first + width - 1 : last + width - 1], strict=True)
        hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in pairs], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, width: int = WIDTH) -> Column:
    """SimHash of a text column as a long."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([simhash(t.as_py(), width) for t in batch], pa.int64())

    return of(text)


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _counts(value: Column) -> Column:
    """Bit counts of all two-bit segments, each packed in the two bits of its segment.

    One set bit gives 01, two give 10: no sum carries into the next segment.
    """
    low = F.lit(0x5555555555555555)
    first, second = value.bitwiseAND(low), F.shiftrightunsigned(value, 1).bitwiseAND(low)
    return first.bitwiseXOR(second).bitwiseOR(F.shiftleft(first.bitwiseAND(second), 1))


def _group_bounds(max_bits: int) -> list[tuple[int, int]]:
    """Segments of each group. Of ``max_bits`` differences some group takes one at most."""
    groups = max_bits // 2 + 1
    edges = [SEGMENTS * g // groups for g in range(groups + 1)]
    return list(zip(edges, edges[1:], strict=False))


def _mask(first: int, last: int) -> int:
    return _signed(sum(3 << (SEGMENT_BITS * s) for s in range(first, last)))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def cells(prints: DataFrame, max_bits: int = MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """Own cell of every fingerprint in each group, and the cells one step up from it.

    Cells one step apart differ by one in one count, so of two such fingerprints one looks upwards.
    """
    counted = prints.select("print", _counts(F.col("print")).alias("counts"))
    own, up = [], []
    for group, (first, last) in enumerate(_group_bounds(max_bits)):
        cell = F.col("counts").bitwiseAND(F.lit(_mask(first, last)))
        own.append(F.struct(F.lit(group).alias("grp"), cell.alias("cell")))
        for s in range(first, last):  # in the segment's two bits, count 0 (00) goes to 01 and count 1 (01) to 10
            one, both = F.lit(_signed(1 << (SEGMENT_BITS * s))), F.lit(_signed(3 << (SEGMENT_BITS * s)))
            here = cell.bitwiseAND(both)
            step = F.when(here == 0, cell.bitwiseOR(one)).when(here == one, cell.bitwiseXOR(both))
            up.append(F.struct(F.lit(group).alias("grp"), step.alias("cell")))
    home = counted.select("print", F.explode(F.array(*own)).alias("at")).select("print", "at.grp", "at.cell")
    above = counted.select("print", F.explode(F.array(*up)).alias("at")).select("print", "at.grp", "at.cell")
    return home, above.where(F.col("cell").isNotNull())


def links(
    prints: DataFrame, max_bits: int = MAX_BITS, hot_cell: int = HOT_CELL, block: int = BLOCK, hot_seekers: int = HOT_SEEKERS
) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``print``) of at most ``max_bits`` bits.

    All such pairs are found. A cell is hot if it has more than ``hot_cell`` fingerprints, or if more than ``hot_seekers`` of
    its own and the cells below look into it, so that no key of the join on cells has more rows than these bounds. Pairs in a
    hot cell are reported as a spanning forest of each pair of blocks, which has the same connected components, so
    the links are linear in the fingerprints however dense a cell is. With m fingerprints and s that look for them, a hot
    cell takes (s / block) * (m / block) tasks of block * block comparisons.
    """
    if max_bits < 0:
        raise ValueError("max_bits must not be negative")
    home, above = cells(prints, max_bits)
    seekers = home.withColumn("up", F.lit(False)).unionByName(above.withColumn("up", F.lit(True)))
    counted = seekers.groupBy("grp", "cell").agg(F.count_if(~F.col("up")).alias("members"), F.count("*").alias("seekers"))
    crowded = (F.col("members") > hot_cell) | ((F.col("members") > 0) & (F.col("seekers") > hot_seekers))
    hot = settled(counted.where(crowded))
    near = (F.col("up") | (F.col("print") < F.col("other"))) & (
        F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= max_bits
    )
    many = hot.count()
    cold, looking = home, seekers
    if many:
        cold, looking = _with_hot(home, hot, many, "left_anti"), _with_hot(seekers, hot, many, "left_anti")
    targets = cold.withColumnRenamed("print", "other")
    found = looking.join(targets, ["grp", "cell"]).where(near).select(F.col("print").alias("a"), F.col("other").alias("b"))
    return found.unionByName(_hot_links(seekers, home, hot, many, max_bits, block)) if many else found


def _with_hot(rows: DataFrame, hot: DataFrame, many: int, how: str) -> DataFrame:
    """Join rows to the hot cells: broadcast up to :data:`BROADCAST_CELLS` of them, else by cell and salt, so that no cell is one key."""
    if many <= BROADCAST_CELLS:
        return rows.join(F.broadcast(hot), ["grp", "cell"], how)
    salted = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = rows.withColumn("salt", F.pmod(F.xxhash64("print", F.lit(3)), F.lit(SALTS)).cast("int"))
    return own.join(salted, ["grp", "cell", "salt"], how).drop("salt")


def _hot_links(seekers: DataFrame, home: DataFrame, hot: DataFrame, many: int, max_bits: int, block: int) -> DataFrame:
    """Links within hot cells: rows are cut into blocks by their hash, every block meets every other once."""

    def blocks(rows: DataFrame) -> DataFrame:
        return _with_hot(rows, hot, many, "inner").select(
            "grp", "cell", "print", F.ceil(F.col("seekers") / block).cast("int").alias("lefts"), F.ceil(F.col("members") / block).cast("int").alias("rights")
        )

    def part(of: str) -> Column:
        return F.pmod(F.xxhash64("print", F.lit(7)), F.col(of)).cast("int")

    def every(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    left = blocks(seekers.drop("up")).select("grp", "cell", "print", part("lefts").alias("l"), every("rights").alias("r"))
    right = blocks(home).select("grp", "cell", "print", part("rights").alias("r"), every("lefts").alias("l"))
    right = right.toDF("grp_right", "cell_right", "other", "r_right", "l_right")

    def forest(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            spanning(one["print"].to_numpy(np.int64), two["other"].to_numpy(np.int64), max_bits), columns=["a", "b"]
        )

    meeting = left.groupBy("grp", "cell", "l", "r").cogroup(right.groupBy("grp_right", "cell_right", "l_right", "r_right"))
    return meeting.applyInPandas(forest, "a long, b long")


def spanning(left: np.ndarray, right: np.ndarray, max_bits: int) -> np.ndarray:
    """Links that keep together what the pairs of two blocks tie together: each node to its root."""
    nodes = np.unique(np.concatenate([left, right]))
    label = np.arange(len(nodes))
    near = np.bitwise_count(left[:, None].view(np.uint64) ^ right[None, :].view(np.uint64)) <= max_bits
    one, two = np.nonzero(near)
    one, two = np.searchsorted(nodes, left)[one], np.searchsorted(nodes, right)[two]
    while True:
        least = np.minimum(label[one], label[two])
        fresh = label.copy()
        np.minimum.at(fresh, label[one], least)
        np.minimum.at(fresh, label[two], least)
        fresh = fresh[fresh]
        if (fresh == label).all():
            break
        label = fresh
    tied = label != np.arange(len(nodes))
    return np.stack([nodes[label[tied]], nodes[tied]], axis=1)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    max_bits: int = MAX_BITS,
    hot_cell: int = HOT_CELL,
) -> DataFrame:
    """One row per document: ``doc_id``, ``row_key``, ``print``, ``component_id``, ``keeper``.

    ``component_id`` is the smallest id reachable over links, ``row_key`` a 64-bit hash of id and text.
    ``keeper`` marks the row that stands for its component: smallest id, then smallest row key; rows
    repeated in both are marked alike. Only ids and fingerprints are shuffled, never texts.
    """
    prints = settled(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.xxhash64(id_col, text_of(text_col)).alias("row_key"),
            fingerprint(text_of(text_col), width).alias("print"),
        )
    )
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")
    distinct = settled(prints.groupBy("print").agg(F.min(place).alias("first")))
    tied = components(links(distinct.select("print"), max_bits, hot_cell))
    rooted = distinct.join(tied, distinct["print"] == tied["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    leaders = rooted.groupBy("root").agg(F.min("first").alias("leader"))
    found = rooted.join(leaders, "root").select("print", "leader")
    return prints.join(found, "print").select(
        "doc_id",
        "row_key",
        "print",
        F.col("leader.doc_id").alias("component_id"),
        place.eqNullSafe(F.col("leader")).alias("keeper"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params: int) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one document of each group stays, as it is.

    Of rows repeated in id and text, the one with the smallest hash of all columns stays.
    """
    keepers = near_duplicates(docs, id_col, text_col, **params).where("keeper").select("doc_id", "row_key").distinct()
    rows = whole_rows(docs, doc_id=F.col(id_col), row_key=F.xxhash64(id_col, text_of(text_col)))
    same = (rows["row_key"] == keepers["row_key"]) & rows["doc_id"].eqNullSafe(keepers["doc_id"])
    once = Window.partitionBy("row_key", "doc_id").orderBy(F.xxhash64("row"))
    kept = rows.join(keepers, same, "left_semi").withColumn("nth", F.row_number().over(once))
    return kept.where("nth = 1").select("row.*")
