"""Keep-first dedup, last-wins lookups and running numbers over ordered rows.

Row order is part of the result here, so nothing in this module relies on the arrival order of rows:
every pick and every number is decided by the order columns of :mod:`sheetloom.schemas`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.schemas import order_of


def first_by(df: DataFrame, *keys: str) -> DataFrame:
    """Keep the first row, in row order, of every key (A2).

    ``row_number() = 1`` lets Spark drop all but one row per key and map task before the shuffle, so a
    key that holds most of the rows costs no more than any other.
    """
    ordered = Window.partitionBy(*keys).orderBy(*order_of(df))
    return df.withColumn("_rank", F.row_number().over(ordered)).where("_rank = 1").drop("_rank")


def last_values(df: DataFrame, key: str, *values: str) -> DataFrame:
    """One row per non-null key with the values of its last row, null or not (A3)."""
    position = F.struct(*order_of(df))
    picks = [F.max_by(v, position).alias(v) for v in values]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*picks)


#: Consecutive run of rows that a group is cut along: one scan block of one file.
PIECE = ("file_ord", "block")


def running_number(df: DataFrame, keys: Sequence[str], name: str, after: DataFrame | None = None) -> DataFrame:
    """Number the rows of every group 1, 2, ... in row order.

    Rows with a null key have no group and are left out. Every group is cut into scan blocks, whatever its size: rows
    are numbered inside each block, and the rows of the earlier blocks, summed up per group, are added on top. No task
    holds more of a group than a block, or its list of blocks.

    Only blocks with earlier ones get an offset, so where groups lie in one block, which most do, next to nothing is joined.

    ``after`` (the keys and ``last``, see :func:`last_numbers`) continues the numbers of earlier runs: rows of files that come
    later are numbered as if all files had been there from the start. It meets the blocks of a group, not its rows.
    """
    pieces = [*keys, *PIECE]
    rows = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in pieces))
    dealt = rows.repartition(*pieces)
    numbered = dealt.withColumn("_inside", F.row_number().over(Window.partitionBy(*pieces).orderBy(*order_of(rows))))
    numbered = numbered.where((F.col("_inside") >= 1) | _all_of(dealt, keys))
    placed = numbered.join(block_offsets(dealt, keys, after), pieces, "left")
    number = F.col("_inside") + F.coalesce("_before", F.lit(0))
    return placed.select(*df.columns, number.cast("long").alias(name))


def _of_blocks(dealt: DataFrame, keys: Sequence[str], **values: Column) -> DataFrame:
    """Aggregates by group and block that read the very shuffle ``dealt`` ends with, so that Spark writes it once.

    For that all readers must take the same columns of it: this one hashes those it has no use for, and rows are kept by a
    condition that names them (:func:`_all_of`). Without the reuse the result is the same, and the rows are derived and shuffled twice.
    """
    mark = F.bit_xor(F.xxhash64(*[c for c in dealt.columns if c not in (*keys, *PIECE)]))
    found = dealt.groupBy(*keys, *PIECE).agg(*[v.alias(n) for n, v in values.items()], F.count(F.lit(1)).alias("_rows"), mark.alias("_mark"))
    return found.where("_rows > 0 OR _mark IS NULL").drop("_mark")


def _all_of(dealt: DataFrame, keys: Sequence[str]) -> Column:
    """Names all columns of ``dealt``. Behind an OR whose other side holds it is not computed, and no column can be left out before."""
    return F.xxhash64(*[c for c in dealt.columns if c not in (*keys, *PIECE)]) == 0


def block_offsets(dealt: DataFrame, keys: Sequence[str], after: DataFrame | None = None) -> DataFrame:
    """``_before``: rows of the same group in earlier blocks and runs, for every group and block that has some."""
    earlier = Window.partitionBy(*keys).orderBy(*PIECE).rowsBetween(Window.unboundedPreceding, -1)
    counted = _of_blocks(dealt, keys).select(*keys, *PIECE, F.sum("_rows").over(earlier).alias("_before"))
    if after is not None:
        met = counted.join(after.select(*keys, "last"), list(keys), "left")
        total = F.coalesce("_before", F.lit(0)) + F.coalesce("last", F.lit(0))
        counted = met.select(*keys, *PIECE, F.when(total > 0, total).alias("_before"))
    return counted.where("_before IS NOT NULL")


def last_numbers(df: DataFrame, keys: Sequence[str], after: DataFrame | None = None) -> DataFrame:
    """The keys and ``last``: how far the numbers of every group run, those of earlier runs (``after``) included.

    What a run stores for the next one. Groups are counted with a map-side combine; no row is numbered for it.
    """
    here = df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("last"))
    if after is None:
        return here
    return here.unionByName(after.select(*keys, "last")).groupBy(*keys).agg(F.sum("last").alias("last"))


def merged_rows(df: DataFrame, *keys: str) -> DataFrame:
    """The rows that :func:`first_by` drops, each with the place of the row that is kept instead (A2): ``kept_file_ord``, ...

    Rows are ranked inside their scan block, and only blocks with earlier ones of the same key are joined to what the first block
    says, so a key that holds most of the rows spreads over its blocks. Rows are shuffled once, whatever columns are used of the
    result; keys are held in a struct, in which nulls are equal.
    """
    order = order_of(df)
    inner = [c for c in order if c not in PIECE]
    others = [c for c in df.columns if c not in keys]
    rows = df.where(" AND ".join(f"{c} IS NOT NULL" for c in PIECE))
    dealt = rows.select(F.struct(*keys).alias("_key"), *others).repartition("_key", *PIECE)
    block = Window.partitionBy("_key", *PIECE).orderBy(*inner)
    ranked = dealt.withColumns({"_inside": F.row_number().over(block), **{f"_own_{c}": F.first(c).over(block) for c in inner}})
    ranked = ranked.where((F.col("_inside") >= 1) | _all_of(dealt, ["_key"]))

    counted = _of_blocks(dealt, ["_key"], **({"_first": F.min(F.struct(*inner))} if inner else {}))
    of_key = Window.partitionBy("_key").orderBy(*PIECE)
    firsts = [F.first(c).over(of_key).alias(f"_kept_{c}") for c in PIECE] + [F.first(f"_first.{c}").over(of_key).alias(f"_kept_{c}") for c in inner]
    later = counted.select("_key", *PIECE, F.row_number().over(of_key).alias("_nth"), *firsts).where("_nth > 1").drop("_nth")

    placed = ranked.join(later, ["_key", *PIECE], "left")
    moved = F.col(f"_kept_{PIECE[0]}").isNotNull()
    lost = placed.where((F.col("_inside") > 1) | moved)
    kept = [F.when(moved, F.col(f"_kept_{c}")).otherwise(F.col(c if c in PIECE else f"_own_{c}")).alias(f"kept_{c}") for c in order]
    return lost.select(*[F.col(f"_key.{c}") if c in keys else c for c in df.columns], *kept)
