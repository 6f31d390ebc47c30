"""Sharding by jump consistent hashing.

The shard of a key follows from the key and the number of shards alone; there is no ring and no table.
When a shard is appended, a key either stays or moves to the new shard, and 1 key in n moves.

Defined results: a null key counts as 0; repeated rows share a shard and get slots of their own; a null
or empty text has no bytes and checksum 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.llm.common import mixed, settled, text_of

_MULTIPLIER = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key: from bucket b, jump to floor((b + 1) / r) for a fresh r in (0, 1]."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    bucket = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        bucket[moving] = ahead[moving]
        state[moving] = state[moving] * _MULTIPLIER + np.uint64(1)
        drawn = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[moving] = ((bucket[moving] + 1) * (float(1 << 31) / drawn)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return bucket


def key_of(column: str, kind: T.DataType) -> Column:
    """A stable 64-bit key: whole numbers as they are, anything else by its XXH64."""
    whole = isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.coalesce(F.col(column).cast("long") if whole else F.xxhash64(column), F.lit(0))


def shard(key: Column, shards: int) -> Column:
    """Shard number of a 64-bit key column."""

    @F.arrow_udf("int")
    def of(keys: pa.Array) -> pa.Array:
        return pa.array(jump(mixed(keys.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)), shards), pa.int32())

    return of(key)


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot``, ``grown_shard``.

    ``slot`` numbers the rows of a shard from 0 without a gap. Every task numbers its rows of each shard as
    it reads them; the counts of the tasks before it are added by a prefix sum over tasks. No shard is
    gathered or sorted in one place, and texts are read once and never shuffled.
    """
    kind = docs.select(id_col).schema[0].dataType
    raw = F.encode(text_of(text_col), "UTF-8")
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(raw).cast("long") + 8).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        shard(key_of(id_col, kind), shards).alias("shard"),
        shard(key_of(id_col, kind), shards + 1).alias("grown_shard"),
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for batch in batches:
            mine = batch.column(3).to_numpy()
            order = np.argsort(mine, kind="stable")
            values, index, sizes = np.unique(mine[order], return_index=True, return_counts=True)
            rank = np.empty(len(mine), np.int64)
            rank[order] = np.arange(len(mine)) - np.repeat(index, sizes) + np.repeat(seen[values], sizes)
            seen[values] += sizes
            extra = [pa.array(np.full(len(mine), block, np.int64)), pa.array(rank)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "block", "rank"])

    fields = [*narrow.schema.fields, T.StructField("block", T.LongType()), T.StructField("rank", T.LongType())]
    rows = settled(narrow.mapInArrow(number, T.StructType(fields)))
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        rows.groupBy("shard", "block")
        .agg(F.count("*").alias("n"))
        .select("shard", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    return rows.join(before, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank")).alias("slot"), "grown_shard"
    )
