"""Lookups by keys that may hold very many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.operators.ordering import PIECE


def semi_join(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is in ``known``, one row per key there.

    Membership is settled once for every key and scan block it occurs in, on the keys alone and with a map-side
    combine. Rows then meet the answer of their own block, so a key never brings more rows to a task than a
    block has, whatever its share of the table.
    """
    place = [key, *PIECE]
    found = rows.select(*place).distinct().join(known, key, "left_semi")
    return rows.join(found, place, "left_semi").select(rows.columns)


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast the table, so that no row of the other side moves."""
    spark = df.sparkSession
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    most = int(most) if most.lstrip("-").isdigit() else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most)
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most


def lookup(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``table``, one row per key there; null where the key is not in it.

    A table that Spark may broadcast is left to it. Beyond that the answer is settled once for every key and scan block
    it occurs in, on the keys alone and with a map-side combine, and rows meet the answer of their own block: a key
    that holds half of the rows spreads over its blocks, without adaptive splitting.
    """
    if broadcastable(table) or not set(PIECE) <= set(rows.columns):
        return rows.join(table, key, "left")
    place = [key, *PIECE]
    found = rows.select(*place).distinct().join(table, key)
    return rows.join(found, place, "left").select(*rows.columns, *[F.col(c) for c in table.columns if c != key])
