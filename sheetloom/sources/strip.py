"""Path trimming of manifests before they are used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sheetloom.functions.paths import PATH_COLUMNS, base_name
from sheetloom.schemas import order_of
from sheetloom.sources.sinks import in_row_order, write_rows
from sheetloom.sources.tables import read_table


def strip_paths(df: DataFrame, columns: Sequence[str] = PATH_COLUMNS) -> DataFrame:
    """Keep only the file name in the path columns that are there; also works on a stream."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: base_name(F.col(c)) for c in present}) if present else df


def _metrics(df: DataFrame, columns: Sequence[str]):
    """Row count, and per path column the place of its first value."""
    present = [c for c in columns if c in df.columns]
    place = F.struct(*order_of(df))
    firsts = [F.min(F.when(F.col(c) != "", place)).alias(c) for c in present]
    return present, [F.count(F.lit(1)).alias("rows_processed"), *firsts]


def strip_metrics(df: DataFrame, columns: Sequence[str] = PATH_COLUMNS) -> DataFrame:
    """One row: ``rows_processed`` and ``path_columns``, those that held a value, by first appearance."""
    present, aggregates = _metrics(df, columns)
    seen = F.array(
        *[
            F.struct(F.col(c).alias("place"), F.lit(i).alias("i"), F.lit(c).alias("name"))
            for i, c in enumerate(present)
        ]
    )
    found = F.array_sort(F.filter(seen, lambda s: s["place"].isNotNull()))
    names = F.array_join(F.transform(found, lambda s: s["name"]), ", ") if present else F.lit("")
    return df.agg(*aggregates).select("rows_processed", names.alias("path_columns"))


def _telling_case_apart(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` in which names that differ by letter case only are two columns."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.caseSensitive", "true")
    return session


def strip_file(
    spark: SparkSession, source: str, target: str, ordered: bool = True, columns: Sequence[str] = PATH_COLUMNS
) -> dict:
    """Strip the path ``columns`` of one manifest into ``target``; cells are otherwise kept as they are, ``NA`` included.

    Columns whose names differ by letter case only are all kept. A row with more cells than the header has names is
    an error. Returns the run metrics, gathered while writing.
    """
    rows = read_table(_telling_case_apart(spark), source, missing=False)
    present, aggregates = _metrics(rows, columns)
    seen = Observation()
    lines = in_row_order(rows) if ordered else rows
    write_rows(strip_paths(lines.observe(seen, *aggregates), columns), target, "errorifexists")
    first = {c: seen.get[c] for c in present if seen.get[c] is not None}
    found = sorted(first, key=lambda c: (tuple(first[c]), present.index(c)))
    return {"rows_processed": seen.get["rows_processed"], "path_columns": found}
