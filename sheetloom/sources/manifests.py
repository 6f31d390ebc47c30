"""Sample manifests and their file tags.

A manifest table has one row per argument position and data file: ``kind`` (``short_read``,
``long_read`` or ``rna``), ``path`` (the argument as given) and ``arg_ord``. Three sheets read the
assay off the files in three different ways; each gets its own column. ``file_ord`` numbers the rows in argument order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.functions import ids
from sheetloom.sources.tables import (
    in_file_order,
    list_files,
    listed_only,
    listing_of,
    read_table,
    scan_files,
)

MANIFEST_TYPE = {
    "file_ord": pa.int32(), "arg_ord": pa.int32(), "sub_ord": pa.int32(), "kind": pa.string(), "path": pa.string(), "file": pa.string(),
}

TAGS = (
    "file_ord", "for_analyte", "analyte_label", "for_file_set", "file_set_type",
    "for_unaligned", "for_aligned", "aligned_type",
)

DATA_COLUMNS = (ids.SAMPLE_ID, "donor_id", "cram_path", "input_bam", "sample_id")
CODEC_COLUMNS = (ids.SAMPLE_ID, "donor_id", "RAW_BAM", "MolConsensusBAM", "vcf")


def manifest(
    spark: SparkSession,
    short_read: Sequence[str] = (),
    long_read: Sequence[str] = (),
    rna: Sequence[str] = (),
    listed: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Manifest table of the three argument lists, in argument order; ``listed`` has their files where they are known."""
    given = [
        *[("short_read", p) for p in short_read],
        *[("long_read", p) for p in long_read],
        *[("rna", p) for p in rna],
    ]
    if not given:
        raise ValueError("give at least one short-read, long-read or RNA file")
    listed = list_files(spark, [p for _, p in given]) if listed is None else listed
    rows = [
        (arg_ord, sub_ord, kind, path, file)
        for arg_ord, (kind, path) in enumerate(given)
        for sub_ord, file in enumerate(listed[path])
    ]
    return listing_of(spark, [(i, *row) for i, row in enumerate(rows)], **MANIFEST_TYPE)


IS_RNA = "kind = 'rna'"
IS_LONG = "contains(lower(path), 'long')"


def _by_name(markers: Sequence[tuple[str, str]], default: str) -> str:
    """SQL for the value of the first marker in the file name."""
    cases = " ".join(f"WHEN contains(lower(path), '{marker}') THEN '{value}'" for marker, value in markers)
    return f"CASE {cases} ELSE '{default}' END"


# What a file name says about its assay, in three readings.
SHORT, LONG = ("short", "WGS_ILLUMINA"), ("long", "WGS_PACBIO")
TRUSEQ, WATCHMAKER = ("truseq", "RNA_TRUSEQ"), ("watchmaker", "RNA_WATCHMAKER")
RNA_BY_TRUSEQ = _by_name([TRUSEQ], "RNA_WATCHMAKER")
ANALYTE_LABEL = f"""CASE kind WHEN 'short_read' THEN 'GDNA_SHORTREAD' WHEN 'long_read' THEN 'GDNA_LONGREAD'
                              ELSE {RNA_BY_TRUSEQ} END"""
FILE_SET_TYPE = f"""CASE WHEN {IS_RNA} THEN {_by_name([WATCHMAKER, TRUSEQ], "RNA_WATCHMAKER")}
                         ELSE {_by_name([SHORT, LONG], "WGS_ILLUMINA")} END"""
ALIGNED_TYPE = f"CASE WHEN {IS_RNA} THEN {RNA_BY_TRUSEQ} ELSE {_by_name([SHORT], 'WGS_PACBIO')} END"


def tag_manifest(files: DataFrame) -> DataFrame:
    """Add the order and assay tags of every manifest row.

    * ``analyte_label`` goes by argument group, RNA by file name. A path given twice is read once,
      at its first position with its last label.
    * ``file_set_type`` goes by file name with Illumina as the default, over DNA files and the first
      RNA argument; a path given twice counts twice.
    * ``aligned_type`` goes by file name with PacBio as the default, leaves out long-read names, and
      reads a path once.
    * ``for_unaligned`` marks DNA files named long-read.

    Windows are per file; the first RNA argument comes from a count of one row per kind.
    """
    firsts = files.groupBy("kind").agg(F.min("arg_ord").alias("first_of_kind"))
    return (
        files.join(firsts, "kind")
        .selectExpr("*", f"{IS_RNA} AND arg_ord = first_of_kind AS first_rna")
        .selectExpr("*", f"first_rna OR NOT ({IS_RNA} OR {IS_LONG}) AS in_aligned")
        .selectExpr(
            *files.columns,
            "arg_ord = min(arg_ord) OVER (PARTITION BY path, file) AS for_analyte",
            f"max_by({ANALYTE_LABEL}, arg_ord) OVER (PARTITION BY path, file) AS analyte_label",
            f"first_rna OR NOT {IS_RNA} AS for_file_set",
            f"{FILE_SET_TYPE} AS file_set_type",
            f"NOT {IS_RNA} AND {IS_LONG} AS for_unaligned",
            "in_aligned AND arg_ord = min(CASE WHEN in_aligned THEN arg_ord END) OVER (PARTITION BY path, file)"
            " AS for_aligned",
            f"max_by({ALIGNED_TYPE}, CASE WHEN in_aligned THEN arg_ord END) OVER (PARTITION BY path, file)"
            " AS aligned_type",
        )
    )


def _with_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    absent = {c: F.lit(None).cast("string") for c in columns if c not in rows.columns}
    return rows.withColumns(absent) if absent else rows


def read_manifests(
    spark: SparkSession,
    short_read: Sequence[str] = (),
    long_read: Sequence[str] = (),
    rna: Sequence[str] = (),
    listed: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """All manifest rows in input order with their file tags; a path given twice fans out."""
    listed = list_files(spark, [*short_read, *long_read, *rna]) if listed is None else listed
    files = tag_manifest(manifest(spark, short_read, long_read, rna, listed)).select("file", *TAGS)
    # FileSet describes a row by ``sample_id``, or by the collaborator sample id where a file has no such
    # column.
    found = {file for group in listed.values() for file in group}
    rows = scan_files(spark, found, columns=DATA_COLUMNS, sample_id=ids.SAMPLE_ID)
    rows = _with_columns(rows, DATA_COLUMNS).select(*DATA_COLUMNS, "file", "block", "pos")
    rows = rows.withColumnRenamed("sample_id", "description")
    # The listing's own size decides whether it is broadcast.
    return listed_only(rows.join(files, "file", "left"), "file_ord").drop("file")


def read_codec(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All CODEC manifest rows in input order."""
    if not paths:
        raise ValueError("give at least one CODEC file")
    listed = list_files(spark, paths)
    files = [file for path in paths for file in listed[path]]
    rows = _with_columns(scan_files(spark, files, columns=CODEC_COLUMNS), CODEC_COLUMNS)
    return in_file_order(rows.select(*CODEC_COLUMNS, "file", "block", "pos"), files)


def read_donors(spark: SparkSession, path: str) -> DataFrame:
    """Donor table (S8): ``donor``, ``gender``, ``age``; further columns are ignored."""
    return read_table(spark, path).select("donor", "gender", "age", "file_ord", "block", "pos")


def read_tissues(spark: SparkSession, path: str) -> DataFrame:
    """Tissue reference (S9) in row order."""
    return read_table(spark, path).select(
        "tissue_identifier_code", "corresponding_tissue", "uberon_id", "file_ord", "block", "pos"
    )
