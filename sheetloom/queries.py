"""Every operator as a query over the star-schema tables, for correctness checks and timing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom import harness
from sheetloom.functions import ids, labels
from sheetloom.functions.paths import PATH_COLUMNS, extension, slash_name
from sheetloom.operators import links, tissues
from sheetloom.operators.ordering import first_by, last_values, merged_rows, running_number
from sheetloom.plans import codec, regular
from sheetloom.plans.bundle import CODEC_EDGES, REGULAR_EDGES, codec_plan, codec_sheets, regular_plan, regular_sheets
from sheetloom.schemas import order_of, plain
from sheetloom.sources.bundles import read_bundle
from sheetloom.sources.manifests import TAGS, tag_manifest
from sheetloom.sources.sinks import block_parts, capitalized, write_bundle
from sheetloom.sources.staging import Sheets, passing_shuffles
from sheetloom.sources.strip import strip_metrics, strip_paths
from sheetloom.sources.tables import missing_to_null, scan_tables


#: Columns of a sample that say what it is and where it stands.
_KEYS = (ids.SAMPLE_ID, "donor_id", "file_ord", "block", "pos")


def _staged(spark, sf, *columns):
    """Samples written once, as the workflows do before several sheets read them, and where to stage more.

    ``columns`` beside the keys name what the sheets of a query read; without any, all are staged.
    """
    staging, rows = harness.staging(spark), harness.samples(spark, sf)
    return staging(rows.select(*_KEYS, *columns) if columns else rows, "samples"), staging


def donor_sheet(spark: SparkSession, sf: str) -> DataFrame:
    return plain(regular.donor_sheet(harness.donors(spark, sf)))


def sample_parts(spark, sf):
    rows = tissues.parse_samples(harness.samples(spark, sf))
    return rows.select("sample_id", "file_ord", "donor_part", "core", "external_id", "suffix")


def rejects(spark, sf):
    return regular.rejects(harness.samples(spark, sf)).select("sample_id", "file_ord", "reason")


def tissue_lookup_fallback(spark, sf):
    rows = tissues.with_tissue(harness.samples(spark, sf), harness.tissue_ref(spark))
    return rows.select(ids.SAMPLE_ID, "core", "label", labels.category(F.col("label")).alias("category"))


def tissue_join_fanout(spark, sf):
    rows = regular.identified(harness.samples(spark, sf))
    return tissues.tissue_fanout(rows, harness.tissue_ref(spark))


def tissue_sheet(spark, sf):
    return plain(regular.tissue_sheet(harness.samples(spark, sf), harness.tissue_ref(spark)))


def tissue_sample_sheet(spark, sf):
    return plain(regular.tissue_sample_sheet(harness.samples(spark, sf), harness.tissue_ref(spark)))


def analyte_sheet(spark, sf):
    (samples, _), ref = _staged(spark, sf, "for_analyte", "analyte_label"), harness.tissue_ref(spark)
    rows = regular.analyte_rows(samples, ref)
    return plain(regular.analyte_sheet(rows))


def library_numbers(spark, sf):
    (samples, _), ref = _staged(spark, sf, "for_analyte", "analyte_label"), harness.tissue_ref(spark)
    return plain(regular.library_sheet(regular.analyte_rows(samples, ref)))


def sequencing_sheet(spark, sf):
    return plain(regular.sequencing_sheet(harness.manifest(spark, sf)))


def software_sheet(spark, sf):
    return plain(regular.software_sheet(harness.manifest(spark, sf)))


def fileset_numbers(spark, sf):
    rows = regular.file_set_rows(harness.samples(spark, sf), harness.tissue_ref(spark))
    numbered = running_number(rows, ["file_set_group"], "number")
    return numbered.select("file_set_group", "number", "description")


def appended_numbers(spark, sf):
    """W2 in two runs: the first two files, then the other two after the numbers that the first run stored."""
    ref, staging = harness.tissue_ref(spark), harness.staging(spark)
    samples = staging(harness.samples(spark, sf).select(*_KEYS, "description", "for_file_set", "file_set_type"), "samples")
    first = regular.file_set_rows(samples.where("file_ord < 2"), ref)
    later = regular.file_set_rows(samples.where("file_ord >= 2"), ref)
    stored = staging(regular.file_set_numbers(first), "numbers")
    runs = [running_number(first, ["file_set_group"], "number"), running_number(later, ["file_set_group"], "number", stored)]
    return runs[0].unionByName(runs[1]).select("file_set_group", "number", "description")


def merge_audit(spark, sf):
    """A2: rows that keep-first drops, by sheet: how many, for how many kept rows, and how many stand in another file."""
    (samples, _), ref = _staged(spark, sf, "for_analyte", "analyte_label"), harness.tissue_ref(spark)
    sheets = {
        "Tissue": regular.tissue_rows(samples, ref),
        "TissueSample": regular.tissue_sample_rows(samples, ref),
        "Analyte": regular.analyte_rows(samples, ref),
    }
    found = []
    for name, rows in sheets.items():
        lost = merged_rows(rows.select("submitted_id", *order_of(rows)), "submitted_id")
        found.append(
            lost.agg(
                F.count(F.lit(1)).alias("merged"),
                F.count_distinct("submitted_id").alias("kept"),
                F.count_if(F.col("file_ord") != F.col("kept_file_ord")).alias("from_other_file"),
            ).select(F.lit(name).alias("sheet"), "merged", "kept", "from_other_file")
        )
    return reduce(DataFrame.unionByName, found)


def bundle_read_back(spark, sf):
    """Sheets written as a bundle and read back; rows and filled cells of each, and its last id in row order."""
    staging = harness.staging(spark)
    samples, ref = staging(harness.samples(spark, sf).select(*_KEYS), "samples"), harness.tissue_ref(spark)
    sheets = {
        "Donor": regular.donor_sheet(harness.donors(spark, sf)),
        "Tissue": regular.tissue_sheet(samples, ref),
        "TissueSample": regular.tissue_sample_sheet(samples, ref),
        "Sequencing": regular.sequencing_sheet(harness.manifest(spark, sf)),
        "UnalignedReads": codec.codec_unaligned_reads_sheet(spark),
    }
    root = staging.path("bundle")
    write_bundle(Sheets(sheets, parts=staging(block_parts(samples), "parts")), root)
    found = []
    for i, (name, sheet) in enumerate(read_bundle(spark, root).items()):
        place = F.struct(*order_of(sheet))
        cells = [F.count(c) for c in sheet.columns if c not in order_of(sheet)]
        found.append(
            sheet.agg(
                F.count(F.lit(1)).alias("n_rows"), reduce(lambda a, b: a + b, cells).alias("n_cells"),
                F.max_by("submitted_id", place).alias("last_id"),
            ).select(F.lit(i).alias("sheet_order"), F.lit(name).alias("sheet"), "n_rows", "n_cells", "last_id")
        )
    return reduce(DataFrame.unionByName, found)


def _written(rows, folder, *columns):
    """Rows as a directory of tab-separated files in row order; its path."""
    ordered = rows.orderBy(*order_of(rows)).select(*columns)
    with passing_shuffles(rows.sparkSession):
        ordered.write.option("sep", "\t").option("header", True).option("escape", '"').csv(folder)
    return folder


def _dimensions(spark, sf, folder):
    """Donor table and tissue reference as files."""
    ref = harness.tissue_ref(spark).coalesce(1)
    return (
        _written(harness.donors(spark, sf), f"{folder}/donors", "donor", "gender", "age"),
        _written(ref, f"{folder}/tissues", "tissue_identifier_code", "corresponding_tissue", "uberon_id"),
    )


#: Columns of a sheet that some row fills, by workflow and sheet.
_FILLED = {
    "Donor": "submitted_id age external_id sex tpc_submitted",
    "Tissue": "submitted_id external_id donor uberon_id",
    "TissueSample": "submitted_id category external_id sample_sources",
    "Analyte": "submitted_id molecule molecule_detail external_id samples",
}
REGULAR_FILLED = _FILLED | {
    "Library": "submitted_id analytes assay",
    "FileSet": "submitted_id description libraries sequencing",
    "UnalignedReads": "submitted_id filename description file_format file_sets",
    "AlignedReads": "submitted_id filename description alignment_details file_format file_sets reference_genome software",
    "Sequencing": "submitted_id read_type target_read_length flow_cell target_coverage target_read_count sequencer",
    "Software": "submitted_id category title version",
}
CODEC_FILLED = _FILLED | {
    "Library": "submitted_id analytes assay library_preparation",
    "FileSet": "submitted_id libraries sequencing",
    "AlignedReads": "submitted_id filename description alignment_details file_format file_sets reference_genome software data_category derived_from",
    "VariantCalls": "submitted_id data_category data_type filename description file_format file_sets reference_genome derived_from software",
    "UnalignedReads": "submitted_id",
    "Sequencing": "submitted_id read_type target_read_length target_coverage sequencer",
    "Software": "submitted_id category title version",
    "LibraryPreparation": "submitted_id description",
}


def _summed_up(sheets, filled, staging):
    """Rows of every sheet, and the sum of a checksum over its filled columns.

    One sheet after the other is read, so that the disk holds the shuffles of one at a time.
    """

    def of(name, columns):
        digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns.split()]).cast("binary"))
        checksum = F.sum(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"))
        counted = sheets[name].agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(checksum, F.lit(0)).alias("checksum"))
        return staging(counted.select(F.lit(name).alias("sheet"), "n_rows", "checksum"), f"sum_{name}")

    return reduce(DataFrame.unionByName, [of(*item) for item in filled.items()])


def regular_from_files(spark, sf):
    """The regular workflow over manifests, donors and tissues that were written as files."""
    staging = harness.staging(spark)
    columns = ("sample_id", "cram_path", "donor_id", ids.SAMPLE_ID, "input_bam")
    folder, rows = staging.path("in"), staging(harness.manifest_rows(spark, sf).select(*columns, "file_ord", "block", "pos"), "rows")
    donors, ref = _dimensions(spark, sf, folder)
    names = ("short_read", "long_read", "rna_watchmaker", "rna_truseq")
    paths = [_written(rows.where(F.col("file_ord") == i), f"{folder}/{name}", *columns) for i, name in enumerate(names)]
    staging.drop("rows")
    sheets = regular_sheets(spark, donors, ref, paths[:1], paths[1:2], paths[2:], folder=staging.path("sheets"))
    for name in names:  # their rows are staged
        staging.drop(f"in/{name}")
    return _summed_up(sheets, REGULAR_FILLED, staging)


def codec_from_files(spark, sf):
    """The CODEC workflow over files."""
    staging = harness.staging(spark)
    columns = ("sample_id", ids.SAMPLE_ID, "MolConsensusBAM", "RAW_BAM", "donor_id", "vcf")
    folder, rows = staging.path("in"), staging(harness.codec_samples(spark, sf).select(*columns, "file_ord", "block", "pos"), "rows")
    donors, ref = _dimensions(spark, sf, folder)
    path = _written(rows, f"{folder}/codec", *columns)
    staging.drop("rows")
    sheets = codec_sheets(spark, donors, ref, [path], folder=staging.path("sheets"))
    staging.drop("in/codec")  # its rows are staged
    return _summed_up(sheets, CODEC_FILLED, staging)


def fileset_sheet_linked(spark, sf):
    columns = ("description", "for_analyte", "analyte_label", "for_file_set", "file_set_type")
    (samples, _), ref = _staged(spark, sf, *columns), harness.tissue_ref(spark)
    # read once, for the sizes of Library groups, so that only what these need is derived and nothing is written
    return plain(regular.file_set_sheet(samples, ref, regular.analyte_rows(samples, ref)))


def unaligned_reads(spark, sf):
    samples, ref = harness.samples(spark, sf), harness.tissue_ref(spark)
    return plain(regular.unaligned_reads_sheet(samples, ref))


def aligned_reads_linked(spark, sf):
    columns = ("cram_path", "description", "for_aligned", "aligned_type", "for_file_set", "file_set_type")
    (samples, _), ref = _staged(spark, sf, *columns), harness.tissue_ref(spark)
    return plain(regular.aligned_reads_sheet(samples, ref))


def file_names(spark, sf):
    """Name by slash and extension of every CRAM path."""
    name = slash_name(F.col("cram_path"))
    rows = harness.samples(spark, sf).where(F.col("cram_path").isNotNull())
    return rows.select("sample_id", name.alias("filename"), extension(name).alias("file_format"))


def strip_path_columns(spark, sf):
    rows = harness.manifest_rows(spark, sf).select("sample_id", *PATH_COLUMNS)
    return plain(strip_paths(rows))


def strip_path_metrics(spark, sf):
    return strip_metrics(harness.manifest_rows(spark, sf))


def keep_first_dedup(spark, sf):
    rows = harness.samples(spark, sf).where(F.col(ids.SAMPLE_ID).isNotNull())
    kept = first_by(rows.select(ids.SAMPLE_ID, "sample_id", "cram_path", *order_of(rows)), ids.SAMPLE_ID)
    return plain(kept)


def last_wins_lookup(spark, sf):
    rows = harness.samples(spark, sf)
    return plain(last_values(rows, ids.SAMPLE_ID, "sample_id", "cram_path"))


def hot_group_numbers(spark, sf):
    """W1 on groups that each hold a large share of all rows: tissue labels."""
    rows = tissues.with_tissue(harness.samples(spark, sf), harness.tissue_ref(spark))
    rows = rows.select("label", "sample_id", *order_of(rows))
    numbered = running_number(rows, ["label"], "number")
    return numbered.select("label", "sample_id", "number")


def heterogeneous_union(spark, sf):
    """The four files, written with columns of their own in an order of their own, read as one table."""
    rows = harness.samples(spark, sf)
    common = ["donor_id", ids.SAMPLE_ID]
    columns = {
        0: ["sample_id", "cram_path", *common],
        1: ["sample_id", *common, "input_bam"],
        2: [*common, "cram_path"],
        3: ["cram_path", *common],
    }
    folder = harness.staging(spark).path("manifests")
    for i, chosen in columns.items():
        part = rows.where(F.col("file_ord") == i).select(chosen)
        part.write.option("sep", "\t").option("header", True).option("escape", '"').csv(f"{folder}/{i}")
    taken = ["sample_id", "cram_path", *common, "input_bam"]
    return scan_tables(spark, [f"{folder}/*"], columns=taken, sample_id=ids.SAMPLE_ID).select(taken)


def uneven_rows(spark, sf):
    """Lines of uneven length, with stray, doubled and enclosing quotes, under two headers; no cell is lost."""
    note = """CASE l_partkey % 5 WHEN 0 THEN concat(l_suppkey, '" tube') WHEN 1 THEN concat('"a\\t', l_suppkey, '"')
                   WHEN 2 THEN '"say ""x"" so"' WHEN 3 THEN concat('"in"', l_suppkey) ELSE string(l_suppkey) END"""
    rest = """CASE l_linenumber WHEN 3 THEN '' WHEN 5 THEN concat('\\t', note, '\\tx', l_suppkey, '\\t\\tNA')
                   WHEN 6 THEN concat('\\t', note, '\\t\\t') ELSE concat('\\t', note) END"""
    lines = harness.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey % 2 AS part", f"{note} AS note", "l_linenumber", "l_suppkey", "concat_ws('-', 'SM', l_orderkey, l_linenumber) AS sample"
    )
    folder = harness.staging(spark).path("uneven")
    for part, header in enumerate(("sample_id\tnote", "sample_id\tremark")):
        text = lines.where(F.col("part") == part).select(F.expr(f"concat(sample, {rest})").alias(header))
        as_is = text.write.option("header", True).option("quote", "").option("ignoreTrailingWhiteSpace", False)
        as_is.csv(f"{folder}/{part}")
    rows = scan_tables(spark, [f"{folder}/*"], columns=["sample_id", "note", "remark"], surplus="keep")
    return rows.select("sample_id", "note", "remark", F.array_join("surplus", "|").alias("surplus"))


def assay_tags(spark, sf):
    """Manifest tags of file names that the rows of ``supplier`` and ``part`` spell out."""
    words = F.array(*[F.lit(w) for w in ("Short", "long", "x", "Watchmaker", "TruSeq")])
    kinds = F.array(*[F.lit(k) for k in ("short_read", "long_read", "rna")])
    key = F.col("p_partkey")
    path = F.concat(
        F.lit("in/"),
        F.get(words, (key % 5).cast("int")),
        F.lit("_"),
        (key % 11).cast("string"),
        F.lit("_"),
        F.get(words, (F.shiftright(key, 3) % 5).cast("int")),
        F.lit(".tsv"),
    )
    given = harness.table(spark, sf, "part").select(
        F.get(kinds, (F.shiftright(key, 2) % 3).cast("int")).alias("kind"), path.alias("path")
    )
    # One manifest per kind and path: the tables only spell out which names occur.
    distinct = given.distinct()
    listed = distinct.select(
        (F.row_number().over(_by_kind_and_path()) - 1).alias("file_ord"),
        (F.row_number().over(_by_kind_and_path()) - 1).alias("arg_ord"),
        F.lit(0).alias("sub_ord"),
        "kind",
        "path",
        F.col("path").alias("file"),
    )
    return tag_manifest(listed).drop("sub_ord", "file").withColumnRenamed("file_ord", "position")


def _by_kind_and_path():
    from pyspark.sql import Window

    rank = F.when(F.col("kind") == "short_read", 0).when(F.col("kind") == "long_read", 1).otherwise(2)
    return Window.orderBy(rank, "path")


def missing_cells(spark, sf):
    """Cells of missing-value tokens become blank."""
    tokens = F.array(*[F.lit(t) for t in ("NA", "nan", "N/A", "none", "null", "Na", "x", "#N/A")])
    cell = F.get(tokens, (F.col("o_custkey") % 8).cast("int"))
    rows = harness.table(spark, sf, "orders").select("o_orderkey", cell.alias("cell"))
    return missing_to_null(rows, ["cell"])


def capitalized_cells(spark, sf):
    """K5: first letter upper, the rest lower."""
    rows = harness.table(spark, sf, "customer")
    return rows.select("c_custkey", capitalized(F.col("c_mktsegment")).alias("segment"))


def _codec_analytes(spark, sf):
    samples, ref = harness.codec_samples(spark, sf), harness.tissue_ref(spark)
    return codec.codec_analyte_rows(codec.codec_tissue_sample_sheet(samples, ref), ref)


def codec_tissue(spark, sf):
    return plain(codec.codec_tissue_sheet(harness.codec_samples(spark, sf), harness.tissue_ref(spark)))


def codec_tissue_sample(spark, sf):
    return plain(codec.codec_tissue_sample_sheet(harness.codec_samples(spark, sf), harness.tissue_ref(spark)))


def codec_analyte(spark, sf):
    return plain(codec.codec_analyte_sheet(_codec_analytes(spark, sf)))


def codec_library(spark, sf):
    return plain(codec.codec_library_sheet(_codec_analytes(spark, sf)))


def codec_fileset(spark, sf):
    return plain(codec.codec_file_set_sheet(_codec_analytes(spark, sf)))


def codec_aligned_reads(spark, sf):
    return plain(codec.codec_aligned_reads_sheet(harness.codec_samples(spark, sf), harness.tissue_ref(spark)))


def codec_variant_calls(spark, sf):
    return plain(codec.codec_variant_calls_sheet(harness.codec_samples(spark, sf), harness.tissue_ref(spark)))


def _codec_sheets(spark, sf):
    staging = harness.staging(spark)
    samples = staging(harness.codec_samples(spark, sf).select(*_KEYS, *_CODEC), "samples")
    return codec_plan(samples, harness.tissue_ref(spark), harness.donors(spark, sf), staging=staging)


def codec_constants(spark, sf):
    """The constant rows with the number of sheet rows that cite each."""
    sheets = _codec_sheets(spark, sf)
    citing = [
        ("AlignedReads", "software"),
        ("VariantCalls", "software"),
        ("FileSet", "sequencing"),
        ("Library", "library_preparation"),
    ]
    cited = [sheets[s].groupBy(F.col(c).alias("submitted_id")).agg(F.count("*").alias("n")) for s, c in citing]
    counts = reduce(DataFrame.unionByName, cited)
    constants = [
        plain(sheets[s]).withColumn("sheet", F.lit(s)) for s in ("Software", "Sequencing", "LibraryPreparation")
    ]
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), constants)
    cited = counts.groupBy("submitted_id").agg(F.sum("n").alias("cited"))
    return table.join(cited, "submitted_id", "left").withColumn("cited", F.coalesce("cited", F.lit(0)))


def codec_two_protocols(spark, sf):
    """The Library sheet of two protocols."""
    sheet = codec.codec_library_sheet(_codec_analytes(spark, sf), protocols=("DDBTP", "SECOND"))
    return plain(sheet).select("submitted_id", "analytes", "library_preparation")


def sheet_order(spark, sf):
    """O1: the order columns that a sheet carries to the sink."""
    sheet = regular.tissue_sample_sheet(harness.samples(spark, sf), harness.tissue_ref(spark))
    return sheet.select("submitted_id", "file_ord", "block")


#: Columns of a sample that the regular sheets read, and those that the CODEC sheets read.
_REGULAR = ("description", "cram_path", "input_bam", *TAGS[1:])
_CODEC = ("RAW_BAM", "MolConsensusBAM", "vcf")


def dangling_links(spark, sf):
    samples, staging = _staged(spark, sf, *_REGULAR)
    ref, donors, manifest = harness.tissue_ref(spark), harness.donors(spark, sf), harness.manifest(spark, sf)
    return links.dangling_links(regular_plan(samples, ref, donors, manifest, staging=staging), REGULAR_EDGES, staging)


def codec_dangling_links(spark, sf):
    return links.dangling_links(_codec_sheets(spark, sf), CODEC_EDGES)


def duplicate_reads(spark, sf):
    """Read ids that stand on more than one row. Ids need no look at the file sets."""
    (samples, _), ref = _staged(spark, sf, "input_bam", "cram_path", "for_unaligned", "for_aligned", "aligned_type"), harness.tissue_ref(spark)
    unaligned = regular.unaligned_reads_sheet(samples, ref).select("submitted_id")
    aligned = regular.aligned_reads_rows(samples, ref).select("submitted_id")
    return links.duplicate_ids(unaligned.unionByName(aligned))


def tissue_sample_collisions(spark, sf):
    """TissueSample ids that several samples share, so that all but one sample lose their row."""
    rows = regular.tissue_sample_rows(harness.samples(spark, sf), harness.tissue_ref(spark))
    return links.collisions(rows, "external_id")


QUERIES = {
    "donor_sheet": donor_sheet,
    "sample_parts": sample_parts,
    "rejects": rejects,
    "tissue_lookup_fallback": tissue_lookup_fallback,
    "tissue_join_fanout": tissue_join_fanout,
    "tissue_sheet": tissue_sheet,
    "tissue_sample_sheet": tissue_sample_sheet,
    "analyte_sheet": analyte_sheet,
    "library_numbers": library_numbers,
    "sequencing_sheet": sequencing_sheet,
    "software_sheet": software_sheet,
    "fileset_numbers": fileset_numbers,
    "appended_numbers": appended_numbers,
    "merge_audit": merge_audit,
    "bundle_read_back": bundle_read_back,
    "regular_from_files": regular_from_files,
    "codec_from_files": codec_from_files,
    "fileset_sheet_linked": fileset_sheet_linked,
    "unaligned_reads": unaligned_reads,
    "aligned_reads_linked": aligned_reads_linked,
    "file_names": file_names,
    "strip_paths": strip_path_columns,
    "strip_metrics": strip_path_metrics,
    "keep_first_dedup": keep_first_dedup,
    "last_wins_lookup": last_wins_lookup,
    "hot_group_numbers": hot_group_numbers,
    "heterogeneous_union": heterogeneous_union,
    "uneven_rows": uneven_rows,
    "assay_tags": assay_tags,
    "missing_cells": missing_cells,
    "capitalized_cells": capitalized_cells,
    "codec_tissue": codec_tissue,
    "codec_tissue_sample": codec_tissue_sample,
    "codec_analyte": codec_analyte,
    "codec_library": codec_library,
    "codec_fileset": codec_fileset,
    "codec_aligned_reads": codec_aligned_reads,
    "codec_variant_calls": codec_variant_calls,
    "codec_constants": codec_constants,
    "codec_two_protocols": codec_two_protocols,
    "sheet_order": sheet_order,
    "dangling_links": dangling_links,
    "codec_dangling_links": codec_dangling_links,
    "duplicate_reads": duplicate_reads,
    "tissue_sample_collisions": tissue_sample_collisions,
}
