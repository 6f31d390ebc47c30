"""Sheets of the regular workflow.

``samples`` is what :func:`sheetloom.sources.manifests.read_manifests` returns: one row per manifest row
and argument position, with the file tags next to the data columns. ``ref`` is the tissue
reference. Every builder keeps the order columns so that the sink can write rows in input order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom import schemas
from sheetloom.functions import ids, labels, paths
from sheetloom.operators.links import group_sizes, link
from sheetloom.operators.ordering import first_by, last_numbers, running_number
from sheetloom.operators.skew import semi_join
from sheetloom.operators.tissues import parse_samples, tissue_variants, with_tissue
from sheetloom.schemas import conform

PREFIX = "BROAD"

# Fixed values of the regular read and software sheets.
DRAGEN = "BROAD_SOFTWARE_DRAGEN_07.021.604.3.7.8"
DRAGEN_VERSION = "07.021.604.3.7.8"
REFERENCE_GENOME = "broad_grch38"

# The Sequencing rows by the input that calls for them, in sheet order.
SEQUENCING_ROWS = (
    ("long_read", "BROAD_SEQUENCING_PACBIO_15000BP_20X", "Single-end", 15000, None, 20, None, "pacbio_revio_hifi"),
    ("short_read", "BROAD_SEQUENCING_NOVASEQXPLUS_25B_150BP_160X", "Paired-end", 150, "25B", 160, None,
     "illumina_novaseq_x_plus"),
    ("rna_watchmaker", "BROAD_SEQUENCING_NOVASEQX_25B_145BP_100M", "Paired-end", 145, "25B", None, 100000000,
     "illumina_novaseq_x_plus"),
)
SEQUENCING_ROW_TYPE = (
    "need string, submitted_id string, read_type string, target_read_length int, flow_cell string, "
    "target_coverage int, target_read_count int, sequencer string"
)


def donor_sheet(donors: DataFrame) -> DataFrame:
    """Every donor of the donor table, with or without samples."""
    return conform(
        donors,
        schemas.DONOR,
        submitted_id=ids.donor_id(F.coalesce(F.col("donor").cast("string"), F.lit("nan"))),
        age=F.col("age"),
        external_id=F.col("donor"),
        sex=F.col("gender"),
        tpc_submitted="True",
    )


def filled(samples: DataFrame, *columns: str) -> DataFrame:
    """Rows with a value in every column, as plain null tests that reach the scan."""
    return samples.where(" AND ".join(f"{c} IS NOT NULL" for c in columns))


def identified(samples: DataFrame) -> DataFrame:
    """Rows that name both a sample and a donor."""
    return filled(samples, ids.SAMPLE_ID, "donor_id")


def tissue_rows(samples: DataFrame, ref: DataFrame, upper_external: bool = True) -> DataFrame:
    """Tissue rows before dedup: one per sample row and distinct label of its code."""
    parsed = parse_samples(identified(samples)).drop("item")
    joined = parsed.join(tissue_variants(ref), "core", "left")
    tissue = ids.tissue_id(F.col("external_id"), F.col("variant"), upper_external)
    return joined.withColumns({"submitted_id": tissue, "donor": ids.donor_id(F.col("donor_id"))})


def tissue_sheet(samples: DataFrame, ref: DataFrame, upper_external: bool = True) -> DataFrame:
    """R2 (C2 with ``upper_external=False``): one row per tissue id, taken from its first sample."""
    rows = tissue_rows(samples, ref, upper_external)
    narrow = rows.select("submitted_id", "external_id", "donor", "uberon_id", *schemas.order_of(rows))
    return conform(
        first_by(narrow, "submitted_id"),
        schemas.TISSUE,
        submitted_id=F.col("submitted_id"),
        external_id=F.col("external_id"),
        donor=F.col("donor"),
        uberon_id=F.col("uberon_id"),
    )


def with_sample_ids(rows: DataFrame, ref: DataFrame, prefix: str, codec: bool = False) -> DataFrame:
    """Add ``sample_label``, ``category``, ``tissue_sample`` and ``sample_source`` to parsed samples.

    Both ids are functions of the sample id and its code, so nothing is looked up in the
    Tissue sheet (J3, J5). The CODEC workflow reads the label off the Tissue sheet (J4).
    """
    own_label = labels.tissue_label(F.col("core"))
    label = F.coalesce("source_label", own_label) if codec else F.col("label")
    return (
        with_tissue(rows, ref)
        .withColumns({
            "sample_label": label,
            "category": labels.category(label),
            "sample_source": ids.tissue_id(F.col("external_id"), F.col("source_label"), not codec),
        })
        .withColumn(
            "tissue_sample",
            ids.tissue_sample_id(
                prefix, F.col("donor_part"), F.col("sample_label"), F.col("suffix"), F.col("category")
            ),
        )
    )


def tissue_sample_rows(
    samples: DataFrame, ref: DataFrame, prefix: str = PREFIX, codec: bool = False
) -> DataFrame:
    """TissueSample rows before dedup."""
    rows = with_sample_ids(identified(samples), ref, prefix, codec)
    return rows.select(
        F.col("tissue_sample").alias("submitted_id"),
        "category",
        F.col(ids.SAMPLE_ID).alias("external_id"),
        F.col("sample_source").alias("sample_sources"),
        *schemas.order_of(rows),
    )


def tissue_sample_sheet(
    samples: DataFrame, ref: DataFrame, prefix: str = PREFIX, codec: bool = False
) -> DataFrame:
    """R3 (C3 with ``codec=True``)."""
    return conform(
        first_by(tissue_sample_rows(samples, ref, prefix, codec), "submitted_id"),
        schemas.TISSUE_SAMPLE,
        submitted_id=F.col("submitted_id"),
        category=F.col("category"),
        external_id=F.col("external_id"),
        sample_sources=F.col("sample_sources"),
    )


def known_samples(samples: DataFrame) -> DataFrame:
    """Rows whose sample is known, that is named together with a donor on some row.

    A row with a donor proves itself; only the rows without one have to be looked up.
    """
    named = parse_samples(samples.where("for_analyte"))
    donorless = named.where(F.col("donor_id").isNull())
    known = identified(samples).select(ids.SAMPLE_ID).distinct()
    found = semi_join(donorless, known, ids.SAMPLE_ID)
    return named.where(F.col("donor_id").isNotNull()).unionByName(found)


def _analyte_columns(rows: DataFrame, ref: DataFrame, prefix: str) -> DataFrame:
    minted = ids.analyte_id(
        prefix, F.col("donor_part"), F.col("label"), F.col("suffix"), F.col("analyte_label")
    )
    tagged = with_sample_ids(rows, ref, prefix).withColumn("analyte", minted)
    return tagged.select(
        F.col("analyte").alias("submitted_id"),
        "donor_part",
        "label",
        labels.library_type(F.col("analyte")).alias("library_type"),
        labels.molecule(F.col("analyte_label")).alias("molecule"),
        labels.molecule_detail(F.col("analyte_label")).alias("molecule_detail"),
        F.col(ids.SAMPLE_ID).alias("external_id"),
        F.col("tissue_sample").alias("samples"),
        *schemas.order_of(tagged),
    )


def analyte_rows(samples: DataFrame, ref: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """R4 before dedup: one row per known sample row; a file given twice counts once.

    Analyte, Library and FileSet all start from these rows, so a workflow stages them.
    """
    return _analyte_columns(known_samples(samples), ref, prefix)


def analyte_sheet(rows: DataFrame) -> DataFrame:
    """First row of every analyte id."""
    return conform(
        first_by(rows, "submitted_id"),
        schemas.ANALYTE,
        submitted_id=F.col("submitted_id"),
        molecule=F.col("molecule"),
        molecule_detail=F.col("molecule_detail"),
        external_id=F.col("external_id"),
        samples=F.col("samples"),
    )


LIBRARY_GROUP = ("donor_part", "label", "library_type")


def library_sheet(rows: DataFrame, prefix: str = PREFIX, after: DataFrame | None = None) -> DataFrame:
    """One row per analyte row before dedup, numbered per donor, tissue and library type.

    ``after``, what :func:`library_numbers` gave for the rows of earlier runs, continues their numbers.
    """
    narrow = rows.select(*LIBRARY_GROUP, "submitted_id", *schemas.order_of(rows))
    numbered = running_number(narrow, LIBRARY_GROUP, "number", after)
    minted = ids.library_id(
        prefix, F.col("donor_part"), F.col("label"), F.col("library_type"), F.col("number").cast("string")
    )
    return conform(
        numbered,
        schemas.LIBRARY,
        submitted_id=minted,
        analytes=F.col("submitted_id"),
        assay=labels.assay(F.col("library_type")),
    )


def library_numbers(rows: DataFrame, after: DataFrame | None = None) -> DataFrame:
    """Last Library number of every group, to be stored for a run over files that come later."""
    return last_numbers(rows, LIBRARY_GROUP, after)


def library_sizes(rows: DataFrame, after: DataFrame | None = None) -> DataFrame:
    """How far Library numbers run, by the part of the id between entity and number."""
    stem = F.upper(F.replace(F.concat_ws("_", *LIBRARY_GROUP), F.lit(" "), F.lit("-")))
    return group_sizes(rows, LIBRARY_GROUP, stem, after)


def file_set_rows(samples: DataFrame, ref: DataFrame) -> DataFrame:
    """Rows the FileSet sheet is made of: DNA files and the first RNA file, donors null or not (P5).

    Groups are keyed by the joined text of donor, label and type, with ``nan`` for a missing donor.
    """
    rows = with_tissue(samples.where("for_file_set"), ref)
    donor = F.coalesce("donor_id", F.lit("nan"))
    return rows.select(
        F.concat_ws("_", donor, "label", "file_set_type").alias("file_set_group"),
        F.col("file_set_type").alias("library_type"),
        "description",
        *schemas.order_of(rows),
    )


def file_set_numbers(rows: DataFrame, after: DataFrame | None = None) -> DataFrame:
    """Last FileSet number of every group, to be stored for a run over files that come later."""
    return last_numbers(rows, ["file_set_group"], after)


def file_set_sizes(rows: DataFrame, after: DataFrame | None = None) -> DataFrame:
    """How far FileSet numbers run."""
    return group_sizes(rows, ["file_set_group"], F.upper("file_set_group"), after)


def file_set_sheet(
    samples: DataFrame,
    ref: DataFrame,
    analytes: DataFrame,
    prefix: str = PREFIX,
    after: DataFrame | None = None,
    library_after: DataFrame | None = None,
    rows: DataFrame | None = None,
) -> DataFrame:
    """Numbered per donor, tissue and type (W2), linked to the Library rows of ``analytes``.

    ``after`` and ``library_after`` are the last FileSet and Library numbers of earlier runs; ``rows`` are the
    :func:`file_set_rows` where they are at hand.
    """
    rows = running_number(file_set_rows(samples, ref) if rows is None else rows, ["file_set_group"], "number", after)
    rows = rows.withColumn("stem", F.upper("file_set_group"))
    number = F.col("number").cast("string")
    library = ids.mint(prefix, "LIBRARY", F.col("stem"), number)
    linked = link(rows, library_sizes(analytes, library_after), "number", library, "library")
    return conform(
        linked,
        schemas.FILE_SET,
        submitted_id=ids.mint(prefix, "FILE-SET", F.col("stem"), number),
        description=F.col("description"),
        libraries=F.col("library"),
        sequencing=labels.sequencing_id(F.col("library_type")),
    )


def unaligned_reads_sheet(samples: DataFrame, ref: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """One row per BAM of the files named long-read, numbered per sample id.

    The file set is constructed from the same number and not checked (J9).
    """
    bams = filled(samples.where("for_unaligned"), ids.SAMPLE_ID, "input_bam")
    rows = with_tissue(bams, ref)
    rows = rows.select(
        ids.SAMPLE_ID, "donor_part", "label", F.col("input_bam").cast("string"), *schemas.order_of(rows)
    )
    numbered = running_number(rows, [ids.SAMPLE_ID], "number")
    donor, label, number = F.col("donor_part"), F.col("label"), F.col("number").cast("string")
    return conform(
        numbered,
        schemas.UNALIGNED_READS,
        submitted_id=ids.unaligned_reads_id(prefix, donor, label, number),
        filename=F.col("input_bam"),
        description=F.col(ids.SAMPLE_ID),
        file_format="bam",
        file_sets=ids.mint(prefix, "FILE-SET", donor, label, F.lit("WGS_PACBIO"), number),
    )


def aligned_reads_rows(samples: DataFrame, ref: DataFrame, prefix: str = PREFIX) -> DataFrame:
    """One row per CRAM with its id, numbered over the rows that have one (W4); its file set is not looked up yet."""
    crams = filled(samples.where("for_aligned"), ids.SAMPLE_ID, "cram_path")
    rows = with_tissue(crams, ref)
    rows = rows.select(
        "donor_part", "label", "aligned_type", ids.SAMPLE_ID, "cram_path", *schemas.order_of(rows)
    )
    numbered = running_number(rows, ["donor_part", "label", "aligned_type"], "number")
    minted = ids.aligned_reads_id(
        prefix, F.col("donor_part"), F.col("label"), F.col("aligned_type"), F.col("number")
    )
    return numbered.withColumn("submitted_id", minted)


def aligned_reads_sheet(
    samples: DataFrame, ref: DataFrame, prefix: str = PREFIX, file_sets: DataFrame | None = None
) -> DataFrame:
    """One row per CRAM, linked to FileSet.

    ``file_sets`` are the :func:`file_set_rows` where they are at hand.
    """
    rows = aligned_reads_rows(samples, ref, prefix)
    numbered = rows.withColumn("stem", F.upper(F.concat_ws("_", "donor_part", "label", "aligned_type")))
    file_set = ids.mint(prefix, "FILE-SET", F.col("stem"), F.col("number").cast("string"))
    sizes = file_set_sizes(file_set_rows(samples, ref) if file_sets is None else file_sets)
    linked = link(numbered, sizes, "number", file_set, "file_set")
    name = paths.slash_name(F.col("cram_path"))
    return conform(
        linked,
        schemas.ALIGNED_READS,
        submitted_id=F.col("submitted_id"),
        filename=name,
        description=F.col(ids.SAMPLE_ID),
        alignment_details="Sorted",
        file_format=paths.extension(name),
        file_sets=F.col("file_set"),
        reference_genome=REFERENCE_GENOME,
        software=DRAGEN,
    )


def _needs(manifest: DataFrame) -> DataFrame:
    """What the given files call for, as distinct ``need`` values."""
    is_rna = F.col("kind") == "rna"
    watchmaker = F.when(is_rna & F.contains(F.lower("path"), F.lit("watchmaker")), F.lit("rna_watchmaker"))
    dragen = F.when(F.col("kind").isin("short_read", "rna"), F.lit("dragen"))
    needs = F.filter(F.array("kind", watchmaker, dragen), lambda n: n.isNotNull())
    return manifest.select(F.explode(needs).alias("need")).distinct()


def sequencing_sheet(manifest: DataFrame) -> DataFrame:
    """The constant Sequencing rows that the given files call for."""
    spark = manifest.sparkSession
    rows = spark.createDataFrame(
        [(0, 0, i, *row) for i, row in enumerate(SEQUENCING_ROWS)],
        f"file_ord int, block long, pos long, {SEQUENCING_ROW_TYPE}",
    )
    found = F.broadcast(rows).join(_needs(manifest), "need", "left_semi")
    given = [c for c in schemas.SEQUENCING.names if c in rows.columns]
    return conform(found, schemas.SEQUENCING, **{c: F.col(c) for c in given})


def software_sheet(manifest: DataFrame) -> DataFrame:
    """The aligner row, present when short-read or RNA files are given."""
    found = _needs(manifest).where("need = 'dragen'")
    ordered = found.select(
        F.lit(0).alias("file_ord"), F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("pos")
    )
    return conform(
        ordered,
        schemas.SOFTWARE,
        submitted_id=DRAGEN,
        category="Alignment",
        title="DRAGEN",
        version=DRAGEN_VERSION,
    )


def rejects(samples: DataFrame) -> DataFrame:
    """Rows no sheet can place (Q9, Q10), with the reason."""
    sample = F.col(ids.SAMPLE_ID)
    reason = F.when(sample.isNull(), "no sample id").when(~ids.has_code(sample), "sample id has no tissue code")
    return samples.withColumn("reason", reason).where(F.col("reason").isNotNull())
