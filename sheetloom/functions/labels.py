"""Vocabulary expressions: tissue labels, categories, assay and library types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The only labels whose underscores turn into hyphens.
HYPHENATED_LABELS = ("TEMPORAL_LOBE", "FRONTAL_LOBE", "L_HIPPOCAMPUS", "R_HIPPOCAMPUS")

# Marker searched in an analyte id -> library type, in order of precedence.
LIBRARY_TYPE_MARKERS = (
    ("SHORTREAD", "WGS_ILLUMINA"),
    ("LONGREAD", "WGS_PACBIO"),
    ("WATCHMAKER", "RNA_WATCHMAKER"),
    ("TRUSEQ", "RNA_TRUSEQ"),
)

# Marker searched in a library type -> sequencing id. They name BROAD whatever the
# submitter prefix is.
SEQUENCING_MARKERS = (
    ("PACBIO", "BROAD_SEQUENCING_PACBIO_15000BP_20X"),
    ("WATCHMAKER", "BROAD_SEQUENCING_NOVASEQXPLUS_25B_145BP_100M"),
    ("TRUSEQ", "BROAD_SEQUENCING_NOVASEQ6000_150BP_75M"),
)
DEFAULT_SEQUENCING = "BROAD_SEQUENCING_NOVASEQXPLUS_25B_150BP_160X"


def first_marker(text: Column, markers, default: str) -> Column:
    """Value of the first marker contained in ``text``."""
    picks = [F.when(F.contains(text, F.lit(marker)), F.lit(value)) for marker, value in markers]
    return F.coalesce(*picks, F.lit(default))


def tissue_label(tissue: Column) -> Column:
    """Upper-case label with spaces as hyphens; null stays null (F1)."""
    label = F.upper(F.replace(tissue, F.lit(" "), F.lit("-")))
    return F.replace(label, F.lit("_"), F.when(label.isin(*HYPHENATED_LABELS), "-").otherwise("_"))


def category(label: Column) -> Column:
    """``Liquid`` for blood, ``Core`` for everything else including null."""
    return F.when(F.contains(F.upper(label), F.lit("BLOOD")), "Liquid").otherwise("Core")


def library_type(analyte_id: Column) -> Column:
    """Library type by the first marker found anywhere in the analyte id."""
    return first_marker(analyte_id, LIBRARY_TYPE_MARKERS, "UNKNOWN")


def assay(library_type: Column) -> Column:
    """Assay name of a library type (F16)."""
    return (
        F.when(library_type.isin("RNA_WATCHMAKER", "RNA_TRUSEQ"), "bulk_rna_seq")
        .when(library_type.isin("WGS_ILLUMINA", "WGS_PACBIO"), "bulk_wgs_pcr_free")
        .otherwise("other")
    )


def sequencing_id(library_type: Column) -> Column:
    """Sequencing sheet id a file set of this library type points to."""
    return first_marker(library_type, SEQUENCING_MARKERS, DEFAULT_SEQUENCING)


def molecule(analyte_label: Column) -> Column:
    """DNA or RNA."""
    return F.when(analyte_label.startswith("RNA_"), "RNA").otherwise("DNA")


def molecule_detail(analyte_label: Column) -> Column:
    """Detail that goes with :func:`molecule`."""
    return (
        F.when(analyte_label == "RNA_WATCHMAKER", "Total RNA")
        .when(analyte_label == "RNA_TRUSEQ", "mRNA")
        .otherwise("Total DNA")
    )
