"""Sample-key parsing and identifier minting.

A sample id reads ``{donor}-{tissue code}-{core suffix}``. Every minted id is a pure function of the
row it stands on (plus a running number), so links between sheets are rebuilt rather than looked up
wherever the other side is known to exist.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAMPLE_ID = "collaborator_sample_id"


def has_code(sample_id: Column) -> Column:
    """True when the sample id has at least a donor and a tissue code part."""
    return F.contains(sample_id, F.lit("-"))


def donor_part(sample_id: Column) -> Column:
    return F.substring_index(sample_id, "-", 1)


def core_code(sample_id: Column) -> Column:
    return F.get(F.split(sample_id, "-"), F.lit(1))


def external_id(sample_id: Column) -> Column:
    """Donor and tissue code: the tissue the sample was cut from."""
    return F.substring_index(sample_id, "-", 2)


def suffix(sample_id: Column) -> Column:
    """Last part, whatever the number of parts."""
    return F.substring_index(sample_id, "-", -1)


def mint(prefix: str, entity: str, *parts: Column) -> Column:
    """``{prefix}_{entity}_{part}_...`` in upper case; parts must not be null."""
    return F.upper(F.concat_ws("_", F.lit(f"{prefix}_{entity}"), *parts))


def donor_id(donor: Column) -> Column:
    """Donor ids keep their case."""
    return F.concat(F.lit("NDRI_DONOR_"), donor)


def tissue_id(external: Column, label: Column, upper_external: bool) -> Column:
    """Tissue id (F2); an unmapped tissue has no label part and is never upper-cased."""
    shown = F.upper(external) if upper_external else external
    return F.coalesce(
        F.concat(F.lit("NDRI_TISSUE_"), shown, F.lit("-"), label),
        F.concat(F.lit("NDRI_TISSUE_"), external),
    )


def tissue_sample_id(prefix: str, donor: Column, label: Column, suffix: Column, category: Column) -> Column:
    return mint(prefix, "TISSUE-SAMPLE", donor, label, suffix, category)


def analyte_id(prefix: str, donor: Column, label: Column, suffix: Column, analyte_label: Column) -> Column:
    return mint(prefix, "ANALYTE", donor, label, suffix, analyte_label)


def library_id(prefix: str, donor: Column, label: Column, library_type: Column, number: Column) -> Column:
    """Library ids turn spaces into hyphens."""
    return F.replace(mint(prefix, "LIBRARY", donor, label, library_type, number), F.lit(" "), F.lit("-"))


def unaligned_reads_id(prefix: str, donor: Column, label: Column, number: Column) -> Column:
    smrt = F.concat(F.lit("SMRT"), number)
    return mint(prefix, "UNALIGNED-READS", donor, label, F.lit("WGS_PACBIO_SMRT"), smrt)


def aligned_reads_id(prefix: str, donor: Column, label: Column, library_type: Column, number: Column) -> Column:
    """RNA ids never carry a number, DNA ids only from the second on."""
    numbered = ~library_type.startswith("RNA") & (number > 1)
    shown = F.when(numbered, number.cast("string"))
    return mint(prefix, "ALIGNED-READS", F.concat_ws("-", donor, label, library_type, shown, F.lit("CRAM")))


def codec_id(prefix: str, entity: str, sample_id: Column, protocol: Column, suffix: Column) -> Column:
    """CODEC read and variant ids hang on the whole sample id."""
    return mint(prefix, entity, F.concat_ws("-", F.lit("CODEC"), sample_id, protocol), suffix)


def codec_tissue_id(
    prefix: str, entity: str, donor: Column, label: Column, protocol: Column, suffix: Column
) -> Column:
    """CODEC library and file set ids hang on donor, tissue and protocol."""
    return mint(prefix, entity, F.lit("CODEC"), donor, F.concat_ws("-", label, protocol), suffix)
