"""Fixed sheet schemas and the projection onto them (K2).

Sheets carry their row order in the columns of :data:`ORDER` until they are written;
:func:`plain` drops them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: Row order: input file, scan block in the file, position in the block, item of a fanned-out row.
ORDER = ("file_ord", "block", "pos", "item")


def _sheet(columns: str, integers: str = "") -> StructType:
    numbers = set(integers.split())
    return StructType(
        [StructField(c, IntegerType() if c in numbers else StringType(), True) for c in columns.split()]
    )


# Column names and order of every sheet.
DONOR = _sheet("submitted_id age external_id sex tpc_submitted eligibility hardy_scale")

TISSUE = _sheet(
    "submitted_id external_id sample_count preservation_type preservation_medium ischemic_time "
    "anatomical_location pathology_notes ph prosector_notes size size_unit volume weight donor uberon_id"
)

TISSUE_SAMPLE = _sheet(
    "submitted_id category external_id preservation_type preservation_medium description core_size "
    "processing_date processing_notes weight sample_sources parent_samples"
)

ANALYTE = _sheet(
    "submitted_id molecule molecule_detail external_id description a260_a280_ratio average_fragment_size "
    "concentration concentration_unit dna_integrity_number dna_integrity_number_instrument "
    "dna_quality_number dna_quality_number_instrument dna_quality_size_threshold genomic_quality_number "
    "genomic_quality_number_instrument genomic_quality_size_threshold quantitation_method "
    "ribosomal_rna_ratio rna_integrity_number rna_integrity_number_instrument sample_quantity "
    "sample_quantity_unit volume volume_unit total_yield yield_per_unit yield_unit samples "
    "analyte_preparation"
)

LIBRARY = _sheet(
    "submitted_id comments external_id description a260_a280_ratio adapter_name adapter_sequence "
    "amplification_cycles analyte_weight antibody barcode_sequences concatenated_reads "
    "fragment_mean_length guide_sequence insert_coefficient_of_variation insert_maximum_length "
    "insert_mean_length insert_minimum_length preparation_date dna_target target_fragment_size "
    "target_insert_maximum_length target_insert_minimum_length target_monomer_size analytes assay "
    "library_preparation"
)

SEQUENCING = _sheet(
    "submitted_id read_type target_read_length flow_cell movie_length on_target_rate target_coverage "
    "target_read_count target_monomer_length sequencer preparation_kits",
    integers="target_read_length target_coverage target_read_count",
)

FILE_SET = _sheet("submitted_id description libraries sequencing samples")

CODEC_FILE_SET = _sheet("submitted_id description submitter_comments libraries sequencing samples")

UNALIGNED_READS = _sheet(
    "submitted_id filename submitted_md5sum data_category data_type n50 flow_cell_barcode flow_cell_lane "
    "description read_pair_number file_format file_sets derived_from external_quality_metrics "
    "paired_with software"
)

ALIGNED_READS = _sheet(
    "submitted_id filename submitted_md5sum data_category data_type n50 flow_cell_barcode flow_cell_lane "
    "description alignment_details file_format file_sets reference_genome derived_from "
    "external_quality_metrics software"
)

VARIANT_CALLS = _sheet(
    "submitted_id data_category data_type filename submitted_md5sum description comparators "
    "external_databases filtering_methods mode file_format file_sets reference_genome derived_from "
    "external_quality_metrics software"
)

SOFTWARE = _sheet(
    "submitted_id category title version description binary_url commit source_url gpu_architecture model "
    "modification_tags"
)

CODEC_SOFTWARE = _sheet(
    "submitted_id category title version description binary_url commit source_url gpu model "
    "modification_tags"
)

LIBRARY_PREPARATION = _sheet(
    "submitted_id description adapter_inclusion_method amplification_method fragmentation_method "
    "insert_selection_method enzymes rna_seq_protocol size_selection_method strand "
    "trim_adapter_sequence preparation_kits treatments"
)


def order_of(df: DataFrame) -> list[str]:
    """The order columns present in ``df``, most significant first."""
    return [c for c in ORDER if c in df.columns]


def conform(df: DataFrame, schema: StructType, **computed: Column | str) -> DataFrame:
    """Project onto a sheet: ``computed`` columns by name, blanks for the rest, row order kept.

    A string value is a constant.
    """
    unknown = set(computed) - set(schema.names)
    if unknown:
        raise ValueError(f"not columns of the sheet: {sorted(unknown)}")

    def value(field: StructField) -> Column:
        kind = field.dataType.simpleString()
        if field.name not in computed:
            return F.expr(f"CAST(NULL AS {kind}) AS {field.name}")
        v = computed[field.name]
        return (F.lit(v) if isinstance(v, str) else v).cast(kind).alias(field.name)

    return df.select(*[value(f) for f in schema.fields], *order_of(df))


def plain(sheet: DataFrame) -> DataFrame:
    """The sheet without its order columns."""
    return sheet.drop(*ORDER)

