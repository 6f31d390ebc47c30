"""Value tables."""

import pytest
from pyspark.sql import functions as F

from sheetloom.functions import ids, labels, paths
from sheetloom.sources.sinks import capitalized


def evaluate(spark, expression, values):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in table.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


CASES = [
    (
        labels.tissue_label,
        {
            "HEART": "HEART",
            "l hippocampus": "L-HIPPOCAMPUS",
            "L_HIPPOCAMPUS": "L-HIPPOCAMPUS",
            "temporal_lobe": "TEMPORAL-LOBE",
            "Frontal_Lobe": "FRONTAL-LOBE",
            "R_HIPPOCAMPUS": "R-HIPPOCAMPUS",
            "UV_SKIN": "UV_SKIN",
            "uv skin x": "UV-SKIN-X",
            "L-HIPPOCAMPUS": "L-HIPPOCAMPUS",
            None: None,
            "": "",
        },
    ),
    (labels.category, {"BLOOD": "Liquid", "cord blood": "Liquid", "HEART": "Core", None: "Core"}),
    (
        labels.library_type,
        {
            "X_GDNA_SHORTREAD": "WGS_ILLUMINA",
            "X_GDNA_LONGREAD": "WGS_PACBIO",
            "X_RNA_WATCHMAKER": "RNA_WATCHMAKER",
            "X_RNA_TRUSEQ": "RNA_TRUSEQ",
            "SHORTREAD_RNA_TRUSEQ": "WGS_ILLUMINA",
            "else": "UNKNOWN",
        },
    ),
    (
        labels.assay,
        {
            "RNA_TRUSEQ": "bulk_rna_seq",
            "RNA_WATCHMAKER": "bulk_rna_seq",
            "WGS_ILLUMINA": "bulk_wgs_pcr_free",
            "WGS_PACBIO": "bulk_wgs_pcr_free",
            "UNKNOWN": "other",
        },
    ),
    (
        labels.sequencing_id,
        {
            "WGS_PACBIO": "BROAD_SEQUENCING_PACBIO_15000BP_20X",
            "RNA_WATCHMAKER": "BROAD_SEQUENCING_NOVASEQXPLUS_25B_145BP_100M",
            "RNA_TRUSEQ": "BROAD_SEQUENCING_NOVASEQ6000_150BP_75M",
            "WGS_ILLUMINA": "BROAD_SEQUENCING_NOVASEQXPLUS_25B_150BP_160X",
            "UNKNOWN": "BROAD_SEQUENCING_NOVASEQXPLUS_25B_150BP_160X",
        },
    ),
    (labels.molecule, {"RNA_TRUSEQ": "RNA", "RNA_WATCHMAKER": "RNA", "GDNA_LONGREAD": "DNA"}),
    (
        labels.molecule_detail,
        {"RNA_TRUSEQ": "mRNA", "RNA_WATCHMAKER": "Total RNA", "GDNA_SHORTREAD": "Total DNA"},
    ),
    (ids.donor_part, {"A-B-C": "A", "A": "A", "-B": ""}),
    (ids.core_code, {"A-B-C": "B", "A-B": "B", "A": None, "A--C": "", "A-B-C-D": "B"}),
    (ids.external_id, {"A-B-C": "A-B", "A-B": "A-B", "A-B-C-D": "A-B"}),
    (ids.suffix, {"A-B-C": "C", "A-B": "B", "A-B-C-D": "D", "A-B-": ""}),
    (ids.donor_id, {"d1": "NDRI_DONOR_d1"}),
    (
        paths.base_name,
        {
            "gs://a/b.cram": "b.cram",
            "gs://a/b/": "",
            "C:\\a\\b": "b",
            "C:\\a/b": "b",
            "/x/C:\\a": "C:\\a",
            "b.cram": "b.cram",
            "": "",
            None: None,
        },
    ),
    (paths.slash_name, {"gs://a/b.cram": "b.cram", "C:\\a\\b.cram": "C:\\a\\b.cram", "b": "b"}),
    (paths.extension, {"b.cram": "cram", "a.b.c": "c", "noext": "noext", "dot.": ""}),
    (capitalized, {"True": "True", "TRUE": "True", "two words": "Two words", "": "", None: None}),
]


@pytest.mark.parametrize("expression,table", CASES, ids=lambda x: getattr(x, "__name__", ""))
def test_table(spark, expression, table):
    assert evaluate(spark, expression, list(table)) == list(table.values())


def test_minted_ids(spark):
    c = {k: F.lit(v) for k, v in dict(d="dn1", l="UV_SKIN", s="001a1", t="WGS_PACBIO", p="DDBTP").items()}
    one, two = F.lit("1"), F.lit(2)
    minted = {
        "BROAD_TISSUE-SAMPLE_DN1_UV_SKIN_001A1_LIQUID": ids.tissue_sample_id(
            "Broad", c["d"], c["l"], c["s"], F.lit("Liquid")
        ),
        "X_ANALYTE_DN1_UV_SKIN_001A1_RNA_TRUSEQ": ids.analyte_id("x", c["d"], c["l"], c["s"], F.lit("RNA_TRUSEQ")),
        "X_LIBRARY_A-B_UV_SKIN_WGS_PACBIO_1": ids.library_id("X", F.lit("a b"), c["l"], c["t"], one),
        "X_UNALIGNED-READS_DN1_UV_SKIN_WGS_PACBIO_SMRT_SMRT1": ids.unaligned_reads_id("X", c["d"], c["l"], one),
        "X_ALIGNED-READS_DN1-UV_SKIN-WGS_PACBIO-CRAM": ids.aligned_reads_id("X", c["d"], c["l"], c["t"], F.lit(1)),
        "X_ALIGNED-READS_DN1-UV_SKIN-WGS_PACBIO-2-CRAM": ids.aligned_reads_id("X", c["d"], c["l"], c["t"], two),
        "X_ALIGNED-READS_DN1-UV_SKIN-RNA_TRUSEQ-CRAM": ids.aligned_reads_id(
            "X", c["d"], c["l"], F.lit("RNA_TRUSEQ"), two
        ),
        "X_VARIANT-CALLS_CODEC-DN1-3A-S-DDBTP_001A1": ids.codec_id(
            "X", "VARIANT-CALLS", F.lit("dn1-3a-s"), c["p"], c["s"]
        ),
        "X_LIBRARY_CODEC_DN1_UV_SKIN-DDBTP_001A1": ids.codec_tissue_id(
            "X", "LIBRARY", c["d"], c["l"], c["p"], c["s"]
        ),
        "NDRI_TISSUE_DN1-3A-UV_SKIN": ids.tissue_id(F.lit("dn1-3a"), c["l"], True),
        "NDRI_TISSUE_dn1-3a-UV_SKIN": ids.tissue_id(F.lit("dn1-3a"), c["l"], False),
        "NDRI_TISSUE_dn1-3a": ids.tissue_id(F.lit("dn1-3a"), F.lit(None).cast("string"), True),
    }
    row = spark.range(1).select(*[v.alias(f"c{i}") for i, v in enumerate(minted.values())]).first()
    assert list(row) == list(minted)
