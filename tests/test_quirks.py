"""One test per behaviour that is easy to get wrong (Q1-Q20, Q22, Q23)."""

import pytest
from pyspark.sql import functions as F

from sheetloom import read_codec, read_manifests
from sheetloom.operators import tissues
from sheetloom.operators.links import collisions, duplicate_ids
from sheetloom.plans import codec, regular
from sheetloom.schemas import plain
from sheetloom.sources.manifests import manifest, read_donors
from tests.data import codec_file, long_file, ref_of, rna_file, rows_of, short_file, tsv

REF = [("3A", "BLOOD"), ("3Q", "LUNG"), ("1D", "LUNG"), ("3S", "HEART"), ("3AN", "L_HIPPOCAMPUS")]
SHORT_HEADER = ["sample_id", "cram_path", "donor_id", "collaborator_sample_id"]


@pytest.fixture(scope="module")
def ref(spark):
    return ref_of(spark, REF)


def file_sets(samples, ref, *columns, prefix="BROAD"):
    analytes = regular.analyte_rows(samples, ref, prefix)
    return rows_of(regular.file_set_sheet(samples, ref, analytes, prefix), *columns)


def test_q1_two_codes_of_one_tissue(spark, ref, tmp_path):
    samples = read_manifests(spark, [short_file(tmp_path / "short.tsv", ["D-3Q-001A1", "D-1D-001A1"])])
    assert rows_of(regular.tissue_sheet(samples, ref), "submitted_id") == [
        "NDRI_TISSUE_D-3Q-LUNG", "NDRI_TISSUE_D-1D-LUNG",
    ]
    assert rows_of(regular.tissue_sample_sheet(samples, ref), "external_id") == ["D-3Q-001A1"]
    assert rows_of(regular.analyte_sheet(regular.analyte_rows(samples, ref)), "external_id") == ["D-3Q-001A1"]
    report = collisions(regular.tissue_sample_rows(samples, ref), "external_id").collect()
    assert [tuple(r) for r in report] == [("BROAD_TISSUE-SAMPLE_D_LUNG_001A1_CORE", 2, "D-1D-001A1")]


def test_q2_q3_q12_rna_files(spark, ref, tmp_path):
    first = rna_file(tmp_path / "rna.tsv", ["D-3Q-001A1"])
    second = rna_file(tmp_path / "truseq.tsv", ["D-3Q-002A1"])
    samples, files = read_manifests(spark, rna=[first, second]), manifest(spark, rna=[first, second])
    assert rows_of(regular.library_sheet(regular.analyte_rows(samples, ref)), "submitted_id") == [
        "BROAD_LIBRARY_D_LUNG_RNA_WATCHMAKER_1", "BROAD_LIBRARY_D_LUNG_RNA_TRUSEQ_1",
    ]
    assert file_sets(samples, ref, "submitted_id", "sequencing") == [
        ("BROAD_FILE-SET_D_LUNG_RNA_WATCHMAKER_1", "BROAD_SEQUENCING_NOVASEQXPLUS_25B_145BP_100M")
    ]
    assert rows_of(regular.aligned_reads_sheet(samples, ref), "description") == ["D-3Q-001A1"]
    assert rows_of(regular.sequencing_sheet(files), "submitted_id") == []
    assert rows_of(regular.software_sheet(files), "title") == ["DRAGEN"]


def test_q4_prefix(spark, ref, tmp_path):
    samples = read_manifests(spark, [short_file(tmp_path / "short.tsv", ["D-3Q-001A1"])])
    assert file_sets(samples, ref, "submitted_id", "libraries", "sequencing", prefix="Other") == [
        ("OTHER_FILE-SET_D_LUNG_WGS_ILLUMINA_1", "OTHER_LIBRARY_D_LUNG_WGS_ILLUMINA_1",
         "BROAD_SEQUENCING_NOVASEQXPLUS_25B_150BP_160X")
    ]
    assert rows_of(codec.codec_sequencing_sheet(spark, "Other"), "submitted_id") == ["OTHER_SEQUENCING_CODEC"]


def test_q5_argument_and_file_name_disagree(spark, ref, tmp_path):
    samples = read_manifests(spark, long_read=[long_file(tmp_path / "pb.tsv", ["D-3Q-001A1"])])
    assert rows_of(regular.library_sheet(regular.analyte_rows(samples, ref)), "submitted_id") == [
        "BROAD_LIBRARY_D_LUNG_WGS_PACBIO_1"
    ]
    assert file_sets(samples, ref, "submitted_id", "libraries") == [("BROAD_FILE-SET_D_LUNG_WGS_ILLUMINA_1", None)]
    assert rows_of(regular.unaligned_reads_sheet(samples, ref), "submitted_id") == []


def test_q6_smrt_numbers_go_by_sample(spark, ref, tmp_path):
    path = long_file(tmp_path / "long.tsv", ["D-3Q-001A1", "D-3Q-002A1", "D-3Q-001A1"])
    reads = regular.unaligned_reads_sheet(read_manifests(spark, long_read=[path]), ref)
    stem = "BROAD_UNALIGNED-READS_D_LUNG_WGS_PACBIO_SMRT_SMRT"
    assert rows_of(reads, "submitted_id", "file_sets") == [
        (f"{stem}{n}", f"BROAD_FILE-SET_D_LUNG_WGS_PACBIO_{n}") for n in (1, 1, 2)
    ]
    assert [tuple(r) for r in duplicate_ids(plain(reads)).collect()] == [(f"{stem}1", 2)]


def test_q7_aligned_numbers_skip_rows_without_a_cram(spark, ref, tmp_path):
    rows = [["a", "g/1.cram", "D", "D-3Q-1"], ["b", None, "D", "D-3Q-2"], ["c", "g/3.x.bam", "D", "D-3Q-3"]]
    samples = read_manifests(spark, [tsv(tmp_path / "short.tsv", SHORT_HEADER, rows)])
    got = rows_of(regular.aligned_reads_sheet(samples, ref), "submitted_id", "filename", "file_format", "file_sets")
    assert got == [
        ("BROAD_ALIGNED-READS_D-LUNG-WGS_ILLUMINA-CRAM", "1.cram", "cram", "BROAD_FILE-SET_D_LUNG_WGS_ILLUMINA_1"),
        ("BROAD_ALIGNED-READS_D-LUNG-WGS_ILLUMINA-2-CRAM", "3.x.bam", "bam", "BROAD_FILE-SET_D_LUNG_WGS_ILLUMINA_2"),
    ]
    rna = read_manifests(spark, rna=[rna_file(tmp_path / "rna.tsv", ["D-3Q-1", "D-3Q-1"])])
    assert len(set(rows_of(regular.aligned_reads_sheet(rna, ref), "submitted_id"))) == 1


def test_q8_prefix_with_an_underscore_keeps_its_links(spark, ref, tmp_path):
    samples = read_manifests(spark, [short_file(tmp_path / "short.tsv", ["D-3Q-001A1"])])
    assert file_sets(samples, ref, "libraries", prefix="A_B") == ["A_B_LIBRARY_D_LUNG_WGS_ILLUMINA_1"]


def test_q9_q10_missing_donors_and_bad_sample_ids(spark, ref, tmp_path):
    rows = [
        ["a", "1.cram", None, "D-3Q-1"],  # donor on another row: known
        ["b", "2.cram", "D", "D-3Q-1"],
        ["c", "3.cram", None, "E-3Q-1"],  # donor nowhere: unknown
        ["d", "4.cram", "D", None],
        ["e", "5.cram", "D", "onepart"],
        ["f", "6.cram", "D", "D-9Z"],  # two parts, unmapped code
    ]
    samples = read_manifests(spark, [tsv(tmp_path / "short.tsv", SHORT_HEADER, rows)])
    assert rows_of(regular.tissue_sheet(samples, ref), "submitted_id", "donor", "uberon_id") == [
        ("NDRI_TISSUE_D-3Q-LUNG", "NDRI_DONOR_D", "U1"), ("NDRI_TISSUE_D-9Z", "NDRI_DONOR_D", None),
    ]
    assert rows_of(regular.library_sheet(regular.analyte_rows(samples, ref)), "submitted_id") == [
        "BROAD_LIBRARY_D_LUNG_WGS_ILLUMINA_1", "BROAD_LIBRARY_D_LUNG_WGS_ILLUMINA_2",
        "BROAD_LIBRARY_D_9Z_WGS_ILLUMINA_1",
    ]
    assert file_sets(samples, ref, "submitted_id", "libraries") == [
        ("BROAD_FILE-SET_NAN_LUNG_WGS_ILLUMINA_1", None),
        ("BROAD_FILE-SET_D_LUNG_WGS_ILLUMINA_1", "BROAD_LIBRARY_D_LUNG_WGS_ILLUMINA_1"),
        ("BROAD_FILE-SET_NAN_LUNG_WGS_ILLUMINA_2", None),
        ("BROAD_FILE-SET_D_9Z_WGS_ILLUMINA_1", "BROAD_LIBRARY_D_9Z_WGS_ILLUMINA_1"),
    ]
    assert rows_of(regular.aligned_reads_sheet(samples, ref), "description", "file_sets")[1:] == [
        ("D-3Q-1", None), ("E-3Q-1", None), ("D-9Z", "BROAD_FILE-SET_D_9Z_WGS_ILLUMINA_1"),
    ]
    assert rows_of(regular.rejects(samples), "description", "reason") == [
        ("d", "no sample id"), ("e", "sample id has no tissue code"),
    ]


def test_q11_code_without_a_tissue_name(spark, tmp_path):
    ref = ref_of(spark, [("3x", None), (None, "HEART")])
    samples = read_manifests(spark, [short_file(tmp_path / "short.tsv", ["D-3x-1"])])
    assert rows_of(regular.tissue_sheet(samples, ref), "submitted_id") == ["NDRI_TISSUE_D-3x"]
    assert rows_of(regular.tissue_sample_sheet(samples, ref), "submitted_id", "sample_sources") == [
        ("BROAD_TISSUE-SAMPLE_D_3X_1_CORE", "NDRI_TISSUE_D-3x")
    ]


@pytest.mark.parametrize(
    "names,label,source,variants",
    [
        (["A", "B"], "B", "B", ["A", "B"]),
        (["A", "B", "A"], "A", "B", ["A", "B"]),
        (["A", "a", "B b", "B-B"], "B-B", "B-B", ["A", "B-B"]),
        (["A", None], "X1", None, ["A", None]),
        ([None, "A", None], "X1", "A", [None, "A"]),
    ],
)
def test_conflicting_reference_rows(spark, names, label, source, variants, tmp_path):
    ref = ref_of(spark, [("x1", n) for n in names])
    row = tissues.tissue_codes(ref).first()
    assert (row.core, row.label, row.source_label) == ("x1", label, source)
    samples = read_manifests(spark, [short_file(tmp_path / "short.tsv", ["d-x1-1", "d-x1-2"])])
    ids = [f"NDRI_TISSUE_D-X1-{v}" if v else "NDRI_TISSUE_d-x1" for v in variants]
    assert rows_of(regular.tissue_sheet(samples, ref), "submitted_id") == ids
    got = rows_of(regular.tissue_sample_sheet(samples, ref), "submitted_id", "sample_sources")
    linked = f"NDRI_TISSUE_D-X1-{source}" if source else "NDRI_TISSUE_d-x1"
    assert got == [(f"BROAD_TISSUE-SAMPLE_D_{label}_{n}_CORE", linked) for n in (1, 2)]
    got = rows_of(regular.tissue_sample_sheet(samples, ref, codec=True), "submitted_id", "sample_sources")
    linked = f"NDRI_TISSUE_d-x1-{source}" if source else "NDRI_TISSUE_d-x1"
    assert got == [(f"BROAD_TISSUE-SAMPLE_D_{source or 'X1'}_{n}_CORE", linked) for n in (1, 2)]


def test_fanout_join_gives_the_same_tissues(spark, tmp_path):
    ref = ref_of(spark, [("3S", "HEART"), ("3S", "HEART"), ("3S", "heart x")])
    samples = read_manifests(spark, [short_file(tmp_path / "short.tsv", ["D-3S-1", "D-3S-2", "D-3S-1"])])
    fanned = tissues.tissue_fanout(regular.identified(samples), ref)
    assert fanned.count() == 6
    label = F.concat_ws("-", F.lit("NDRI_TISSUE_D-3S"), F.upper(F.replace("corresponding_tissue", F.lit(" "), F.lit("-"))))
    expected = {r[0] for r in fanned.select(label).distinct().collect()}
    assert set(rows_of(regular.tissue_sheet(samples, ref), "submitted_id")) == expected


def test_q13_q14_codec_reads(spark, ref, tmp_path):
    header = ["collaborator_sample_id", "donor_id", "RAW_BAM", "MolConsensusBAM", "vcf"]
    rows = [
        ["D-3Q-1", "D", None, "m1", "v1"],
        ["D-3Q-1", "D", "r2", None, "v2"],
        ["D-3Q-1", None, "r3", "m3", None],
        [None, "D", "r4", "m4", "v4"],
    ]
    samples = read_codec(spark, [tsv(tmp_path / "c.tsv", header, rows)])
    raw, processed = (f"BROAD_ALIGNED-READS_{k}_CODEC-D-3Q-1-DDBTP_1" for k in ("RAW", "PROCESSED"))
    got = rows_of(codec.codec_aligned_reads_sheet(samples, ref), "submitted_id", "filename", "derived_from")
    assert got == [(processed, "m1", None), (raw, "r2", None), (raw, "r3", None), (processed, "m3", raw)]
    got = rows_of(codec.codec_variant_calls_sheet(samples, ref), "filename", "derived_from")
    assert got == [("v1", processed), ("v2", processed)]


def test_codec_protocol_list(spark, ref, tmp_path):
    samples = read_codec(spark, [codec_file(tmp_path / "c.tsv", ["D-3Q-1", "D-3S-2"])])
    sheet = codec.codec_tissue_sample_sheet(samples, ref)
    rows = codec.codec_analyte_rows(sheet, ref)
    got = rows_of(codec.codec_library_sheet(rows, protocols=("DDBTP", "xyz")), "submitted_id", "library_preparation")
    assert [r[0] for r in got] == [
        f"BROAD_LIBRARY_CODEC_D_{tissue}-{p}_{n}" for tissue, n in (("LUNG", 1), ("HEART", 2)) for p in ("DDBTP", "XYZ")
    ]
    assert got[1][1] == "BROAD_LIBRARY-PREPARATION_CODEC_XYZ"
    reads = codec.codec_aligned_reads_sheet(samples, ref, protocols=("DDBTP", "xyz"))
    assert [f for f in rows_of(reads, "filename")] == ["0.raw.bam", "0.mol.bam"] * 2 + ["1.raw.bam", "1.mol.bam"] * 2


def test_codec_keeps_case_of_external_ids(spark, ref, tmp_path):
    samples = read_codec(spark, [codec_file(tmp_path / "c.tsv", ["d-3Q-1", "D-3Q-2"])])
    assert rows_of(codec.codec_tissue_sheet(samples, ref), "submitted_id") == [
        "NDRI_TISSUE_d-3Q-LUNG", "NDRI_TISSUE_D-3Q-LUNG",
    ]


def test_q15_donors_that_differ_by_case(spark, ref, tmp_path):
    samples = read_manifests(spark, [short_file(tmp_path / "short.tsv", ["D-3Q-1", "d-3Q-2", "d-3Q-3"])])
    ids = rows_of(regular.library_sheet(regular.analyte_rows(samples, ref)), "submitted_id")
    assert [i.rsplit("_", 1)[1] for i in ids] == ["1", "1", "2"]
    assert file_sets(samples, ref, "libraries") == ids


def test_q18_path_given_twice(spark, ref, tmp_path):
    short = short_file(tmp_path / "short.tsv", ["D-3Q-1"])
    long = long_file(tmp_path / "long.tsv", ["D-3S-1"])
    samples = read_manifests(spark, [short, short], [long, long])
    analytes = regular.analyte_rows(samples, ref)
    assert rows_of(regular.library_sheet(analytes), "submitted_id") == [
        "BROAD_LIBRARY_D_LUNG_WGS_ILLUMINA_1", "BROAD_LIBRARY_D_HEART_WGS_PACBIO_1",
    ]
    assert rows_of(regular.aligned_reads_sheet(samples, ref), "description") == ["D-3Q-1"]
    assert file_sets(samples, ref, "submitted_id", "libraries") == [
        ("BROAD_FILE-SET_D_LUNG_WGS_ILLUMINA_1", "BROAD_LIBRARY_D_LUNG_WGS_ILLUMINA_1"),
        ("BROAD_FILE-SET_D_LUNG_WGS_ILLUMINA_2", None),
        ("BROAD_FILE-SET_D_HEART_WGS_PACBIO_1", "BROAD_LIBRARY_D_HEART_WGS_PACBIO_1"),
        ("BROAD_FILE-SET_D_HEART_WGS_PACBIO_2", None),
    ]
    assert [i[-5:] for i in rows_of(regular.unaligned_reads_sheet(samples, ref), "submitted_id")] == ["SMRT1", "SMRT2"]


def test_q19_no_input(spark):
    with pytest.raises(ValueError):
        read_manifests(spark)


def test_q20_nothing_left_after_filters(spark, ref, tmp_path):
    rows = [[None, None, None, None], ["a", None, None, "D-3Q-1"]]
    samples = read_manifests(spark, [tsv(tmp_path / "short.tsv", SHORT_HEADER, rows)])
    analytes = regular.analyte_rows(samples, ref)
    for sheet in (
        regular.tissue_sheet(samples, ref),
        regular.tissue_sample_sheet(samples, ref),
        regular.analyte_sheet(analytes),
        regular.library_sheet(analytes),
        regular.aligned_reads_sheet(samples, ref),
    ):
        assert sheet.count() == 0


def test_q22_external_ids_that_differ_by_case(spark, ref, tmp_path):
    samples = read_manifests(spark, [short_file(tmp_path / "short.tsv", ["D-3Q-1", "d-3Q-2"])])
    assert rows_of(regular.tissue_sheet(samples, ref), "submitted_id", "external_id") == [("NDRI_TISSUE_D-3Q-LUNG", "D-3Q")]
    assert rows_of(regular.tissue_sample_sheet(samples, ref), "submitted_id", "sample_sources") == [
        (f"BROAD_TISSUE-SAMPLE_D_LUNG_{n}_CORE", "NDRI_TISSUE_D-3Q-LUNG") for n in (1, 2)
    ]
    report = collisions(regular.tissue_rows(samples, ref), "external_id").collect()
    assert [tuple(r) for r in report] == [("NDRI_TISSUE_D-3Q-LUNG", 2, "D-3Q")]


def test_q23_missing_age(spark, tmp_path):
    path = tsv(tmp_path / "d.tsv", ["age", "donor", "note", "gender"], [[76, "D1", "x", "Male"], [None, "D2", "y", None]])
    assert rows_of(regular.donor_sheet(read_donors(spark, path)), "submitted_id", "age", "sex") == [
        ("NDRI_DONOR_D1", "76", "Male"), ("NDRI_DONOR_D2", None, None),
    ]


def test_tissue_takes_its_donor_from_the_first_row(spark, ref, tmp_path):
    rows = [["a", "1", "E", "D-3Q-1"], ["b", "2", "D", "D-3Q-2"]]
    samples = read_manifests(spark, [tsv(tmp_path / "short.tsv", SHORT_HEADER, rows)])
    assert rows_of(regular.tissue_sheet(samples, ref), "donor") == ["NDRI_DONOR_E"]
