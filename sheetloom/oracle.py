"""The registered queries as plain SQL over the same tables.

Written from the data model, not from the DataFrame code: running numbers are one window over a
whole group, links are looked up in the full list of ids of the far sheet.
"""

from __future__ import annotations

from sheetloom import schemas

_HYPHENATED = "'TEMPORAL_LOBE', 'FRONTAL_LOBE', 'L_HIPPOCAMPUS', 'R_HIPPOCAMPUS'"


def _label(tissue: str) -> str:
    shown = f"upper(replace({tissue}, ' ', '-'))"
    return f"CASE WHEN {shown} IN ({_HYPHENATED}) THEN replace({shown}, '_', '-') ELSE {shown} END"


REF = f"""
  tissue_ref(ord, code, tissue, uberon_id) AS (VALUES
    (0, 'K1', 'BLOOD', 'ONT:0001'), (1, 'K2', 'L_HIPPOCAMPUS', 'ONT:0002'), (2, 'K3', 'outer bark', 'ONT:0003'),
    (3, 'K4', 'OUTER BARK', 'ONT:0003'), (4, 'K5', NULL, 'ONT:0005'), (5, 'K6', 'STEM', 'ONT:0006'),
    (6, 'K6', 'LEAF_TIP', 'ONT:0007'), (7, 'K6', 'STEM', 'ONT:0008'), (8, 'K7', 'FRONTAL_LOBE', 'ONT:0009')),
  codes(i, code) AS (VALUES
    (0, 'K1'), (1, 'K2'), (2, 'K3'), (3, 'K4'), (4, 'K5'), (5, 'K6'), (6, 'K7'), (7, 'Z9')),
  variants AS (
    SELECT code, {_label("tissue")} AS variant, min(ord) AS first_ord, max(ord) AS last_ord,
           arg_min(uberon_id, ord) AS uberon_id
    FROM tissue_ref GROUP BY ALL),
  tissue_map AS (
    SELECT code, arg_max_null(variant, last_ord) AS variant, arg_max_null(variant, first_ord) AS source
    FROM variants GROUP BY code)
"""

ROWS = """
  base AS (
    SELECT l.*, CASE WHEN l_suppkey % 11 = 0 THEN 'dnr' ELSE 'DNR' END || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS d,
           d || '-' || c.code || '-' ||
             lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || 'A' || CAST(l_partkey % 3 AS VARCHAR) AS cs,
           CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1
                WHEN l_linestatus = 'F' THEN 2 ELSE 3 END AS f
    FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN codes c ON c.i = l_partkey % 8),
  raw_rows AS (
    SELECT
      'SM-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS sample_id,
      CASE WHEN l_tax <> 0.08 THEN d END AS donor_id,
      CASE WHEN l_quantity = 49 THEN d WHEN l_quantity <> 50 THEN cs END AS collaborator_sample_id,
      CASE WHEN l_returnflag <> 'N' AND l_discount <> 0.1 THEN
        CASE l_suppkey % 3
          WHEN 0 THEN 'gs://bucket/run' || CAST(l_suppkey AS VARCHAR) || '/' || cs || '.cram'
          WHEN 1 THEN 'C:' || chr(92) || 'data' || chr(92) || cs || '.cram'
          ELSE cs || '.cram' END END AS cram_path,
      CASE WHEN l_returnflag = 'N' AND l_discount <> 0.1 THEN 'gs://bucket/' || cs || '.hifi_reads.bam' END
        AS input_bam,
      CASE WHEN l_discount <> 0.0 THEN cs || '.raw.aligned.bam' END AS "RAW_BAM",
      CASE WHEN l_tax <> 0.01 THEN cs || '.mol_consensus.aligned.bam' END AS "MolConsensusBAM",
      CASE WHEN l_quantity <> 10 THEN cs || '.vcf' END AS vcf,
      f AS file_ord, l_orderkey >> 12 AS block,
      row_number() OVER (ORDER BY {file} l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                         l_extendedprice, l_shipdate) AS rn
    FROM base),
  samples AS (
    SELECT r.*, split_part(collaborator_sample_id, '-', 1) AS dp,
      split_part(collaborator_sample_id, '-', 2) AS core,
      split_part(collaborator_sample_id, '-', 1) || '-' || split_part(collaborator_sample_id, '-', 2) AS ext,
      split_part(collaborator_sample_id, '-', -1) AS suffix,
      coalesce(m.variant, upper(split_part(collaborator_sample_id, '-', 2))) AS label, m.source,
      CASE file_ord WHEN 0 THEN 'WGS_ILLUMINA' WHEN 1 THEN 'WGS_PACBIO' WHEN 2 THEN 'RNA_WATCHMAKER'
           ELSE 'RNA_TRUSEQ' END AS lib_type,
      CASE file_ord WHEN 0 THEN 'GDNA_SHORTREAD' WHEN 1 THEN 'GDNA_LONGREAD' WHEN 2 THEN 'RNA_WATCHMAKER'
           ELSE 'RNA_TRUSEQ' END AS tag
    FROM raw_rows r LEFT JOIN tissue_map m ON m.code = split_part(collaborator_sample_id, '-', 2)),
  coded AS (SELECT * FROM samples WHERE contains(collaborator_sample_id, '-')),
  named AS (SELECT * FROM coded WHERE donor_id IS NOT NULL)
"""

TISSUE = """
  tissue_all AS (
    SELECT coalesce('NDRI_TISSUE_' || upper(ext) || '-' || t.variant, 'NDRI_TISSUE_' || ext) AS submitted_id,
           ext AS external_id, 'NDRI_DONOR_' || donor_id AS donor, t.uberon_id, rn, t.first_ord
    FROM named n LEFT JOIN variants t ON t.code = n.core),
  tissue AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY submitted_id ORDER BY rn, first_ord) AS k
                   FROM tissue_all) WHERE k = 1)
"""

TISSUE_SAMPLE = """
  ts_all AS (
    SELECT upper('BROAD_TISSUE-SAMPLE_' || dp || '_' || label || '_' || suffix || '_' ||
             CASE WHEN label LIKE '%BLOOD%' THEN 'Liquid' ELSE 'Core' END) AS submitted_id,
           CASE WHEN label LIKE '%BLOOD%' THEN 'Liquid' ELSE 'Core' END AS category,
           collaborator_sample_id AS external_id,
           coalesce('NDRI_TISSUE_' || upper(ext) || '-' || source, 'NDRI_TISSUE_' || ext) AS sample_sources, rn, file_ord,
           block
    FROM named),
  ts AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY submitted_id ORDER BY rn) AS k FROM ts_all)
    WHERE k = 1)
"""

ANALYTE = """
  analyte_all AS (
    SELECT upper('BROAD_ANALYTE_' || dp || '_' || label || '_' || suffix || '_' || tag) AS submitted_id,
           CASE WHEN tag LIKE 'RNA%' THEN 'RNA' ELSE 'DNA' END AS molecule,
           CASE tag WHEN 'RNA_WATCHMAKER' THEN 'Total RNA' WHEN 'RNA_TRUSEQ' THEN 'mRNA'
                ELSE 'Total DNA' END AS molecule_detail,
           collaborator_sample_id AS external_id,
           upper('BROAD_TISSUE-SAMPLE_' || dp || '_' || label || '_' || suffix || '_' ||
             CASE WHEN label LIKE '%BLOOD%' THEN 'Liquid' ELSE 'Core' END) AS samples,
           dp, label, lib_type, rn
    FROM coded
    WHERE collaborator_sample_id IN (SELECT collaborator_sample_id FROM named)),
  analyte AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY submitted_id ORDER BY rn) AS k
                   FROM analyte_all) WHERE k = 1)
"""

LIBRARY = """
  library AS (
    SELECT upper('BROAD_LIBRARY_' || dp || '_' || label || '_' || lib_type || '_' ||
             CAST(row_number() OVER (PARTITION BY dp, label, lib_type ORDER BY rn) AS VARCHAR)) AS submitted_id,
           submitted_id AS analytes,
           CASE WHEN lib_type LIKE 'RNA%' THEN 'bulk_rna_seq' ELSE 'bulk_wgs_pcr_free' END AS assay
    FROM analyte_all)
"""

FILE_SET = """
  file_set_rows AS (
    SELECT coalesce(donor_id, 'nan') || '_' || label || '_' || lib_type AS file_set_group,
           row_number() OVER (PARTITION BY coalesce(donor_id, 'nan'), label, lib_type ORDER BY rn) AS number,
           sample_id AS description, lib_type
    FROM coded WHERE file_ord <= 2)
"""

FILE_SET_LINKED = """
  file_set AS (
    SELECT upper('BROAD_FILE-SET_' || file_set_group || '_' || CAST(number AS VARCHAR)) AS submitted_id,
           description,
           (SELECT max(l.submitted_id) FROM library l WHERE l.submitted_id =
              upper('BROAD_LIBRARY_' || file_set_group || '_' || CAST(number AS VARCHAR))) AS libraries,
           CASE lib_type WHEN 'WGS_PACBIO' THEN 'BROAD_SEQUENCING_PACBIO_15000BP_20X'
             WHEN 'RNA_WATCHMAKER' THEN 'BROAD_SEQUENCING_NOVASEQXPLUS_25B_145BP_100M'
             ELSE 'BROAD_SEQUENCING_NOVASEQXPLUS_25B_150BP_160X' END AS sequencing
    FROM file_set_rows)
"""

UNALIGNED = """
  unaligned AS (
    SELECT upper('BROAD_UNALIGNED-READS_' || dp || '_' || label || '_WGS_PACBIO_SMRT_SMRT' ||
                 CAST(n AS VARCHAR)) AS submitted_id,
           input_bam AS filename, collaborator_sample_id AS description, 'bam' AS file_format,
           upper('BROAD_FILE-SET_' || dp || '_' || label || '_WGS_PACBIO_' || CAST(n AS VARCHAR)) AS file_sets
    FROM (SELECT *, row_number() OVER (PARTITION BY collaborator_sample_id ORDER BY rn) AS n
          FROM coded WHERE file_ord = 1 AND input_bam IS NOT NULL))
"""

ALIGNED = """
  aligned AS (
    SELECT upper('BROAD_ALIGNED-READS_' || dp || '-' || label || '-' || lib_type ||
             CASE WHEN lib_type LIKE 'RNA%' OR n = 1 THEN '' ELSE '-' || CAST(n AS VARCHAR) END || '-CRAM')
             AS submitted_id,
           split_part(cram_path, '/', -1) AS filename, collaborator_sample_id AS description,
           'Sorted' AS alignment_details,
           split_part(split_part(cram_path, '/', -1), '.', -1) AS file_format,
           (SELECT max(s.submitted_id) FROM file_set_ids s WHERE s.submitted_id =
              upper('BROAD_FILE-SET_' || dp || '_' || label || '_' || lib_type || '_' || CAST(n AS VARCHAR)))
             AS file_sets,
           'broad_grch38' AS reference_genome, 'BROAD_SOFTWARE_DRAGEN_07.021.604.3.7.8' AS software
    FROM (SELECT *, row_number() OVER (PARTITION BY dp, label, lib_type ORDER BY rn) AS n
          FROM coded WHERE file_ord IN (0, 2) AND cram_path IS NOT NULL))
"""

FILE_SET_IDS = """
  file_set_ids AS (
    SELECT upper('BROAD_FILE-SET_' || file_set_group || '_' || CAST(number AS VARCHAR)) AS submitted_id
    FROM file_set_rows)
"""

SEQUENCING = """
  sequencing AS (
    SELECT s.* FROM (VALUES
      (1, 'BROAD_SEQUENCING_PACBIO_15000BP_20X', 'Single-end', 15000, NULL, 20, NULL, 'pacbio_revio_hifi'),
      (0, 'BROAD_SEQUENCING_NOVASEQXPLUS_25B_150BP_160X', 'Paired-end', 150, '25B', 160, NULL,
       'illumina_novaseq_x_plus'),
      (2, 'BROAD_SEQUENCING_NOVASEQX_25B_145BP_100M', 'Paired-end', 145, '25B', NULL, 100000000,
       'illumina_novaseq_x_plus'))
      AS s(file_ord, submitted_id, read_type, target_read_length, flow_cell, target_coverage,
           target_read_count, sequencer)
    WHERE s.file_ord IN (
      SELECT CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1
                  WHEN l_linestatus = 'F' THEN 2 ELSE 3 END FROM lineitem))
"""

SOFTWARE = """
  software AS (
    SELECT 'BROAD_SOFTWARE_DRAGEN_07.021.604.3.7.8' AS submitted_id, 'Alignment' AS category,
           'DRAGEN' AS title, '07.021.604.3.7.8' AS version
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag <> 'N'))
"""

DONOR = """
  donor AS (
    SELECT 'NDRI_DONOR_DNR' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS submitted_id,
           CAST(20 + c_custkey % 70 AS VARCHAR) AS age,
           'DNR' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS external_id,
           CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS sex, 'True' AS tpc_submitted
    FROM customer)
"""

CODEC = """
  c_tissue_all AS (
    SELECT coalesce('NDRI_TISSUE_' || ext || '-' || t.variant, 'NDRI_TISSUE_' || ext) AS submitted_id,
           ext AS external_id, 'NDRI_DONOR_' || donor_id AS donor, t.uberon_id, rn, t.first_ord
    FROM named n LEFT JOIN variants t ON t.code = n.core),
  c_tissue AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY submitted_id ORDER BY rn, first_ord) AS k
                   FROM c_tissue_all) WHERE k = 1),
  c_last AS (
    SELECT external_id, arg_max(submitted_id, (rn, coalesce(first_ord, -1))) AS source FROM c_tissue GROUP BY external_id),
  c_labels AS (
    SELECT external_id, source,
           CASE WHEN split_part(source, '-', 3) = '' THEN split_part(source, '-', 2)
                ELSE substr(source, length('NDRI_TISSUE_' || external_id || '-') + 1) END AS cut
    FROM c_last),
  c_ts_all AS (
    SELECT upper('BROAD_TISSUE-SAMPLE_' || dp || '_' || cut || '_' || suffix || '_' ||
             CASE WHEN cut LIKE '%BLOOD%' THEN 'Liquid' ELSE 'Core' END) AS submitted_id,
           CASE WHEN cut LIKE '%BLOOD%' THEN 'Liquid' ELSE 'Core' END AS category,
           collaborator_sample_id AS external_id, c_labels.source AS sample_sources, dp, label, suffix, rn
    FROM named JOIN c_labels ON c_labels.external_id = named.ext),
  c_ts AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY submitted_id ORDER BY rn) AS k FROM c_ts_all)
    WHERE k = 1),
  c_analyte_all AS (
    SELECT upper('BROAD_ANALYTE_' || dp || '_' || label || '_' || suffix || '_GDNA_SHORTREAD') AS submitted_id,
           external_id, submitted_id AS samples, dp, label, suffix, rn
    FROM c_ts),
  c_analyte AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY submitted_id ORDER BY rn) AS k
                   FROM c_analyte_all) WHERE k = 1),
  c_library AS (
    SELECT upper('BROAD_LIBRARY_CODEC_' || dp || '_' || label || '-DDBTP_' || suffix) AS submitted_id,
           submitted_id AS analytes, 'codec' AS assay,
           'BROAD_LIBRARY-PREPARATION_CODEC_DDBTP' AS library_preparation
    FROM c_analyte_all),
  c_file_set AS (
    SELECT upper('BROAD_FILE-SET_CODEC_' || dp || '_' || label || '-DDBTP_' || suffix) AS submitted_id,
           upper('BROAD_LIBRARY_CODEC_' || dp || '_' || label || '-DDBTP_' || suffix) AS libraries,
           'BROAD_SEQUENCING_CODEC' AS sequencing
    FROM c_analyte_all),
  c_aligned AS (
    SELECT upper('BROAD_ALIGNED-READS_RAW_CODEC-' || collaborator_sample_id || '-DDBTP_' || suffix)
             AS submitted_id,
           "RAW_BAM" AS filename, 'Sequencing Reads' AS data_category,
           'Raw bam CODEC_' || collaborator_sample_id || '-ddbtp' AS description,
           'Sorted' AS alignment_details, 'bam' AS file_format,
           upper('BROAD_FILE-SET_CODEC_' || dp || '_' || label || '-DDBTP_' || suffix) AS file_sets,
           'GRCh38' AS reference_genome, CAST(NULL AS VARCHAR) AS derived_from,
           'BROAD_SOFTWARE_CODEC_ALIGNMENT_PIPELINE_V1' AS software
    FROM coded WHERE "RAW_BAM" IS NOT NULL
    UNION ALL
    SELECT upper('BROAD_ALIGNED-READS_PROCESSED_CODEC-' || collaborator_sample_id || '-DDBTP_' || suffix),
           "MolConsensusBAM", 'Sequencing Reads | Consensus Reads',
           'Processed duplex bam CODEC_' || collaborator_sample_id || '-DDBTP', 'Sorted', 'bam',
           upper('BROAD_FILE-SET_CODEC_' || dp || '_' || label || '-DDBTP_' || suffix), 'GRCh38',
           CASE WHEN "RAW_BAM" IS NOT NULL THEN
             upper('BROAD_ALIGNED-READS_RAW_CODEC-' || collaborator_sample_id || '-DDBTP_' || suffix) END,
           'BROAD_SOFTWARE_CODEC_BAM_PROCESSING_PIPELINE_V1'
    FROM coded WHERE "MolConsensusBAM" IS NOT NULL),
  c_variant AS (
    SELECT upper('BROAD_VARIANT-CALLS_CODEC-' || collaborator_sample_id || '-DDBTP_' || suffix) AS submitted_id,
           'Somatic Variant Calls' AS data_category, 'SNV | Indel' AS data_type, vcf AS filename,
           'CODEC_' || collaborator_sample_id || '-DDBTP' AS description, 'vcf' AS file_format,
           upper('BROAD_FILE-SET_CODEC_' || dp || '_' || label || '-DDBTP_' || suffix) AS file_sets,
           'GRCh38' AS reference_genome,
           upper('BROAD_ALIGNED-READS_PROCESSED_CODEC-' || collaborator_sample_id || '-DDBTP_' || suffix)
             AS derived_from,
           'BROAD_SOFTWARE_CODEC_VARIANT_CALL_PIPELINE_V1' AS software
    FROM coded WHERE vcf IS NOT NULL),
  c_software(submitted_id, category, title, version) AS (VALUES
    ('BROAD_SOFTWARE_CODEC_ALIGNMENT_PIPELINE_V1', 'Alignment', 'CODEC alignment pipeline', '1'),
    ('BROAD_SOFTWARE_CODEC_BAM_PROCESSING_PIPELINE_V1', 'Read Manipulation', 'CODEC bam process pipeline', '1'),
    ('BROAD_SOFTWARE_CODEC_VARIANT_CALL_PIPELINE_V1', 'Variant Calling', 'CODEC variant calling pipeline', '1')),
  c_sequencing(submitted_id, read_type, target_read_length, target_coverage, sequencer) AS (VALUES
    ('BROAD_SEQUENCING_CODEC', 'Paired-end', 150, 2, 'illumina_novaseq_x_plus')),
  c_preparation(submitted_id, description) AS (VALUES ('BROAD_LIBRARY-PREPARATION_CODEC_DDBTP',
    'ddBTP End Repair is an end repair strategy that utilizes ddBTPs to optimize DNA fragment ends for ' ||
    'ligation while preventing unintended polymerase extension and exonuclease degradation.'))
"""


def _with(*parts: str, file: str = "f,") -> str:
    return "WITH " + ",".join([REF, ROWS.replace("{file}", file), *parts])


_TYPES = {"string": "VARCHAR", "int": "INTEGER"}


def _columns(schema, given: str) -> str:
    """Every column of the sheet with its type: ``given`` ones as they are, all others null."""
    filled = set(given.split())
    return ", ".join(f"CAST({f.name if f.name in filled else 'NULL'} AS {_TYPES[f.dataType.simpleString()]}) AS {f.name}" for f in schema)


def _sheet(schema, given: str, source: str, *parts: str, file: str = "f,", table: str = "") -> str:
    return f"{_with(*parts, file=file)} SELECT {_columns(schema, given)} FROM {source}"


def _edges(edges) -> str:
    selects = [
        f"SELECT '{child}' AS sheet, '{column}' AS link, '{parent}' AS target, count({column}) AS links, "
        f"count(CASE WHEN {column} NOT IN (SELECT submitted_id FROM {known}) THEN 1 END) AS dangling "
        f"FROM {used}"
        for child, column, parent, used, known in edges
    ]
    return " UNION ALL ".join(selects)


def _summed_up(filled: dict[str, str], sources: dict[str, str]) -> str:
    """Rows of every sheet, and the sum of a checksum over its filled columns."""
    return " UNION ALL ".join(
        f"SELECT '{sheet}' AS sheet, count(*) AS n_rows, coalesce(sum(('0x' || substr(md5(concat_ws('|', "
        f"{', '.join(columns.split())})), 1, 8))::BIGINT), 0)::BIGINT AS checksum FROM {sources[sheet]}"
        for sheet, columns in filled.items()
    )


_FILLED = {
    "Donor": "submitted_id age external_id sex tpc_submitted",
    "Tissue": "submitted_id external_id donor uberon_id",
    "TissueSample": "submitted_id category external_id sample_sources",
    "Analyte": "submitted_id molecule molecule_detail external_id samples",
}

_FILE_SETS = (TISSUE_SAMPLE, ANALYTE, LIBRARY, FILE_SET, FILE_SET_LINKED)
_ALIGNED = (FILE_SET, FILE_SET_IDS, ALIGNED)
_READS = "submitted_id filename description alignment_details file_format file_sets reference_genome software"

_WORD = "list_extract(['Short', 'long', 'x', 'Watchmaker', 'TruSeq'], CAST({i} AS INT) + 1)"
_TAGS = f"""
WITH given AS (
  SELECT DISTINCT list_extract(['short_read', 'long_read', 'rna'], CAST((p_partkey >> 2) % 3 AS INT) + 1) AS kind,
         'in/' || {_WORD.format(i="p_partkey % 5")} || '_' || CAST(p_partkey % 11 AS VARCHAR) || '_' ||
         {_WORD.format(i="(p_partkey >> 3) % 5")} || '.tsv' AS path
  FROM part),
listed AS (
  SELECT *, lower(path) AS p, kind = 'rna' AS is_rna, lower(path) LIKE '%long%' AS is_long,
         row_number() OVER (ORDER BY CASE kind WHEN 'short_read' THEN 0 WHEN 'long_read' THEN 1 ELSE 2 END,
                            path) - 1 AS arg_ord
  FROM given),
rna0 AS (SELECT min(arg_ord) AS arg_ord FROM listed WHERE is_rna),
flagged AS (
  SELECT l.*, is_rna AND l.arg_ord = rna0.arg_ord AS is_rna0,
         (is_rna AND l.arg_ord = rna0.arg_ord) OR (NOT is_rna AND NOT is_long) AS in_aligned,
         CASE kind WHEN 'short_read' THEN 'GDNA_SHORTREAD' WHEN 'long_read' THEN 'GDNA_LONGREAD'
              ELSE CASE WHEN p LIKE '%truseq%' THEN 'RNA_TRUSEQ' ELSE 'RNA_WATCHMAKER' END END AS own_label
  FROM listed l, rna0),
analytes AS (
  SELECT path, min(arg_ord) AS arg_ord, arg_max(own_label, arg_ord) AS label FROM flagged GROUP BY path),
aligned AS (
  SELECT path, min(arg_ord) AS arg_ord,
         arg_max(CASE WHEN is_rna THEN CASE WHEN p LIKE '%truseq%' THEN 'RNA_TRUSEQ' ELSE 'RNA_WATCHMAKER' END
                      ELSE CASE WHEN p LIKE '%short%' THEN 'WGS_ILLUMINA' ELSE 'WGS_PACBIO' END END, arg_ord)
           AS label
  FROM flagged WHERE in_aligned GROUP BY path)
SELECT CAST(f.arg_ord AS INTEGER) AS arg_ord, f.kind, f.path, CAST(f.arg_ord AS INTEGER) AS "position",
       f.arg_ord = a.arg_ord AS for_analyte, a.label AS analyte_label, NOT is_rna OR is_rna0 AS for_file_set,
       CASE WHEN is_rna THEN
              CASE WHEN p LIKE '%watchmaker%' THEN 'RNA_WATCHMAKER' WHEN p LIKE '%truseq%' THEN 'RNA_TRUSEQ'
                   ELSE 'RNA_WATCHMAKER' END
            ELSE CASE WHEN p LIKE '%short%' THEN 'WGS_ILLUMINA' WHEN p LIKE '%long%' THEN 'WGS_PACBIO'
                      ELSE 'WGS_ILLUMINA' END END AS file_set_type,
       NOT is_rna AND is_long AS for_unaligned, coalesce(f.arg_ord = g.arg_ord, FALSE) AS for_aligned,
       g.label AS aligned_type
FROM flagged f JOIN analytes a USING (path) LEFT JOIN aligned g USING (path)
"""

_PATHS = ("cram_path", "input_bam", "MolConsensusBAM", "RAW_BAM", "vcf")


def _trimmed(c: str) -> str:
    back = "chr(92)"
    return (
        f"CASE WHEN contains(\"{c}\", '/') THEN split_part(\"{c}\", '/', -1) "
        f'WHEN contains("{c}", {back}) THEN split_part("{c}", {back}, -1) ELSE "{c}" END AS "{c}"'
    )


ORACLE = {
    "donor_sheet": _sheet(
        schemas.DONOR, "submitted_id age external_id sex tpc_submitted", "donor", DONOR
    ),
    "sample_parts": _with()
    + " SELECT sample_id, file_ord, dp AS donor_part, core, ext AS external_id, suffix FROM coded",
    "rejects": _with()
    + " SELECT sample_id, file_ord, CASE WHEN collaborator_sample_id IS NULL THEN 'no sample id' "
    "ELSE 'sample id has no tissue code' END AS reason FROM raw_rows "
    "WHERE coalesce(NOT contains(collaborator_sample_id, '-'), TRUE)",
    "tissue_lookup_fallback": _with()
    + " SELECT collaborator_sample_id, core, label, "
    "CASE WHEN label LIKE '%BLOOD%' THEN 'Liquid' ELSE 'Core' END AS category "
    "FROM coded",
    "tissue_join_fanout": _with()
    + " SELECT collaborator_sample_id, external_id, core, donor_id, t.tissue AS corresponding_tissue, t.uberon_id "
    "FROM (SELECT DISTINCT collaborator_sample_id, ext AS external_id, core, donor_id FROM named) n "
    "LEFT JOIN tissue_ref t ON t.code = n.core",
    "tissue_sheet": _sheet(
        schemas.TISSUE, "submitted_id external_id donor uberon_id", "tissue", TISSUE
    ),
    "tissue_sample_sheet": _sheet(
        schemas.TISSUE_SAMPLE, "submitted_id category external_id sample_sources", "ts", TISSUE_SAMPLE
    ),
    "analyte_sheet": _sheet(
        schemas.ANALYTE, "submitted_id molecule molecule_detail external_id samples", "analyte", ANALYTE
    ),
    "library_numbers": _sheet(
        schemas.LIBRARY, "submitted_id analytes assay", "library", ANALYTE, LIBRARY
    ),
    "sequencing_sheet": _sheet(
        schemas.SEQUENCING,
        "submitted_id read_type target_read_length flow_cell target_coverage target_read_count sequencer",
        "sequencing",
        SEQUENCING,
    ),
    "software_sheet": _sheet(
        schemas.SOFTWARE, "submitted_id category title version", "software", SOFTWARE
    ),
    "fileset_numbers": _with(FILE_SET) + " SELECT file_set_group, number, description FROM file_set_rows",
    "appended_numbers": _with(FILE_SET) + " SELECT file_set_group, number, description FROM file_set_rows",
    "merge_audit": _with(TISSUE, TISSUE_SAMPLE, ANALYTE)
    + """,
        listed AS (
            SELECT 'Tissue' AS sheet, submitted_id, rn, first_ord FROM tissue_all
            UNION ALL SELECT 'TissueSample', submitted_id, rn, 0 FROM ts_all
            UNION ALL SELECT 'Analyte', submitted_id, rn, 0 FROM analyte_all),
        placed AS (
            SELECT sheet, submitted_id, r.file_ord, row_number() OVER w AS k, first_value(r.file_ord) OVER w AS kept_file_ord
            FROM listed JOIN raw_rows r USING (rn) WINDOW w AS (PARTITION BY sheet, submitted_id ORDER BY rn, first_ord))
        SELECT sheet, count(*) AS merged, count(DISTINCT submitted_id) AS kept,
               count(*) FILTER (file_ord <> kept_file_ord) AS from_other_file
        FROM placed WHERE k > 1 GROUP BY sheet""",
    "bundle_read_back": _with(DONOR, TISSUE, TISSUE_SAMPLE, SEQUENCING)
    + """
        SELECT 0 AS sheet_order, 'Donor' AS sheet, count(*) AS n_rows,
               count(submitted_id) + count(age) + count(external_id) + count(sex) + count(tpc_submitted) AS n_cells,
               max(submitted_id) AS last_id FROM donor
        UNION ALL
        SELECT 1, 'Tissue', count(*), count(submitted_id) + count(external_id) + count(donor) + count(uberon_id),
               arg_max(submitted_id, rn * 100 + coalesce(first_ord, 0)) FROM tissue
        UNION ALL
        SELECT 2, 'TissueSample', count(*), count(submitted_id) + count(category) + count(external_id) + count(sample_sources),
               arg_max(submitted_id, rn) FROM ts
        UNION ALL
        SELECT 3, 'Sequencing', count(*),
               count(submitted_id) + count(read_type) + count(target_read_length) + count(flow_cell) + count(target_coverage)
               + count(target_read_count) + count(sequencer),
               arg_max(submitted_id, CASE file_ord WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END) FROM sequencing
        UNION ALL SELECT 4, 'UnalignedReads', 0, 0, NULL""",
    "regular_from_files": _with(
        DONOR, TISSUE, TISSUE_SAMPLE, ANALYTE, LIBRARY, FILE_SET, FILE_SET_LINKED, FILE_SET_IDS, UNALIGNED, ALIGNED, SEQUENCING, SOFTWARE
    )
    + " "
    + _summed_up(
        _FILLED
        | {
            "Library": "submitted_id analytes assay",
            "FileSet": "submitted_id description libraries sequencing",
            "UnalignedReads": "submitted_id filename description file_format file_sets",
            "AlignedReads": _READS,
            "Sequencing": "submitted_id read_type target_read_length flow_cell target_coverage target_read_count sequencer",
            "Software": "submitted_id category title version",
        },
        {
            "Donor": "donor", "Tissue": "tissue", "TissueSample": "ts", "Analyte": "analyte", "Library": "library", "FileSet": "file_set",
            "UnalignedReads": "unaligned", "AlignedReads": "aligned", "Sequencing": "sequencing", "Software": "software",
        },
    ),
    "codec_from_files": _with(DONOR, CODEC, file="")
    + " "
    + _summed_up(
        _FILLED
        | {
            "Library": "submitted_id analytes assay library_preparation",
            "FileSet": "submitted_id libraries sequencing",
            "AlignedReads": _READS + " data_category derived_from",
            "VariantCalls": "submitted_id data_category data_type filename description file_format file_sets reference_genome "
            "derived_from software",
            "UnalignedReads": "submitted_id",
            "Sequencing": "submitted_id read_type target_read_length target_coverage sequencer",
            "Software": "submitted_id category title version",
            "LibraryPreparation": "submitted_id description",
        },
        {
            "Donor": "donor", "Tissue": "c_tissue", "TissueSample": "c_ts",
            "Analyte": "(SELECT *, 'DNA' AS molecule, 'Total DNA' AS molecule_detail FROM c_analyte)", "Library": "c_library",
            "FileSet": "c_file_set", "AlignedReads": "c_aligned", "VariantCalls": "c_variant",
            "UnalignedReads": "(SELECT 1 AS submitted_id WHERE false)", "Sequencing": "c_sequencing", "Software": "c_software",
            "LibraryPreparation": "c_preparation",
        },
    ),
    "fileset_sheet_linked": _sheet(
        schemas.FILE_SET, "submitted_id description libraries sequencing", "file_set", *_FILE_SETS
    ),
    "unaligned_reads": _sheet(
        schemas.UNALIGNED_READS, "submitted_id filename description file_format file_sets", "unaligned", UNALIGNED
    ),
    "aligned_reads_linked": _sheet(schemas.ALIGNED_READS, _READS, "aligned", *_ALIGNED),
    "file_names": _with()
    + " SELECT sample_id, split_part(cram_path, '/', -1) AS filename, "
    "split_part(split_part(cram_path, '/', -1), '.', -1) AS file_format "
    "FROM raw_rows WHERE cram_path IS NOT NULL",
    "strip_paths": _with() + " SELECT sample_id, " + ", ".join(_trimmed(c) for c in _PATHS) + " FROM raw_rows",
    "strip_metrics": _with()
    + ", firsts AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, {i} AS i, min(rn) AS place FROM raw_rows WHERE \"{c}\" <> ''"
        for i, c in enumerate(_PATHS)
    )
    + ") SELECT (SELECT count(*) FROM raw_rows) AS rows_processed, "
    "string_agg(name, ', ' ORDER BY place, i) AS path_columns FROM firsts WHERE place IS NOT NULL",
    "keep_first_dedup": _with()
    + " SELECT collaborator_sample_id, sample_id, cram_path FROM ("
    "SELECT *, row_number() OVER (PARTITION BY collaborator_sample_id ORDER BY rn) AS k FROM samples "
    "WHERE collaborator_sample_id IS NOT NULL) WHERE k = 1",
    "last_wins_lookup": _with()
    + " SELECT collaborator_sample_id, arg_max_null(sample_id, rn) AS sample_id, "
    "arg_max_null(cram_path, rn) AS cram_path FROM samples "
    "WHERE collaborator_sample_id IS NOT NULL GROUP BY collaborator_sample_id",
    "hot_group_numbers": _with()
    + " SELECT label, sample_id, row_number() OVER (PARTITION BY label ORDER BY rn) AS number FROM coded",
    # A file without sample_id takes the collaborator's; a line without any cell is no row.
    "heterogeneous_union": _with()
    + " SELECT CASE WHEN file_ord <= 1 THEN sample_id ELSE collaborator_sample_id END AS sample_id, "
    "cram_path, donor_id, collaborator_sample_id, input_bam FROM raw_rows "
    "WHERE file_ord <= 1 OR coalesce(cram_path, donor_id, collaborator_sample_id) IS NOT NULL",
    "uneven_rows": """
        WITH cells AS (
            SELECT 'SM-' || l_orderkey || '-' || l_linenumber AS sample_id, l_orderkey % 2 AS part,
                   CASE WHEN l_linenumber = 3 THEN NULL WHEN l_partkey % 5 = 0 THEN l_suppkey || '" tube'
                        WHEN l_partkey % 5 = 1 THEN 'a' || chr(9) || l_suppkey WHEN l_partkey % 5 = 2 THEN 'say "x" so'
                        WHEN l_partkey % 5 = 3 THEN '"in"' || l_suppkey ELSE l_suppkey::VARCHAR END AS note,
                   CASE WHEN l_linenumber = 5 THEN 'x' || l_suppkey || '|NA' END AS surplus
            FROM lineitem)
        SELECT sample_id, CASE WHEN part = 0 THEN note END AS note, CASE WHEN part = 1 THEN note END AS remark, surplus FROM cells
    """,
    "sheet_order": _with(TISSUE_SAMPLE) + " SELECT submitted_id, file_ord, block FROM ts",
    "assay_tags": _TAGS,
    "missing_cells": "SELECT o_orderkey, CASE o_custkey % 8 WHEN 3 THEN 'none' WHEN 5 THEN 'Na' WHEN 6 THEN 'x' END "
    "AS cell FROM orders",
    "capitalized_cells": "SELECT c_custkey, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS segment "
    "FROM customer",
    "codec_tissue": _sheet(
        schemas.TISSUE, "submitted_id external_id donor uberon_id", "c_tissue", CODEC, file=""
    ),
    "codec_tissue_sample": _sheet(
        schemas.TISSUE_SAMPLE, "submitted_id category external_id sample_sources", "c_ts", CODEC, file=""
    ),
    "codec_analyte": _sheet(
        schemas.ANALYTE,
        "submitted_id molecule molecule_detail external_id samples",
        "(SELECT *, 'DNA' AS molecule, 'Total DNA' AS molecule_detail FROM c_analyte)",
        CODEC,
        file="",
    ),
    "codec_library": _sheet(
        schemas.LIBRARY, "submitted_id analytes assay library_preparation", "c_library", CODEC, file=""
    ),
    "codec_fileset": _sheet(
        schemas.CODEC_FILE_SET, "submitted_id libraries sequencing", "c_file_set", CODEC, file=""
    ),
    "codec_aligned_reads": _sheet(
        schemas.ALIGNED_READS, _READS + " data_category derived_from", "c_aligned", CODEC, file=""
    ),
    "codec_variant_calls": _sheet(
        schemas.VARIANT_CALLS,
        "submitted_id data_category data_type filename description file_format file_sets reference_genome "
        "derived_from software",
        "c_variant",
        CODEC,
        file="",
    ),
    "codec_two_protocols": _with(CODEC, file="")
    + " SELECT CAST(submitted_id AS VARCHAR) AS submitted_id, analytes, library_preparation FROM c_library UNION ALL "
    "SELECT replace(submitted_id, '-DDBTP_', '-SECOND_'), analytes, 'BROAD_LIBRARY-PREPARATION_CODEC_SECOND' FROM c_library",
    "codec_constants": _with(CODEC, file="")
    + ", cites AS (SELECT software AS submitted_id FROM c_aligned UNION ALL SELECT software FROM c_variant "
    "UNION ALL SELECT sequencing FROM c_file_set UNION ALL SELECT library_preparation FROM c_library), "
    "cited AS (SELECT submitted_id, count(*) AS cited FROM cites GROUP BY submitted_id), known AS ("
    + " UNION ALL BY NAME ".join(
        f"SELECT '{sheet}' AS sheet, {_columns(schema, given)} FROM {source}"
        for sheet, schema, given, source in (
            ("Software", schemas.CODEC_SOFTWARE, "submitted_id category title version", "c_software"),
            ("Sequencing", schemas.SEQUENCING, "submitted_id read_type target_read_length target_coverage sequencer", "c_sequencing"),
            ("LibraryPreparation", schemas.LIBRARY_PREPARATION, "submitted_id description", "c_preparation"),
        )
    )
    + ") SELECT known.*, coalesce(cited, 0) AS cited FROM known LEFT JOIN cited USING (submitted_id)",
    "dangling_links": _with(
        DONOR, TISSUE, TISSUE_SAMPLE, ANALYTE, LIBRARY, FILE_SET, FILE_SET_LINKED, FILE_SET_IDS, UNALIGNED,
        ALIGNED, SEQUENCING, SOFTWARE,
    )
    + _edges([
        ("Tissue", "donor", "Donor", "tissue", "donor"),
        ("TissueSample", "sample_sources", "Tissue", "ts", "tissue"),
        ("Analyte", "samples", "TissueSample", "analyte", "ts"),
        ("Library", "analytes", "Analyte", "library", "analyte"),
        ("FileSet", "libraries", "Library", "file_set", "library"),
        ("FileSet", "sequencing", "Sequencing", "file_set", "sequencing"),
        ("UnalignedReads", "file_sets", "FileSet", "unaligned", "file_set"),
        ("AlignedReads", "file_sets", "FileSet", "aligned", "file_set"),
        ("AlignedReads", "software", "Software", "aligned", "software"),
    ]),
    "codec_dangling_links": _with(DONOR, CODEC, file="")
    + _edges([
        ("Tissue", "donor", "Donor", "c_tissue", "donor"),
        ("TissueSample", "sample_sources", "Tissue", "c_ts", "c_tissue"),
        ("Analyte", "samples", "TissueSample", "c_analyte", "c_ts"),
        ("Library", "analytes", "Analyte", "c_library", "c_analyte"),
        ("Library", "library_preparation", "LibraryPreparation", "c_library", "c_preparation"),
        ("FileSet", "libraries", "Library", "c_file_set", "c_library"),
        ("FileSet", "sequencing", "Sequencing", "c_file_set", "c_sequencing"),
        ("AlignedReads", "file_sets", "FileSet", "c_aligned", "c_file_set"),
        ("AlignedReads", "derived_from", "AlignedReads", "c_aligned", "c_aligned"),
        ("AlignedReads", "software", "Software", "c_aligned", "c_software"),
        ("VariantCalls", "file_sets", "FileSet", "c_variant", "c_file_set"),
        ("VariantCalls", "derived_from", "AlignedReads", "c_variant", "c_aligned"),
        ("VariantCalls", "software", "Software", "c_variant", "c_software"),
    ]),
    "duplicate_reads": _with(UNALIGNED, *_ALIGNED)
    + " SELECT submitted_id, count(*) AS n_rows FROM (SELECT submitted_id FROM unaligned UNION ALL "
    "SELECT submitted_id FROM aligned) GROUP BY submitted_id HAVING count(*) > 1",
    "tissue_sample_collisions": _with(TISSUE_SAMPLE)
    + " SELECT submitted_id, count(DISTINCT external_id) AS n_sources, min(external_id) AS first_source "
    "FROM ts_all GROUP BY submitted_id HAVING count(DISTINCT external_id) > 1",
}
