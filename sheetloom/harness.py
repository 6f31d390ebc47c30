"""Manifest-shaped tables derived from star-schema tables.

The engine reads sample manifests. To run it over tables of any size, every ``lineitem`` row becomes a
manifest row: its order gives the donor, its part the tissue code, its flags the file it stands in.
The tissue reference has nine rows, the code list eight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.sources.manifests import TAGS, tag_manifest
from sheetloom.sources.staging import Staging

#: An invented reference. It has names with blanks and in lower case, two codes of one tissue, a code without a name,
#: and repeats of a code that disagree. BLOOD and the hyphenated names are fixed values of the labels.
TISSUE_REF = (
    (0, "K1", "BLOOD", "ONT:0001"),
    (1, "K2", "L_HIPPOCAMPUS", "ONT:0002"),
    (2, "K3", "outer bark", "ONT:0003"),
    (3, "K4", "OUTER BARK", "ONT:0003"),
    (4, "K5", None, "ONT:0005"),
    (5, "K6", "STEM", "ONT:0006"),
    (6, "K6", "LEAF_TIP", "ONT:0007"),
    (7, "K6", "STEM", "ONT:0008"),
    (8, "K7", "FRONTAL_LOBE", "ONT:0009"),
)
#: Code of a row by ``l_partkey % 8``; the last one is not in the reference.
CODES = ("K1", "K2", "K3", "K4", "K5", "K6", "K7", "Z9")

FILES = (
    ("short_read", "manifests/short_read.tsv"),
    ("long_read", "manifests/long_read.tsv"),
    ("rna", "manifests/rna_watchmaker.tsv"),
    ("rna", "manifests/rna_truseq.tsv"),
)

#: 2**KEY_BITS keys make a block. Blocks are what a hot group is cut along.
KEY_BITS = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staging(spark: SparkSession) -> Staging:
    """Staging of a query. A local session without a shared folder, as in tests, gets one under its warehouse."""
    try:
        return Staging(spark)
    except ValueError:
        if not spark.sparkContext.master.startswith("local"):
            raise
        return Staging(spark, f"{spark.conf.get('spark.sql.warehouse.dir')}/staged")


def tissue_ref(spark: SparkSession) -> DataFrame:
    named = [(i, code, f"'{tissue}'" if tissue else "CAST(NULL AS string)", uberon) for i, code, tissue, uberon in TISSUE_REF]
    rows = ", ".join(f"(0, 0L, {i}L, '{code}', {tissue}, '{uberon}')" for i, code, tissue, uberon in named)
    return spark.sql(
        f"SELECT * FROM VALUES {rows} "
        "AS t(file_ord, block, pos, tissue_identifier_code, corresponding_tissue, uberon_id)"
    )


#: Columns of a manifest row, over a line ``l_*`` with ``donor`` and ``sample``.
ROW = (
    "concat_ws('-', 'SM', l_orderkey, l_linenumber) AS sample_id",
    "CASE WHEN l_tax != 0.08 THEN donor END AS donor_id",
    # no sample id, and one without a tissue code
    "CASE WHEN l_quantity = 49 THEN donor WHEN l_quantity != 50 THEN sample END AS collaborator_sample_id",
    """CASE WHEN l_returnflag != 'N' AND l_discount != 0.1 THEN concat(
         CASE l_suppkey % 3 WHEN 0 THEN concat('gs://bucket/run', l_suppkey, '/')
                            WHEN 1 THEN concat('C:', chr(92), 'data', chr(92)) ELSE '' END,
         sample, '.cram') END AS cram_path""",
    """CASE WHEN l_returnflag = 'N' AND l_discount != 0.1
         THEN concat('gs://bucket/', sample, '.hifi_reads.bam') END AS input_bam""",
    "CASE WHEN l_discount != 0.0 THEN concat(sample, '.raw.aligned.bam') END AS RAW_BAM",
    "CASE WHEN l_tax != 0.01 THEN concat(sample, '.mol_consensus.aligned.bam') END AS MolConsensusBAM",
    "CASE WHEN l_quantity != 10 THEN concat(sample, '.vcf') END AS vcf",
)
FILE_ORD = """CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1
                   WHEN l_linestatus = 'F' THEN 2 ELSE 3 END"""
PLACE = (
    f"shiftright(l_orderkey, {KEY_BITS}) AS block",
    # In a block: the order key's low bits, then the line's place in its order by line number and the rest of the row. It is
    # one number, as a scan gives. Lines come grouped by order key from the join, so this takes no shuffle.
    f"""shiftleft(l_orderkey & {(1 << KEY_BITS) - 1}, 32) + row_number() OVER (PARTITION BY l_orderkey
          ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS pos""",
)


def donors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Donor table: one row per customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('DNR', lpad(c_custkey, 6, '0')) AS donor",
        "CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender",
        "CAST(20 + c_custkey % 70 AS int) AS age",
        "0 AS file_ord",
        f"shiftright(c_custkey, {KEY_BITS}) AS block",
        "c_custkey AS pos",
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the files that have at least one row."""
    present = table(spark, sf_dir, "lineitem").selectExpr(f"{FILE_ORD} AS file_ord").distinct()
    return present.join(F.broadcast(_files(spark)), "file_ord")


def _files(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({i}, {i}, 0, '{kind}', '{path}', '{path}')" for i, (kind, path) in enumerate(FILES))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(file_ord, arg_ord, sub_ord, kind, path, file)")


def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows without file tags, in the order file, order key, line and the rest of the row."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    code = " ".join(f"WHEN {i} THEN '{code}'" for i, code in enumerate(CODES))
    code = f"CASE l_partkey % {len(CODES)} {code} END"
    # Orders grow with the lines, so the join is a shuffle at every size.
    return (
        lines.join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey"))
        # one donor in two spellings
        .selectExpr("*", "concat(CASE WHEN l_suppkey % 11 = 0 THEN 'dnr' ELSE 'DNR' END, lpad(o_custkey, 6, '0')) AS donor")
        .selectExpr(
            "*",
            f"concat_ws('-', donor, {code}, concat(lpad(l_linenumber, 3, '0'), 'A', l_partkey % 3)) AS sample",
        )
        .selectExpr(*ROW, f"{FILE_ORD} AS file_ord", *PLACE)
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`sheetloom.read_manifests` returns for four files."""
    rows = manifest_rows(spark, sf_dir).withColumn("description", F.col("sample_id"))
    tags = tag_manifest(_files(spark)).select(*TAGS)
    # Four rows, so the broadcast is bounded.
    return rows.join(F.broadcast(tags), "file_ord")


def codec_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What :func:`sheetloom.read_codec` returns: the same rows as one file."""
    return manifest_rows(spark, sf_dir).withColumn("file_ord", F.lit(0))
