"""The tissue dimension and its lookups.

The reference table may repeat a code. Three readings of the repeats exist and differ only when
the repeats disagree:

* ``label`` - the name of the last row, falling back to the code itself;
* ``source_label`` - the label on the last *new* Tissue row of the code, null for a Tissue row
  without label;
* the variants - one Tissue row per distinct label, in order of first appearance.

No join here carries a broadcast hint: the table is broadcast when Spark's own estimate keeps it under
``spark.sql.autoBroadcastJoinThreshold``. Beyond that codes are looked up once per scan block, see :func:`sheetloom.operators.skew.lookup`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.functions import ids, labels
from sheetloom.operators.ordering import first_by
from sheetloom.operators.skew import lookup
from sheetloom.schemas import order_of

CODE = "tissue_identifier_code"


def tissue_variants(ref: DataFrame) -> DataFrame:
    """``(core, variant, uberon_id, item)``: the distinct labels of every code, numbered by appearance."""
    rows = _labelled(ref)
    return first_by(rows, "core", "variant").select("core", "variant", "uberon_id", _place(rows).alias("item"))


def tissue_codes(ref: DataFrame) -> DataFrame:
    """``(core, label, source_label)``, one row per code.

    Repeats of a code are folded per label before the code is put together.
    """
    rows = _labelled(ref)
    place = _place(rows)
    variants = rows.groupBy("core", "variant").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    last_named = F.max_by("variant", "last")
    return variants.groupBy("core").agg(
        F.coalesce(last_named, labels.tissue_label(F.col("core"))).alias("label"),
        F.max_by("variant", "first").alias("source_label"),
    )


def _labelled(ref: DataFrame) -> DataFrame:
    return ref.where(F.col(CODE).isNotNull()).select(
        F.col(CODE).alias("core"),
        labels.tissue_label(F.col("corresponding_tissue")).alias("variant"),
        "uberon_id",
        *order_of(ref),
    )


def _place(rows: DataFrame) -> Column:
    return F.struct(*order_of(rows))


def parse_samples(rows: DataFrame) -> DataFrame:
    """Add the parts of the sample id (F14); rows whose id lacks a tissue code are left to ``rejects``."""
    sample = F.col(ids.SAMPLE_ID)
    return rows.where(ids.has_code(sample)).withColumns(
        {
            "donor_part": ids.donor_part(sample),
            "core": ids.core_code(sample),
            "external_id": ids.external_id(sample),
            "suffix": ids.suffix(sample),
        }
    )


def with_tissue(rows: DataFrame, ref: DataFrame) -> DataFrame:
    """Parsed samples with ``label`` and ``source_label``; an unmapped code labels itself."""
    named = lookup(parse_samples(rows), tissue_codes(ref), "core")
    return named.withColumn("label", F.coalesce("label", labels.tissue_label(F.col("core"))))


def tissue_fanout(rows: DataFrame, ref: DataFrame) -> DataFrame:
    """Distinct samples against every reference row of their code, repeats included.

    The sheets use :func:`tissue_variants` instead, which gives the same Tissue rows without the fan-out.
    """
    distinct = (
        parse_samples(rows).select("collaborator_sample_id", "external_id", "core", "donor_id").distinct()
    )
    listed = ref.select(F.col(CODE).alias("core"), "corresponding_tissue", "uberon_id")
    return distinct.join(listed, "core", "left")
