"""Registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.llm import (
    hard_negatives,
    isolation,
    jump_shards,
    language_id,
    line_dedup,
    merge_dropout,
    merkle,
    oracle,
    packing,
    rule_ensemble,
    simhash,
    spot_signatures,
    substrings,
    url_filter,
)
from sheetloom.llm.common import ship, text_of

SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(parts: int):
    """Fold of a document: the CRC-32 of its id as text, modulo ``parts``. No id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("n_removed").cast("long").alias("n_removed"),
        F.length("text").cast("long").alias("kept_chars"),
        F.md5(F.encode("text", "UTF-8")).alias("kept_md5"),
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    done = merge_dropout.encoded(docs).withColumn("decoded", merge_dropout.decode(F.col("ids")))
    return done.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        F.crc32(F.encode("decoded", "UTF-8")).alias("decoded_crc32"),
        (F.col("decoded") == F.col("text")).alias("lossless"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.train(docs, _fold(5) != 0)
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (_fold(5) == 0).alias("held_out"), "lang_pred", "score"
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.against_next(_table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = rule_ensemble.train(docs, labels, _fold(4) != 2)
    scored = rule_ensemble.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = isolation.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return judged.select(
        F.col("row.doc_id").alias("doc_id"), *[f"counts.{c}" for c in isolation.BASE], "base_failed", "kept", "anomaly"
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.assign(_table(spark, sf_dir, "documents"), SHARDS).withColumn("law", F.lit("key"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.train(url_filter.labelled_urls(spark))
    return url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), model).drop("url")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(_table(spark, sf_dir, "documents"))
    return packing.place(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("print")).alias("fingerprint"), "component_id")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    capitals, small = (bytes(range(first, first + 26)).decode() for first in b"Aa")
    lowered = [F.translate("text", capitals, small) if c == "text" else F.col(c) for c in merkle.LEAF_COLUMNS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf(lowered))
    proven = merkle.manifest(docs, tampered=tampered)
    root = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), root.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup_substrings(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_sentencepiece, op3_language_id, op4_fingerprints, op5_quality,
        op6_rules, op7_sharding, op8_url_filter, op9_packing, op10_simhash, op11_merkle, op12_hard_negatives,
        op13_substring_dedup,
    )
}

_HEX = "(strpos('0123456789abcdef', substr(digest, {0}, 1)) - 1)"
_LINE_VALUE = f"256 * {_HEX.format(1)} + 16 * {_HEX.format(2)} + {_HEX.format(3)}"

ORACLE: dict[str, str] = {
    "op1_line_dedup": f"""
        WITH split AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos
            FROM documents WHERE text IS NOT NULL),
        worded AS (
            SELECT *, md5(line) AS digest, len(regexp_extract_all(line, '[^ ]+')) > {line_dedup.LONG_LINE_WORDS} AS lengthy,
                   row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k, count(*) OVER (PARTITION BY doc_id) AS n
            FROM split WHERE regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]')),
        valued AS (SELECT *, {_LINE_VALUE} AS value FROM worded),
        marked AS (
            SELECT *, (value + 31 * coalesce(lag(value) OVER (PARTITION BY doc_id ORDER BY k), 0))
                      % {line_dedup.PRIME} % {line_dedup.DIVISOR} <> 0 AS mark
            FROM valued),
        ended AS (
            SELECT *, least(n, coalesce(min(CASE WHEN mark THEN k END) OVER (
                PARTITION BY doc_id ORDER BY k ROWS BETWEEN 1 FOLLOWING AND {line_dedup.MOST_LINES - 2} FOLLOWING),
                k + {line_dedup.MOST_LINES - 1})) AS last
            FROM marked),
        spans AS (
            SELECT doc_id, k, last FROM ended WHERE k < n
            UNION ALL SELECT doc_id, k, k FROM ended WHERE lengthy),
        chunk AS (
            SELECT s.doc_id, s.k, s.last, string_agg(w.line, chr(10) ORDER BY w.k) AS body
            FROM spans s JOIN worded w ON w.doc_id = s.doc_id AND w.k BETWEEN s.k AND s.last GROUP BY ALL),
        later AS (SELECT doc_id, k, last FROM chunk QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, k) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(k, last + 1)) AS k FROM later),
        owned AS (
            SELECT s.*, max(w.k) OVER (PARTITION BY s.doc_id ORDER BY s.pos) AS owner
            FROM split s LEFT JOIN worded w ON w.doc_id = s.doc_id AND w.pos = s.pos),
        kept AS (
            SELECT o.doc_id, count(DISTINCT g.k) AS n_removed,
                   coalesce(string_agg(o.line, chr(10) ORDER BY o.pos) FILTER (g.k IS NULL), '') AS body
            FROM owned o LEFT JOIN gone g ON g.doc_id = o.doc_id AND g.k = o.owner GROUP BY o.doc_id)
        SELECT d.doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed, length(body)::BIGINT AS kept_chars, md5(body) AS kept_md5
        FROM documents d LEFT JOIN kept USING (doc_id)
    """,
    "op11_merkle": oracle.MERKLE,
    "op12_hard_negatives": oracle.NEGATIVES,
    "op13_substring_dedup": oracle.SUBSTRINGS,
}
