"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy step handles at a time, however large an Arrow batch is.
SLICE_BYTES = 2 << 20


def text_of(name: str = "text") -> Column:
    """The text column; null reads as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def settled(df: DataFrame) -> DataFrame:
    """``df``, computed once and kept in the folder of ``spark.checkpoint.dir``.

    Later reads see the same rows after the loss of any executor. Where the setting is absent, a local
    session gets a folder of its own; on a cluster that is an error, since no folder there is known to
    be shared.
    """
    ensure_folder(df.sparkSession)
    return df.checkpoint()


def ensure_folder(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    sc.setCheckpointDir(folder)


#: Rows of an Arrow batch. A row is a whole document, so batches are kept shorter than for narrow rows.
BATCH_ROWS = 1000
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this library's modules to the Python workers, which need not have it installed, and bound their batches."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="modules-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w") as held:
        for source in sorted(root.rglob("*.py")):
            held.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def whole_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows of ``df`` as one struct column ``row``, next to ``columns``.

    What an operator adds then cannot clash with a column that the caller's table happens to have.
    """
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def with_outputs(df: DataFrame, source: DataFrame, outputs: list[str]) -> DataFrame:
    """Unpack ``row``; an input column with the name of an output column gives way to the output."""
    taken = {c.lower() for c in outputs}
    kept = [F.col("row").getField(c).alias(c) for c in source.columns if c.lower() not in taken]
    return df.select(*kept, *outputs)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow array, and where each text starts (one entry more than texts)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, starts, data = texts.buffers()
    offsets = np.frombuffer(starts, wide)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, wide)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def slices(offsets: np.ndarray, most: int = SLICE_BYTES, rows: int = 1 << 14) -> list[tuple[int, int]]:
    """Cut a batch into runs of about ``most`` bytes and at most ``rows`` texts; a longer text is a run by itself."""
    runs, first, n = [], 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), first + rows, n)
        runs.append((first, last))
        first = last
    return runs


def mixed(keys: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit keys in which every input bit moves every output bit."""
    z = keys.astype(np.uint64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))
