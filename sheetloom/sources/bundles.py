"""Reading written bundles back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sheetloom import schemas
from sheetloom.schemas import order_of
from sheetloom.sources.sinks import BUNDLE_NAMES
from sheetloom.sources.staging import Sheets, exists
from sheetloom.sources.tables import read_table

#: Sheets by their columns, which also tell the two Software and FileSet sheets apart.
_BY_COLUMNS = {tuple(s.names): s for s in vars(schemas).values() if isinstance(s, StructType)}


def read_sheet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A written sheet in row order: bound by the header of each part file, typed by its schema, empty cells null.

    ``columns`` are its columns where they are known, as from a manifest. Columns of no known sheet stay text.
    """
    rows = read_table(spark, path, missing=False)
    names = [c for c in rows.columns if c not in schemas.ORDER] if columns is None else columns
    absent = [c for c in names if c not in rows.columns]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    known = _BY_COLUMNS.get(tuple(names))
    kinds = {f.name: f.dataType for f in known.fields} if known is not None else {}
    cells = [F.when(F.col(c) != "", F.col(c)).cast(kinds.get(c, "string")).alias(c) for c in names]
    return rows.select(*cells, *order_of(rows))


def read_bundle(spark: SparkSession, root: str) -> Sheets:
    """The sheets of a written bundle by name, in the order of its manifest.

    The manifest is written last, so a bundle without one is not finished, and an error.
    """
    if not exists(spark, f"{root}/manifest/_SUCCESS") and not exists(spark, f"{root}/manifest"):
        raise ValueError(f"no finished bundle: {root} has no manifest")
    own = {shown: name for name, shown in BUNDLE_NAMES.items()}
    listed = read_table(spark, f"{root}/manifest", missing=False).select("sheet_order", "sheet_name", "columns").collect()
    found = {}
    for row in sorted(listed, key=lambda r: int(r["sheet_order"])):
        name = own.get(row["sheet_name"], row["sheet_name"])
        found[name] = read_sheet(spark, f"{root}/{name}", row["columns"].split(","))
    return Sheets(found)
