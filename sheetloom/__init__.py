"""Sample manifests in, linked submission sheets out, as Spark DataFrames."""

from sheetloom.plans.bundle import codec_sheets, regular_sheets
from sheetloom.sources.bundles import read_bundle, read_sheet
from sheetloom.sources.manifests import read_codec, read_donors, read_manifests, read_tissues
from sheetloom.sources.sinks import write_bundle, write_sheet
from sheetloom.sources.staging import scratch
from sheetloom.sources.strip import strip_file, strip_paths

__all__ = [
    "codec_sheets",
    "read_bundle",
    "read_codec",
    "read_donors",
    "read_manifests",
    "read_sheet",
    "read_tissues",
    "regular_sheets",
    "scratch",
    "strip_file",
    "strip_paths",
    "write_bundle",
    "write_sheet",
]
