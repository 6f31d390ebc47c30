"""Counts over whole texts that quality rules and classifiers are built on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import slices, utf8

#: White space between words, and characters that count as symbols.
BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

COUNTS = (
    "n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words",
    "n_again_words", "n_upper", "n_letters", "n_digits", "n_marks",
)
STRUCT = ", ".join(f"{name} long" for name in COUNTS)


def _member(characters: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(characters)] = 1
    return table


_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
#: One row of 0 and 1 by byte value for each count that follows from single bytes.
_BYTE_TABLES = {
    "n_chars": 1 - _member(bytes(range(0x80, 0xC0))),
    "blanks": _member(BLANKS),
    "n_symbols": _member(SYMBOLS),
    "n_upper": _member(_UPPER),
    "n_letters": _member(_UPPER + _LOWER + bytes(range(0xC0, 0x100))),
    "n_digits": _member(bytes(range(48, 58))),
    "n_marks": _member(b"!?.,;:|"),
}


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more, the first included; each word counts once."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    codes: dict[tuple, int] = {}
    which = np.array([codes.setdefault(w, len(codes)) for w in windows])
    often = np.bincount(which)[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(often)] |= often
    return int(covered.sum())


def _by_words(text: bytes) -> tuple[int, int, int, int, int, int]:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    return (
        len(words),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(set(words)),
        sum(map(bytes.__eq__, words, words[1:])),
    )


def counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """All counts of :data:`COUNTS` for each text of an Arrow array; a null counts as empty."""
    data, offsets = utf8(texts)
    found = {name: np.zeros(len(texts), np.int64) for name in (*COUNTS, "blanks")}
    for first, last in slices(offsets):
        part = data[offsets[first] : offsets[last]]
        inner = offsets[first : last + 1] - offsets[first]
        for name, table in _BYTE_TABLES.items():
            before = np.concatenate([[0], np.cumsum(table[part])])
            found[name][first:last] = np.diff(before[inner])
        raw = part.tobytes()
        rows = [_by_words(raw[a:b]) for a, b in zip(inner[:-1].tolist(), inner[1:].tolist(), strict=True)]
        names = ("n_words", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_again_words")
        for name, values in zip(names, np.array(rows, np.int64).T, strict=True):
            found[name][first:last] = values
    found["word_chars"] = found["n_chars"] - found.pop("blanks")
    return found


def text_counts(text: Column) -> Column:
    """The counts of a text column as one struct of longs."""

    @F.arrow_udf(STRUCT)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = counts(batch)
            yield pa.StructArray.from_arrays([pa.array(found[n]) for n in COUNTS], list(COUNTS))

    return of(text)


#: Shares that do not grow with the length of a text, from the counts above.
RATIOS = {
    "mean_word": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "again_share": ("n_again_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "upper_share": ("n_upper", "n_letters"),
    "digit_share": ("n_digits", "n_chars"),
    "mark_share": ("n_marks", "n_words"),
    "words_a_line": ("n_words", "n_lines"),
}


def ratio(name: str, source: str = "") -> Column:
    """A share as a Spark column over the counts; 0 where there is nothing to divide by."""
    above, below = (F.col(f"{source}{c}") for c in RATIOS[name])
    return F.when(below > 0, above / below).otherwise(F.lit(0.0)).cast("double")


def shares(found: dict[str, np.ndarray], name: str) -> np.ndarray:
    """The same share over the counts of :func:`counts`."""
    above, below = (found[c] for c in RATIOS[name])
    return np.where(below > 0, above / np.maximum(below, 1), 0.0)


def bounded_sample(rows: DataFrame, key: Column, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hash of their key: the same rows at every run.

    Rows are counted first and thinned by the hash, so that little more than the sample is ever sorted, however
    many tasks read the table.
    """
    draw = F.pmod(F.xxhash64(F.lit(17), key), F.lit(1 << 40))
    share = min(1.0, (1.5 * most + 1000) / max(rows.count(), 1))
    thinned = rows.where(draw < int(share * (1 << 40))) if share < 1 else rows
    return thinned.orderBy(draw, key).limit(most)
