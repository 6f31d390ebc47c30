"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

A rolling hash runs over the hashes of a text's lines and marks those at which a chunk may end: it depends on the
last :data:`WINDOW` lines alone, so after lines are put in or taken out the same lines are marked. From every line a chunk goes
to the first mark at least one line further on, :data:`MOST_LINES` lines at most. So a chunk has several lines, starts
wherever a shared passage starts, and ends within it, whatever stands around the passage; most lines are marked, so that short
passages hold chunks, too. Chunks that occur more than once in the whole table are removed everywhere but at their first place,
after their bytes have been compared; what overlapping chunks cover goes as one. A line of over :data:`LONG_LINE_WORDS` words
is also a chunk by itself, so that a passage in one line is found whatever surrounds it.

Lines without a word are no lines of a chunk: they stand behind the line before them, and go with it.

Defined results: a null text stays null and an empty one empty; the first place is that of the smallest
``doc_id`` (no id last), then the smallest hash of id and text, then the earliest in the text; rows repeated in id
and text are one document and end up alike; of a run of equal lines in one text the first ones stay; a single short line is
never removed by itself; where every line of a text is removed the text is empty; an empty table gives an empty
result. Texts may have any number of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import settled, whole_rows

WINDOW = 2
#: One line in DIVISOR is not marked.
DIVISOR = 8
MOST_LINES = 8
LONG_LINE_WORDS = 50
#: Prime that rolling hashes are taken by, so that all bits of a line's value move the remainder by DIVISOR.
PRIME = 4093
#: Rows of a table of hashes up to which it is broadcast: 16 bytes each, so 64 MB at most.
BROADCAST_ROWS = 4_000_000


def line_value(line: Column) -> Column:
    """Hash of a line in 0..4095: the first three hexadecimal digits of its MD5."""
    digits = F.md5(F.encode(line, "UTF-8"))
    return F.conv(F.substring(digits, 1, 3), 16, 10).cast("int")


def is_long(line: Column) -> Column:
    return F.regexp_count(line, F.lit("[^ ]+")) > LONG_LINE_WORDS


def _times(factor: int):
    return lambda value: value * (factor % PRIME)


def _marks(values: Column, window: int, divisor: int) -> Column:
    """Whether a chunk may end at each line, by the values of it and the lines before. Arrays are walked in step."""
    rolled, factor = values, 1
    for back in range(1, window):
        factor *= 31
        shifted = F.slice(F.concat(F.array_repeat(F.lit(0), back), values), F.lit(1), F.size(values))
        rolled = F.zip_with(rolled, F.transform(shifted, _times(factor)), lambda r, v: r + v)
    return F.transform(rolled, lambda r: r % PRIME % divisor != 0)


def chunks(rows: DataFrame, text: str = "text", window: int = WINDOW, divisor: int = DIVISOR) -> DataFrame:
    """Replace column ``text`` with its ``lines``, its ``worded`` lines (``at``, ``line``) and its chunks ``spans``.

    A span (``first``, ``last``) counts lines with a word from 0. Each ``explode`` of one element holds an array
    fast, so that what is computed from it does not compute it again for every element.
    """
    others = [c for c in rows.columns if c != text]
    held = [*others, "lines", "worded"]
    lines = rows.select(*others, F.explode(F.array(F.split(text, "\n", -1))).alias("lines"))
    numbered = F.transform("lines", lambda line, at: F.struct(at.alias("at"), line.alias("line")))
    worded = lines.select(*others, "lines", F.explode(F.array(F.filter(numbered, lambda c: c["line"].rlike(r"[^\s]")))).alias("worded"))
    values = F.transform("worded", lambda c: line_value(c["line"]))
    longs = F.transform("worded", lambda c: is_long(c["line"]))
    valued = worded.select(*held, F.explode(F.array(F.struct(values.alias("values"), longs.alias("longs")))).alias("v"))
    marked = valued.select(*held, F.col("v.longs").alias("longs"), F.explode(F.array(_marks(F.col("v.values"), window, divisor))).alias("marks"))
    end = F.size("worded") - 1

    def several(k: Column) -> Column:
        ahead = F.coalesce(*[F.when(F.get("marks", k + step), step) for step in range(1, MOST_LINES - 1)], F.lit(MOST_LINES - 1))
        return F.struct(k.alias("first"), F.least(k + ahead, end).alias("last"))

    places = F.transform("worded", lambda c, k: k)
    alone = F.transform(F.filter(places, lambda k: F.get("longs", k)), lambda k: F.struct(k.alias("first"), k.alias("last")))
    spans = F.concat(F.transform(F.filter(places, lambda k: k < end), several), alone)
    return marked.select(*held, spans.alias("spans"))


def _body(span: Column) -> Column:
    """Text of a chunk."""
    return F.concat_ws("\n", F.transform(F.slice("worded", span["first"] + 1, span["last"] - span["first"] + 1), lambda c: c["line"]))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> dict[str, Column]:
    return {"id": F.col(id_col), "row_key": F.xxhash64(id_col, text_col)}


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params: int) -> DataFrame:
    """``id``, ``row_key``, ``first``, ``last``: the chunks to remove, by their lines with a word, counted from 0.

    First, hashes alone are counted. Then the texts of chunks with a repeated hash, and of no others, are grouped by
    their bytes, which tells the first place of each. A hash that stands for one text needs no further
    look; where two texts share it, places are told apart by the text.
    """
    key = _keyed(docs, id_col, text_col)
    named = [c.alias(n) for n, c in key.items()]
    texts = docs.where(F.col(text_col).isNotNull()).select(*named, F.col(text_col).cast("string").alias("text"))
    cut = chunks(texts, **params)
    parts = F.transform("spans", lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), _body(s).alias("text")))
    every = cut.select("id", "row_key", F.explode(parts).alias("part")).select("id", "row_key", "part.first", "part.last", "part")
    hashed = every.withColumn("hash", F.xxhash64("part.text"))
    places = settled(hashed.select("id", "row_key", "first", "last", "hash"))
    repeated = settled(places.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    small = repeated.count() <= BROADCAST_ROWS
    again = hashed.join(F.broadcast(repeated) if small else repeated, "hash")
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row_key", F.col("first").alias("line"))
    firsts = settled(again.groupBy("hash", F.col("part.text").alias("chunk")).agg(F.min(place).alias("origin")))
    alone = firsts.groupBy("hash").agg(F.count("*").alias("texts"), F.min("origin").alias("origin"))
    settled_by_hash = places.join(alone.where("texts = 1").select("hash", "origin"), "hash")
    shared = alone.where("texts > 1").select("hash")
    if shared.isEmpty():
        decided = settled_by_hash
    else:
        told = again.join(shared, "hash", "left_semi").select(*places.columns, F.col("part.text").alias("chunk"))
        decided = settled_by_hash.unionByName(told.join(firsts, ["hash", "chunk"]).drop("chunk"))
    return decided.where(~place.eqNullSafe(F.col("origin"))).select("id", "row_key", "first", "last")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params: int) -> DataFrame:
    """``row`` (the document as it was), ``text`` without repeated chunks, ``n_removed`` (lines with a word).

    Texts are shuffled once, to meet the numbers of their removed lines.
    """
    found = removals(docs, id_col, text_col, **params).select("id", "row_key", F.explode(F.sequence("first", "last")).alias("k"))
    gone = found.groupBy("id", "row_key").agg(F.collect_set("k").alias("gone"))
    gone = gone.withColumnsRenamed({"id": "gone_id", "row_key": "gone_key"})
    rows = whole_rows(docs, whole=F.col(text_col).cast("string"), **_keyed(docs, id_col, text_col))
    same = (F.col("row_key") == F.col("gone_key")) & F.col("id").eqNullSafe(F.col("gone_id"))
    touched = F.col("gone").isNotNull()
    met = rows.join(gone, same, "left").select("row", "whole", "gone", F.when(touched, F.col("whole")).otherwise("").alias("text"))
    cut = chunks(met, **params)  # an untouched text is not cut again
    kept = F.array_except(F.transform("worded", lambda c, k: k), "gone")
    held = cut.select("row", "whole", "gone", F.explode(F.array(F.struct("lines", F.col("worded.at").alias("at"), kept.alias("kept")))).alias("v"))

    def piece(k: Column) -> Column:
        """A line with the lines without a word behind it."""
        begin, end = F.get("v.at", k), F.coalesce(F.get("v.at", k + 1), F.size("v.lines"))
        return F.concat_ws("\n", F.slice("v.lines", begin + 1, end - begin))

    before = F.coalesce(F.get("v.at", F.lit(0)), F.lit(0))  # lines without a word at the very beginning
    leading = F.when(before > 0, F.array(F.concat_ws("\n", F.slice("v.lines", F.lit(1), before)))).otherwise(F.array().cast("array<string>"))
    rest = F.concat_ws("\n", F.concat(leading, F.transform("v.kept", piece)))
    return held.select(
        "row",
        F.when(F.col("gone").isNotNull(), rest).otherwise(F.col("whole")).alias("text"),
        F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(0).alias("n_removed"),
    )


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params: int) -> DataFrame:
    """The documents with their texts deduplicated; one whose text is all removed goes."""
    found = dedup_lines(docs, id_col, text_col, **params)
    left = found.where((F.col("n_removed") == 0) | (F.col("text") != ""))
    return left.select(*[(F.col("text") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
