"""Packing of tokenized documents into sequences of bounded length: best-fit decreasing.

A document is tokenized, closed with an end id and cut into full windows and a rest. Best-fit decreasing
places pieces from the longest to the shortest, each into the open sequence with the least room that
still takes it. It looks at lengths only, and there are no more lengths than the window has ids. So the
plan is made from the count of pieces of each length, a table of at most ``window`` rows however many
documents there are: sequences with equal room are handled as one run, and a segment tree over the
remaining room finds the tightest one. The plan says which ranks of each length go where, and every piece
finds its place from its own length and rank, without meeting the others.

Defined results: a null or empty text holds the end id only; repeated rows are packed each; an empty
table gives no piece; a text of any length is cut as it comes.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.llm.common import settled, slices, text_of, utf8

WINDOW = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
#: Text units that a worker remembers the ids of, at most.
REMEMBERED = 200_000
#: White space other than a blank and a line break.
_RARE_BLANK = re.compile(r"[^\S \n]")


#: Fixed value: the pattern by which byte-level tokenizers of this kind cut a text into words before they merge bytes.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_character() -> dict[str, int]:
    """Bytes by the characters that stand for them in a byte-level vocabulary: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class UnitTokenizer:
    """Token ids of many texts by a byte-level tokenizer file, with the ids of recurring units remembered.

    Such a tokenizer never joins what lies before a blank with the blank, if no white space follows it. Text
    between such blanks is a unit with ids of its own. New units are strung together again and encoded in one
    go; the bytes that a token stands for tell where one ends.

    Where the file numbers its tokens in the order of their merges, as it should, the merges are run by tiktoken
    over the file's own vocabulary, which gives the same ids in a fraction of the time. A text that holds a
    special token, and any text of another kind of file, goes through the file's own library as a whole.
    """

    def __init__(self, path: str, end_id: int = END_ID) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._end = np.array([end_id], "<u4").tobytes()
        self._units: dict[str, bytes] = {}
        self._again: set[str] = set()
        self._fast, self._sizes = self._merger(path)

    def _merger(self, path: str):
        """The same merges in tiktoken, and the bytes of each token; nothing where the file is of another kind."""
        import json

        import tiktoken

        whole = json.loads(Path(path).read_text())
        model, cutter = whole["model"], whole.get("pre_tokenizer") or {}
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model.get("merges", [])]
        vocabulary, letters = model.get("vocab", {}), _byte_of_character()
        in_order = [vocabulary.get(m) for m in merges] == list(range(256, 256 + len(merges)))
        if whole.get("normalizer") or cutter.get("type") != "ByteLevel" or cutter.get("add_prefix_space") or not in_order:
            return None, None
        special = set(self._special)
        ranks = {bytes(letters[c] for c in token): n for token, n in vocabulary.items() if token not in special}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, number in ranks.items():
            sizes[number] = len(token)
        return tiktoken.Encoding("merges", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}), sizes

    def forget(self) -> None:
        """Let go of what is remembered: an idle worker should hold the vocabulary only."""
        self._units, self._again = {}, set()

    def units(self, text: str) -> tuple[str, list[str]]:
        """The opening unit, and the others without the blank that each begins with."""
        first, *rest = text.split(" ")
        if "  " not in text and " \n" not in text and text[-1:] != " " and not _RARE_BLANK.search(text):
            return first, rest
        found, open_part = [], first
        for part in rest:  # a blank before white space, or at the end, belongs to what precedes it
            if part and not part[0].isspace():
                found.append(open_part)
                open_part = part
            else:
                open_part += " " + part
        found.append(open_part)
        return found[0], found[1:]

    def _whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, fresh: list[str]) -> None:
        if not fresh:
            return
        ids = self._fast.encode_to_numpy(" " + " ".join(fresh)).astype("<u4")
        ends = np.cumsum([len(u.encode()) + 1 for u in fresh])
        after = np.searchsorted(np.cumsum(self._sizes[ids]), ends, side="right") * 4
        raw, begin = ids.tobytes(), 0
        for unit, end in zip(fresh, after.tolist(), strict=True):
            self._units[unit] = raw[begin:end]
            begin = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers, closed with the end id."""
        whole = [self._fast is None or any(s in text for s in self._special) for text in texts]
        cut = [("", []) if special else self.units(text) for text, special in zip(texts, whole, strict=True)]
        used = set().union(*[rest for _, rest in cut])
        fresh = used.difference(self._units)
        self._again |= used - fresh
        if len(self._units) + len(fresh) > REMEMBERED:  # forget what has not come again
            self._units = {unit: self._units[unit] for unit in self._again}
            self._again = used - fresh
        self._learn(list(fresh))
        known = self._units.__getitem__

        def ids(text: str, special: bool, first: str, rest: list[str]) -> bytes:
            if special:
                return self._whole(text)
            return self._fast.encode_to_numpy(first).astype("<u4").tobytes() + b"".join(map(known, rest))

        return [ids(t, special, *units) + self._end for t, special, units in zip(texts, whole, cut, strict=True)]


def tokenizer_file(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_TOKENIZERS: dict[tuple, UnitTokenizer] = {}


def _tokenizer(path: str, end_id: int) -> UnitTokenizer:
    if (path, end_id) not in _TOKENIZERS:
        _TOKENIZERS[path, end_id] = UnitTokenizer(path, end_id)
    return _TOKENIZERS[path, end_id]


PIECES = "doc_id {id}, start long, length long, doc_tokens long, ids binary, block long, rank long"


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    window: int = WINDOW,
) -> DataFrame:
    """Documents cut into windows: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``ids``, ``block``, ``rank``.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers. ``block`` is the task that read
    the document, ``rank`` the number of the piece among those of its length in that block.
    """
    path = path or tokenizer_file()
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    arrow = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, block = _tokenizer(path, end_id), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            texts = batch.column(1)
            for first, last in slices(utf8(texts)[1]):
                ids = tokenizer.encode(texts[first:last].to_pylist())
                total = np.array([len(i) // 4 for i in ids], np.int64)
                count = -(-total // window)
                doc = np.repeat(np.arange(last - first), count)
                start = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * window
                length = np.minimum(window, total[doc] - start)
                bounds = zip(doc.tolist(), start.tolist(), (start + length).tolist(), strict=True)
                raw = [ids[d][4 * a : 4 * b] for d, a, b in bounds]
                order = np.argsort(length, kind="stable")
                rank = np.empty(len(order), np.int64)
                values, index, sizes = np.unique(length[order], return_index=True, return_counts=True)
                rank[order] = np.arange(len(order)) - np.repeat(index, sizes) + np.repeat(seen[values], sizes)
                seen[values] += sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[first:last].take(pa.array(doc)),
                        pa.array(start),
                        pa.array(length),
                        pa.array(total[doc]),
                        pa.array(raw, pa.binary()),
                        pa.array(np.full(len(order), block, np.int64)),
                        pa.array(rank),
                    ],
                    names=["doc_id", "start", "length", "doc_tokens", "ids", "block", "rank"],
                )
        tokenizer.forget()

    return arrow.mapInArrow(cut, PIECES.format(id=kind))


class RoomTree:
    """Segment tree over remaining room: which rooms have an open run, and the least that is large enough."""

    def __init__(self, most: int) -> None:
        self._leaves = 1 << most.bit_length()
        self._open = [0] * (2 * self._leaves)

    def add(self, room: int, change: int) -> None:
        at = room + self._leaves
        while at:
            self._open[at] += change
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that has an open run."""
        at = least + self._leaves
        if self._open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self._open[at + 1]:
                at += 1
                while at < self._leaves:
                    at = 2 * at if self._open[2 * at] else 2 * at + 1
                return at - self._leaves
            at >>= 1
        return None


@dataclass(frozen=True)
class Move:
    """Pieces of one length, from ``rank`` on, go ``each`` to a sequence from ``sequence`` on, at ``offset``."""

    length: int
    rank: int
    sequence: int
    each: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], window: int = WINDOW) -> tuple[list[Move], int]:
    """Moves that place ``counts[length]`` pieces of each length, and the number of sequences.

    Gives what placing the pieces one by one gives. Equal pieces that go to a run of equal sequences fill
    its sequences one after the other, for a sequence just used has less room than the others and is
    the tightest while it can take one more. A step splits one run at most, so the runs, and with them
    the moves, are bounded by the window alone.
    """
    tree, runs = RoomTree(window), {}  # room: runs of sequences as (first, count)
    moves: list[Move] = []
    opened = 0

    def put(room: int, first: int, count: int) -> None:
        if count and room:
            runs.setdefault(room, []).append((first, count))
            tree.add(room, 1)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, count = window, opened, -(-left // (window // length))
                opened += count
            else:
                first, count = runs[room].pop(0)
                tree.add(room, -1)
            each = room // length
            placed = min(left, count * each)
            full, over = divmod(placed, each)
            moves.append(Move(length, rank, first, each, window - room))
            put(room - each * length, first, full)
            if over:
                put(room - over * length, first + full, 1)
            put(room, first + full + bool(over), count - full - bool(over))
            left -= placed
            rank += placed
    return moves, opened


def place(cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the rows of :func:`pieces`; columns beside those it needs are kept.

    The rows are written once to the shared checkpoint folder. What meets on the driver is one count per
    length. Ranks within a length come from the ranks within blocks and a prefix sum over blocks, so a
    length that a third of all pieces has is no special case.
    """
    cut = settled(cut)
    spark = cut.sparkSession
    sizes = cut.groupBy("length", "block").agg(F.count("*").alias("n"))
    totals = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    moves, _ = best_fit_decreasing(totals, window)
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    moves.sort(key=lambda m: (m.length, m.rank))
    table = np.array([[m.length, m.rank, m.sequence, m.each, m.offset] for m in moves], np.int64).reshape(-1, 5).T
    shared = spark.sparkContext.broadcast(table)  # a few rows per length, however many pieces there are

    @F.arrow_udf("sequence_id long, offset long")
    def position(length: pa.Array, rank: pa.Array) -> pa.Array:
        lengths, ranks, sequences, eachs, offsets = shared.value
        mine, at = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        move = np.empty(len(mine), np.int64)
        for value in np.unique(mine):  # at most a window's worth of lengths
            of = mine == value
            low, high = np.searchsorted(lengths, [value, value + 1])
            move[of] = low + np.searchsorted(ranks[low:high], at[of], side="right") - 1
        within = at - ranks[move]
        sequence = sequences[move] + within // eachs[move]
        offset = offsets[move] + within % eachs[move] * mine
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    placed = cut.join(before, ["length", "block"]).withColumn("at", position("length", F.col("before") + F.col("rank")))
    kept = [c for c in cut.columns if c not in ("block", "rank")]
    return placed.select(*kept, "at.sequence_id", "at.offset")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """Pieces of all documents with their ids and places."""
    return place(pieces(docs, id_col, text_col, **params), params.get("window", WINDOW))


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """The sequences: ``sequence_id``, ``ids`` in order of offset, ``used``, ``padded_to``.

    A sequence is padded to the window with ``pad_id``, unless its own length is a power of two. A
    sequence holds at most ``window`` pieces, so a group is bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    built = packed.groupBy("sequence_id").agg(ordered.alias("parts"), F.sum("length").alias("used"))
    joined = F.aggregate("parts", F.lit(b""), lambda whole, part: F.concat(whole, part["ids"]))
    whole_power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    padded = F.when(whole_power, F.col("used")).otherwise(F.lit(window))
    padding = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (padded - F.col("used")).cast("int")))
    return built.select("sequence_id", F.concat(joined, padding).alias("ids"), "used", padded.alias("padded_to"))
