"""Substring dedup: words that a repeated window of fixed length covers are removed, but for its first place.

Each window of :data:`WINDOW` words has a Rabin-Karp hash: a prefix sum over word hashes times falling powers of an odd base,
so that a window's hash is one difference and one product. Documents meet in chunks, runs of ids of bounded size. A chunk sends each
of its distinct hashes once, in sorted order and without the bits that the order tells, to buckets of hashes. A bucket
counts which chunks hold a hash and answers each with one bit per hash: whether the first place is in that chunk. A chunk that
holds it keeps its first occurrence; all other windows are removed, and those that overlap or touch merge into maximal intervals.

Hashes have as many bits as leave less than one expected false match in a thousand tables of this size (two independent
64-bit states, cut to 66 bits or more). A passage in very many documents reaches a bucket once per chunk, whatever its
count; a run of ids beyond the bound of a chunk, also of one id or of rows without an id, is split by the hash of id and text.

Defined results: a null text has no words; rows without an id come first, rows of one id in the order of the unsigned XXH64 of id and
text; repeated rows are documents of their own, of which the first keeps its words; very long texts are one document in one
chunk; texts of fewer words than a window are left alone; where all words go the rest is empty; an empty table gives an empty result; other
columns have no part, whatever they are called. Ids are whole numbers.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterable
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.llm.common import mixed, text_of

WINDOW = 20
#: Bytes of text of a chunk, about, and windows of a bucket. A task holds one of either.
CHUNK_BYTES = 4 << 20
BUCKET_WINDOWS = 1 << 21
#: Runs of ids that chunks are put together from; their sizes are all that the driver sees.
RUNS = 4096
#: Bits of a hash that its cell tells; buckets are runs of cells.
CELL_BITS = 18
#: Distinct words that a worker remembers.
REMEMBERED = 400_000
#: Odd bases of the two rolling hashes.
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_LOW = 64 - CELL_BITS


class _Words(dict):
    """Number of each word; its two hashes are found once, when it is first seen."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes = array("Q"), array("Q")

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.hashes[0])
        for seed, held in enumerate(self.hashes, 1):
            held.append(xxhash.xxh64_intdigest(word, seed))
        return code


_WORDS = _Words()


def _rolling(words: np.ndarray, base: np.uint64, window: int) -> np.ndarray:
    """Hash of the window from each word on, sum of word k times base ** (last - k), modulo 2 ** 64."""
    n = len(words)
    falling = np.full(n, pow(int(base), -1, 1 << 64), np.uint64)
    falling[:1] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(falling, dtype=np.uint64), dtype=np.uint64)])
    rising = np.full(max(n - window + 1, 0), base, np.uint64)
    rising[:1] = pow(int(base), window - 1, 1 << 64)
    return (sums[window:] - sums[: len(rising)]) * np.cumprod(rising, dtype=np.uint64)


class Chunk:
    """Distinct window hashes of some documents in their order."""

    def __init__(self, texts: Iterable[bytes], window: int, low_bits: int) -> None:
        global _WORDS
        if len(_WORDS) > REMEMBERED:
            _WORDS = _Words()
        self.window = window
        codes, ends = array("q"), array("q")
        for text in texts:
            codes.extend(map(_WORDS.__getitem__, text.split()))  # at the six ASCII blanks, as bytes do
            ends.append(len(codes))
        self.ends = np.array(ends, np.int64)
        self.sizes = np.diff(self.ends, prepend=0)
        which = np.array(codes, np.int64)
        whole = np.repeat(self.ends, self.sizes) - np.arange(len(which)) >= window
        self.starts = np.flatnonzero(whole)  # words that a window begins with
        one, two = (
            _rolling(np.array(held, np.uint64)[which], base, window)[self.starts] for held, base in zip(_WORDS.hashes, _BASES, strict=True)
        )
        high = mixed(one ^ mixed(two))
        low = mixed(two + high) >> np.uint64(64 - low_bits)
        order = np.argsort(high)
        new = high[order][1:] != high[order][:-1]
        if not np.all(new | (low[order][1:] == low[order][:-1])):  # equal first halves of different hashes
            order = np.lexsort((low, high))
            new = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
        self.order = order
        self.first = np.flatnonzero(np.concatenate([np.ones(min(len(order), 1), bool), new]))
        self.high, self.low = high[order[self.first]], low[order[self.first]]
        #: For each distinct hash the window that comes first.
        self.earliest = np.minimum.reduceat(order, self.first) if len(order) else order

    def cuts(self, buckets: int) -> np.ndarray:
        """Where the distinct hashes of each bucket begin, and the end."""
        edges = (np.arange(1, buckets, dtype=np.uint64) << np.uint64(64 - buckets.bit_length() + 1)) if buckets > 1 else np.zeros(0, np.uint64)
        return np.concatenate([[0], np.searchsorted(self.high, edges), [len(self.high)]])

    def kept(self, owned: np.ndarray) -> list[np.ndarray]:
        """Which words of each document stay, if the first place of some distinct hashes is in this chunk."""
        gone = np.ones(len(self.order), bool)
        gone[self.earliest[owned]] = False
        at = self.starts[gone]
        change = np.zeros(int(self.sizes.sum()) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + self.window, -1)
        return np.split(np.cumsum(change[:-1]) == 0, self.ends[:-1])


def packed(high: np.ndarray, low: np.ndarray, low_bits: int, cells: int) -> tuple[bytes, bytes]:
    """Sorted hashes as counts of their cells, and the bits below: six bytes, which take two bits of ``low``, and the rest of it."""
    inside = ((high >> np.uint64(_LOW)) % np.uint64(cells)).astype(np.int64)
    counts = np.bincount(inside, minlength=cells)
    small = counts.max(initial=0) < 256
    rest = low_bits - 2
    main = ((high & np.uint64((1 << _LOW) - 1)) << np.uint64(2)) | (low >> np.uint64(rest))
    parts = [main.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]]
    if rest:
        parts.append(low.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - rest // 8 :])
    return counts.astype(np.uint8 if small else "<u4").tobytes(), np.concatenate(parts, axis=1).tobytes()


def unpacked(counts: bytes, lows: bytes, low_bits: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes within their bucket, as :func:`packed` was given them (``high`` without the bits that the bucket tells), and ``low``."""
    many = np.frombuffer(counts, np.uint8 if len(counts) == cells else "<u4")
    rest = low_bits - 2
    raw = np.frombuffer(lows, np.uint8).reshape(-1, 6 + rest // 8)
    wide = np.zeros((2, len(raw), 8), np.uint8)
    wide[0, :, 2:] = raw[:, :6]
    wide[1, :, 8 - rest // 8 :] = raw[:, 6:]
    main, tail = wide.view(">u8")[:, :, 0].astype(np.uint64)
    cell = np.repeat(np.arange(cells, dtype=np.uint64), many)
    low = ((main & np.uint64(3)) << np.uint64(rest)) | (tail & np.uint64((1 << rest) - 1))
    return (cell << np.uint64(_LOW)) | (main >> np.uint64(2)), low


def first_places(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For hashes in the order of their places: whether a place is the first of its hash."""
    order = np.argsort(high, kind="stable")
    same = high[order][1:] == high[order][:-1]
    if np.any(same & (low[order][1:] != low[order][:-1])):
        order = np.lexsort((low, high))
        same = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
    found = np.ones(len(order), bool)
    found[order[1:][same]] = False
    return found


# ---- chunks of documents


class Plan:
    """Chunks of a table, and the sizes that follow from its bytes."""

    def __init__(self, bounds: list[int], runs: list) -> None:
        self.bounds = np.array(bounds, np.int64)
        total = sum(r["bytes"] for r in runs)
        matches = 2 * math.log2(max(total / 4, 2)) + 9  # for less than 1 / 1000 expected false matches
        self.low_bits = 2 + 8 * max(0, math.ceil((matches - 66) / 8))
        self.buckets = 1 << min(CELL_BITS, max(4, math.ceil(math.log2(max(total / 6 / BUCKET_WINDOWS, 1)))))
        many = len(bounds) + 2
        #: Of each run of ids: the first of its chunks, how many it is split into, its group of chunks, and its least id.
        self.first, self.split, self.group, self.least = (np.zeros(many, np.int64) for _ in range(4))
        self.split[:] = 1
        chunk = group = -1
        room = 0
        for r in sorted(runs, key=lambda r: r["run"]):
            parts = max(1, -(-r["bytes"] // CHUNK_BYTES))
            if parts > 1 or r["bytes"] > room:
                chunk, group, room = chunk + 1, group + 1, CHUNK_BYTES
            at = r["run"]
            self.first[at], self.split[at], self.group[at], self.least[at] = chunk, parts, group, r["least"] or 0
            room = room - r["bytes"] if parts == 1 else 0
            chunk += parts - 1
        self.chunks = chunk + 1
        if self.low_bits > 64:
            raise ValueError("the table is too large for hashes of 128 bits")

    def run(self, ids: pa.Array) -> np.ndarray:
        """Run of each id; 0 is that of rows without one."""
        known = ids.fill_null(0).to_numpy(zero_copy_only=False)
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, 1 + np.searchsorted(self.bounds, known))


def planned(rows: DataFrame) -> Plan:
    """Ids are cut into runs at approximate quantiles; neighbouring runs fill a chunk, and a run beyond it is split."""
    shares = F.array(*[F.lit((k + 1) / RUNS) for k in range(RUNS - 1)])
    bounds = sorted(set(rows.agg(F.percentile_approx("id", shares, F.lit(10 * RUNS)).alias("b")).first()["b"] or []))
    empty = Plan(bounds, [])
    run = F.arrow_udf(lambda ids: pa.array(empty.run(ids), pa.int64()), "long")
    sized = rows.select(run("id").alias("run"), "id", F.octet_length("text").cast("long").alias("bytes"))
    return Plan(bounds, sized.groupBy("run").agg(F.sum("bytes").alias("bytes"), F.min("id").alias("least")).collect())


def _sorted(table: pa.Table) -> tuple[list, np.ndarray, list[bytes]]:
    """Order of a chunk's rows, their ids (no id: 0), and their texts in that order."""
    ids, keys = table.column("id").to_pylist(), table.column("row_key").to_pylist()
    texts = table.column("text").cast(pa.binary()).to_pylist()
    place = [(i is not None, i or 0, k % (1 << 64), t) for i, k, t in zip(ids, keys, texts, strict=True)]
    order = sorted(range(len(ids)), key=place.__getitem__)
    return order, np.array([ids[k] or 0 for k in order], np.int64), [texts[k] for k in order]


_SENT = "bucket int, chunk long, grp long, counts binary, lows binary, places binary"
_ANSWER = "chunk long, bucket int, first binary"
SPANS = "array<struct<start:long,length:long>>"


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``spans`` (maximal runs of removed words, from 0) and ``kept`` (the rest, joined by blanks).

    Texts are shuffled once, into chunks, and read there twice: for their hashes and for what the buckets answer.
    """
    kind = docs.select(id_col).schema[0].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"ids must be whole numbers, not {kind.simpleString()}")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    plan = planned(rows)

    @F.arrow_udf("chunk long, grp long, least long, split boolean")
    def home(ids: pa.Array, keys: pa.Array) -> pa.Array:
        run = plan.run(ids)
        share = (keys.to_numpy().view(np.uint64) >> np.uint64(33)).astype(np.int64)  # in the order of the keys
        part = share * plan.split[run] >> 31
        columns = [plan.first[run] + part, plan.group[run], plan.least[run]]
        return pa.StructArray.from_arrays([*map(pa.array, columns), pa.array(plan.split[run] > 1)], ["chunk", "grp", "least", "split"])

    keyed = rows.withColumn("row_key", F.xxhash64("id", "text"))
    placed = keyed.select("id", "text", "row_key", home("id", "row_key").alias("home")).select("id", "text", "row_key", "home.*")
    dealt = placed.repartition(min(max(plan.chunks, 1), 1 << 15), "chunk")
    cells = (1 << CELL_BITS) // plan.buckets

    def send(table: pa.Table) -> pa.Table:
        _, ids, texts = _sorted(table)
        chunk = Chunk(texts, window, plan.low_bits)
        cuts = chunk.cuts(plan.buckets)
        number, group, split = (table.column(c)[0].as_py() for c in ("chunk", "grp", "split"))
        if split:  # other chunks share this run of ids: the places of documents in it go along
            owner = np.searchsorted(chunk.ends, chunk.starts[chunk.earliest], side="right")
            after = (ids - table.column("least")[0].as_py())[owner]
        out: dict[str, list] = {name: [] for name in ("bucket", "chunk", "grp", "counts", "lows", "places")}
        for bucket, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
            if a == b:
                continue
            counts, lows = packed(chunk.high[a:b], chunk.low[a:b], plan.low_bits, cells)
            places = after[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (int(after.max()).bit_length() + 7) // 8] if split else b""
            for name, value in zip(out, (bucket, number, group, counts, lows, bytes(places.tobytes() if split else places)), strict=True):
                out[name].append(value)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    def answer(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("chunk").to_numpy(), table.column("grp").to_numpy()))
        sent = table.take(pa.array(order)).to_pylist()
        parts = [unpacked(s["counts"], s["lows"], plan.low_bits, cells) for s in sent]
        ends = np.cumsum([len(p[0]) for p in parts])
        high, low = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        turn = np.arange(len(high))
        groups = np.array([s["grp"] for s in sent])
        for group in np.unique(groups[1:][groups[1:] == groups[:-1]]):  # chunks that share a run of ids: by document
            mine = np.flatnonzero(groups == group)
            a, b = int(ends[mine[0]] - len(parts[mine[0]][0])), int(ends[mine[-1]])
            turn[a:b] = a + np.argsort(np.concatenate([_places(sent[k]["places"], len(parts[k][0])) for k in mine]), kind="stable")
        found = np.empty(len(high), bool)
        found[turn] = first_places(high[turn], low[turn])
        bits = [np.packbits(f).tobytes() for f in np.split(found, ends[:-1])]
        return pa.table([
            pa.array([s["chunk"] for s in sent], pa.int64()), pa.array([s["bucket"] for s in sent], pa.int32()), pa.array(bits, pa.binary()),
        ], names=["chunk", "bucket", "first"])

    answers = dealt.groupBy("chunk").applyInArrow(send, _SENT).groupBy("bucket").applyInArrow(answer, _ANSWER)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        order, _, texts = _sorted(left) if left.num_rows else ([], None, [])
        chunk = Chunk(texts, window, plan.low_bits)
        cuts = chunk.cuts(plan.buckets)
        owned = np.zeros(len(chunk.high), bool)
        for bucket, raw in zip(right.column("bucket").to_pylist(), right.column("first").to_pylist(), strict=True):
            a, b = cuts[bucket], cuts[bucket + 1]
            owned[a:b] = np.unpackbits(np.frombuffer(raw, np.uint8), count=b - a).astype(bool)
        removed, spans, rest = [], [], []
        for text, stays in zip(texts, chunk.kept(owned) if order else [], strict=True):
            words = text.split()
            removed.append(len(words) - int(stays.sum()))
            edges = np.flatnonzero(np.diff(np.concatenate([[True], stays, [True]]))).tolist()
            spans.append([{"start": a, "length": b - a} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            rest.append(b" ".join(compress(words, stays.tolist()) if removed[-1] else words))
        columns = [
            left.column("id").take(pa.array(order, pa.int64())), pa.array(chunk.sizes), pa.array(removed, pa.int64()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), pa.array(rest, pa.binary()).cast(pa.string()),
        ]
        return pa.table(columns, names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    found = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    found = found.applyInArrow(cut, f"doc_id long, n_words long, n_removed long, spans {SPANS}, kept string")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def _places(raw: bytes, many: int) -> np.ndarray:
    """Places of documents in their run, written in as many bytes as they took."""
    wide = np.zeros((many, 8), np.uint8)
    held = np.frombuffer(raw, np.uint8).reshape(many, -1)
    wide[:, : held.shape[1]] = held
    return wide.view("<u8")[:, 0]
