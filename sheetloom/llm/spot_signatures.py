"""Document fingerprints by SpotSigs: chains of content words behind common words.

Wherever a common word (an anchor) occurs, the next content words make a signature. Anchors are the most frequent words
of the corpus in each script, counted over all rows. They are spread over natural prose, and rare in menus and
listings, so the set of signatures stands for what a document says. Two documents are compared by the Jaccard share of
their sets; sets whose sizes differ too much need no comparison, which :func:`similar` uses to partition by size.

In a text where anchors are rare (less than one word in :data:`RARE`: a list, a short text, a language with few rows) every word
whose hash is a multiple of :data:`PICK` serves as an anchor too, in a text of up to :data:`SHORT` words every word, and chains
take the words that follow. So every text with a word has chains, and texts that differ in one word share most of them.
Scripts without blanks are taken character by character.

Defined results: a null text is empty; a text without a word, the empty one included, gets one signature from all
of its characters, so equal texts and only those share it; a fingerprint lists the set in order, in
base64; repeated rows are compared as they come; rows of one id are in order of the XXH64 of id and text, rows without an id come
last; ids may be of any atomic type that has an order; an empty table gives an empty result.
"""

from __future__ import annotations

import binascii
import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.llm.common import mixed, settled, slices, text_of, utf8
from sheetloom.llm.components import components
from sheetloom.llm.text_stats import bounded_sample

#: Content words of a signature.
CHAIN = 2
#: Anchors of each script, and how often a word occurs at least to be one: in a small corpus no word is common.
COMMON, LEAST = 60, 20
#: A text with fewer anchors than one in so many words also has anchors by hash, one in PICK words, or all in a short text.
RARE, PICK, SHORT = 20, 4, 50
#: Rows of a part, about, which a task reads in order; the most parts, and rows that are sampled to place the cut between two.
PART_ROWS, MOST_PARTS, SAMPLED = 500, 100_000, 5
#: Distinct words that a worker remembers.
REMEMBERED = 400_000

#: First code points of scripts; what lies before the next one belongs to it.
SCRIPTS = (
    (0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"),
    (0x900, "indic"), (0xE00, "thai"), (0x1000, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3000, "cjk"), (0xA000, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0x20000, "cjk"),
)
_FIRST = np.array([first for first, _ in SCRIPTS])
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”’…¿¡–—"
#: Characters that are words by themselves, since their scripts put no blanks between words.
_ALONE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")


def words_of(text: str) -> list[str]:
    if not text.isascii() and _ALONE.search(text):
        text = _ALONE.sub(r" \g<0> ", text)
    return text.split()


def script_of(word: str) -> str:
    return SCRIPTS[int(np.searchsorted(_FIRST, ord(word[0]), side="right")) - 1][1]


def common_words(docs: DataFrame, text_col: str = "text", most: int = COMMON, least: int = LEAST) -> tuple[str, ...]:
    """The ``most`` most frequent words of each script over whole texts of all rows; ties go to the first by code points.

    A task counts the words it reads and hands on a count for each, from time to time; Spark adds them up. What comes
    to the driver is ``most`` words for each of a fixed list of scripts.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def emptied() -> pa.RecordBatch:
            bare: Counter = Counter()
            for word, n in held.items():
                bare[word.lower().strip(_EDGES)] += n
            held.clear()
            known = [(w, script_of(w), n) for w, n in bare.items() if w and w[0].isalpha()]
            columns = [list(c) for c in zip(*known, strict=True)] or [[], [], []]
            kinds = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["word", "script", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.update(words_of(text.as_py()))
                if len(held) > REMEMBERED:
                    yield emptied()
        yield emptied()

    found = docs.select(text_of(text_col).alias("text")).mapInArrow(counted, "word string, script string, n long")
    total = found.groupBy("script", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    first = Window.partitionBy("script").orderBy(F.desc("n"), "word")
    kept = total.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= most)
    return tuple(sorted(r["word"] for r in kept.select("word").collect()))


class _Words(dict):
    """Number of each word as it is written; its hash and kind are found once, when it is first seen."""

    def __init__(self, anchors: tuple[str, ...]) -> None:
        super().__init__()
        self._anchors = frozenset(anchors)
        self.hashes: list[int] = []
        self.kinds: list[int] = []

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self.hashes)
        bare = word.lower().strip(_EDGES)
        self.hashes.append(xxhash.xxh64_intdigest(bare.encode()))
        self.kinds.append(2 if bare in self._anchors else 1 if bare else 0)
        return code


class Spotter:
    """Signature sets of texts."""

    def __init__(self, anchors: tuple[str, ...], chain: int = CHAIN) -> None:
        self._chain, self._anchors = chain, anchors
        self._words = _Words(anchors)

    def _chains(self, starts: np.ndarray, following: np.ndarray, begin: np.ndarray, hashes: np.ndarray, text: np.ndarray, salt: int) -> np.ndarray:
        """Signatures of words ``starts``, each with the next words of the list ``following`` from ``begin`` on, within its text."""
        state = mixed(hashes[starts] ^ np.uint64(salt))
        padded = np.append(following, len(text))
        owner = np.append(text, -1)
        for k in range(self._chain):
            ahead = padded[np.minimum(begin + k, len(following))]
            here = owner[ahead] == text[starts]
            state = np.where(here, mixed(state + np.append(hashes, np.uint64(0))[ahead]), state)
        return (text[starts].astype(np.uint64) << np.uint64(32)) | (state >> np.uint64(32))

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """Sorted distinct signatures (unsigned 32-bit) of each text."""
        if len(self._words) > REMEMBERED:
            self._words = _Words(self._anchors)
        codes: list[int] = []
        ends = []
        for text in texts:
            codes += map(self._words.__getitem__, words_of(text))
            ends.append(len(codes))
        which = np.array(codes, np.int64)
        hashes, kinds = np.array(self._words.hashes, np.uint64), np.array(self._words.kinds, np.int8)
        hashes, kinds = (hashes[which], kinds[which]) if len(which) else (np.zeros(0, np.uint64), np.zeros(0, np.int8))
        text = np.repeat(np.arange(len(texts)), np.diff(np.array(ends, np.int64), prepend=0))
        content, spots, all_words = (np.flatnonzero(k) for k in (kinds == 1, kinds == 2, kinds > 0))
        nearest = np.searchsorted(content, spots)  # the first content word behind each anchor
        behind = np.append(text[content], -1)[np.minimum(nearest, len(content))] == text[spots]
        spots, nearest = spots[behind], nearest[behind]
        found = [self._chains(spots, content, nearest, hashes, text, 0)]

        sizes = np.bincount(text[all_words], minlength=len(texts))
        rare = np.bincount(text[spots], minlength=len(texts)) * RARE < sizes
        picked = hashes[all_words] % np.uint64(PICK) == 0
        few = (sizes <= SHORT) | (np.bincount(text[all_words], picked, len(texts)) == 0)
        chosen = np.flatnonzero(rare[text[all_words]] & (picked | few[text[all_words]]))
        found.append(self._chains(all_words[chosen], all_words, chosen + 1, hashes, text, 0x5851F42D4C957F2D))
        keyed = np.unique(np.concatenate(found))
        cut = np.searchsorted(keyed, np.arange(len(texts) + 1).astype(np.uint64) << np.uint64(32))
        return [
            keyed[low:high].astype(np.uint32) if low < high else np.array([xxhash.xxh32_intdigest(texts[row].encode())], np.uint32)
            for row, (low, high) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
        ]


_SPOTTERS: dict[tuple, Spotter] = {}


def _spotter(chain: int, anchors: tuple[str, ...]) -> Spotter:
    if (chain, anchors) not in _SPOTTERS:
        _SPOTTERS.clear()
        _SPOTTERS[chain, anchors] = Spotter(anchors, chain)
    return _SPOTTERS[chain, anchors]


def written(signatures: np.ndarray) -> str:
    return binascii.b2a_base64(signatures.astype("<u4").tobytes(), newline=False).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(binascii.a2b_base64(fingerprint), "<u4")


def jaccard(one: np.ndarray, two: np.ndarray, least: float = 0.0) -> float:
    """Share of common members of two sorted sets; 0 without a look where their sizes rule ``least`` out."""
    small, large = sorted((len(one), len(two)))
    if small < least * large:
        return 0.0
    common = len(np.intersect1d(one, two, assume_unique=True)) if small else 0
    return common / (small + large - common) if large else 1.0


def fingerprint(text: Column, anchors: tuple[str, ...], chain: int = CHAIN) -> Column:
    """Struct of ``fingerprint`` and ``n_signatures`` for a text column."""

    @F.arrow_udf("fingerprint string, n_signatures int")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        spotter = _spotter(chain, anchors)
        for batch in batches:
            sets = [s for a, b in slices(utf8(batch)[1]) for s in spotter.sets(batch[a:b].to_pylist())]
            yield pa.StructArray.from_arrays(
                [pa.array([written(s) for s in sets], pa.string()), pa.array([len(s) for s in sets], pa.int32())],
                ["fingerprint", "n_signatures"],
            )

    return of(text)


# ---- a document against its neighbour and an edited text

EDITED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [f.split()[0] for f in EDITED.split(", ")]


class _Row:
    """A document: its id, its text, and its signatures once they are known."""

    __slots__ = ("id", "text", "found")

    def __init__(self, id_: object, text: str, found: np.ndarray) -> None:
        self.id, self.text, self.found = id_, text, found


def _judged(rows: list[_Row], nexts: list[_Row], spotter: Spotter, id_type: pa.DataType) -> list[pa.Array]:
    """The columns of some documents, each held against the next one and against its edited text."""
    edited = [r.text[: len(r.text) - len(r.text) // 2] + n.text[: len(r.text) // 2] for r, n in zip(rows, nexts, strict=True)]
    sets = spotter.sets(edited)
    return [
        pa.array([r.id for r in rows], id_type),
        pa.array([len(r.text) for r in rows], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array([written(r.found) for r in rows], pa.string()),
        pa.array([written(s) for s in sets], pa.string()),
        pa.array([jaccard(r.found, s) for r, s in zip(rows, sets, strict=True)], pa.float64()),
        pa.array([jaccard(r.found, n.found) for r, n in zip(rows, nexts, strict=True)], pa.float64()),
    ]


def _heads(rows: DataFrame, part_rows: int) -> list[tuple]:
    """The rows that parts begin with, as ``(has an id, id, - key)`` in rising order; the last one is the first document.

    Quantiles of a sample of at most SAMPLED * MOST_PARTS rows' ids and keys.
    """
    order = [F.col("at").desc_nulls_last(), F.col("row_key")]
    first = rows.select("at", "row_key").orderBy(*order).limit(1).collect()
    if not first:
        return []
    parts = max(1, min(MOST_PARTS, rows.count() // part_rows))
    sample = bounded_sample(rows.select("at", "row_key"), F.col("row_key"), SAMPLED * parts).collect() if parts > 1 else []
    rising = sorted((r["at"] is not None, 0 if r["at"] is None else r["at"], -r["row_key"]) for r in sample)
    (top,) = first
    heads = {rising[len(rising) * k // parts] for k in range(1, parts)} if rising else set()
    return sorted({*heads, (top["at"] is not None, 0 if top["at"] is None else top["at"], -top["row_key"])})


def against_next(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chain: int = CHAIN,
    anchors: tuple[str, ...] | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Each document's fingerprint, held against that of an edited text and of the next document.

    The next document is the one with the next smaller id, for the last one the first. The edited text has
    the last half of its code points (rounded down) replaced by as many of the next document's first ones.

    Documents in falling order of id and key (XXH64 of id and text) are cut into parts at documents of a sample. A part is read in
    order in one task, and the document that each part begins with goes to the end of the part before, too. So texts are
    shuffled once, and an id that very many rows share, or none, spreads over parts.
    """
    anchors = common_words(docs, text_col) if anchors is None else anchors
    kind = docs.select(id_col).schema[0].dataType
    at = F.unix_micros(F.col("doc_id")) if isinstance(kind, T.TimestampType) else F.col("doc_id")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", "text", at.alias("at"), F.xxhash64("doc_id", "text").alias("row_key"))
    rising = _heads(rows, part_rows)

    @F.arrow_udf("array<struct<part:int,peek:boolean>>")
    def homes(ids: pa.Array, keys: pa.Array) -> pa.Array:
        """A row's own part, and for the one that a part begins with the part before, which looks ahead to it."""
        out, last = [], len(rising) - 1
        for value, key in zip(ids.to_pylist(), keys.to_pylist(), strict=True):
            place = (value is not None, 0 if value is None else value, -key)
            head = bisect_left(rising, place)
            part = last - head
            out.append([{"part": part, "peek": False}])
            if rising[head] == place:
                out[-1].append({"part": part - 1 if part else last, "peek": True})
        return pa.array(out, pa.list_(pa.struct([("part", pa.int32()), ("peek", pa.bool_())])))

    spread = rows.withColumn("home", F.explode(homes("at", "row_key"))).select("doc_id", "text", "home.part", "home.peek", "at", "row_key")
    dealt = spread.repartition("part").sortWithinPartitions("part", "peek", F.col("at").desc_nulls_last(), "row_key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spotter, held, held_part = _spotter(chain, anchors), None, None  # the row that waits for its next one
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            parts, peeks = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for a, b in slices(utf8(texts)[1]):
                here = texts[a:b].to_pylist()
                waited, nexts = [], []
                for k, (text, found) in enumerate(zip(here, spotter.sets(here), strict=True), a):
                    now = _Row(ids[k], text, found)
                    if held is not None and held_part == parts[k]:
                        waited.append(held)
                        nexts.append(now)
                    held, held_part = (None, None) if peeks[k] else (now, parts[k])
                if waited:
                    yield pa.RecordBatch.from_arrays(_judged(waited, nexts, spotter, id_type), names=["doc_id", *_NAMES])

    schema = T.StructType([T.StructField("doc_id", kind), *T.StructType.fromDDL(EDITED).fields])
    return dealt.select("doc_id", "text", "part", "peek").mapInArrow(compare, schema)


# ---- near-duplicates by signature sets


def _size_class(size: Column, threshold: float) -> Column:
    """Partition of a set by its size: sets of one class, or of classes next to each other, may be similar."""
    return F.floor(F.log(size.cast("double")) / F.lit(-np.log(threshold))).cast("int")


def similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    chain: int = CHAIN,
    anchors: tuple[str, ...] | None = None,
) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``class_id``: documents tied by signature sets of at least ``threshold``.

    Equal fingerprints collapse to one set first. Sets are partitioned by size, so that similar ones lie in
    one class or in two next to each other. In each class a set is listed under its rarest signatures only,
    as many as a similar set cannot all miss; pairs that meet and whose sizes allow it are compared in full.
    """
    anchors = common_words(docs, text_col) if anchors is None else anchors
    prints = settled(
        docs.select(F.col(id_col).alias("doc_id"), fingerprint(text_of(text_col), anchors, chain).alias("f")).select("doc_id", "f.*")
    )
    sets = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"), F.max("n_signatures").alias("size"))
    sets = settled(sets.withColumn("node", F.xxhash64("fingerprint")))
    raw = F.unbase64("fingerprint")
    members = sets.select(
        "node", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("k"), "fingerprint"
    ).select("node", "size", F.hex(F.substring(raw, F.col("k") * 4 + 1, F.lit(4))).alias("signature"))
    often = members.groupBy("signature").agg(F.count("*").alias("times"))
    rare = Window.partitionBy("node").orderBy("times", "signature")
    prefix = (
        members.join(often, "signature")
        .withColumn("nth", F.row_number().over(rare))
        .where(F.col("nth") <= F.col("size") - F.ceil(F.col("size") * threshold) + 1)
    )
    own = _size_class(F.col("size"), threshold)
    left = prefix.select("signature", F.col("node").alias("a"), F.col("size").alias("size_a"), own.alias("class"))
    right = prefix.select(
        "signature", F.col("node").alias("b"), F.col("size").alias("size_b"), F.explode(F.array(own, own - 1)).alias("class")
    )
    fits = (F.col("size_a") >= threshold * F.col("size_b")) & (F.col("size_b") >= threshold * F.col("size_a"))
    before = (F.col("a") < F.col("b")) | (_size_class(F.col("size_a"), threshold) < _size_class(F.col("size_b"), threshold))
    pairs = left.join(right, ["signature", "class"]).where(fits & before & (F.col("a") != F.col("b"))).select("a", "b").distinct()
    texts = sets.select("node", "fingerprint")
    both = pairs.join(texts.toDF("a", "one"), "a").join(texts.toDF("b", "two"), "b")

    @F.arrow_udf("double")
    def share(one: pa.Array, two: pa.Array) -> pa.Array:
        return pa.array([jaccard(read(x), read(y), threshold) for x, y in zip(one.to_pylist(), two.to_pylist(), strict=True)])

    tied = components(both.where(share("one", "two") >= threshold).select("a", "b"))
    rooted = sets.join(tied, "node", "left").select("fingerprint", "first", F.coalesce("root", "node").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    found = rooted.join(classes, "root").select("fingerprint", "class_id")
    return prints.join(found, "fingerprint").select("doc_id", "fingerprint", "n_signatures", "class_id")
