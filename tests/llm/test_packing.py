import random
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheetloom.llm import packing
from sheetloom.llm.queries import op9_packing
from tests.llm.conftest import LONG, MESSY, ODD, OTHER, PROSE

SF = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(packing.tokenizer_file())


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def raw(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


PARTS = st.sampled_from([" ", "  ", "\n", " \n", "\t", " ", "a", "The", "é", "'s", "don't", "12", "<|endoftext|>", "日本", ".", "!!", " "])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=12).map("".join), max_size=4))
def test_ids_equal_the_library(texts):
    tokenizer = packing._tokenizer(packing.tokenizer_file(), packing.END_ID)
    assert tokenizer._fast is not None
    assert tokenizer.encode(texts) == [raw(ids_of(t)) for t in texts]


def test_forgetting_does_not_change_ids(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    tokenizer = packing.UnitTokenizer(packing.tokenizer_file())
    for text in (PROSE, OTHER, LONG[:3000], PROSE, ODD) * 3:
        assert tokenizer.encode([text, OTHER]) == [raw(ids_of(text)), raw(ids_of(OTHER))]


def one_by_one(counts, window):
    """Best-fit decreasing as it is defined: the room left in each sequence, and how often each fill occurs."""
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fitting = [r for r in rooms if r >= length]
            if fitting:
                rooms[rooms.index(min(fitting))] -= length
            else:
                rooms.append(window - length)
    return Counter(rooms)


@settings(max_examples=120, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 9), max_size=12))
def test_plan_equals_one_by_one(counts):
    moves, opened = packing.best_fit_decreasing(counts, 20)
    filled, seen = {}, Counter()
    for m in moves:
        following = [x.rank for x in moves if x.length == m.length and x.rank > m.rank]
        n = (min(following) if following else counts[m.length]) - m.rank
        for j in range(n):
            place = (m.sequence + j // m.each, m.offset + j % m.each * m.length)
            filled.setdefault(place[0], []).append((place[1], m.length))
        seen[m.length] += n
    assert seen == Counter(counts)
    assert sorted(filled) == list(range(opened))
    rooms = []
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        rooms.append(20 - at)
    assert Counter(rooms) == one_by_one(counts, 20)


def test_moves_are_bounded_by_the_window():
    draw = random.Random(3)
    small = {n: draw.randint(1, 50) for n in range(1, 2049)}
    large = {n: c * 1_000_003 for n, c in small.items()}
    assert len(packing.best_fit_decreasing(large)[0]) < 3 * len(packing.best_fit_decreasing(small)[0]) + 10_000


def test_room_tree():
    tree = packing.RoomTree(20)
    assert tree.tightest(1) is None
    for room in (3, 7, 7, 20):
        tree.add(room, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 7, 8, 20)] == [3, 3, 7, 7, 20, 20]
    tree.add(7, -1)
    tree.add(7, -1)
    assert tree.tightest(4) == 20


def check(pieces, texts, window):
    """Every id of every document in one piece, sequences gapless and within the window."""
    covered, filled = {}, {}
    for p in pieces:
        covered.setdefault(p["doc_id"], []).append(p)
        filled.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    want = Counter((i, ids) for i, ids in ((i, tuple(ids_of(t))) for i, t in texts))
    for (i, ids), times in want.items():
        for start in range(0, len(ids), window):
            part = raw(ids[start : start + window])
            same = [p for p in covered[i] if p["start"] == start and p["ids_crc32"] == zlib.crc32(part) and p["doc_tokens"] == len(ids)]
            assert len(same) >= times and all(p["length"] == len(part) // 4 for p in same)
    assert sum(p["length"] for p in pieces) == sum(len(ids) * n for (_, ids), n in want.items())
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(filled)


def test_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op9_packing(spark, SF).collect()
    used = check(got, texts, packing.WINDOW)
    assert used <= 1.03 * sum(p["length"] for p in got) / packing.WINDOW + 1
    assert sorted({p["sequence_id"] for p in got}) == list(range(used))


@pytest.mark.parametrize("window", [64, 2048])
def test_messy_rows(messy, empty, window):
    cut = packing.pieces(messy, window=window).withColumn("ids_crc32", F.crc32("ids"))
    packed = packing.place(cut, window)
    check(packed.collect(), MESSY, window)
    built = packing.sequences(packed, window).collect()
    for s in built:
        whole = s["used"] & (s["used"] - 1) == 0
        assert s["padded_to"] == (s["used"] if whole else window) and len(s["ids"]) == 4 * s["padded_to"]
    assert packing.pack(empty).count() == 0
