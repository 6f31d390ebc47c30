import hashlib
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetloom.llm import queries, substrings
from tests.llm.conftest import MESSY, table

SF = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def order_of(spark, rows):
    """Defined order: no id first, then by id, then by the unsigned XXH64 of id and text."""
    keyed = spark.createDataFrame([(k, i, t or "") for k, (i, t) in enumerate(rows)], "k long, id long, text string")
    keys = {r["k"]: r["key"] % (1 << 64) for r in keyed.select("k", F.xxhash64("id", "text").alias("key")).collect()}
    return sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, keys[k]))


def plain(rows, window=20):
    """The definition. rows: (id, text), in the order that decides."""
    seen, out = set(), []
    for i, text in rows:
        words = words_of(text)
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if w in seen:
                gone[k : k + window] = [True] * window
            seen.add(w)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def ran(spark, docs, **params):
    found = substrings.dedup_substrings(docs, **params).collect()
    for r in found:
        assert sum(s["length"] for s in r["spans"]) == r["n_removed"]
        assert all(a["start"] + a["length"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))  # maximal
        assert len(words_of(r["kept"])) == r["n_words"] - r["n_removed"]
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) for r in found), key=str)


def small(monkeypatch, chunk=2000, runs=8):
    """Many chunks and runs that are split."""
    monkeypatch.setattr(substrings, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(substrings, "RUNS", runs)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = queries.op13_substring_dedup(spark, SF).collect()
    expected = plain([tuple(r) for r in rows])
    assert sorted(map(tuple, found)) == expected
    assert sum(r[2] for r in expected) > 0


@pytest.mark.parametrize(("chunk", "runs"), [(2000, 4), (500, 2), (40_000, 64), (3000, 1000)])
def test_passages_across_chunks(spark, modules, monkeypatch, chunk, runs):
    """Few words in many documents, passages at all places, whole copies, a hot id and rows without one."""
    small(monkeypatch, chunk, runs)
    rng = np.random.default_rng(chunk)
    passages = [" ".join(rng.choice(list("abcdefghij"), 35)) for _ in range(6)]
    rows = []
    for k in range(150):
        parts = [" ".join(rng.choice(list("abcdefghij"), rng.integers(0, 60))) for _ in range(3)]
        parts.insert(int(rng.integers(0, 4)), passages[k % 6])
        text = "\n ".join(parts)
        rows.append((None if k % 5 == 0 else 7 if k % 3 == 0 else 1000 - 3 * k, text if k % 11 else rows[k // 2][1] if rows else text))
    rows += rows[40:60]
    expected = plain([rows[k] for k in order_of(spark, rows)])
    assert ran(spark, table(spark, rows)) == sorted(expected, key=str)


def test_messy_rows(spark, messy):
    assert ran(spark, messy) == sorted(plain([MESSY[k] for k in order_of(spark, MESSY)]), key=str)


def test_repeats_within_one_text(spark, modules):
    text = " ".join(["x"] * 50 + list("abcdefghijklmnopqrstuvwxyz") * 3 + ["x"] * 25)
    rows = [(1, text), (2, " ".join(["x"] * 19)), (3, " ".join(["x"] * 20)), (4, "x x " * 30), (5, "x\x1cx " * 30)]
    assert ran(spark, table(spark, rows)) == plain(rows)


def test_empty_table_and_texts(spark, empty, modules):
    assert ran(spark, empty) == []
    assert ran(spark, table(spark, [(1, ""), (2, None), (None, " \n")])) == sorted(plain([(1, ""), (2, None), (None, "")]), key=str)


def test_window_is_a_parameter(spark, modules):
    rows = [(1, "a b c d e f"), (2, "z b c d q e f"), (3, "c d e")]
    assert ran(spark, table(spark, rows), window=3) == plain(rows, 3)
    assert ran(spark, table(spark, rows), window=1) == plain(rows, 1)


def test_text_ids_are_refused(spark, modules):
    with pytest.raises(TypeError, match="whole numbers"):
        substrings.dedup_substrings(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"bb", b"ccc"]), max_size=30), max_size=6), st.integers(1, 6))
def test_rolling_hash_stands_for_the_words(texts, window):
    """Equal windows have equal hashes, and others do not; the packed form says the same."""
    chunk = substrings.Chunk([b" ".join(t) for t in texts], window, 10)
    all_words = [w for t in texts for w in t]
    windows = [tuple(all_words[s : s + window]) for s in chunk.starts]
    assert len(windows) == sum(max(0, len(t) - window + 1) for t in texts)
    assert len(chunk.high) == len(set(windows))
    by_place = {w: k for k, w in reversed(list(enumerate(windows)))}
    assert sorted(chunk.earliest.tolist()) == sorted(by_place.values())
    cuts = chunk.cuts(16)
    for b in range(16):
        high, low = chunk.high[cuts[b] : cuts[b + 1]], chunk.low[cuts[b] : cuts[b + 1]]
        cells = (1 << substrings.CELL_BITS) // 16
        again = substrings.unpacked(*substrings.packed(high, low, 10, cells), 10, cells)
        assert np.array_equal(again[0], high & np.uint64((1 << 60) - 1)) and np.array_equal(again[1], low)


@pytest.mark.parametrize("low_bits", [2, 10, 34, 58])
def test_packing_of_hashes_is_exact(low_bits):
    rng = np.random.default_rng(low_bits)
    high = np.sort(rng.integers(0, 1 << 60, 5000, dtype=np.uint64))
    high[100:900] = high[100]  # a cell of over 255
    low = rng.integers(0, 1 << low_bits, 5000, dtype=np.uint64)
    found = substrings.unpacked(*substrings.packed(high, low, low_bits, 1 << 14), low_bits, 1 << 14)
    assert np.array_equal(found[0], high) and np.array_equal(found[1], low)


def test_first_places_tell_equal_halves_apart():
    high = np.array([5, 5, 3, 5, 5, 3], np.uint64)
    low = np.array([1, 2, 0, 1, 2, 0], np.uint64)
    assert substrings.first_places(high, low).tolist() == [True, True, True, False, False, False]
    assert substrings.first_places(high, low * 0).tolist() == [True, False, True, False, False, False]


def test_window_hash_is_the_polynomial():
    texts = [b"the quick brown fox jumps over the lazy dog"]
    words = np.array([xxhash.xxh64_intdigest(w, 1) for w in texts[0].split()], np.uint64)
    base = int(substrings._BASES[0])
    expected = [sum(int(words[k + j]) * base ** (3 - j) for j in range(4)) % (1 << 64) for k in range(6)]
    assert substrings._rolling(words, substrings._BASES[0], 4).tolist() == expected
