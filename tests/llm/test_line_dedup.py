import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetloom.llm import line_dedup
from tests.llm.conftest import table


def worded(text):
    """Lines with a word, each with the lines without one behind it, and what stands before the first."""
    before, found = [], []
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            found.append([line])
        else:
            (found[-1] if found else before).append(line)
    return before, found


def cut(lines):
    """Chunks as (first, last)."""
    value = [int(hashlib.md5(x.encode()).hexdigest()[:3], 16) for x in lines]
    marked = [(v + 31 * (value[i - 1] if i else 0)) % 4093 % 8 != 0 for i, v in enumerate(value)]
    spans = []
    for i, line in enumerate(lines):
        if len([w for w in line.split(" ") if w]) > 50:
            spans.append((i, i))
        if i + 1 < len(lines):
            last = next((j for j in range(i + 1, min(i + 7, len(lines))) if marked[j]), i + 7)
            spans.append((i, min(last, len(lines) - 1)))
    return spans


def brute(rows):
    """Texts after removal, by id; ids must differ."""
    places = defaultdict(list)
    held = {i: worded(text) for i, text in rows if text is not None}
    for i in sorted(held):
        lines = [part[0] for part in held[i][1]]
        for first, last in sorted(cut(lines)):
            places["\n".join(lines[first : last + 1])].append((i, first, last))
    gone = {(i, k) for found in places.values() for i, first, last in found[1:] for k in range(first, last + 1)}
    kept = {i: None for i, text in rows if text is None}
    for i, (before, parts) in held.items():
        kept[i] = "\n".join(before + [line for k, part in enumerate(parts) if (i, k) not in gone for line in part])
    return kept


def passage(seed, lines=9, words=6):
    return [" ".join(f"w{(seed * 7919 + k * 104729 + j * j * 31) % 9973}" for j in range(words)) for k in range(lines)]


SHARED, LINE = passage(1, 24), " ".join(f"q{j}" for j in range(60))
ROWS = [
    (1, "\n".join(passage(2, 5) + SHARED + passage(3, 4))),
    (2, "\n".join(passage(4, 3) + SHARED + passage(5, 7))),
    (3, "\n".join(["inserted line", *SHARED])),
    (4, "\n".join([*passage(6, 2), LINE, *passage(7, 2)])),
    (5, "\n".join([*passage(8, 1), LINE, *passage(9, 5), LINE])),
    (6, None),
    (7, ""),
    (8, "\n\n\n"),
    (9, "\n\n\n"),
    (10, "\n".join(SHARED)),
    (11, "one short line"),
    (12, "one short line"),
    (13, "\n \n" + "\n\n".join(["alpha beta", *passage(11, 3), "gamma"]) + "\n\n"),
    (14, "\n\t\n".join([*passage(11, 3), "delta"])),
    (15, "\n".join(["equal footer line"] * 40)),
    (16, "\n".join(["own line", *["equal footer line"] * 40])),
]


def test_equals_brute_force(spark, modules):
    got = line_dedup.dedup_lines(table(spark, ROWS)).select("row.doc_id", "text").collect()
    assert dict(map(tuple, got)) == brute(ROWS)
    kept = dict(map(tuple, got))
    assert kept[1] == ROWS[0][1]  # the first place stays whole
    assert len(kept[2]) < len(ROWS[1][1]) and len(kept[3]) < len(ROWS[2][1])  # shifted copies are found
    assert LINE in kept[4] and LINE not in kept[5]
    assert kept[11] == kept[12] == "one short line"  # a single short line is no passage
    assert kept[2] == "\n".join(passage(4, 3) + passage(5, 7)) and kept[10] == ""
    assert kept[14].endswith("delta") and len(kept[14]) < len(ROWS[13][1]) and kept[13] == ROWS[12][1]
    assert kept[15] in ("equal footer line", "\n".join(["equal footer line"] * 7)) and kept[16] == "own line"


@pytest.mark.parametrize("lines", [2, 3, 4, 8, 12, 24])
def test_planted_passages_are_removed(spark, modules, lines):
    """Passages of 14-word lines, each in three documents between lines of their own: how many of the lines go."""
    draw = np.random.default_rng(lines)

    def own(n):
        return [" ".join(f"o{x}" for x in draw.integers(0, 10**9, 9)) for _ in range(n)]

    rows, planted = [], 0
    for k in range(60):
        shared = [" ".join(f"s{x}" for x in draw.integers(0, 10**9, 14)) for _ in range(lines)]
        for copy in range(3):
            rows.append((3 * k + copy, "\n".join(own(draw.integers(0, 5)) + shared + own(draw.integers(0, 5)))))
        planted += 2 * lines
    found = line_dedup.dedup_lines(table(spark, rows)).select("row.doc_id", "text", "n_removed").collect()
    removed = sum(r["n_removed"] for r in found)
    assert removed >= (0.75 if lines == 2 else 0.9) * planted
    kept = {r["doc_id"]: r["text"] for r in found}
    for i, text in rows:  # nothing but shared lines goes
        assert [x for x in text.split("\n") if x[0] == "o"] == [x for x in kept[i].split("\n") if x[:1] == "o"]


def test_a_long_run_of_equal_lines_stays_linear(spark, modules):
    rows = [(1, "\n".join(["the same line"] * 30_000)), (2, "\n".join(["the same line"] * 3000 + ["end"]))]
    got = dict(map(tuple, line_dedup.dedup_lines(table(spark, rows)).select("row.doc_id", "text").collect()))
    assert len(got[1].split("\n")) <= 8 and len(got[2].split("\n")) <= 8


def test_equal_hashes_of_unequal_chunks_are_told_apart(spark, modules, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(5).cast("long") if c and "part" in str(c[0]) else real(*c))
    got = line_dedup.dedup_lines(table(spark, ROWS)).select("row.doc_id", "text").collect()
    assert dict(map(tuple, got)) == brute(ROWS)


def test_result_is_the_same_without_a_broadcast(spark, modules, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 0)
    got = line_dedup.dedup_lines(table(spark, ROWS)).select("row.doc_id", "text").collect()
    assert dict(map(tuple, got)) == brute(ROWS)


def test_messy_rows(messy, empty):
    found = line_dedup.dedup_lines(messy).select("row.doc_id", "row.text", F.col("text").alias("kept"), "row.score").collect()
    assert len(found) == messy.count()
    assert all(r["score"] == "kept as it is" for r in found)
    assert all(r["kept"] is None for r in found if r["text"] is None)
    assert [r["kept"] for r in found if r["doc_id"] == 1] == [r["text"] for r in found if r["doc_id"] == 1]
    sevens = [r["kept"] for r in found if r["doc_id"] == 7]
    assert sevens[0] == sevens[1]  # rows repeated in id and text end up alike
    assert line_dedup.dedup_lines(empty).count() == 0
    assert line_dedup.keep(messy).columns == messy.columns


def test_no_python_on_the_main_path(messy):
    plan = line_dedup.dedup_lines(messy)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
