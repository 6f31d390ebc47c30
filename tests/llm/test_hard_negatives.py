import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetloom.llm import hard_negatives, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, positives=5, negatives=5):
    """The definition, over all pairs. rows: (vec_id, vector, label)."""
    held = set()
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        held.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(x)) for x in vector)))
    out = []
    for a in (r for r in held if r[0] % 100 == 0):
        scored = [(sum(x * y for x, y in zip(a[2], r[2], strict=False)), r) for r in held]
        ranked = sorted(scored, key=lambda s: (-s[0], s[1][0]))
        kin = [(s, r[0]) for s, r in ranked if r != a and r[1] == a[1]][:positives]
        for good, i in kin:
            bad = [(s, r[0]) for s, r in ranked if r[1] != a[1] and 80 * good <= 100 * s <= 100 * good][:negatives]
            out += [(a[0], i, k, j, good, s) for k, (s, j) in enumerate(bad, 1)]
    return sorted(out)


def found(spark, rows, tmp_path, extra=()):
    table = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("z").alias(c) for c in extra])
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    return sorted(map(tuple, queries.op12_hard_negatives(spark, str(tmp_path)).collect()))


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    assert sorted(map(tuple, queries.op12_hard_negatives(spark, SF).collect())) == plain([tuple(r) for r in rows])


def drawn(many, width, seed, near=0.3):
    """Vectors in loose groups, of different lengths."""
    rng = np.random.default_rng(seed)
    heart = rng.normal(size=(6, width))
    rows = heart[rng.integers(0, 6, many)] + near * rng.normal(size=(many, width))
    rows *= rng.uniform(0.2, 3, (many, 1))
    ids = rng.permutation(many) * 20
    return [(int(i), v, int(c)) for i, v, c in zip(ids, rows.tolist(), rng.integers(0, 4, many), strict=True)]


@pytest.mark.parametrize(("many", "width", "near"), [(1200, 8, 0.3), (900, 3, 0.05), (700, 24, 2.0)])
def test_groups_of_vectors(spark, modules, tmp_path, monkeypatch, many, width, near):
    """Small blocks, strides and batches, so that walks end early and results come from many blocks."""
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "STRIDE", 16)
    monkeypatch.setattr(hard_negatives, "ABREAST", 3)
    rows = drawn(many, width, many, near)
    assert found(spark, rows, tmp_path) == plain(rows)


def test_ties_repeats_one_label_and_negative_scores(spark, modules, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(int(i) * 10, (rng.integers(-2, 3, 3) / 256).tolist(), int(rng.integers(0, 2))) for i in rng.permutation(400)]
    rows += rows[:50] + [(0, [0.5, -0.5], 1), (0, [0.25, 0.5, 1.0], 1), (100, [], 0), (200, [0.0, 0.0, 0.0], 1)]
    assert found(spark, rows, tmp_path) == plain(rows)


def test_nulls_infinities_large_numbers_and_clashing_columns(spark, modules, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = drawn(300, 4, 1) + [
        (None, [1.0, 1.0, 1.0, 1.0], 1), (100, None, 1), (200, [1.0, 1.0, 1.0, 1.0], None), (300, [1.0, None, 1.0, 1.0], 2),
        (400, [nan, 1.0, 1.0, 1.0], 2), (500, [inf, 1.0, 1.0, 1.0], 2), (700, [3e5, 1.0, -1.0, 2.0], 2), (701, [2e5, 1e5, 0.0, 1.0], 3),
        (702, [2e5, 2e5, 0.0, 1.0], 3), (703, [3e5, 1e5, 0.0, 1.0], 4),
    ]
    extra = "id mark vector cell part cluster low high blocks score asks near angle norm nth walker found role".split()
    assert found(spark, rows, tmp_path, extra) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(0, [1.0], 1)], [(100, [0.0], 1), (200, [0.0], 1), (3, [0.0], 2)], [(0, None, None)]])
def test_small_and_empty_tables(spark, modules, tmp_path, rows):
    assert found(spark, rows, tmp_path) == plain(rows)


def test_a_vector_that_is_too_long_is_an_error(spark, modules, tmp_path):
    with pytest.raises(Exception, match="longer than 524288"):
        found(spark, [(0, [1e30, 1.0], 1)], tmp_path)


def test_walk_ends_with_a_certificate(monkeypatch):
    """Members of a tight cluster leave the list long before its end, and what they found is right."""
    rng = np.random.default_rng(3)
    rows = np.floor(256 * rng.normal(size=(5000, 6)))
    members = rows[:4] = np.floor(256 * (np.eye(1, 6) * 9 + 0.1 * rng.normal(size=(4, 6))))
    cells = hard_negatives.Cells(np.eye(1, 6), [{"cell": 0, "n": 5000, "spread": 3.2, "reach": 0.05, "longest": 1e4, "shortest": 0.0}])
    block = hard_negatives.Block(cells)
    block.ids, block.labels, block.rows = np.arange(5000), np.arange(5000) % 2, rows
    block.norms = np.linalg.norm(rows, axis=1)
    steps = []
    monkeypatch.setattr(hard_negatives, "STRIDE", 64)
    monkeypatch.setattr(hard_negatives, "_products", lambda m, r, far: steps.append(len(r)) or (m @ r.T).astype(np.int64))
    low, high = np.full(4, -(2**62)), np.full(4, 2**62)
    w, score, at = hard_negatives.walk(block, 0, np.arange(4), block.labels[:4], members, np.arange(4), low, high, 5, True)
    assert sum(steps) < 2500
    for k in range(4):
        scores = (rows @ members[k]).astype(int)
        best = sorted((-scores[i], i) for i in range(5000) if i != k and i % 2 == k % 2)[:5]
        assert list(zip(-score[w == k], at[w == k], strict=True)) == best
