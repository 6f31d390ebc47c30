import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.llm import merkle, queries
from tests.llm.conftest import CLASHING

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(*values):
    texts = [None if v is None else str(v) for v in values]
    return digest("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def plain_tree(nodes):
    """Root, and the siblings of each leaf from the bottom up, in two texts a level."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(place):
            run = p // 8 * 8
            paths[k].append(("".join(nodes[run:p]), "".join(nodes[p + 1 : run + 8])))
            place[k] = p // 8
        nodes = [digest("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)]
    return nodes[0], paths


def fold(node, path):
    for before, after in path:
        node = digest(before + node + after)
    return node


def plain(rows):
    """The rows that the query has to return, one by one; rows: (doc_id, text, lang, source, n_chars)."""
    trees = defaultdict(list)
    for i, text, lang, source, n in rows:
        trees[lang].append((i, plain_leaf(i, source, lang, n, text), text, source, n))
    names = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    found = {}
    for lang in names:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        found[lang] = plain_tree([r[1] for r in trees[lang]])
    root, above = plain_tree([found[lang][0] for lang in names]) if names else (None, [])
    out = []
    for lang, upper in zip(names, above, strict=True):
        for (i, leaf, text, source, n), path in zip(trees[lang], found[lang][1], strict=True):
            held = leaf
            if i is not None and zlib.crc32(str(i).encode()) % 3 == 0:
                low = text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                held = plain_leaf(i, source, lang, n, low)
            led = fold(held, path + upper)
            out.append((i, leaf, found[lang][0], root, digest("".join(b + a for b, a in path + upper)), led, led == root))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    found = queries.op11_merkle(spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert sorted(map(tuple, found), key=str) == plain([tuple(r) for r in rows])
    assert {r["verified"] for r in found} == {True, False}


@pytest.mark.parametrize("size", [1, 2, 8, 9, 65, 5000])
def test_trees_of_many_sizes(spark, modules, tmp_path, size):
    """One tree of several blocks, and some of one leaf, among them the null one and one with an awkward name."""
    rows = [(k, f"Text {k % 7}", "en", None, k) for k in range(size)] + [(9, None, None, "a", None), (9, "", "é", "b", 0), (7, "X", "", "c", 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, queries.op11_merkle(spark, str(tmp_path)).collect()), key=str) == plain(rows)


def test_nulls_ties_repeats_long_texts_and_clashing_columns(spark, modules, tmp_path):
    rows = [(None, "a", "en", "s", 1), (None, None, None, None, None), (1, "x" * 300_000, "en", "s", 1), (1, "Same", "en", "s", 2)]
    rows += [(1, "Same", "en", "s", 2), (1, "OTHER ÄÖ", "en", None, 2), (2, "", "en", "s", 0)]
    named = [c for c in (*CLASHING, "tree", "n", "pos", "digest", "leaf", "root", "subroot", "tampered") if c not in SCHEMA.split()]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("z").alias(c) for c in named])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, queries.op11_merkle(spark, str(tmp_path)).collect()), key=str) == plain(rows)


def test_empty_table(spark, modules, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_merkle(spark, str(tmp_path))
    assert found.collect() == []
    assert found.schema["verified"].dataType == T.BooleanType()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 700), st.data())
def test_multiproof_is_minimal_and_proves(n, data):
    """What is fetched is just what is neither held nor derived, and every leaf's path leads to the root."""
    chosen = data.draw(st.sets(st.integers(0, n - 1), min_size=1, max_size=40))
    leaves = [digest(str(k)) for k in range(n)]
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][k : k + 8])) for k in range(0, len(levels[-1]), 8)])
    wanted = merkle.missing(n, chosen)
    assert len(wanted) == len(set(wanted))
    covers = [set(range(p * 8**level, p * 8**level + 8**level)) for level, p in wanted]
    assert not any(c & chosen for c in covers)  # none can be derived
    assert set.union(chosen, *covers) >= set(range(n)) and sum(len(c & set(range(n))) for c in covers) + len(chosen) == n
    found = merkle.paths(n, {p: leaves[p] for p in chosen}, {c: levels[c[0]][c[1]] for c in wanted})
    expected = plain_tree(leaves)[1]
    assert found == {p: expected[p] for p in chosen}


def test_subset_of_leaves(spark, modules):
    leaves = [digest(str(k)) for k in range(9000)]
    rows = merkle.positioned(spark.createDataFrame([("1a", k, d) for k, d in enumerate(leaves)], "tree string, k long, digest string"), "k")
    ground = rows.select("tree", "n", F.lit(0).alias("level"), "pos", "digest")
    nodes = ground.unionByName(merkle.nodes_above(rows))
    root, paths = plain_tree(leaves)
    found = merkle.inclusion_paths(rows.where("k % 1500 = 7"), nodes).select("k", "path", merkle.folded(F.col("digest"), F.col("path")).alias("root"))
    got = {r["k"]: ([tuple(p) for p in r["path"]], r["root"]) for r in found.collect()}
    assert got == {k: (paths[k], root) for k in range(7, 9000, 1500)}
