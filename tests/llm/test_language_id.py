import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sheetloom.llm import language_id as lid
from sheetloom.llm.queries import op3_language_id
from tests.llm.conftest import table

SF = "/root/testdata/sf0.001"


def test_histogram_equals_brute_force():
    texts = ["Abc ab", "", "é" * 7, "x" * 3_000_000]
    got = np.concatenate([x for _, _, x in lid.histograms(pa.array(texts))])
    for row, text in zip(got[:3], texts[:3], strict=True):
        raw = text.lower().encode()
        want = np.zeros(lid.DIMENSIONS)
        for n in lid.GRAMS:
            for k in range(len(raw) - n + 1):
                code = 0
                for j in range(n):
                    code = (code * 257 + raw[k + j] + j + 1) % 2**32
                want[(code * 2654435761 % 2**32) >> 20] += 1
        want = np.sqrt(want)
        assert np.allclose(row, want / max(np.sqrt((want**2).sum()), 1e-9), atol=1e-5)
    one = np.concatenate([x for _, _, x in lid.histograms(pa.array(["x" * 30]))])
    assert np.allclose(got[3], one, atol=0.05) and np.isclose((got[3] ** 2).sum(), 1, atol=1e-3)


def test_held_out_accuracy(spark):
    got = op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == 200
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    assert len(held) > 20 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_held_out_languages_are_not_looked_at(spark, modules):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    changed = docs.withColumn("lang", F.when(fold == 0, "xx").otherwise(F.col("lang")))
    one, two = (lid.train(d, fold != 0) for d in (docs, changed))
    assert one.families == two.families and np.array_equal(one.weights, two.weights)


def test_hierarchy():
    draw = np.random.default_rng(1)
    x = draw.normal(0, 0.1, (90, 3)).astype(np.float32)
    names = np.array(["de", "en", "fr"] * 30)
    x[names == "fr", 0] += 2
    x[names == "de", 1] += 2
    model = lid.fit(x, names)
    assert model.families == ("germanic", "romance") and model.languages == (("de", "en"), ("fr",)) and len(model.pairs) == 1
    got, sure = model.predict(x)
    assert got == names.tolist() and (sure > 0.5).all()


def test_messy_rows(spark, messy, empty):
    model = lid.train(messy)
    got = lid.predict(messy, model).select("doc_id", "text", "lang_pred", "score", "row").collect()
    assert len(got) == 14 and all(r["row"] == "kept as it is" for r in got)
    for r in got:
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("de", "en")
    nothing = lid.train(empty)
    assert {r["lang_pred"] for r in lid.predict(messy, nothing).collect()} == {"und"}
    assert lid.predict(empty, model).count() == 0
    one = lid.train(table(spark, [(1, "The only text."), (2, None)]).withColumn("lang", F.lit("en")))
    assert {(r["lang_pred"], r["score"]) for r in lid.predict(messy.where("doc_id = 1"), one).collect()} == {("en", 1.0)}
    assert lid.keep(messy, model).columns == messy.columns


@pytest.mark.parametrize("broadcast", [100_000, 10])
def test_no_language_is_left_out(spark, modules, monkeypatch, broadcast):
    """600 languages, one with half of the rows: every one is in the sample, which stays bounded."""
    monkeypatch.setattr(lid, "BROADCAST_LANGUAGES", broadcast)
    seen = []
    monkeypatch.setattr(lid, "fit", lambda x, language: seen.append(language) or lid.Model())
    rows = [(k, f"text {k} of it", "hot" if k % 2 else f"l{k // 2 % 599}") for k in range(6000)]
    lid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most=1200)
    assert len(set(seen[0])) == 600 and len(seen[0]) == 1200
    lid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most=100)
    assert len(set(seen[1])) == 600 == len(seen[1])


def test_many_languages_are_told_apart(spark, modules, monkeypatch):
    """40 languages, each with words of its own; none is predicted as another."""
    monkeypatch.setattr(lid, "STEPS", 60)
    words = [[f"{chr(97 + k % 26)}{chr(97 + k // 7 % 26)}{chr(97 + (k * j) % 26)}{j}" for j in range(1, 9)] for k in range(40)]
    draw = np.random.default_rng(4)
    rows = [(k, " ".join(draw.choice(words[k % 40], 30)), f"lang{k % 40}") for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lid.train(docs, F.col("doc_id") < 400, most=400)
    got = lid.predict(docs, model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got if r["doc_id"] >= 400]) > 0.95
    assert {r["lang_pred"] for r in got} == {f"lang{k}" for k in range(40)}


def test_fit_makes_no_copy_of_its_sample():
    draw = np.random.default_rng(3)
    x = draw.random((1600, lid.DIMENSIONS), np.float32)
    names = np.array(["de", "en", "es", "fr"] * 400)
    tracemalloc.start()
    lid.fit(x, names)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 0.6 * x.nbytes  # the rows of one pair; a centred copy took as much as the sample


def test_sample_is_sent_compressed():
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["text"]).column(0).combine_chunks()
    x = np.concatenate([part for _, _, part in lid.histograms(docs)])
    raw = lid.packed(x)
    assert sum(map(len, raw)) < len(x) * lid.DIMENSIONS // 2  # a quarter of the plain numbers
    assert np.array_equal(lid.unpacked(raw), x.astype(np.float16).astype(np.float32))


def test_machine_equals_one_on_centred_rows():
    draw = np.random.default_rng(4)
    x = draw.random((300, 40), np.float32)
    x[:90, 0] += 0.3
    y = np.where(np.arange(300) < 90, 1.0, -1.0)
    share = np.where(y > 0, 0.5 / 90, 0.5 / 210)
    centre = share @ x
    w, b = lid.linear_svm(x, y)
    w2, b2 = lid.linear_svm((x - centre).astype(np.float32), y)
    assert np.allclose(w, w2, atol=1e-3) and np.isclose(b, b2 - centre @ w2, atol=1e-3)
