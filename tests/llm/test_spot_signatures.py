import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sheetloom.llm import spot_signatures as spots
from sheetloom.llm.queries import op4_fingerprints
from tests.llm.conftest import LONG, MESSY, ODD, PROSE, table

SF = "/root/testdata/sf0.001"
ANCHORS = ("the", "of", "and", "in", "der", "die", "und", "is", "a")


def picked(word):
    return xxhash.xxh64_intdigest(word.encode()) % spots.PICK == 0


def chains(text, chain=spots.CHAIN, anchors=ANCHORS):
    """Signatures as tuples of words."""
    words = [w for w in (w.lower().strip(spots._EDGES) for w in spots.words_of(text)) if w]
    found, at = set(), 0
    for k, word in enumerate(words):
        content = [w for w in words[k + 1 :] if w not in anchors][:chain]
        if word in anchors and content:
            found.add((word, *content))
            at += 1
    if at * spots.RARE < len(words):
        few = len(words) <= spots.SHORT or not any(map(picked, words))
        found |= {("by hash", *words[k : k + 1 + chain]) for k, w in enumerate(words) if few or picked(w)}
    return found or {("whole", text)}


def share(one, two):
    return len(one & two) / len(one | two)


def test_signatures_equal_brute_force():
    texts = [PROSE, "", "of the", "of the old town", "no anchors here", LONG[:5000], "...", "x", "a b", "東京 は 日本の首都です。", ODD]
    texts += [" ".join(f"w{k * j % 31}" for j in range(40)) for k in range(1, 9)]
    got = spots.Spotter(ANCHORS).sets(texts)
    assert [len(s) for s in got] == [len(chains(t)) for t in texts]
    for one, a in zip(got, texts, strict=True):
        for two, b in zip(got, texts, strict=True):
            assert spots.jaccard(one, two) == pytest.approx(share(chains(a), chains(b)))
            if share(chains(a), chains(b)) >= 0.3:
                assert spots.jaccard(one, two, 0.3) == spots.jaccard(one, two)
    assert np.array_equal(spots.read(spots.written(got[0])), got[0])


def test_common_words_are_counted_over_all_rows(spark, modules):
    words = {"the": 50, "река": 30, "город": 20, "Τον": 7, "the,": 3, "rare": 1, "7": 90, "": 0}
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(words.items())] + [(99, None), (98, "京京 京")]
    assert spots.common_words(table(spark, rows), most=1, least=2) == ("the", "τον", "река", "京")
    assert spots.common_words(table(spark, rows), least=1) == ("rare", "the", "τον", "город", "река", "京")
    assert spots.common_words(table(spark, rows)) == ("the", "город", "река")
    assert spots.common_words(table(spark, [])) == ()


RUSSIAN = [
    "Дом стоял на краю деревни и был виден издалека всем кто шёл по дороге от реки к старой мельнице",
    "В саду росли яблони и груши а за садом начиналось поле где летом паслись коровы и лошади соседей",
    "Каждое утро дед выходил на крыльцо смотрел на небо и говорил какая будет погода до самого вечера",
    "Мы бежали к пруду прыгали с мостков в холодную воду и потом долго грелись на тёплых досках у берега",
    "Осенью дорога размокала и почтальон приходил пешком с тяжёлой сумкой полной писем газет и посылок",
]


def test_texts_that_differ_in_a_word_are_near_in_any_script(spark, modules):
    """Next to each other stand texts one word apart: prose of five scripts, lists, and short texts, in a corpus mostly English."""
    pairs = [(t, " ".join([*t.split()[:5], "другое", *t.split()[6:]])) for t in RUSSIAN]
    greek = "το σπίτι ήταν στην άκρη του χωριού και το έβλεπε από μακριά όποιος ερχόταν από το ποτάμι προς τον μύλο"
    thai = "บ้านหลังนี้อยู่ริมหมู่บ้านและมองเห็นได้จากที่ไกลสำหรับทุกคนที่เดินมาจากแม่น้ำ"
    chinese = "这座房子在村子的边上从河边走到老磨坊的人远远就能看见它每天早上爷爷都会走到门口看看天空"
    listing = " ".join(f"part{k} screw{k}" for k in range(30))
    pairs += [(greek, greek.replace("χωριού", "δάσους")), (chinese, chinese.replace("爷", "父", 1)), (listing, listing.replace("part7", "part7b"))]
    pairs += [(thai, thai.replace("ไกล", "ใกล้")), ("one two three four five six seven eight nine ten eleven twelve", "one two three four five six seven eight nine ten eleven last")]
    rows = [(2 * k + 1000, a) for k, (a, _) in enumerate(pairs)] + [(2 * k + 999, b) for k, (_, b) in enumerate(pairs)]
    rows += [(k, f"the mill of stone{k} and the barn in field{k} is the house of miller{k}") for k in range(200)]
    got = {r["doc_id"]: r for r in spots.against_next(table(spark, rows)).collect()}
    for k in range(len(pairs)):
        assert got[2 * k + 1000]["near_next"] > 0.5, pairs[k]
        assert got[2 * k + 1000]["near_edited"] > 0.1, pairs[k]
    assert got[999]["near_next"] < 0.1


@pytest.mark.parametrize("part_rows", [7, 500])
def test_query_equals_brute_force(spark, modules, part_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in spots.against_next(docs, anchors=ANCHORS, part_rows=part_rows).collect()}
    order = sorted(texts, reverse=True)
    assert sorted(got, reverse=True) == order
    for k, i in enumerate(order):
        text, ahead = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + ahead[:half]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["near_edited"] == pytest.approx(share(chains(text), chains(edited)), abs=0.02)
        assert got[i]["near_next"] == pytest.approx(share(chains(text), chains(ahead)), abs=0.02)
    assert op4_fingerprints(spark, SF).columns == list(next(iter(got.values())).asDict())


def test_messy_rows(spark, messy, empty):
    got = spots.against_next(messy, part_rows=2).collect()
    assert len(got) == len(MESSY)
    ids = [r["doc_id"] for r in got]
    assert sorted((i for i in ids if i is not None)) == sorted(i for i, _ in MESSY if i is not None)
    by = {}
    for r, (_, text) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"])), sorted(
        MESSY, key=lambda m: (m[0] is None, m[0] or 0, len(m[1] or ""))), strict=True):
        by.setdefault(text or "", set()).add(r["fingerprint"])
        assert r["n_chars"] == len(text or "") and 0 <= r["near_edited"] <= 1
    assert all(len(f) == 1 for f in by.values())  # equal texts, equal fingerprints
    assert spots.against_next(empty).count() == 0
    alone = spots.against_next(table(spark, [(5, PROSE)])).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    unnamed = spots.against_next(table(spark, [(None, PROSE), (None, "x")])).collect()
    assert len(unnamed) == 2


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "binary", "decimal(20,2)"])
def test_ids_of_any_atomic_type(spark, modules, kind):
    rows = [(k * 7 % 40, f"the mill{k} of stone{k % 5} and barn{k % 3}") for k in range(40)]
    text = F.lpad("doc_id", 3, "0")
    day = F.date_add(F.lit("2020-01-01"), F.col("doc_id").cast("int"))
    as_id = {"string": text, "date": day, "timestamp": day.cast("timestamp"), "binary": text.cast("binary")}
    docs = table(spark, rows)
    plain = spots.against_next(docs, anchors=ANCHORS, part_rows=4).drop("doc_id").collect()
    named = docs.withColumn("doc_id", as_id.get(kind, F.col("doc_id").cast(kind)))
    found = spots.against_next(named, anchors=ANCHORS, part_rows=4)
    assert sorted(tuple(r)[1:] for r in found.collect()) == sorted(map(tuple, plain))
    assert found.schema["doc_id"].dataType == named.schema["doc_id"].dataType


def test_ids_that_many_rows_share_spread_over_parts(spark, modules):
    """A third of the rows have one id, a third none; the hash of id and text decides their order, and no part is large."""
    rows = [((7, None, k)[k % 3], f"the word{k:03d} of text{k * 31 % 97:02d}") for k in range(300)]
    docs = table(spark, rows)
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key")).collect()
    order = sorted(map(tuple, keyed), key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    found = spots.against_next(docs, anchors=ANCHORS, part_rows=10).collect()
    expected = []
    for k, (i, text, _) in enumerate(order):
        half, ahead = len(text) // 2, order[(k + 1) % 300][1]
        expected.append((i, hashlib.sha256((text[: len(text) - half] + ahead[:half]).encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["edited_sha256"]) for r in found), key=str) == sorted(expected, key=str)
    held = docs.select(F.col("doc_id").alias("at"), F.xxhash64("doc_id", "text").alias("row_key"))
    heads = spots._heads(held, 10)
    assert len(heads) > 20 and sum(h[:2] == (True, 7) for h in heads) > 5 and sum(not h[0] for h in heads) > 5


def test_similar_equals_brute_force(spark, messy):
    base = [f"the mill{k} stands of stone{k % 7} in field{k % 11} and barn{k}" for k in range(40)]
    near = [(k, " ".join(base[:30] + [f"of extra{k} words{k}"])) for k in range(6)]
    rows = near + [(10 + k, " ".join(base[k : k + 12])) for k in range(0, 28, 3)] + [(50, near[0][1]), (51, ""), (52, None)]
    got = {r["doc_id"]: r["class_id"] for r in spots.similar(table(spark, rows), anchors=ANCHORS).collect()}
    sets = {i: chains(t or "") for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a in sets:
        for b in sets:
            if share(sets[a], sets[b]) >= 0.8:
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {i: find(i) for i in sets}
    assert spots.similar(messy).count() == len(MESSY)
