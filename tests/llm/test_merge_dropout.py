import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetloom.llm import merge_dropout as md
from sheetloom.llm import queries
from tests.llm.conftest import LONG, MESSY, ODD, OTHER, PROSE

SF = "/root/testdata/sf0.001"
PATH = md.model_file()
WORDS = md.vocabulary(PATH)


def ids_of(text, dropout=0.0, seed=1, variant=0):
    raw = md.Encoder(WORDS, dropout, seed, variant).encode(text)
    return [int.from_bytes(raw[k : k + 4], "little") for k in range(0, len(raw), 4)]


def text_of(ids):
    return b"".join(WORDS.written[i] for i in ids)[1:].decode()


def test_without_dropout_equals_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in (PROSE, OTHER, LONG[:20_000], " two  blanks ", "日本語 ★", "a\nb\tc", "", " ", "U.S. 3.14!!"):
        assert ids_of(text) == library.encode(text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60), st.sampled_from([0.0, 0.1, 0.5, 1.0]), st.integers(0, 3))
def test_round_trip(text, dropout, variant):
    assert text_of(ids_of(text, dropout, 3, variant)) == text


def test_segmentations_vary_by_key_and_only_by_it():
    one = ids_of(PROSE, 0.3, 1, 0)
    assert one == ids_of(PROSE, 0.3, 1, 0)
    assert len({tuple(ids_of(PROSE, 0.3, seed, variant)) for seed in (1, 2) for variant in (0, 1)}) == 4
    assert len(one) > len(ids_of(PROSE))
    assert len(ids_of(PROSE, 1.0)) >= len(PROSE)


def test_share_of_skipped_merges():
    """With all candidate merges of single pairs passed over at rate p, a two-letter word stays cut at rate p."""
    words = [a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz" if a + b in WORDS.ids]
    cut = sum(len(md.merged(list(w), WORDS, 0.25, key)) == 2 for key in range(1, 41) for w in words)
    assert abs(cut / (40 * len(words)) - 0.25) < 0.03


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="theanignr.,▁é★\n", min_size=1, max_size=34), min_size=1, max_size=20), st.sampled_from([0.0, 0.1, 0.5]))
def test_side_by_side_equals_one_by_one(words, dropout):
    encoder = md.Encoder(WORDS, dropout, 5, 1)
    encoder._learn(words)
    assert [encoder._words[w] for w in words] == [encoder.spell(1, w) for w in words]


def test_forgetting_does_not_change_ids(monkeypatch):
    whole = ids_of(LONG[:9000], 0.2)
    monkeypatch.setattr(md, "REMEMBERED", 40)
    encoder = md.Encoder(WORDS, 0.2, 1, 0)
    for text in (PROSE, LONG[:9000], OTHER, LONG[:9000]):
        raw = encoder.encode(text)
    assert [int.from_bytes(raw[k : k + 4], "little") for k in range(0, len(raw), 4)] == whole


def test_every_occurrence_is_drawn_anew():
    """A word comes in far more than a few segmentations, in one document and by document, as the agenda makes them one by one."""
    encoder, word, times = md.Encoder(WORDS, 0.1, 1), "internationalisation", 300
    ids, sizes = encoder.encode_many([" ".join([word] * times)] * 2, np.array([5, 6]))
    keys = encoder._keys_of(np.repeat([5, 6], times), np.tile(np.arange(times), 2))
    want = [encoder.spell(1, word, int(key)) for key in keys]
    assert ids.tobytes() == b"".join(want)
    first, second = want[:times], want[times:]
    assert len(set(first)) > 20 and len(set(second)) > 20 and first != second
    assert sizes.tolist() == [sum(map(len, part)) // 4 for part in (first, second)]


def test_documents_draw_their_own_ids(spark, modules):
    rows = spark.createDataFrame([(k, PROSE) for k in range(40)] * 2, "doc_id long, text string")
    done = md.encoded(rows, dropout=0.3).collect()
    assert len({tuple(r["ids"]) for r in done}) == 40 == len({(r["doc_id"], tuple(r["ids"])) for r in done})


def test_messy_rows(messy, empty):
    done = md.encoded(messy).withColumn("decoded", md.decode(F.col("ids"))).select("doc_id", "text", "ids", "decoded").collect()
    assert len(done) == len(MESSY)
    assert all(r["decoded"] == (r["text"] or "") for r in done)
    assert all(r["ids"] == [] for r in done if not r["text"])
    sevens = [r["ids"] for r in done if r["text"] == ODD]
    assert sevens[0] == sevens[1]
    assert md.encoded(empty).count() == 0
    assert messy.limit(1).select(md.decode(F.lit(None).cast("array<int>")).alias("t")).first()["t"] is None


def test_many_ids_decode_as_one_by_one(spark, modules):
    """Any ids, also such that no text has, empty lists, nulls, slices of an array."""
    rng = np.random.default_rng(2)
    rows = [rng.integers(0, WORDS.size, n).tolist() for n in (0, 1, 2, 50, 3000)] + [None, [], ids_of(ODD), ids_of(LONG[:5000])]
    expected = [None if r is None else b"".join(WORDS.written[i] for i in r)[1:].decode("utf-8", "replace") for r in rows]
    whole = pa.array(rows, pa.list_(pa.int32()))
    assert md.decoded(whole, WORDS).to_pylist() == expected
    assert md.decoded(whole[3:8], WORDS).to_pylist() == expected[3:8]
    assert md.decoded(whole[:0], WORDS).to_pylist() == []
    frame = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, ids array<int>")
    found = {r["k"]: r["text"] for r in frame.select("k", md.decode(F.col("ids")).alias("text")).collect()}
    assert [found[k] for k in range(len(rows))] == expected


def test_query_equals_encoding_one_by_one(spark, modules):
    """The registered query against the agenda run for each document and occurrence by itself."""
    found = {r["doc_id"]: r for r in queries.op2_sentencepiece(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.xxhash64("doc_id", "text").alias("draw")).collect()
    ids, expected = [], {}
    for d in docs[:40]:
        raw = md.Encoder(WORDS, md.DROPOUT, md.SEED, d["draw"]).encode(d["text"] or "")
        ids.append((d["doc_id"], np.frombuffer(raw, "<i4").tolist()))
        expected[d["doc_id"]] = (len(d["text"] or ""), len(ids[-1][1]), zlib.crc32((d["text"] or "").encode()))
    hashes = {r["k"]: r["h"] for r in spark.createDataFrame(ids, "k long, ids array<int>").select("k", F.xxhash64("ids").alias("h")).collect()}
    for k, (chars, many, crc) in expected.items():
        assert (found[k]["n_chars"], found[k]["n_ids"], found[k]["decoded_crc32"], found[k]["lossless"]) == (chars, many, crc, True)
        assert found[k]["ids_hash"] == hashes[k]
    assert len(found) == len(docs)
