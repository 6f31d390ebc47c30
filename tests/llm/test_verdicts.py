"""Registered queries of fitted models against the same model, asked row by row in plain Python."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetloom.llm import isolation, language_id, queries, text_stats, url_filter

SF = "/root/testdata/sf0.001"
M64 = (1 << 64) - 1


def splitmix(z):
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & M64
    z = (z ^ z >> 27) * 0x94D049BB133111EB & M64
    return z ^ z >> 31


@pytest.fixture(scope="module")
def docs(spark, modules):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_url_verdicts(spark, modules):
    model = url_filter.train(url_filter.labelled_urls(spark))

    def score(host, path):
        total = model.bias
        for salt, text in enumerate((host, path)):
            marked = b"\x01" + bytes(48 if 48 <= c <= 57 else c for c in text.encode()) + b"\x01"
            grams = []
            for begin in range(len(marked)):
                state = salt + 1
                for n, byte in enumerate(marked[begin : begin + url_filter.LONGEST], 1):
                    state = (state * 0x100000001B3 + byte) & M64
                    if n >= url_filter.SHORTEST:
                        grams.append(splitmix(state) % url_filter.DIMENSIONS)
            total += sum(model.weights[g] for g in grams) / math.sqrt(max(len(grams), 1))
        return 1 / (1 + math.exp(-total))

    def judged(url):
        if url is None or "://" not in url:
            return "", "", None, "allow"
        rest = url.split("://", 1)[1]
        cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]
        fits = [r for r in url_filter.RULES if (host == (n := r[0].partition("/"))[0] or host.endswith("." + n[0])) and path.startswith("/" + n[2])]
        if fits:
            return host, path, *max(fits, key=lambda r: len(r[0]))
        return host, path, None, "block" if (host or path) and score(host, path) >= 0.5 else "allow"

    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in queries.op8_url_filter(spark, SF).collect()}
    assert found == {i: judged(url) for i, url in pages.items()}
    assert {v[3] for v in found.values()} == {"allow", "block"}


def test_rule_verdicts(spark, docs):
    forests = isolation.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet"))

    def path_length(forest, tree, x):
        node = 0
        while forest.feature[tree][node] >= 0:
            node = forest.left[tree][node] + (x[forest.feature[tree][node]] >= forest.cut[tree][node])
        return forest.path[tree][node]

    def kept(text):
        words = text.encode().split()
        if len(words) < 50 or 100 * text_stats.repeated_words(words) > 50 * len(words):
            return False
        lines = [x for x in text.split("\n") if x.encode().split()]
        letters = sum(c.isascii() and c.isalpha() or 0xC0 <= b for c in text for b in c.encode()[:1])
        share = {
            "symbol_share": sum(c in "#*$%&|<>" for c in text) / len(words),
            "mark_share": sum(c in "!?.,;:|" for c in text) / len(words),
            "mean_word": sum(len(w.decode()) for w in words) / len(words),
            "dup_line_share": (len(lines) - len(set(lines))) / max(len(lines), 1),
            "repeat_share": text_stats.repeated_words(words) / len(words),
            "again_share": sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words),
            "upper_share": sum("A" <= c <= "Z" for c in text) / max(letters, 1),
            "digit_share": sum("0" <= c <= "9" for c in text) / max(len(text), 1),
        }
        for group, forest, most in zip(isolation.GROUPS, forests.forests, forests.most, strict=True):
            x = [share[name] for name in group]
            mean = sum(path_length(forest, t, x) for t in range(len(forest.feature))) / len(forest.feature)
            n = forest.rows
            expected = 2 * (math.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else 1.0
            if 2 ** (-mean / expected) / most > 1 + 1e-12:
                return False
        return True

    found = {r["doc_id"]: r["kept"] for r in queries.op6_rules(spark, SF).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert found == {i: kept(t) for i, t in texts.items()}
    assert 0 < sum(found.values()) < len(found)


def test_languages(spark, docs):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    model = language_id.train(docs, fold != 0)

    def share(text):
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
        held = np.zeros(language_id.DIMENSIONS)
        for begin in range(len(raw)):
            code = 0
            for n, byte in enumerate(raw[begin : begin + 3], 1):
                code = (code * 257 + byte + n) & 0xFFFFFFFF
                held[(code * 2654435761 & 0xFFFFFFFF) >> 20] += 1
        return np.sqrt(held) / np.sqrt(held.sum())

    def spoken(text):
        if not any(c.isalpha() for c in text):
            return "und", 0.0
        odds = [1 / (1 + math.exp(-min(max(float(v), -30), 30))) for v in (share(text) @ model.weights + model.biases) * model.slopes]
        family, sure, machines = 0, 1.0, 0
        if len(model.families) > 1:
            machines = len(model.families)
            family = int(np.argmax(odds[:machines]))
            sure = odds[family] / sum(odds[:machines])
        names = model.languages[family]
        votes, backing = [0] * len(names), [0.0] * len(names)
        for k, (of, one, two) in enumerate(model.pairs):
            if of == family:
                p = odds[machines + k]
                votes[one if p >= 0.5 else two] += 1
                backing[one] += p
                backing[two] += 1 - p
        best = max(range(len(names)), key=lambda j: (votes[j] + backing[j] / (len(names) + 1), -j))
        return names[best], sure * (backing[best] / (len(names) - 1) if len(names) > 1 else 1.0)

    found = {r["doc_id"]: r for r in queries.op3_language_id(spark, SF).collect()}
    short = [r for r in docs.collect() if len(r["text"] or "") < 2500][:60]
    assert len(short) == 60
    for r in short:
        name, sure = spoken(r["text"] or "")
        got = found[r["doc_id"]]
        assert got["lang_pred"] == name and got["score"] == pytest.approx(sure, abs=1e-3)
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
