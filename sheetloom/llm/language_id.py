"""Language identification in two steps: the family first, then the language within it.

Texts become histograms of hashed byte n-grams. Linear support vector machines, one against the rest, tell the
families apart; within a family one machine for each pair of languages votes. They are fitted on the
driver from at most :data:`SAMPLE_ROWS` labelled rows of :data:`DIMENSIONS` numbers each, drawn evenly from all
languages, whatever their number; they come there compressed, and the fit makes no copy of them all. Every text is read
whole. Where there are more than :data:`SAMPLE_ROWS` languages,
each gives one row, so the sample grows with the languages and no language is left out.

Defined results: ``und`` with score 0 for a text that is null, empty or without a letter, and where nothing
could be learned; with one known language, that language with score 1; ties go to the first name; repeated
rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetloom.llm.common import slices, text_of, utf8, whole_rows, with_outputs

SAMPLE_ROWS = 3000
DIMENSIONS = 4096
#: Languages up to which their row counts are broadcast, some 50 bytes each.
BROADCAST_LANGUAGES = 100_000
GRAMS = (1, 2, 3)
UNKNOWN = "und"
PENALTY, STEPS = 1e-4, 300

#: Families by language code; a code that is not listed is a family by itself.
FAMILIES = {
    "germanic": ("de", "en", "nl", "af", "fy", "lb", "yi", "sv", "da", "nb", "nn", "no", "is", "fo"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "indic": ("hi", "ur", "bn", "pa", "mr", "ne", "gu"),
    "semitic": ("ar", "he", "am", "mt"),
}


def family_of(language: str) -> str:
    return next((name for name, codes in FAMILIES.items() if language in codes), language)


def histograms(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Rows ``first`` to ``last`` of the array as unit vectors of square roots of n-gram shares.

    A text longer than a slice is counted piece by piece; pieces overlap so that no n-gram is lost.
    """
    data, offsets = utf8(texts)
    step = 1 << 20
    for first, last in slices(offsets, step // 4, 256):
        rows = last - first
        held = np.zeros(rows * DIMENSIONS, np.int64)
        begin, stop = int(offsets[first]), int(offsets[last])
        for at in range(begin, stop, step):
            upto = min(at + step, stop)
            part = data[at : min(upto + max(GRAMS) - 1, stop)].astype(np.uint32)
            part = np.where((part >= 65) & (part <= 90), part + 32, part)
            place = np.arange(at, upto)
            row = np.searchsorted(offsets[first : last + 1], place, side="right") - 1
            room = offsets[first + row + 1] - place
            code = np.zeros(upto - at, np.uint32)
            for n in range(1, max(GRAMS) + 1):
                fits = room >= n
                ahead = part[n - 1 : n - 1 + len(code)]
                code[: len(ahead)] = code[: len(ahead)] * np.uint32(257) + ahead + np.uint32(n)
                if n in GRAMS:
                    dim = (code[fits] * np.uint32(2654435761)) >> np.uint32(20)  # the top 12 bits: DIMENSIONS values
                    held += np.bincount(row[fits] * DIMENSIONS + dim, minlength=len(held))
        x = np.sqrt(held.reshape(rows, DIMENSIONS).astype(np.float32))
        norm = np.sqrt((x * x).sum(1, keepdims=True))
        yield first, last, x / np.maximum(norm, 1e-9)


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss, by accelerated gradient steps. ``y`` is 1 or -1.

    Both classes weigh the same, whatever their sizes.
    """
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    # rows are taken from the centre in the products, so that nothing as large as ``x`` is made
    centre = (share.astype(x.dtype) @ x).astype(float)
    spread = float(share @ np.einsum("ij,ij->i", x, x)) - (2 - share.sum()) * float(centre @ centre)
    rate = 1 / (2 * max(spread, 0.0) + 2 + penalty)  # the trace bounds the largest curvature
    w, b, aw, ab, t = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0, 1.0
    for _ in range(steps):
        # products in the matrix's own type: a vector of doubles would have it converted every time
        slack = 2 * share * np.maximum(0, 1 - y * (x @ aw.astype(x.dtype) - centre @ aw + ab)) * -y
        pull = slack.astype(x.dtype) @ x - slack.sum() * centre
        nw, nb = aw - rate * (pull + penalty * aw), ab - rate * slack.sum()
        tn = (1 + (1 + 4 * t * t) ** 0.5) / 2
        aw, ab = nw + (t - 1) / tn * (nw - w), nb + (t - 1) / tn * (nb - b)
        w, b, t = nw, nb, tn
    return w, float(b - centre @ w)


def slope(margin: np.ndarray, y: np.ndarray) -> float:
    """Scale that turns margins into log-odds, by Newton steps on the training margins; kept within bounds."""
    a = 1.0
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(a * margin, -30, 30)))
        gradient, bend = ((p - (y > 0)) * margin).mean(), (p * (1 - p) * margin**2).mean()
        a = float(np.clip(a - gradient / max(bend, 1e-6), 0.5, 6.0))
    return a


@dataclass(frozen=True)
class Model:
    """Machines as columns of one matrix: first one for each family, then one for each pair of languages within."""

    families: tuple[str, ...] = ()
    languages: tuple[tuple[str, ...], ...] = ()
    pairs: tuple[tuple[int, int, int], ...] = ()
    weights: np.ndarray = field(default_factory=lambda: np.zeros((DIMENSIONS, 0), np.float32))
    biases: np.ndarray = field(default_factory=lambda: np.zeros(0))
    slopes: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if not self.families:
            return [UNKNOWN] * len(x), np.zeros(len(x))
        odds = 1 / (1 + np.exp(-np.clip((x @ self.weights + self.biases) * self.slopes, -30, 30)))
        machines = len(self.families) if len(self.families) > 1 else 0
        family, sure = np.zeros(len(x), np.int64), np.ones(len(x))
        if machines:
            share = odds[:, :machines] / odds[:, :machines].sum(1, keepdims=True)
            family, sure = share.argmax(1), share.max(1)
        names = np.empty(len(x), object)
        for f, languages in enumerate(self.languages):
            mine = np.flatnonzero(family == f)
            won, backed = np.zeros((len(mine), len(languages))), np.zeros((len(mine), len(languages)))
            for k, (of, one, two) in enumerate(self.pairs):
                if of == f:
                    p = odds[mine, machines + k]
                    won[:, one] += p >= 0.5
                    won[:, two] += p < 0.5
                    backed[:, one] += p
                    backed[:, two] += 1 - p
            best = (won + backed / (len(languages) + 1)).argmax(1)
            names[mine] = np.array(languages, object)[best]
            if len(languages) > 1:
                sure[mine] *= backed[np.arange(len(mine)), best] / (len(languages) - 1)
        return names.tolist(), sure


def fit(x: np.ndarray, language: np.ndarray) -> Model:
    if not len(x):
        return Model()
    known = sorted(set(language))
    families = tuple(sorted({family_of(code) for code in known}))
    languages = tuple(tuple(c for c in known if family_of(c) == f) for f in families)
    of = np.array([family_of(c) for c in language])
    pairs = tuple((f, i, j) for f, codes in enumerate(languages) for i, j in combinations(range(len(codes)), 2))
    tasks = [(np.ones(len(x), bool), of == f) for f in families] if len(families) > 1 else []
    tasks += [((language == languages[f][i]) | (language == languages[f][j]), language == languages[f][i]) for f, i, j in pairs]

    def machine(rows: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, float, float]:
        y, own = np.where(positive[rows], 1.0, -1.0), x if rows.all() else x[rows]  # gone before the next one's is made
        w, b = linear_svm(own, y)
        return w, b, slope(own @ w.astype(own.dtype) + b, y)

    made = [machine(*task) for task in tasks]
    if not made:
        return Model(families, languages)
    return Model(
        families, languages, pairs, np.stack([w for w, _, _ in made], 1).astype(np.float32),
        np.array([b for _, b, _ in made]), np.array([a for _, _, a in made]),
    )


def packed(x: np.ndarray) -> list[bytes]:
    """Rows as the sample is sent to the driver: half-precision numbers, compressed, as most of them are 0."""
    return [zlib.compress(row.astype(np.float16).tobytes(), 1) for row in x]


def unpacked(raw: Sequence[bytes]) -> np.ndarray:
    x = np.empty((len(raw), DIMENSIONS), np.float32)
    for k, row in enumerate(raw):
        x[k] = np.frombuffer(zlib.decompress(row), np.float16)
    return x


def train(docs: DataFrame, usable: Column | None = None, most: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample of rows with a language: those with the smallest hash of their id, evenly by language.

    Ids and languages are sampled before any text is read; the sample's ids are all that is broadcast.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    if usable is not None:
        known = known.where(usable)
    ids = known.select("doc_id", "lang").distinct()
    counted = ids.groupBy("lang").agg(F.count("*").alias("rows"))
    languages = counted.count()
    if not languages:
        return Model()
    most = max(most, languages)
    each = -(-most // languages) * 4  # a language that has fewer leaves room to the others
    # thinned by the hash first, so that no language's rows are ever sorted as a whole
    draw = F.pmod(F.xxhash64(F.lit(17), F.col("doc_id")), F.lit(1 << 40))
    limit = F.least(F.lit(1.0), (1.5 * min(most, each) + 1000) / F.col("rows")) * (1 << 40)
    sizes = F.broadcast(counted) if languages <= BROADCAST_LANGUAGES else counted
    thinned = ids.join(sizes, "lang").where(draw < limit)
    by_hash = Window.partitionBy("lang").orderBy(draw, "doc_id")
    ranked = thinned.withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= most)
    chosen = ranked.orderBy("nth", draw, "lang").limit(most)
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("chosen_id"), F.col("lang").alias("chosen_lang")))
    same = (F.col("doc_id") == F.col("chosen_id")) & (F.col("lang") == F.col("chosen_lang"))
    texts = known.select("doc_id", "lang", text_of().alias("text")).join(chosen, same).select("lang", "text")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, x in histograms(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:last], pa.array(packed(x), pa.binary())], names=["lang", "x"])

    seen = texts.mapInArrow(vectors, "lang string, x binary")
    rows = seen.orderBy(F.xxhash64("x"), "x", "lang").limit(most).toPandas()
    return fit(unpacked(rows.pop("x")), rows["lang"].to_numpy(str))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS numbers a machine

    @F.arrow_udf("lang_pred string, score double")
    def guess(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, sure = [], [np.zeros(0)]
            for _, _, x in histograms(batch):
                name, odds = shared.value.predict(x)
                names += name
                sure.append(odds)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.concatenate(sure).astype(float))], ["lang_pred", "score"]
            )

    text = text_of(text_col)
    seen = whole_rows(docs, spoken=text.rlike(r"\p{L}"), guess=guess(text))
    named = seen.select(
        "row",
        F.when(F.col("spoken"), F.col("guess.lang_pred")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(F.col("spoken"), F.col("guess.score")).otherwise(F.lit(0.0)).alias("score"),
    )
    return with_outputs(named, docs, ["lang_pred", "score"])


#: Least score of a prediction that a corpus keeps.
LEAST_SCORE = 0.3


def keep(docs: DataFrame, model: Model, least: float = LEAST_SCORE) -> DataFrame:
    """The documents in a language that is recognised, as they are."""
    judged = predict(docs.select(F.struct("*").alias("row"), "text"), model)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
