"""URL filter: a rule list first, then logistic regression on hashed character n-grams of host and path.

The model is fitted on the driver from a small labelled URL table of at most :data:`TABLE_ROWS` rows; every
URL is judged. Digits count as one character, so page numbers carry no weight.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is allowed;
repeated rows are judged alike; a labelled table with one label only allows or blocks accordingly; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.llm.common import mixed, slices, utf8, whole_rows, with_outputs

TABLE_ROWS = 10_000
DIMENSIONS = 1 << 14
SHORTEST, LONGEST = 2, 5
PENALTY, STEPS = 1e-3, 400

#: The rules as (host and path, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: The labelled URL table that is used where the caller brings none: names of ordinary sites, to block and to allow.
BLOCKED_NAMES = """
    grand-casino casino-palace royalcasino casino-hotel-slots vegas-roulette pokerroom poker-tables blackjack-club sportsbook
    betting-odds betting-tips bingo-lounge lottery-tickets jackpot-slots slotmachines spinandwin livecasino discount-pharmacy
    generic-meds viagra-store buyviagra diet-pills pillstore painpills sleeping-pills pill-discount weightloss-fast
    muscle-steroids cheap-cigarettes cheap-watches replica-handbags cheap-replica-shoes adult-dating adult-movies adultchat
    adults-only-videos sex-cams sexshop-videos livecams webcam-girls hot-singles escort-service nude-photos porntube freeporn
    erotic-stories xxx-movies spam-mailer bulkmail email-spam spambot spam-comments buy-backlinks backlinks-shop
    seo-links link-exchange paid-links linkbuilder traffic-bot buy-followers fake-likes popup-ads banner-ads adserver
    ad-network click-tracker pixel-tracking adclicks payday-loans fast-cash cash-advance quick-loans get-rich-quick
    free-money forex-profits bitcoin-doubler miracle-cure keygen-serials crack-download warez-games torrent-movies
    free-giftcards win-iphone prize-winner survey-rewards verify-account-login secure-bank-update password-reset-alert
""".split()
ALLOWED_NAMES = """
    city-library public-library townhall weather-today daily-news evening-post morning-herald world-news garden-notes
    gardening-tips vegetable-garden cooking-recipes family-kitchen bread-bakery coffee-house tea-room travel-guide
    mountain-hiking cycling-club running-club football-league chess-society swimming-pool yoga-studio science-journal
    physics-lectures chemistry-lab biology-notes astronomy-club maths-forum history-museum art-gallery modern-art
    photography-blog film-festival theatre-tickets opera-house concert-hall jazz-radio music-school piano-lessons guitar-chords
    bookshop secondhand-books poetry-magazine short-stories writers-guild language-school grammar-guide dictionary
    encyclopedia open-data statistics-office research-institute state-university technical-college primary-school
    kindergarten teacher-resources student-union hospital childrens-clinic dental-practice eye-doctor health-service
    nutrition-advice first-aid fire-brigade police-station law-firm tax-office post-office bank-of-the-valley
    savings-bank insurance accounting architecture interior-design furniture carpentry hardware-store car-repair
    railway-timetable bus-lines airport harbour-authority shipping-company software-docs python-tutorial linux-users
    database-manual web-standards open-source code-review computer-club electronics weather-station climate-report
    nature-reserve bird-watching animal-shelter dog-training horse-riding farmers-market organic-farm wine-cellar
    cheese-dairy fishing-lake camping-site youth-hostel grand-hotel guesthouse wedding-planner flower-shop toy-store
    knitting-patterns sewing-room pottery-class parish-church monastery community-centre volunteers charity human-rights
    parliament election-results embassy foreign-affairs essex-county sussex-museum tracks-and-trails adult-education
    winter-sports free-software link-building-engineers betterment window-cleaning pillars-of-rome spamalot-musical
""".split()
_PREFIXES, _ENDS = ("", "www.", "m.", "", "blog.", "shop.", "www."), (".com", ".org", ".net", ".info", ".example")
#: Every name is paired with paths of all kinds, so that a path says little.
PATHS = ("/", "/index.html", "/about", "/en/contact", "/news/2024/05/17/", "/products/list.html", "/blog/post-42", "")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table: ``url``, ``blocked``."""
    rows = [
        (f"https://{_PREFIXES[i % len(_PREFIXES)]}{name}{_ENDS[(i + k) % len(_ENDS)]}{PATHS[(i + k) % len(PATHS)]}", int(blocked))
        for names, blocked in ((BLOCKED_NAMES, True), (ALLOWED_NAMES, False))
        for i, name in enumerate(names)
        for k in (0, 3)
    ]
    return spark.createDataFrame(rows, "url string, blocked int")


def held_out_shares(folds: int = 5) -> tuple[float, float]:
    """Shares of blocked and of allowed names judged right by models that have seen neither the name nor its paths."""
    names = [(n, 1) for n in BLOCKED_NAMES] + [(n, 0) for n in ALLOWED_NAMES]
    hosts, paths = ([f"{n}{_ENDS[k % len(_ENDS)]}" for k, (n, _) in enumerate(names)], [PATHS[k % len(PATHS)] for k in range(len(names))])
    label, right = np.array([b for _, b in names]), np.zeros(len(names), bool)
    for fold in range(folds):
        out = np.arange(len(names)) % folds == fold
        model = fit([h for h, o in zip(hosts, out, strict=True) if not o], [p for p, o in zip(paths, out, strict=True) if not o], label[~out])
        found = model.probability(*(pa.array([x for x, o in zip(some, out, strict=True) if o]) for some in (hosts, paths)))
        right[out] = (found >= 0.5) == (label[out] == 1)
    return float(right[label == 1].mean()), float(right[label == 0].mean())


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):  # the longest is asked first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _hashed(parts: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, dimension and weight of every n-gram of the given text columns of equal length."""
    rows, dims, weights = [], [], []
    for salt, texts in enumerate(parts):
        data, starts = utf8(texts)
        length = np.diff(starts)
        # each text between a start and an end mark; digits are one character
        marked = np.full(len(data) + 2 * len(length), 1, np.uint8)
        at = np.arange(len(data)) + np.repeat(2 * np.arange(len(length)) + 1, length)
        marked[at] = np.where((data >= 48) & (data <= 57), 48, data)
        row = np.repeat(np.arange(len(length)), length + 2)
        end = np.repeat(np.cumsum(length + 2), length + 2)
        here = np.arange(len(marked))
        state = np.full(len(marked), salt + 1, np.uint64)
        found = []
        for n in range(1, LONGEST + 1):
            inside = here + n <= end
            ahead = marked[np.minimum(here + n - 1, len(marked) - 1)] if len(marked) else marked
            state = state * np.uint64(0x100000001B3) + ahead
            if n >= SHORTEST:
                found.append((row[inside], (mixed(state[inside]) % np.uint64(DIMENSIONS)).astype(np.int64)))
        row, dim = (np.concatenate(x) for x in zip(*found, strict=True))
        count = np.bincount(row, minlength=len(length))
        rows.append(row)
        dims.append(dim)
        weights.append(1 / np.sqrt(np.maximum(count, 1))[row])
    return np.concatenate(rows), np.concatenate(dims), np.concatenate(weights)


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray

    def probability(self, host: pa.Array, path: pa.Array) -> np.ndarray:
        out = np.zeros(len(host))
        for first, last in slices(utf8(host)[1] + utf8(path)[1]):
            row, dim, weight = _hashed([host[first:last], path[first:last]])
            out[first:last] = np.bincount(row, self.weights[dim] * weight, last - first)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -40, 40)))


def fit(hosts: list[str], paths: list[str], blocked: np.ndarray) -> Model:
    """Logistic regression with an L2 penalty, by accelerated gradient steps."""
    y = np.asarray(blocked, float)
    if not len(y) or y.min() == y.max():
        return Model(40.0 if len(y) and y[0] else -40.0, np.zeros(DIMENSIONS))
    row, dim, weight = _hashed([pa.array(hosts, pa.string()), pa.array(paths, pa.string())])
    used, dim = np.unique(dim, return_inverse=True)
    w, bias, ahead, ahead_bias, t = np.zeros(len(used)), 0.0, np.zeros(len(used)), 0.0, 1.0
    rate = 4.0 / 3.0  # a row's n-grams have at most norm 1 for host and path each, with the bias 3 in all
    norm = max(np.bincount(row, weight**2 * len(used)).max() / len(used), 1.0)
    rate /= norm
    for _ in range(STEPS):
        slack = 1 / (1 + np.exp(-(np.bincount(row, ahead[dim] * weight, len(y)) + ahead_bias))) - y
        gradient = np.bincount(dim, slack[row] * weight, len(used)) / len(y) + PENALTY * ahead
        w_next, bias_next = ahead - rate * gradient, ahead_bias - rate * slack.mean()
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, ahead_bias = w_next + (t - 1) / t_next * (w_next - w), bias_next + (t - 1) / t_next * (bias_next - bias)
        w, bias, t = w_next, bias_next, t_next
    weights = np.zeros(DIMENSIONS)
    weights[used] = w
    return Model(float(bias), weights)


def train(labelled: DataFrame, most: int = TABLE_ROWS) -> Model:
    """Fit on at most ``most`` rows of ``labelled`` (``url``, ``blocked``), those with the smallest hash of the URL."""
    url = F.col("url")
    known = labelled.where(url.isNotNull() & F.col("blocked").isNotNull())
    rows = known.select(host_of(url).alias("host"), path_of(url).alias("path"), F.col("blocked").cast("int").alias("blocked"), "url")
    rows = rows.orderBy(F.xxhash64("url"), "url", "blocked").limit(most).collect()
    return fit([r["host"] for r in rows], [r["path"] for r in rows], np.array([r["blocked"] for r in rows]))


def judge(pages: DataFrame, model: Model, rules=RULES, url_col: str = "url") -> DataFrame:
    """All columns of ``pages`` and ``host``, ``path``, ``rule``, ``block_probability``, ``verdict``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS numbers

    @F.arrow_udf("double")
    def probability(host: pa.Array, path: pa.Array) -> pa.Array:
        return pa.array(shared.value.probability(host, path))

    url = F.col(url_col).cast("string")
    parts = whole_rows(pages, host=host_of(url), path=path_of(url))
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    scored = parts.select("row", "host", "path", rule.alias("rule"), says.alias("says"), probability("host", "path").alias("block_probability"))
    empty = (F.col("host") == "") & (F.col("path") == "")
    own = F.when(~empty & (F.col("block_probability") >= 0.5), F.lit("block")).otherwise(F.lit("allow"))
    judged = scored.withColumn("verdict", F.coalesce("says", own))
    return with_outputs(judged, pages, ["host", "path", "rule", "block_probability", "verdict"])
