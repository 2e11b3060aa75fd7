"""URL filters: rules of host and path first, a logistic regression on hashed character n-grams for all other URLs.

A URL's host and path, framed and in lower case, give their distinct character n-grams of 3 to 5 code points, hashed to
`BUCKETS` buckets that host and path don't share on purpose. The n-grams of each of the two weigh together 1 by their
squares, so that a long path doesn't drown its host. score = sigmoid(b + w . x) is the likelihood that a URL is to be blocked.

Training takes a small table of labelled URLs, at most `SAMPLE` rows in the order of a hash, in one task, both classes alike; the bias
is set by `PRIOR`, so that names the table doesn't know are let through. Filtering is a narrow pass over all URLs that reads no other column of a page: no shuffle, no key, no skew.

Defined results: a null URL, and one without `://`, has an empty host and path, fits no rule and gets the score of no
n-grams; ports and users count as parts of the host; a URL without a path fits no rule whose path starts with a slash. Rows
that repeat are judged one by one, extra columns of any name stay in `row` or are dropped, and an empty table gives no rows.
Without labelled URLs nothing is blocked but by rules. Time and memory are linear in the length of a URL.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillbank.llm.frames import Shared, attach, slices

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
#: Labelled URLs that the model is fitted on, at most.
SAMPLE = 1 << 14
STEPS = 600
PENALTY = 1e-5
THRESHOLD = 0.5
#: Likelihood for a URL whose n-grams tell nothing; it sets the bias, which a small table can't teach.
PRIOR = 0.1
ALLOW, BLOCK = "allow", "block"

# Words for the table of labelled URLs that the query learns from; each stands in hosts and paths of several shapes.
BLOCKED_WORDS = [
    "casino", "poker", "bets", "betting", "slots", "jackpot", "roulette", "bookmaker", "lottery", "bingo", "wager", "blackjack",
    "pills", "viagra", "pharmacy", "dietpills", "steroids", "adult", "xxx", "porn", "escort", "webcam-girls", "sexchat", "nude",
    "spam", "linkfarm", "farm-links", "seo-links", "ads", "adserver", "adtrack", "tracker", "tracking", "popunder", "banner-ads",
    "clicks", "doorway", "malware", "phishing", "warez", "keygen", "cracked", "replica", "fakewatches", "payday", "quickloan",
    "free-money", "win-prize", "win-cash", "cheap-meds", "cheap-watches", "freebies", "followers", "hot-deals",
]
ALLOWED_WORDS = [
    "library", "university", "school", "museum", "garden", "weather", "history", "science", "recipes", "news", "journal",
    "gazette", "city", "council", "hospital", "music", "theatre", "archive", "travel", "railway", "mountain", "river", "forest",
    "bakery", "cycling", "chess", "football", "physics", "chemistry", "biology", "astronomy", "poetry", "novels", "letters",
    "parish", "harbour", "market", "farmers", "workshop", "carpentry", "painting", "photo", "cinema", "radio", "village",
    "society", "institute", "college", "kitchen", "orchard", "winery", "timber", "addresses", "winter", "betterhomes", "trackside",
]
# Frequent English letter groups, which invented names are made of; such names tell nothing.
SYLLABLES = [
    "th", "he", "in", "er", "an", "re", "on", "at", "en", "nd", "ti", "es", "or", "te", "of", "ed", "is", "it", "al", "ar", "st", "to",
    "nt", "ng", "se", "ha", "as", "ou", "io", "le", "ve", "co", "me", "de", "hi", "ri", "ro", "ic", "ne", "ea", "ra", "ing", "ion", "ent", "ble", "ly",
]
SHAPES = [
    "https://{w}.example.{t}/{p}", "http://www.{w}.example.{t}/{p}", "https://{n}-{w}.example.{t}/{p}", "https://{w}-{n}.example.{t}/{p}",
    "http://m.{w}{n}.example.{t}/{p}", "https://{n}.example.{t}/{w}/{p}",
]
#: URLs of invented names for each URL with a word.
INVENTED = 2
#: URLs with a word in each shape.
REPEATS = 3


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, blocked 0 or 1): every word above `REPEATS` times in every shape beside invented names; for each of these
    `INVENTED` URLs of invented names alone. Endings and pages are drawn for all alike."""
    draw = random.Random(5)

    def name() -> str:
        return "".join(draw.choice(SYLLABLES) for _ in range(draw.randint(2, 4)))

    def url(shape: str, word: str) -> str:
        page = f"{draw.choice(['en', 'de', 'fr', 'es', 'it'])}/{draw.randint(1, 9999)}{draw.choice(['', '/', '.html', '?page=2', '#top'])}"
        return shape.format(w=word, n=name(), t=draw.choice(["com", "org", "net", "info"]), p=page)

    rows = []
    for blocked, words in ((1, BLOCKED_WORDS), (0, ALLOWED_WORDS)):
        for word in words:
            for shape in SHAPES * REPEATS:
                rows.append((url(shape, word), blocked))
                rows += [(url(shape, name()), 0) for _ in range(INVENTED)]
    return spark.createDataFrame(rows, "url string, blocked int")


def parts(url: bytes) -> tuple[bytes, bytes]:
    """Host, A-Z lower-cased, and path."""
    at = url.find(b"://")
    if at < 0:
        return b"", b""
    rest = url[at + 3 :]
    ends = [k for k in (rest.find(b"#"), rest.find(b"?")) if k >= 0]
    rest = rest[: min(ends)] if ends else rest
    slash = rest.find(b"/")
    host, path = (rest, b"") if slash < 0 else (rest[:slash], rest[slash:])
    return host.lower(), path


class Rules:
    """Rules by host; of those that fit, the longest counts, of equally long ones the one with the longer host."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        """`rules` are (verdict, host, path)."""
        self.known: dict[bytes, tuple[list[int], dict[bytes, tuple[str, str]]]] = {}
        for verdict, host, path in rules:
            lengths, by_path = self.known.setdefault(host.lower().encode(), ([], {}))
            key = path.encode()
            if len(key) not in lengths:
                lengths.append(len(key))
            by_path[key] = (host + path, verdict)
        self.labels = max((h.count(b".") + 1 for h in self.known), default=0)

    def of(self, host: bytes, path: bytes) -> tuple[str, str] | None:
        """The rule and its verdict. Only as many labels of the host are looked at as some rule has."""
        labels = host.rsplit(b".", self.labels)[-self.labels :] if self.labels else []
        best, longest = None, (-1, -1)
        for k in range(len(labels)):
            suffix = b".".join(labels[k:])
            lengths, by_path = self.known.get(suffix, ((), {}))
            for n in lengths:
                found = by_path.get(path[:n]) if n <= len(path) else None
                if found and (len(suffix) + n, len(suffix)) > longest:
                    best, longest = found, (len(suffix) + n, len(suffix))
        return best


def grams(text: bytes, seed: int) -> np.ndarray:
    """Distinct buckets of the n-grams of a framed text."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(f"^{text.lower().decode('utf-8', 'replace')}$".encode("utf-32-le"), np.uint32)
    out = []
    for n in GRAMS:
        if len(points) >= n:
            h = np.full(len(points) - n + 1, seed * 31 + n, np.uint32)
            for k in range(n):
                h = (h ^ points[k : len(points) - n + 1 + k]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            out.append(h % np.uint32(BUCKETS))
    return np.unique(np.concatenate(out)).astype(np.int64) if out else np.zeros(0, np.int64)


def features(url: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a URL's host and path."""
    found = [grams(part, seed) for seed, part in enumerate(parts(url))]
    return np.concatenate(found), np.concatenate([np.full(len(f), 1 / np.sqrt(max(1, len(f)))) for f in found])


@dataclass
class Model:
    bias: float
    weight: np.ndarray

    def score(self, buckets: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.bias + float(self.weight[buckets] @ values), -30, 30))))


def fit(urls: list[bytes], label: np.ndarray) -> Model:
    """Logistic loss with a squared penalty, both classes alike, by Nesterov steps over all rows."""
    found = [features(u) for u in urls]
    row = np.repeat(np.arange(len(urls)), [len(f) for f, _ in found])
    bucket = np.concatenate([f for f, _ in found])
    value = np.concatenate([v for _, v in found])
    used, column = np.unique(bucket, return_inverse=True)
    scale = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum()))
    bias = float(np.log(PRIOR / (1 - PRIOR)))
    w = old = np.zeros(len(used))
    for k in range(STEPS):
        look = w + k / (k + 3) * (w - old)
        z = bias + np.bincount(row, look[column] * value, len(urls))
        g = scale * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label)
        old, w = w, look - 2 * (np.bincount(column, g[row] * value, len(used)) + PENALTY * look)
    weight = np.zeros(BUCKETS, np.float32)
    weight[used] = w
    return Model(bias, weight)


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from rows (url, blocked 0 or 1); null URLs and other labels are left out. None without rows of both classes."""
    rows = labelled.where(F.col("blocked").isin(0, 1) & F.col("url").isNotNull()).select("url", F.col("blocked").cast("int").alias("blocked"))
    some = rows.orderBy(F.xxhash64("url"), "url", "blocked").limit(sample)

    def fitted(_, group):
        group = group.sort_by([("url", "ascending"), ("blocked", "ascending")])
        model = fit(list(slices(group.column("url").combine_chunks())), group.column("blocked").to_numpy().astype(float))
        return pa.table({"bias": [model.bias], "weight": [model.weight.tobytes()], "classes": pa.array([len(set(group.column("blocked").to_pylist()))], pa.int32())})

    found = some.groupBy(F.lit(1).alias("all")).applyInArrow(fitted, "bias double, weight binary, classes int").first()
    if found is None or found.classes < 2:
        return None
    return Model(found.bias, np.frombuffer(bytes(found.weight), np.float32))


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]], model: Model | None, keep: list[str] | None = None) -> DataFrame:
    """`pages` packed by `attach`, with `found`: host, path, rule, verdict and the model's score, also where a rule decides."""
    shared = Shared(pages.sparkSession, (Rules(rules), model))

    def work(batches: Iterator[dict[str, pa.Array]]) -> Iterator[pa.Array]:
        known, m = shared.get()
        for batch in batches:
            out: list[tuple] = []
            for url in slices(batch["url"]):
                host, path = parts(url)
                rule, verdict = known.of(host, path) or (None, None)
                score = m.score(*features(url)) if m else 0.0
                out.append((host, path, rule, verdict or (BLOCK if score >= THRESHOLD else ALLOW), score))
            host, path, rule, verdict, score = zip(*out) if out else ((),) * 5
            yield pa.StructArray.from_arrays([
                pa.array(host, pa.binary()).view(pa.string()), pa.array(path, pa.binary()).view(pa.string()),
                pa.array(rule, pa.string()), pa.array(verdict, pa.string()), pa.array(score, pa.float64()),
            ], ["host", "path", "rule", "verdict", "score"])

    return attach(pages, ["url"], work, "host string, path string, rule string, verdict string, score double", keep)


def allowed(pages: DataFrame, rules: Iterable[tuple[str, str, str]], model: Model | None) -> DataFrame:
    """The rows of `pages`, all columns, that aren't blocked."""
    kept = judge(pages, rules, model).where(F.col("found.verdict") == ALLOW)
    return kept.select(*[F.col(f"row.`{c.replace('`', '``')}`").alias(c) for c in pages.columns])
