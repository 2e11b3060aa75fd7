"""Toxicity with a factorization machine over hashed terms.

A text's terms are its distinct words and their beginnings, hashed to `BUCKETS` buckets. Every bucket that `LEAST_ROWS` counted
rows have gets a weight from its log odds. The `FEATURES` / 2 buckets that part the classes best and the `FEATURES` / 2 that most
rows have become features as well; the latter may be even alone and tell together. The machine learns the features' weights and,
for every pair of features that meet in a text, the product of their factors: score = sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>),
so an insult and a group mention can weigh more together than apart.

What is learnt comes from bounded samples of the labelled rows, in the order of a hash of their ids: terms are counted in at most
`COUNTED` rows of each class, whose ids are broadcast, so no text is shuffled; the machine is fitted in one task on the first
`SAMPLE` of each class, weighted back to the true class sizes. Weights start from the counts and are drawn to them, so a term
too rare for the fitted rows is learnt. Scoring is a narrow pass over all whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillbank.llm.frames import Shared, attach, cut, slices, unpacked, words

BUCKETS = 1 << 20
FEATURES = 8192
FACTORS = 8
SAMPLE = 4096
#: Labelled rows of each class that terms are counted in, at most; their ids take up to 2 MB.
COUNTED = 1 << 16
PREFIXES = (4, 5, 6)
EPOCHS = 12
BATCH = 256
#: Steps of training at least: of few rows there are more rounds.
STEPS = 200
THRESHOLD = 0.3
#: Counted rows that a bucket needs to get a weight.
LEAST_ROWS = 5
#: Words whose features a task remembers before it starts anew.
REMEMBERED = 1 << 19


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def word_buckets(word: bytes) -> list[int]:
    """The word itself and its beginnings."""
    return [zlib.crc32(word)] + [zlib.crc32(word[:n], n) for n in PREFIXES if len(word) > n]


class Buckets(dict):
    """Buckets by word, made when first asked for."""

    def __missing__(self, word: bytes):
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = found = tuple({h % BUCKETS for h in word_buckets(word)})
        return found


def text_buckets(text: bytes, known: Buckets) -> np.ndarray:
    found: set[int] = set()
    for w in set(words(text)):
        found.update(known[w])
    return np.sort(np.fromiter(found, np.uint32, len(found)))


@dataclass
class Machine:
    """Feature of each bucket (-1: none), bias, the features' weights and factors, and the weights of all other buckets."""

    feature: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    other: np.ndarray

    def score(self, features: np.ndarray, others: float = 0.0) -> float:
        """Of the features of a text and the sum of its other buckets' weights."""
        v = self.factor[features]
        z = self.bias + others + float(self.weight[features].sum()) + 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def score_buckets(self, buckets: np.ndarray) -> float:
        features = self.feature[buckets]
        return self.score(features[features >= 0], float(self.other[buckets].sum()))


@dataclass
class Terms:
    """Buckets that become features, in order, with the weights to start from, and the weights of all other buckets."""

    bucket: np.ndarray
    prior: np.ndarray
    other: np.ndarray

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, features: int) -> Terms:
        """From the toxic (a) and other (b) rows that each bucket is in. A word has up to four buckets, so each starts from a
        quarter of its log odds, less of it the fewer standard deviations these are from zero."""
        odds = np.log((a + 0.5) / (n_a - a + 0.5)) - np.log((b + 0.5) / (n_b - b + 0.5))
        z = np.abs(odds) / np.sqrt(1 / (a + 0.5) + 1 / (n_a - a + 0.5) + 1 / (b + 0.5) + 1 / (n_b - b + 0.5))
        weight = np.where(a + b >= LEAST_ROWS, odds * z**2 / (z**2 + 4) / (1 + len(PREFIXES)), 0)
        usable = np.flatnonzero(a + b >= LEAST_ROWS)
        telling = usable[np.argsort(-z[usable], kind="stable")][: features // 2]
        common = usable[np.argsort(-(a + b)[usable], kind="stable")][: features // 2]
        at = np.union1d(telling, common).astype(np.int64)
        other = weight.astype(np.float32)
        other[at] = 0
        return cls(at, weight[at], other)


def terms_of_rows(rows: list[np.ndarray], label: np.ndarray, features: int) -> Terms:
    a, b = (np.bincount(np.concatenate([r for r, y in zip(rows, label) if y == side] or [np.zeros(0, np.int64)]).astype(np.int64), minlength=BUCKETS) for side in (1, 0))
    return Terms.of(a, b, int((label == 1).sum()), int((label == 0).sum()), features)


def sampled(usable: DataFrame, size: int) -> DataFrame:
    """At most `size` rows of each label of `usable` (doc_id, label), in the order of a hash of their ids."""
    sides = [usable.where(F.col("label") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for side in (0, 1)]
    return sides[0].unionAll(sides[1])


def count_terms(documents: DataFrame, counted: DataFrame, features: int) -> Terms:
    """The terms of the rows of `counted` (doc_id, label), which is broadcast: `COUNTED` rows a class bound it. One row a bucket comes
    to the driver, at most `BUCKETS`."""
    texts = documents.select("doc_id", "text").join(F.broadcast(counted), "doc_id").select("text", "label")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets()
        counts = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            for text, label in zip(slices(batch.column(0)), batch.column(1).to_pylist()):
                counts[label, text_buckets(text, known)] += 1
                counts[label, BUCKETS] += 1
        at = np.flatnonzero(counts.any(axis=0))
        for k in range(0, len(at), 10_000):
            some = at[k : k + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[1, some]), pa.array(counts[0, some])], names=["bucket", "a", "b"])

    sums = texts.mapInArrow(work, "bucket int, a bigint, b bigint").groupBy("bucket").agg(F.sum("a").cast("int").alias("a"), F.sum("b").cast("int").alias("b"))
    found = sums.toArrow()
    counts = np.zeros((2, BUCKETS + 1), np.int64)
    counts[:, found.column("bucket").to_numpy()] = found.column("a").to_numpy(), found.column("b").to_numpy()
    return Terms.of(counts[0, :BUCKETS], counts[1, :BUCKETS], int(counts[0, BUCKETS]), int(counts[1, BUCKETS]), features)


def fit(rows: list[np.ndarray], label: np.ndarray, weight: np.ndarray, features: int = FEATURES, factors: int = FACTORS, epochs: int = EPOCHS, terms: Terms | None = None) -> Machine:
    """Weighted logistic loss, small squared penalties, Adam on batches in a fixed random order with steps that shrink to zero."""
    terms = terms_of_rows(rows, label, features) if terms is None else terms
    chosen, prior = terms.bucket, terms.prior
    feature = np.full(BUCKETS, -1, np.int16)
    feature[chosen] = np.arange(len(chosen))
    held = [f[f >= 0] for f in (feature[r] for r in rows)]
    others = np.array([terms.other[r].sum() for r in rows])
    random = np.random.default_rng(7)
    share = float(np.clip((weight * label).sum() / weight.sum(), 1e-4, 1 - 1e-4))
    parts = [np.array([np.log(share / (1 - share))]), prior.copy(), random.normal(0, 0.05, (len(chosen), factors))]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    scale = weight / weight.mean()
    step, batches = 0, max(1, len(rows) // BATCH)
    rounds = max(epochs, -(-STEPS // batches))
    for _ in range(rounds):
        for at in np.array_split(random.permutation(len(rows)), batches):
            b, w, v = parts
            xb = np.zeros((len(at), len(chosen)))
            for k, row in enumerate(at):
                xb[k, held[row]] = 1
            xv = xb @ v
            z = b[0] + others[at] + xb @ w + 0.5 * ((xv**2).sum(axis=1) - xb @ (v**2).sum(axis=1))
            g = scale[at] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[at]) / len(at)
            xg = xb.T @ g
            slopes = [np.array([g.sum()]), xg + 1e-4 * (w - prior), xb.T @ (g[:, None] * xv) - v * xg[:, None] + 1e-4 * v]
            rate = 0.02 * (1 - step / (rounds * batches))
            step += 1
            for p, m, s, d in zip(parts, first, second, slopes):
                m += 0.1 * (d - m)
                s += 0.01 * (d**2 - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
    return Machine(feature, float(parts[0][0]), parts[1], parts[2], terms.other)


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine | None:
    """A machine from the rows of `labels` (doc_id, toxic 0 or 1) that aren't held out; None if there are none.

    Other labels, null ids and ids without a document are left out; a document labelled twice counts twice.
    """
    spark = documents.sparkSession
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.select("doc_id", F.col("toxic").cast("int").alias("label"))
    sizes = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    if not sizes:
        return None
    terms = count_terms(documents, sampled(usable, COUNTED), FEATURES)
    times = F.lit(1.0)
    for side, size in sizes.items():
        times = F.when(F.col("label") == side, size / min(size, sample)).otherwise(times)
    picked = sampled(usable, sample).withColumn("weight", times)
    texts = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")

    def work(batches: Iterator[dict[str, pa.Array]]) -> Iterator[pa.Array]:
        known = Buckets()
        for batch in batches:
            yield pa.StructArray.from_arrays([pa.array([text_buckets(t, known).tobytes() for t in slices(batch["text"])], pa.binary())], ["buckets"])

    marked = unpacked(attach(texts, ["text"], work, "buckets binary", ["doc_id", "label", "weight"]))

    def fit_rows(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("buckets", "ascending")])
        rows = [np.frombuffer(b, np.uint32) for b in group.column("buckets").to_pylist()]
        m = fit(rows, group.column("label").to_numpy().astype(float), group.column("weight").to_numpy(), terms=terms)
        return pa.table({
            "bias": [m.bias], "chosen": [np.flatnonzero(m.feature >= 0).astype(np.int32).tobytes()],
            "weight": [m.weight.tobytes()], "factor": [m.factor.tobytes()],
        })

    model = marked.groupBy(F.lit(1).alias("all")).applyInArrow(
        lambda _, group: fit_rows(group), "bias double, chosen binary, weight binary, factor binary"
    ).first()
    if model is None:
        return None
    chosen_buckets = np.frombuffer(bytes(model.chosen), np.int32)
    feature = np.full(BUCKETS, -1, np.int16)
    feature[chosen_buckets] = np.arange(len(chosen_buckets))
    weight = np.frombuffer(bytes(model.weight))
    return Machine(feature, model.bias, weight, np.frombuffer(bytes(model.factor)).reshape(len(weight), FACTORS), terms.other)


def with_score(documents: DataFrame, machine: Machine | None, keep: list[str] | None = None) -> DataFrame:
    """`documents` packed by `attach`, with `found.score` from 0 to 1.

    A text without words, an empty or null one too, gets the score of no terms; without a machine all scores are 0.
    """
    shared = Shared(documents.sparkSession, machine)

    def work(batches: Iterator[dict[str, pa.Array]]) -> Iterator[pa.Array]:
        m = shared.get()
        known = Buckets()
        for batch in batches:
            scores = [m.score_buckets(text_buckets(text, known)) if m else 0.0 for text in slices(batch["text"])]
            yield pa.StructArray.from_arrays([pa.array(scores, pa.float64())], ["score"])

    return attach(documents, ["text"], work, "score double", keep)


def score(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of `documents`; predicted is 1 from a score of 0.3."""
    scored = unpacked(with_score(documents.select("doc_id", "text"), train(documents, labels, sample), ["doc_id"]))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def without_toxic(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of `documents`, all columns, that score below the threshold."""
    scored = with_score(documents, train(documents, labels, sample))
    return unpacked(scored.where(F.col("found.score") < THRESHOLD), [])
