"""Quality scores by positive-unlabelled learning.

A linear scorer is trained on trusted positives and unlabelled web text only:
the non-negative unbiased risk (positives weighted by the class prior; the
negative part estimated from unlabelled text minus positives and kept from
going below zero) is minimised by full-batch Adam. The class prior is estimated
from the same two samples, so labels other than 1 are not needed: a classifier
of positives against unlabelled text is trained on one half of each and scores
the other; the prior is the least share of unlabelled scores above a threshold
for that of positives, where the least is taken with confidence widths added
(best-bin estimation), averaged over both halves.

Features see the whole text: how often each class of byte (lower case, upper
case, digit, space, line break, each kind of mark, part of a longer character)
follows each other, and shares of repeated words, distinct words, repeated
lines and marks at word ends. Text is read in pieces, so a very long document
needs no more memory than a piece beside itself.

Training uses at most ``max_positive`` positives and ``max_unlabelled``
unlabelled texts (the rows with the least hash of doc_id), whose features meet
in one task; the driver gets the scorer alone. Everything else covers all
rows. Null texts count as empty and get a score like any other;
rows without a doc_id are scored, never learnt from. Repeated rows score alike;
of rows that share a doc_id training reads one (the least text).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contract_lake.llm.common import arrow_map, batch_of, byte_views

#: Marks with a class of their own; other ASCII marks share one.
MARKS = "!#$%&*|.,;:-_<>/(){}=@\"'"
LOWER, UPPER, DIGIT, SPACE, BREAK, CONTROL, HIGH, OTHER = range(8)
CLASSES = 8 + len(MARKS)
PIECE = 1 << 20


def _classes() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    out[:32], out[127], out[128:] = CONTROL, CONTROL, HIGH
    for c in range(128):
        if chr(c).islower():
            out[c] = LOWER
        elif chr(c).isupper():
            out[c] = UPPER
        elif chr(c).isdigit():
            out[c] = DIGIT
    out[[32, 9]], out[[10, 13]] = SPACE, BREAK
    for i, mark in enumerate(MARKS):
        out[ord(mark)] = 8 + i
    return out


CLASS_OF = _classes()
SHARES = 8
N_FEATURES = CLASSES * CLASSES + SHARES


def features(octets: np.ndarray) -> np.ndarray:
    """Feature vector of one text."""
    pairs = np.zeros(CLASSES * CLASSES, np.int64)
    for at in range(0, max(1, len(octets) - 1), PIECE):
        kinds = CLASS_OF[octets[at:at + PIECE + 1]].astype(np.int32)
        pairs += np.bincount(kinds[:-1] * CLASSES + kinds[1:], minlength=CLASSES * CLASSES)
    out = np.zeros(N_FEATURES, np.float32)
    out[:CLASSES * CLASSES] = np.sqrt(pairs / max(1, len(octets) - 1))
    text = octets.tobytes()
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if len(x) > 20]
    shares = (
        sum(map(eq, words, words[1:])) / n,  # the same word again
        sum(map(eq, words, words[2:])) / n,
        min(1.0, len(counts) / n ** 0.85),
        max(counts.values(), default=0) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(n) / 10,
        min(3.0, len(text) / n / 10),
        1.0 if len(words) < 5 else 0.0,
    )
    out[CLASSES * CLASSES:] = shares
    return out


@dataclass(frozen=True)
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, steps: int = 400, rate: float = 0.02,
        decay: float = 1e-4) -> Scorer:
    """Minimise the non-negative PU risk with the logistic loss; without a
    prior, that of telling positives from unlabelled rows."""
    every = np.concatenate([positive, unlabelled])
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-2
    del every
    p, u = (np.clip((x - mean) / scale, -8, 8).astype(np.float64) for x in (positive, unlabelled))
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    for step in range(1, steps + 1):
        sp, su = sigmoid(p @ w + b), sigmoid(u @ w + b)
        dp, du = (-(1 - sp) / len(p), su / len(u)) if prior is None else risk_slopes(sp, su, prior)
        grad = np.append(p.T @ dp + u.T @ du + decay * w, dp.sum() + du.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Scorer(mean, scale, w, b, 0.5 if prior is None else prior)


def risk(sp: np.ndarray, su: np.ndarray, prior: float) -> tuple[float, float]:
    """Positive and (unbiased) negative part of the PU risk at the scores of
    positives and unlabelled rows. Loss of the negative class: -log(1 - s), of
    the positive class: -log s."""
    positive = -prior * np.log(np.maximum(sp, 1e-12)).mean()
    return positive, -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()


def risk_slopes(sp: np.ndarray, su: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the risk by each row's score before the sigmoid; where the
    negative part is below zero, what a risk cannot be, those out of it."""
    gp, gu = -prior * sp / len(sp), su / len(su)  # of the negative part
    if risk(sp, su, prior)[1] < 0:
        return -gp, -gu
    return gp - prior * (1 - sp) / len(sp), gu


def best_bin(positive: np.ndarray, unlabelled: np.ndarray, chance: float = 0.1, gamma: float = 0.01) -> float:
    """Share of positives among unlabelled rows from scores of both."""
    p, u = np.sort(positive), np.sort(unlabelled)
    cuts = np.unique(p)
    above_p, above_u = (1 - np.searchsorted(x, cuts) / len(x) for x in (p, u))
    width = sum(np.sqrt(np.log(4 / chance) / (2 * len(x))) for x in (p, u))
    best = np.argmin((above_u + (1 + gamma) * width) / above_p)
    return float(above_u[best] / above_p[best])


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 3) -> float:
    """The class prior, from 0.01 to 0.99."""
    chance = np.random.default_rng(seed)
    halves = [np.array_split(chance.permutation(len(x)), 2) if len(x) > 1 else [np.arange(len(x))] * 2 for x in (positive, unlabelled)]
    found = []
    for own, other in ((0, 1), (1, 0)):
        scorer = fit(positive[halves[0][own]], unlabelled[halves[1][own]], None, steps=200)
        found.append(best_bin(scorer(positive[halves[0][other]]), scorer(unlabelled[halves[1][other]])))
    return min(0.99, max(0.01, sum(found) / 2))


def held_out(doc_id: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether a row's labels are never learnt from (NULL doc_id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _feature_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id``, ``x`` (features) of the documents named by ``ids`` (bounded by the caller), one row each."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float32()))])

    def run(batches):
        for batch in batches:
            yield batch_of(schema, batch.column("doc_id"), [features(v) for v in byte_views(batch.column("text"))])

    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(ids), "doc_id", "left_semi")
            .groupBy("doc_id").agg(F.min("text").alias("text")))
    return arrow_map(rows, run, "doc_id long, x array<float>")


def _matrix(doc_id: pa.ChunkedArray, x: pa.ChunkedArray) -> np.ndarray:
    """The lists of features ``x`` as rows, by doc_id."""
    order = np.argsort(doc_id.to_numpy(), kind="stable")
    out, at = np.empty((len(order), N_FEATURES), np.float32), np.empty_like(order)
    at[order] = np.arange(len(order))
    start = 0
    for chunk in x.chunks:
        out[at[start:start + len(chunk)]] = chunk.flatten().to_numpy(zero_copy_only=False).reshape(len(chunk), N_FEATURES)
        start += len(chunk)
    return out


def _features_of(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Features of the documents named by ``ids`` (few: they come to the driver), one row each."""
    found = _feature_rows(docs, ids).toArrow()
    return _matrix(found.column("doc_id"), found.column("x"))


def _fitted(sample: DataFrame) -> Scorer | None:
    """The scorer of a ``sample`` (``positive``, ``doc_id``, ``x``; bounded by
    the caller), fitted in a task; None without a row of either kind."""
    schema = pa.schema([("mean", pa.list_(pa.float32())), ("scale", pa.list_(pa.float32())), ("weights", pa.list_(pa.float64())),
                        ("bias", pa.float64()), ("prior", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        del held
        kinds = rows.column("positive").to_numpy()
        p, u = (_matrix(x.column("doc_id"), x.column("x")) for x in (rows.filter(pa.array(kinds)), rows.filter(pa.array(~kinds))))
        del rows
        if len(p) and len(u):
            scorer = fit(p, u, estimated_prior(p, u))
            yield batch_of(schema, [scorer.mean], [scorer.scale], [scorer.weights], [scorer.bias], [scorer.prior])

    found = arrow_map(sample.repartition(1), run, "mean array<float>, scale array<float>, weights array<double>, bias double, prior double").toArrow()
    if not len(found):
        return None
    mean, scale, weights = (found.column(c).combine_chunks().flatten().to_numpy() for c in ("mean", "scale", "weights"))
    return Scorer(mean, scale, weights, *(found.column(c)[0].as_py() for c in ("bias", "prior")))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_positive: int = 4000,
          max_unlabelled: int = 8000) -> Scorer:
    """A scorer from the labels outside the held-out fold. Without a usable
    positive or any text it scores everything 1 (nothing is known against it)."""
    usable = labels.where(~held_out() & F.col("doc_id").isNotNull() & (F.col(label) == 1))
    known = docs.select(F.col("doc_id")).where(~held_out() & F.col("doc_id").isNotNull()).distinct()
    order = F.xxhash64("doc_id")
    positive = usable.select("doc_id").distinct().join(known, "doc_id").orderBy(order, "doc_id").limit(max_positive)
    unlabelled = known.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(max_unlabelled)
    kinds = [_feature_rows(docs, ids).select(F.lit(kind).alias("positive"), "doc_id", "x") for kind, ids in ((True, positive), (False, unlabelled))]
    return _fitted(kinds[0].union(kinds[1])) or Scorer(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 500.0, 1.0)


def scored(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = scorer(np.stack([features(v) for v in byte_views(batch.column("text"))])) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score, pa.float64()), pa.array(score >= 0.5).cast(pa.int32())],
                schema=schema)

    return arrow_map(docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string")),
                     run, "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """The rows of ``docs`` that score at least 0.5, columns as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(scorer(np.stack([features(v) for v in byte_views(batch.column("text"))])) >= 0.5))

    return arrow_map(docs, run, docs.schema)
