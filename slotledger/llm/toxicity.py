"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms (words and beginnings of words), hashed into buckets. The score is a logistic function of a bias, a weight for each bucket
and, for each pair of buckets, the product of their factor vectors: what two terms mean together is learned even where
neither says much alone, if both are among the PAIR_BUCKETS most frequent. The model is fitted on a bounded sample of labelled rows; every document is scored on its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import mix, pieces, stored, word_hashes

BITS = 18
#: Besides whole words, their beginnings of so many bytes are terms: inflected and compound forms share them.
PREFIXES = (4, 5, 6)
FACTORS = 8
#: Labelled documents of either class that the model is fitted on, at most: the first by a hash of their id.
SAMPLE_PER_CLASS = 8000
#: A bucket that fewer documents of the sample have is left out of the model.
MIN_DOCS = 3
#: A bucket stays in the model if the classes' shares of it lie so many standard errors apart; without this the many chance
#: differences of rare terms would outweigh the few terms that matter, all the more in long documents.
MIN_Z = 4.0
#: A bucket that only toxic documents of the sample have, so many at least, stays at any size of the sample.
PURE_DOCS = 8
#: Buckets that say nothing alone stay if a pair of them, among so many of the most frequent ones, has another share of toxic
#: documents than its two buckets lead to expect, by so many standard errors (there are millions of pairs).
PAIR_BUCKETS, PAIR_Z = 2048, 7.0
EPOCHS = 8
RATE, FACTOR_RATE = 0.05, 0.02
DECAY = 1e-3
SEED = 23
THRESHOLD = 0.3
FOLDS, OUT = 4, 2
_GAP = np.ones(256, dtype=bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def term_buckets(texts: pa.Array, bits: int = BITS) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, distinct sorted buckets of each row) in runs; A-Z lowered."""
    for first, _, raw, limits in pieces(texts):
        words, at, *cut = word_hashes(raw, limits, lower=True, gap=_GAP, prefixes=PREFIXES)
        names = [words, *(mix(c + np.uint64(k)) for k, c in zip(PREFIXES, cut))]
        buckets = (np.stack(names, axis=1) >> np.uint64(64 - bits)).astype(np.int32)
        yield first, [np.unique(buckets[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray  # [bucket]
    factors: np.ndarray  # [bucket, factor]

    def raw(self, buckets: np.ndarray) -> float:
        v = self.factors[buckets]
        total = v.sum(axis=0)
        return float(self.bias + self.weights[buckets].sum() + 0.5 * (total @ total - np.einsum("ij,ij->", v, v)))

    def score(self, buckets: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(buckets), -40, 40))))


def _telling(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Which buckets at least MIN_DOCS documents have, and the two classes to clearly different shares or only the toxic ones."""
    if not rows:
        return np.zeros(size, dtype=bool)
    docs = np.bincount(np.concatenate(rows), minlength=size)
    toxic = np.bincount(np.concatenate([r for r, y in zip(rows, labels) if y == 1] or [np.zeros(0, dtype=np.int64)]), minlength=size)
    share = labels.sum() / len(rows)
    error = np.sqrt(np.maximum(docs * share * (1 - share) * (1 - docs / len(rows)), 1e-12))
    return (docs >= MIN_DOCS) & ((np.abs(toxic - docs * share) >= MIN_Z * error) | ((docs >= PURE_DOCS) & (toxic == docs) & (share < 1)))


def _in_telling_pair(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Which of the most frequent buckets take part in a pair that says more than its two buckets say alone."""
    found = np.zeros(size, dtype=bool)
    docs = np.bincount(np.concatenate(rows), minlength=size) if rows else np.zeros(size, dtype=np.int64)
    often = np.argsort(-docs, kind="stable")[:PAIR_BUCKETS]
    often = often[(docs[often] >= MIN_DOCS) & (docs[often] < len(rows))]
    share = labels.mean() if rows else 0.0
    if len(often) < 2 or not 0 < share < 1:
        return found
    place = np.full(size, -1)
    place[often] = np.arange(len(often))
    both, toxic = np.zeros((2, len(often), len(often)), dtype=np.float32)
    for start in range(0, len(rows), 2000):
        part = rows[start : start + 2000]
        has = np.zeros((len(part), len(often)), dtype=np.float32)
        for i, r in enumerate(part):
            at = place[r]
            has[i, at[at >= 0]] = 1
        both += has.T @ has
        marked = has[labels[start : start + 2000] == 1]
        toxic += marked.T @ marked
    n, t = np.diag(both), np.diag(toxic)
    alone = (t + share) / (n + 1)
    odds = alone / (1 - alone)
    for i, bucket in enumerate(often):
        expected = odds[i] * odds * (1 - share) / share
        expected = np.clip(expected / (1 + expected), 1e-3, 1 - 1e-3)
        away = np.abs(toxic[i] - both[i] * expected) >= PAIR_Z * np.sqrt(np.maximum(both[i], 1) * expected * (1 - expected))
        # a bucket that comes only with the other one makes no pair with it
        away &= (both[i] >= MIN_DOCS) & (both[i] < 0.8 * np.minimum(n[i], n))
        found[bucket] = away.any()
    return found


def fit(rows: list[np.ndarray], labels: np.ndarray, importance: np.ndarray, bits: int = BITS, factors: int = FACTORS, epochs: int = EPOCHS) -> Model:
    """Logistic loss by stochastic steps with a rate of its own for each parameter; deterministic."""
    rng = np.random.default_rng(SEED)
    size = 1 << bits
    seen = _telling(rows, labels, size) | _in_telling_pair(rows, labels, size)
    rows = [r[seen[r]] for r in rows]
    bias, weights = 0.0, np.zeros(size)
    vectors = np.where(seen[:, None], rng.normal(0, 0.01, (size, factors)), 0.0)
    past_b, past_w, past_v = 1e-8, np.full(size, 1e-8), np.full((size, factors), 1e-8)
    if len(rows):
        rate = float((labels * importance).sum() / importance.sum())
        bias = float(np.log(max(rate, 1e-6) / max(1 - rate, 1e-6)))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), 128):
            take = order[start : start + 128]
            n = np.array([len(rows[i]) for i in take])
            at = np.concatenate([rows[i] for i in take]).astype(np.int64)
            of = np.repeat(np.arange(len(take)), n)
            v = vectors[at]
            total = np.stack([np.bincount(of, v[:, k], len(take)) for k in range(factors)], axis=1)
            squares = np.bincount(of, (v * v).sum(axis=1), len(take))
            raw = bias + np.bincount(of, weights[at], len(take)) + 0.5 * ((total * total).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[take]) * importance[take]
            past_b += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(past_b)
            used, back = np.unique(at, return_inverse=True)
            gw = np.bincount(back, error[of], len(used)) + DECAY * weights[used]
            gv = np.stack([np.bincount(back, error[of] * (total[of, k] - v[:, k]), len(used)) for k in range(factors)], axis=1) + DECAY * vectors[used]
            past_w[used] += gw * gw
            past_v[used] += gv * gv
            weights[used] -= RATE * gw / np.sqrt(past_w[used])
            vectors[used] -= FACTOR_RATE * gv / np.sqrt(past_v[used])
    return Model(bias, weights, vectors)


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, found in term_buckets(batch.column("text")):
            limits = np.concatenate([[0], np.cumsum([len(b) for b in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(limits), pa.array(np.concatenate(found)))
            rows = [batch.column(c).slice(first, len(found)) for c in ("doc_id", "toxic")]
            yield pa.RecordBatch.from_arrays([*rows, lists], names=["doc_id", "toxic", "buckets"])


def _fit_rows(shares: dict[int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, rows = [], [], []
        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            labels += batch.column("toxic").to_pylist()
            rows += [np.array(b, dtype=np.int64) for b in batch.column("buckets").to_pylist()]
        order = sorted(range(len(ids)), key=ids.__getitem__)
        y = np.array([labels[i] for i in order], dtype=float)
        model = fit([rows[i] for i in order], y, np.array([shares[labels[i]] for i in order]))
        used = np.flatnonzero((model.weights != 0) | (model.factors != 0).any(axis=1))
        yield pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(np.append(used, -1).astype(np.int32)),
                "weight": pa.array(np.append(model.weights[used], model.bias)),
                "factors": pa.array([*model.factors[used].tolist(), [0.0] * FACTORS], pa.list_(pa.float64())),
            }
        )

    return run


def held_out() -> Column:
    """True for the rows whose labels are not learned from; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == OUT


def learn(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """A model from `labels` (doc_id, toxic) of documents that are not held out.

    Labels other than 0 and 1 and null ids are passed over; a document with both labels is toxic. The sample is at most
    `per_class` documents of either class, weighed back to the shares of the classes among all labels. It is fitted in one
    task; the model has at most 2**BITS rows. Without labels every score is one half.
    """
    known = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = stored(known.filter(~held_out()), "labels")
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picks = [known.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(per_class) for c in (0, 1)]
    sample = picks[0].unionByName(picks[1])  # at most 2 * per_class rows
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").mapInArrow(_bucket_rows, "doc_id long, toxic int, buckets array<int>")
    rows = stored(rows.groupBy("doc_id", "toxic").agg(F.min("buckets").alias("buckets")), "toxic-sample")
    taken = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not taken:
        return Model(0.0, np.zeros(1 << BITS), np.zeros((1 << BITS, FACTORS)))
    scale = sum(totals.values()) / sum(taken.values())
    shares = {c: totals[c] / taken[c] / scale for c in taken}
    model = stored(rows.coalesce(1).mapInArrow(_fit_rows(shares), "bucket int, weight double, factors array<double>"), "model")
    bias, weights, vectors = 0.0, np.zeros(1 << BITS), np.zeros((1 << BITS, FACTORS))
    for r in model.collect():
        if r.bucket < 0:
            bias = r.weight
        else:
            weights[r.bucket], vectors[r.bucket] = r.weight, r.factors
    return Model(bias, weights, vectors)


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted. Null or empty text has no terms and gets the bias alone.

    Repeated rows get equal scores; other columns are not looked at; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        found = shared.value
        return pa.array([found.score(b) for _, rows in term_buckets(texts) for b in rows], pa.float64())

    out = docs.select("doc_id", held_out().alias("held_out"), scores(F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
