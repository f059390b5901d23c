"""Quality classifier: supervised subword embeddings with a softmax output.

A document's features are its words, the character n-grams of every word, its pairs of
neighbouring words, and a mark for each pair that the document has held before, hashed into
learned vectors.  The vectors are averaged over
the document and go through a softmax layer; both layers are trained by stochastic gradient
descent in numpy on a bounded sample of labelled rows.  A score needs one number per bucket
(the vector's product with the output layer), so the model that travels to the tasks has a
fixed size.  Whole texts are scored on the executors.

Defined results
---------------
* null, empty or word-free text: the score of the bias alone.
* labels: null qualities are ignored; a document with both labels is not learned from; a
  repeated doc_id counts once, with its smallest text.  Without labelled rows every score
  is 0.5; with labels of one class, that class's share decides.
* a null doc_id is never learned from and counts as held out.
* repeated rows are scored alike; further columns of the input are passed through; an empty
  table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.common import append_columns

FACTOR = np.uint64(0x100000001B3)
SCATTER = np.uint64(0x9E3779B97F4A7C15)
SEEN_PAIR = np.uint64(0x5EE9)


@dataclass(frozen=True)
class Config:
    """``max_docs`` and ``max_chars`` bound the sample that is learned from: labelled rows in the
    order of a hash of doc_id, until either is reached."""

    buckets_log2: int = 17
    dim: int = 8
    min_n: int = 3
    max_n: int = 5
    epochs: int = 6
    rate: float = 0.5
    seed: int = 7
    max_docs: int = 3000
    max_chars: int = 40_000_000


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR**i and its inverse modulo 2**64, for i below n."""
    base = np.full(n, FACTOR)
    base[:1] = 1
    back = np.full(n, pow(int(FACTOR), -1, 1 << 64), np.uint64)
    back[:1] = 1
    return np.multiply.accumulate(base), np.multiply.accumulate(back)


def feature_ids(text: str, cfg: Config, powers=_powers) -> np.ndarray:
    """The bucket of every feature of one text, repeated as often as it occurs.

    The words stand in one array of code points with single spaces around them, which mark the
    ends of words; an n-gram holds a space only as its first or last character.  All hashes are
    polynomials modulo 2**64.
    """
    words = text.split()
    if not words:
        return np.zeros(0, np.int64)
    code = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    space = code == 32
    up, down = powers(len(code))
    mixed = (code + np.uint64(1)) * SCATTER
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed * up)))
    bounds = np.flatnonzero(space)
    starts, ends = bounds[:-1] + 1, bounds[1:]
    word = (sums[ends] - sums[starts]) * down[starts]
    pair = word[:-1] * FACTOR + word[1:]
    _, first = np.unique(pair, return_index=True)
    found = [word, pair + np.uint64(1), np.full(len(pair) - len(first), SEEN_PAIR)]
    inner = np.zeros(len(code) + 1, np.int64)
    np.cumsum(space, out=inner[1:])
    for n in range(cfg.min_n, cfg.max_n + 1):
        at = np.arange(len(code) - n + 1)
        at = at[inner[at + n - 1] == inner[at + 1]]
        found.append((sums[at + n] - sums[at]) * down[at] + np.uint64(n + 1))
    every = np.concatenate(found) * SCATTER
    return (every >> np.uint64(64 - cfg.buckets_log2)).astype(np.int64)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, cfg: Config) -> tuple[np.ndarray, float]:
    """SGD over documents.  Returns each bucket's contribution to the log odds of label 1, and the bias."""
    n_buckets, rng = 1 << cfg.buckets_log2, np.random.default_rng(cfg.seed)
    vectors = rng.uniform(-1 / cfg.dim, 1 / cfg.dim, (n_buckets, cfg.dim)).astype(np.float32)
    out, bias = np.zeros((cfg.dim, 2), np.float32), np.zeros(2, np.float32)
    if len(rows):
        share = np.bincount(labels, minlength=2) + 1.0
        bias = np.log(share / share.sum()).astype(np.float32)
    steps, done = cfg.epochs * len(rows), 0
    for _ in range(cfg.epochs):
        for r in rng.permutation(len(rows)):
            rate = cfg.rate * (1 - done / steps)
            done += 1
            ids, weight = rows[r]
            mean = weight @ vectors[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            error = p / p.sum()
            error[labels[r]] -= 1
            back = out @ error
            out -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            # Averages over long texts move each vector little: step by the share of the largest one.
            vectors[ids] -= (rate / max(float(weight.max()), 1e-6)) * np.outer(weight, back)
    side = out[:, 1] - out[:, 0]
    return vectors @ side, float(bias[1] - bias[0])


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, cfg: Config) -> DataFrame:
    """(doc_id, text, quality): the bounded sample.  The ids (at most ``max_docs``) are broadcast, so
    documents are filtered where they are read."""
    labelled = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
                .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("__most"))
                .where((F.col("quality") == F.col("__most")) & F.col("quality").isin(0, 1))
                .drop("__most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(cfg.max_docs))
    sample = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
              .join(F.broadcast(labelled), "doc_id")
              .groupBy("doc_id", "quality").agg(F.min("text").alias("text")))
    # At most max_docs rows reach this window.
    so_far = F.sum(F.length("text")).over(Window.orderBy(F.xxhash64("doc_id"), "doc_id")
                                          .rowsBetween(Window.unboundedPreceding, -1))
    return sample.withColumn("__before", F.coalesce(so_far, F.lit(0))).where(F.col("__before") < cfg.max_chars).drop("__before")


def fit(docs: DataFrame, labels: DataFrame, cfg: Config = Config()) -> tuple[np.ndarray, float]:
    """The trained model, from features that the executors make of the sample."""
    def featurise():
        def compute(texts):
            for text in texts:
                found = feature_ids(text, cfg)
                ids, counts = np.unique(found, return_counts=True)
                yield ids.astype(np.int32).tobytes(), (counts / max(len(found), 1)).astype(np.float32).tobytes()
        return compute

    sample = append_columns(training_sample(docs, labels, cfg).repartition(16, "doc_id"),
                            {"ids": "binary", "weight": "binary"}, featurise)
    got = sorted(sample.select("doc_id", "quality", "ids", "weight").collect(), key=lambda r: r["doc_id"])
    rows = [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["weight"], np.float32)) for r in got if r["ids"]]
    return train(rows, np.array([r["quality"] for r in got if r["ids"]], np.int64), cfg)


def scorer(gain: np.ndarray, bias: float, cfg: Config):
    """A function from texts to log odds."""
    def compute(texts):
        tables = _powers(0)

        def powers(n: int):
            nonlocal tables
            if n > len(tables[0]):
                tables = _powers(n)
            return tables[0][:n], tables[1][:n]

        for text in texts:
            ids = feature_ids(text, cfg, powers)
            yield ((float(gain[ids].mean()) if len(ids) else 0.0) + bias,)
    return compute


def score_quality(docs: DataFrame, labels: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Every row of ``docs`` with held_out, score (probability of label 1) and predicted."""
    gain, bias = fit(docs, labels, cfg)
    gain = gain.astype(np.float64)
    out = append_columns(docs, {"log_odds": "double"}, lambda: scorer(gain, bias, cfg))
    score = 1 / (1 + F.exp(-F.col("log_odds")))
    return (out.withColumn("held_out", held_out()).withColumn("score", score)
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")).drop("log_odds"))
