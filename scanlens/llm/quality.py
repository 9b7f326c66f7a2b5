"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Shards of a bounded sample of labelled rows are trained in parallel; after every pass
their states are averaged, and the next pass starts from the mean.  A score is a sparse dot product.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlens.session import written

#: Weights; n-grams are hashed to them.  Weight 0 is the bias.
WEIGHTS = 1 << 18
#: Labelled rows that training draws, about (by hash).
FIT_ROWS = 20_000
#: Rows of one training shard, about, and passes with an exchange of the state after each.
SHARD_ROWS, ROUNDS = 4_000, 4
#: Step size, smoothing, L1 and L2 strength of the updates.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.3, 0.1
#: A document is predicted good from this score on.
GOOD = 0.7
#: Tokens: words as written, and runs of other marks.
TOKEN = re.compile(r"\w+|[^\w\s]+")
TOKEN_CACHE = 300_000


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= TOKEN_CACHE:
            self.clear()
        h = self[token] = xxhash.xxh3_64_intdigest(token) - 2**63
        return h


def features(text: str, hashes: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams and their values: words, pairs, and shapes of pairs (same word again, marks, capitals).

    Values are square roots of counts, scaled to length 1; the bias has value 1.
    """
    found = TOKEN.findall(text)
    if not found:
        return np.zeros(1, np.int64), np.ones(1)
    t = np.fromiter(map(hashes.__getitem__, found), np.int64, len(found)).view(np.uint64)
    pair = t[:-1] * np.uint64(0x9E3779B97F4A7C15) + t[1:]
    same = np.where(t[:-1] == t[1:], np.uint64(0x1234567), np.uint64(0x7654321))
    shape = _shape(found)
    both = shape[:-1] * np.uint64(31) + shape[1:] + np.uint64(0xABCDEF)
    h = np.concatenate([t, pair, same, both])
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x, n = np.unique((h >> np.uint64(46)).astype(np.int64) | 1, return_counts=True)
    return np.append(x, 0), np.append(np.sqrt(n / n.sum()), 1.0)


def _shape(found: list[str]) -> np.ndarray:
    """Kind of each token: 0 lower, 1 capitalised, 2 capitals, 3 marks."""
    return np.fromiter((3 if not (c := w[0]).isalnum() else 2 if len(w) > 1 and w.isupper() else int(c.isupper()) for w in found), np.uint64, len(found))


def held_out(key: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 2 modulo 4; their labels are never read."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _train(rows: list[tuple[np.ndarray, np.ndarray, float]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass of follow-the-regularised-leader over ``(features, values, label)``; changes the state ``z, n``."""
    for x, v, y in rows:
        zx, nx = z[x], n[x]
        w = _weights(zx, nx)
        p = 1 / (1 + np.exp(-np.clip(w @ v, -35, 35)))
        g = (p - y) * v
        s = (np.sqrt(nx + g * g) - np.sqrt(nx)) / ALPHA
        z[x] += g - s * w
        n[x] += g * g


def _learner(held):
    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("order")
        z, n = (x.copy() for x in held.value)
        _train(list(zip(map(np.asarray, pdf["x"]), map(np.asarray, pdf["v"]), pdf["y"], strict=True)), z, n)
        used = np.flatnonzero(n)
        return pd.DataFrame({"i": used, "z": z[used], "n": n[used]})

    return learn


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> np.ndarray:
    """Weights learned from about ``rows`` labelled documents that are not held out.

    Labels with a null id or value are ignored; of several labels of one id the largest
    counts.  Without labels all weights are 0.
    """
    spark = docs.sparkSession
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    share = min(1.0, rows / max(1, usable.count()))
    drawn = usable.where(F.pmod(F.xxhash64(F.lit(5), F.col(key)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    drawn = drawn.groupBy(key).agg(F.max(label).cast("double").alias("__y"))
    # the sample is bounded by ``rows``, so it may be broadcast
    known = docs.select(key, F.col(text).alias("__text")).join(F.broadcast(drawn), key).select(key, "__text", "__y")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            x, v = zip(*(features(t or "", hashes) for t in b.column("__text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.int32())), pa.array(v, pa.list_(pa.float32())), b.column("__y"), b.column("order")], names=["x", "v", "y", "order"])

    order = F.xxhash64(F.lit(9), F.col(key))
    made = written(known.withColumn("order", order).mapInArrow(extract, "x array<int>, v array<float>, y double, order long"), "features")
    shards = max(1, round(made.count() / SHARD_ROWS))
    made = made.withColumn("shard", F.pmod("order", F.lit(shards)))
    z, n = np.zeros(WEIGHTS), np.zeros(WEIGHTS)
    for _ in range(ROUNDS):
        learner = _learner(spark.sparkContext.broadcast((z, n)))
        state = made.groupBy("shard").applyInPandas(learner, "i int, z double, n double")
        mean = state.groupBy("i").agg(*((F.sum(c) / shards).alias(c) for c in ("z", "n"))).toPandas()
        z, n = np.zeros(WEIGHTS), np.zeros(WEIGHTS)
        z[mean["i"].to_numpy()], n[mean["i"].to_numpy()] = mean["z"].to_numpy(), mean["n"].to_numpy()
    return _weights(z, n)


def score_documents(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, held_out, score, predicted.  A null text is scored as the empty one."""
    held = docs.sparkSession.sparkContext.broadcast(weights)
    docs = docs.select(key, text, held_out(F.col(key)).alias("held_out"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            dots = np.array([_dot(features(t or "", hashes), held.value) for t in b.column(text).to_pylist()], np.float64)
            score = 1 / (1 + np.exp(-np.clip(dots, -35, 35)))
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("held_out"), pa.array(score)], names=[key, "held_out", "score"])

    scored = docs.mapInArrow(run, f"`{key}` {docs.dtypes[0][1]}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


def _dot(sparse: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> float:
    return float(weights[sparse[0]] @ sparse[1])
