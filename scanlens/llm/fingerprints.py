"""Order MinHash fingerprints, sensitive to edit distance.

A text is a row of k-mers of short tokens, each k-mer numbered by its occurrence.  For
each of the sketches, the ``KEPT`` k-mers with the smallest hashes are taken, put back
in text order and hashed as a tuple.  Two texts agree in a sketch only if they share the
same k-mers in the same order, so likeness falls with insertions, losses and moves.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens: runs without white space, cut every eight characters so that no edit reaches far.
TOKEN = re.compile(r"\S{1,8}")
K = 3
KEPT = 2
SKETCHES = 64
#: K-mers hashed at a time; bounds the memory of a long text.
BLOCK = 512
#: Tokens whose hashes a task remembers before it starts afresh.
TOKEN_CACHE = 300_000

_draw = np.random.default_rng(42)
_XOR = _draw.integers(0, 2**64, SKETCHES, np.uint64)[:, None]
_MUL = (_draw.integers(0, 2**64, SKETCHES, np.uint64) | np.uint64(1))[:, None]
_ROWS, _LARGEST = np.arange(SKETCHES)[:, None], np.uint64(2**64 - 1)
_ROOM = np.empty((SKETCHES, BLOCK), np.uint64)
_PLACE = _draw.integers(0, 2**64, K + KEPT, np.uint64) | np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _Hashes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= TOKEN_CACHE:
            self.clear()
        h = self[token] = xxhash.xxh3_64_intdigest(token) - 2**63
        return h


def kmers(text: str, hashes: dict[str, int] | None = None) -> np.ndarray:
    """Hashes of the k-mers in text order; a text with fewer tokens is one k-mer."""
    found = TOKEN.findall(text)
    if not found:
        return np.array([xxhash.xxh3_64_intdigest(text)], np.uint64)
    hashes = _Hashes() if hashes is None else hashes
    tokens = np.fromiter(map(hashes.__getitem__, found), np.int64, len(found)).view(np.uint64)
    n = min(K, len(tokens))
    row = np.zeros(len(tokens) - n + 1, np.uint64)
    for j in range(n):
        row += tokens[j : len(row) + j] * _PLACE[j]
    return _mix(row + np.uint64(n))


def numbered(row: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how many times it came before)."""
    order = np.argsort(row, kind="stable")
    ordered = row[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    starts = np.flatnonzero(new)
    count = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
    out = np.empty_like(row)
    out[order] = _mix(ordered + count.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return out


def _least(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values of the ``KEPT`` smallest of each row (all if there are no more); ``h`` is used up."""
    if h.shape[1] <= KEPT:
        return np.tile(np.arange(h.shape[1]), (SKETCHES, 1)), h.copy()
    found, least = [], []
    for _ in range(KEPT):
        at = h.argmin(1)[:, None]
        found.append(at)
        least.append(h[_ROWS, at])
        h[_ROWS, at] = _LARGEST
    return np.hstack(found), np.hstack(least)


def signature(text: str, hashes: dict[str, int] | None = None) -> np.ndarray:
    """The sketches of a text as 32-bit numbers; equal texts have equal signatures."""
    row = kmers(text, hashes)
    base = numbered(row)
    if len(row) <= KEPT:
        chosen = np.tile(np.arange(len(row)), (SKETCHES, 1))
    else:
        values, places = np.empty((SKETCHES, 0), np.uint64), np.empty((SKETCHES, 0), np.int64)
        for s in range(0, len(row), BLOCK):
            part = base[s : s + BLOCK]
            h = _ROOM[:, : len(part)]
            np.bitwise_xor(part, _XOR, out=h)
            np.multiply(h, _MUL, out=h)
            some, least = _least(h)
            values, places = np.hstack([values, least]), np.hstack([places, some + s])
            if s:
                some, values = _least(values)
                places = places[_ROWS, some]
        chosen = np.sort(places, axis=1)
    out = np.zeros(SKETCHES, np.uint64)
    for j in range(chosen.shape[1]):
        out = _mix(out + row[chosen[:, j]] * _PLACE[K + j])
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of sketches in which two signatures agree."""
    return float(np.mean(a == b))


def _hex(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_chars, fingerprint (eight hex digits per sketch).  Null text: empty."""
    docs = docs.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            own = [t or "" for t in b.column(text).to_pylist()]
            prints = [_hex(signature(t, hashes)) for t in own]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(map(len, own), pa.int64()), pa.array(prints, pa.string())], names=[key, "n_chars", "fingerprint"])

    return docs.mapInArrow(run, f"`{key}` {docs.dtypes[0][1]}, n_chars long, fingerprint string")


def _neighbourly(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows in descending key order, cut into ranges; each range ends with the first row of the next.

    Cut points come from approximate quantiles of the key, first rows from one narrow
    aggregate with a row for each range.  The texts move once.
    """
    spark = docs.sparkSession
    rank = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), rank.alias("rank")).withColumn("tie", F.xxhash64("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [(i + 1) / n for i in range(n - 1)]
    cuts = rows.select(F.percentile_approx("rank", shares, max(10_000, 20 * n))).first()[0] if shares else []
    bounds = [float("-inf"), *sorted({float(c) for c in cuts or []}), float("inf")]
    ranges = len(bounds) - 1
    if ranges > 1:
        rows = Bucketizer(splits=bounds, inputCol="place", outputCol="bucket").transform(rows.withColumn("place", F.col("rank").cast("double")))
    else:
        rows = rows.withColumn("bucket", F.lit(0))
    part = rows.select("key", "text", "rank", "tie", (F.lit(ranges - 1) - F.col("bucket")).cast("int").alias("part"))
    heads = part.groupBy("part").agg(F.max(F.struct(F.col("rank"), F.bitwise_not("tie").alias("tie"))).alias("h")).orderBy("part").collect()
    before = [(r.h.rank, ~r.h.tie, heads[i - 1].part) for i, r in enumerate(heads)]  # the first row of all ends the last range
    ends = spark.createDataFrame(before, "rank long, tie long, before int")
    both = part.join(F.broadcast(ends), ["rank", "tie"], "left")
    copies = F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("ghost")), F.struct(F.col("before").alias("part"), F.lit(True).alias("ghost")))
    both = both.select("key", "text", "rank", "tie", F.explode(copies).alias("c")).select("key", "text", "rank", "tie", "c.part", "c.ghost").where("part is not null")
    return both.repartitionById(ranges, "part").sortWithinPartitions("part", "ghost", F.desc("rank"), "tie").select("part", "ghost", "key", "text")


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likenesses.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next document in descending key order; after the last comes the
    first.  One row per input row: key, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  Null text: empty.  A null key comes
    after all others; rows of one key are ordered by a hash of their text.  A single
    row is its own next.
    """
    rows = _neighbourly(docs, key, text)
    kind = docs.select(key).dtypes[0][1]
    names = [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        held = None  # the row that waits for its next
        for b in batches:
            keys, out = [], []
            for i, (part, ghost, own) in enumerate(zip(*(b.column(c).to_pylist() for c in ("part", "ghost", "text")), strict=True)):
                if held is not None and held[0] == part:
                    sig = held[3] if own == held[2] else signature(own, hashes)
                    keys.append(held[1])
                    out.append(_compared(held[2], held[3], own, sig, hashes))
                    held = None if ghost else (part, b.column("key").slice(i, 1), own, sig)
                elif not ghost:
                    held = (part, b.column("key").slice(i, 1), own, signature(own, hashes))
                else:
                    held = None
            if out:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(keys), *(pa.array(c) for c in zip(*out, strict=True))], names=names)

    return rows.mapInArrow(run, f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _compared(own: str, sig: np.ndarray, following: str, next_sig: np.ndarray, hashes: dict[str, int]) -> tuple:
    half = len(own) // 2
    edited = own[: len(own) - half] + following[:half]
    other = sig if edited == own else signature(edited, hashes)
    return len(own), hashlib.sha256(edited.encode()).hexdigest(), _hex(sig), _hex(other), likeness(sig, other), likeness(sig, next_sig)
