"""Helpers the corpus operators share: Arrow batch maps, checked lookups, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlens.session import drop_path, shared_folder, written

#: Bytes of a lookup table that may be broadcast; a larger one takes a shuffle join.
BROADCAST_BYTES = 32 << 20
#: Parts into which the rows of one key are dealt in a salted join.
SALTS = 32


_BASE = 0xD6E8FEB86659FD93
#: Longer words are hashed by themselves.
_LONG_WORD = 64


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2^64, as many as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 2 * n
            make = lambda x: np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, x, np.uint64))])
            self.up, self.down = make(_BASE), make(pow(_BASE, -1, 2**64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One scrambled number for each pair of numbers."""
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_BASE)
    return x ^ (x >> np.uint64(31))


def stretch_hashes(row: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of a row of bytes, or of hashes: differences of one sum of products."""
    up, down = _POWERS.of(len(row))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((row.astype(np.uint64) + np.uint64(1)) * up)])
    return joined((total[end] - total[begin]) * down[begin], (end - begin).astype(np.uint64))


def word_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of a row of bytes."""
    out = stretch_hashes(raw, begin, end)
    for k in np.flatnonzero(end - begin > _LONG_WORD):
        out[k] = xxhash.xxh3_64_intdigest(raw[begin[k] : end[k]].tobytes())
    return out


#: Rows of whole texts that travel to a Python task at a time, unless the session asks for fewer.
BATCH_ROWS = 1_000


def small_batches(df: DataFrame) -> DataFrame:
    """Keep Arrow batches of whole texts small in this session: a batch is held several times over on its way."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark = df.sparkSession
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return df


def map_batches(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """Apply ``make()`` once per task and its result to every Arrow batch of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return small_batches(df).mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The text column as Python strings; null becomes the empty text."""
    return [x or "" for x in batch.column(name).to_pylist()]


def table_bytes(df: DataFrame) -> int:
    """Rows times the row width of a written table; strings and arrays are measured."""
    wide = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    arrays = [F.coalesce(F.size(c), F.lit(0)) * 8 for c, kind in df.dtypes if kind.startswith("array")]
    width = sum(wide + arrays, F.lit(16 * len(df.columns)))
    return int(df.agg(F.sum(width.cast("long"))).first()[0] or 0)


def attach(df: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join ``df`` with a lookup table that has one row per key.

    The table must be cheap to read twice (written).  It is broadcast only if its
    measured size allows; else it is a shuffle join whose crowded partitions the
    engine splits (skew join).
    """
    if table_bytes(table) <= BROADCAST_BYTES:
        table = F.broadcast(table)
    return df.join(table, keys, how)


def set_aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rename columns that an operator would replace; the second value puts all columns of ``docs`` back."""
    new = {c: f"__aside_{i}" for i, c in enumerate(docs.columns) if c in names}

    def restore(out: DataFrame) -> DataFrame:
        return out.select(*(F.col(f"`{new.get(c, c)}`").alias(c) for c in docs.columns))

    return docs.withColumnsRenamed(new), restore


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Connected components of ``links(a long, b long)``: (node, comp), comp = the smallest node.

    Alternating large-star and small-star steps on (child, parent) links; every
    round is written to the shared folder and the loop ends when nothing changes.
    Nodes without links are not listed.
    """
    def kept(df: DataFrame) -> tuple[DataFrame, str]:
        path = shared_folder(spark, "links")
        df.write.option("compression", "none").parquet(path)  # two columns of numbers, dropped a round later
        return spark.read.parquet(path), path

    edges, path = kept(links.select("a", "b").where("a <> b").distinct())
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        # the minima are written: then the join has an exchange of its own, and the engine can split a hub's
        least, first = kept(both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m")))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("m").alias("b")), F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        after, new_path = kept(small)
        mark = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
        old, new = edges.select(*mark).first(), after.select(*mark).first()
        for done in (path, first):
            drop_path(spark, done)
        edges, path = after, new_path
        if tuple(old) == tuple(new):
            break
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("comp"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(roots)
