"""Sharding by histogram sort: shards of near-equal bytes in one total order of keys.

The bytes below candidate key boundaries are counted exactly over all partitions and
the candidates refined until every splitter meets the tolerance.  The rows then move
once.  Every shard is cut into many pieces by further splitters of the same search, so
no task holds a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scanlens.session import written

SHARDS = 16
#: A splitter is good if it misses its target by at most this share of a piece.
TOLERANCE = 0.01
#: Candidates tried inside the interval of each open splitter in one round.
PROBES = 16
#: Pieces over all shards for each shuffle partition.
PIECES = 4


def keyed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Narrow rows ``(id, size, crc, order)``.

    ``order`` is a 63-bit key: 40 bits of a text hash, then 23 bits of an id hash.  Equal
    texts are neighbours, yet a group of copies of any size can be cut.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    high = F.shiftleft(F.xxhash64(body).bitwiseAND(F.lit((1 << 40) - 1)), 23)
    low = F.xxhash64(F.lit(7), F.col(key)).bitwiseAND(F.lit((1 << 23) - 1))
    return docs.select(F.col(key).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("crc"), high.bitwiseOR(low).alias("order"))


def below(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with ``order < probe`` for each of the sorted probes.

    Every task counts its rows into the gaps between probes; what reaches the driver
    is one row for each gap.
    """
    held = rows.sparkSession.sparkContext.broadcast(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, n = (np.zeros(len(held.value) + 1, np.int64) for _ in range(2))
        for b in batches:
            gap = np.searchsorted(held.value, b.column("order").to_numpy(), side="right")
            np.add.at(size, gap, b.column("size").to_numpy())
            n += np.bincount(gap, minlength=len(n))
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(size[used]), pa.array(n[used])], names=["gap", "size", "n"])

    gaps = rows.select("order", "size").mapInArrow(count, "gap long, size long, n long")
    size, n = (np.zeros(len(probes) + 1, np.int64) for _ in range(2))
    for r in gaps.groupBy("gap").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect():
        size[r.gap], n[r.gap] = r["size"], r.n
    return np.cumsum(size)[:-1], np.cumsum(n)[:-1]


def splitters(rows: DataFrame, pieces: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries of ``pieces`` pieces of near-equal bytes, and the exact number of rows below each.

    A boundary moves until its bytes are within ``tolerance`` of a piece of its target,
    or its interval holds one key, whose rows cannot be told apart.
    """
    total = int(rows.agg(F.sum("size")).first()[0] or 0)
    goal = np.array([total * (i + 1) // pieces for i in range(pieces - 1)], np.int64)
    low, high = np.zeros(len(goal), np.int64), np.full(len(goal), np.iinfo(np.int64).max)
    low_size, high_size = np.zeros(len(goal), np.int64), np.full(len(goal), total, np.int64)
    best, miss, rank = high.copy(), np.full(len(goal), total + 1, np.int64), np.zeros(len(goal), np.int64)
    open_ = np.arange(len(goal))
    while len(open_):
        tried = {i: _probes(int(low[i]), int(high[i]), (goal[i] - low_size[i]) / max(1, high_size[i] - low_size[i]), probes) for i in open_}
        every = np.array(sorted({p for t in tried.values() for p in t}), np.int64)
        if not len(every):
            break
        size, n = below(rows, every)
        for i in open_:
            for p in tried[i]:
                k = np.searchsorted(every, p)
                gap = abs(int(size[k] - goal[i]))
                if gap < miss[i]:
                    best[i], miss[i], rank[i] = p, gap, n[k]
                if size[k] <= goal[i] and p > low[i]:
                    low[i], low_size[i] = p, size[k]
                if size[k] > goal[i] and p < high[i]:
                    high[i], high_size[i] = p, size[k]
        open_ = np.array([i for i in open_ if miss[i] > tolerance * total / pieces and high[i] - low[i] > 1], np.int64)
    return best, rank


def _probes(low: int, high: int, share: float, n: int) -> list[int]:
    """Candidates inside (low, high): close about the interpolated place, and evenly spread."""
    wide = high - low
    guess = low + int(wide * min(1.0, max(0.0, float(share))))
    near = [guess + int(d * wide) for d in (-2**-6, -2**-9, 0, 2**-9, 2**-6)]
    even = [low + wide * (j + 1) // (n + 1) for j in range(n)]
    return [p for p in (*near, *even) if low < p < high]


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: sizes (UTF-8 bytes plus 1; a null text has none) of the shards
    are near equal, off by ``TOLERANCE`` of a piece or one row at most.  Rows are in the
    order of their text hash, so equal texts are neighbours; a group of copies larger
    than a shard goes over several.  ``slot`` counts from 0 within the shard without
    gaps.  Equal rows (same id and text) take neighbouring slots.  A null id is a value
    like any other.  An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    rows = written(keyed(docs, key, text), "shards")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, -(-PIECES * partitions // shards))
    cuts, rank = splitters(rows, shards * each)
    order = np.argsort(cuts, kind="stable")
    cuts, rank = cuts[order], rank[order]
    held = spark.sparkContext.broadcast(cuts)
    start = np.concatenate([[0], rank])
    first = start[::each]
    table = spark.createDataFrame([(i, i // each, int(start[i] - first[i // each])) for i in range(shards * each)], "piece int, shard int, base long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            piece = np.searchsorted(held.value, b.column("order").to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(piece, pa.int32())], names=[*b.schema.names, "piece"])

    fields = ", ".join(f"`{c}` {k}" for c, k in rows.dtypes)
    placed = rows.mapInArrow(place, f"{fields}, piece int")
    slot = F.row_number().over(Window.partitionBy("piece").orderBy("order", "id"))
    return placed.withColumn("within", slot - 1).join(F.broadcast(table), "piece").select(
        F.col("id").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("within")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
