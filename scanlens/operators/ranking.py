"""Exact ranks and exact samples without sorting a whole group in one task.

The hash order is uniform, so its leading digits cut every stratum into equal
buckets: counts per bucket give each bucket's offset, and rows are numbered only
within their bucket.  The value order is cut at quantile splits of the order
column; rows tied on a split value are cut again by their hash digits.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlens.constants import SEED
from scanlens.functions.hashing import row_hash
from scanlens.limits import DRIVER_ROWS, IN_MEMORY_ROWS

_DIGITS = 4  # 65,536 buckets per stratum
_LEVEL = 1_024  # buckets of one level of splits; two levels give about a million


def _hash_bucket(key: str, seed: int) -> tuple[Column, Column]:
    digest = row_hash(F.col(key), seed)
    return digest, F.substring(digest, 1, _DIGITS)


def rank_by_hash(df: DataFrame, stratum: str, key: str = "flow_id", seed: int = SEED) -> DataFrame:
    """Add ``hash_rank``: 0-based rank of the row within its stratum in hash order.

    Rows without a stratum are left out.
    """
    digest, bucket = _hash_bucket(key, seed)
    keyed = df.where(F.col(stratum).isNotNull()).withColumns({"_hash": digest, "_bucket": bucket})
    before = Window.partitionBy(stratum).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(stratum, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(stratum, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    within = Window.partitionBy(stratum, "_bucket").orderBy("_hash", key)
    numbered = keyed.withColumn("_row", F.row_number().over(within))
    return (
        numbered.join(offsets, [stratum, "_bucket"])
        .withColumn("hash_rank", F.col("_offset") + F.col("_row") - 1)
        .drop("_hash", "_bucket", "_offset", "_row")
    )


def mark_smallest_hashes(
    df: DataFrame,
    stratum: str,
    wanted,
    key: str = "flow_id",
    seed: int = SEED,
    flag: str = "chosen",
) -> DataFrame:
    """Flag exactly ``wanted(sizes)[stratum]`` rows per stratum, those first in hash order.

    ``sizes`` maps every stratum to its row count.  Two narrow passes over stratum
    and key find the last chosen hash per stratum; the flag itself is then a
    comparison inside the scan, without a shuffle.
    """
    digest, bucket = _hash_bucket(key, seed)
    keyed = df.select(stratum, key, digest.alias("_hash"), bucket.alias("_bucket"))
    counts = keyed.groupBy(stratum, "_bucket").agg(F.count(F.lit(1)).alias("_n")).persist()
    totals = counts.groupBy(stratum).agg(F.sum("_n").alias("n")).limit(DRIVER_ROWS + 1).collect()
    if len(totals) > DRIVER_ROWS:
        raise ValueError(f"{stratum} has more than {DRIVER_ROWS} strata")
    sizes = {row[stratum]: row["n"] for row in totals}
    numbers = {s: min(n, sizes.get(s, 0)) for s, n in wanted(sizes).items()}

    reached = F.sum("_n").over(
        Window.partitionBy(stratum).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    )
    targets = _attached(counts, stratum, numbers.items(), "_target bigint")
    cut_buckets = (
        targets.withColumn("_reached", reached)
        .where((F.col("_reached") >= F.col("_target")) & (F.col("_reached") - F.col("_n") < F.col("_target")))
        .select(stratum, "_bucket", (F.col("_target") - F.col("_reached") + F.col("_n")).alias("take"))
        .collect()  # one row per stratum
    )
    counts.unpersist()
    if not cut_buckets:
        return df.withColumn(flag, F.lit(False))
    position = F.row_number().over(Window.partitionBy(stratum).orderBy("_hash", key))
    cuts = ((r[stratum], r["_bucket"], r["take"]) for r in cut_buckets)
    last_rows = (
        _attached(keyed, stratum, cuts, "_cut_bucket string, _take bigint")
        .where(F.col("_bucket") == F.col("_cut_bucket"))
        .withColumn("_position", position)
        .where(F.col("_position") == F.col("_take"))
        .select(stratum, "_hash", F.col(key).cast("string").alias("_key"))
        .collect()  # one row per stratum
    )
    lasts = ((r[stratum], r["_hash"], r["_key"]) for r in last_rows)
    marked = _attached(df, stratum, lasts, "_last_hash string, _last_key string")
    last_key = F.col("_last_key").cast(df.schema[key].dataType)
    chosen = (digest < F.col("_last_hash")) | ((digest == F.col("_last_hash")) & (F.col(key) <= last_key))
    return marked.withColumn(flag, F.coalesce(chosen, F.lit(False))).drop("_last_hash", "_last_key")


def _attached(df: DataFrame, stratum: str, rows, fields: str) -> DataFrame:
    """Left join with values per stratum, a NULL stratum included; at most ``DRIVER_ROWS`` rows, so a broadcast."""
    kind = df.schema[stratum].dataType.simpleString()
    table = df.sparkSession.createDataFrame(list(rows), f"_stratum {kind}, {fields}")
    return df.join(F.broadcast(table), F.col(stratum).eqNullSafe(F.col("_stratum")), "left").drop("_stratum")


def split_points(df: DataFrame, column: str, rows: int, rows_per_bucket: int) -> list[float]:
    """Inner split values of ``column`` that give about ``rows_per_bucket`` rows each."""
    buckets = max(math.ceil(rows / rows_per_bucket), 1)
    if buckets == 1:
        return []
    coarse = min(buckets, _LEVEL)
    shares = [i / coarse for i in range(1, coarse)]
    present = df.select(column).where(F.col(column).isNotNull())
    found = present.approxQuantile(column, shares, 0.2 / coarse)
    splits = sorted({v for v in found if math.isfinite(v)})  # infinite values order rightly in the outer buckets
    if buckets > coarse:
        # a second level: every bucket is cut again by the same method, all of them in one aggregate
        fine = min(math.ceil(buckets / coarse), _LEVEL)
        cuts = F.percentile_approx(column, [i / fine for i in range(1, fine)], max(10_000, 10 * fine))
        inner = bucket_by_splits(present, column, splits, "_bucket").groupBy("_bucket").agg(cuts.alias("cuts")).collect()
        splits = sorted({*splits, *(v for r in inner for v in r["cuts"] if math.isfinite(v))})
    return splits


def bucket_by_splits(df: DataFrame, column: str, splits: list[float], output: str) -> DataFrame:
    """Bucket number of each value; monotone, so bucket order is value order."""
    edges = [-math.inf] + splits + [math.inf]
    if len(edges) < 3:
        return df.withColumn(output, F.lit(0))
    model = Bucketizer(splits=edges, inputCol=column, outputCol=output, handleInvalid="keep")
    return model.transform(df).withColumn(output, F.col(output).cast("int"))


def rank_within(
    df: DataFrame,
    group: str,
    order: str,
    key: str = "flow_id",
    rows_per_bucket: int = IN_MEMORY_ROWS,
) -> DataFrame:
    """Add ``row_rank`` (0-based) and ``group_rows``: rank by (order, hash of key, key) in the group.

    A group may hold most of the rows: it is cut at the splits of the order
    column, and the rows equal to a split value are cut once more by hash digits.
    Rows without a group are left out.
    """
    df = df.where(F.col(group).isNotNull())
    digest = row_hash(F.col(key), SEED)
    rows = df.count()
    if rows <= rows_per_bucket:
        by_order = Window.partitionBy(group).orderBy(order, "_hash", key)
        return (
            df.withColumn("_hash", digest)
            .withColumns(
                {
                    "row_rank": (F.row_number().over(by_order) - 1).cast("long"),
                    "group_rows": F.count(F.lit(1)).over(Window.partitionBy(group)),
                }
            )
            .drop("_hash")
        )
    splits = split_points(df, order, rows, rows_per_bucket)
    bucketed = bucket_by_splits(df.withColumn("_hash", digest), order, splits, "_bucket")
    edges = df.sparkSession.createDataFrame([(i + 1, v) for i, v in enumerate(splits)], "_bucket int, _edge double")
    bucketed = bucketed.join(F.broadcast(edges), "_bucket", "left")  # at most _LEVEL * _LEVEL rows
    on_edge = (F.col("_bucket") > 0) & (F.col(order) == F.col("_edge"))
    tied = on_edge | F.col(order).isNull()
    bucketed = bucketed.withColumns(
        {
            "_part": F.when(tied, F.substring("_hash", 1, 3)).otherwise("~"),
            "_bucket": F.coalesce(F.col("_bucket"), F.lit(-1)),  # NULL sorts first
        }
    )
    cell = [group, "_bucket", "_part"]
    before = Window.partitionBy(group).orderBy("_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *cell,
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
            F.sum("_n").over(Window.partitionBy(group)).alias("group_rows"),
        )
    )
    numbered = bucketed.withColumn(
        "_row", F.row_number().over(Window.partitionBy(*cell).orderBy(order, "_hash", key))
    )
    return (
        numbered.join(offsets, cell)
        .withColumn("row_rank", (F.col("_offset") + F.col("_row") - 1).cast("long"))
        .drop("_hash", "_bucket", "_edge", "_part", "_offset", "_row")
    )


def running_totals(
    df: DataFrame, order: str, sums: list[str], descending: bool = True, rows_per_bucket: int = IN_MEMORY_ROWS
) -> DataFrame:
    """Cumulative sums (``cum_<name>``) along a column whose values are distinct.

    ``df`` is read more than once; pass a written table.
    """
    rows = df.count()
    splits = split_points(df, order, rows, rows_per_bucket)
    bucketed = bucket_by_splits(df, order, splits, "_bucket")

    def way(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    inside = Window.partitionBy("_bucket").orderBy(way(order)).rowsBetween(Window.unboundedPreceding, 0)
    if not splits:
        return bucketed.withColumns({f"cum_{s}": F.sum(s).over(inside) for s in sums}).drop("_bucket")
    # At most one row per split below, so the single ordered window stays small.
    before = Window.partitionBy(F.lit(0)).orderBy(way("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .select("_bucket", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_off_{s}") for s in sums])
    )
    return (
        bucketed.join(F.broadcast(offsets), "_bucket")  # one row per bucket
        .withColumns({f"cum_{s}": F.col(f"_off_{s}") + F.sum(s).over(inside) for s in sums})
        .drop("_bucket", *[f"_off_{s}" for s in sums])
    )
