"""Stratified train/test split and cross-validation folds."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.functions.hashing import row_hash
from scanlens.operators.ranking import mark_smallest_hashes, rank_by_hash


def mark_test_rows(
    df: DataFrame, stratum: str = "y", share: float = K.TEST_SHARE, key: str = "flow_id", seed: int = K.SEED
) -> DataFrame:
    """``is_test`` for exactly round(share * n) rows of each class."""

    def wanted(sizes):
        return {s: math.floor(share * n + 0.5) for s, n in sizes.items()}

    return mark_smallest_hashes(df, stratum, wanted, key, seed, "is_test")


def mark_test_rows_by_threshold(
    df: DataFrame, share: float = K.TEST_SHARE, key: str = "flow_id", seed: int = K.SEED
) -> DataFrame:
    """``is_test`` from a hash threshold alone: no pass over the data, shares hold on average."""
    limit = f"{math.floor(share * 2**32):08x}"
    return df.withColumn("is_test", F.substring(row_hash(F.col(key), seed), 1, 8) < limit)


def train_test_split(df: DataFrame, stratum: str = "y", **options) -> tuple[DataFrame, DataFrame]:
    marked = mark_test_rows(df, stratum, **options)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def assign_folds(
    df: DataFrame, stratum: str = "y", folds: int = K.CV_FOLDS, key: str = "flow_id", seed: int = K.SEED
) -> DataFrame:
    """``fold`` with equal class shares in every fold."""
    ranked = rank_by_hash(df, stratum, key, seed)
    return ranked.withColumn("fold", (F.col("hash_rank") % folds).cast("int")).drop("hash_rank")
