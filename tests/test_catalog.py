"""Every registered query with an SQL twin gives the twin's rows."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_catalog import connect, difference  # noqa: E402

from scanlens.catalog import ORACLES, QUERIES  # noqa: E402

_MODELS = {
    "rf_score", "gbt_score", "iforest_score", "model_comparison", "feature_importances", "graded_detections", "model_agreement",
}


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, folder, duck, name):
    assert difference(QUERIES[name](spark, folder), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - _MODELS))
def test_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).count() >= 0


@pytest.mark.parametrize("partitions", ["1", "16"])
@pytest.mark.parametrize("name", ["ordered_chunk_agg", "stratified_split", "cv_fold_assignment", "roc_auc", "engineer_features"])
def test_same_rows_under_other_partitioning(spark, folder, duck, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert difference(QUERIES[name](spark, folder), duck, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_entry(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
