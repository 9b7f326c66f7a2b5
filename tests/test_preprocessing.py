"""Properties of fitted parameters, clipping, alignment and verdicts."""

from __future__ import annotations

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.functions import labels as L
from scanlens.functions import scalars as S
from scanlens.operators import align, preprocess, scale, verdicts
from scanlens.sources.flows_view import dirty_flows


def test_imputed_rows_have_no_null_and_lie_in_the_fences(spark, folder):
    source = dirty_flows(spark, folder)
    params = preprocess.fit_preprocessing(source, variant="serve_ref")
    for p in params.features:
        p.log = False
    shaped = preprocess.apply_preprocessing(source, params)
    row = shaped.agg(
        *[F.count_if(F.col(p.feature).isNull()).alias(f"{p.feature}_null") for p in params.features],
        *[F.min(p.feature).alias(f"{p.feature}_min") for p in params.features],
        *[F.max(p.feature).alias(f"{p.feature}_max") for p in params.features],
    ).first()
    for p in params.features:
        assert row[f"{p.feature}_null"] == 0
        assert p.lower <= row[f"{p.feature}_min"] and row[f"{p.feature}_max"] <= p.upper


def test_zero_iqr_features_are_kept_in_training_only(spark, folder):
    source = dirty_flows(spark, folder)
    train = {p.feature: p for p in preprocess.fit_preprocessing(source, variant="train").features}
    serve = {p.feature: p for p in preprocess.fit_preprocessing(source, variant="serve_ref").features}
    assert train["rst_flag_count"].lower is None
    assert (serve["rst_flag_count"].lower, serve["rst_flag_count"].upper) == (0.0, 0.0)
    with pytest.raises(ValueError):
        preprocess.fit_preprocessing(source, variant="other")


def test_parameters_survive_a_round_trip(spark, folder, tmp_path):
    params = preprocess.fit_preprocessing(dirty_flows(spark, folder))
    params.write(spark, str(tmp_path / "params"))
    again = preprocess.Preprocessing.read(spark, str(tmp_path / "params"))
    assert {p.feature: p for p in again.features} == {p.feature: p for p in params.features}


def test_skewness_is_bias_corrected(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (3.0, 4.0), (10.0, 4.0)], "a double, b double")
    row = df.agg(S.g1_skewness(F.col("a")).alias("a"), S.g1_skewness(F.col("b")).alias("b")).first()
    assert row["a"] == pytest.approx(pd.Series([1.0, 2.0, 3.0, 10.0]).skew())
    assert row["b"] == 0.0


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (2.0,), (-1.0,), (9.0,)], "a double")
    values = [r[0] for r in df.select(S.clip(F.col("a"), 0.0, 5.0)).collect()]
    assert values == [None, 2.0, 0.0, 5.0]


def test_values_below_the_fitted_minimum_are_counted_and_clamped(spark):
    params = preprocess.Preprocessing([preprocess.FeatureParams("a", 0.0, -100.0, 100.0, 2.0, True, 13.0)])
    df = spark.createDataFrame([(-50.0,), (-13.0,), (0.0,)], "a double")
    shaped = [r["a"] for r in preprocess.apply_preprocessing(df, params).collect()]
    assert shaped == pytest.approx([0.0, 0.0, math.log(14.0)])
    assert preprocess.below_fitted_minimum(df, params).first()["a"] == 1


def test_scaler_uses_population_deviation_and_centres_constants(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0)], "a double, b double")
    fitted = scale.fit_scaler(df, ["a", "b"])
    rows = fitted.transform(df).orderBy("a").collect()
    assert rows[0]["a"] == pytest.approx(-1.0 / math.sqrt(2 / 3))
    assert {r["b"] for r in rows} == {0.0}
    later = fitted.transform(spark.createDataFrame([(2.0, 9.0)], "a double, b double")).first()
    assert later["b"] == 2.0


@pytest.mark.parametrize(
    "prediction, confidence, action",
    [(0, 0.99, "ALLOW"), (1, 0.85, "BLOCK"), (1, 0.8499, "ALERT"), (1, 0.60, "ALERT"), (1, 0.59, "MONITOR")],
)
def test_graded_actions(spark, prediction, confidence, action):
    df = spark.createDataFrame([(prediction, confidence)], "prediction int, confidence double")
    row = verdicts.grade(df).first()
    assert row["action"] == action
    assert row["verdict"] == ("PortScan" if prediction else "BENIGN")


def test_default_source_and_port(spark):
    df = spark.createDataFrame([(1, None), (2, 80.0)], "id int, dst_port double")
    rows = verdicts.with_defaults(df).orderBy("id").collect()
    assert [(r["src_ip"], r["dst_port"]) for r in rows] == [("192.168.100.10", 0), ("192.168.100.10", 80)]


@pytest.mark.parametrize(
    "confidence, votes, level", [(0.96, 3, "HIGH"), (0.96, 2, "MEDIUM"), (0.9, 3, "MEDIUM"), (0.9, 1, "LOW"), (0.5, 3, "LOW")]
)
def test_severity(spark, confidence, votes, level):
    row = spark.range(1).select(L.severity(F.lit(confidence), F.lit(votes), 3).alias("s")).first()
    assert row["s"] == level


def test_alignment_maps_cover_the_same_targets(spark):
    assert list(K.FLOWMETER_V3_MAP) == list(K.ARGUS_MAP)
    assert len(K.FLOWMETER_V3_MAP) == 48
    assert [t for t, _ in K.WIDE_FEATURES] + K.WIDE_DEFENCE_FEATURES == list(K.FLOWMETER_V3_MAP)


def test_alignment_rules(spark):
    df = spark.createDataFrame([("7", "x"), ("Infinity", "1")], "num string, text string")
    aligned, absent = align.align_schema(df, {"a": "num", "b": 3, "c": None, "d": "missing", "e": "text"})
    rows = aligned.collect()
    assert absent == ["d"]
    assert rows[0].asDict() == {"a": 7.0, "b": 3.0, "c": None, "d": 0.0, "e": None}


def test_fallback_to_all_attacks_without_recon_labels(spark):
    rows = [("1", "Benign"), ("2", "Bot"), ("3", "Benign"), ("4", "DoS"), ("5", "BENIGN")]
    df = spark.createDataFrame(rows, "flow_id string, Label string")
    chosen = align.recon_subset(df).collect()
    assert sorted(r["flow_id"] for r in chosen if r["Label"] in ("Bot", "DoS")) == ["2", "4"]
    assert len(chosen) == 4


def test_balancing_keeps_all_attacks_when_benign_rows_are_few(spark):
    rows = [(str(i), "PortScan") for i in range(5)] + [("b", "Benign")]
    df = spark.createDataFrame(rows, "flow_id string, Label string")
    assert align.recon_subset(df).count() == 6


def test_no_category_rows_give_an_empty_table(spark):
    df = spark.createDataFrame([("1", "Exploits", 1), ("2", None, 0)], "flow_id string, attack_cat string, label int")
    assert align.category_subset(df).count() == 0


def test_shuffled_rows_are_the_same_rows(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("flow_id"))
    order = [r["flow_id"] for r in align.shuffle_rows(df).collect()]
    assert sorted(order, key=int) == [str(i) for i in range(50)] and order != sorted(order, key=int)
