"""Splits, oversampling, isolation forest, training and scoring."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.functions import labels as L
from scanlens.operators import cv, evaluate, iforest, split, trees
from scanlens.operators.neighbours import Cells, cut_cells, nearest_neighbours
from scanlens.operators.smote import smote
from scanlens.plans import replay, score
from scanlens.plans.train import BOOSTED, FOREST, ISOLATION, Trained, train_contract, train_wide
from scanlens.sources import files


def test_split_is_disjoint_complete_and_exact(flows):
    marked = split.mark_test_rows(flows.select("flow_id", "label"), "label")
    train, test = split.train_test_split(flows.select("flow_id", "label"), "label")
    sizes = {r["label"]: r["n"] for r in flows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    taken = {r["label"]: r["n"] for r in test.groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert taken == {label: int(0.2 * n + 0.5) for label, n in sizes.items()}
    assert train.count() + test.count() == marked.count() == flows.count()
    assert train.join(test, "flow_id", "left_semi").count() == 0


def test_folds_share_the_classes_evenly(flows):
    folds = split.assign_folds(flows.select("flow_id", "label"), "label")
    per_fold = folds.groupBy("label", "fold").count().collect()
    for label in ("BENIGN", "PortScan"):
        counts = [r["count"] for r in per_fold if r["label"] == label]
        assert len(counts) == 10 and max(counts) - min(counts) <= 1


@pytest.fixture(scope="module")
def cloud(spark):
    """900 two-class points: clusters, a far outlier, and one vector copied 200 times."""
    rng = random.Random(1)
    rows = []
    for i in range(400):
        rows.append((f"p{i}", 1, rng.gauss(i % 3 * 5, 1), rng.gauss(0, 2), float(rng.randrange(3))))
    rows += [(f"c{i}", 1, 1.0, 1.0, 1.0) for i in range(200)]
    rows += [("far", 1, 500.0, -500.0, 0.0), ("twin1", 1, 50.0, 50.0, 50.0), ("twin2", 1, 50.0, 50.0, 50.0)]
    rows += [(f"b{i}", 0, rng.random(), rng.random(), rng.random()) for i in range(1500)]
    return spark.createDataFrame(rows, "flow_id string, y int, a double, b double, c double").repartition(4)


def _brute_neighbours(rows: np.ndarray, i: int, k: int) -> float:
    distance = np.sqrt(((rows - rows[i]) ** 2).sum(axis=1))
    return np.sort(np.delete(distance, i))[:k]


@pytest.mark.parametrize("cell_points", [5, 40, 10_000])
def test_neighbours_equal_brute_force(spark, cloud, cell_points):
    points = cloud.where("y = 1").groupBy(F.array("a", "b", "c").alias("vector")).agg(
        F.min("flow_id").alias("point"), F.count("*").alias("weight")
    ).cache()
    found = nearest_neighbours(points, 5, 3, cell_points).toPandas()
    table = points.toPandas()
    rows = np.repeat(np.array(table["vector"].tolist()), table["weight"], axis=0)
    start = np.concatenate([[0], np.cumsum(table["weight"])[:-1]])
    for at, (point, weight) in enumerate(zip(table["point"], table["weight"])):
        near = found[found["point"] == point].sort_values(["distance", "other"])
        mine = [0.0] * (weight - 1) + [d for d, w in zip(near["distance"], near["weight"]) for _ in range(w)]
        assert mine[:5] == pytest.approx(list(_brute_neighbours(rows, start[at], 5)))
    assert not found.duplicated(["point", "other"]).any()


def test_cells_cover_the_space():
    rng = np.random.default_rng(0)
    sample = rng.normal(size=(500, 3))
    cells: Cells = cut_cells(sample, 10)
    x = rng.normal(scale=3, size=(200, 3))
    home = cells.locate(x)
    assert (cells.dimension[home] == -1).all()
    assert ((x >= cells.low[home]) & (x <= cells.high[home])).all()
    row, cell = cells.touched(x, np.full(200, 1e9))
    assert len(row) == 200 * (cells.dimension == -1).sum()


@pytest.mark.parametrize("cell_points", [30, 10_000])
def test_oversampling_balances_with_points_between_neighbours(cloud, cell_points):
    balanced = smote(cloud, ["a", "b", "c"], cell_points=cell_points).cache()
    counts = {r["y"]: r["count"] for r in balanced.groupBy("y").count().collect()}
    assert counts == {0: 1500, 1: 1500}
    assert balanced.select("flow_id").distinct().count() == 3000
    real = np.array(cloud.where("y = 1").select("a", "b", "c").toPandas())
    made = np.array(balanced.where("flow_id like 'smote-%'").select("a", "b", "c").toPandas())
    assert len(made) == 1500 - 603
    # Each synthetic point lies on a segment from a real point to one of its neighbours.
    neighbours = [np.argsort(np.sqrt(((real - r) ** 2).sum(axis=1)), kind="stable")[:7] for r in real]
    for m in made[:: 37]:
        on_segment = False
        for i, r in enumerate(real):
            for j in neighbours[i]:
                d = real[j] - r
                length = (d**2).sum()
                u = ((m - r) @ d) / length if length else 0.0
                if -1e-9 <= u <= 1 + 1e-9 and np.abs(r + u * d - m).max() < 1e-9:
                    on_segment = True
        assert on_segment


def test_oversampling_does_not_depend_on_the_cells_or_partitions(cloud):
    one = smote(cloud, ["a", "b", "c"]).toPandas().sort_values("flow_id").reset_index(drop=True)
    two = smote(cloud.repartition(13), ["a", "b", "c"], cell_points=25).toPandas().sort_values("flow_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(one, two)


def test_equal_classes_are_left_alone(spark):
    df = spark.createDataFrame([("1", 0, 1.0), ("2", 1, 2.0)], "flow_id string, y int, a double")
    assert smote(df, ["a"]).count() == 2
    single = spark.createDataFrame([("1", 0, 1.0)], "flow_id string, y int, a double")
    with pytest.raises(ValueError):
        smote(single, ["a"])


def test_a_single_minority_row_is_copied(spark):
    df = spark.createDataFrame([("m", 1, 5.0)] + [(str(i), 0, 0.0) for i in range(4)], "flow_id string, y int, a double")
    assert [r["a"] for r in smote(df, ["a"]).where("y = 1").collect()] == [5.0] * 4


def test_average_path():
    assert iforest.average_path(np.array([1, 2])).tolist() == [0.0, 1.0]
    assert iforest.average_path(np.array([256]))[0] == pytest.approx(10.2448, abs=1e-3)


@pytest.mark.parametrize("rows", [300, 20_000])
def test_isolation_forest_finds_outliers(spark, tmp_path, rows):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame(rng.normal(size=(rows, 2)), columns=["a", "b"])
    frame["flow_id"] = [str(i) for i in range(rows)]
    df = spark.createDataFrame(frame)
    forest = iforest.fit_isolation_forest(df, ["a", "b"], trees=20, sample=128)
    assert forest.nodes["tree"].nunique() == 20 and forest.nodes["sample"].max() == 128
    odd = spark.createDataFrame([("x", 9.0, -9.0), ("y", 0.0, 0.0)], "flow_id string, a double, b double")
    scores = {r["flow_id"]: r["anomaly_score"] for r in forest.score(odd).collect()}
    assert scores["x"] > 0.7 > 0.5 > scores["y"]
    forest.write(spark, str(tmp_path / "forest"))
    again = iforest.IsolationForest.read(spark, str(tmp_path / "forest"))
    assert {r["flow_id"]: r["anomaly_score"] for r in again.score(odd).collect()} == pytest.approx(scores)


def test_contamination_sets_the_share_of_anomalies(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame(rng.normal(size=(2_000, 2)), columns=["a", "b"])
    frame["flow_id"] = [str(i) for i in range(2_000)]
    df = spark.createDataFrame(frame)
    forest = iforest.fit_isolation_forest(df, ["a", "b"], trees=30, contamination=0.1, max_features=0.8, bootstrap=True)
    flagged = forest.predict(df).agg(F.sum("prediction").alias("n")).first()["n"]
    assert flagged == pytest.approx(200, abs=25)


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 30 + [(1,)] * 10, "y int")
    sums = {r["y"]: r["w"] for r in trees.with_balanced_weights(df).groupBy("y").agg(F.sum("_weight").alias("w")).collect()}
    assert sums == pytest.approx({0: 20.0, 1: 20.0})


@pytest.fixture(scope="module")
def trained(flows):
    return train_contract(flows, rounds=5, forest_trees=10)


def test_training_meets_the_criteria_and_survives_saving(spark, flows, trained, tmp_path):
    metrics = {r["model"]: r for r in trained.metrics.collect()}
    assert set(metrics) == {FOREST, BOOSTED, ISOLATION}
    assert metrics[FOREST]["passed"] and metrics[FOREST]["auc_roc"] > 0.95
    checked = trained.metrics
    assert evaluate.best_supervised(checked).first()["best_model"] in (FOREST, BOOSTED)
    folder = str(tmp_path / "saved")
    trained.save(spark, folder)
    again = Trained.load(spark, folder)
    assert again.features == trained.features == K.MODEL_FEATURES
    for model in (FOREST, BOOSTED, ISOLATION):
        left = score.score_flows(flows, trained, model).select("flow_id", "prediction", F.round("confidence", 9).alias("c"))
        right = score.score_flows(flows, again, model).select("flow_id", "prediction", F.round("confidence", 9).alias("c"))
        assert left.exceptAll(right).count() == 0
    assert again.test.count() == trained.test.count()
    with pytest.raises(FileNotFoundError):
        Trained.load(spark, str(tmp_path / "nothing"))
    importances = trees.feature_importances(trained.models[FOREST], trained.features, spark).collect()
    assert len(importances) == 10
    assert [r["importance"] for r in importances] == sorted((r["importance"] for r in importances), reverse=True)


def test_scoring_and_replay_jobs(spark, flows, trained, tmp_path):
    models = str(tmp_path / "models")
    trained.save(spark, models)
    feed = str(tmp_path / "feed")
    files.write_csv(files.to_file_names(flows.select("src_ip", *K.FEATURES, "label")), feed)
    dry = score.run(spark, feed, models, str(tmp_path / "dry"), dry_run=True)
    assert dry.count() == flows.count() and not files.path_exists(spark, str(tmp_path / "dry"))
    assert dry.where("confidence < 0 or confidence > 1").count() == 0
    out = str(tmp_path / "out")
    graded = score.run(spark, feed, models, out)
    log = files.read_detection_log(spark, f"{out}/detections")
    assert log.count() == graded.count() == flows.count()
    blocked = graded.where("action = 'BLOCK'").count()
    assert spark.read.json(f"{out}/blocks").count() == blocked > 0
    assert files.read_detection_log(spark, f"{out}/alerts").count() == graded.where("action in ('BLOCK', 'ALERT')").count()

    reports = tmp_path / "reports"
    reports.mkdir()
    (reports / "a.xml").write_text(
        '<nmaprun args="-sS"><host><address addr="10.0.0.2" addrtype="ipv4"/><ports><port protocol="tcp" portid="22">'
        '<state state="open"/></port></ports></host></nmaprun>'
    )
    summary = replay.run(spark, str(reports), feed, models, str(tmp_path / "replay")).first()
    assert summary["events"] == flows.count() + 1


def test_command_lines(spark, flows, trained, tmp_path, capsys):
    from scanlens.plans import convert

    models, feed = str(tmp_path / "models"), str(tmp_path / "feed")
    trained.save(spark, models)
    files.write_csv(files.to_file_names(flows.select("src_ip", *K.FEATURES, "label")), feed)
    score.main(["--input", feed, "--models", models, "--dry-run", "--csv", str(tmp_path / "predictions")])
    assert f"out of {flows.count()} flows" in capsys.readouterr().out
    assert spark.read.option("header", True).csv(str(tmp_path / "predictions")).count() == flows.count()
    with pytest.raises(SystemExit):
        score.main(["--input", feed, "--models", models])
    (tmp_path / "scans").mkdir()
    (tmp_path / "scans" / "a.xml").write_text(
        '<nmaprun args="-sS"><host><address addr="10.0.0.2" addrtype="ipv4"/><ports><port protocol="tcp" portid="22">'
        '<state state="open"/></port></ports></host></nmaprun>'
    )
    convert.main(["--scans-dir", str(tmp_path / "scans"), "--output", str(tmp_path / "rows")])
    assert "1 feature rows" in capsys.readouterr().out


def test_row_keys_are_unique_and_stable(spark):
    df = spark.createDataFrame([(1.0,)] * 500, "a double").repartition(3)
    keyed = files.with_row_key(df)
    first = {r["flow_id"] for r in keyed.collect()}
    assert len(first) == 500 == len(first | {r["flow_id"] for r in keyed.repartition(7).collect()})
    marked = split.mark_test_rows(keyed.withColumn("y", F.lit(0)))
    assert marked.where("is_test").count() == 100


def test_missing_feature_is_an_error(flows, trained):
    with pytest.raises(ValueError, match="flow_duration"):
        trained.prepare(flows.drop("flow_duration"))


def test_wide_training(spark, folder):
    from scanlens.catalog.aggregates import _wide_raw

    raw = _wide_raw(spark, folder).withColumn("Label", F.when(F.col("y") == 1, K.ATTACK_LABEL).otherwise(K.BENIGN_LABEL)).drop("y")
    wide = train_wide(raw, rounds=2, forest_trees=5)
    assert len(wide.features) == 48
    assert wide.metrics.count() == 3


def test_cross_validation(flows):
    data = flows.select("flow_id", L.attack_exact(F.col("label")).alias("y"), *K.FEATURES)
    rates = cv.cross_validate(data, trees.random_forest(trees=5, max_depth=5), K.FEATURES, folds=2)
    assert rates.count() == 2
    one_by_one = cv.cross_validate(data, trees.random_forest(trees=5, max_depth=5), K.FEATURES, folds=2, parallel=1)
    assert sorted(map(tuple, rates.collect())) == sorted(map(tuple, one_by_one.collect()))
    assert evaluate.cv_summary(rates).first()["mean_f1"] > 0.8
