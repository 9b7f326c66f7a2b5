"""Training jobs: nine contract features, or the wide engineered set.

python -m scanlens.plans.train --input flows.csv --output models/ [--wide]
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.functions import labels as L
from scanlens.operators import clean, engineer, evaluate, trees
from scanlens.operators.boost import BoostedModel
from scanlens.operators.forest import ForestModel
from scanlens.operators.grow import binned
from scanlens.operators.iforest import IsolationForest, fit_isolation_forest
from scanlens.operators.preprocess import Preprocessing, apply_preprocessing, fit_preprocessing
from scanlens.operators.scale import Scaler, fit_scaler
from scanlens.operators.smote import smote
from scanlens.operators.split import train_test_split
from scanlens.session import build_session, scratch, written
from scanlens.sources.files import path_exists, read_flows_csv, read_names, to_short_names, with_row_key, write_names

FOREST, BOOSTED, ISOLATION = "Random Forest", "Boosted Trees", "Isolation Forest"
_FOLDERS = {FOREST: "random_forest", BOOSTED: "boosted_trees"}
_KINDS = {FOREST: ForestModel, BOOSTED: BoostedModel}


@dataclass(frozen=True)
class Growth:
    """How trees grow; None takes the default of the variant."""

    depth: int | None = None  # of the forest
    bins: int | None = None
    min_leaf_rows: int | None = None
    trees: int | None = None
    rounds: int | None = None


def _growth(growth: Growth | None, rounds: int | None, forest_trees: int | None) -> Growth:
    growth = growth or Growth()
    return replace(growth, rounds=rounds or growth.rounds, trees=forest_trees or growth.trees)


@dataclass
class Trained:
    """Everything needed to score new flows, and the held-out rows."""

    features: list[str]
    preprocessing: Preprocessing | None
    scaler: Scaler
    models: dict[str, ForestModel | BoostedModel] = field(default_factory=dict)
    isolation: IsolationForest | None = None
    test: DataFrame | None = None
    metrics: DataFrame | None = None

    def prepare(self, flows: DataFrame) -> DataFrame:
        """Raw flows to scaled model features; other columns pass through."""
        ready = flows
        if self.preprocessing is not None:
            checked = clean.require_features(flows, [p.feature for p in self.preprocessing.features])
            ready = apply_preprocessing(checked, self.preprocessing)
        ready = clean.add_placeholders(ready, [f for f in self.features if f in K.DEFENCE_FEATURES], only_if_absent=True)
        return self.scaler.transform(clean.require_features(ready, self.features))

    def predict(self, prepared: DataFrame, model: str = FOREST) -> DataFrame:
        if model == ISOLATION:
            return self.isolation.predict(prepared)
        return trees.predict(self.models[model], prepared)

    def save(self, spark: SparkSession, folder: str) -> None:
        write_names(spark, self.features, f"{folder}/features")
        self.scaler.write(spark, f"{folder}/scaler")
        if self.preprocessing is not None:
            self.preprocessing.write(spark, f"{folder}/preprocessing")
        for name, model in self.models.items():
            model.write(spark, f"{folder}/{_FOLDERS[name]}")
        if self.isolation is not None:
            self.isolation.write(spark, f"{folder}/isolation_forest")
        if self.metrics is not None:
            self.metrics.coalesce(1).write.mode("overwrite").json(f"{folder}/metrics")
        if self.test is not None:
            self.test.write.mode("overwrite").parquet(f"{folder}/test_rows")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "Trained":
        if not path_exists(spark, f"{folder}/scaler"):
            raise FileNotFoundError(f"no saved scaler below {folder}")

        def present(name: str) -> bool:
            return path_exists(spark, f"{folder}/{name}")

        return cls(
            features=read_names(spark, f"{folder}/features"),
            preprocessing=Preprocessing.read(spark, f"{folder}/preprocessing") if present("preprocessing") else None,
            scaler=Scaler.read(spark, f"{folder}/scaler"),
            models={n: _KINDS[n].read(spark, f"{folder}/{d}") for n, d in _FOLDERS.items() if present(d)},
            isolation=IsolationForest.read(spark, f"{folder}/isolation_forest") if present("isolation_forest") else None,
            test=spark.read.parquet(f"{folder}/test_rows") if present("test_rows") else None,
        )


def train_contract(
    flows: DataFrame,
    key: str = "flow_id",
    label: str = "label",
    growth: Growth | None = None,
    rounds: int | None = None,
    forest_trees: int | None = None,
) -> Trained:
    """Nine features plus two placeholders.  Every parameter is fitted on training rows only."""
    labelled = flows.select(key, *K.FEATURES, L.attack_contains(F.col(label)).alias("y"))
    train_rows, test_rows = train_test_split(labelled, "y", key=key)
    train_rows = written(train_rows, "train-rows")  # fitting reads them a dozen times
    preprocessing = fit_preprocessing(train_rows, K.FEATURES, variant="train")

    def shaped(rows: DataFrame) -> DataFrame:
        return clean.add_placeholders(apply_preprocessing(rows, preprocessing), K.DEFENCE_FEATURES)

    train_rows, test_rows = shaped(train_rows), shaped(test_rows)
    return _fit_all(train_rows, test_rows, list(K.MODEL_FEATURES), preprocessing, key, False, _growth(growth, rounds, forest_trees))


def train_wide(
    raw: DataFrame,
    key: str = "flow_id",
    label: str = "Label",
    source: str = "Source IP",
    growth: Growth | None = None,
    rounds: int | None = None,
    forest_trees: int | None = None,
) -> Trained:
    """46 engineered and 2 synthetic features; rows with a missing value are dropped."""
    origins = sorted({o for _, o in K.WIDE_FEATURES if o})
    labelled = clean.drop_unlabelled(raw, label).withColumn("y", L.attack_exact(F.col(label)))
    complete = clean.drop_incomplete(clean.non_finite_to_null(labelled, origins), origins)
    wide = engineer.inject_defence_features(engineer.engineer_features(complete, source, keep=[key, "y"]), key=key)
    features = [target for target, _ in K.WIDE_FEATURES] + K.WIDE_DEFENCE_FEATURES
    train_rows, test_rows = train_test_split(wide, "y", key=key)
    return _fit_all(train_rows, test_rows, features, None, key, True, _growth(growth, rounds, forest_trees))


def _fit_all(train_rows, test_rows, features, preprocessing, key, wide, growth: Growth) -> Trained:
    scaler = fit_scaler(train_rows, features)
    scaled = written(scaler.transform(train_rows).select(key, "y", *[F.col(f"`{f}`") for f in features]), "train")
    test = written(scaler.transform(test_rows).select(key, "y", *[F.col(f"`{f}`") for f in features]), "test")
    balanced = written(smote(scaled, features, key=key), "train-balanced")
    trained = Trained(features, preprocessing, scaler, test=test)
    forest = trees.random_forest(
        wide=wide, max_depth=growth.depth, trees=growth.trees, max_bins=growth.bins, min_leaf_rows=growth.min_leaf_rows
    )
    boosting = trees.boosted_trees(wide=wide, rounds=growth.rounds, max_bins=growth.bins)
    ready = binned(balanced, features, "y", key, forest.bins)  # both have the same candidates
    trained.models[FOREST] = trees.fit(forest, balanced, features, key=key, ready=ready)
    trained.models[BOOSTED] = trees.fit(boosting, balanced, features, key=key, ready=ready)
    options = dict(trees=300, contamination=0.45, max_features=0.8, bootstrap=True) if wide else {}
    trained.isolation = fit_isolation_forest(scaled.where("y = 0"), features, key=key, **options)
    trained.metrics = compare_models(trained, test)
    return trained


def compare_models(trained: Trained, test: DataFrame) -> DataFrame:
    """Rates, AUC and acceptance per model; all are read from one scored table."""
    rows = []
    for name in [*trained.models, *([ISOLATION] if trained.isolation else [])]:
        scored = written(trained.predict(test, name).select("y", "prediction", "confidence"), "scored")
        rates = evaluate.rates(evaluate.confusion(scored)).first().asDict()
        # A model without probabilities has no ranking to measure.
        auc = 0.0 if name == ISOLATION else evaluate.roc_auc(scored, "y", "confidence").first()["auc_roc"]
        rows.append({**rates, "model": name, "unsupervised": name == ISOLATION, "auc_roc": float(auc or 0.0)})
    names = ["tn", "fp", "fn", "tp"]
    measures = ["accuracy", "precision", "recall", "f1_score", "fpr", "auc_roc"]
    schema = "model string, unsupervised boolean, " + ", ".join(
        [f"{n} bigint" for n in names] + [f"{m} double" for m in measures]
    )
    ordered = [(r["model"], r["unsupervised"], *[r[n] for n in names], *[r[m] for m in measures]) for r in rows]
    return evaluate.criteria(test.sparkSession.createDataFrame(ordered, schema))


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Train the three models on a labelled flow file")
    parser.add_argument("--input", required=True, nargs="+", help="flow files, or folders of them")
    parser.add_argument("--output", required=True, help="folder for parameters, models, metrics and test rows")
    parser.add_argument("--wide", action="store_true", help="46 engineered and 2 synthetic features")
    parser.add_argument("--depth", type=int, help="depth of the forest's trees (no limit)")
    parser.add_argument("--bins", type=int, help="split candidates per feature (256)")
    parser.add_argument("--min-leaf-rows", type=int, help="rows a leaf of the forest has at least")
    parser.add_argument("--trees", type=int, help="trees of the forest (100; wide 300)")
    parser.add_argument("--rounds", type=int, help="boosting rounds (100; wide 300)")
    options = parser.parse_args(arguments)
    growth = Growth(options.depth, options.bins, options.min_leaf_rows, options.trees, options.rounds)
    spark = build_session("scanlens-train")
    with scratch(spark):
        # keys follow from the content, so a second run splits, samples and trains alike
        raw = written(with_row_key(read_flows_csv(spark, options.input)), "raw")
        trained = train_wide(raw, growth=growth) if options.wide else train_contract(to_short_names(raw), growth=growth)
        trained.save(spark, options.output)
        trained.metrics.show(truncate=False)
        best = evaluate.best_supervised(trained.metrics).first()["best_model"]
    print(f"best supervised model: {best}")


if __name__ == "__main__":
    main()
