"""Stratified cross-validation with oversampling inside each training part."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.operators import evaluate, trees
from scanlens.operators.smote import smote
from scanlens.operators.split import assign_folds
from scanlens.session import written


def cross_validate(
    df: DataFrame,
    classifier,
    features: list[str],
    label: str = "y",
    folds: int = K.CV_FOLDS,
    key: str = "flow_id",
    oversample: bool = True,
    parallel: int = 4,
) -> DataFrame:
    """Rates per fold.  Each fold trains on the others; test rows are never oversampled.

    Folds are trained side by side, each in jobs of its own, so the cluster works on one
    while another waits for its next job; ``parallel`` bounds how many.  Their results do
    not depend on it.
    """
    numbered = written(assign_folds(df.select(key, *features, label), label, folds, key), "cv-folds")

    def scored(fold: int) -> DataFrame:
        train = numbered.where(F.col("fold") != fold).drop("fold")
        if oversample:
            train = written(smote(train, features, label, key=key), "cv-train")
        model = trees.fit(classifier, train, features, label, key)
        return trees.predict(model, numbered.where(F.col("fold") == fold)).select("fold", label, "prediction")

    with ThreadPoolExecutor(min(parallel, folds)) as pool:
        parts = list(pool.map(inheritable_thread_target(scored), range(folds)))
    together = reduce(lambda a, b: a.unionByName(b), parts)
    return evaluate.rates(evaluate.confusion(together, label, by=["fold"]))
