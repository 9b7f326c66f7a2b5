"""Confusion counts, rates, ROC, acceptance criteria."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlens import constants as K
from scanlens.functions.scalars import ratio
from scanlens.limits import IN_MEMORY_ROWS
from scanlens.operators.ranking import running_totals
from scanlens.session import written


def confusion(df: DataFrame, truth: str = "y", prediction: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """TN, FP, FN, TP as four conditional counts in one pass."""
    t, p = F.col(truth), F.col(prediction)
    return df.groupBy(*(by or [])).agg(
        F.count_if((t == 0) & (p == 0)).alias("tn"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
        F.count_if((t == 1) & (p == 1)).alias("tp"),
    )


def rates(confusions: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and FPR; 0 where the denominator is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return confusions.withColumns(
        {
            "accuracy": ratio(tp + tn, tn + fp + fn + tp),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
            "fpr": ratio(fp, fp + tn),
        }
    )


def class_report(confusions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class with macro and weighted averages.

    ``confusions`` has one row, so everything here is a projection of that row.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def entry(name: str, hit: Column, false_alarm: Column, miss: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            ratio(hit, hit + false_alarm).alias("precision"),
            ratio(hit, hit + miss).alias("recall"),
            ratio(2 * hit, 2 * hit + false_alarm + miss).alias("f1_score"),
            (hit + miss).alias("support"),
        )

    per_class = confusions.select(
        entry(K.BENIGN_LABEL, tn, fn, fp).alias("benign"), entry(K.ATTACK_LABEL, tp, fp, fn).alias("attack")
    )
    measures = ("precision", "recall", "f1_score")
    total = F.col("benign.support") + F.col("attack.support")

    def average(name: str, benign_weight: Column, attack_weight: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[(F.col(f"benign.{m}") * benign_weight + F.col(f"attack.{m}") * attack_weight).alias(m) for m in measures],
            total.alias("support"),
        )

    half = F.lit(0.5)
    return per_class.select(
        F.inline(
            F.array(
                F.col("benign"),
                F.col("attack"),
                average("macro avg", half, half),
                average("weighted avg", ratio(F.col("benign.support"), total), ratio(F.col("attack.support"), total)),
            )
        )
    )


def score_counts(df: DataFrame, truth: str = "y", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score: the only pass over the raw rows."""
    t = F.col(truth)
    return df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(t == 1).alias("positives"), F.count_if(t == 0).alias("negatives")
    )


def roc_points(
    df: DataFrame, truth: str = "y", score: str = "score", rows_per_bucket: int = IN_MEMORY_ROWS
) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, from the highest threshold down."""
    counts = written(score_counts(df, truth, score), "score-counts")
    totals = counts.agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n")).first()
    cumulated = running_totals(counts, "score", ["positives", "negatives"], True, rows_per_bucket)
    return cumulated.select(
        F.col("score").alias("threshold"),
        ratio(F.col("cum_negatives"), F.lit(totals["n"] or 0)).alias("fpr"),
        ratio(F.col("cum_positives"), F.lit(totals["p"] or 0)).alias("tpr"),
    )


def roc_auc(
    df: DataFrame, truth: str = "y", score: str = "score", rows_per_bucket: int = IN_MEMORY_ROWS
) -> DataFrame:
    """Share of (positive, negative) pairs ranked correctly, ties counted half; NULL with one class."""
    counts = written(score_counts(df, truth, score), "score-counts")
    cumulated = running_totals(counts, "score", ["negatives"], False, rows_per_bucket)
    below = F.col("cum_negatives") - F.col("negatives")
    won = F.col("positives") * (below + F.col("negatives") / 2)
    return cumulated.agg(
        F.sum(won.cast("double")).alias("won"), F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives")
    ).select(
        F.try_divide(F.col("won"), F.col("positives").cast("double") * F.col("negatives")).alias("auc_roc"),
        "positives",
        "negatives",
    )


def criteria(metrics: DataFrame, model: str = "model", unsupervised: Column | None = None) -> DataFrame:
    """Pass or fail per criterion and overall; unsupervised models have their own set."""
    is_unsupervised = F.col("unsupervised") if unsupervised is None else unsupervised
    sup, uns = K.SUPERVISED_CRITERIA, K.UNSUPERVISED_CRITERIA
    checked = metrics.withColumns(
        {
            "f1_ok": F.col("f1_score") >= F.when(is_unsupervised, uns["f1_score"]).otherwise(sup["f1_score"]),
            "accuracy_ok": F.col("accuracy") >= F.when(is_unsupervised, uns["accuracy"]).otherwise(sup["accuracy"]),
            "third_ok": F.when(is_unsupervised, F.col("recall") >= uns["recall"]).otherwise(F.col("fpr") < sup["fpr"]),
        }
    )
    return checked.withColumn("passed", F.col("f1_ok") & F.col("accuracy_ok") & F.col("third_ok"))


def best_supervised(checked: DataFrame, model: str = "model") -> DataFrame:
    """Supervised model with the lowest FPR among those that pass."""
    return checked.where(F.col("passed") & ~F.col("unsupervised")).agg(F.min_by(model, "fpr").alias("best_model"))


def cv_summary(folds: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean F1 and two population deviations over the folds."""
    return folds.groupBy(*(by or [])).agg(
        F.avg("f1_score").alias("mean_f1"), (2 * F.stddev_pop("f1_score")).alias("spread")
    )


def anomaly_capture(df: DataFrame, truth: str = "y", prediction: str = "prediction") -> DataFrame:
    """Flagged rows, actual attacks, attacks caught and the share of attacks caught."""
    t, p = F.col(truth), F.col(prediction)
    return df.agg(
        F.count_if(p == 1).alias("flagged"),
        F.count_if(t == 1).alias("actual"),
        F.count_if((t == 1) & (p == 1)).alias("caught"),
        F.count(F.lit(1)).alias("rows"),
    ).withColumn("caught_percent", 100 * ratio(F.col("caught"), F.col("actual")))


def comparison_table(evaluated: list[tuple[str, bool, DataFrame]]) -> DataFrame:
    """One rate row per (model name, unsupervised?, one-row rates)."""
    rows = [
        frame.withColumns({"model": F.lit(name), "unsupervised": F.lit(unsupervised)})
        for name, unsupervised, frame in evaluated
    ]
    result = rows[0]
    for frame in rows[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result
