"""The plans for big or skewed inputs give the same answers as the simple plans."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanlens.operators import chunks, evaluate, lookups, ranking
from scanlens.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("limit", [50, 400])
def test_narrowed_quantiles_equal_numpy(spark, limit):
    rng = random.Random(7)
    rows = [
        (
            rng.expovariate(0.01),
            float(rng.choice([0, 0, 0, 1])),  # one hot value
            None if rng.random() < 0.3 else rng.gauss(0, 1e6),
            3.0,
        )
        for _ in range(5_000)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(6)
    shares = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, ["a", "b", "c", "d"], shares, in_memory_rows=limit)
    for i, name in enumerate("abcd"):
        values = np.array([r[i] for r in rows if r[i] is not None])
        assert found[name] == pytest.approx(list(np.quantile(values, shares)), rel=1e-12, abs=1e-12)


def test_both_quantile_plans_give_the_same_bits(spark, flows):
    columns, shares = ["flow_duration", "flow_iat_mean", "dst_port"], [0.1, 0.25, 0.5, 0.75, 0.9]
    assert exact_quantiles(flows, columns, shares, in_memory_rows=20) == exact_quantiles(flows, columns, shares)


def test_quantiles_of_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert exact_quantiles(df, ["a"], [0.5]) == {"a": [None]}
    assert exact_quantiles(df, ["a"], [0.5], in_memory_rows=1) == {"a": [None]}


@pytest.fixture(scope="module")
def skewed(spark):
    """One source with most rows, half of them tied on the order column."""
    rng = random.Random(3)
    rows = []
    for i in range(3_000):
        source = "hot" if rng.random() < 0.6 else f"s{rng.randrange(40)}"
        duration = 5.0 if rng.random() < 0.5 else float(rng.randrange(1000))
        rows.append((str(i), source, None if i % 97 == 0 else duration, float(rng.randrange(300)), float(i % 2),
                     "PortScan" if rng.random() < 0.4 else "BENIGN"))
    schema = "flow_id string, src_ip string, flow_duration double, dst_port double, syn_flag_count double, label string"
    return (
        spark.createDataFrame(rows, schema)
        .withColumns({"total_fwd_packets": F.lit(1.0), "flow_iat_mean": F.col("flow_duration") * 2})
        .repartition(5)
    )


def _as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


def test_cut_ranks_equal_plain_ranks(skewed):
    plain = ranking.rank_within(skewed, "src_ip", "flow_duration")
    cut = ranking.rank_within(skewed, "src_ip", "flow_duration", rows_per_bucket=100)
    columns = ("flow_id", "row_rank", "group_rows")
    assert _as_set(cut, *columns) == _as_set(plain, *columns)


def test_cut_chunks_equal_plain_chunks(skewed):
    plain = chunks.chunk_statistics(skewed)
    cut = chunks.chunk_statistics(skewed, rows_per_bucket=100)
    columns = ("src_ip", "chunk", "flow_count", "distinct_ports", "label", "total_fwd_packets")
    assert _as_set(cut, *columns) == _as_set(plain, *columns)


def test_chunk_sizes(skewed):
    sizes = {r["src_ip"]: r["n"] for r in skewed.groupBy("src_ip").agg(F.count("*").alias("n")).collect()}
    for row in chunks.chunk_statistics(skewed).collect():
        n = sizes[row["src_ip"]]
        size = min(n, max(2, n // 3))
        assert 2 <= row["flow_count"] <= size


def test_hash_rank_is_a_permutation_per_stratum(skewed):
    ranked = ranking.rank_by_hash(skewed, "label").select("label", "hash_rank").collect()
    for label in ("PortScan", "BENIGN"):
        ranks = sorted(r["hash_rank"] for r in ranked if r["label"] == label)
        assert ranks == list(range(len(ranks)))


@pytest.mark.parametrize("wanted", [0, 1, 7, 500, 10_000])
def test_marked_rows_are_exact(skewed, wanted):
    marked = ranking.mark_smallest_hashes(skewed, "label", lambda sizes: {s: wanted for s in sizes})
    counts = {r["label"]: (r["n"], r["c"]) for r in marked.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if("chosen").alias("c")).collect()}
    for n, chosen in counts.values():
        assert chosen == min(wanted, n)


def test_marked_rows_are_the_first_in_hash_order(skewed):
    ranked = ranking.rank_by_hash(skewed, "label").where("hash_rank < 37")
    marked = ranking.mark_smallest_hashes(skewed, "label", lambda sizes: {s: 37 for s in sizes}).where("chosen")
    assert _as_set(marked, "flow_id") == _as_set(ranked, "flow_id")


def test_running_totals_cut_equal_plain(spark):
    df = spark.range(2_000).select(F.sin("id").alias("x"), (F.col("id") % 5).alias("n")).repartition(4)
    for descending in (True, False):
        plain = ranking.running_totals(df, "x", ["n"], descending)
        cut = ranking.running_totals(df, "x", ["n"], descending, rows_per_bucket=100)
        assert _as_set(cut, "x", "cum_n") == _as_set(plain, "x", "cum_n")


def test_hot_key_join_equals_plain_join(spark, skewed):
    lookup = skewed.groupBy("src_ip").agg(F.count("*").alias("n")).where("src_ip <> 's1'")
    plain = lookups.attach_by_key(skewed, lookup, "src_ip")
    split = lookups.attach_by_key(skewed, lookup, "src_ip", broadcast_rows=5, hot_key_rows=500)
    shuffled = lookups.attach_by_key(skewed, lookup, "src_ip", broadcast_rows=5, hot_key_rows=10_000)
    assert _as_set(split, "flow_id", "n") == _as_set(plain, "flow_id", "n") == _as_set(shuffled, "flow_id", "n")
    assert split.count() == skewed.count()


def test_distinct_ports_with_split_join(skewed):
    plain = lookups.with_distinct_ports(skewed)
    split = lookups.with_distinct_ports(skewed, broadcast_rows=5, hot_key_rows=500)
    assert _as_set(split, "flow_id", "distinct_ports") == _as_set(plain, "flow_id", "distinct_ports")


def test_without_source_the_port_stands_in(skewed):
    row = lookups.with_distinct_ports(skewed.drop("src_ip")).first()
    assert row["distinct_ports"] == row["dst_port"]


def test_auc_cut_equals_plain_and_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(11)
    rows = [(round(rng.random(), 3), float(rng.random() < 0.3)) for _ in range(4_000)]
    df = spark.createDataFrame(rows, "score double, y double")
    plain = evaluate.roc_auc(df).first()["auc_roc"]
    cut = evaluate.roc_auc(df, rows_per_bucket=50).first()["auc_roc"]
    judged = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0).evaluate(df)
    assert plain == pytest.approx(cut, abs=1e-12) == pytest.approx(judged, abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.9, 1)], "score double, y int")
    assert evaluate.roc_auc(df).first()["auc_roc"] is None


def test_roc_points_cut_equal_plain(spark):
    df = spark.range(3_000).select((F.col("id") % 701 / 701).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    plain, cut = evaluate.roc_points(df), evaluate.roc_points(df, rows_per_bucket=60)
    assert _as_set(cut, "threshold", "fpr", "tpr") == _as_set(plain, "threshold", "fpr", "tpr")
    last = plain.orderBy("threshold").first()
    assert (last["fpr"], last["tpr"]) == (1.0, 1.0)
