"""Language ID against a plain version of fit, likelihood, priors and fusion."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from scanlens.llm import language as g


def _plain_cells(text: str) -> list[int]:
    raw = f" {text.lower()} ".encode()
    return [((a * 0x9E3779B1 + b * 0x85EBCA6B + c * 0xC2B2AE35) % 2**32) >> 17 for a, b, c in zip(raw, raw[1:], raw[2:], strict=False)]


def _plain(rows: list[dict]) -> list[tuple]:
    """(language, confidence, accepted) of every row; all texts are few enough to be counted whole."""
    texts = defaultdict(set)
    for r in rows:
        said = (r["lang"] or "").strip(" ").lower()
        if r["text"] is not None and said:
            texts[said].add(r["text"])
    names = sorted(k for k, own in texts.items() if len(own) >= g.LEAST_ROWS)
    k = len(names) + 1
    table = np.ones((g.CELLS, k))
    for i, name in enumerate(names):
        for t in texts[name]:
            for c in _plain_cells(t):
                table[c, i] += 1
    table = np.log(table / table.sum(0)).astype(np.float32).astype(float)
    ll = [g.WEIGHT * sum((table[c] for c in _plain_cells(r["text"] or "")), np.zeros(k)) for r in rows]
    flat = np.log([*[(1 - g.OTHER) / max(1, k - 1)] * (k - 1), g.OTHER])
    p = [np.exp(x + flat - max(x + flat)) for x in ll]
    p = [x / x.sum() for x in p]
    hosts, whole = defaultdict(lambda: np.zeros(k)), np.zeros(k)
    law = np.zeros((k, k))
    for r, x in zip(rows, p, strict=True):
        hosts[(r["source"] or "").lower()] += x
        whole += x
        if said := (r["lang"] or "").strip(" ").lower():
            law[names.index(said) if said in names else k - 1] += x
    base = (whole + 1 / k) / (whole.sum() + 1)
    suffix = (whole + g.STRENGTH * base) / (whole.sum() + g.STRENGTH)
    for i in range(k):
        prior = np.full(k, (1 - g.TRUST) / max(1, k - 1))
        prior[i] = g.TRUST
        law[:, i] = (law[:, i] + g.STRENGTH * prior) / (law[:, i].sum() + g.STRENGTH)
    out = []
    for r, x in zip(rows, ll, strict=True):
        n = hosts[(r["source"] or "").lower()]
        s = x - x.max() + np.log((n + g.STRENGTH * suffix) / (n.sum() + g.STRENGTH))
        if said := (r["lang"] or "").strip(" ").lower():
            s = s + np.log(law[names.index(said) if said in names else k - 1])
        best = int(np.argmax(s))
        c = 1 / np.exp(s - s.max()).sum()
        out.append(([*names, "und"][best], c, best < k - 1 and c >= g.ACCEPT))
    return out


def _compare(frame) -> None:
    rows = [r.asDict() for r in frame.collect()]
    want = sorted(((r["n"], lang, yes), c) for r, (lang, c, yes) in zip(rows, _plain(rows), strict=True))
    got = sorted(((r.n, r.language, r.accepted), r.confidence) for r in g.identify(frame, ["n"], declared=F.col("lang"), host=F.col("source")).collect())
    assert [x for x, _ in got] == [x for x, _ in want]
    assert np.allclose([c for _, c in got], [c for _, c in want], atol=1e-6)


def test_languages_equal_plain_version(docs, odd):
    _compare(docs.withColumn("n", F.monotonically_increasing_id()))
    short = odd.where("length(text) < 1000 or text is null").select(*odd.columns)
    _compare(short.withColumn("n", F.monotonically_increasing_id()))


def test_copies_and_partitions_do_not_change_the_languages(spark, docs):
    rare = spark.createDataFrame([(900_000 + i, f"kolme sanaa {i % 5} tässä", "fi", "x", 1) for i in range(5)] + [(900_100 + i, "samma text", "sv", "x", 1) for i in range(50)], docs.schema)
    whole = docs.select(*rare.columns).union(rare)
    model = g.fit(whole)
    assert "fi" in model.languages and "sv" not in model.languages  # five texts, and one text fifty times
    copies = whole.crossJoin(spark.range(10).select(F.col("id").alias("copy"))).drop("copy").repartition(13)
    again = g.fit(copies)
    assert again.languages == model.languages and np.array_equal(again.table, model.table)


def test_many_languages_leave_a_task_in_parts(spark, monkeypatch):
    rows = [(f"word{lang} text number {i}", f"l{lang:03d}") for lang in range(90) for i in range(6)]
    frame = spark.createDataFrame([*rows, *[(f"few {i}", "few") for i in range(4)]], "text string, lang string").coalesce(1)
    model = g.fit(frame)
    assert model.languages == [f"l{k:03d}" for k in range(90)]
    count = np.exp(model.table[:, 7].astype(float))
    assert np.argmax(count) in {c for i in range(6) for c in _plain_cells(f"word7 text number {i}")}
