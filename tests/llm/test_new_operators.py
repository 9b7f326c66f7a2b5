"""Line dedup, lexical search, tokenizer alignment: against SQL and plain Python versions."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from scanlens.llm import catalog, crosstok, lexical, lines

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _plain_lines(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """Rows of (key, n_lines, n_dropped, kept)."""
    order = lambda i: (i is None, i or 0)
    low: dict[str, tuple] = {}
    cut = [(i, [(line, _lower(line.strip(lines.BLANKS))) for line in (t or "").split("\n")]) for i, t in rows]
    for i, own in cut:
        for _, key in own:
            if len(key) >= lines.LEAST_CHARS:
                low[key] = min(low.get(key, order(i)), order(i))
    out = []
    for i, own in cut:
        kept = [line for line, key in own if len(key) < lines.LEAST_CHARS or low[key] == order(i)]
        out.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def _sorted(rows) -> list:
    return sorted(rows, key=repr)


def _got_lines(frame) -> list:
    return _sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in lines.dedup_lines(frame).select("doc_id", "n_lines", "n_dropped", "kept_text").collect())


def test_lines_against_plain_version(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert _got_lines(docs) == _sorted(_plain_lines(rows))


def test_lines_odd_rows(spark, odd, none, clashing):
    extra = [
        (20, "A LONG LINE here\n\tA long line HERE \r\nshort\nÉcole LONGUE ligne\n"),
        (21, "x\na long line here\nÉCOLE longue ligne\nécole longue ligne\n\n"),
        (None, "a long line here\nown line without an id\nown line without an id"),
        (22, "\n".join(f"line number {i % 3000}" for i in range(20_000)) + "\nA long line here"),
        (23, "\n".join(f"line number {i}" for i in range(3000))),
        (20, "another text of one id\na long line here"),
        (24, "\n" * 200 + "a long line here" + "\n" * 200),
        (25, "漢字" * 5 + "　\n" + "a long line here"),
    ]
    frame = odd.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    plain = _plain_lines([(r.doc_id, r.text) for r in frame.collect()])
    assert _got_lines(frame) == _sorted(plain)
    mixed = clashing.withColumns({c: F.lit(7) for c in ("late", "pos", "h", "g", "keep", "bits", "word", "__x")})
    out = lines.dedup_lines(mixed)
    assert out.count() == odd.count() and set(mixed.columns) <= set(out.columns)
    assert lines.dedup_lines(none).count() == 0 and lines.line_digests(none).count() == 0


def test_hot_lines_take_the_aggregate(spark, monkeypatch):
    rows = [(i, f"the line of everyone\nown line number {i}\nthe line of everyone") for i in range(400, 0, -1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    plain = _sorted(_plain_lines(rows))
    assert lines._hot(lines._lines(frame, "doc_id", "text", 10)) is None
    assert _got_lines(frame) == plain
    monkeypatch.setattr(lines, "HOT_ROWS", 100)
    assert lines._hot(lines._lines(frame, "doc_id", "text", 10)).count() == 1
    assert _got_lines(frame) == plain


def test_lines_use_no_python(spark, docs):
    plan = lines.line_digests(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "sha2" in plan


def _plain_search(rows, items, top=10) -> list[tuple]:
    words = {k: Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lower(t or ""))) for k, (_, t) in enumerate(rows)}
    words = {k: c for k, c in words.items() if c}
    n_docs, total = len(words), sum(c.total() for c in words.values())
    df = Counter(w for c in words.values() for w in c)
    out = []
    for item, text in items:
        scored = []
        asked = set(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", _lower(text or "")))
        for k, c in words.items():
            m = 10 + 90 * c.total() * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in asked if c[w])
            if s > 0:
                scored.append((-s, rows[k][0] is None, rows[k][0] or 0))
        out += [(item, r + 1, None if void else i, -s) for r, (s, void, i) in enumerate(sorted(scored)[:top])]
    return out


def test_search_with_small_buckets(spark, docs, folder, monkeypatch):
    """Buckets, thresholds and blocks of items change nothing."""
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    want = _sorted(_plain_search(rows, asked))
    for bucket, head, block in ((2048, 4096, 16 << 20), (3, 5, 6000), (17, 40, 16 << 20)):
        for name, value in (("BUCKET", bucket), ("HEAD", head), ("BLOCK_BYTES", block)):
            monkeypatch.setattr(lexical, name, value)
        assert _sorted(map(tuple, lexical.search(docs, items).collect())) == want


def test_search_odd_rows(spark, odd, none, clashing):
    asked = [("a", "Quick FOX, dog!"), ("a", "word1 other7 zzz"), ("b", None), ("c", ""), (None, "a row without an id"), ("d", "nowhere_at-all1"), ("e", "漢字 ä🙂漢字")]
    items = spark.createDataFrame(asked, "item_id string, text string").withColumn("rank", F.lit("clash"))
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = lexical.search(clashing.withColumns({c: F.lit(1) for c in ("q", "term", "tf", "n", "rank", "tie", "length")}), items)
    assert _sorted(map(tuple, got.collect())) == _sorted(_plain_search(rows, asked))
    assert lexical.search(none, items).count() == 0 and lexical.search(odd, items.limit(0)).count() == 0
    ties = spark.createDataFrame([(i, "same words in every text") for i in range(500, 0, -1)], "doc_id long, text string").union(odd.select("doc_id", "text"))
    best = lexical.search(ties, spark.createDataFrame([(1, "words every")], "item_id int, text string")).orderBy("rank").collect()
    assert [r.doc_id for r in best] == list(range(1, 11)) and [r["rank"] for r in best] == list(range(1, 11))


def test_survivors_hold_every_document_at_the_threshold():
    import numpy as np
    import pyarrow as pa

    draw = np.random.default_rng(4)
    for _ in range(40):
        n, width = int(draw.integers(1, 60)), 12
        dense = draw.integers(1, 10**9, (n, width)) * (draw.random((n, width)) < 0.3)
        row, at = np.nonzero(dense)
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (at.astype(np.int32), dense[row, at])]
        b = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(np.sqrt((dense.astype(float) ** 2).sum(1))), *lists], names=["id", "length", "term", "impact"])
        query = np.sort(draw.choice(width + 3, 5, replace=False)).astype(np.int32)
        score = dense[:, query[query < width]].sum(1)
        for least in (1, int(np.median(score)), int(score.max()) or 1, int(score.max()) + 1):
            rows, exact = lexical._Bucket(b).survivors(query, least)
            assert (exact == score[rows]).all() and {*np.flatnonzero((score >= least) & (score > 0))} <= {*rows}


def _plain_alignment(rows):
    """Loops over groups, with the tokenizer library itself."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A_FILE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B_FILE)
    known = crosstok._byte_of()
    found, held = [], Counter()
    for i, text in rows:
        groups = []
        if text:
            a = first.encode(" " + text, add_special_tokens=False).ids
            b = second.encode(text)
            bytes_a = [bytes(known[c] for c in first.id_to_token(x)) for x in a]
            bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(x) else p.replace("▁", " ").encode() for x in b for p in [second.id_to_piece(x)]]
            if b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
                k = at_a = at_b = 0
                own_a, own_b = [], []
                for x, raw in zip(a, bytes_a, strict=True):
                    own_a.append(x)
                    at_a += len(raw)
                    while at_b < at_a:
                        own_b.append(b[k])
                        at_b += len(bytes_b[k])
                        k += 1
                    if at_a == at_b:
                        groups.append((own_a, own_b))
                        own_a, own_b = [], []
        found.append((i, groups))
        held.update({(x, y) for p, q in groups for x in p for y in q})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for i, groups in found:
        links = [(x, y) for p, q in groups for x in p for y in q]
        said = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((i, sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), len(links), sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links), hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return out, held


@pytest.fixture(scope="module")
def strange(spark, odd):
    extra = [(30, "<|endoftext|> and </s> <unk> <0x41>"), (31, "a▁b"), (32, "naïve café 🙂🙂 漢字かな\t\ttabs  and   blanks \n\n"), (33, "x" * 3000), (34, "あ" * 700), (35, "🙂" * 500), (36, " "), (37, "\n"), (38, "don't DON'T 12345 ½    end "), (39, "\u0000\u0001�"), (40, " " * 300_000 + "end")]
    return odd.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))


def test_alignment_against_plain_version(docs, strange):
    for frame in (docs, strange):
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        want, held = _plain_alignment(rows)
        got, counts = crosstok.align_documents(frame, A_FILE, B_FILE)
        names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert _sorted(tuple(r[c] for c in names) for r in got.collect()) == _sorted(want)
        assert {(r.pair >> 32, r.pair & 0xFFFFFFFF): r["count"] for r in counts.collect()} == held


def test_alignment_without_broadcast(strange, monkeypatch):
    from scanlens.llm import common

    want = _sorted(map(tuple, crosstok.alignment_measures(strange, A_FILE, B_FILE).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    assert _sorted(map(tuple, crosstok.alignment_measures(strange, A_FILE, B_FILE).collect())) == want


def test_pairs_in_parts(docs, strange):
    aligner = crosstok.Aligner(*(open(p, "rb").read() for p in (A_FILE, B_FILE)))
    for r in [*docs.limit(30).collect(), *strange.collect()]:
        if found := aligner.align(r.text):
            (pair, times), *rest = found.pairs()
            parts = list(found.pairs(50))
            assert not rest and times.sum() == found.links
            assert sorted(zip(*(x.tolist() for x in (pair, times)), strict=True)) == sorted(p for own in parts for p in zip(*(x.tolist() for x in own), strict=True))


def test_alignment_odd_rows(spark, none, clashing, strange):
    mixed = clashing.withColumns({c: F.lit(7) for c in ("h", "g", "pair", "copies", "n_a", "count_sum")})
    assert crosstok.alignment_measures(mixed, A_FILE, B_FILE).count() == clashing.count()
    assert crosstok.alignment_measures(none, A_FILE, B_FILE).count() == 0
    by = {r.doc_id: r for r in crosstok.alignment_measures(strange, A_FILE, B_FILE).collect()}
    assert all(by[i].n_a == by[i].n_links == by[i].count_sum == 0 and by[i].groups_sha256 == "" for i in (2, 3, 31))
    groups = {r.doc_id: r for r in crosstok.aligned_groups(strange.where("doc_id >= 30"), A_FILE, B_FILE).collect()}
    assert len(groups[32].a) == len(groups[32].b) == by[32].n_groups and sum(map(len, groups[32].a)) == by[32].n_a and groups[31].a == []


def test_ranks_and_library_give_one_encoding(docs):
    side = crosstok.ByteLevel(open(A_FILE, "rb").read())
    assert side.ranks is not None
    for t in [r.text for r in docs.limit(60).collect() if r.text] + ["<|endoftext|>", "it's 9's  \x1c\x85 x", "　　 a", "İıſ ﬁ"]:
        assert side.encode(t).tolist() == side.library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["op11_line_dedup", "op12_lexical_search"])
def test_new_queries_match_sql(spark, folder, name):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    from check_catalog import connect, difference

    assert difference(catalog.LLM_QUERIES[name](spark, folder), connect(folder), catalog.LLM_ORACLES[name]) is None
