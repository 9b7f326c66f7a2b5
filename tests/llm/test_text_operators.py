"""Substring dedup, fingerprints, shards, URL rules: against plain Python versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanlens.llm import fingerprints, shards, spans, urlrules
from scanlens.llm.common import joined, word_hashes


def _plain_pieces(words: list[str], sentence: list[int]) -> list[int]:
    """First words of the pieces, place by place."""
    raw = [np.frombuffer(w.encode(), np.uint8) for w in words]
    h = [word_hashes(x, np.array([0]), np.array([len(x)]))[0] for x in raw]
    pair = [int(joined(np.array([x], np.uint64), np.array([y], np.uint64))[0]) for x, y in zip(h, [*h[1:], 0], strict=False)]
    cuts = {i for i in range(len(words)) if i == 0 or sentence[i] != sentence[i - 1]}
    for k in range(len(words) - spans.PIECE + 1):
        row = pair[k : k + spans.PIECE]
        cuts |= {k + j for j, x in enumerate(row) if x == min(row) and sentence.count(sentence[k + j]) > spans.PIECE}
    return sorted(cuts)


def _repeats(docs: list[tuple[int, str]], least: int) -> dict[int, str]:
    """Place by place: a run is removed where the same words were a run before."""
    seen: dict[str, tuple[int, int, int]] = {}
    out = {}
    for i, text in sorted(docs):
        own = spans.sentences(text)
        places = [(a + x, a + y, k) for k, (a, b) in enumerate(own) for x, y in spans.word_spans(text[a:b])]
        words = [text[x:y].lower() for x, y, _ in places]
        cuts = _plain_pieces(words, [k for *_, k in places])
        gone: set[int] = set()
        for first in cuts:
            end = next((e for e in [*cuts, len(words)] if e - first >= least), None)
            if end is not None:
                stop = next(e for e in range(end, len(words) + 1) if e == len(words) or places[e][2] != places[e - 1][2])
                end = stop if stop - end <= spans.PIECE else end
                where = seen.setdefault(" ".join(words[first:end]), (i, first, end))
                if where != (i, first, end):
                    gone |= set(range(max(first, where[2]) if where[0] == i else first, end))
        kept = []
        for k, (a, b) in enumerate(own):
            mine = [n for n, (*_, s) in enumerate(places) if s == k]
            left = [n for n in mine if n not in gone]
            if len(left) == len(mine):
                kept.append(text[a:b])
            elif left:
                ends = [places[n + 1][0] if n + 1 in mine else b for n in mine]
                parts = [text[places[n][0] if n != mine[0] else a : ends[j]] for j, n in enumerate(mine) if n not in gone]
                if mine[-1] in gone:
                    parts[-1] = parts[-1].rstrip() if text[places[mine[-1]][1] : b] else parts[-1]
                    parts.append(text[places[mine[-1]][1] : b])
                kept.append("".join(parts))
        out[i] = "".join(kept).rstrip() if len(words) - 1 in gone else "".join(kept)
    return out


def test_substring_dedup_against_brute_force(spark):
    draw = random.Random(2)
    pool = [" ".join(draw.choice("abcdefgh") * 2 for _ in range(draw.randint(1, 9))).capitalize() + draw.choice([". ", "! ", ".\n"]) for _ in range(60)]
    docs = [(i, "".join(draw.choice(pool) for _ in range(draw.randint(0, 9)))) for i in range(50)]
    passage = "".join(pool[:6])
    docs += [(100 + k, f"Own start {k}. {passage}Own end {k}.") for k in range(8)]
    docs += [(200 + k, " ".join(draw.choice(["and", f"w{draw.randrange(40)}", "stop.", "über"]) for _ in range(150)) + "\n") for k in range(12)]
    docs += [(220 + k, f"Word {k} " + docs[-3][1][40 * k :] + "。漢字漢字" * 9) for k in range(5)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in spans.remove_repeats(frame, least=10).collect()}
    assert got == _repeats(docs, 10)
    assert got[100] == docs[50][1] and got[107] == "Own start 7. Own end 7."


def test_substring_dedup_odd_rows(odd, none, clashing):
    rows = spans.remove_repeats(clashing).collect()
    assert len(rows) == odd.count()
    assert all(r.kept_text is None for r in rows if r.doc_id == 2)
    assert spans.deduplicated(odd).columns == odd.columns and spans.deduplicated(none).count() == 0
    twice = [r for r in rows if r.doc_id == 5]
    assert twice[0].kept_text == twice[1].kept_text


def test_fingerprints_of_edited_texts(spark, docs):
    rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprints.edited_likeness(docs).collect()}
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(rows):
        half, following = len(text) // 2, rows[(k + 1) % len(rows)][1]
        edited = text[: len(text) - half] + following[:half]
        a, b, c = (fingerprints.signature(t) for t in (text, edited, following))
        r = got[i]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(text)
        assert (r.fingerprint, r.edited_fingerprint) == tuple(x.astype(">u4").tobytes().hex() for x in (a, b))
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(a, b), fingerprints.likeness(a, c))


def test_sketches_are_ordered_minima():
    text = " ".join(random.Random(4).choice(["aa", "bb", "cc", "dd"]) for _ in range(fingerprints.BLOCK * 2 + 77))
    row = fingerprints.kmers(text)
    count: Counter = Counter()
    base = []
    for h in row:
        base.append(fingerprints._mix(np.array([h + np.uint64(count[h]) * np.uint64(0x9E3779B97F4A7C15)], np.uint64))[0])
        count[h] += 1
    base = np.array(base)
    assert (base == fingerprints.numbered(row)).all()
    sig = fingerprints.signature(text)
    for s in (0, 13, 63):
        h = (base ^ fingerprints._XOR[s]) * fingerprints._MUL[s]
        out = np.zeros(1, np.uint64)
        for k, place in enumerate(np.sort(np.argsort(h, kind="stable")[: fingerprints.KEPT])):
            out = fingerprints._mix(out + row[place] * fingerprints._PLACE[fingerprints.K + k])
        assert sig[s] == out[0] >> np.uint64(32)


def test_fingerprints_fall_with_edits_and_order():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    text = " ".join(words)
    sig = fingerprints.signature(text)
    near = [fingerprints.likeness(sig, fingerprints.signature(" ".join(draw.choice(words) if draw.random() < p else w for w in words))) for p in (0.01, 0.1, 0.5)]
    assert 1 > near[0] > near[1] > near[2]
    assert fingerprints.likeness(sig, fingerprints.signature(" ".join(words[150:] + words[:150]))) < 0.8
    assert fingerprints.likeness(sig, fingerprints.signature(text)) == 1


def test_fingerprints_odd_rows(spark, odd, none, clashing):
    rows = fingerprints.edited_likeness(clashing).collect()
    assert len(rows) == odd.count()
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 8)}) == 1
    assert fingerprints.edited_likeness(none).count() == 0
    lone = fingerprints.edited_likeness(spark.createDataFrame([(4, "a b c d")], "doc_id long, text string")).collect()
    assert lone[0].near_next == 1 and fingerprints.fingerprints(odd).count() == odd.count()


def _check_shards(rows, texts, n=16):
    assert len(rows) == len(texts)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sizes = [sum(r["size"] for r in by[k]) for k in range(n)]
    largest = max((r["size"] for r in rows), default=0)
    total = sum(sizes)
    assert max(sizes) - min(sizes) <= 2 * largest + 0.02 * total / n + 2
    got = Counter((r.doc_id, r["size"], r.text_crc32) for r in rows)
    assert got == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)


def test_shards_are_even_and_gapless(spark, docs):
    _check_shards(shards.shard_documents(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    copies = [(i, "one text, many times" if i % 3 else f"text {i} " * (i % 7)) for i in range(3000)]
    frame = spark.createDataFrame(copies, "doc_id long, text string")
    rows = shards.shard_documents(frame).collect()
    _check_shards(rows, copies)
    assert len({r.shard for r in rows if r["size"] == 21}) > 5  # a crowded group goes over several shards


def test_shards_odd_rows(odd, none, clashing):
    rows = shards.shard_documents(clashing).collect()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((r.doc_id, len((r.text or "").encode()) + 1) for r in odd.collect())
    assert shards.shard_documents(none).count() == 0


def _judge(url: str | None, rules) -> tuple[str, str, str | None, str]:
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c < "\x80" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.mark.parametrize("broadcast", [True, False])
def test_url_rules_against_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(urlrules, "BROADCAST_BYTES", -1)
    draw = random.Random(6)
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("a.b", "", "block"), ("b", "/xy", "allow"), ("b", "/xyz", "block")]
    urls: list[str | None] = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/?q", "x://y://z/en/", "http://a.b", "http://q.a.b?x=/en/", "http://com/", "http://xcom/", "http://b/xyzz#/", "http://Ä.b/xy\n/"]
    part = ["com", "example.com", "www.example.com", "net", "b", "a.b", "org"]
    urls += [f"https://{draw.choice(['', 'm.'])}{draw.choice(part)}{draw.choice(['', '/', '/en/', '/en', '/es/1', '/xyz', '/xy?a', '#/en/'])}" for _ in range(150)]
    pages = spark.createDataFrame([*enumerate(urls), (0, None), (4, urls[4])], "page_id long, url string")
    frame = spark.createDataFrame([*rules, (None, "/", "block"), ("q", None, "block")], "host string, path string, verdict string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlrules.judge_urls(pages, frame).collect()), key=repr)
    assert got == sorted(((i, *_judge(u, rules)) for i, u in [*enumerate(urls), (0, None), (4, urls[4])]), key=repr)
    assert urlrules.judge_urls(pages.limit(0), frame).count() == 0
    extra = pages.withColumns({c: F.lit(7) for c in ("row", "key", "host", "path", "rule", "verdict", "digest", "prefix", "h", "p", "cuts")})
    assert urlrules.judge_urls(extra, frame).count() == pages.count()
    long = spark.createDataFrame([(1, "http://" + "a." * 100_000 + "b/xy"), (2, "http://b" + "/xyz" * 50_000)], pages.schema)
    assert [(r.page_id, r.verdict) for r in urlrules.judge_urls(long, frame).orderBy("page_id").collect()] == [(1, "allow"), (2, "block")]
    assert urlrules.judge_urls(pages, frame.limit(0)).where("rule is not null").count() == 0


def _second_windows(before: list[tuple[int, str]], after: dict[int, str]) -> list[tuple[int, str]]:
    """Rows of 50 words that stay where an earlier place keeps them too."""
    seen: dict[str, int] = {}
    found = []
    for i, _ in sorted(before):
        words = [after[i][a:b].lower() for a, b in spans.word_spans(after[i])]
        for k in range(len(words) - 49):
            row = " ".join(words[k : k + 50])
            if seen.setdefault(row, i) != i:
                found.append((i, row))
    return found


def test_no_window_of_fifty_words_stays_twice(spark):
    draw = random.Random(12)
    fresh = lambda n: [f"w{draw.randrange(10**9)}" for _ in range(n)]
    cut = [*fresh(22), "one.", *fresh(18), "two!", *fresh(22)]  # begins and ends inside sentences
    clean = " ".join([*fresh(29), "end.", *fresh(23), "stop."])
    bare = fresh(60)
    han = "".join(chr(0x4E00 + draw.randrange(8000)) for _ in range(60)) + "。" + "".join(chr(0x4E00 + draw.randrange(8000)) for _ in range(40)) + "。"
    blob = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(2500))
    docs = []
    for k in range(6):
        docs.append((k, " ".join([*fresh(9), "x.", *fresh(k + 3), *cut, *fresh(5), "z."])))
        docs.append((10 + k, f"{' '.join(fresh(8))}. {clean} {' '.join(fresh(8))}."))
        docs.append((20 + k, " ".join([*fresh(k + 40), *bare, *fresh(40)])))
        docs.append((30 + k, chr(0x3042 + k) * 5 + han + chr(0x3052 + k) * 5))
        docs.append((40 + k, "q" * k + blob + "r" * k))
    docs += [(60, " ".join(["a", "b"] * 200)), (61, "short text. " * 3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r.doc_id: r for r in spans.remove_repeats(frame).collect()}
    after = {i: r.kept_text for i, r in rows.items()}
    assert _second_windows(docs, after) == []
    assert all(after[i] == docs_text for i, docs_text in docs if i in (0, 10, 20, 30, 40))  # first places are whole
    for k in range(1, 6):
        assert not set(clean.split()) & set(after[10 + k].split())  # a cleanly cut passage goes whole
        for i, passage in ((k, cut), (20 + k, bare)):
            text = dict(docs)[i]
            assert sum(w in passage for w in after[i].split()) <= 4 * spans.PIECE
            assert [w for w in text.split() if w not in passage] == [w for w in after[i].split() if w not in passage]
    assert after[60].split() == ["a", "b"] * (len(after[60].split()) // 2) and len(after[60].split()) < 2 * spans.RUN_WORDS
    assert rows[61].n_removed == 0  # too short for a run


def test_a_run_leaves_its_own_first_place(spark):
    draw = random.Random(3)
    line = [f"w{draw.randrange(10**9)}" for _ in range(30)]
    frame = spark.createDataFrame([(1, " ".join(line * 6))], "doc_id long, text string")
    kept = spans.remove_repeats(frame).first().kept_text.split()
    assert kept[:30] == line and len(kept) < 100


def test_few_different_words_are_found_too(spark):
    """A passage of ten different words, cut inside its sentences, does not stay twice."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(10)]
    passage = [draw.choice(words) for _ in range(200)]
    docs = [(k, " ".join([*(f"own{k}_{j}" for j in range(20 + k)), *passage, *(f"end{k}_{j}" for j in range(30))])) for k in range(4)]
    rows = spans.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert _second_windows(docs, {r.doc_id: r.kept_text for r in rows}) == []


def test_documents_without_a_shared_passage_lose_their_own_repeats_only(docs):
    """What clean documents lose are runs that they hold twice themselves."""
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    words = {i: [t[a:b].lower() for a, b in spans.word_spans(t)] for i, t in text.items()}
    holders: dict[str, set[int]] = defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - spans.RUN_WORDS + 1):
            holders[" ".join(w[k : k + spans.RUN_WORDS])].add(i)
    shared = {i for own in holders.values() if len(own) > 1 for i in own}
    lost = {r.doc_id for r in spans.remove_repeats(docs).collect() if r.n_removed}
    for i in lost - shared:
        rows = Counter(" ".join(words[i][k : k + spans.RUN_WORDS]) for k in range(len(words[i]) - spans.RUN_WORDS + 1))
        assert rows.most_common(1)[0][1] > 1


def test_word_tables_agree_with_spans(docs, odd):
    """The fast way and the plain way find the same words and sentences."""
    texts = [r.text or "" for r in [*docs.collect(), *odd.collect()]]
    texts += ["A b.\nC  d! e? f\x1cg", "\n\n x\ty.z \n", " . ! ", "İstanbul ΑΣ. ß\u00a0x", "漢字。漢！ a b。c", "x" * 65 + " y. z", "é" * 40 + " end. É b"]
    for t in texts:
        own = [[t[x + a : y + a].lower() for x, y in spans.word_spans(t[a:b])] for a, b in spans.sentences(t)]
        own = [w for w in own if w]
        h, starts = spans.word_table(t)
        words = [w for s in own for w in s]
        assert starts.tolist() == [sum(map(len, own[:k])) for k in range(len(own))] and len(h) == len(words)
        for w, x in zip(words, h, strict=True):
            raw = np.frombuffer(w.encode(), np.uint8)
            assert word_hashes(raw, np.array([0]), np.array([len(raw)]))[0] == x


def test_cells_of_runs_of_either_sign_are_marked(spark):
    """The bitmap takes upper halves of hashes; runs are whole ones, half of them negative."""
    passage = [" ".join(f"w{k}x{i}" for i in range(30)) + "." for k in range(12)]
    h = np.concatenate([spans.runs(p)[2] for p in passage]).view(np.int64)
    assert h.min() < 0 < h.max()
    rows = [(i, p) for p in passage for i in (1, 2)]
    docs = spark.createDataFrame([(i, " ".join(p for j, p in rows if j == i)) for i in (1, 2)], "doc_id long, text string")
    kept = {r["doc_id"]: (r["n_sentences"], r["n_removed"], r["kept_text"]) for r in spans.remove_repeats(docs).collect()}
    assert kept == {1: (12, 0, " ".join(passage)), 2: (12, 12, "")}
