from __future__ import annotations

import random

import pytest

from scanlens.llm import setjoin as j


def _components(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    low = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]) and low[b] < low[a]:
                    low[a], changed = low[b], True
    return {i: (len(sets[i]), low[i]) for i in texts}


def _corpus(seed: int, n: int = 60) -> dict[int, str | None]:
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [draw.choice(words) for _ in range(40)]
    base = [[draw.choice(words) for _ in range(draw.randint(1, 80))] for _ in range(12)]
    out: dict[int, str | None] = {}
    for i in range(n):
        w = list(draw.choice(base))
        for _ in range(draw.randint(0, 3)):
            w[draw.randrange(len(w))] = draw.choice(words)
        if draw.random() < 0.3:
            w = passage + w
        out[i * 3] = draw.choice([" ", "\n\t"]).join(x.upper() if draw.random() < 0.2 else x for x in w)
    out |= {1000: None, 1001: "", 1002: "  ", 1003: "a b", 1004: "A  b", 1005: "b a"}
    return out


@pytest.mark.parametrize(("seed", "crowded", "block", "pivots"), [(1, 64, 512, 8), (2, 3, 4, 8), (3, 2, 5, 0)])
def test_against_brute_force(spark, monkeypatch, seed, crowded, block, pivots):
    """Also with crowded shingles, cut buckets, and without any pivot, so the trees find every link."""
    monkeypatch.setattr(j, "CROWDED", crowded)
    monkeypatch.setattr(j, "BLOCK", block)
    monkeypatch.setattr(j, "PIVOTS", pivots)
    texts = _corpus(seed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.link_groups(docs).collect()}
    assert got == _components(texts)


def test_trees_lose_no_link():
    draw = random.Random(9)
    sets = [j.shingles(t) for t in _corpus(4, 120).values() if t and t.split()]
    rows = [(i, i, len(s), j.bitmap(s)) for i, s in enumerate(sets)]
    draw.shuffle(rows)
    want = {(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets)) if j.similar(sets[a], sets[b])}
    found = list(j.pairs_of(rows))
    assert len(found) == len(set(found)) and want <= set(found) and len(found) < len(sets) * (len(sets) - 1) / 2
    first = {r[0] for r in rows[:50]}
    across = {p for p in want if (p[0] in first) != (p[1] in first)}
    assert across <= set(j.pairs_of(rows[:50], rows[50:]))


def test_many_near_copies_leave_few_pairs(spark, monkeypatch):
    """Copies of one text, half of them too far from the others to link: pairs grow with the copies, not with their square."""
    draw = random.Random(11)
    base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    texts = {}
    for i in range(500):
        w = list(base)
        for k in draw.sample(range(len(w)), draw.randint(1, 7)):
            w[k] = f"v{draw.randrange(10**6)}"
        texts[i] = " ".join(w)
    counts = []

    def counted(*args):
        pairs = found(*args).localCheckpoint()
        counts.append(pairs.count())
        return pairs

    found = j._bucket_pairs
    monkeypatch.setattr(j, "_bucket_pairs", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.link_groups(docs).collect()}
    assert got == _components(texts)
    assert counts[0] < 10 * len(texts)


@pytest.mark.parametrize(("gap", "linked"), [(3, True), (4, False)])
def test_crowded_buckets_leave_few_pairs(spark, monkeypatch, gap, linked):
    """Copies on both sides of the limit that no pivot has grouped: neither links nor near misses leave pairs by the square."""
    monkeypatch.setattr(j, "PIVOTS", 0)
    draw = random.Random(13)
    base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    texts = {}
    for i in range(400):
        w = list(base)
        at = draw.randrange(4, 140)
        w[at], w[at + gap] = f"v{i}", f"u{i}"
        texts[i] = " ".join(w)
    sets = [j.shingles(texts[i]) for i in range(12)]
    assert (sum(j.similar(a, b) for a in sets for b in sets) > 100) == linked
    counts = []

    def counted(*args):
        pairs = found(*args).localCheckpoint()
        counts.append(pairs.count())
        return pairs

    found = j._bucket_pairs
    monkeypatch.setattr(j, "_bucket_pairs", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in j.link_groups(docs).collect()}
    assert got == _components(texts)
    assert 0 < counts[0] < 10 * len(texts)


def test_joined_groups_stay_joined():
    above: dict[int, int] = {}
    for a, b in [(1, 2), (3, 4), (2, 4), (5, 1)]:
        above[j._top(above, a)] = j._top(above, b)
    assert len({j._top(above, x) for x in range(1, 6)}) == 1 and j._top(above, 6) == 6


def test_buckets_hold_only_rows_that_can_link(spark, monkeypatch):
    """Sets that share a token far from the start of both reach no one by it; a row far from its start needs a smaller set."""
    sent = {}

    def spied(df, purpose):
        out = keep(df, purpose)
        sent[purpose] = out.count()
        return out

    keep = j.written
    monkeypatch.setattr(j, "written", spied)
    words = [" ".join(f"x{i}w{k}" for k in range(104)) for i in range(4)]
    reps = spark.createDataFrame(list(enumerate(words)), "node long, text string")
    nodes = spark.createDataFrame([(i, 100, j.bitmap(j.shingles(w))) for i, w in enumerate(words)], "node long, n long, sig binary")

    def met(rows):
        j._bucket_pairs(spark.createDataFrame([(t, at, n, k, k) for t, at, n, k in rows], "token long, at int, n int, node long, group long"), nodes, reps)
        return sent["met"]

    assert met([(7, 15, 100, 0), (7, 18, 100, 1)]) == 0
    assert met([(7, 15, 100, 0), (7, 3, 100, 1)]) == 0
    assert met([(7, 15, 100, 0), (7, 3, 85, 1)]) == 2
    assert met([(7, 15, 100, 0), (7, 3, 85, 1), (7, 20, 100, 2), (8, 2, 100, 0), (8, 2, 100, 2), (8, 9, 100, 3)]) == 5


def test_rows_of_linked_pairs_live(spark):
    """At the first token that a linked pair shares both its rows are kept, whatever else is in the bucket."""
    draw = random.Random(17)
    sets = []
    for _ in range(40):
        base = draw.sample(range(3000), draw.randint(3, 120))
        for _ in range(4):
            sets.append(sorted(set(draw.sample(base, len(base) - draw.randint(0, len(base) // 7)) + draw.sample(range(3000), draw.randint(0, 3)))))
    rows = [(t, at, len(s), i, i) for i, s in enumerate(sets) for at, t in enumerate(s[: j.prefix_length(len(s))])]
    kept = {(r.token, r.node) for r in j._living(spark.createDataFrame(rows, "token long, at int, n int, node long, group long")).collect()}
    linked = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]})]
    assert len(linked) > 30 and len(kept) < len(rows)
    for a, b in linked:
        first = min({*sets[a]} & {*sets[b]})
        assert (first, a) in kept and (first, b) in kept


def test_odd_rows(spark, odd, none, clashing):
    rows = j.link_groups(clashing).collect()
    assert len(rows) == odd.count()
    by = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert by[8, 7] == 1 and by[2, 0] == 2 and by[3, 0] == 3 and by[4, 0] == 4
    kept = j.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted(((r.doc_id or 0, r.text or "")[0] for r in kept.collect()))
    assert ids == [0, 0, 1, 2, 3, 4, 5, 6, 7]
    assert j.link_groups(none).count() == 0 and j.one_of_each(none).count() == 0
