from __future__ import annotations

import random

from scanlens.llm import decontaminate as d


def _brute(text: str, items: dict[str, str], window: int) -> tuple[int, set[int], set[str]]:
    words = d.WORD.findall(text.translate(d.LOWER))
    hit, found = set(), set()
    for item, body in items.items():
        own = d.WORD.findall(body.translate(d.LOWER))
        for i in range(max(1, len(own) - window + 1)) if own else ():
            w = own[i : i + window]
            for j in range(len(words) - len(w) + 1):
                if words[j : j + len(w)] == w:
                    hit |= set(range(j, j + len(w)))
                    found.add(item)
    return len(words), hit, found


def test_against_brute_force(spark, monkeypatch):
    draw = random.Random(1)
    word = lambda: draw.choice(["a", "B", "ä", "c1", "dd"])
    items = {str(i): draw.choice([" ", "-"]).join(word() for _ in range(draw.randint(0, 8))) for i in range(30)}
    texts = [draw.choice([" ", ".\n"]).join(word() for _ in range(draw.randint(0, 60))) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id string, text string")
    for block in (d.BLOCK_BYTES, 200):  # one automaton, and several passes
        monkeypatch.setattr(d, "BLOCK_BYTES", block)
        for r in d.find_items(docs, bench, window=4).collect():
            n, hit, found = _brute(r.text, items, 4)
            assert (r.n_words, r.n_hit, set(r.found_items)) == (n, len(hit), found)
            inside = [any(s.start <= m.start() and m.end() <= s.end for s in r.hit_spans) for m in d.WORD.finditer(r.text.translate(d.LOWER))]
            assert {i for i, x in enumerate(inside) if x} == hit
        for r in d.contamination(docs, bench, window=4).collect():
            assert r.items_sha256 == d.digest_of(list(_brute(texts[r.doc_id], items, 4)[2]))


def test_odd_rows(spark, odd, none, clashing):
    bench = spark.createDataFrame([(None, "quick brown fox"), (7, None), (8, "")], "item_id long, text string")
    rows = d.find_items(clashing, bench).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id for r in rows if r.n_hit} == {1, 8}
    assert set(d.clean_documents(odd, bench).columns) == set(odd.columns)
    assert d.clean_documents(odd, bench).count() == odd.count() - 3
    assert d.contamination(none, bench).count() == 0
    assert d.contamination(odd, bench.limit(0)).where("contaminated").count() == 0
