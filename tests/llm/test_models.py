"""Language ID, quality, HTML extraction and the pipeline."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanlens.llm import catalog, language, quality, wrapper


def test_languages_of_documents(spark, docs, folder):
    got = {r.doc_id: r for r in catalog.op6_language_id(spark, folder).collect()}
    want = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == len(want)
    assert np.mean([got[i].language == lang for i, lang in want.items()]) > 0.98
    assert np.mean([r.accepted for r in got.values()]) > 0.98


def test_evidence_is_fused(spark):
    model = language.Trigrams(["aa", "bb"], np.log(np.full((language.CELLS, 3), 1 / language.CELLS)).astype(np.float32))
    rows = [(i, "", "aa" if i < 300 else None, "h.aa" if i < 200 else "k.bb", "aa" if i < 200 else "bb") for i in range(400)]
    frame = spark.createDataFrame(rows, "id long, text string, said string, host string, suffix string")
    got = language.identify(frame, ["id"], declared=F.col("said"), host=F.col("host"), suffix=F.col("suffix"), model=model)
    by = {r.id: r for r in got.collect()}
    assert by[0].language == "aa"  # the declaration decides where the text says nothing
    assert by[0].confidence > by[399].confidence


def test_priors_are_smoothed(spark):
    """Counts of a host, its suffix and the corpus, as one would add them up by hand."""
    model = language.Trigrams(["aa", "bb"], np.zeros((language.CELLS, 3), np.float32))
    p = {"h1": [1.0, 0.0, 0.0], "h2": [0.0, 1.0, 0.0]}
    rows = [("h1", "s", None, p["h1"])] * 3 + [("h2", "s", None, p["h2"])]
    frame = spark.createDataFrame(rows, "__host string, __suffix string, __declared string, __p array<double>")
    table, law = language.priors(frame, model)
    k, strength = 3, language.STRENGTH
    base = np.array([(n + 1 / k) / (4 + 1) for n in (3, 1, 0)])
    suffix = (np.array([3, 1, 0]) + strength * base) / (4 + strength)
    got = {r["__host"]: r["__prior"] for r in table.collect()}
    assert np.allclose(got["h1"], (np.array([3, 0, 0]) + strength * suffix) / (3 + strength))
    assert np.allclose(np.sum(law, axis=0), 1)


def test_language_odd_rows(odd, none, clashing):
    got = language.identify(clashing, ["doc_id"], declared=F.col("lang"), host=F.col("source")).collect()
    assert len(got) == odd.count()
    kept = language.accepted_documents(odd)
    assert kept.columns == odd.columns
    assert language.accepted_documents(none).count() == 0
    assert language.identify(none, ["doc_id"], declared=F.col("lang")).count() == 0


def test_quality_on_held_out_rows(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefg") for _ in range(draw.randint(2, 6)))
    rows, labels = [], []
    for i in range(900):
        good = draw.random() < 0.7
        w = [word() for _ in range(draw.randint(5, 60))]
        rows.append((i, " ".join(w) + "." if good else " | ".join(w) if i % 2 else " ".join(x for x in w[:6] for _ in range(8))))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality.score_documents(docs, quality.fit(docs, truth)).collect()
    held = {r.doc_id for r in got if r.held_out}
    assert held == {i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.predicted == labels[r.doc_id][1] for r in got if r.held_out]) > 0.95
    # labels of held-out rows are never read
    flipped = truth.withColumn("quality", F.when(F.col("doc_id").isin(list(held)), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.fit(docs, flipped) == quality.fit(docs, truth)).all()


def test_quality_odd_rows(spark, odd, none, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (5, None, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    weights = quality.fit(clashing, labels)
    rows = quality.score_documents(clashing, weights).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.score_documents(none, quality.fit(none, labels.limit(0))).count() == 0


PAGE = """<!DOCTYPE html><html lang="en"><head><title>{title}</title><script>var t="</p><p>no</p>";</script></head><body class="nav-open">
<nav><ul><li><a href="/a">{a}</a></li><li>Home</li></ul></nav><!-- <p>no</p> --><header><h2>Site</h2></header>
<div class="cookie-notice">We use cookies {a}</div><aside><p>{a} side</p></aside>
<article><h1>{title}</h1><div class="byline">Share this story</div>{body}<section class="comments"><p>{a} first!</p></section></article>
<form><p>Sign up {a}</p></form><footer>&copy; {a}</footer></body></html>"""


def test_articles_of_a_host(spark):
    draw = random.Random(7)
    pages, want = [], {}
    for i in range(12):
        parts = [" ".join(draw.choice(["lorem", "ipsum", "dolor", "a&amp;b", "&lt;x&gt;"]) for _ in range(draw.randint(3, 20))) for _ in range(draw.randint(1, 6))]
        body = "".join(f"<p><b>{p}<br>\n\n  more </b>" if k % 2 else f"<p>{p}</p>" for k, p in enumerate(parts))
        pages.append((i, f"https://{'one' if i < 8 else 'two'}.example/{i}", PAGE.format(title=f"Title {i}", a=f"x{i}", body=body)))
        plain = [p.replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">") for p in parts]
        want[i] = "\n\n".join([f"Title {i}", *(f"{p} more" if k % 2 else p for k, p in enumerate(plain))])
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r for r in wrapper.main_texts(frame).collect()}
    assert {i: r.text for i, r in got.items()} == want  # "Share this story" is the same on all pages: template
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_every_layout_of_a_host_has_its_article(spark):
    """Slots of other classes, tags and depths, and several articles on a page."""
    draw = random.Random(9)
    text = lambda: " ".join(f"w{draw.randrange(10**6)}" for _ in range(20))
    shapes = ['<article class="post sport"><p>{}</p></article>', '<article class="news post"><p>{}</p></article>', "<div><div><article><p>{}</p></article></div></div>", '<div class="content"><p>{}</p></div>', "<article><p>{}</p></article><p>between</p><article><p>{}</p></article>", "<p>{}</p>"]
    pages, want = [], {}
    for i in range(24):
        parts = [text(), text()][: shapes[i % 6].count("{}")]
        pages.append((i, "https://h.example/a", f"<html><body><nav>menu</nav>{shapes[i % 6].format(*parts)}<footer>end</footer></body></html>"))
        want[i] = "\n\n".join(parts)
    pages.append((99, "https://h.example/b", '<html><body><nav>menu</nav><article class="lone"><p>only here</p></article></body></html>'))
    want[99] = "only here"
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrapper.main_texts(frame).collect()} == want


def test_templates_do_not_depend_on_the_order(spark):
    trees = [wrapper.fold([wrapper.parse(PAGE.format(title=f"t{i}", a=i, body=f"<p>{i}</p>" * (i % 3) + "<ul><li>z</li></ul>" * (i % 2)))[0]]) for i in range(6)]
    one, two = trees[0], trees[-1]
    for t in trees[1:]:
        one = wrapper.merged(one, t)
    for t in trees[-2::-1]:
        two = wrapper.merged(two, t)
    assert one.pages == two.pages == 6
    assert wrapper.matching(one, two, {}) >= max(wrapper.matching(t, t, {}) for t in trees)
    page = PAGE.format(title="new", a="q", body="<p>own text</p>")
    assert wrapper.extract(page, one) == wrapper.extract(page, two) == "new\n\nown text"


def _texts(spark, pages) -> dict[int, str]:
    frame = spark.createDataFrame([(i, "https://h.example/a", h) for i, h in pages], "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in wrapper.main_texts(frame).collect()}


def test_the_template_tells_content_where_no_tag_does(spark):
    """Pages without article elements: alone everything is kept, on its host only what varies."""
    draw = random.Random(3)
    word = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    shell = "<html><body><div class=top>The Daily Host</div><div class=line>Since 1901</div><div class=a>{}</div><div class=b><p>{}</p><p>{}</p></div><div class=end>All rights reserved here</div></body></html>"
    pages = [(i, shell.format(word(3), word(25), word(18))) for i in range(12)]
    got = _texts(spark, pages)
    for i, page in pages:
        parts = [b.text for b in wrapper.parse(page)[1]]
        assert got[i] == "\n\n".join(parts[2:5])
        assert wrapper.extract(page, None) == "\n\n".join(parts)  # without the template nothing tells them apart
    # the same inside a wide article body
    wide = [(i, f"<html><body><article><div class=kicker>Read our best stories</div><h1>{word(4)}</h1><p>{word(30)}</p><div class=tail>Published by the Daily Host</div></article></body></html>") for i in range(12)]
    got = _texts(spark, wide)
    for i, page in wide:
        parts = [b.text for b in wrapper.parse(page)[1]]
        assert got[i] == "\n\n".join(parts[1:3]) and wrapper.extract(page, None) == "\n\n".join(parts)


def test_versions_of_one_article_are_kept_whole(spark):
    """Only one paragraph differs between the pages of a host: title, headings and equal paragraphs stay."""
    parts = ["A title", "First paragraph of the text, which is long.", "Heading", "Second one that says more.", "Heading two", "Third and last paragraph."]
    page = lambda k: f"<html><body><nav>menu</nav><article><h1>{parts[0]}</h1><p>{parts[1]}</p><h2>{parts[2]}</h2><p>{parts[3]} edited {k}.</p><h2>{parts[4]}</h2><p>{parts[5]}</p></article></body></html>"
    got = _texts(spark, [(k, page(k)) for k in range(5)])
    for k in range(5):
        assert got[k] == "\n\n".join([*parts[:3], f"{parts[3]} edited {k}.", *parts[4:]])


def test_comments_adverts_and_part_headers(spark):
    draw = random.Random(8)
    word = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    pages, want = [], {}
    for i in range(6):
        title, body = word(4), word(30)
        deep = "<div>" * 90 + f'<div class="advert"><p>{word(9)}</p></div>' + f"<p>deep {word(6)}</p>" + "</div>" * 90
        kept = [b.text for b in wrapper.parse(deep)[1] if b.text.startswith("deep")]
        around = '<div class="comments">' + "<div>" * 80 + f"<p>{word(7)}</p>" + "</div>" * 80 + "</div>"
        pages.append((i, f'<html><body><article class="post has-comments"><div class="entry-header"><h1>{title}</h1></div><p>{body}</p>{deep}{around}</article><article class="comment"><p>{word(12)}</p></article><article id="comment-12" class="depth-1"><p>{word(12)}</p></article><article class="ad-slot">{word(5)}</article></body></html>'))
        want[i] = "\n\n".join([title, body, *kept])
    assert _texts(spark, pages) == want


def test_html_clashing_columns(spark):
    page = "<article><p>text &amp; more</p></article>"
    names = ["host", "page", "key", "text", "n_chars", "template", "salt", "url_", "html_"]
    frame = spark.createDataFrame([(1, "http://a/", page, *map(str, range(len(names))))], "page_id long, url string, html string, " + ", ".join(f"`{n}` string" for n in names))
    assert [tuple(r) for r in wrapper.main_texts(frame).collect()] == [(1, "http://a/", "text & more", 11)]


def test_html_odd_rows(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    pages = [(1, None, None), (1, None, None), (2, "", ""), (None, "http://a/", "plain text &amp; more"), (3, "http://a/", deep), (4, "x", "<p>un<b>closed"), (5, "http://h/", "<article><p>same</p></article>"), (6, "http://h/", "<article><p>same</p></article>"), (7, "http://h", "<" * 500), (8, "u", "a < b <!-- never closed")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"text": F.lit("clash"), "host": F.lit(1), "template": F.lit(2)})
    got = [(r.page_id, r.text) for r in wrapper.main_texts(frame).collect()]
    assert len(got) == len(pages)
    by = dict(got)
    assert by[1] == by[2] == "" and by[None] == "plain text & more" and by[3] == "deep" and by[4] == "unclosed"
    assert by[5] == by[6] == "same" and by[8] == "a < b"
    assert wrapper.main_texts(frame.limit(0)).count() == 0


@pytest.fixture(scope="module")
def stages(spark, folder):
    import corpus_pipeline
    from scanlens.session import written

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], folder), name))
    return out


def test_pipeline_stages(spark, folder, stages):
    import corpus_pipeline
    from test_decontaminate import _brute
    from test_setjoin import _components
    from test_text_operators import _repeats

    docs, known, single, cut, clean, coded = stages
    assert all(s.columns == docs.columns and s.dtypes == docs.dtypes for s in stages[1:-1])
    text = [{r.doc_id: r.text for r in s.select("doc_id", "text").collect()} for s in stages[:-1]]
    assert {i for i, (_, c) in _components(text[1]).items() if c == i} == set(text[2])
    from scanlens.llm import spans

    want = _repeats(list(text[2].items()), spans.RUN_WORDS)
    assert {i: t for i, t in want.items() if t.strip() or t == text[2][i]} == text[3]
    items = {str(r.item_id): r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    assert {i for i, t in text[3].items() if not _brute(t, items, 10)[1]} == set(text[4])
    assert {r.doc_id for r in coded.collect()} == set(text[4])
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, coded.collect()))


def test_registered_queries_match_sql(spark, folder):
    import os
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
    from check_catalog import connect, difference

    duck = connect(folder)
    for name, sql in catalog.LLM_ORACLES.items():
        assert difference(catalog.LLM_QUERIES[name](spark, folder), duck, sql) is None, name
