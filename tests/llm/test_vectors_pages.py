"""Top-k and page text against brute force, the registered queries, and the pipeline."""

from __future__ import annotations

import math
import random
import time

import duckdb
import pytest

import corpus_pipeline
from tapeloom.llm import catalog, htmltext, topk

SF = "/root/testdata/sf0.001"


def by_hand(rows, queries, k):
    vectors = {}
    for number, v in rows:
        if number is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.setdefault(number, []).append([math.floor(256 * x) for x in v])
    out = []
    for q in sorted(queries & set(vectors)):
        scores = [
            (-max(sum(a * b for a, b in zip(vectors[q][0], v)) for v in many), number)
            for number, many in vectors.items() if number != q
        ]
        out += [(q, rank, number, -s) for rank, (s, number) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize("at_once", [4096, 2])
def test_top_k_brute_force(spark, at_once):
    random.seed(4)
    rows = [(i, [random.choice([0.0, 0.25, -0.5, random.gauss(0, 0.3)]) for _ in range(8)]) for i in range(300)]
    rows += [(300, None), (301, [0.1, None]), (302, [float("nan")] * 8), (303, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    rows += [(400 + i, list(rows[7][1])) for i in range(9)] + [rows[11], (500, [0.0] * 8), (501, [1.0] * 3)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, score string")
    rounded = [(r.vec_id, r.embedding) for r in frame.collect()]
    found = topk.top_k(frame, frame.filter("vec_id % 50 = 0"), queries_at_once=at_once)
    assert [tuple(r) for r in found.orderBy("query_id", "rank").collect()] == by_hand(
        rounded, {i for i, _ in rows if i is not None and i % 50 == 0}, 5
    )
    assert topk.top_k(frame.limit(0), frame.limit(0)).collect() == []
    few = frame.filter("vec_id < 3")
    assert topk.top_k(few, few).count() == 6


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p><p>x";</script></head>
<body><header>site</header><nav><ul><li><a href="/">home</a></ul></nav><div class="cookie-notice">cookies</div>
<%s><h1>Head &amp;amp; tail</h1><p><b>One<br>two&nbsp; three <p>Fo<i>u</i>r<!-- no --> &lt;5 &copy</p>
<aside>aside</aside><form><p>mail</p></form><div class="comments"><p>first!</p></div><ul><li>a<li>b</ul></%s>
<div id="sidebar">side</div><footer>foot &middot; er</footer></body></html>"""
TEXT = "Head &amp; tail\n\nOne two three\n\nFour <5 ©\n\na\n\nb"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows],
                                 "page_id bigint, url string, html string, host string, `page` int")


def test_page_text(spark):
    rows = [(1, "http://A.example/x", PAGE % ("article", "article")), (2, "http://a.example/y", PAGE % ("article", "article")),
            (3, None, None), (4, "nonsense", ""), (5, "http://b.example", "plain &amp; simple"),
            (5, "http://b.example", "plain &amp; simple"), (None, "http://a.example/z", "<p>cut <b"),
            (6, "http://c.example", "<p>" + "long " * 50_000 + "</p>")]
    found = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in htmltext.extract(pages(spark, rows)).collect()), key=str)
    texts = [TEXT, TEXT, "", "", "plain & simple", "plain & simple", "cut", ("long " * 50_000).strip()]
    assert found == sorted([(i or 0, u, t, len(t)) for (i, u, _), t in zip(rows, texts)], key=str)
    assert htmltext.extract(pages(spark, [])).collect() == []


def test_slot_of_the_host(spark):
    """Without an article element, the host's template tells where the text is."""
    rows = [(k, f"http://h.example/{k}",
             f'<body><div class="top">word {k}</div><div class="body"><p>{"text " * 30}{k}</p></div><div class="end">z</div></body>')
            for k in range(6)]
    found = {r.page_id: r.text for r in htmltext.extract(pages(spark, rows)).collect()}
    assert found == {k: "text " * 30 + str(k) for k in range(6)}
    template = htmltext.templates(htmltext.hosted(pages(spark, rows), "page_id", "url", "html").select("host", "html")).first()
    paths = [p for c in template.classes for p in c.paths]
    assert "body/div.body" in paths and all(c.parent < len(template.classes) for c in template.classes)


def test_slot_of_varying_paragraphs(spark):
    """Paragraphs whose number varies belong to the container around them; depth does not count."""
    rows = []
    for k in range(6):
        text = "".join(f"<p>{'text ' * 10}{k} {n}</p>" for n in range(1 + k % 3))
        rows.append((k, f"http://h.example/{k}",
                     f'<body><div class="content"><h1>Title {k}</h1>{text}<ul><li>one {k}<li>two {k}</ul></div>'
                     f'<div><div><div class="logo">logo {k}</div></div></div></body>'))
    found = {r.page_id: r.text for r in htmltext.extract(pages(spark, rows)).collect()}
    for k in range(6):
        text = [f"{'text ' * 10}{k} {n}" for n in range(1 + k % 3)]
        assert found[k] == "\n\n".join([f"Title {k}", *text, f"one {k}", f"two {k}"])


def test_template_goes_before_the_article_element(spark):
    """What the pages share leaves the article, and a small article element is not the slot."""
    notice = "<div><p>All rights reserved by the publisher.</p></div>"
    rows = [(k, f"http://h.example/{k}", f"<body><article><h1>Title {k}</h1>{notice}<p>{'text ' * 9}{k}</p></article></body>")
            for k in range(4)]
    rows += [(10 + k, f"http://i.example/{k}",
              f"<body><article><p>teaser {k}</p></article><div class='x'><p>{'text ' * 9}{k}</p></div></body>") for k in range(4)]
    found = {r.page_id: r.text for r in htmltext.extract(pages(spark, rows)).collect()}
    assert found == {k: f"Title {k}\n\n{'text ' * 9}{k}" for k in range(4)} | {10 + k: f"{'text ' * 9}{k}" for k in range(4)}


def test_near_copies_keep_their_article(spark):
    """Pages of a host that share all but a line are near copies; what they share is the article."""
    article = "".join(f"<p>{'word ' * 12}{n}</p>" for n in range(5))
    body = [f"{'word ' * 12}{n}".strip() for n in range(5)]
    rows, want = [], {}
    for size in range(3, 11):
        for k in range(size):
            rows.append((size * 100 + k, f"http://n{size}.example/{k}", f"<body><div class='box'>{article}<p>Updated at {k}</p></div></body>"))
            want[size * 100 + k] = "\n\n".join([*body, f"Updated at {k}"])
            rows.append((5000 + size * 100 + k, f"http://m{size}.example/{k}", f"<body><article>{article}<p>Updated at {k}</p></article><div>x</div></body>"))
            want[5000 + size * 100 + k] = want[size * 100 + k]
    assert {r.page_id: r.text for r in htmltext.extract(pages(spark, rows)).collect()} == want


def test_comments_do_not_outweigh_the_article(spark):
    rows = [(k, f"http://c.example/{k}", f"<body><article><h1>Title {k}</h1><p>{'text ' * 20}{k}</p></article>"
             f"<div class='feedback'>{''.join(f'<p>opinion {n} of {k} {chr(97 + n) * 30}</p>' for n in range(6))}</div></body>")
            for k in range(5)]
    found = {r.page_id: r.text for r in htmltext.extract(pages(spark, rows)).collect()}
    assert found == {k: f"Title {k}\n\n{'text ' * 20}{k}" for k in range(5)}


def test_deep_and_odd_markup(spark):
    """Very deep pages lose no text and take no time that grows with the square of their depth."""
    deep = "<div>" * 30_000 + "bottom" + "<p>after"
    rows = [(1, "http://d.example/1", deep), (2, "http://e.example/1", "<!-->kept<!--->too<!-- not --> end")]
    start = time.time()
    found = {r.page_id: r.text for r in htmltext.extract(pages(spark, rows)).collect()}
    assert found == {1: "bottom\n\nafter", 2: "kepttoo end"}
    assert time.time() - start < 60


def test_wrappers_named_as_boilerplate(spark):
    """A name alone drops no element around the article, and still drops comments and adverts."""
    text, aside = "text " * 9, "<div class='comments'><p>first</p></div><div class='ad'>buy</div>"
    bodies = [f"<div class='page has-sidebar'><p>{text}</p>{aside}</div>", f"<div id='post-with-comments'><article>{text}{aside}</article></div>",
              f"<div class='teasers'><p>{'more ' * 30}</p></div><div class='no-sidebar'><main>{text}</main></div>{aside}",
              f"<article>{text}</article><div class='comments'><p>{'first ' * 20}</p></div>",
              f"<div>{text}</div><div class='comments'><article>a</article><article>b</article></div>"]
    rows = [(k, f"http://h{k}.example/", f"<body>{body}</body>") for k, body in enumerate(bodies)]
    rows += [(10 + k, f"http://i.example/{k}", f"<body><div class='page has-sidebar'>{aside}<div><p>{k} {text}</p></div></div></body>")
             for k in range(3)]
    found = {r.page_id: r.text for r in htmltext.extract(pages(spark, rows)).collect()}
    assert found == {k: text.strip() for k in range(5)} | {10 + k: f"{k} {text}".strip() for k in range(3)}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_runs(spark, name):
    rows = catalog.QUERIES[name](spark, SF)
    assert rows.count() > 0
    if name in catalog.ORACLE:
        with duckdb.connect() as con:
            for name_ in ("documents", "embeddings", "benchmark", "conversations"):
                con.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{SF}/{name_}.parquet'")
            expected = con.execute(catalog.ORACLE[name]).fetchall()
        assert sorted(map(tuple, rows.collect()), key=repr) == sorted(expected, key=repr)


def test_pipeline(spark):
    """Each stage's decisions against the operators' own answers on its input."""
    from tapeloom.llm import decontaminate, near, paragraphs, stages
    from tapeloom.llm.frames import stored, table

    docs = table(spark, SF, "documents").cache()
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF), f"test-{name}"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept[-1].columns == docs.columns
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert all(later <= earlier for earlier, later in zip(ids, ids[1:]))
    marks = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    good = [d for d in ids[0] if marks.get(d) == 1]
    assert sum(d in ids[1] for d in good) >= 0.97 * len(good)
    classes = near.near_duplicates(kept[1]).collect()
    assert ids[2] == {r.class_id for r in classes}
    cut = {r.doc_id: r.text for r in paragraphs.without_repeats(kept[2]).collect()}
    assert {r.doc_id: r.text for r in kept[3].collect()} == {d: t for d, t in cut.items() if t}
    leaked = {r.doc_id for r in decontaminate.leaks(kept[3], table(spark, SF, "benchmark")).collect()}
    assert ids[4] == ids[3] - leaked and leaked
    assert ids[5] == ids[4] and stages.COLUMNS == docs.columns
    assert corpus_pipeline.run(spark, SF).count() == len(ids[5])
