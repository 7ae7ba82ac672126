import random

import numpy as np
import pytest

from vigil.llm import html_extract as X
from vigil.llm.html_blocks import blocks_of
from vigil.llm.html_pages import labelled_page


def texts(html):
    return [b.text for b in blocks_of(html)]


def test_blocks():
    assert texts("") == texts(" \n ") == texts("<p></p><!-- x -->") == []
    assert texts("<p>a<b>b</b> c<br>d &amp; e&amp f &#233; &am</p>x") == ["ab c d & e& f é &am", "x"]
    assert texts("<script>var t='</p>';</script><style>p{}</style><p>t</p><title>q</title>") == ["t"]
    assert texts("<SCRIPT>x</Script >y") == ["y"]
    assert texts("a < b <3 <p title='x>y'>c</p>") == ["a < b <3", "c"]
    assert texts("one<p>two<p>three</div>four") == ["one", "two", "three", "four"]
    for cut in ("<p", "<", "</", "</artic", "<p class='x", "<!-- c", "<!doc"):
        assert texts("<p>kept</p>" + cut) == ["kept"], cut
    assert texts("<script>never ends") == []
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]


def test_paths_and_links():
    b = blocks_of('<body><nav class="Top menu"><ul><li><a href=x>abc</a> d</ul></nav>'
                  "<article><p><b>text<p>more</article>end")
    assert b[0].path == ("body", "nav top menu", "ul", "li") and b[0].linked == 3
    assert [x.path for x in b[1:]] == [("body", "article", "p"), ("body", "article", "p"), ("body",)]


def test_deep_and_hostile_pages_end_soon():
    assert len(blocks_of("<div>" * 20_000 + "x")) == 1
    assert texts("<p " + "a" * 50_000) == []
    assert texts("<p " + "= ' " * 20_000 + ">x") is not None
    assert len(texts("<p>x</p>" * 20_000)) == 20_000


def test_gradients():
    rng = np.random.default_rng(0)
    model = X.Labeller(1)
    pages = [rng.normal(size=(n, X.INPUT)).astype(np.float32) for n in (3, 5)]
    labels = [np.array([0, 1, 1], np.float32), np.array([1, 0, 0, 1, 0], np.float32)]
    _, grads = model.loss_grads(pages, labels)
    for w, g in zip(model.weights(), grads):
        k = np.unravel_index(int(np.abs(g).argmax()), g.shape)
        old, eps = w[k], 1e-2
        w[k] = old + eps
        up = model.loss_grads(pages, labels)[0]
        w[k] = old - eps
        down = model.loss_grads(pages, labels)[0]
        w[k] = old
        assert (up - down) / (2 * eps) == pytest.approx(float(g[k]), rel=0.05, abs=1e-4)


def test_batches_do_not_change_predictions():
    rng = np.random.default_rng(0)
    model = X.Labeller(1)
    pages = [rng.normal(size=(n, X.INPUT)).astype(np.float32) for n in (2, 9, 4)]
    for p, q in zip(model.predict(pages), [model.predict([p])[0] for p in pages]):
        assert np.allclose(p, q, atol=1e-5)


def test_held_out_accuracy():
    model = X.trained()
    pages, labels = X.labelled_sample(200, seed=123)
    right = np.concatenate([(model.predict([p])[0] >= 0.5) == (y > 0.5) for p, y in zip(pages, labels)])
    assert right.mean() >= 0.98


def test_labels_are_known():
    rng = random.Random(5)
    for _ in range(30):
        html, known = labelled_page(rng)
        if html.endswith("</html>"):
            assert all(b.text in known for b in blocks_of(html))


def page(article, cut=None):
    html = ('<!DOCTYPE html><html lang="en"><head><title>T</title></head><body><nav><ul><li>'
            '<a href="/x">Menu</a></li></ul></nav><div class="ad">Buy this now.</div>'
            f'<article>{article}</article><aside class="sidebar"><h3>Related</h3><a href="/">link</a>'
            "</aside><footer>&copy; example.net</footer></body></html>")
    return html if cut is None else html[:cut]


def test_extract(spark):
    rows = [(1, "a", page("<h1>Title here</h1><p>Some text &amp; more.</p><p><b>Last<br>part.")),
            (2, "b", ""), (3, None, None), (None, "d", "<p></p>"),
            (4, "e", page("<h1>One</h1>" + "<p>word word word.</p>" * 3000)),
            (4, "e", page("<h1>Title here</h1><p>Some text."))]
    df = spark.createDataFrame([(*r, "x") for r in rows],
                               "page_id long, url string, html string, text string")
    got = [(r.page_id, r.url, r.text) for r in X.extract(df).collect()]
    want = [(1, "a", "Title here Some text & more. Last part."), (2, "b", ""), (3, None, ""),
            (None, "d", ""), (4, "e", " ".join(["One"] + ["word word word."] * 3000)),
            (4, "e", "Title here Some text.")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert X.extract(df.limit(0)).count() == 0


def test_elements_without_content_leave_the_page():
    from vigil.llm.html_blocks import blocks_of
    texts = lambda html: [b.text for b in blocks_of(html)]
    for head in ("<svg/>", "<svg width='1' />", '<svg viewBox="0 0 1 1"/>', "<math/>", "<noscript>",
                 "<template>", "<svg>", "<math>"):
        assert texts(f"<body>{head}<p>one</p><p>two</p></body>") == ["one", "two"], head
    assert texts("<svg/><p>one</p><svg><path/>x</svg><p>two</p>") == ["one", "two"]
    assert texts("<template><p>one</p><template>x</template><p>two</p>") == ["one", "two"]
    assert texts("<svg><svg>x</svg>y</svg><p>one</p>") == ["one"]
    assert texts("<svg width=5/>x</svg><p>one</p>") == ["one"]
    assert texts("<noscript>x</noscript><p>one</p>") == ["one"]
    assert texts("<p>so <math><mi>a</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><mspace/>"
                 "<annotation>tex</annotation></math> holds</p>") == ["so a=12 holds"]
