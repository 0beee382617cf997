"""Pages with known main text, and blocks of broken markup."""

import time

import numpy as np
import pytest

from paddock.llm.html_blocks import blocks_of


@pytest.fixture(scope="module")
def model():
    from paddock.llm.block_labeller import features, fit
    from paddock.llm.block_layouts import training_pages

    texts = [f"A sentence number {i} with some words in it, as articles have." for i in range(80)]
    pages = [f"<nav><a href=x>Home {k}</a></nav><article><h1>{texts[k]}</h1><p>{texts[k + 1]}</p></article>"
             f"<footer>c {k}</footer>" for k in range(60)]
    known = training_pages(pages, layouts=1200)
    return fit([features(b) for b, _ in known], [y.astype(np.float32) for _, y in known])


def texts(page):
    return [b.text for b in blocks_of(page)]


def test_blocks_of_broken_markup():
    assert texts("") == texts("<p></p>") == texts("<script>var a = '<p>x</p>'</script>") == []
    assert texts("a<br>b <i>c</i>\n d<p>e<p>f") == ["a b c d", "e", "f"]
    assert texts("<p>x &lt; y &amp;amp; z&nbsp;&#233;") == ["x < y &amp; z é"]
    assert texts("<ul><li>a<li>b</ul>c") == ["a", "b", "c"]
    assert texts('<p title="a>b">c</p><!-- <p>no</p> --> 1 < 2') == ["c", "1 < 2"]
    assert texts("<style>p{}</style ><p>a</b>b<script>never closed <p>c") == ["ab"]
    assert texts("<article><p><b>head<br><p>one</p></article><footer>f</footer>") == ["head", "one", "f"]


def test_a_new_layout(model):
    from paddock.llm.block_labeller import features, label

    page = """<body><div id="top-nav"><a href=/>Home</a></div><div class="cookie-banner"><p>We use cookies.</p></div>
    <div class="post-content"><h1>Title</h1><p>First  para.<p>Second <i>one</i>.</div>
    <aside><p>Other story</p></aside><section id="comments"><div class="comment"><p>Nice!</p></div></section>
    <form><label>Mail</label><button>Go</button></form><div class="footer">c 2020</div></body>"""
    blocks = blocks_of(page)
    kept = label(model, [features(blocks)])[0]
    assert [b.text for b, y in zip(blocks, kept) if y] == ["Title", "First para.", "Second one."]


def test_held_out_layouts(model):
    from paddock.llm.block_labeller import features, label
    from paddock.llm.block_layouts import Layouts

    drawn = Layouts([f"Text {i} of an article, a longer one." for i in range(40)], ["Home", "Log in", "About us"], seed=77)
    pages = [x for x in (drawn.labelled() for _ in range(200)) if x[0]]
    found = label(model, [features(b) for b, _ in pages])
    wrong = sum(int((f != y).sum()) for f, (_, y) in zip(found, pages))
    assert wrong <= 0.03 * sum(len(y) for _, y in pages)


def test_gradients_are_right():
    from paddock.llm.block_labeller import INPUTS, Labeller, padded

    r = np.random.RandomState(0)
    model = Labeller.fresh()
    for name, p in vars(model).items():
        setattr(model, name, p.astype(np.float64) + (r.normal(0, 0.1, p.shape) if name == "out" else 0))
    x, mask = padded([r.normal(size=(4, INPUTS)), r.normal(size=(2, INPUTS))])
    y = r.randint(0, 2, mask.shape).astype(float)

    def loss():
        s, _ = model.forward(x, mask)
        return float(((np.log1p(np.exp(s)) - y * s) * mask).sum() / mask.sum())

    for p, g in zip(model.parts(), model.gradients(x, mask, y)):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old = p[at]
        p[at] = old + 1e-3
        up = loss()
        p[at] = old - 1e-3
        down = loss()
        p[at] = old
        assert abs((up - down) / 2e-3 - g[at]) < 1e-2 * abs(g[at]) + 1e-6


def test_pages_without_text(spark, model):
    from paddock.llm.html_extraction import main_text

    df = spark.createDataFrame([(1, None), (2, ""), (3, "<nav>x</nav>"), (3, "<nav>x</nav>")],
                               "page_id long, html string").selectExpr("*", "1 as text", "2 as n_chars")
    rows = main_text(df, model).select("_row.page_id", "text", "n_chars").collect()
    assert len(rows) == 4 and all(r.n_chars == len(r.text) for r in rows)
    assert {r.text for r in rows if r.page_id < 3} == {""}
    assert main_text(df.limit(0), model).count() == 0


def test_formulas_and_drawings_are_text_of_the_page():
    got = [b.text for b in blocks_of("<p>Area <math><mi>x</mi></math> of <svg><text>y</text></svg> end</p>"
                                     "<svg><p>after an open one</p><script>no < text</script>")]
    assert got == ["Area x of y end", "after an open one"]


def test_broken_tags_cost_their_length():
    start = time.perf_counter()
    for bad in ('<a "', "<! ", '<a ">" ', "<a", "<p ' \""):
        blocks_of(bad * ((1 << 20) // len(bad)))
    assert time.perf_counter() - start < 20
