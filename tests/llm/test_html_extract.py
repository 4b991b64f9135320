import itertools
import random
import time

import pytest

from cellmart.llm import html_extract
from cellmart.llm.html_tree import parse
from cellmart.llm.labelled_pages import labelled_pages

P = "Here is a sentence of the article that goes on for a while, as sentences do. "


@pytest.fixture(scope="module")
def model():
    out = html_extract.Model()
    for page, labels in labelled_pages():
        out.learn(parse(page), labels, html_extract.LABELLED_WEIGHT)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_messages_give_exact_marginals(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 9)
    parents = [-1, *(rng.randrange(i) for i in range(1, n))]
    local = [(rng.random() + 0.01, rng.random() + 0.01) for _ in range(n)]
    table = [[rng.random() + 0.01 for _ in range(2)] for _ in range(2)]
    weight, total = [0.0] * n, 0.0
    for labels in itertools.product((0, 1), repeat=n):
        w = 1.0
        for i, x in enumerate(labels):
            w *= local[i][x] * (table[labels[parents[i]]][x] if i else 1.0)
        total += w
        for i, x in enumerate(labels):
            weight[i] += w * x
    assert html_extract.marginals(parents, local, table) == pytest.approx([w / total for w in weight])


def test_labelled_pages_are_learned(model):
    right = total = 0
    for page, labels in labelled_pages():
        tree = parse(page)
        text = html_extract.main_text(page, model)
        expected = {t.strip() for n, t, _ in tree.texts if labels[n] and t.strip()}
        right += sum(e in text for e in expected)
        total += len(expected)
    assert right >= 0.97 * total


PAGES = {
    "article": f"<body><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{P}<p>{P}<a href=x>link</a> end</article><footer>{P}</footer>",
    "div": f"<div class='site-header'><a href=/>Site</a></div><div class='post-content'><h1>Title</h1><p>{P}</p><p>{P}<a href=x>link</a> end</p></div><div id=sidebar><p>{P}</p></div>",
    "comments": f"<main><article><h1>Title</h1><p>{P}</p><p>{P}<a href=x>link</a> end</p><section class='comments'><h3>Comments</h3><div class='comment'><p>{P}</p></div></section></article></main>",
    "notices": f"<div class='cookie-notice'><p>{P}</p></div><main id=content><h1>Title</h1><p>{P}</p><div class='ad-banner'>Buy now</div><p>{P}<a href=x>link</a> end</p><form><label>Name</label><input><p>{P}</p></form></main>",
    "aside": f"<header><h2>Site</h2></header><main><h1>Title</h1><p>{P}</p><aside><p>{P}</p></aside><p>{P}<a href=x>link</a> end</p></main><div class='related-posts'><ul><li><a href=/1>{P}</a></li></ul></div>",
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(model, name):
    assert html_extract.main_text(PAGES[name], model).split("\n") == ["Title", P.strip(), f"{P.strip()} link end"]


def test_blocks_references_and_white_space(model):
    page = "<article><p>a &amp; b&nbsp;&lt;c&gt;\n\t d<br>e<b>f</b><!-- no --><script>var x='<p>';</script><p>&#233;&euro;x<style>p{}</style></p>\n<ul><li>one<li>two</ul></article>"
    assert html_extract.main_text(page, model) == "a & b <c> d ef\né€x\none\ntwo"


@pytest.mark.parametrize("page", [None, "", "   ", "plain", "<", "<p", "<div><div></p></div>", "<script>never ends", "<!-- never ends", "</b></i>" * 50])
def test_broken_pages_do_not_stop(model, page):
    html_extract.main_text(page, model)


def test_deep_and_long_pages(model):
    html_extract.main_text("<div>" * 3000 + "x", model)
    text = html_extract.main_text(f"<article>{f'<p>{P}</p>' * 5000}</article>", model)
    assert text == "\n".join([P.strip()] * 5000)


def test_table(spark):
    rows = [(1, "u", PAGES["article"], 1), (1, "u", PAGES["article"], 1), (None, None, None, 2), (3, "v", "", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html_extract.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = got.collect()
    assert all(len(r.text) == r.n_chars for r in rows) and [r.n_chars > 0 for r in rows if r.page_id == 1] == [True, True]
    assert {r.text for r in rows if r.page_id != 1} == {""}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_formulas_and_literal_text_stay(model):
    formula = "<math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><mspace width='1em'/></math>"
    page = f"<main><article><h1>Title</h1><p>{P}<svg class='icon' width=1 /></p><p>So {formula} holds. {P}</p><xmp>if a <b> c &amp; d</xmp><p>{P}<svg><path d='M0'/><title>icon</title><text>Label</text></svg> end</p></article></main>"
    text = html_extract.main_text(page, model)
    assert text.count(P.strip()) == 3 and "So E=mc2 holds." in text and "if a <b> c &amp; d" in text
    assert "Label" in text and "icon" not in text and text.endswith("end")


@pytest.mark.parametrize(
    "unit", ["<a '", "<a ", "<a<a", '<a "x" ', "<div>", "<select>", "<p><b>", "<li><ul><div>", "<td>", "<svg ", "<b =a", "<noscript>", "<script", "</div>", "<!--"]
)
def test_broken_pages_take_time_that_follows_their_length(unit):
    """A third of a megabyte of what is never closed: a search from every tag to the end of the page would take minutes."""
    page = unit * (300_000 // len(unit))
    started = time.process_time()
    tree = parse(page)
    assert time.process_time() - started < 10
    assert sum(len(t) for _, t, _ in tree.texts) <= len(page)


def test_quotes_decide_where_tags_end():
    for page, texts in (
        ("""<p title="a > b" class='x'>one</p>two""", ["one", "two"]),
        ("""<p title="a > b>one</p>two""", ["""<p title="a > b>one""", "two"]),
        ("""x <a"b c>y""", ["x ", "y"]),
        ("1 < 2 <3 </ b> <b>4</b>", ["1 < 2 <3 </ b> ", "4"]),
        ("""<svg class=a/>in<text>label</text></svg>out""", ["in", "label", "out"]),
        ("""<svg class="a"/>out""", ["out"]),
    ):
        assert [t for _, t, _ in parse(page).texts] == texts
