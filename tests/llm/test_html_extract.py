from itertools import product
from math import exp

import pytest

from docketframe.llm import html_extract
from docketframe.llm.labelled_pages import labelled_pages


@pytest.fixture(scope="module")
def model():
    return html_extract.trained()


def accuracy(model, pages):
    right = total = 0
    for html in pages:
        tree = html_extract.Tree(html)
        truth, (content, _) = html_extract.labels(tree), model.marginals(tree, html_extract.features(tree))
        for at, _ in tree.blocks:
            total += 1
            right += (content[at] >= 0.5) == bool(truth[at])
    return right / total


def test_pages_drawn_anew_are_read_right(model):
    assert accuracy(model, labelled_pages(99)) > 0.98


@pytest.mark.parametrize("html", ["<div><p>a</p><p>b</p></div>", "<ul><li>x<li><p>y</p></ul>", "<nav>m</nav><article><h1>t</h1></article>"])
def test_messages_give_the_exact_marginals(model, html):
    tree = html_extract.Tree(html)
    found = html_extract.features(tree)
    n = len(tree.nodes)
    mass, on = 0.0, [0.0] * n
    for labels in product((0, 1), repeat=n):
        weight = 1.0
        for at in range(n):
            weight *= exp(sum(model.weights.get(f, 0.0) for f in found[at])) if labels[at] else 1.0
            if at:
                weight *= model.pairs[html_extract.KINDS.get(tree.nodes[at].tag, 0)][labels[tree.nodes[at].parent]][labels[at]]
        mass += weight
        on = [total + weight * label for total, label in zip(on, labels, strict=True)]
    marginals, joint = model.marginals(tree, found)
    assert marginals == pytest.approx([total / mass for total in on])
    assert all(sum(cells) == pytest.approx(1) for cells in joint[1:])


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><div id="cookie-banner"><p>We use cookies. Accept.</p></div>
<header><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav></header><div class="advert">Buy now, it is cheap.</div>
<article><h1>A &amp; B</h1><p><b>First   para&shy;graph<br>with a break, and a <a href=x>link</a>.<p>Second &lt;one&gt; &eacute;&#x41;.</p><script>var a = "<p>no</p>";</script>
</article><aside class=sidebar><p>Something else to read here.</p></aside><section id=comments><article class=comment><p>I agree with this.</p></article></section>
<form><label>Name</label><input><button>Go</button></form><footer>&copy; 2020 us</footer></body></html>"""


def test_main_text_of_a_page(model):
    assert model.extract(PAGE) == "A & B\nFirst para­graph with a break, and a link.\nSecond <one> éA."


@pytest.mark.parametrize(("html", "text"), [("", ""), ("plain words", "plain words"), ("<p>One.", "One."), ("<article><p>cut &am", "cut &am"), ("</div></p>", "")])
def test_malformed_pages(model, html, text):
    assert model.extract(html) == text


def test_every_page_has_a_row(spark, model):
    deep = "<div>" * 3000 + "<p>Deep down.</p>"
    wide = "<article>" + "".join(f"<p>Paragraph number {i} of many.</p>" for i in range(5000)) + "</article>"
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", deep), (4, "x", wide)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as text", "1 as n_chars")
    found = html_extract.extract_pages(frame, model).collect()
    assert [(r.page_id, r.url) for r in found] == [(row[0], row[1]) for row in rows]
    assert all(r.n_chars == len(r.text) for r in found)
    assert found[2].text == found[3].text == ""
    assert found[5].text.count("\n") == 4999
    assert html_extract.extract_pages(frame.limit(0), model).collect() == []
