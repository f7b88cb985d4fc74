import time

import pytest

from docketframe.llm import html_extract

ARTICLE = "<article><h1>A title here</h1>" + "".join(f"<p>Sentence number {i} of the article, long enough to be read. And one more.</p>" for i in range(8)) + "</article>"


@pytest.fixture(scope="module")
def model():
    return html_extract.trained()


def text_of(model, html):
    return model.extract(html)


@pytest.mark.parametrize(
    "html",
    [
        f"<html><body><![foo[bar]]>{ARTICLE}</body></html>",
        f"<html><body><![if !IE]>{ARTICLE}<![endif]><![CDATA[x]]></body></html>",
        f"<html><body>{ARTICLE}<![unfinished",
        f"<html><head><title>T</title><body>{ARTICLE}</body></html>",
        f"<html><head><title>T<meta charset=utf-8><body>{ARTICLE}</body></html>",
        *(f"<html><body><{tag}>{ARTICLE}</body></html>" for tag in ("button", "svg", "select", "noscript", "textarea", "iframe", "template")),
        f"<html><body><button>one<div>{ARTICLE}</div><button>two</button></body></html>",
    ],
)
def test_broken_pages_keep_their_article(model, html):
    text = text_of(model, html)
    assert "Sentence number 0 of the article" in text and "Sentence number 7 of the article" in text
    assert "two" not in text.split() and "bar" not in text


def test_silent_elements_with_ends_stay_silent(model):
    page = f"<html><head><title>T</title></head><body><svg><text>drawn</text></svg><noscript><p>Turn it on, please, right now.</p></noscript>{ARTICLE}<select><option>pick</select></body>"
    text = text_of(model, page)
    assert "drawn" not in text and "Turn it on" not in text and "pick" not in text and "Sentence number 3" in text


@pytest.mark.parametrize("unit", ["<b><p>x</p>", "<i><div>x</div></b>", "<b></i>x"])
def test_unclosed_inline_tags_take_time_in_proportion(unit):
    def seconds(n):
        start = time.perf_counter()
        html_extract.Tree(unit * n)
        return time.perf_counter() - start

    seconds(500)
    assert min(seconds(16_000) for _ in range(2)) < 9 * min(seconds(4_000) for _ in range(3))
