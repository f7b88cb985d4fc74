import pytest

from docketframe.llm import html_extract

FORMULA = "<math><mrow><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><mspace/></mrow></math>"


@pytest.fixture(scope="module")
def model():
    return html_extract.trained()


def page(inner):
    return (
        "<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav><article><h1>On energy</h1>"
        f"<p>A first paragraph tells what the text is about. It has two sentences.</p>{inner}"
        "<p>A last paragraph closes the text. It has two sentences too.</p></article><footer>&copy; 2020 us</footer></body></html>"
    )


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        (f"<p>The law {FORMULA} holds for all bodies at rest.</p>", "The law E=mc2 holds for all bodies at rest."),
        ("<p>The plan <object data=a.pdf>of the house</object> is kept here.</p>", "The plan of the house is kept here."),
        ("<p>Watch <video src=a><source src=b>a talk on bees</video> and <audio src=c>a song of birds</audio>.</p>", "Watch a talk on bees and a song of birds."),
        ("<p>See <canvas id=c>a chart of prices</canvas> and <map name=m><area href=x>a map of roads</map>.</p>", "See a chart of prices and a map of roads."),
        ("<p>Before it. <object><p>Inner words are here.</object>After it.</p>", "Before it.\nInner words are here.\nAfter it."),
    ],
)
def test_formulas_and_fallback_text_are_text(model, inner, text):
    lines = model.extract(page(inner)).split("\n")
    assert lines[2:-1] == text.split("\n")


def test_what_is_no_text_stays_out(model):
    inner = "<p>One <script>var a</script><svg><text>drawn</text></svg><button>Go</button>line of text is here.</p>"
    assert model.extract(page(inner)).split("\n")[2] == "One line of text is here."
